"""Batch scoring with fitted steps and a fitted model, and the post-test on fresh samples."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.selection import random_rows
from ..schema import RoleSchema, schema_named
from .clean import clean
from .evaluate import errors
from .knn import Predicting, load_index, save_index
from .knn_hashed import HashedIndex, load_hashed_index, save_hashed_index
from .linear_grid import LinearModel
from .models import INPUTS, BoostedTrees, Candidate, CutTree, FittedModel
from .transform import FittedStep, apply_steps, invert_target, load_steps, save_steps
from .validate import CategoricalInput, Manifest, NumericInput, accept, describe_inputs, judge, quarantine, some_value, typed_input

RAW_PREDICTION = "_raw_prediction"


@dataclass
class Scorer:
    """A published model: input manifest, fitted steps and the model behind them."""

    name: str
    schema: RoleSchema
    manifest: Manifest
    steps: list[FittedStep]
    model: FittedModel
    description: str = ""

    @property
    def output(self) -> str:
        return self.schema.target.lower()

    def predict(self, df: DataFrame, output: str | None = None) -> DataFrame:
        """Add the prediction on the scale of the raw target; inputs keep their raw values."""
        raw = {c: f"_in_{c}" for c in self.manifest.names}
        kept = df.select("*", *[F.col(c).alias(raw[c]) for c in raw])
        scored = self.model.transform(apply_steps(kept, self.steps, only="features"))
        value = invert_target(F.col(self.model.prediction), self.steps)
        out = scored.withColumn(output or self.output, value)
        columns = [F.col(raw[c]).alias(c) if c in raw else F.col(c) for c in df.columns]
        return out.select(*columns, output or self.output)


def score(df: DataFrame, scorer: Scorer, keep=()) -> DataFrame:
    """Validate, keep the accepted rows, transform, predict, invert: one plan, no shuffle for MLlib models."""
    accepted = accept(df, scorer.manifest, keep)
    return scorer.predict(accepted).select(*keep, scorer.output)


def score_and_quarantine(df: DataFrame, scorer: Scorer, keep=()) -> tuple[DataFrame, DataFrame]:
    return score(df, scorer, keep), quarantine(df, scorer.manifest)


def score_many(df: DataFrame, scorers: list[Scorer], keep=()) -> DataFrame:
    """Every model on the rows that its manifest accepts, told apart by `model_name`: (*keep, output, model_name).

    The rows are read once and judged once per different manifest; the predictions of a row are an array that is exploded.
    Only nearest neighbours, which shuffle the rows anyway, are asked one by one.
    """
    outputs = {s.output for s in scorers}
    if len(outputs) != 1:
        raise ValueError(f"the models predict different columns: {sorted(outputs)}")
    apart = [s for s in scorers if isinstance(s.model.model, Predicting)]
    parts = [score(df, s, keep).withColumn("model_name", F.lit(s.name)) for s in apart]
    together = [s for s in scorers if not isinstance(s.model.model, Predicting)]
    if together:
        parts.insert(0, _score_together(df, together, keep, outputs.pop()))
    return reduce(DataFrame.unionByName, parts)


def _score_together(df: DataFrame, scorers: list[Scorer], keep, output: str) -> DataFrame:
    manifests: list[Manifest] = []
    for s in scorers:
        if s.manifest not in manifests:
            manifests.append(s.manifest)
    judged, accepted = judge(df, manifests)
    columns = judged.columns
    number = {n: f"_own_{i}" for i, n in enumerate(columns)}
    # the rows as they came, under names that no step or model uses
    rows = judged.where(reduce(lambda a, b: a | b, map(F.col, accepted))).select(*[F.col(c).alias(number[c]) for c in columns])
    found = []
    for j, s in enumerate(scorers):
        ok = F.col(number[accepted[manifests.index(s.manifest)]])
        # rows that this model does not accept get inputs that it does, since its steps may raise on others
        typed = {i.name: typed_input(F.col(number[i.name]), i, dict(df.dtypes)[i.name]) for i in s.manifest.inputs}
        inputs = [F.when(ok, typed[i.name]).otherwise(F.lit(some_value(i))).alias(i.name) for i in s.manifest.inputs]
        kept = rows.columns
        rows = s.predict(rows.select("*", *inputs), f"_value_{j}").select(*kept, f"_value_{j}")
        own = [typed.get(c, F.col(number[c]) if c in number else F.col(c)).alias(c) for c in keep]
        found.append(F.when(ok, F.struct(*own, F.col(f"_value_{j}").alias(output), F.lit(s.name).alias("model_name"))))
    predictions = F.filter(F.array(*found), lambda p: p.isNotNull())
    return rows.select(F.explode(predictions).alias("p")).select(*[F.col(f"p.`{c}`").alias(c) for c in (*keep, output, "model_name")])


def score_by_name(df: DataFrame, scorers: dict[str, Scorer], name: str, keep=()) -> DataFrame:
    if name not in scorers:
        raise ValueError(f"model {name} not found")
    return score(df, scorers[name], keep)


def model_inputs(spark: SparkSession, scorers: list[Scorer]) -> DataFrame:
    """(model_name, description, name, type, min, max, available_values): what each model expects.

    Domains kept as tables are listed whole too, by an aggregate: their values do not pass through the driver.
    """
    rows = [
        (s.name, s.description, i["name"], i["type"], i["min"], i["max"], i["available_values"])
        for s in scorers
        for i in describe_inputs(s.manifest)
        if i["type"] == "numerical" or i["available_values"] is not None
    ]
    known = spark.createDataFrame(
        rows,
        "model_name string, description string, name string, type string, min double, max double, "
        "available_values array<string>",
    )
    none = F.lit(None).cast("double")
    wide = [
        i.table.agg(F.sort_array(F.collect_set("value")).alias("available_values")).select(
            F.lit(s.name).alias("model_name"), F.lit(s.description).alias("description"), F.lit(i.name).alias("name"),
            F.lit("categorical").alias("type"), none.alias("min"), none.alias("max"), "available_values",
        )
        for s in scorers
        for i in s.manifest.inputs
        if isinstance(i, CategoricalInput) and i.table is not None
    ]
    return reduce(DataFrame.unionByName, wide, known)


def post_test(
    raw: DataFrame, scorer: Scorer, clean_steps: list[dict], n_samples: int, metrics, seed: int = 42
) -> DataFrame:
    """Random raw rows, cleaned, scored and compared with their raw target: one row of metrics."""
    sample = random_rows(raw, scorer.schema.primary_id, n_samples, seed)
    cleaned = clean(sample, scorer.schema, clean_steps)
    scored = scorer.predict(cleaned, RAW_PREDICTION)
    return errors(scored, scorer.schema.target, F.col(RAW_PREDICTION), metrics)


def save_scorer(scorer: Scorer, path: str) -> None:
    """Parameter tables, train rows of neighbours and MLlib persistence; nothing is pickled. Categorical tables go next to it."""
    spark = SparkSession.active()
    save_steps(spark, scorer.steps, f"{path}/steps")
    model = scorer.model.model
    boosted = model if isinstance(model, BoostedTrees) else None
    cut = model if isinstance(model, CutTree) else None
    index = None
    if isinstance(model, Predicting):
        save = save_hashed_index if isinstance(model, HashedIndex) else save_index
        index = save(model, f"{path}/neighbours")
    elif not isinstance(model, LinearModel):
        assembler = VectorAssembler(inputCols=scorer.model.features, outputCol=INPUTS, handleInvalid="error")
        PipelineModel([assembler, *(boosted.trees if boosted else [cut.tree if cut else model])]).write().overwrite().save(f"{path}/model")
    inputs = describe_inputs(scorer.manifest)
    for i in scorer.manifest.inputs:
        if isinstance(i, CategoricalInput) and i.table is not None:
            i.table.write.mode("overwrite").parquet(f"{path}/values/{i.name}")
    card = {
        "name": scorer.name,
        "description": scorer.description,
        "schema": scorer.schema.name,
        "inputs": inputs,
        "features": scorer.model.features,
        "prediction": scorer.model.prediction,
        "model_id": scorer.model.candidate.model_id,
        "model_type": scorer.model.candidate.model_type,
        "hyperparameters": scorer.model.candidate.hyperparameters,
        "boosting": [boosted.start, boosted.rate] if boosted else None,
        "cut": [cut.values, cut.numNodes] if cut else None,
        "neighbours": index,
        "linear": [model.coefficients, model.intercept] if isinstance(model, LinearModel) else None,
    }
    spark.createDataFrame([(json.dumps(card),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/card")


def load_scorer(spark: SparkSession, path: str) -> Scorer:
    card = json.loads(spark.read.text(f"{path}/card").first()["value"])
    inputs = []
    for i in card["inputs"]:
        if i["type"] == "numerical":
            inputs.append(NumericInput(i["name"], i["min"], i["max"]))
        elif i["available_values"] is not None:
            inputs.append(CategoricalInput(i["name"], values=tuple(i["available_values"])))
        else:
            inputs.append(CategoricalInput(i["name"], table=spark.read.parquet(f"{path}/values/{i['name']}")))
    candidate = Candidate(card["model_id"], card["model_type"], card["hyperparameters"])
    if card.get("neighbours"):
        load = load_hashed_index if "hashes" in card["neighbours"] else load_index
        model = load(spark, f"{path}/neighbours", card["neighbours"])
    elif card.get("linear"):
        model = LinearModel(*card["linear"], INPUTS, card["prediction"])
    else:
        stages = PipelineModel.load(f"{path}/model").stages[1:]
        boosting = card.get("boosting")
        model = BoostedTrees(*boosting, stages, card["prediction"]) if boosting else stages[-1]
        if card.get("cut"):
            model = CutTree(model, *card["cut"], card["prediction"])
    return Scorer(
        card["name"],
        schema_named(card["schema"]),
        Manifest(tuple(inputs)),
        load_steps(spark, f"{path}/steps"),
        FittedModel(candidate, card["features"], card["prediction"], model),
        card["description"],
    )
