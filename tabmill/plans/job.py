"""The declared job: load, clean, transform, train, post-test, with everything noted in the run log."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.selection import first_rows
from ..operators.clean import clean
from ..operators.models import GridResult, train_grid
from ..operators.runlog import (
    DEPLOYMENT,
    intents,
    latest,
    nominate,
    previously_published,
    published_candidates,
    tagged_best,
)
from ..operators.score import Scorer, load_scorer, post_test, save_scorer
from ..operators.split import split, stage_sizes
from ..operators.transform import FittedStep, apply_steps, fit, save_steps, transformed_features
from ..operators.validate import CategoricalInput, Manifest, build_manifest, describe_inputs
from ..schema import RoleSchema, schema_named
from ..sources.runlog_store import Recorder, create, read
from ..sources.tables import audited, read_csv, stored_splits
from ..sources.workspace import materialize

MODEL = "model"  # type of the log's entries about saved models
STEP_TYPES = ("data_io", "data_cleaner", "data_transformer", "model_trainer", "post_test")


@dataclass
class Prepared:
    """The split rows, and the same rows transformed, with the steps that made them."""

    parts: DataFrame
    rows: DataFrame
    schema: RoleSchema
    steps: list[FittedStep]
    features: list[str]
    label: str


def step_of(config: dict, kind: str) -> dict | None:
    return next((s for s in config["instructions"] if s["type"] == kind), None)


def check_config(config: dict) -> None:
    kinds = [s["type"] for s in config["instructions"]]
    unknown = [k for k in kinds if k not in STEP_TYPES]
    if unknown:
        raise ValueError(f"unknown job steps {unknown}")
    if kinds != [k for k in STEP_TYPES if k in kinds] or "data_io" not in kinds:
        raise ValueError(f"job steps must follow {STEP_TYPES} and begin with data_io, not {kinds}")


def reference(config: dict) -> RoleSchema:
    return schema_named(step_of(config, "data_io")["properties"]["reference"])


def load(spark: SparkSession, config: dict, table: DataFrame | None = None) -> DataFrame:
    """The declared table (a CSV path, or a table handed in), cut to the declared number of rows."""
    spec, schema = step_of(config, "data_io"), reference(config)
    if table is None:
        where = spec["properties"]
        table = read_csv(spark, f"{where['path']}/{where['file']}.csv", schema)
    for call in spec.get("call", []):
        if call["type"] != "load":
            raise ValueError(f"unknown load step {call['type']!r}")
        if call.get("n_rows") is not None:
            table = first_rows(table, schema.primary_id, call["n_rows"])
    return table


def cleaned(df: DataFrame, config: dict) -> DataFrame:
    spec, schema = step_of(config, "data_cleaner"), reference(config)
    return clean(df, schema, spec.get("call", []) if spec else [], carry_id=True)


class Stopwatch:
    """Notes times in the log. Stages fuse into one plan, which has one time; `apart` writes every stage as a table, so
    that it has its own."""

    def __init__(self, log: Recorder, run_id: str, apart: bool):
        self.log, self.run_id, self.apart = log, run_id, apart

    def note(self, key: str, seconds: float) -> None:
        self.log.metric(self.run_id, f"time_ms.{key}", seconds * 1000)

    def stage(self, df: DataFrame, key: str) -> DataFrame:
        if not self.apart:
            return df
        since = time.time()
        out = materialize(df, key)
        self.note(key, time.time() - since)
        return out


def prepare(
    df: DataFrame, config: dict, fit_mode: str = "chained", exact: bool = False, watch: Stopwatch | None = None
) -> Prepared:
    """Split the cleaned rows, fit on train, transform all.

    The split rows are written once: manifest, fit, sizes and training all read them. A `watch` that takes stages apart
    has each declared transformation written on its own.
    """
    spec, schema = step_of(config, "data_transformer"), reference(config)
    if exact:
        df = materialize(df, "cleaned")
    parts = stored_splits(split(df, schema, exact=exact))
    steps = fit(parts, spec.get("call", []) if spec else [], schema, fit_mode)
    if watch and watch.apart:
        rows = parts
        for _, group in groupby(steps, lambda s: s.step.ordinal):
            group = list(group)
            rows = watch.stage(apply_steps(rows, group), f"transforming.{group[0].step.name}")
    else:
        rows = apply_steps(parts, steps)
    return Prepared(parts, rows, schema, steps, transformed_features(schema, df.columns, steps), schema.label)


@dataclass
class JobResult:
    run_id: str
    prepared: Prepared | None
    grid: GridResult | None
    scorer: Scorer | None
    metrics: DataFrame | None
    post_tests: list[dict]


def run_scenario(
    spark: SparkSession,
    config: dict,
    log_path: str | None = None,
    table: DataFrame | None = None,
    fit_mode: str = "chained",
    exact: bool = False,
    unsupported: str = "raise",
    timers: str = "job",
) -> JobResult:
    """Run a declared job. With `log_path`, its run, sizes, timings, metrics and status are appended there.

    `unsupported` tells what happens to candidates with options that MLlib cannot express: raise or skip. `timers` are of
    the "job" as it runs best, where loading, cleaning and transforming are one plan, or of its "stages", which are then
    run one by one: loading, cleaning, transforming.{name} per declared transformation, validation.{stage}.
    """
    if timers not in ("job", "stages"):
        raise ValueError(f"timers are of the job or of its stages, not {timers!r}")
    check_config(config)
    started = time.time()
    schema = reference(config)
    experiment = config.get("repository", {}).get("experiment_id", "default")
    log = Recorder(experiment)
    run_id = log.run(uuid.uuid4().hex[:6].upper())
    if log_path and not _known(spark, log_path, experiment):
        log.experiment(config.get("repository", {}).get("experiment_name", experiment))
    log.prop(run_id, "name.intent", config["name"])
    log.prop(run_id, "name.description", config.get("description", ""))

    watch = Stopwatch(log, run_id, timers == "stages")

    def timed(key: str, since: float) -> None:
        watch.note(key, time.time() - since)

    raw = load(spark, config, table)
    seen, loaded = audited(raw, f"load-{run_id}")
    seen = watch.stage(seen, "loading")
    log.prop(run_id, "size.load.column", len(raw.columns))
    log.prop(run_id, "name.dataset", step_of(config, "data_io")["properties"].get("file", ""))

    rows = watch.stage(cleaned(seen, config), "cleaning")
    chosen = [c for c in rows.columns if c != schema.primary_id]
    prepared = grid = scorer = None
    post_tests: list[dict] = []
    since = time.time()
    if step_of(config, "data_transformer"):
        prepared = prepare(rows, config, fit_mode, exact, watch)
        timed("transforming.all", since)
        manifest = build_manifest(prepared.parts.select(*chosen), schema)
        sizes = {r["stage"]: r["n_rows"] for r in stage_sizes(prepared.parts).collect()}
        for stage, n in sizes.items():
            log.prop(run_id, f"size.split.{stage}.row", n)
            log.prop(run_id, f"size.split.{stage}.column", len(prepared.features))
        cleaned_rows = sum(sizes.values())
    else:
        cleaned_rows = (rows if watch.apart else materialize(rows, "cleaned")).count()
        if not watch.apart:
            timed("cleaning", since)
    # reading and cleaning ran within the first action above
    log.prop(run_id, "size.load.row", loaded.get["rows"])
    log.prop(run_id, "size.clean.row", cleaned_rows)
    log.prop(run_id, "size.clean.column", len(chosen))
    if prepared:
        if log_path:
            stored = f"{log_path}/steps/{run_id}"
            save_steps(spark, prepared.steps, stored)
            log.obj(run_id, "transformation.steps", stored)
            log.obj(run_id, "transformation.allowed_columns", _manifest_text(manifest, f"{log_path}/values/{run_id}"))
    trainer = step_of(config, "model_trainer")
    if trainer and prepared:
        since = time.time()
        options = trainer["properties"]
        grid = train_grid(
            prepared.rows,
            prepared.features,
            prepared.label,
            schema.primary_id,
            trainer["call"],
            options["metrics"],
            options["primary_metric"],
            options.get("parameter_grid", {}).get("type", "exhaustive"),
            options.get("objective", "best_model"),
            options.get("unsupported", unsupported),
            timer=watch.note if watch.apart else None,
        )
        for model_id, reason in grid.skipped.items():
            log.prop(run_id, f"skipped.{model_id}", reason)
        timed("train", since)
        scorer = Scorer(run_id, schema, manifest, prepared.steps, grid.best, config["name"])
        _log_models(log, run_id, grid)
        if log_path:
            saved = f"{log_path}/models/{run_id}"
            save_scorer(scorer, saved)
            log.obj(run_id, MODEL, saved)
        _log_nomination(spark, log, log_path, run_id, config["name"], grid, options["primary_metric"])
    post = step_of(config, "post_test")
    if post and scorer:
        source = load(spark, {"instructions": [{**step_of(config, "data_io"), "call": []}]}, table)
        for call in post["call"]:
            n = call.get("n_samples", 1000)
            since = time.time()
            result = post_test(
                source,
                scorer,
                step_of(config, "data_cleaner")["call"],
                n,
                call.get("metrics", ["mse", "rmse"]),
                call.get("seed", 42),
            ).first()
            timed("validation.post_test", since)
            log.prop(run_id, "size.post_test.row", n)
            log.prop(run_id, "name.post_test.intent", call.get("intent", ""))
            for metric in call.get("metrics", ["mse", "rmse"]):
                log.metric(run_id, f"validation.post_test.{metric}", result[metric])
            post_tests.append(result.asDict())
    log.metric(run_id, "time_ms.all", (time.time() - started) * 1000)
    if log_path:
        log.flush(spark, log_path)
    return JobResult(run_id, prepared, grid, scorer, grid.metrics if grid else None, post_tests)


def load_published(spark: SparkSession, log_path: str, experiment: str) -> dict[str, Scorer]:
    """Scorers by run id of all runs of an experiment that are published now, as their jobs saved them."""
    runs, tags, objects = (read(spark, log_path, t) for t in ("runs", "tags", "objects"))
    chosen = published_candidates(runs, tags).where(F.col("experiment_id") == experiment)
    paths = latest(objects.where(F.col("type") == MODEL), by=("run_id",), value="url").withColumnRenamed("run_id", "id")
    return {r["id"]: load_scorer(spark, r["url"]) for r in chosen.join(paths, "id").collect()}


def _manifest_text(manifest: Manifest, folder: str) -> str:
    """The manifest as JSON. A domain kept as a table is written below `folder`, and its path stands for the list."""
    inputs = describe_inputs(manifest)
    for i, described in zip(manifest.inputs, inputs):
        if isinstance(i, CategoricalInput) and i.table is not None:
            described["values_path"] = f"{folder}/{i.name}"
            i.table.write.mode("overwrite").parquet(described["values_path"])
    return json.dumps([{k: v for k, v in i.items() if v is not None} for i in inputs])


def _known(spark: SparkSession, log_path: str, experiment: str) -> bool:
    create(spark, log_path)
    return not read(spark, log_path, "experiments").where(F.col("id") == experiment).isEmpty()


def _log_models(log: Recorder, run_id: str, grid: GridResult) -> None:
    children = {}
    for model_id, m in grid.models.items():
        children[model_id] = log.run(model_id, parent_id=run_id)
        log.prop(children[model_id], "name.model", m.candidate.model_type)
        for k, v in m.candidate.hyperparameters.items():
            log.prop(children[model_id], f"property.{k}", v)
    for r in grid.metrics.collect():
        log.metric(children[r["model_id"]], f"validation.{r['stage']}.{r['metric']}", r["value"])
    log.tag(children[grid.best.candidate.model_id], "level", "best")


def _log_nomination(spark, log: Recorder, log_path, run_id: str, intent: str, grid: GridResult, primary: str) -> None:
    score = grid.metrics.where((F.col("stage") == "test") & (F.col("metric") == primary)).first()["value"]
    before = None
    if log_path:
        create(spark, log_path)
        tables = {t: read(spark, log_path, t) for t in ("runs", "tags", "properties", "metrics")}
        before = (
            previously_published(tables["runs"], tables["tags"], tables["properties"], tables["metrics"], primary)
            .where((F.col("experiment_id") == log.experiment_id) & (F.col("intent") == intent))
            .first()
        )
    status, old_status = nominate(score, before["value"] if before else None)
    if old_status:
        log.tag(before["id"], DEPLOYMENT, old_status)
    log.tag(run_id, DEPLOYMENT, status)


def run_sweep(spark: SparkSession, configs: list[dict], log_path: str, table: DataFrame | None = None, **options) -> DataFrame:
    """Run several jobs into one log and compare them: (intent, run, model, valid and test metric, status)."""
    for config in configs:
        run_scenario(spark, config, log_path, table, **options)
    return compare_runs(spark, log_path)


def compare_runs(spark: SparkSession, log_path: str) -> DataFrame:
    """Best model of each run with its metrics, from the log alone."""
    runs, tags = read(spark, log_path, "runs"), read(spark, log_path, "tags")
    best = tagged_best(runs, tags)
    metrics = latest(read(spark, log_path, "metrics").where(F.col("key").startswith("validation.")))
    names = intents(read(spark, log_path, "properties")).withColumnRenamed("value", "intent")
    return (
        best.join(metrics.withColumnRenamed("run_id", "id"), "id")
        .join(names.withColumnRenamed("run_id", "parent_id"), "parent_id")
        .select("intent", F.col("name").alias("model"), "key", "value")
    )
