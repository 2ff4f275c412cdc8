"""Regression models on MLlib, plus the exact nearest-neighbour search, and the grid over them."""

from __future__ import annotations

import itertools
import math
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import dealt_out, rows_of_tasks
from ..sources.workspace import in_parts, materialize
from .evaluate import best_model, known_metrics, metrics_by_stage
from .knn import Predicting, build_index
from .knn_hashed import build_hashed_index
from .linear_grid import MAX_INPUTS, LinearModel, moments, solve_all

INPUTS = "model_inputs"
DEEPEST = 30  # levels of a tree, and how many it may have if nothing is said
KEEP_ROUNDS = 8  # boosting rounds between two writes of the residuals
HELD_VALUES = 16_000_000  # inputs of all rows that executors hold for a fit; more are read from the shared folder
TASK_VALUES = 8_000_000  # and of a task's rows then, each with ten more: Spark ML holds them as objects

# Model types and option names of the job files.
MODEL_TYPES = (
    "random_forest_regressor",
    "linear_regression",
    "decision_tree_regressor",
    "gradient_boosting_regressor",
    "elastic_net",
    "lasso",
    "k_nearest_neighbors_regressor",
)


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    """Add the input vector; a missing value raises."""
    return VectorAssembler(inputCols=features, outputCol=INPUTS, handleInvalid="error").transform(df)


def n_inputs(df: DataFrame) -> int:
    """Width of the input vector, from the column's metadata."""
    attributes = df.schema[INPUTS].metadata.get("ml_attr", {})
    return attributes["num_attrs"] if "num_attrs" in attributes else len(df.select(INPUTS).first()[0])


def expand_grid(hyperparameters: dict) -> list[dict]:
    """Every combination of the listed values, the last name (alphabetically) varying fastest."""
    names = sorted(hyperparameters)
    return [dict(zip(names, values)) for values in itertools.product(*[hyperparameters[n] for n in names])]


@dataclass(frozen=True)
class Candidate:
    model_id: str
    model_type: str
    hyperparameters: dict = field(default_factory=dict)


def candidates(calls: list[dict], grid_type: str = "exhaustive") -> list[Candidate]:
    if grid_type != "exhaustive":
        raise ValueError(f"parameter grid {grid_type!r} is not available")
    out = []
    for call in calls:
        if call["model_type"] not in MODEL_TYPES:
            raise ValueError(f"model type {call['model_type']!r} is not supported")
        for hp in expand_grid(call.get("hyperparameters", {})):
            out.append(Candidate(f"m{len(out):03d}-{call['model_type']}", call["model_type"], hp))
    return out


class Unsupported(ValueError):
    """A hyper-parameter value that MLlib cannot express."""


def _take(hp: dict, allowed: dict) -> dict:
    """Hyper-parameters by their MLlib names; anything without a twin raises."""
    unknown = sorted(set(hp) - set(allowed))
    if unknown:
        raise Unsupported(f"hyper-parameters without a counterpart: {unknown}")
    return {allowed[k]: v for k, v in hp.items() if allowed[k] is not None and v is not None}


def _tree_options(hp: dict, single: bool = False) -> dict:
    """Checks the options MLlib trees cannot express instead of ignoring them."""
    hp = dict(hp)
    criterion = hp.pop("criterion", "squared_error")
    # with one output both rank splits by the reduction of variance
    if criterion not in ("squared_error", "friedman_mse"):
        raise Unsupported(f"criterion {criterion!r} is not available, trees minimise the variance")
    smallest = hp.pop("min_samples_split", 2)
    leaf = hp.get("min_samples_leaf", 1)
    if smallest > 2 * leaf and not single:
        raise Unsupported(f"min_samples_split={smallest} above twice min_samples_leaf={leaf} is for single trees only")
    hp.setdefault("max_depth", DEEPEST)
    if hp["max_depth"] is None or hp["max_depth"] > DEEPEST:
        raise Unsupported(f"max_depth={hp['max_depth']} is not available, trees have at most {DEEPEST} levels")
    return hp


def estimator(candidate: Candidate, label: str, prediction: str, n_inputs: int, label_std: float = 1.0):
    """MLlib estimator of a candidate. `label_std` is the population std of the train label."""
    hp = candidate.hyperparameters
    common = {"featuresCol": INPUTS, "labelCol": label, "predictionCol": prediction}
    kind = candidate.model_type
    if kind in ("linear_regression", "elastic_net", "lasso"):
        # the normal equations take up to 4096 inputs; `solver` is the way beyond, chosen by the caller
        linear = dict(common, standardization=False, tol=1e-12, maxIter=1000, solver="normal")
        shared = {"fit_intercept": "fitIntercept", "solver": "solver", "max_iter": "maxIter"}
        if kind == "linear_regression":
            return LinearRegression(**{"regParam": 0.0, **linear, **_take(hp, shared)})
        # coordinate choice is not random here, so a seed changes nothing and is only allowed
        options = _take(hp, {"alpha": None, "l1_ratio": None, "random_state": None, **shared})
        alpha = hp.get("alpha", 1.0)
        ratio = 1.0 if kind == "lasso" else hp.get("l1_ratio", 0.5)
        # MLlib divides the ridge part by the label's std; undo that to meet the usual objective
        # 1/(2n) |y - Xw|^2 + alpha * ratio * |w|_1 + alpha * (1 - ratio) / 2 * |w|^2
        lasso_part, ridge_part = alpha * ratio, alpha * (1 - ratio) * label_std
        reg = lasso_part + ridge_part
        return LinearRegression(**{"regParam": reg, "elasticNetParam": lasso_part / reg if reg else 0.0, **linear, **options})
    if kind == "decision_tree_regressor":
        options = _take(
            _tree_options(hp, single=True),
            {"max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode", "random_state": "seed", "max_bins": "maxBins"},
        )
        return DecisionTreeRegressor(**common, **options)
    if kind == "random_forest_regressor":
        options = _take(
            _tree_options(hp),
            {
                "n_estimators": "numTrees",
                "bootstrap": "bootstrap",
                "max_depth": "maxDepth",
                "min_samples_leaf": "minInstancesPerNode",
                "random_state": "seed",
                "max_bins": "maxBins",
            },
        )
        options.setdefault("numTrees", 100)
        return RandomForestRegressor(featureSubsetStrategy="all", **common, **options)
    if kind == "gradient_boosting_regressor":
        defaults = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}
        options = _take(
            _tree_options({**defaults, **hp}),
            {
                "n_estimators": "maxIter",
                "learning_rate": "stepSize",
                "max_depth": "maxDepth",
                "min_samples_leaf": "minInstancesPerNode",
                "subsample": "subsamplingRate",
                "random_state": "seed",
                "max_bins": "maxBins",
            },
        )
        return Boosting(common, **options)
    raise ValueError(f"{kind} is not an MLlib estimator")


def node_spans(tree: DecisionTreeRegressionModel) -> list[tuple[int, int]]:
    """First and last leaf of every node, a node before those below it, from the printed tree.

    Leaves are numbered in the order of print, as the model's `leafCol` numbers them.
    """
    lines = [line.split(None, 1)[0] for line in tree.toDebugString.splitlines()[1:] if line.strip()]
    spans, above, leaf = [], [], 0
    for word in lines:
        if word == "If":
            above.append([len(spans), 2])
            spans.append((leaf, leaf))
        elif word == "Predict:":
            spans.append((leaf, leaf))
            # a node ends with the last leaf of its second branch
            while above:
                above[-1][1] -= 1
                if above[-1][1]:
                    break
                node, _ = above.pop()
                spans[node] = (spans[node][0], leaf)
            leaf += 1
    return spans


@dataclass
class CutTree:
    """A tree whose leaves predict what the node predicts that they were cut to."""

    tree: DecisionTreeRegressionModel
    values: list[float]  # by leaf of the tree
    numNodes: int
    prediction: str

    def transform(self, df: DataFrame) -> DataFrame:
        leaf, plain = f"_{self.prediction}_leaf", f"_{self.prediction}_whole"
        found = self.tree.copy().setLeafCol(leaf).setPredictionCol(plain).transform(df)
        return found.withColumn(self.prediction, F.lit(self.values)[F.col(f"`{leaf}`").cast("int")]).drop(leaf, plain)


def cut_small_nodes(tree: DecisionTreeRegressionModel, rows: DataFrame, label: str, smallest: int) -> CutTree:
    """Turn every node with fewer train rows into a leaf: the tree that `min_samples_split` would have grown.

    A split does not depend on the splits below it, so cutting afterwards gives the same tree. One aggregate over the
    train rows tells rows and sum of labels of each leaf, and so of each node.
    """
    leaf, plain = "_leaf", "_whole"
    placed = tree.copy().setLeafCol(leaf).setPredictionCol(plain).transform(rows)
    seen = {int(r[leaf]): (r["n"], r["s"]) for r in placed.groupBy(leaf).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("s")).collect()}
    spans = node_spans(tree)
    n_leaves = spans[0][1] + 1
    counts = [0, *itertools.accumulate(seen[i][0] if i in seen else 0 for i in range(n_leaves))]
    values = [0.0] * n_leaves
    done = nodes = 0  # leaves that have their value; nodes come before those below them
    for first, last in spans:
        nodes += first >= done
        n = counts[last + 1] - counts[first]
        if first >= done and (n < smallest or first == last):
            mean = (math.fsum(seen[i][1] for i in range(first, last + 1) if i in seen) / n) if n else 0.0
            values[first : last + 1] = [mean] * (last + 1 - first)
            done = last + 1
    return CutTree(tree, values, nodes, tree.getPredictionCol())


@dataclass
class BoostedTrees:
    """The train mean plus a share of each tree of residuals."""

    start: float
    rate: float
    trees: list[DecisionTreeRegressionModel]
    prediction: str

    def transform(self, df: DataFrame) -> DataFrame:
        names = [f"_{self.prediction}_{i}" for i in range(len(self.trees))]
        out = df
        for name, tree in zip(names, self.trees):
            out = tree.setPredictionCol(name).transform(out)
        total = F.lit(self.start)
        for name in names:
            total = total + self.rate * F.col(f"`{name}`")
        return out.withColumn(self.prediction, total).drop(*names)


def _held(vectors: DataFrame, n: int) -> bool:
    """Whether executors hold this many rows of vectors from one pass to the next."""
    return n == 0 or n * n_inputs(vectors) <= HELD_VALUES


def _written(vectors: DataFrame, name: str, n: int) -> DataFrame:
    """Rows of vectors that are too many to be held, read from the shared folder by tasks of bounded size."""
    return in_parts(vectors, name, n, max(1, TASK_VALUES // (n_inputs(vectors) + 10)))


@dataclass
class Boosting:
    """Least-squares boosting: starts from the mean and fits each tree to what is left of the label.

    The residuals are a column that is kept for the round that reads it several times, and written to the shared folder
    every few rounds, so that neither plans nor lost executors make all the rounds before run again. Those of more than
    HELD_VALUES inputs are not kept: a pass takes the trees since the last write off again, and holds a batch at a time.
    """

    columns: dict
    maxIter: int = 100
    stepSize: float = 0.1
    subsamplingRate: float = 1.0
    seed: int = 0
    maxDepth: int = 3
    minInstancesPerNode: int = 1
    maxBins: int = 32

    def fit(self, rows: DataFrame) -> BoostedTrees:
        label, inputs = self.columns["labelCol"], self.columns["featuresCol"]
        start, n = rows.agg(F.avg(label), F.count(F.lit(1))).first()
        held = _held(rows, n)
        left = rows.select(inputs, (F.col(label) - F.lit(start)).alias("_left"))
        trees: list[DecisionTreeRegressionModel] = []
        for i in range(self.maxIter):
            tree = DecisionTreeRegressor(
                featuresCol=inputs, labelCol="_left", predictionCol="_step", maxDepth=self.maxDepth, maxBins=self.maxBins,
                minInstancesPerNode=self.minInstancesPerNode, seed=self.seed + i,
            )
            seen = left if self.subsamplingRate >= 1 else left.sample(self.subsamplingRate, self.seed + i)
            trees.append(tree.fit(seen))
            if i + 1 < self.maxIter:
                before = left
                left = trees[-1].transform(left).select(inputs, (F.col("_left") - self.stepSize * F.col("_step")).alias("_left"))
                if (i + 1) % KEEP_ROUNDS == 0:
                    left = materialize(left, "residuals") if held else _written(left, "residuals", n)
                elif held:
                    left = left.persist(StorageLevel.MEMORY_AND_DISK)
                    left.count()
                before.unpersist()
        left.unpersist()
        return BoostedTrees(start, self.stepSize, trees, self.columns["predictionCol"])


def _fit_mllib(candidate: Candidate, chosen, rows: DataFrame):
    model = chosen.fit(rows)
    hp = candidate.hyperparameters
    if candidate.model_type == "decision_tree_regressor" and hp.get("min_samples_split", 2) > 2 * hp.get("min_samples_leaf", 1):
        return cut_small_nodes(model, rows, chosen.getLabelCol(), hp["min_samples_split"])
    return model


def knn_setting(candidate: Candidate) -> tuple[int, str, int]:
    """(k, weights, p); `algorithm` only chooses an index. All find the same neighbours but for `hashed`, which is approximate."""
    hp = dict(candidate.hyperparameters)
    hp.pop("algorithm", None)
    unknown = sorted(set(hp) - {"n_neighbors", "weights", "p"})
    if unknown:
        raise Unsupported(f"hyper-parameters without a counterpart: {unknown}")
    return hp.get("n_neighbors", 5), hp.get("weights", "uniform"), hp.get("p", 2)


def knn_builder(candidate: Candidate):
    return build_hashed_index if candidate.hyperparameters.get("algorithm") == "hashed" else build_index


@dataclass
class FittedModel:
    """A fitted candidate that adds a prediction column to a table with the feature columns."""

    candidate: Candidate
    features: list[str]
    prediction: str
    model: object

    def transform(self, df: DataFrame) -> DataFrame:
        if isinstance(self.model, Predicting):
            k, weights, _ = knn_setting(self.candidate)
            return self.model.predict(df, {self.prediction: (k, weights)})
        return self.model.transform(assemble(df, self.features)).drop(INPUTS)


def fit_one(candidate: Candidate, train: DataFrame, features: list[str], label: str, key: str, prediction: str = "prediction") -> FittedModel:
    """Fit a single candidate on the given rows."""
    if candidate.model_type == "k_nearest_neighbors_regressor":
        k, _, p = knn_setting(candidate)
        return FittedModel(candidate, features, prediction, knn_builder(candidate)(train, features, label, key, k, p))
    std = 1.0
    if candidate.model_type == "elastic_net":
        std = train.agg(F.stddev_pop(label)).first()[0] or 1.0
    vectors = assemble(train, features).select(label, INPUTS)
    chosen = estimator(candidate, label, prediction, n_inputs(vectors), std)
    if isinstance(chosen, LinearRegression) and chosen.getSolver() == "normal":
        # a single pass, nothing to keep
        return FittedModel(candidate, features, prediction, _fit_mllib(candidate, chosen, vectors))
    rows = rows_of_tasks(vectors)
    vectors = dealt_out(vectors, rows)
    if not _held(vectors, rows[1]):
        # kept by executors in large partitions, vectors and what Spark ML makes of them fill the heap
        return FittedModel(candidate, features, prediction, _fit_mllib(candidate, chosen, _written(vectors, "vectors", rows[1])))
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return FittedModel(candidate, features, prediction, _fit_mllib(candidate, chosen, vectors))
    finally:
        vectors.unpersist()


@dataclass
class GridResult:
    models: dict[str, FittedModel]
    metrics: DataFrame  # (model_id, stage, metric, value): train and valid of all, test of the best
    best: FittedModel
    skipped: dict[str, str] = field(default_factory=dict)  # model_id -> why it was not fitted


def shared_settings(candidate: Candidate) -> tuple[float, float, bool] | None:
    """(alpha, l1_ratio, fit_intercept) of a linear candidate that no option ties to an MLlib solver."""
    hp = candidate.hyperparameters
    if candidate.model_type not in ("linear_regression", "elastic_net", "lasso") or {"solver", "max_iter"} & set(hp):
        return None
    intercept = hp.get("fit_intercept", True)
    if candidate.model_type == "linear_regression":
        return 0.0, 0.0, intercept
    return hp.get("alpha", 1.0), 1.0 if candidate.model_type == "lasso" else hp.get("l1_ratio", 0.5), intercept


def _possible(todo: list[Candidate], label: str, unsupported: str) -> tuple[list[Candidate], dict[str, str]]:
    """Candidates that can be fitted, and the reasons for the others."""
    if unsupported not in ("raise", "skip"):
        raise ValueError(f"unsupported candidates can be raised or skipped, not {unsupported!r}")
    good, skipped = [], {}
    for c in todo:
        try:
            if c.model_type == "k_nearest_neighbors_regressor":
                knn_setting(c)
            else:
                estimator(c, label, c.model_id, 1)
            good.append(c)
        except Unsupported as e:
            if unsupported == "raise":
                raise
            skipped[c.model_id] = str(e)
    return good, skipped


def train_grid(
    df: DataFrame,
    features: list[str],
    label: str,
    key: str,
    calls: list[dict],
    metrics,
    primary: str,
    grid_type: str = "exhaustive",
    objective: str = "best_model",
    unsupported: str = "raise",
    parallelism: int = 4,
    per_pass: int = 16,
    timer=None,
) -> GridResult:
    """Fit every candidate on train, measure on train and valid, and the winner alone on test.

    Linear candidates share one pass over the train rows; trees are fitted a few at a time; neighbours share one search.
    Candidates with options that MLlib cannot express raise, or are skipped and reported. With a `timer`, a function of a
    stage and a time in seconds, every stage is measured in a pass of its own and its time is told.
    """
    metrics = known_metrics(metrics)
    spent = {"train": 0.0, "valid": 0.0, "test": 0.0}

    def measured(scored: DataFrame, columns: dict[str, str], stages) -> list[tuple]:
        if timer is None:
            return [tuple(r) for r in metrics_by_stage(scored, label, columns, metrics).collect()]
        found = []
        for stage in stages:
            since = time.time()
            found += metrics_by_stage(scored.where(F.col("stage") == stage), label, columns, metrics).collect()
            spent[stage] += time.time() - since
        return [tuple(r) for r in found]

    if primary not in metrics:
        raise ValueError("the primary metric must be one of the metrics")
    if objective not in ("best_model", "first_model"):
        raise ValueError(f"unknown objective {objective!r}")
    todo, skipped = _possible(candidates(calls, grid_type), label, unsupported)
    if not todo:
        raise ValueError("no model to compare")
    spark = df.sparkSession
    plain = [c for c in todo if c.model_type != "k_nearest_neighbors_regressor"]
    nearest = [c for c in todo if c.model_type == "k_nearest_neighbors_regressor"]
    vectors = assemble(df, features) if plain else df
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    models: dict[str, FittedModel] = {}
    collected: list[tuple] = []
    try:
        train = vectors.where(F.col("stage") == "train")
        seen = vectors.where(F.col("stage") != "test")
        if plain:
            width = n_inputs(train)
            shared = {c.model_id: shared_settings(c) for c in plain if width <= MAX_INPUTS and shared_settings(c)}
            if shared:
                solved = solve_all(moments(train, INPUTS, label), shared)
                for c in plain:
                    if c.model_id in solved:
                        weights, intercept = solved[c.model_id]
                        models[c.model_id] = FittedModel(c, features, c.model_id, LinearModel(weights.tolist(), intercept, INPUTS, c.model_id))
            single = [c for c in plain if c.model_id not in shared]
            std = (train.agg(F.stddev_pop(label)).first()[0] or 1.0) if any(c.model_type == "elastic_net" for c in single) else 1.0
            estimators = [estimator(c, label, c.model_id, width, std) for c in single]
            with ThreadPoolExecutor(parallelism) as pool:
                fit_in_thread = inheritable_thread_target(spark)(_fit_mllib)
                jobs = [pool.submit(fit_in_thread, c, e, train) for c, e in zip(single, estimators)]
                for c, job in zip(single, jobs):
                    models[c.model_id] = FittedModel(c, features, c.model_id, job.result())
            for start in range(0, len(plain), per_pass):
                part = plain[start : start + per_pass]
                scored = seen
                for c in part:
                    scored = models[c.model_id].model.transform(scored)
                collected += measured(scored, {c.model_id: c.model_id for c in part}, ("train", "valid"))
        # one search per distance and kind of index serves every k and weighting of the grid
        kinds = {(knn_setting(c)[2], knn_builder(c)): None for c in nearest}
        for p, build in kinds:
            group = [c for c in nearest if (knn_setting(c)[2], knn_builder(c)) == (p, build)]
            index = build(train, features, label, key, max(knn_setting(c)[0] for c in group), p)
            settings = {c.model_id: knn_setting(c)[:2] for c in group}
            scored = index.predict(seen.select("stage", label, *features), settings)
            collected += measured(scored, {c.model_id: c.model_id for c in group}, ("train", "valid"))
            for c in group:
                models[c.model_id] = FittedModel(c, features, c.model_id, index)
        columns = "model_id string, stage string, metric string, value double"
        if objective == "first_model":
            best = models[todo[0].model_id]
        else:
            best = models[best_model(spark.createDataFrame(collected, columns), primary).first()["model_id"]]
        test = df.where(F.col("stage") == "test")
        collected += measured(best.transform(test), {best.candidate.model_id: best.prediction}, ("test",))
        for stage, seconds in spent.items() if timer else ():
            timer(f"validation.{stage}", seconds)
        return GridResult(models, spark.createDataFrame(collected, columns), best, skipped)
    finally:
        vectors.unpersist()
