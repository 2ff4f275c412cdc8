"""Column transformations that are fitted on the train rows and applied everywhere.

Fitting is one aggregate for all steps (one more per data-dependent step that follows another on
the same column); applying is one projection. Fitted steps are plain parameters: they can be
written to a table, read back, replayed on other data and inverted on the target.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordering import alphabetical_index
from ..functions.scalar import natural_log, quoted, sign, skip_nan
from ..functions.skew import lookup_join
from ..schema import RoleSchema
from ..sources.workspace import materialize

REPLACE, APPEND, APPEND_AND_REMOVE = "REPLACE", "APPEND", "APPEND_AND_REMOVE"

# Up to this many categories get a 0/1 column each, more go into one sparse vector, unless a step says `columns` or `vector`.
MAX_WIDTH = 200
MOST_COLUMNS = 5_000  # a step that says `columns` raises beyond
FORMS = ("auto", "columns", "vector")

# Step type -> (name in appended columns, prefix of step ids), both fixed values.
STEP_NAMES = {
    "log_transformation": ("log", "log"),
    "normalization": ("normalization", "norm"),
    "min_max_transformation": ("min_max", "minmax"),
    "one_hot_encoding": ("one_hot_encoding", "ohe"),
    "standardization": ("standardization", "std"),
}


@dataclass(frozen=True)
class FunctionPair:
    """A user's own transformation as Column functions; no inverse means not for targets."""

    name: str
    forward: Callable[[Column], Column]
    inverse: Callable[[Column], Column] | None = None


_pairs: dict[str, FunctionPair] = {}


def register_pair(pair: FunctionPair) -> FunctionPair:
    """Make a pair usable as a step type, also when fitted steps are read back."""
    if pair.name in STEP_NAMES:
        raise ValueError(f"{pair.name} is a built-in step")
    _pairs[pair.name] = pair
    return pair


@dataclass(frozen=True)
class Step:
    """One transformation of one column, not fitted yet."""

    ordinal: int
    type: str
    column: str
    method: str
    is_target: bool
    form: str = field(default="auto", compare=False)  # of one-hot encoding

    @property
    def name(self) -> str:
        return STEP_NAMES.get(self.type, (self.type, self.type))[0]

    @property
    def id(self) -> str:
        prefix = STEP_NAMES.get(self.type, (self.type, self.type))[1]
        return f"{prefix}-{self.ordinal:02d}-{self.column.lower()}"

    @property
    def has_inverse(self) -> bool:
        if self.type in _pairs:
            return _pairs[self.type].inverse is not None
        return self.type in ("log_transformation", "min_max_transformation", "standardization")


@dataclass(frozen=True)
class FittedStep:
    """A step with its parameters."""

    step: Step
    params: dict[str, float] = field(default_factory=dict)
    categories: tuple[str, ...] | None = None
    domain: DataFrame | None = None  # value -> index, for a domain too large for columns

    def forward(self, x: Column) -> Column:
        kind, p = self.step.type, self.params
        if kind == "log_transformation":
            return natural_log(x)
        if kind == "normalization":
            return sign(x)
        if kind == "min_max_transformation":
            return (x - F.lit(p["min"])) / F.lit(p["scale"])
        if kind == "standardization":
            return (x - F.lit(p["mean"])) / F.lit(p["scale"])
        return _pairs[kind].forward(x)

    def inverse(self, z: Column) -> Column:
        kind, p = self.step.type, self.params
        if kind == "log_transformation":
            return F.exp(z)
        if kind == "min_max_transformation":
            return z * F.lit(p["scale"]) + F.lit(p["min"])
        if kind == "standardization":
            return z * F.lit(p["scale"]) + F.lit(p["mean"])
        if not self.step.has_inverse:
            raise ValueError(f"{kind} has no inverse")
        return _pairs[kind].inverse(z)


def parse_steps(specs: list[dict], schema: RoleSchema) -> list[Step]:
    """One step per (spec, column), in order. Only declared columns can be named."""
    steps = []
    for ordinal, spec in enumerate(specs):
        kind = spec["type"]
        if kind not in STEP_NAMES and kind not in _pairs:
            raise ValueError(f"unknown transformation {kind!r}")
        for name in spec["columns"]:
            column = schema.resolve(name)
            # where the target is a feature too, steps work on the feature and the label stays raw
            is_target = column == schema.target and not schema.target_is_feature
            method = spec.get("condition", "append_and_remove" if kind == "one_hot_encoding" else "replace").upper()
            form = spec.get("form", "auto")
            if form not in FORMS or form != "auto" and kind != "one_hot_encoding":
                raise ValueError(f"unknown form {form!r} of {kind}")
            if kind == "one_hot_encoding":
                method = APPEND_AND_REMOVE
            if method not in (REPLACE, APPEND, APPEND_AND_REMOVE):
                raise ValueError(f"unknown condition {method!r}")
            step = Step(ordinal, kind, column, method, is_target, form)
            if is_target and method != REPLACE:
                raise ValueError(f"{column} is the target, not a feature: only replace is possible")
            if is_target and not step.has_inverse:
                raise ValueError(f"{kind} on the target {column} needs an inverse")
            if method == APPEND_AND_REMOVE and kind != "one_hot_encoding":
                raise ValueError(f"{kind} does not yield named columns for append_and_remove")
            steps.append(step)
    return steps


def _needs_fit(step: Step) -> bool:
    return step.type in ("min_max_transformation", "standardization", "one_hot_encoding")


def _statistics(step: Step, x: Column, i: int) -> list[Column]:
    """Aggregates a scaling step needs."""
    x = skip_nan(x)
    if step.type == "min_max_transformation":
        return [F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
    return [F.avg(x).alias(f"mean{i}"), F.stddev_pop(x).alias(f"std{i}")]


def _fitted(step: Step, row, i: int) -> FittedStep:
    if step.type == "min_max_transformation":
        low, span = row[f"min{i}"], None if row[f"min{i}"] is None else row[f"max{i}"] - row[f"min{i}"]
        params = {"min": low, "scale": span}
    else:
        params = {"mean": row[f"mean{i}"], "scale": row[f"std{i}"]}
    if any(v is None or not math.isfinite(v) for v in params.values()):
        raise ValueError(f"{step.id}: train values of {step.column} are empty or infinite: {params}")
    # a constant column is only shifted
    params["scale"] = params["scale"] or 1.0
    return FittedStep(step, params)


def _fit_one_hot(train: DataFrame, steps: dict[int, Step], max_width: int) -> dict[int, FittedStep]:
    """Sorted distinct values of every column to encode, all from one pass over the train rows."""
    if not steps:
        return {}
    columns = sorted({s.column for s in steps.values()})
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    long = train.select(F.explode(cells).alias("cell")).select("cell.*").where(F.col("value").isNotNull())
    values = materialize(long.distinct(), "values")
    width = {r["column"]: r["count"] for r in values.groupBy("column").count().collect()}
    forms = {s.column: s.form for s in steps.values()}
    small = [c for c in columns if forms[c] == "columns" or forms[c] == "auto" and width.get(c, 0) <= max_width]
    for c in small:
        if width.get(c, 0) > max(MOST_COLUMNS, max_width):
            raise ValueError(f"{c} has {width[c]} categories, {MOST_COLUMNS} may get a column each; use the form 'vector'")
    listed: dict[str, list[str]] = {c: [] for c in small}
    for row in values.where(F.col("column").isin(*small)).collect() if small else []:
        listed[row["column"]].append(row["value"])
    large = {}
    for c in columns:
        if c not in listed:
            indexed = alphabetical_index(values.where(F.col("column") == c).select("value"), "value", "index")
            large[c] = materialize(indexed, "domain")
    return {
        i: FittedStep(s, categories=tuple(sorted(listed[s.column])))
        if s.column in listed
        else FittedStep(s, {"width": float(width.get(s.column, 0))}, domain=large[s.column])
        for i, s in steps.items()
    }


def fit(
    df: DataFrame,
    specs: list[dict],
    schema: RoleSchema,
    fit_mode: str = "chained",
    max_width: int = MAX_WIDTH,
) -> list[FittedStep]:
    """Fit on the rows with stage = train, or on all rows if there is no stage column.

    `chained` fits a step on what the earlier steps make of its column, `raw` always on the column
    as it was before any step.
    """
    if fit_mode not in ("chained", "raw"):
        raise ValueError(f"unknown fit mode {fit_mode!r}")
    steps = parse_steps(specs, schema)
    train = df.where(F.col("stage") == "train") if "stage" in df.columns else df
    absent = [s.column for s in steps if s.column not in df.columns]
    if absent:
        raise ValueError(f"columns to transform are absent: {absent}")
    fitted: dict[int, FittedStep] = {i: FittedStep(s) for i, s in enumerate(steps) if not _needs_fit(s)}
    fitted |= _fit_one_hot(train, {i: s for i, s in enumerate(steps) if s.type == "one_hot_encoding"}, max_width)
    while len(fitted) < len(steps):
        aggregates, ready = [], []
        current: dict[str, Column] = {}
        blocked: set[str] = set()
        for i, step in enumerate(steps):
            if step.column in blocked:
                continue
            x = current.get(step.column, F.col(step.column))
            if i not in fitted:
                ready.append(i)
                aggregates += _statistics(step, x, i)
                if fit_mode == "chained":
                    blocked.add(step.column)
            elif fit_mode == "chained" and step.method == REPLACE:
                current[step.column] = fitted[i].forward(x)
        row = train.agg(*aggregates).first()
        for i in ready:
            fitted[i] = _fitted(steps[i], row, i)
    return [fitted[i] for i in range(len(steps))]


def one_hot_columns(step: FittedStep) -> list[str]:
    """`<column>_<value>` for each category. Names that could not be told apart, or read as a path, end in a checksum.

    Column names are not case-sensitive, so of `a` and `A` the second gets one, as does a value with a point or backtick.
    """
    names: list[str] = []
    taken: set[str] = set()
    for value in step.categories:
        name = plain = f"{step.step.column}_{value}"
        if name.lower() in taken or "." in value or "`" in value:
            plain = plain.replace(".", "_").replace("`", "_")
            name = f"{plain}_{zlib.crc32(value.encode()):08x}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def apply_steps(df: DataFrame, steps: list[FittedStep], only: str | None = None) -> DataFrame:
    """Run fitted steps as one projection. `only` restricts to 'features' or 'target' steps."""
    for s in steps:
        if not isinstance(s, FittedStep):
            raise ValueError(f"{getattr(s, 'id', s)} is not fitted yet")
    out: dict[str, Column] = {c: quoted(c) for c in df.columns}
    wide = []
    for s in steps:
        step = s.step
        if only is not None and (only == "target") != step.is_target:
            continue
        if step.column not in out:
            raise ValueError(f"column {step.column} is not there")
        x = out[step.column]
        if s.domain is not None:
            wide.append(s)
        elif step.type == "one_hot_encoding":
            del out[step.column]
            there = {c.lower() for c in out}
            for value, name in zip(s.categories, one_hot_columns(s)):
                if name.lower() in there:
                    raise ValueError(f"{s.step.id} would overwrite the column {name}")
                out[name] = F.when(x.cast("string") == F.lit(value), 1).otherwise(0)
        elif step.method == REPLACE:
            out[step.column] = s.forward(x)
        else:
            out[f"{step.column}_{step.name}"] = s.forward(x)
    df = df.select(*[expr.alias(name) for name, expr in out.items()])
    for s in wide:
        if f"{s.step.column}_vector".lower() in {c.lower() for c in df.columns}:
            raise ValueError(f"{s.step.id} would overwrite the column {s.step.column}_vector")
        df = _sparse_one_hot(df, s)
    return df


def _sparse_one_hot(df: DataFrame, s: FittedStep) -> DataFrame:
    """One sparse vector instead of a column per category; unseen values give an empty vector."""
    from pyspark.ml.feature import OneHotEncoder

    column, width = s.step.column, int(s.params["width"])
    index = f"{column}_index"
    table = s.domain.select(F.col("value").alias("_value"), F.col("index").cast("double").alias(index))
    joined = lookup_join(df.withColumn("_value", F.col(column).cast("string")), table, ["_value"])
    # the slot after the last category stands for unseen values and is dropped again
    known = joined.fillna({index: float(width)}).drop("_value", column)
    slots = known.sparkSession.range(width + 1).select(F.col("id").cast("double").alias(index))
    encoder = OneHotEncoder(inputCol=index, outputCol=f"{column}_vector", dropLast=True)
    return encoder.fit(slots).transform(known).drop(index)


def invert_target(z: Column, steps: list[FittedStep]) -> Column:
    """Undo the target's steps, last one first."""
    for s in reversed([s for s in steps if s.step.is_target]):
        z = s.inverse(z)
    return z


def transformed_features(schema: RoleSchema, columns: list[str], steps: list[FittedStep]) -> list[str]:
    """Names of the model inputs after the steps, in order."""
    names = schema.features(columns)
    for s in steps:
        step = s.step
        if step.is_target:
            continue
        if s.domain is not None:
            names = [n for n in names if n != step.column] + [f"{step.column}_vector"]
        elif step.type == "one_hot_encoding":
            names = [n for n in names if n != step.column] + one_hot_columns(s)
        elif step.method == APPEND:
            names.append(f"{step.column}_{step.name}")
    return names


STEP_TABLE = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("is_target", T.BooleanType()),
        T.StructField("params", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("domain_path", T.StringType()),
    ]
)


def save_steps(spark: SparkSession, steps: list[FittedStep], path: str) -> None:
    """Write the parameter table, and large domains next to it."""
    rows = []
    for position, s in enumerate(steps):
        domain_path = None
        if s.domain is not None:
            domain_path = f"{path}-{s.step.id}"
            s.domain.write.mode("overwrite").parquet(domain_path)
        categories = None if s.categories is None else list(s.categories)
        t = s.step
        rows.append((t.ordinal, position, t.id, t.type, t.name, t.column, t.method, t.is_target, s.params, categories, domain_path))
    spark.createDataFrame(rows, STEP_TABLE).coalesce(1).write.mode("overwrite").parquet(path)


def load_steps(spark: SparkSession, path: str) -> list[FittedStep]:
    """Read the parameter table back; own function pairs must be registered under the same name."""
    steps = []
    for r in spark.read.parquet(path).orderBy("position").collect():
        if r["type"] not in STEP_NAMES and r["type"] not in _pairs:
            raise ValueError(f"{r['type']} is not registered")
        step = Step(r["ordinal"], r["type"], r["column"], r["method"], r["is_target"])
        categories = None if r["categories"] is None else tuple(r["categories"])
        domain = spark.read.parquet(r["domain_path"]) if r["domain_path"] else None
        steps.append(FittedStep(step, dict(r["params"]), categories, domain))
    return steps
