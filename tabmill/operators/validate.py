"""Check rows against an input manifest and send them to accepted or quarantined."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import skip_nan
from ..functions.skew import lookup_join
from ..schema import RoleSchema
from ..sources.workspace import materialize
from . import profile

# Up to this many values a categorical check is a literal list, beyond it is a lookup join.
INLINE_VALUES = 500


@dataclass(frozen=True)
class NumericInput:
    name: str
    min: float
    max: float


@dataclass(frozen=True)
class CategoricalInput:
    """Allowed values as a literal list, or as a one-column table (`value`) if there are many."""

    name: str
    values: tuple[str, ...] | None = None
    table: DataFrame | None = None


@dataclass(frozen=True)
class Manifest:
    inputs: tuple

    @property
    def names(self) -> list[str]:
        return [i.name for i in self.inputs]


def build_manifest(
    df: DataFrame, schema: RoleSchema, truncate: bool = False, inline_values: int = INLINE_VALUES
) -> Manifest:
    """Bounds and allowed values of the inputs present in the table, in declared order."""
    present = [c for c in schema.columns if c in df.columns and c != schema.target]
    categorical = [c for c in present if c in schema.categorical]
    numerical = [c for c in present if c in schema.numerical]
    numeric: dict[str, tuple[float, float]] = {}
    if numerical:
        aggregates = []
        for c in numerical:
            x = skip_nan(F.col(c).cast("double"))
            aggregates += [F.min(x).alias(f"min_{c}"), F.max(x).alias(f"max_{c}")]
        found = df.agg(*aggregates).first()
        cut = math.trunc if truncate else (lambda v: v)
        for c in numerical:
            if found[f"min_{c}"] is None:
                raise ValueError(f"{c} has no values to take bounds from")
            numeric[c] = (float(cut(found[f"min_{c}"])), float(cut(found[f"max_{c}"])))
    listed: dict[str, list[str]] = {c: [] for c in categorical}
    wide = {}
    if categorical:
        # one pass over the rows; the distinct values are written and only short lists are collected
        values = materialize(profile.cells(df, categorical).where(F.col("value").isNotNull()).distinct(), "values")
        sizes = {r["column"]: r["count"] for r in values.groupBy("column").count().collect()}
        wide = {c: values.where(F.col("column") == c).select("value") for c in sizes if sizes[c] > inline_values}
        for r in values.where(~F.col("column").isin(*wide)).collect() if wide else values.collect():
            listed[r["column"]].append(r["value"])
    inputs = []
    for c in present:
        if c in numeric:
            inputs.append(NumericInput(c, *numeric[c]))
        elif c in wide:
            inputs.append(CategoricalInput(c, table=wide[c]))
        elif c in categorical:
            inputs.append(CategoricalInput(c, values=tuple(sorted(listed[c]))))
    return Manifest(tuple(inputs))


def manifest_from_rows(rows) -> Manifest:
    """From the typed rows of a stored JSON manifest; domains kept as tables are read where their `values_path` says."""
    inputs = []
    for r in rows:
        if r["type"] == "numerical":
            inputs.append(NumericInput(r["name"], r["min"], r["max"]))
        elif r["type"] == "categorical" and r["available_values"] is not None:
            inputs.append(CategoricalInput(r["name"], values=tuple(r["available_values"])))
        elif r["type"] == "categorical":
            path = r["values_path"] if "values_path" in r else None
            if path is None:
                raise ValueError(f"the manifest holds no values of {r['name']!r}")
            inputs.append(CategoricalInput(r["name"], table=SparkSession.active().read.parquet(path)))
        else:
            raise ValueError(f"unknown input type {r['type']!r}")
    return Manifest(tuple(inputs))


def describe_inputs(manifest: Manifest) -> list[dict]:
    """Names, types, ranges and values of the inputs of a model; None for the values of domains kept as tables."""
    out = []
    for i in manifest.inputs:
        if isinstance(i, NumericInput):
            out.append({"name": i.name, "type": "numerical", "min": i.min, "max": i.max, "available_values": None})
        else:
            values = None if i.values is None else list(i.values)
            out.append({"name": i.name, "type": "categorical", "min": None, "max": None, "available_values": values})
    return out


def _error(name: str, rule: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("column"), F.lit(rule).alias("rule"), value.cast("string").alias("value"))


def _complete(df: DataFrame, manifest: Manifest) -> None:
    absent = [n for n in manifest.names if n not in df.columns]
    if absent:
        raise ValueError(f"incomplete input data, missing columns: {absent}")


def _number(df: DataFrame, name: str) -> Column:
    """The input as a double, null where its text is not a number."""
    return F.col(name).try_cast("double") if dict(df.dtypes)[name] == "string" else F.col(name).cast("double")


def check(df: DataFrame, manifest: Manifest) -> DataFrame:
    """Add `errors`, an array of (column, rule, value). Rules: missing, not_a_number, range, unknown_value."""
    _complete(df, manifest)
    found = []
    marks = []
    for i in manifest.inputs:
        x = F.col(i.name)
        if isinstance(i, NumericInput):
            number = _number(df, i.name)
            found.append(
                F.when(x.isNull(), _error(i.name, "missing", x))
                .when(number.isNull() | F.isnan(number), _error(i.name, "not_a_number", x))
                .when((number < F.lit(i.min)) | (number > F.lit(i.max)), _error(i.name, "range", x))
            )
        elif i.values is not None:
            found.append(
                F.when(x.isNull(), _error(i.name, "missing", x)).when(
                    ~x.cast("string").isin(*i.values) if i.values else F.lit(True), _error(i.name, "unknown_value", x)
                )
            )
        else:
            mark = f"_known_{i.name}"
            table = i.table.select(F.col("value").alias(f"_value_{i.name}"), F.lit(True).alias(mark))
            df = lookup_join(df.withColumn(f"_value_{i.name}", x.cast("string")), table, [f"_value_{i.name}"])
            marks += [mark, f"_value_{i.name}"]
            found.append(
                F.when(x.isNull(), _error(i.name, "missing", x)).when(
                    F.col(mark).isNull(), _error(i.name, "unknown_value", x)
                )
            )
    errors = F.filter(F.array(*found), lambda e: e.isNotNull())
    return df.withColumn("errors", errors).drop(*marks)


def accept(df: DataFrame, manifest: Manifest, keep=()) -> DataFrame:
    """Rows without errors, reduced to the inputs of the model and the columns in `keep`, numbers typed.

    The complement of `quarantine`, as plain predicates that reach the scan where they can.
    """
    _complete(df, manifest)
    for i in manifest.inputs:
        x = F.col(i.name)
        if isinstance(i, NumericInput):
            # null, unreadable text and NaN all fail the comparison
            df = df.where(_number(df, i.name).between(F.lit(i.min), F.lit(i.max)))
        elif i.values is not None:
            df = df.where(x.cast("string").isin(*i.values) if i.values else F.lit(False))
        else:
            mark = f"_value_{i.name}"
            df = lookup_join(df.withColumn(mark, x.cast("string")), i.table.select(F.col("value").alias(mark)), [mark], "left_semi")
    numeric = {i.name for i in manifest.inputs if isinstance(i, NumericInput)}
    return df.select(
        *[c for c in keep if c not in manifest.names],
        *[_number(df, n).alias(n) if n in numeric else F.col(n).cast("string").alias(n) for n in manifest.names],
    )


def judge(df: DataFrame, manifests: list[Manifest]) -> tuple[DataFrame, list[str]]:
    """All rows with one boolean column per manifest, whether it accepts the row, and the names of these columns."""
    for m in manifests:
        _complete(df, m)
    out, marks = df, {}
    for i in [i for m in manifests for i in m.inputs if isinstance(i, CategoricalInput) and i.table is not None]:
        if (i.name, id(i.table)) not in marks:
            mark = marks[i.name, id(i.table)] = f"_known_{len(marks)}"
            table = i.table.select(F.col("value").alias(f"{mark}_value"), F.lit(True).alias(mark))
            out = lookup_join(out.withColumn(f"{mark}_value", F.col(i.name).cast("string")), table, [f"{mark}_value"]).drop(f"{mark}_value")
    verdicts = []
    for m in manifests:
        accepted = F.lit(True)
        for i in m.inputs:
            if isinstance(i, NumericInput):
                one = _number(df, i.name).between(F.lit(i.min), F.lit(i.max))
            elif i.values is not None:
                one = F.col(i.name).cast("string").isin(*i.values) if i.values else F.lit(False)
            else:
                one = F.col(marks[i.name, id(i.table)])
            accepted &= F.coalesce(one, F.lit(False))
        verdicts.append(accepted)
    names = [f"_accepted_{n}" for n in range(len(manifests))]
    return out.select(*df.columns, *[v.alias(n) for v, n in zip(verdicts, names)]), names


def typed_input(column: Column, item: NumericInput | CategoricalInput, kind: str) -> Column:
    """An input as models take it: numbers as doubles, null where a text is none, everything else as text."""
    if isinstance(item, NumericInput):
        return column.try_cast("double") if kind == "string" else column.cast("double")
    return column.cast("string")


def some_value(item: NumericInput | CategoricalInput) -> float | str | None:
    """A value that the input accepts; None if there is none."""
    if isinstance(item, NumericInput):
        return item.min
    if item.values is not None:
        return item.values[0] if item.values else None
    return item.table.agg(F.min("value")).first()[0]


def quarantine(df: DataFrame, manifest: Manifest) -> DataFrame:
    """Rows with errors, all their columns and the reasons."""
    return check(df, manifest).where(F.size("errors") > 0)


def reasons(checked: DataFrame) -> DataFrame:
    """(column, rule, n_rows) over the quarantined rows."""
    return (
        checked.select(F.explode("errors").alias("e"))
        .groupBy(F.col("e.column").alias("column"), F.col("e.rule").alias("rule"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
