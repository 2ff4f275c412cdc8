"""Column and row cleaning, and typing by role."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import RoleSchema


def _present(df: DataFrame, columns) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"no such columns: {absent}")


def filter_columns(df: DataFrame, columns) -> DataFrame:
    """Keep these columns, in this order."""
    _present(df, columns)
    return df.select(*columns)


def remove_columns(df: DataFrame, columns) -> DataFrame:
    _present(df, columns)
    return df.drop(*columns)


def remove_nan_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Drop rows with a null or NaN in any column but those in `keep`."""
    return df.na.drop("any", subset=[c for c in df.columns if c not in keep])


def typed(df: DataFrame, schema: RoleSchema) -> DataFrame:
    """Numerical columns to double (bad text raises), categorical ones to string, the rest as is."""
    return df.select(
        *[
            F.col(c).cast("double").alias(c)
            if c in schema.numerical
            else F.col(c).cast("string").alias(c)
            if c in schema.categorical
            else F.col(c)
            for c in df.columns
        ]
    )


def typed_or_quarantined(df: DataFrame, schema: RoleSchema) -> tuple[DataFrame, DataFrame]:
    """Rows that can be typed, and the others untouched with the `bad_columns` named."""
    numerical = [c for c in df.columns if c in schema.numerical]
    bad = F.filter(
        F.array(
            *[F.when(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull(), F.lit(c)) for c in numerical]
        ),
        lambda c: c.isNotNull(),
    )
    marked = df.withColumn("bad_columns", bad)
    good = marked.where(F.size("bad_columns") == 0).drop("bad_columns")
    # try_cast again, as the optimizer may move a failing cast before the filter
    good = good.select(
        *[
            F.col(c).try_cast("double").alias(c)
            if c in schema.numerical
            else F.col(c).cast("string").alias(c)
            if c in schema.categorical
            else F.col(c)
            for c in df.columns
        ]
    )
    return good, marked.where(F.size("bad_columns") > 0)


# Names of the cleaning steps a job may list. `drop_na` is the name used in older job files.
_ROW_STEPS = {"remove_nan_rows", "drop_na"}
_COLUMN_STEPS = {"filter_columns": filter_columns, "remove_columns": remove_columns}


def clean(df: DataFrame, schema: RoleSchema, steps: list[dict], carry_id: bool = False) -> DataFrame:
    """Run the listed steps in order, then type by role.

    `carry_id` keeps the primary id next to the chosen columns for the split and for sampling. It
    does not count as a chosen column: a missing id drops no row.
    """
    key = schema.primary_id

    def step(frame: DataFrame, spec: dict) -> DataFrame:
        kind = spec["type"]
        columns = schema.resolve_all(spec.get("columns", []))
        if kind in _ROW_STEPS:
            return remove_nan_rows(frame, keep=(key,) if carry_id else ())
        if kind not in _COLUMN_STEPS:
            raise ValueError(f"unknown cleaning step {kind!r}")
        if carry_id and kind == "filter_columns":
            columns = [key, *[c for c in columns if c != key]]
        if carry_id and kind == "remove_columns":
            columns = [c for c in columns if c != key]
        return _COLUMN_STEPS[kind](frame, columns)

    return typed(reduce(step, steps, df), schema)


def features(df: DataFrame, schema: RoleSchema) -> DataFrame:
    """Feature columns in declared order."""
    return df.select(*schema.features(df.columns))


def target(df: DataFrame, schema: RoleSchema) -> DataFrame:
    return df.select(schema.target)


def area_mismatches(df: DataFrame, side: str) -> DataFrame:
    """Rows whose area is not `state-district`; `side` is ORIGIN or DESTINATION."""
    expected = F.concat(f"{side}_STATE", F.lit("-"), f"{side}_DISTRICT")
    return df.where(~F.col(f"{side}_CFS_AREA").eqNullSafe(expected)).withColumn("expected_area", expected)
