"""Geographic features: interstate flag, frequency and mean-target encoding."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import heavy_keys, lookup_join
from ..sources.workspace import materialize

ORIGIN, DESTINATION = "ORIGIN_STATE", "DESTINATION_STATE"


def interstate(df: DataFrame, origin: str = ORIGIN, destination: str = DESTINATION) -> DataFrame:
    return df.withColumn("IS_INTERSTATE", (F.col(origin) != F.col(destination)).cast("int"))


@dataclass(frozen=True)
class Encoding:
    """Per column a table (column, <column>_FREQ, <column>_MEAN), the overall train mean, and per column the values that
    had a large share of the train rows, by which a lookup is spread without another pass over the rows."""

    tables: dict[str, DataFrame]
    default: float
    heavy: dict[str, DataFrame] = field(default_factory=dict)


def fit_encoding(df: DataFrame, columns, target: str) -> Encoding:
    """Train counts and target means per value, all columns in one pass, written once and then looked up.

    Rows are counted and summed before the shuffle, so a frequent value is no more work than a rare one.
    """
    columns = list(columns)
    train = df.where(F.col("stage") == "train")
    long = train.select(
        F.col(target).alias("_y"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("cell"),
    )
    grouped = long.groupBy("cell.column", "cell.value").agg(
        F.count(F.lit(1)).alias("n"), F.count("_y").alias("with_target"), F.sum("_y").alias("total")
    )
    fitted = materialize(grouped, "encoding")
    overall = fitted.where(F.col("column") == columns[0]).agg(F.sum("total") / F.sum("with_target")).first()[0]
    types = dict(df.dtypes)
    tables = {
        c: fitted.where(F.col("column") == c).select(
            F.col("value").cast(types[c]).alias(c),
            F.col("n").alias(f"{c}_FREQ"),
            (F.col("total") / F.col("with_target")).alias(f"{c}_MEAN"),
        )
        for c in columns
    }
    return Encoding(tables, overall, {c: heavy_keys(tables[c], [c], f"{c}_FREQ") for c in columns})


def frequency_encode(df: DataFrame, encoding: Encoding) -> DataFrame:
    """Add `<column>_FREQ`: train rows with that value, 0 if never seen."""
    for c, table in encoding.tables.items():
        df = lookup_join(df, table.select(c, f"{c}_FREQ"), [c], heavy=encoding.heavy.get(c)).fillna({f"{c}_FREQ": 0})
    return df


def mean_encode(df: DataFrame, encoding: Encoding) -> DataFrame:
    """Add `<column>_MEAN`: train mean of the target for that value, the overall mean if never seen."""
    for c, table in encoding.tables.items():
        df = lookup_join(df, table.select(c, f"{c}_MEAN"), [c], heavy=encoding.heavy.get(c)).fillna({f"{c}_MEAN": encoding.default})
    return df


def encode(df: DataFrame, encoding: Encoding, drop: bool = True) -> DataFrame:
    """Both encodings with one lookup per column, and the encoded columns dropped."""
    for c, table in encoding.tables.items():
        df = lookup_join(df, table, [c], heavy=encoding.heavy.get(c)).fillna({f"{c}_FREQ": 0, f"{c}_MEAN": encoding.default})
    return df.drop(*encoding.tables) if drop else df


def geo_features(
    df: DataFrame, target: str, origin: str = ORIGIN, destination: str = DESTINATION, drop: bool = True
) -> DataFrame:
    """Interstate flag, frequency and mean encoding of both ends."""
    return encode(interstate(df, origin, destination), fit_encoding(df, [origin, destination], target), drop)
