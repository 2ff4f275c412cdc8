"""Summaries, profiles, input manifests and fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hex_to_long, row_text
from ..functions.scalar import skip_nan
from ..functions.selection import exact_quantiles
from ..schema import RoleSchema
from ..sources.workspace import new_path

MANIFEST = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("type", T.StringType()),
            T.StructField("min", T.DoubleType()),
            T.StructField("max", T.DoubleType()),
            T.StructField("available_values", T.ArrayType(T.StringType())),
            # a table (`value`) instead of the list
            T.StructField("values_path", T.StringType()),
        ]
    )
)

# A column with more values than this keeps them in a table, not in the JSON manifest, and in several maps.
MANIFEST_VALUES = 10_000


def _one_row_per_column(df: DataFrame, columns, aggregates: dict) -> DataFrame:
    """One aggregate over all columns, then one output row per column. No row is multiplied."""
    names = list(aggregates)
    wide = df.agg(
        *[agg(skip_nan(F.col(c).cast("double"))).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, agg in aggregates.items()]
    )
    cells = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{n}_{i}").alias(n) for n in names]) for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*cells)))


def cells(df: DataFrame, columns) -> DataFrame:
    """Long form (column, value) as text."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def value_counts(df: DataFrame, columns) -> DataFrame:
    """(column, value, n): partially counted before the shuffle, so frequent values cost nothing extra."""
    return cells(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def manifest_numeric(df: DataFrame, schema: RoleSchema, truncate: bool = False) -> DataFrame:
    """(name, type, min, max) of the numerical inputs; `truncate` cuts the bounds to whole numbers."""
    columns = [c for c in schema.columns if c in df.columns and c in schema.numerical and c != schema.target]
    if not columns:
        return df.sparkSession.createDataFrame([], "name string, type string, min double, max double")
    out = _one_row_per_column(df, columns, {"min": F.min, "max": F.max})
    cut = (lambda c: F.when(F.col(c) < 0, F.ceil(c)).otherwise(F.floor(c)).cast("double")) if truncate else F.col
    return out.select(
        F.col("column").alias("name"), F.lit("numerical").alias("type"), cut("min").alias("min"), cut("max").alias("max")
    )


def manifest_categorical(df: DataFrame, schema: RoleSchema) -> DataFrame:
    """(name, value) of the categorical inputs, one row per distinct value."""
    columns = [c for c in schema.columns if c in df.columns and c in schema.categorical]
    if not columns:
        return df.sparkSession.createDataFrame([], "name string, value string")
    return cells(df, columns).distinct().select(F.col("column").alias("name"), "value")


def manifest_json(
    numeric: DataFrame, values: DataFrame, max_values: int = MANIFEST_VALUES, folder: str | None = None
) -> DataFrame:
    """The manifest as one JSON text.

    A domain of more than `max_values` values is written as a table (`value`) below `folder`, by default one in the
    shared folder, and its `values_path` stands for the list.
    """
    spark = values.sparkSession
    large = values.groupBy("name").count().where(F.col("count") > max_values).select("name")
    wide = [r["name"] for r in large.collect()]
    if wide:
        folder = folder or new_path(spark, "values")
        for name in wide:
            values.where(F.col("name") == name).select("value").write.mode("overwrite").parquet(f"{folder}/{name}")
        values = values.where(~F.col("name").isin(wide))
    lists = values.groupBy("name").agg(F.sort_array(F.collect_list("value")).alias("available_values"))
    none = F.lit(None)
    entries = numeric.select("name", "type", "min", "max").unionByName(
        lists.select("name", F.lit("categorical").alias("type"), "available_values"), allowMissingColumns=True
    )
    entries = entries.withColumn("values_path", none.cast("string"))
    if wide:
        stored = spark.createDataFrame([(n, "categorical", f"{folder}/{n}") for n in wide], "name string, type string, values_path string")
        entries = entries.unionByName(stored, allowMissingColumns=True)
    entry = F.struct("name", "type", "min", "max", "available_values", "values_path")
    return entries.agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("manifest"))


def manifest_rows(df: DataFrame, json_column: str = "manifest") -> DataFrame:
    """Typed rows from a JSON manifest."""
    return df.select(F.inline(F.from_json(json_column, MANIFEST)))


def describe_numeric(df: DataFrame, columns) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per column, in three passes up to 20 million rows; all are exact."""
    columns = list(columns)
    base = _one_row_per_column(
        df, columns, {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    ).collect()
    q = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    rows = [
        (c := r["column"], r["count"], r["mean"], r["std"], r["min"], q[c, 0.25], q[c, 0.5], q[c, 0.75], r["max"]) for r in base
    ]
    numbers = ", ".join(f"{n} double" for n in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return df.sparkSession.createDataFrame(rows, f"column string, count bigint, {numbers}")


def describe_categorical(df: DataFrame, columns) -> DataFrame:
    """count, distinct values, most frequent value (first by name on a tie) and its count."""
    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    top = F.min(F.struct((-F.col("n")).alias("minus_n"), "value"))
    return (
        counts.groupBy("column")
        .agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), top.alias("top"))
        .select("column", "count", "unique", F.col("top.value").alias("top"), (-F.col("top.minus_n")).alias("freq"))
    )


def profile_numeric(df: DataFrame, columns) -> DataFrame:
    """mean, count, sample standard deviation, sum, min and max per column, in one pass."""
    return _one_row_per_column(
        df,
        list(columns),
        {"mean": F.avg, "count": F.count, "stddev": F.stddev_samp, "sum": F.sum, "min": F.min, "max": F.max},
    )


def profile_categorical(df: DataFrame, columns) -> DataFrame:
    """(column, value, freq, n_unique, n_rows); the per-column totals come from the counted values."""
    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    totals = counts.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"), F.sum("n").alias("n_rows"))
    # one row per column name, so the list of columns bounds it
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", F.col("n").alias("freq"), "n_unique", "n_rows"
    )


def frequency_map(profile: DataFrame, max_values: int = MANIFEST_VALUES) -> DataFrame:
    """(column, freq map) from the long profile.

    A column with more than `max_values` values has several rows, each with the map of about half that many values, dealt
    by hash; no value is in two of them.
    """
    maps = F.when(F.col("n_unique") <= max_values, 1).otherwise(F.ceil(2 * F.col("n_unique") / max_values))
    part = F.pmod(F.xxhash64("column", "value"), maps)
    return (
        profile.groupBy("column", part.alias("_part"))
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("value", "freq")))).alias("freq"))
        .select("column", "freq")
    )


def dataset_meta(df: DataFrame) -> DataFrame:
    """Row count, column count and the schema as column -> type."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"), types.alias("schema")
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """Digest that does not depend on row order or partitioning: row count and sum of 32-bit row hashes.

    The halves of the hashes are summed as bigint, which holds for 2^47 rows.
    """
    hashes = df.select(hex_to_long(F.substring(F.md5(row_text(df)), 1, 8)).alias("h"))
    high, low = F.sum(F.shiftright("h", 16)), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFF)))
    digest = high.cast("decimal(25,0)") * F.lit(65536).cast("decimal(5,0)") + low.cast("decimal(25,0)")
    return hashes.agg(F.count(F.lit(1)).alias("n_rows"), digest.cast("decimal(38,0)").alias("digest"))


def duplicate_content(df: DataFrame, key: str, content: str) -> DataFrame:
    """Contents that occur more than once, by SHA-256. Texts are hashed before the shuffle."""
    return (
        df.select(F.col(key).alias("_key"), F.sha2(F.col(content).cast("binary"), 256).alias("hash"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("_key").alias("first_key"))
        .where(F.col("copies") > 1)
    )


def stage_timings(metrics: DataFrame) -> DataFrame:
    """count, mean and max per timer of the run log."""
    return (
        metrics.where(F.col("key").startswith("time_ms."))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("runs"), F.avg("value").alias("mean_ms"), F.max("value").alias("max_ms"))
    )
