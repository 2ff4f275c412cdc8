"""CSV and Parquet sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.selection import first_rows, random_rows
from ..schema import RoleSchema
from .workspace import new_path

# Texts that a pandas CSV reader takes for a missing value by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

STAGES = ("train", "valid", "test")


def rename_positional(df: DataFrame, schema: RoleSchema) -> DataFrame:
    """Give the columns their declared names by position; the number of columns must match."""
    if len(df.columns) != len(schema.columns):
        raise ValueError(
            f"schema {schema.name} has {len(schema.columns)} columns, the data has {len(df.columns)}"
        )
    return df.toDF(*schema.columns)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Turn the NA texts of string columns into nulls."""
    return df.select(
        *[
            F.when(F.col(c).isin(*NA_TOKENS), None).otherwise(F.col(c)).alias(c) if t == "string" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def _dialect(io, multi_line: bool = False):
    """Fields in double quotes, quotes inside doubled, white space kept."""
    options = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return io.options(**options, **({"multiLine": True} if multi_line else {}))


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Headed CSV as text columns. A row with more fields than the header raises, a shorter one ends in nulls.

    `multi_line` allows line breaks in quoted fields; a file is then read by one task. No inference pass over the data.
    """
    names = _dialect(spark.read, multi_line).csv(path).columns
    surplus = StructType([StructField(f"c{i}", StringType()) for i in range(len(names) + 1)])
    raw = _dialect(spark.read, multi_line).schema(surplus).csv(path)
    error = F.raise_error(F.concat(F.lit(f"a row has more than {len(names)} fields; the first surplus one is "), F.col(f"c{len(names)}")))
    whole = raw.where(F.when(F.col(f"c{len(names)}").isNull(), True).otherwise(error.cast("boolean")))
    return whole.drop(f"c{len(names)}").toDF(*names)


def read_csv(spark: SparkSession, path: str, schema: RoleSchema, multi_line: bool = False) -> DataFrame:
    """Headed CSV as text columns under the declared names, numerical fields without white space around them."""
    df = rename_positional(read_text_csv(spark, path, multi_line), schema)
    numbers = {*schema.numerical, schema.target, schema.primary_id}
    return blank_to_null(df.select(*[F.trim(F.col(c)).alias(c) if c in numbers else F.col(c) for c in df.columns]))


def head(df: DataFrame, schema: RoleSchema, n_rows: int | None) -> DataFrame:
    """First rows by primary id; None, or more rows than there are, gives all."""
    return df if n_rows is None else first_rows(df, schema.primary_id, n_rows)


def sample_rows(df: DataFrame, schema: RoleSchema, n_rows: int, seed: int = 42) -> DataFrame:
    """Exactly n random rows, the same for the same seed; too few rows raise."""
    return random_rows(df, schema.primary_id, n_rows, seed)


def load_csv(
    spark: SparkSession,
    path: str,
    schema: RoleSchema,
    n_rows: int | None = None,
    random_state: int | None = None,
) -> DataFrame:
    """CSV scan, positional rename and, if asked, the head or a random sample."""
    df = read_csv(spark, path, schema)
    if n_rows is None:
        return df
    return head(df, schema, n_rows) if random_state is None else sample_rows(df, schema, n_rows, random_state)


def save_csv(df: DataFrame, path: str) -> None:
    """Headed CSV that `read_csv` gives back, apart from empty texts, which are missing values there."""
    _dialect(df.write).mode("overwrite").csv(path)


def save_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One Parquet dataset, a folder per stage."""
    df.write.partitionBy("stage").mode(mode).parquet(path)


def load_splits(spark: SparkSession, path: str, stage: str | None = None) -> DataFrame:
    """All stages, or one of them by partition pruning."""
    if stage is not None and stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    df = spark.read.parquet(path)
    return df if stage is None else df.where(F.col("stage") == stage)


def stored_splits(df: DataFrame) -> DataFrame:
    """Split rows written to the shared folder once, a folder per stage.

    Worth it wherever several passes follow: they read narrow columns instead of joining and
    hashing again, and a pass over the train rows reads nothing else.
    """
    path = new_path(df.sparkSession, "splits")
    save_splits(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def same_columns(*frames: DataFrame) -> None:
    """Split sets read from separate places must agree on their columns."""
    first = frames[0].dtypes
    for other in frames[1:]:
        if other.dtypes != first:
            raise ValueError(f"column mismatch across splits: {first} and {other.dtypes}")


def audited(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows while the next action runs, without a pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
