"""Scoring and validation of a stream of arriving rows: the batch projection on a file source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.score import Scorer, score


def read_stream(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet", **options) -> DataFrame:
    """Files of a folder or glob as they arrive; the schema is fixed, nothing is inferred."""
    return spark.readStream.format(file_format).schema(schema).options(**options).load(path)


def write_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to a Parquet table, exactly once, and stop."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_stream(rows: DataFrame, scorer: Scorer, path: str, checkpoint: str, keep=()) -> StreamingQuery:
    """Stateless: validate, transform, predict and invert each arriving row."""
    return write_available(score(rows, scorer, keep), path, checkpoint)


def project_stream(rows: DataFrame, step: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Any stateless step over a stream, such as validation into a quarantine table."""
    return write_available(rows.transform(step), path, checkpoint)
