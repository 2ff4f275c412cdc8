"""Where jobs put their intermediate and output tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}

def shared_folder(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a new local folder only on a local master without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tabmill-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def in_parts(df, name: str, rows: int, part: int):
    """`materialize` for a table of that many rows which is read back in tasks of about `part` rows, at least.

    Spark packs files by their bytes, and millions of narrow rows weigh little. How finely is a setting of the session, so
    the table is read by one of its own.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("maxRecordsPerFile", part).parquet(path)
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.minPartitionNum", max(1, -(-rows // part)))
    return reader.read.schema(df.schema).parquet(path)


def materialize(df, name: str):
    """Write a table to the shared folder and read it back, which cuts the lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
