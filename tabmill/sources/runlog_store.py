"""The run log as append-only Parquet tables; one write per job and table."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.runlog import current_tags, round_metrics

_ENTRY = "id string, run_id string, key string, value {value}, written_at timestamp"

# The tables of the log.
TABLES = {
    "experiments": "id string, name string",
    "runs": "id string, name string, parent_id string, experiment_id string, written_at timestamp",
    "tags": _ENTRY.format(value="string"),
    "metrics": _ENTRY.format(value="double"),
    "properties": _ENTRY.format(value="string"),
    "objects": "id string, run_id string, type string, url string, written_at timestamp",
}


def create(spark: SparkSession, path: str) -> None:
    """Create the tables that are not there yet."""
    for table, columns in TABLES.items():
        spark.createDataFrame([], columns).coalesce(1).write.mode("ignore").parquet(f"{path}/{table}")


def read(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One table of the log."""
    return spark.read.schema(TABLES[table]).parquet(f"{path}/{table}")


def append(df: DataFrame, path: str, table: str) -> None:
    """Append a batch; metric values are rounded as they are written."""
    if table not in TABLES:
        raise ValueError(f"unknown table {table!r}")
    (round_metrics(df) if table == "metrics" else df).write.mode("append").parquet(f"{path}/{table}")


def compact_tags(spark: SparkSession, path: str, out: str) -> None:
    """Write the current tags as a fresh table without the overwritten values.

    Each keeps the time at which it was written, so an update that was stamped before the compaction but is appended
    after it still wins.
    """
    tags = current_tags(read(spark, path, "tags"))
    tags.select("id", "run_id", "key", "value", "written_at").write.mode("overwrite").parquet(out)


@dataclass
class Recorder:
    """Collects the few entries of one job and appends them at its end."""

    experiment_id: str
    rows: dict[str, list] = field(default_factory=lambda: {t: [] for t in TABLES})

    def _stamp(self) -> tuple[str, float]:
        now = time.time()
        return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}", now

    def run(self, name: str, parent_id: str | None = None) -> str:
        run_id, now = self._stamp()
        self.rows["runs"].append((run_id, name, parent_id, self.experiment_id, now))
        return run_id

    def experiment(self, name: str) -> None:
        self.rows["experiments"].append((self.experiment_id, name))

    def _entry(self, table: str, run_id: str, key: str, value) -> None:
        entry_id, now = self._stamp()
        self.rows[table].append((entry_id, run_id, key, value, now))

    def tag(self, run_id: str, key: str, value: str) -> None:
        self._entry("tags", run_id, key, value)

    def metric(self, run_id: str, key: str, value: float) -> None:
        self._entry("metrics", run_id, key, float(value))

    def prop(self, run_id: str, key: str, value) -> None:
        self._entry("properties", run_id, key, str(value))

    def obj(self, run_id: str, kind: str, url: str) -> None:
        self._entry("objects", run_id, kind, url)

    def flush(self, spark: SparkSession, path: str) -> None:
        create(spark, path)
        for table, rows in self.rows.items():
            if not rows:
                continue
            if "written_at" in TABLES[table]:
                rows = [(*r[:-1], datetime.fromtimestamp(r[-1], timezone.utc)) for r in rows]
            append(spark.createDataFrame(rows, TABLES[table]).coalesce(1), path, table)
        self.rows = {t: [] for t in TABLES}
