"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A table may be broadcast up to this many rows; its size is always counted first.
BROADCAST_ROWS = 200_000
# A key is heavy from one row in HEAVY on, so there are at most HEAVY of them; it gets salts as if all rows had HEAVY.
HEAVY = 1_000


def rows_up_to(df: DataFrame, limit: int) -> int:
    """Number of rows, counting no further than limit + 1."""
    return df.limit(limit + 1).count()


def broadcast_up_to(table: DataFrame, rows: int, limit: int | None = None) -> DataFrame:
    """A table of `rows` rows as a side of a join: beyond the limit the join is by sorting, whatever the files weigh.

    Spark goes by the size of files. Ids take a few bytes a row there and some 60 to 100 in a broadcast table, which is
    built on the driver and held by it, several for one join of three tables. Up to the limit the planner chooses.
    """
    return table if rows <= (BROADCAST_ROWS if limit is None else limit) else table.hint("merge")


def heavy_keys(counted: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """(*keys, _salts) of the heavy keys of a table of counts, a row per key: at most HEAVY rows, null keys left out."""
    total = counted.agg(F.sum(n)).first()[0] or 0
    present = counted.where(F.col(n) * HEAVY >= total)
    for k in keys:
        present = present.where(F.col(k).isNotNull())
    rows = present.select(*keys, F.ceil(F.col(n) * HEAVY / F.lit(max(total, 1))).cast("int").alias("_salts")).collect()
    return counted.sparkSession.createDataFrame(rows, present.select(*keys, F.lit(1).alias("_salts")).schema)


def row_salt(df: DataFrame, salts: Column) -> Column:
    """A number from 0 to salts - 1 by the row's values and its partition: the same when a task runs again in any order.

    Equal rows share a salt within a partition only.
    """
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), salts).cast("int")


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = 5_000_000,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Join to a table that is unique on `keys`.

    A table of counted, small size is broadcast and the big side stays unshuffled. Beyond that both sides shuffle, and
    every frequent key is spread over several salts. Which keys are frequent is told by `heavy` (see `heavy_keys`), as a
    fitted table knows them; otherwise `df` is counted once for keys with more than `rows_per_task` rows, of which there
    are at most rows / rows_per_task. A stream is never counted: without `heavy` it is joined as it is.
    """
    if rows_up_to(table, broadcast_rows) <= broadcast_rows:
        return df.join(F.broadcast(table), keys, how)
    if heavy is None and df.isStreaming:
        return df.join(table, keys, how)
    if heavy is None:
        frequent = (
            df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > rows_per_task)
            .select(*keys, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))
        )
        if rows_up_to(frequent, broadcast_rows) > broadcast_rows:
            raise ValueError("rows_per_task is too small: too many keys count as frequent")
    else:
        frequent = heavy
    frequent = F.broadcast(frequent)
    salts = F.coalesce("_salts", F.lit(1))
    spread = table.join(frequent, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    # a null key matches nothing, so its rows may go anywhere
    no_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    salted = df.join(frequent, keys, "left")
    salted = salted.withColumn("_salt", row_salt(df, F.when(no_key, F.lit(4096)).otherwise(salts))).drop("_salts")
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")


def rows_of_tasks(df: DataFrame) -> tuple[int, int]:
    """Rows of the largest task and of all, without reading their columns."""
    sizes = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    most, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return most or 0, total or 0


def dealt_out(df: DataFrame, rows: tuple[int, int] | None = None) -> DataFrame:
    """The rows over all cores, for work that reads them several times, if one task holds more than two cores' share.

    A table of many partitions of like size stays as it is. `rows` is what `rows_of_tasks` gives, if it is known.
    """
    most, total = rows or rows_of_tasks(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if total and most > 2 * total / cores else df
