"""Ranks and running values over any group size: no window runs over a whole hot group."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import materialize
from .selection import interval_of, sample_splitters

ROWS_PER_PIECE = 1_000_000
FAN = 1_024  # pieces that one window runs over


def range_pieces(df: DataFrame, order: list[str], rows_per_piece: int = ROWS_PER_PIECE) -> tuple[DataFrame, int]:
    """The rows with `_piece`, the number of their interval along the order columns, written; and how many there are.

    The number of intervals follows from the rows. They cut through groups, so even a group with most of the rows is
    spread over them. Bounds come from a sample of 100 rows per interval, which keeps an interval below twice
    `rows_per_piece` unless rows are equal in all order columns.
    """
    pieces = max(1, math.ceil(df.count() / rows_per_piece))
    cut = df.repartitionByRange(pieces, *order).withColumn("_piece", F.spark_partition_id())
    return materialize(cut, "pieces"), pieces


def _carried(lows: DataFrame, pieces: int, fan: int) -> DataFrame:
    """(_group, _piece, _low) with `_carry`, the minimum of the earlier pieces of the group.

    Of more pieces than `fan`, each `fan` are reduced to one first, and so on: no window holds more than `fan` rows.
    """
    if pieces <= fan:
        along = Window.partitionBy("_group").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        return lows.withColumn("_carry", F.min("_low").over(along))
    branch = F.struct("_group", F.floor(F.col("_piece") / fan).alias("_piece"))
    leaves = lows.withColumn("_branch", branch)
    above = leaves.groupBy("_branch").agg(F.min("_low").alias("_low")).select("_branch.*", "_low")
    above = _carried(above, math.ceil(pieces / fan), fan).select(
        F.struct("_group", "_piece").alias("_branch"), F.col("_carry").alias("_above")
    )
    along = Window.partitionBy("_branch").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    inside = leaves.withColumn("_inside", F.min("_low").over(along)).join(above, "_branch")
    return inside.select("_group", "_piece", "_low", F.least("_inside", "_above").alias("_carry"))


def running_min_before(
    df: DataFrame,
    group: list[str],
    order: list[str],
    value: str,
    out: str,
    piece: Column | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
    fan: int = FAN,
) -> DataFrame:
    """Minimum of the earlier rows of the group, null for the first, plus `group_<out>` over all rows. Null is a group.

    `piece` cuts each group along its order (for instance a day for a timestamp) and must not
    decrease along it; without it the rows are cut into as many pieces as they ask for. Pieces are reduced to one row
    each before the running minimum is carried across them, and the row-level window only runs inside a piece.
    """
    # own pieces are as many as the caller makes them
    cut, pieces = range_pieces(df, order, rows_per_piece) if piece is None else (df.withColumn("_piece", piece), 0)
    # inside a struct nulls are equal to each other
    cut = cut.withColumn("_cell", F.struct(F.struct(*group).alias("_group"), F.col("_piece")))
    lows = cut.groupBy("_cell").agg(F.min(value).alias("_low")).select("_cell.*", "_low")
    whole = lows.groupBy("_group").agg(F.min("_low").alias(f"group_{out}"))
    carried = _carried(lows, pieces, fan).join(whole, "_group")
    carried = carried.select(F.struct("_group", "_piece").alias("_cell"), "_carry", f"group_{out}")
    inside = Window.partitionBy("_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_inside", F.min(value).over(inside))
        .join(carried, "_cell")
        .withColumn(out, F.least("_inside", "_carry"))
        .select(*df.columns, out, f"group_{out}")
    )


def alphabetical_index(values: DataFrame, column: str, out: str, fanout: int = 64) -> DataFrame:
    """0-based position of each distinct value, numbered per interval and shifted by the counts before it."""
    splitters = sample_splitters(values, column, fanout)
    pieced = values.where(F.col(column).isNotNull()).withColumn("_piece", interval_of(F.col(column), splitters))
    counts = {r["_piece"]: r["count"] for r in pieced.groupBy("_piece").count().collect()}
    start, starts = 0, []
    for piece in range(len(splitters) + 1):
        starts.append(start)
        start += counts.get(piece, 0)
    inside = Window.partitionBy("_piece").orderBy(column)
    offset = F.lit(starts)[F.col("_piece")]
    return pieced.withColumn(out, (offset + F.row_number().over(inside) - 1).cast("bigint")).drop("_piece")
