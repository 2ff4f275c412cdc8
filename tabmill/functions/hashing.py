"""Keyed hashes: stable under repartitioning, retries and appends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_hash(key: Column, seed: int) -> Column:
    """md5 of `key-seed` as 32 hex digits."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"-{seed}")))


def hex_to_long(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("bigint")


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the first 8 hex digits of the keyed hash."""
    return hex_to_long(F.substring(keyed_hash(key, seed), 1, 8)) % buckets


def row_text(df, columns=None) -> Column:
    """All columns of a row as one text with lengths, so that fields cannot run into each other."""
    parts = []
    for c in columns or df.columns:
        text = F.col(c).cast("string")
        parts.append(
            F.when(text.isNull(), F.lit("-;")).otherwise(
                F.concat(F.length(text).cast("string"), F.lit(":"), text, F.lit(";"))
            )
        )
    return F.concat(*parts)
