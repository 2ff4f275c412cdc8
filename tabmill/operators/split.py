"""Seeded 80 / 10 / 10 split into a `stage` column."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket, row_text
from ..functions.selection import copies, hash_cuts
from ..schema import RoleSchema

SEED = 42


def hash_stage(key: Column, seed: int = SEED) -> Column:
    """Stage of a row from its id alone: 8 of 10 buckets train, one valid, one test."""
    by_bucket = F.lit(["train"] * 8 + ["valid", "test"])
    # an index instead of comparisons, so that the hash is computed once per row
    return by_bucket[hash_bucket(key, seed, 10).cast("int")]


def split_sizes(rows: int) -> dict[str, int]:
    """Held-out rows are rounded up, and of those the test rows are rounded up."""
    held_out = math.ceil(0.2 * rows)
    test = math.ceil(0.5 * held_out)
    return {"train": rows - held_out, "valid": held_out - test, "test": test}


def split(df: DataFrame, schema: RoleSchema, seed: int = SEED, exact: bool = False) -> DataFrame:
    """Add `stage`; where the target is a feature as well, also a raw copy of it as the label.

    The default needs no pass and no shuffle. `exact` meets the sizes to the row: the hashes at the
    two boundaries are selected first, and the split is then a projection as well.
    """
    key = schema.primary_id
    if not exact:
        # rows without an id go by their content
        stage = F.when(F.col(key).isNull(), hash_stage(row_text(df), seed)).otherwise(hash_stage(F.col(key), seed))
        out = df.withColumn("stage", stage)
    else:

        def boundaries(rows):
            sizes = split_sizes(rows)
            return sorted({sizes["train"], sizes["train"] + sizes["valid"]})

        cuts = sorted(hash_cuts(df, key, seed, boundaries), key=lambda cut: cut.rank)
        first, last = cuts[0], cuts[-1]
        stage = F.when(first.keep, "train").when(last.keep, "valid").otherwise("test")
        tied = [c for c in (first, last) if c.same is not None]
        plain = df
        for c in tied:
            plain = plain.where(~F.coalesce(c.same, F.lit(False)))
        out = plain.withColumn("stage", stage)
        # identical rows on a boundary are dealt by number
        one_group = len(tied) == 2 and first.value == last.value
        if one_group:
            shares = [(first, {"train": first.taken, "valid": last.taken - first.taken, "test": last.equal - last.taken})]
        else:
            after = {id(first): "valid", id(last): "test"}
            before = {id(first): "train", id(last): "valid"}
            shares = [(c, {before[id(c)]: c.taken, after[id(c)]: c.equal - c.taken}) for c in tied]
        for c, share in shares:
            for name, n in share.items():
                if n:
                    out = out.unionByName(copies(df.where(c.same), n).withColumn("stage", F.lit(name)))
    return out.withColumn(schema.label, F.col(schema.target)) if schema.target_is_feature else out


def stage_sizes(df: DataFrame) -> DataFrame:
    """Rows and feature columns per stage."""
    columns = len([c for c in df.columns if c != "stage"])
    return df.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(columns).cast("bigint").alias("n_columns")
    )
