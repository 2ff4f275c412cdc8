"""License notices in texts: MinHash bands over text windows retrieve templates, shingle containment verifies them.

Words are runs of letters and digits, lower-cased; shingles are five words. For a template of T shingles the text is read
in windows of T + s - 1 shingles that start every s, with s a quarter of the template's words: any stretch as long as the
template lies whole in one window. A window that holds at least 0.8 of a template's shingles then has a Jaccard similarity
above 0.4 with it, and shares one of 30 single-hash bands with a chance above 1 - 1e-6. What the bands retrieve is decided by
counting shingles. A template of one to four words has a single shingle, all its words; it is found where these words stand
in a row, compared as text.

Templates are a table of bounded size (`MAX_SHINGLES` in all, checked) and are broadcast. Windows without any shingle of a
template are left out before they are hashed, which loses nothing: their containment is 0. All steps are DataFrame functions,
and texts are not shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
THRESHOLD = 80  # hundredths of a template's shingles
BANDS = 30
MAX_SHINGLES = 100_000

# Notices as they are commonly used: fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "rights-reserved": "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher",
}

# Notices below five words, which are looked for as text.
SHORT_TEMPLATES = {"rights-reserved-short": "All rights reserved."}


def builtin_templates(spark: SparkSession, short: bool = False) -> DataFrame:
    """(template_id, template): the notices above, with those below five words on demand."""
    notices = TEMPLATES | SHORT_TEMPLATES if short else TEMPLATES
    rows = F.array(*[F.struct(F.lit(k).alias("template_id"), F.lit(v).alias("template")) for k, v in notices.items()])
    return spark.range(1).select(F.explode(rows).alias("t")).select("t.*")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _shingles(words: Column) -> Column:
    """Hashes of all shingles of a column of words, in order."""
    n = F.size(words)
    one = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)])
    none = F.array().cast("array<bigint>")
    return F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(0), n - SHINGLE), one)).otherwise(none)


def _bands(shingles: Column) -> Column:
    """The smallest value of each band's hash over the shingles."""
    least = lambda b: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(b))))
    return F.array(*[F.struct(F.lit(b).alias("band"), least(b).alias("value")) for b in range(BANDS)])


def prepared(templates: DataFrame) -> DataFrame:
    """(template_id, set, size, every, width): each template's shingles, and its windows' stride and shingles.

    Templates with fewer than five words have no such shingle and are left to `_short`; nulls are left out.
    """
    words = templates.where("template_id is not null").select("template_id", _words(F.col("template")).alias("words"))
    known = words.select("template_id", F.array_distinct(_shingles(F.col("words"))).alias("set"), F.size("words").alias("n")).where("size(set) > 0")
    every = F.greatest(F.floor(F.col("n") / 4), F.lit(1)).cast("int")
    return known.select("template_id", "set", F.size("set").alias("size"), every.alias("every"), (F.col("n") - SHINGLE + every).alias("width"))


def _short(templates: DataFrame) -> DataFrame:
    """(template_id, line, n): the words of the templates with fewer than five of them, one space between."""
    words = templates.where("template_id is not null").select("template_id", _words(F.col("template")).alias("words"))
    return words.where(F.size("words").between(1, SHINGLE - 1)).select("template_id", F.array_join("words", " ").alias("line"), F.size("words").alias("n")).distinct()


def _short_hits(held: DataFrame, lines: list) -> DataFrame:
    """(doc_id, template_id, start, share): every place in `held` (doc_id, words) where a short template stands."""
    known = F.array(*[F.struct(F.lit(r["template_id"]).alias("template_id"), F.lit(r["line"]).alias("line")) for r in lines])
    texts = F.array(*[F.lit(t) for t in sorted({r["line"] for r in lines})])
    parts = []
    for n in sorted({r["n"] for r in lines}):
        line = lambda i: F.concat_ws(" ", *[F.get("words", i + j) for j in range(n)])  # noqa: E731, B023
        # a generated column, as in scan()
        runs = held.where(F.size("words") >= n).select("doc_id", F.explode(F.array(F.transform(F.sequence(F.lit(0), F.size("words") - n), line))).alias("runs"))
        runs = runs.where(F.arrays_overlap("runs", texts)).select("doc_id", F.posexplode("runs").alias("start", "run")).where(F.array_contains(texts, F.col("run")))
        parts.append(runs.select("doc_id", "start", "run", F.explode(known).alias("t")).where(F.col("run") == F.col("t.line")))
    return reduce(DataFrame.union, parts).select("doc_id", "t.template_id", "start", F.lit(1.0).alias("share"))


def scan(docs: DataFrame, templates: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, template_id, containment, first_word, n_windows): the templates found in `docs` (doc_id, text).

    `containment` is the highest share of the template's shingles in one window, `first_word` the place (from 0) of the
    first window that holds `threshold` hundredths, `n_windows` how many do. Null and short texts hold nothing; rows of one
    doc_id are one document, a null doc_id included; other columns are ignored. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    kept = prepared(templates)
    lines = _short(templates).collect()
    total = (kept.agg(F.sum("size")).first()[0] or 0) + len(lines)
    if total > MAX_SHINGLES:
        raise ValueError(f"the templates have {total} shingles; {MAX_SHINGLES} may be broadcast")
    rows = kept.collect()
    grids = sorted({(r["every"], r["width"]) for r in rows})
    every_shingle = sorted({h for r in rows for h in r["set"]})
    schema = "doc_id bigint, template_id string, containment double, first_word bigint, n_windows bigint"
    if not rows and not lines:
        return spark.range(0).select(*[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in schema.split(", ")])
    # generated columns: filters on them are not moved below, where they would compute the words again for every shingle
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.explode(F.array(_words(F.col("text")))).alias("words"))
    hits = [_long_hits(read, kept, grids, every_shingle, threshold)] if rows else []
    hits += [_short_hits(read, lines)] if lines else []
    return reduce(DataFrame.union, hits).groupBy("doc_id", "template_id").agg(
        F.max("share").alias("containment"), F.min("start").cast("bigint").alias("first_word"), F.count_distinct("start").alias("n_windows")
    )


def _long_hits(held: DataFrame, kept: DataFrame, grids: list, every_shingle: list, threshold: int) -> DataFrame:
    """(doc_id, template_id, start, share): the windows of `held` (doc_id, words) with enough of a template's shingles."""
    ours = F.array(*[F.lit(h) for h in every_shingle])
    held = held.select("doc_id", F.explode(F.array(_shingles(F.col("words")))).alias("h")).where(F.arrays_overlap("h", ours))
    grid = F.array(*[F.struct(F.lit(e).alias("every"), F.lit(w).alias("width")) for e, w in grids])
    held = held.select("doc_id", "h", F.explode(grid).alias("g"))
    held = held.select("doc_id", "h", "g", F.explode(F.sequence(F.lit(0), F.size("h") - 1, F.col("g.every"))).alias("start"))
    window = F.slice("h", F.col("start") + 1, F.col("g.width"))
    windows = held.select("doc_id", "g", "start", window.alias("window")).where(F.arrays_overlap("window", ours))
    banded = windows.withColumn("b", F.explode(_bands(F.col("window"))))
    known = kept.withColumn("g", F.struct("every", "width")).withColumn("b", F.explode(_bands(F.col("set")))).select("template_id", "set", "size", F.col("g").alias("tg"), F.col("b").alias("tb"))
    met = banded.join(F.broadcast(known), (F.col("b") == F.col("tb")) & (F.col("g") == F.col("tg")))
    share = F.size(F.array_intersect("window", "set"))
    met = met.withColumn("shared", share).where(100 * F.col("shared") >= threshold * F.col("size"))
    return met.select("doc_id", "template_id", "start", (F.col("shared") / F.col("size")).alias("share"))
