"""Interpolated modified Kneser-Ney bigram model, counted in Spark and kept as sorted arrays that workers memory-map.

Tokens are the lower-cased words of a text and one end; the first token's context is a begin mark. Three passes:

1. Word hashes are counted per slice of text, merged per hash range, and written as one sorted array of hashes with counts
   and running counts. A word's number is its place in that array.
2. Word pairs become 64-bit keys, counted per slice and merged per key range. Ranges hold about the same number of tokens
   and may cut through a frequent first word, so no word is a hot group. Each range is written as a sorted array of keys
   with counts; how many different words follow and precede each word is added up per vocabulary range.
3. Every worker maps the arrays and scores all texts by binary search.

The arrays lie in the shared folder, which must be a path that workers can map. Only table sizes reach the driver.
"""

from __future__ import annotations

import os
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialize, new_path
from .hashing import Words, from_planes, planes, slices

SLICE = 6 << 20
RANGE_BYTES = 12 << 20  # training text per range of words or pairs
END = np.uint64(0x1D8E4E27C47D124F)  # stands for the end of a text among the word hashes


def _local(path: str) -> str:
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the model's arrays need a shared folder that workers can map, not {parts.scheme}:")
    return parts.path


def _mapped(path: str, kind) -> np.ndarray:
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)


def _put(path: str, at: int, values: np.ndarray) -> None:
    """Write a part of an array that lies ready; a repeated task writes the same again."""
    with open(path, "r+b") as out:
        out.seek(at * values.itemsize)
        out.write(np.ascontiguousarray(values).tobytes())


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key, count = key[order], count[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    return key[first], np.add.reduceat(count, np.flatnonzero(first)) if len(key) else count


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of all rows, and the index of each row's first token (rows + 1 of them)."""
    words = Words(column, lower=True)
    rows = np.arange(len(words.count) + 1)
    out = np.empty(len(words.hash) + len(words.count), np.uint64)
    first = words.first + rows
    is_end = np.zeros(len(out), bool)
    is_end[first[1:] - 1] = True
    out[is_end] = END
    out[~is_end] = words.hash
    return out, first


def _word_counts(ranges: int):
    def run(batches):
        for batch in slices(batches, "text", SLICE):
            hashes, counts = np.unique(_tokens(batch.column("text"))[0], return_counts=True)
            part = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            cuts = np.searchsorted(part, np.arange(ranges + 1))
            held = [(r, a, b) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _, _ in held], pa.int32()), pa.array([planes(hashes[a:b]) for _, a, b in held], pa.binary()), pa.array([planes(counts[a:b].astype(np.int64)) for _, a, b in held], pa.binary())],
                ["part", "keys", "counts"],
            )

    return run


def _blobs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = table.column("keys").to_pylist(), table.column("counts").to_pylist()
    return _merged([from_planes(k, np.uint64) for k in keys], [from_planes(c, np.int64) for c in counts])


def _merge_words(table):
    keys, counts = _blobs(table)
    return pa.table(
        {
            "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
            "size": pa.array([len(keys)], pa.int64()),
            "total": pa.array([int(counts.sum())], pa.int64()),
            "keys": pa.array([planes(keys)], pa.binary()),
            "counts": pa.array([planes(counts)], pa.binary()),
        }
    )


class Model:
    """The arrays of a model folder and its totals."""

    def __init__(self, folder: str, words: int, tokens: int, texts: int, ranges: int):
        self.folder, self.words, self.tokens, self.texts, self.ranges = folder, words, tokens, texts, ranges
        self.starts: list[int] = []  # number of the first word of each vocabulary range
        self.pairs = 0
        self.discounts = self.lower_discounts = (0.0, 0.0, 0.0)
        self.lower_seen = self.begin_kinds = (0, 0, 0)
        self._held: dict = {}

    def __getstate__(self):
        return self.__dict__ | {"_held": {}}

    def array(self, name: str, kind=np.int64) -> np.ndarray:
        if name not in self._held:
            self._held[name] = _mapped(f"{self.folder}/{name}", kind)
        return self._held[name]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The words' numbers; -1 if unknown."""
        known = self.array("hash", np.uint64)
        if not len(known):
            return np.full(len(hashes), -1, np.int64)
        some, back = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(known, some), len(known) - 1)
        return np.where(known[at] == some, at, -1)[back]

    def keys(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Pair keys of numbered tokens; the number of words stands for the begin mark."""
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[first[:-1]] = self.words
        return before, before.astype(np.uint64) * np.uint64(self.words + 1) + tokens.astype(np.uint64)

    def range_of(self, keys: np.ndarray) -> np.ndarray:
        """The range of pairs that are known, not decreasing with the key, by running token counts."""
        a, b = np.divmod(keys, np.uint64(self.words + 1))
        a, b = a.astype(np.int64), b.astype(np.int64)
        sums, counts = self.array("sum"), self.array("count")
        begin = a == self.words
        a = np.where(begin, 0, a)
        low, width = np.where(begin, self.tokens, sums[a]), np.where(begin, self.texts, counts[a])
        share = sums[b] / self.tokens
        return np.minimum((low + width * share) / (self.tokens + self.texts) * self.ranges, self.ranges - 1).astype(np.int64)

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of pairs of known words."""
        some, back = np.unique(keys, return_inverse=True)
        part = self.range_of(some) if len(some) else np.zeros(0, np.int64)
        out = np.zeros(len(some), np.int64)
        for r in np.unique(part).tolist():
            a, b = np.searchsorted(part, [r, r + 1])
            if os.path.exists(f"{self.folder}/pairs-{r}"):
                known = self.array(f"pairs-{r}", np.uint64)
                at = np.minimum(np.searchsorted(known, some[a:b]), len(known) - 1)
                out[a:b] = np.where(known[at] == some[a:b], self.array(f"times-{r}", np.uint32)[at], 0)
        return out[back]

    def log10(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 of the probability of each numbered token after the one before it."""
        known = tokens >= 0
        safe = np.where(known, tokens, 0)
        uniform = 1 / (self.words + 1)
        if not self.words:
            return np.full(len(tokens), np.log10(uniform))
        lower_mass = sum(d * n for d, n in zip(self.lower_discounts, self.lower_seen)) / self.pairs
        times = np.where(known, self.array("cont")[safe], 0)
        lower = np.maximum(times - _discount(times, self.lower_discounts), 0) / self.pairs + lower_mass * uniform
        before, keys = self.keys(safe, first)
        begin = before == self.words
        context = np.empty_like(tokens)
        context[1:] = tokens[:-1]
        context[first[:-1]] = self.words
        seen = begin | (context >= 0)
        base = np.where(begin | ~seen, 0, before)
        total = np.where(begin, self.texts, self.array("count")[base])
        kinds = [np.where(begin, n0, self.array(f"n{i}")[base]) for i, n0 in zip((1, 2, 3), self.begin_kinds)]
        back = sum(d * n for d, n in zip(self.discounts, kinds)) / np.maximum(total, 1)
        both = known & seen
        count = np.zeros(len(tokens), np.int64)
        count[both] = self.pair_counts(keys[both])
        higher = np.maximum(count - _discount(count, self.discounts), 0) / np.maximum(total, 1)
        usable = seen & (total > 0)
        return np.log10(np.where(usable, higher + back * lower, lower))


def _discount(count: np.ndarray, by: tuple) -> np.ndarray:
    return np.array([0.0, *by])[np.minimum(count, 3)]


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many entries were seen once to four times.

    Where too little was seen to estimate one, a half, one and one and a half are used.
    """
    n1, n2, n3, n4 = n
    if not (n1 and n2):
        return (0.5, 1.0, 1.5)
    y = n1 / (n1 + 2 * n2)
    out = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(out))


def _place_words(folder: str, starts: list[int], sums: list[int]):
    def run(batches):
        for batch in batches:
            for part, keys, counts in zip(*[batch.column(c).to_pylist() for c in ("part", "keys", "counts")]):
                counts = from_planes(counts, np.int64)
                _put(f"{folder}/hash", starts[part], from_planes(keys, np.uint64))
                _put(f"{folder}/count", starts[part], counts)
                _put(f"{folder}/sum", starts[part], sums[part] + np.cumsum(counts) - counts)
            yield pa.RecordBatch.from_arrays([batch.column("part")], ["part"])

    return run


def _pair_counts(model: Model):
    def run(batches):
        for batch in slices(batches, "text", SLICE):
            hashes, first = _tokens(batch.column("text"))
            _, keys = model.keys(model.numbers(hashes), first)
            keys, counts = np.unique(keys, return_counts=True)
            part = model.range_of(keys)
            cuts = np.flatnonzero(np.diff(part)) + 1
            parts = [p for p in np.split(np.arange(len(keys)), cuts) if len(p)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[p[0]] for p in parts], pa.int32()), pa.array([planes(keys[p]) for p in parts], pa.binary()), pa.array([planes(counts[p].astype(np.int64)) for p in parts], pa.binary())],
                ["part", "keys", "counts"],
            )

    return run


def _merge_pairs(model: Model):
    """Write a range of pairs; return, by vocabulary range, how many words follow and precede its words."""

    def run(table):
        part = table.column("part")[0].as_py()
        keys, counts = _blobs(table)
        for name, values in ((f"pairs-{part}", keys), (f"times-{part}", np.minimum(counts, 2**32 - 1).astype(np.uint32))):
            path = f"{model.folder}/{name}"
            with open(f"{path}.{os.getpid()}.{os.urandom(4).hex()}", "wb") as out:
                out.write(values.tobytes())
            os.replace(out.name, path)
        a, b = np.divmod(keys, np.uint64(model.words + 1))
        rows = []
        kinds = np.minimum(counts, 3)
        after, at = np.unique(a.astype(np.int64), return_index=True)
        follow = [np.add.reduceat((kinds == i).astype(np.int64), at) for i in (1, 2, 3)]
        before, times = np.unique(b.astype(np.int64), return_counts=True)
        for kind, numbers, values in (("after", after, follow), ("before", before, [times])):
            home = np.searchsorted(model.starts, numbers, "right") - 1
            for chosen in np.split(np.arange(len(numbers)), np.flatnonzero(np.diff(home)) + 1):
                if len(chosen):
                    rows.append((int(home[chosen[0]]), kind, planes(numbers[chosen]), [planes(v[chosen].astype(np.int64)) for v in values]))
        ones = [int((counts == i).sum()) for i in (1, 2, 3, 4)]
        rows.append((-1, "totals", planes(np.array([len(keys), *ones])), []))
        return pa.table({"home": pa.array([r[0] for r in rows], pa.int32()), "kind": pa.array([r[1] for r in rows]), "numbers": pa.array([r[2] for r in rows], pa.binary()), "values": pa.array([r[3] for r in rows], pa.list_(pa.binary()))})

    return run


def _place_neighbours(model: Model):
    """Write what follows and precedes the words of a vocabulary range."""

    def run(table):
        home = table.column("home")[0].as_py()
        if home < 0:
            totals = np.sum([from_planes(n, np.int64) for n in table.column("numbers").to_pylist()], axis=0)
            return _totals(home, totals[0], totals[1:], [0, 0, 0])
        low = model.starts[home]
        high = model.starts[home + 1] if home + 1 < len(model.starts) else model.words
        sums = np.zeros((4, high - low), np.int64)
        begin = np.zeros(3, np.int64)
        for kind, numbers, values in zip(*[table.column(c).to_pylist() for c in ("kind", "numbers", "values")]):
            numbers, values = from_planes(numbers, np.int64), [from_planes(v, np.int64) for v in values]
            words = numbers < model.words
            for i, v in enumerate(values):
                row = 0 if kind == "before" else i + 1
                sums[row, numbers[words] - low] += v[words]
                if kind == "after":
                    begin[i] += v[~words].sum()
        for name, values in zip(("cont", "n1", "n2", "n3"), sums):
            _put(f"{model.folder}/{name}", low, values)
        return _totals(home, int((sums[0] >= 3).sum()), [int((sums[0] == i).sum()) for i in (1, 2, 3, 4)], begin)

    return run


def _totals(home, first, ones, begin):
    whole = lambda v: [int(x) for x in v]
    return pa.table({"home": pa.array([home], pa.int32()), "first": pa.array([int(first)], pa.int64()), "ones": pa.array([whole(ones)], pa.list_(pa.int64())), "begin": pa.array([whole(begin)], pa.list_(pa.int64()))})


def fit(texts: DataFrame) -> Model:
    """A model of all texts of `texts` (text). Nulls are empty texts; without rows every token is unknown."""
    spark = texts.sparkSession
    path = new_path(spark, "language-model")
    folder = _local(path)
    size, rows = texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    ranges = (size or 0) // RANGE_BYTES + 1
    counted = texts.mapInArrow(_word_counts(ranges), "part int, keys binary, counts binary")
    words = materialize(
        counted.groupBy("part").applyInArrow(_merge_words, "part int, size bigint, total bigint, keys binary, counts binary"), "words"
    )
    sizes = {r["part"]: (r["size"], r["total"]) for r in words.select("part", "size", "total").collect()}
    starts, sums = [0], [0]
    for r in range(ranges):
        n, t = sizes.get(r, (0, 0))
        starts.append(starts[-1] + n)
        sums.append(sums[-1] + t)
    os.makedirs(folder, exist_ok=True)
    model = Model(folder, starts[-1], sums[-1], rows, ranges)
    model.starts = starts[:-1]
    for name in ("hash", "count", "sum", "cont", "n1", "n2", "n3"):
        with open(f"{folder}/{name}", "wb") as out:
            out.truncate(8 * model.words)
    if not model.words:
        return model
    words.mapInArrow(_place_words(folder, starts, sums), "part int").write.format("noop").mode("overwrite").save()
    pairs = texts.mapInArrow(_pair_counts(model), "part int, keys binary, counts binary")
    found = pairs.groupBy("part").applyInArrow(_merge_pairs(model), "home int, kind string, numbers binary, values array<binary>")
    found = found.groupBy("home").applyInArrow(_place_neighbours(model), "home int, first bigint, ones array<bigint>, begin array<bigint>")
    add = lambda rows, of: [sum(x) for x in zip(*[of(r) for r in rows])]
    rows = found.collect()
    own, homes = [r for r in rows if r["home"] < 0], [r for r in rows if r["home"] >= 0]
    model.pairs = sum(r["first"] for r in own)
    model.discounts = discounts(add(own, lambda r: r["ones"]))
    lower = add(homes, lambda r: r["ones"])
    model.lower_discounts = discounts(lower)
    model.lower_seen = (lower[0], lower[1], sum(r["first"] for r in homes))
    model.begin_kinds = tuple(add(homes, lambda r: r["begin"]))
    return model


def _scores(model: Model, keep: list[str]):
    def run(batches):
        for batch in slices(batches, "text", SLICE):
            hashes, first = _tokens(batch.column("text"))
            tokens = model.numbers(hashes)
            known = tokens >= 0
            counts = np.where(known, model.array("count")[np.where(known, tokens, 0)], 0) if model.words else np.zeros(len(tokens), np.int64)
            base = np.log10((counts + 1) / (model.tokens + model.words + 1))
            at = first[:-1]
            total = lambda v, kind: pa.array(np.add.reduceat(v, at), kind)
            out = [pa.array(np.diff(first), pa.int64()), total(known.astype(np.int64), pa.int64()), total(base, pa.float64()), total(model.log10(tokens, first), pa.float64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *out], [*keep, "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs` with n_tokens, n_known, base_score and score (both log10) of `text`."""
    types = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keep], "n_tokens bigint, n_known bigint, base_score double, score double"])
    return docs.select(*keep, "text").mapInArrow(_scores(model, keep), schema)


def held_out_scores(docs: DataFrame, fold: int = 7, held: int = 2) -> DataFrame:
    """Score all rows of `docs` (doc_id, text; others are ignored) by a model of those outside the held-out fold.

    The fold is crc32(doc_id as text) modulo `fold`; a null doc_id counts as an empty text. Null texts are empty, which
    leaves the end token. Repeated rows count as often as they come. An empty table gives an empty result.
    """
    mark = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % fold == held
    docs = docs.select("doc_id", mark.alias("held_out"), "text")
    model = fit(docs.where(~F.col("held_out")).select("text"))
    out = score(docs, model, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
