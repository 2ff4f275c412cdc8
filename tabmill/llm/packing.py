"""Best-fit decreasing packing of token pieces into sequences.

Texts are tokenized between blanks: the tokenizer never joins across white space, so the ids of a stretch without blanks
are looked up in a bounded table of those seen before. Pieces are dealt at random into shards of bounded size, and each
shard is packed best-fit decreasing: a segment tree over remaining capacities holds how many open bins have each, and
finds the tightest bin that takes a piece in logarithmic time. Bins that stay open go into a second round of larger
shards, in which a bin counts as one piece, so that the shards do not cost whole sequences.
"""

from __future__ import annotations

import zlib
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialize

CAPACITY = 4096
SHARD_PIECES = 8000
CACHE = 400_000  # stretches, and parts of them, whose ids a worker remembers at most
STRETCH = 64  # longer ones are not remembered
# what the tokenizer cuts a stretch into; for letters up to here it lowers and cuts as Python does
LAST = "\u024f"
PLAIN = regex.compile(f"[!-~\u00a1-{LAST}]+")
PART = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class Encoder:
    """ids of texts by a tokenizer that lowers, drops white space, and knows bytes as printable letters."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printed]
        self.letters = {b: b for b in printed} | {b: 256 + i for i, b in enumerate(rest)}
        numbers = np.arange(max(self.tokenizer.get_vocab().values()) + 1, dtype="<u4").tobytes()
        self.numbers = [numbers[i : i + 4] for i in range(0, len(numbers), 4)]
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        printed = part.encode().decode("latin-1").translate(self.letters)
        ids = b"".join([self.numbers[t.id] for t in self.model.tokenize(printed)])
        if len(part) <= STRETCH:
            if len(self.parts) >= CACHE:
                self.parts.clear()
            self.parts[part] = ids
        return ids

    def _stretch(self, stretch: str) -> bytes:
        parts, low = self.parts, stretch.lower()
        if low.isalpha() and max(low) <= LAST:  # one part
            ids = parts.get(low) or self._part(low)
        elif PLAIN.fullmatch(stretch) and "<|" not in stretch:
            ids = b"".join([parts.get(p) or self._part(p) for p in PART.findall(low)])
        else:
            ids = np.array(self.tokenizer.encode(stretch, add_special_tokens=False).ids, "<u4").tobytes()
        if len(stretch) <= STRETCH:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[stretch] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of the text."""
        get, stretch = self.known.get, self._stretch
        return b"".join([ids if (ids := get(s)) is not None else stretch(s) for s in text.replace("\n", " ").replace("\t", " ").split(" ")])


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The worker's encoder, which later tasks use again."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _pieces(path: str, capacity: int, end: int):
    def run(batches):
        encoder = _encoder(path)
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encoder.encode(text or "") + last
                for piece, a in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[a : a + 4 * capacity]
                    rows.append((doc, piece, a // 4, len(part) // 4, zlib.crc32(part), part))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            )

    return run


class OpenBins:
    """A segment tree over remaining capacities, with the open bins of each."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)  # bins below each node
        self.bins: list[list[int]] = [[] for _ in range(self.size)]

    def put(self, bin_: int, room: int) -> None:
        self.bins[room].append(bin_)
        at = room + self.size
        while at:
            self.tree[at] += 1
            at >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The bin with the least room that is at least `length`, and its room."""
        at = length + self.size
        if not self.tree[at]:
            while at > 1 and (at & 1 or not self.tree[at + 1]):  # up to a right neighbour that has bins
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        room = at - self.size
        while at:
            self.tree[at] -= 1
            at >>= 1
        return self.bins[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (at most `capacity`)."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins, numbers = OpenBins(capacity), count()
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = open_bins.take(need)
        bin_, room = found if found else (next(numbers), capacity)
        bins[i], offsets[i] = bin_, capacity - room
        if room > need:
            open_bins.put(bin_, room - need)
    return bins, offsets


def _packed(capacity: int):
    def run(table):
        table = table.sort_by([("tie", "ascending")])
        bins, offsets = best_fit_decreasing(table.column("length").to_numpy(), capacity)
        return pa.table({"item": table.column("item"), "bin": pa.array(bins), "offset": pa.array(offsets), "shard": table.column("shard"), "length": table.column("length")})

    return run


def _round(items: DataFrame, shards: int, seed: int, capacity: int) -> DataFrame:
    """Pack `items` (item, length) in random shards: (item, bin, offset, shard, length)."""
    # the first shuffle of the item's text decides the shard, and ties of length
    tie = F.xxhash64("item", F.lit(seed))
    dealt = items.withColumns({"tie": tie, "shard": F.pmod(tie, F.lit(shards))})
    return dealt.groupBy("shard").applyInArrow(_packed(capacity), "item string, bin bigint, offset bigint, shard bigint, length bigint")


def tokenize(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids) of `docs` (doc_id, text): the text's ids and an end, cut into pieces.

    `tokenizer` is the path of a tokenizer file that is on every worker. Null texts are empty and leave the end alone.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_pieces(tokenizer, capacity, end), schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """`pieces` (with doc_id, piece, length) with `sequence_id` and `offset`.

    Repeated rows are packed as often as they come; rows with a null doc_id as any others. Full pieces are sequences of
    their own and go through no shard. An empty table gives an empty result.
    """
    # rows that are equal in all but their number get different items
    keyed = materialize(pieces.withColumn("item", F.concat_ws("-", F.monotonically_increasing_id(), "doc_id", "piece")), "pieces")
    full = keyed.where(F.col("length") == capacity).select("item", F.concat(F.lit("f-"), "item").alias("sequence"), F.lit(0).cast("bigint").alias("offset"))
    items = keyed.where(F.col("length") < capacity).select("item", "length")
    shards = -(-(items.count() or 1) // shard_pieces)
    first = materialize(_round(items, shards, 1, capacity), "packed")
    name = F.concat_ws("-", F.lit("b"), "shard", "bin")
    bins = first.groupBy("shard", "bin").agg(F.sum("length").alias("used")).select(name.alias("item"), F.col("used").alias("length"))
    loose = bins.where(F.col("length") <= capacity * 15 // 16)
    again = _round(loose, -(-shards // 16), 2, capacity).select(
        F.col("item").alias("sequence"), F.concat_ws("-", F.lit("c"), "shard", "bin").alias("into"), F.col("offset").alias("more")
    )
    placed = first.select("item", name.alias("sequence"), "offset").join(again, "sequence", "left")
    placed = placed.select("item", F.coalesce("into", "sequence").alias("sequence"), (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"))
    # numbers of their own for full pieces, and for the bins of either round by shard and bin
    at = lambda i: F.split_part("sequence", F.lit("-"), F.lit(i)).cast("bigint")
    kind = F.when(F.col("sequence").startswith("b"), 0).otherwise(1)
    number = F.when(F.col("sequence").startswith("f"), at(2) * 4 + 2).otherwise((at(2) * 2**31 + at(3)) * 4 + kind).cast("bigint").alias("sequence_id")
    return keyed.join(placed.union(full), "item").select(*pieces.columns, number, "offset")
