"""Removal of passages that an earlier document has as well, by repeated-phrase automata.

1. Every window of `size` words is hashed; per hash bucket the smallest document with the window, its owner, is found.
   This confirms which documents own passages that recur, and in which shards of the corpus they recur.
2. The corpus is dealt into shards by document. Each shard gets the texts of the owners it needs, finds the passages that
   its documents share with them, and compiles an Aho-Corasick automaton from blocks of (size + 1) / 2 words laid end to end
   along the passages: every window of a passage holds one whole block.
3. All documents of the shard are streamed through the automaton. A hit is extended word by word within the passage, and
   if it covers a whole window of an earlier document, its words are marked.

Hashes only propose; what is removed has been compared as text. A document is in one shard, so no shard grows with a
popular passage: its owner's text is handed to each shard once. Both the hash buckets and the shards are sized by bytes.
"""

from __future__ import annotations

import io
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import Words, from_planes, planes, slices

SIZE = 13
BUCKET_BYTES = 8 << 20  # text whose windows go to one bucket
SHARD_BYTES = 6 << 20  # text streamed through one automaton


def _width(buckets: int) -> int:
    """The bytes that tell hashes of one bucket apart: 5 low ones, and those of the high 24 bits divided by `buckets`."""
    return 5 + (((2**24 - 1) // buckets).bit_length() + 7) // 8


def _windows(size: int, buckets: int):
    """Per slice and bucket: the windows' hashes, without what the bucket tells, and which documents have how many of them, in order."""
    width = _width(buckets)

    def run(batches):
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            hashes, at = words.shingles(size)
            row = words.rows()[at]
            high, bucket = np.divmod(hashes >> np.uint64(40), np.uint64(buckets))
            hashes, bucket = hashes & np.uint64(2**40 - 1) | high << np.uint64(40), bucket.astype(np.int64)
            order = np.lexsort((row, bucket))
            hashes, row, bucket = hashes[order], row[order], bucket[order]
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            numbers, low, docs, counts = [], [], [], []
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for part in np.split(np.arange(len(bucket)), cuts) if len(bucket) else ():
                own, n = np.unique(row[part], return_counts=True)
                numbers.append(bucket[part[0]])
                low.append(planes(hashes[part])[: width * len(part)])
                docs.append(ids[own].astype(np.int64).tobytes())
                counts.append(n.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), *[pa.array(x, pa.binary()) for x in (low, docs, counts)]], ["bucket", "low", "docs", "counts"]
            )

    return run


def _owners(shards: int, width: int):
    """The owners of a bucket's recurring windows, with the marks of the documents in which they recur."""

    def run(table):
        hashes, docs = [], []
        for low, doc, count in zip(*[table.column(c).to_pylist() for c in ("low", "docs", "counts")]):
            hashes.append(from_planes(low + bytes((8 - width) * (len(low) // width)), np.uint64))
            docs.append(np.repeat(np.frombuffer(doc, np.int64), np.frombuffer(count, np.int32)))
        hashes, docs = np.concatenate(hashes), np.concatenate(docs)
        order = np.lexsort((docs, hashes))
        hashes, docs = hashes[order], docs[order]
        first = np.ones(len(hashes), bool)
        first[1:] = hashes[1:] != hashes[:-1]
        owner = docs[first][np.cumsum(first) - 1]
        later = owner != docs
        shard, owner = _shard(docs[later], shards), owner[later]
        order = np.lexsort((owner, shard))
        shard, owner = shard[order], owner[order]
        parts = [p for p in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard)) + 1) if len(p)]
        owners = [np.unique(owner[p]).tobytes() for p in parts]
        return pa.table({"shard": pa.array([shard[p[0]] for p in parts], pa.int64()), "owners": pa.array(owners, pa.binary())})

    return run


def _together(table):
    """The different owners that a shard needs."""
    shard = table.column("shard")[0].as_py()
    owners = np.unique(np.concatenate([np.frombuffer(o, np.int64) for o in table.column("owners").to_pylist()]))
    return pa.table({"shard": pa.array(np.full(len(owners), shard), pa.int64()), "owner": pa.array(owners, pa.int64())})


def _shard(doc_id, shards: int):
    """The shard of document ids, alike for numpy arrays and columns."""
    if isinstance(doc_id, Column):
        return F.pmod(F.shiftright(doc_id, 7).bitwiseXOR(doc_id), F.lit(shards))
    return np.mod((doc_id >> 7) ^ doc_id, shards)


def _packed(shards: int):
    """Documents packed by shard into compressed blocks."""

    def run(batches):
        for batch in slices(batches, "text", 16 << 20):
            ids = batch.column("doc_id")
            spare = pa.array(np.arange(batch.num_rows))  # rows without an id may go anywhere
            shard = _shard(ids.fill_null(0).to_numpy(zero_copy_only=False), shards)
            shard = np.where(ids.is_null().to_numpy(zero_copy_only=False), spare.to_numpy() % shards, shard)
            order = np.argsort(shard, kind="stable")
            numbers, blocks = [], []
            for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                sink = io.BytesIO()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(batch.take(pa.array(part)))
                numbers.append(shard[part[0]])
                blocks.append(sink.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(blocks, pa.binary())], ["shard", "block"])

    return run


def _deflated(batches):
    for batch in batches:
        texts = [pa.compress(t.as_buffer(), "zstd", asbytes=True) if len(t.as_buffer()) else b"" for t in batch.column("text").cast(pa.binary()).fill_null(b"")]
        sizes = [len(t.as_buffer()) for t in batch.column("text").cast(pa.binary()).fill_null(b"")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary()), pa.array(sizes, pa.int64())], ["doc_id", "z", "size"])


class Passages:
    """An automaton over blocks of words, with the words around each block and the document that owns them."""

    def __init__(self, size: int):
        self.size, self.block = size, (size + 1) // 2
        self.around: dict[str, dict] = defaultdict(dict)
        self.automaton = None

    def add(self, words: list[bytes], owner: int) -> None:
        more = self.size - self.block
        for s in range(0, len(words) - self.block + 1, self.block):
            e = s + self.block
            known = self.around[_joined(words[s:e])]
            context = (tuple(words[max(0, s - more) : s]), tuple(words[e : e + more]))
            known[context] = min(owner, known.get(context, owner))

    def compile(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for key, contexts in self.around.items():
            self.automaton.add_word(key, list(contexts.items()))
        if self.around:
            self.automaton.make_automaton()
        self.around = {}

    def marked(self, words: list[bytes], doc: int) -> np.ndarray:
        """Which words a window of an earlier document covers."""
        out = np.zeros(len(words), bool)
        if not len(self.automaton) or len(words) < self.size:
            return out
        hits = list(self.automaton.iter(_joined(words)))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)  # where the space after each word is
        for e, (_, contexts) in zip((np.searchsorted(ends, [h[0] for h in hits]) + 1).tolist(), hits):
            s = e - self.block
            for (left, right), owner in contexts:
                if owner < doc:
                    a, b = s, e
                    for word in reversed(left):
                        if a == 0 or words[a - 1] != word:
                            break
                        a -= 1
                    for word in right:
                        if b == len(words) or words[b] != word:
                            break
                        b += 1
                    if b - a >= self.size:
                        out[a:b] = True
        return out


def _joined(words: list[bytes]) -> str:
    """The words between single spaces, one character per byte."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def _recurring(size: int, docs: Words, ids: np.ndarray, owners: Words, owner_ids: np.ndarray):
    """The passages (words, owner) of the owners of which some later document of the shard seems to have a window."""
    hashes, at = docs.shingles(size)
    last = ids[docs.rows()[at]]
    order = np.lexsort((last, hashes))
    hashes, last = hashes[order], last[order]
    keep = np.ones(len(hashes), bool)
    keep[:-1] = hashes[1:] != hashes[:-1]  # the largest document with a window
    hashes, last = hashes[keep], last[keep]
    wanted, at = owners.shingles(size)
    if not len(hashes) or not len(wanted):
        return
    where = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
    row = owners.rows()[at]
    good = (hashes[where] == wanted) & (last[where] > owner_ids[row])
    at, row = at[good], row[good]
    if not len(at):
        return
    cuts = np.flatnonzero((np.diff(at) != 1) | (np.diff(row) != 0)) + 1
    texts: tuple[int, list[bytes]] = (-1, [])
    for part in np.split(np.arange(len(at)), cuts):
        r = int(row[part[0]])
        if texts[0] != r:
            texts = (r, owners.word_bytes(r))
        a = int(at[part[0]] - owners.first[r])
        yield texts[1][a : a + len(part) + size - 1], int(owner_ids[r])


def _stream(size: int):
    def run(packed, owners):
        blocks = [pa.ipc.open_stream(b).read_all() for b in packed.column("block").to_pylist()]
        if not blocks:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept_text": pa.array([], pa.string())})
        docs = pa.concat_tables(blocks).combine_chunks()
        one = lambda c: c.chunk(0) if c.num_chunks == 1 else pa.concat_arrays(c.chunks)
        ids, texts = docs.column("doc_id").to_pylist(), one(docs.column("text"))
        passages = Passages(size)
        if owners.num_rows:
            held = [pa.decompress(z, s, "zstd", asbytes=True) if s else b"" for z, s in zip(owners.column("z").to_pylist(), owners.column("size").to_pylist())]
            known = np.array([-(2**63) if i is None else i for i in ids])
            for words, owner in _recurring(size, Words(texts), known, Words(pa.array(held, pa.binary())), owners.column("owner").to_numpy()):
                passages.add(words, owner)
        passages.compile()
        counts, removed, kept = [], [], []
        for doc, text in zip(ids, texts.cast(pa.binary())):
            words = (text.as_py() or b"").split()
            marked = passages.marked(words, doc) if doc is not None else np.zeros(len(words), bool)
            n = int(marked.sum())
            counts.append(len(words))
            removed.append(n)
            kept.append(b" ".join([w for w, m in zip(words, marked.tolist()) if not m] if n else words).decode())
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.string())})

    return run


def remove_repeated_passages(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for every row of `docs` (doc_id, text; other columns are ignored).

    Each word is removed that is covered by a window of `size` words which also starts in a document with a smaller
    doc_id, judged on the input. Kept words are joined by one space. Nulls are empty texts; rows without a doc_id keep
    all words and take nothing from others; rows of one doc_id do not count as earlier than one another. An empty table
    gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, shards = total // BUCKET_BYTES + 1, total // SHARD_BYTES + 1
    known = docs.where("doc_id is not null and text is not null")
    windows = known.mapInArrow(_windows(size, buckets), "bucket int, low binary, docs binary, counts binary")
    owners = windows.groupBy("bucket").applyInArrow(_owners(shards, _width(buckets)), "shard bigint, owners binary")
    owners = owners.groupBy("shard").applyInArrow(_together, "shard bigint, owner bigint")
    texts = known.mapInArrow(_deflated, "doc_id bigint, z binary, size bigint")
    owners = owners.join(texts, F.col("owner") == F.col("doc_id")).select("shard", "owner", "z", "size")
    packed = docs.mapInArrow(_packed(shards), "shard bigint, block binary")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    return packed.groupBy("shard").cogroup(owners.groupBy("shard")).applyInArrow(_stream(size), schema)
