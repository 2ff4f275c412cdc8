"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, written and trained in numpy.

A word (ASCII signs around it left away) has as input its own embedding, the mean embedding of its character n-grams, and
how much more often the word and its n-grams of each size occur in texts labelled 1. The network reads windows of words
that overlap by half; a text's score is that of its highest window, calibrated on the labels.

It is trained in one task on a sample of labelled texts chosen by a hash and bounded in number (`SAMPLE` of either label)
and in bytes (`SAMPLE_BYTES`). The sample is cut into folds: a text's word and n-gram rates come from the other folds, since
its own would give its label away; one fold is not trained on, but decides when to stop and calibrates the scores. Every
round picks the windows that score highest, so clean texts give the hard windows.

Scoring is a scan. Inputs are computed once per different word of a slice of text, in blocks; all windows of a
slice run in blocks.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hashing import Words, mix, release, slices

SAMPLE = 2000  # labelled texts of either label that are learned from
SAMPLE_BYTES = 8 << 20  # of either label; a text with which the sample would be larger is not learned from
WINDOW, STRIDE = 48, 24
HIDDEN = 8
EMBED = 8
WORD_ROWS, GRAM_ROWS = 1 << 14, 1 << 15
GRAMS = (4, 6, 8, 10)  # bytes, marks at the ends of a word included
ODDS = 2 + len(GRAMS)  # inputs that are rates of words and n-grams
FOLDS = 5
ROUNDS, EPOCHS, BATCH = 3, 2, 128
BLOCK = 2048  # windows, or words, at once
BLOCK_BYTES = 1 << 16  # of different words whose n-grams are computed at once; a longer word is a block of its own
SLICE_BYTES = 2 << 20  # of text scored at once; inputs of its different words and its windows take many times as much
RATE = 0.01
GATE = 0.25  # slope of the gates


_SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Inputs:
    """The different words of a slice: rows of the word table, and of the n-gram table with bounds per word."""

    def __init__(self, column: pa.Array):
        words = Words(column, lower=True)
        self.count, self.first = words.count, words.first
        _, at, word = np.unique(words.hash, return_index=True, return_inverse=True)
        self.word = word.astype(np.int32)
        start, end = words.start[at], words.end[at]
        self.row, self.sizes = np.zeros(len(at), np.int32), np.zeros((len(at), len(GRAMS)), np.int32)
        grams, upto, a = [np.zeros(0, np.int32)], np.cumsum(end - start), 0
        while a < len(at):  # what is computed on the way takes some hundred bytes per byte of a word
            b = max(a + 1, int(np.searchsorted(upto, upto[a] + BLOCK_BYTES)))
            self.row[a:b], some, self.sizes[a:b] = self._rows(words.data, start[a:b], end[a:b])
            grams.append(some)
            a = b
        self.gram = np.concatenate(grams)
        self.gram_first = np.r_[0, np.cumsum(self.sizes.sum(1, dtype=np.int64))]

    @staticmethod
    def _rows(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of some words: rows of the word table, rows of the n-gram table by word and size, and how many of each size."""
        length = end - start
        begin = np.cumsum(length) - length
        at = np.arange(length.sum()) + np.repeat(start - begin, length)
        signs = _SIGNS[data[at]]
        low, high = np.minimum.reduceat(np.where(signs, len(data), at), begin), np.maximum.reduceat(np.where(signs, -1, at), begin)
        bare = high >= 0  # from the first to the last byte that is no sign
        start, end = np.where(bare, low, start), np.where(bare, high + 1, end)
        length = end - start
        # each word with marks around it, so that n-grams know its ends and there is always one of each size
        wide = np.maximum(length + 3, max(GRAMS))
        ends = np.cumsum(wide)
        begin = ends - wide
        inside = np.arange(ends[-1]) - np.repeat(begin, wide)
        letters = np.zeros(len(inside), np.uint64)
        real = (inside > 1) & (inside <= np.repeat(length, wide) + 1)
        letters[real] = data[(np.repeat(start, wide) + inside - 2)[real]]
        whole = np.add.reduceat(mix(letters + (inside.astype(np.uint64) << np.uint64(8))), begin)
        left = np.repeat(ends, wide) - np.arange(len(inside))
        owner = np.repeat(np.arange(len(wide)), wide)
        rows, owners, kinds = [], [], []
        for kind, size in enumerate(GRAMS):
            n = max(len(letters) - size + 1, 0)
            code = np.full(n, size, np.uint64)
            for j in range(size):
                code = code * np.uint64(257) + letters[j : j + n]
            good = left[:n] >= size
            rows.append((mix(code[good]) % np.uint64(GRAM_ROWS)).astype(np.int32))
            owners.append(owner[:n][good])
            kinds.append(np.full(len(owners[-1]), kind))
        rows, owners, kinds = np.concatenate(rows), np.concatenate(owners), np.concatenate(kinds)
        sizes = np.bincount(owners * len(GRAMS) + kinds, minlength=len(wide) * len(GRAMS)).reshape(-1, len(GRAMS))
        return mix(whole) % np.uint64(WORD_ROWS), rows[np.lexsort((kinds, owners))], sizes

    def grams(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-gram rows of some words, and their bounds per word."""
        size = np.diff(self.gram_first)[chosen]
        first = np.concatenate([[0], np.cumsum(size)])
        return self.gram[np.arange(first[-1]) - np.repeat(first[:-1] - self.gram_first[chosen], size)], first

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Words (by number, -1 behind the end) of every window, and the text of each; an empty text has one empty window."""
        per = np.maximum(0, -(-(self.count - WINDOW) // STRIDE)) + 1
        text = np.repeat(np.arange(len(per)), per)
        at = (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * STRIDE + self.first[text]
        index = at.astype(np.int32)[:, None] + np.arange(WINDOW, dtype=np.int32)
        behind = index >= self.first[1:][text][:, None]
        if not len(self.word):
            return np.full(index.shape, -1, np.int32), text
        return np.where(behind, np.int32(-1), self.word[np.minimum(index, len(self.word) - 1)]), text


def _seen(inputs: Inputs, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts of either label (0, 1) each row of the word table and of the n-gram table occurs."""
    words, grams = np.zeros((2, WORD_ROWS), np.int64), np.zeros((2, GRAM_ROWS), np.int64)
    for i, label in enumerate(labels.tolist()):  # text by text: all pairs of a text and an n-gram would be a hundred times the texts
        word = np.unique(inputs.word[inputs.first[i] : inputs.first[i + 1]])
        some, many = np.zeros(WORD_ROWS, bool), np.zeros(GRAM_ROWS, bool)
        some[inputs.row[word]] = True
        for a in range(0, len(word), BLOCK):
            many[inputs.grams(word[a : a + BLOCK])[0]] = True
        words[label] += some
        grams[label] += many
    return words, grams


def _log_odds(seen: np.ndarray, ones: int, zeros: int) -> np.ndarray:
    """How much likelier a table row is in texts labelled 1, drawn to 0 for rows seen in few texts."""
    share = (seen[1] + 1) / (ones + 2), (seen[0] + 1) / (zeros + 2)
    both = seen.sum(0)
    return (np.clip(np.log(share[0] / share[1]), -3, 3) * both / (both + 4)).astype(np.float32)


class Network:
    """Weights, the forward pass over windows, and its gradients."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale=0.1: rng.normal(0, scale, shape).astype(np.float32)
        h = HIDDEN
        self.w = {
            "words": draw(WORD_ROWS, EMBED, scale=0.02), "grams": draw(GRAM_ROWS, EMBED, scale=0.02),
            "inf": draw(2 * EMBED + ODDS, 3 * h, scale=0.4), "inb": draw(2 * EMBED + ODDS, 3 * h, scale=0.4),
            "bf": np.zeros(3 * h, np.float32), "bb": np.zeros(3 * h, np.float32),
            "uf": draw(h, 3 * h, scale=0.3), "ub": draw(h, 3 * h, scale=0.3),
            "att": draw(2 * h, scale=0.3), "out": draw(2 * h, scale=0.3), "bias": np.zeros(1, np.float32),
        }
        self.word_odds, self.gram_odds = np.zeros(WORD_ROWS, np.float32), np.zeros(GRAM_ROWS, np.float32)
        self.slope, self.shift = 1.0, 0.0

    def features(self, inputs: Inputs, chosen: np.ndarray | None = None):
        """Inputs of the different words, or of some of them, and the n-gram rows behind them."""
        if chosen is None:
            row, gram, first, sizes = inputs.row, inputs.gram, inputs.gram_first, inputs.sizes
        else:
            row, sizes = inputs.row[chosen], inputs.sizes[chosen]
            gram, first = inputs.grams(chosen)
        x = np.zeros((len(row), 2 * EMBED + ODDS), np.float32)
        for a in range(0, len(row), BLOCK):  # bounded memory
            b = min(a + BLOCK, len(row))
            some, begin, size = gram[first[a] : first[b]], first[a:b] - first[a], np.diff(first[a : b + 1])[:, None]
            x[a:b, :EMBED] = self.w["words"][row[a:b]]
            x[a:b, EMBED:-ODDS] = np.add.reduceat(self.w["grams"][some], begin, axis=0) / size
            odds = self.gram_odds[some]
            x[a:b, -ODDS] = self.word_odds[row[a:b]]
            kinds = np.cumsum(sizes[a:b].ravel()) - sizes[a:b].ravel()
            x[a:b, 1 - ODDS : -1] = np.maximum.reduceat(odds, kinds).reshape(-1, len(GRAMS))
            x[a:b, -1] = np.add.reduceat(odds, begin) / size[:, 0]
        return x, row, gram, first

    def feeds(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """What the different words hand to the gates and the candidate in either direction; a last row for nothing."""
        out = []
        for w, b in (("inf", "bf"), ("inb", "bb")):
            fed = np.vstack([x @ self.w[w] + self.w[b], np.zeros((1, 3 * HIDDEN), np.float32)])
            out.append((fed[:, : 2 * HIDDEN] * np.float32(GATE) + np.float32(0.5), fed[:, 2 * HIDDEN :].copy()))
        return out

    def forward(self, feeds: list[tuple[np.ndarray, np.ndarray]], windows: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits of windows of words (-1: nothing). Gates are piecewise linear, the candidate is x / (1 + |x|)."""
        n, h = len(windows), HIDDEN
        mask = windows >= 0
        whole = mask.all()
        columns = np.ascontiguousarray(windows.T)
        states = np.empty((WINDOW, n, 2 * h), np.float32)
        for side, ((to_gates, to_new), u) in enumerate(zip(feeds, ("uf", "ub"))):
            u_gates, u_new = self.w[u][:, : 2 * h] * np.float32(GATE), self.w[u][:, 2 * h :].copy()
            state = np.zeros((n, h), np.float32)
            for t in range(WINDOW) if side == 0 else range(WINDOW - 1, -1, -1):
                gates = to_gates.take(columns[t], 0)
                gates += state @ u_gates
                np.clip(gates, 0, 1, out=gates)
                back = state @ u_new
                new = gates[:, h:] * back
                new += to_new.take(columns[t], 0)
                size = np.abs(new)
                size += 1
                new /= size
                following = state - new
                following *= gates[:, :h]
                following += new
                if not whole:
                    following = np.where(mask[:, t, None], following, state)
                if keep is not None:
                    keep.append((side, t, state, gates, new, back))
                state = following
                states[t, :, side * h : (side + 1) * h] = state
        weight = np.where(mask.T, states @ self.w["att"], -30)
        weight = np.exp(weight - weight.max(0))
        weight = np.where(mask.T, weight / weight.sum(0), 0).astype(np.float32)
        pooled = (weight[:, :, None] * states).sum(0)
        if keep is not None:
            keep.append((states, weight, pooled, mask))
        return pooled @ self.w["out"] + self.w["bias"][0]

    def gradients(self, inputs: Inputs, windows: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> dict:
        """Gradients of the weighted log loss over windows of words of `inputs`."""
        h = HIDDEN
        some, local = np.unique(windows, return_inverse=True)
        local = local.reshape(windows.shape) - (some[0] < 0)
        some = some[some >= 0]
        x, row, gram, first = self.features(inputs, some)
        keep: list = []
        logit = self.forward(self.feeds(x), local, keep)
        states, weight, pooled, mask = keep.pop()
        d_logit = ((_sigmoid(logit) - labels) * importance / len(labels)).astype(np.float32)
        g = {"uf": np.zeros_like(self.w["uf"]), "ub": np.zeros_like(self.w["ub"])}
        g["out"], g["bias"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * self.w["out"]
        d_weight = (states * d_pooled).sum(2)
        d_att = weight * (d_weight - (weight * d_weight).sum(0))
        g["att"] = np.einsum("tn,tnh->h", d_att, states)
        d_states = weight[:, :, None] * d_pooled + d_att[:, :, None] * self.w["att"]
        d_x = np.zeros((len(some) + 1, x.shape[1]), np.float32)
        d_state = {0: 0.0, 1: 0.0}
        d_fed = {0: np.zeros((len(some) + 1, 3 * h), np.float32), 1: np.zeros((len(some) + 1, 3 * h), np.float32)}
        for side, t, before, gates, new, back in reversed(keep):
            u = self.w["uf" if side == 0 else "ub"]
            m = mask[:, t, None]
            total = d_states[t, :, side * h : (side + 1) * h] + d_state[side]
            d = total * m
            z, r = gates[:, :h], gates[:, h:]
            d_new = d * (1 - z) * (1 - np.abs(new)) ** 2
            d_z = d * (before - new) * GATE * ((z > 0) & (z < 1))
            d_r = d_new * back * GATE * ((r > 0) & (r < 1))
            d_in = np.hstack([d_z, d_r, d_new])
            d_back = np.hstack([d_z, d_r, d_new * r])
            g["uf" if side == 0 else "ub"] += before.T @ d_back
            d_state[side] = d * z + d_back @ u.T + total * ~m
            np.add.at(d_fed[side], local[:, t], d_in)
        for side, (w, b) in enumerate((("inf", "bf"), ("inb", "bb"))):
            fed = d_fed[side][:-1]  # the last row stands for nothing
            g[w], g[b] = x.T @ fed, fed.sum(0)
            d_x[:-1] += fed @ self.w[w].T
        d_x = d_x[:-1]
        size = np.diff(first)
        for k, at, d in (("words", row, d_x[:, :EMBED]), ("grams", gram, np.repeat(d_x[:, EMBED:-ODDS] / size[:, None], size, axis=0))):
            rows, back = np.unique(at, return_inverse=True)  # of the tables only the rows that occur
            order = np.argsort(back, kind="stable")
            g[k] = (rows, np.add.reduceat(d[order], np.searchsorted(back[order], np.arange(len(rows)))) if len(rows) else d)
        return g

    def logits(self, inputs: Inputs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits of all windows, with the windows and their texts."""
        feeds = self.feeds(self.features(inputs)[0])
        windows, text = inputs.windows()
        out = np.empty(len(windows), np.float32)
        for a in range(0, len(windows), BLOCK):
            out[a : a + BLOCK] = self.forward(feeds, windows[a : a + BLOCK])
        return out, windows, text

    def scores(self, column: pa.Array) -> np.ndarray:
        inputs = Inputs(column)
        logit, _, text = self.logits(inputs)
        highest = np.maximum.reduceat(logit, np.searchsorted(text, np.arange(len(inputs.count))))
        return _sigmoid(self.slope * highest.astype(np.float64) + self.shift)


class _Part:
    """The texts of one fold with their windows, and the rates of words and n-grams in the other folds."""

    def __init__(self, texts: list, labels: np.ndarray):
        self.y = labels
        self.inputs = inputs = Inputs(pa.array(texts, pa.string()))
        self.windows, self.text = inputs.windows()
        self.counts = _seen(inputs, labels)
        self.odds: tuple = ()

    def highest(self, logit: np.ndarray) -> np.ndarray:
        return np.maximum.reduceat(logit, np.searchsorted(self.text, np.arange(len(self.y)))).astype(np.float64)


def train(texts: list, labels: list, share: float, seed: int = 11) -> Network:
    """A network for texts labelled 0 and 1, in an order that does not matter to the labels.

    `share` is that of label 1 among all labelled texts.
    """
    net = Network(seed)
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.int64)
    fold = np.zeros(len(y), np.int64)
    for label in (0, 1):  # both labels in all folds
        fold[y == label] = np.arange((y == label).sum()) % FOLDS
    parts = [_Part([texts[i] for i in np.flatnonzero(fold == f)], y[fold == f]) for f in range(FOLDS) if (fold == f).any()]
    totals = [sum(p.counts[k] for p in parts) for k in (0, 1)]
    ones = sum(p.y.sum() for p in parts)
    for p in parts:
        p.odds = tuple(_log_odds(total - own, ones - p.y.sum(), len(y) - len(p.y) - ones + p.y.sum()) for total, own in zip(totals, p.counts))
    last, used = parts[0], parts[1:] or parts

    def seen_with(p: _Part) -> None:
        net.word_odds, net.gram_odds = p.odds

    ranks = []
    for p in used:
        seen_with(p)
        x = net.features(p.inputs)[0][:, -ODDS:]
        strength = np.r_[x.sum(1), np.float32(-99)]
        ranks.append(strength[p.windows].max(1))  # the first round goes by the strongest word
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    step, best = 0, (np.inf, {}, (1.0, 0.0))
    hard: list[np.ndarray] = [np.zeros(0, np.int64) for _ in used]
    for _ in range(ROUNDS):
        chosen, targets = [], []
        for i, (p, rank) in enumerate(zip(used, ranks)):
            order = np.lexsort((-rank, p.text))
            top = order[np.searchsorted(p.text[order], np.arange(len(p.y)))]
            clean = np.flatnonzero(p.y[p.text] == 0)
            some = rng.choice(clean, min(len(clean), len(p.y)), replace=False)
            hard[i] = np.unique(np.concatenate([hard[i], top[p.y == 0]]))
            chosen.append(np.concatenate([top[p.y == 1], hard[i], some]))
            targets.append(p.y[p.text[chosen[-1]]].astype(np.float32))
        toxic = max(sum(t.sum() for t in targets), 1)
        total = sum(map(len, targets))
        for _ in range(EPOCHS):
            batches = [(i, b) for i, c in enumerate(chosen) for b in np.array_split(rng.permutation(len(c)), max(1, len(c) // BATCH))]
            for at in rng.permutation(len(batches)).tolist():
                i, part = batches[at]
                if not len(part):
                    continue
                target = targets[i][part]
                importance = np.where(target == 1, total / (2 * toxic), total / (2 * max(total - toxic, 1)))
                step += 1
                seen_with(used[i])
                for k, d in net.gradients(used[i].inputs, used[i].windows[chosen[i][part]], target, importance).items():
                    rows, d = d if isinstance(d, tuple) else (slice(None), d)
                    m, v = moments[k]
                    m[rows] += 0.1 * (d - m[rows])
                    v[rows] += 0.01 * (d * d - v[rows])
                    net.w[k][rows] -= RATE * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.99**step)) + 1e-8)
            seen_with(last)
            highest = last.highest(net.logits(last.inputs)[0])
            weight = np.where(last.y == 1, share / max(last.y.mean(), 1e-9), (1 - share) / max(1 - last.y.mean(), 1e-9))
            slope, shift = _calibrated(highest, last.y, weight)
            z = slope * highest + shift
            loss = float((weight * np.logaddexp(0, np.where(last.y == 1, -z, z))).mean())
            if loss < best[0]:
                best = loss, {k: v.copy() for k, v in net.w.items()}, (slope, shift)
        ranks = []
        for p in used:
            seen_with(p)
            ranks.append(net.logits(p.inputs)[0])
    net.w, (net.slope, net.shift) = best[1], best[2]
    net.word_odds, net.gram_odds = (_log_odds(t, ones, len(y) - ones) for t in totals)
    return net


def _calibrated(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic regression, held back a little so that separable labels stay finite."""
    at = np.array([1.0, 0.0])
    both = np.stack([logit, np.ones_like(logit)], 1)
    for _ in range(50):
        p = _sigmoid(both @ at)
        grad = both.T @ (weight * (p - y)) + 0.1 * (at - [1, 0])
        hess = (both * (weight * p * (1 - p))[:, None]).T @ both + 0.1 * np.eye(2)
        at = at - np.clip(np.linalg.solve(hess, grad), -1, 1)
    return float(at[0]), float(at[1])


def held_out(doc_id: Column, fold: int = 5) -> Column:
    """Whether crc32(doc_id as text) modulo `fold` is 0; a null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % fold == 0


def _trained(share: float):
    def run(sample: pa.Table) -> pa.Table:
        sample = sample.sort_by([("toxic", "ascending"), ("key", "ascending"), ("doc_id", "ascending")])
        labels = sample.column("toxic").to_pylist()
        net = train(sample.column("text").to_pylist(), labels, share) if len(set(labels)) == 2 else float(labels[0])
        release()
        return pa.table({"model": pa.array([pickle.dumps(net)], pa.binary())})

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network | float:
    """A network from labelled texts outside the held-out fold: of either label at most `sample`, in the order of a hash, and
    no more than `sample_bytes` of UTF-8 in all.

    It is trained by one task; only the network, of a fixed size, comes to the driver. Null labels, labels of unknown
    documents and repeated rows do no harm. Unless both labels occur, the share of label 1 is returned instead (0 without
    labels).
    """
    marks = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.where(~held_out(F.col("doc_id")))
    counts = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return 1.0 if 1 in counts else 0.0
    keyed = marks.withColumn("key", F.md5(F.concat(F.lit("sample-"), F.col("doc_id").cast("string"))))
    zeros, ones = (keyed.where(F.col("toxic") == label).orderBy("key", "doc_id").limit(sample) for label in (0, 1))
    # at most `sample` rows of either label
    rows = docs.select("doc_id", "text").join(F.broadcast(zeros.union(ones)), "doc_id").groupBy("doc_id", "toxic", "key").agg(F.min("text").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    upto = F.sum(size.cast("bigint")).over(Window.partitionBy("toxic").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    taken = rows.where(size <= sample_bytes).withColumn("upto", upto).where(F.col("upto") <= sample_bytes).withColumn("upto", F.lit(0))
    found = taken.groupBy("upto").applyInArrow(_trained(counts[1] / (counts[0] + counts[1])), "model binary").first()
    return pickle.loads(found["model"]) if found else 0.0


def _scored(model, keep: list[str]):
    def run(batches):
        net = model.value
        for batch in slices(batches, "text", SLICE_BYTES):
            text = batch.column("text")
            score = np.full(batch.num_rows, net) if isinstance(net, float) else net.scores(text)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score, pa.float64())], [*keep, "toxicity"])
        release()

    return run


def score(docs: DataFrame, model: Network | float, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs` with `toxicity` (0 to 1) of the whole `text`; null and empty texts are one empty window.

    The model, of a fixed size, is broadcast. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    types = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keep], "toxicity double"])
    columns = keep if "text" in keep else [*keep, "text"]
    return docs.select(*columns).mapInArrow(_scored(spark.sparkContext.broadcast(model), keep), schema)
