"""Least squares, lasso and elastic-net candidates of a grid from statistics that they share.

One pass over the train rows gives the number of rows, the means and the scatter of inputs and label about them; every
candidate is then solved from these, whatever the number of rows. Each task keeps its own means, so that columns far from
zero lose no digits; the tasks' results are moved to the common means when they are added up.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialize

MAX_INPUTS = 512  # the scatter has the square of it as entries and comes to the driver
SWEEPS, TOLERANCE, POLISH = 20_000, 1e-13, 25


@dataclass(frozen=True)
class Moments:
    """Of the inputs and, last, the label: number of rows, means and the sums of products of deviations from them."""

    rows: int
    mean: np.ndarray
    scatter: np.ndarray


def _partial(batches):
    n, mean, scatter = 0, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("z").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        its_mean = part.mean(axis=0)
        its_scatter = (part - its_mean).T @ (part - its_mean)
        if mean is None:
            n, mean, scatter = len(part), its_mean, its_scatter
            continue
        gap, total = its_mean - mean, n + len(part)
        scatter = scatter + its_scatter + np.outer(gap, gap) * (n * len(part) / total)
        mean, n = mean + gap * (len(part) / total), total
    if mean is not None:
        yield pa.RecordBatch.from_pydict({"n": [n], "mean": [mean], "scatter": [scatter.ravel()]}, schema=_SCHEMA)


def _moved(mean: np.ndarray):
    """Scatters about a common mean, added up per task."""

    def run(batches):
        total = None
        for batch in batches:
            for n, own, scatter in zip(*[batch.column(c).to_pylist() for c in ("n", "mean", "scatter")]):
                gap = np.array(own) - mean
                moved = np.array(scatter) + n * np.outer(gap, gap).ravel()
                total = moved if total is None else total + moved
        if total is not None:
            yield pa.RecordBatch.from_pydict({"scatter": [total]}, schema=pa.schema([("scatter", pa.list_(pa.float64()))]))

    return run


_SCHEMA = pa.schema([("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("scatter", pa.list_(pa.float64()))])


def moments(train: DataFrame, inputs: str, label: str) -> Moments:
    """The statistics of the vector column `inputs` and of `label`, from one pass over `train`. Missing labels raise."""
    y = F.col(label).cast("double")
    y = F.when(y.isNull() | F.isnan(y), F.raise_error(F.lit(f"{label} has missing values"))).otherwise(y)
    z = F.concat(vector_to_array(F.col(inputs)), F.array(y))
    parts = materialize(train.select(z.alias("z")).mapInArrow(_partial, "n bigint, mean array<double>, scatter array<double>"), "moments")
    weighted = parts.select("n", F.posexplode("mean")).groupBy("pos").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("col")).alias("total")).orderBy("pos").collect()
    if not weighted:
        raise ValueError("no train rows")
    mean = np.array([r["total"] / r["n"] for r in weighted])
    moved = parts.mapInArrow(_moved(mean), "scatter array<double>").select(F.posexplode("scatter"))
    summed = moved.groupBy("pos").agg(F.sum("col").alias("total")).toPandas().sort_values("pos")["total"].to_numpy()
    return Moments(weighted[0]["n"], mean, summed.reshape(len(mean), len(mean)))


def _polished(gram: np.ndarray, toward: np.ndarray, w: np.ndarray, bound: float, ridge: float) -> np.ndarray | None:
    """The optimum with the signs of `w`, from its linear equations; None if it has others or is no optimum.

    Descent gets the signs right soon, but where inputs depend on each other it comes closer to the values very slowly.
    """
    live = np.flatnonzero(w)
    if not len(live):
        return None
    signs = np.sign(w[live])
    out = np.zeros_like(w)
    part = gram[np.ix_(live, live)] + ridge * np.eye(len(live))
    size = np.sqrt(np.maximum(np.diag(part), 1e-300))
    out[live] = np.linalg.lstsq(part / np.outer(size, size), (toward[live] - bound * signs) / size, rcond=None)[0] / size
    slope = toward - gram @ out - ridge * out
    slack = 1e-9 * (np.abs(toward) + bound + 1e-300)
    dead = np.setdiff1d(np.arange(len(w)), live)
    fits = (np.sign(out[live]) == signs).all() and (np.abs(slope[live] - bound * signs) <= slack[live]).all()
    return out if fits and (np.abs(slope[dead]) <= bound + slack[dead]).all() else None


def solve(m: Moments, alpha: float = 0.0, ratio: float = 0.0, fit_intercept: bool = True, start: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Coefficients and intercept that minimise 1/(2n) |y - Xw - b|^2 + alpha * (ratio * |w|_1 + (1 - ratio) / 2 * |w|^2).

    Without a penalty by least squares, of the smallest norm where inputs depend on each other; else by coordinate
    descent, ended by the linear equations of its signs.
    """
    scatter = m.scatter / m.rows
    if not fit_intercept:
        scatter = scatter + np.outer(m.mean, m.mean)
    gram, toward = scatter[:-1, :-1], scatter[:-1, -1]
    size = np.sqrt(np.diag(gram))
    size[size == 0] = 1.0
    if alpha == 0:
        w = np.linalg.lstsq(gram / np.outer(size, size), toward / size, rcond=1e-12)[0] / size
    else:
        w = np.zeros(len(toward)) if start is None else start.copy()
        bound, ridge = alpha * ratio, alpha * (1 - ratio)
        left = toward - gram @ w
        scale = max(float(np.sqrt(max(scatter[-1, -1], 0))), 1e-300)
        for sweep in range(SWEEPS):
            change = 0.0
            for j in range(len(w)):
                room = gram[j, j] + ridge
                pull = left[j] + gram[j, j] * w[j]
                new = np.sign(pull) * max(abs(pull) - bound, 0.0) / room if room > 0 else 0.0
                if new != w[j]:
                    left -= gram[:, j] * (new - w[j])
                    change = max(change, abs(new - w[j]) * size[j])
                    w[j] = new
            if change <= TOLERANCE * scale:
                break
            if sweep % POLISH == POLISH - 1:
                exact = _polished(gram, toward, w, bound, ridge)
                if exact is not None:
                    w = exact
                    break
    return w, float(m.mean[-1] - m.mean[:-1] @ w) if fit_intercept else 0.0


def solve_all(m: Moments, wanted: dict[str, tuple[float, float, bool]]) -> dict[str, tuple[np.ndarray, float]]:
    """All candidates {name: (alpha, ratio, fit_intercept)}: along falling penalties each starts where the one before ended."""
    out: dict[str, tuple[np.ndarray, float]] = {}
    last: dict[tuple, np.ndarray] = {}
    for name, (alpha, ratio, intercept) in sorted(wanted.items(), key=lambda i: (i[1][1], -i[1][0], i[0])):
        out[name] = solve(m, alpha, ratio, intercept, last.get((ratio, intercept)))
        last[ratio, intercept] = out[name][0]
    return out


@dataclass
class LinearModel:
    """Coefficients over the input vector."""

    coefficients: list[float]
    intercept: float
    inputs: str
    prediction: str

    def transform(self, df: DataFrame) -> DataFrame:
        weights = F.array(*[F.lit(float(w)) for w in self.coefficients])
        products = F.zip_with(vector_to_array(F.col(self.inputs)), weights, lambda x, w: x * w)
        return df.withColumn(self.prediction, F.aggregate(products, F.lit(float(self.intercept)), lambda a, b: a + b))
