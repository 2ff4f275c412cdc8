"""Fits of more rows than executors hold: read from the shared folder, in tasks of bounded size, with the same trees."""

import pytest
from pyspark.sql import functions as F

from tabmill.functions import skew
from tabmill.operators import models
from tabmill.sources import workspace


def rows_of(spark, n):
    id_ = F.col("id").cast("double")
    x, y = id_ % 17, F.floor(id_ / 17) % 13
    return spark.range(0, n, 1, 2).select(id_.alias("id"), x.alias("x"), y.alias("y"), (3 * x + F.sqrt(x) * y + F.log1p(id_)).alias("label"))


@pytest.mark.parametrize("kind, rounds", [("gradient_boosting_regressor", 10), ("decision_tree_regressor", None), ("random_forest_regressor", 3)])
def test_large_fits_hold_no_rows(spark, monkeypatch, kind, rounds):
    df = rows_of(spark, 3000)
    hp = {"max_depth": 3, "random_state": 1} | ({"n_estimators": rounds} if rounds else {}) | ({"bootstrap": False} if kind == "random_forest_regressor" else {})
    fit = lambda: models.fit_one(models.Candidate("m", kind, hp), df, ["x", "y"], "label", "id")
    want = {r["id"]: r["prediction"] for r in fit().transform(df).collect()}
    read, kept, fit_mllib, persist = [], [], models._fit_mllib, type(df).persist

    def noted(candidate, chosen, rows):
        read.append((skew.rows_of_tasks(rows), rows.storageLevel.useMemory))
        return fit_mllib(candidate, chosen, rows)

    monkeypatch.setattr(models, "HELD_VALUES", 5999, raising=False)
    monkeypatch.setattr(models, "TASK_VALUES", 1200, raising=False)  # a hundred rows of two inputs
    monkeypatch.setattr(models, "_fit_mllib", noted)
    monkeypatch.setattr(type(df), "persist", lambda self, *a: kept.append(self) or persist(self, *a))
    got = {r["id"]: r["prediction"] for r in fit().transform(df).collect()}
    assert got == pytest.approx(want) and len(got) == 3000
    assert not kept
    [((most, total), in_memory)] = read
    assert total == 3000 and most <= 200 and not in_memory


def test_tables_in_parts_keep_rows_and_metadata(spark):
    df = models.assemble(rows_of(spark, 1000), ["x", "y"])
    found = workspace.in_parts(df.coalesce(1), "vectors", 1000, 100)
    assert skew.rows_of_tasks(found) == (100, 1000)
    assert models.n_inputs(found) == 2 and sorted(found.collect()) == sorted(df.collect())
    assert skew.rows_of_tasks(workspace.in_parts(df.limit(0), "vectors", 0, 100)) == (0, 0)
