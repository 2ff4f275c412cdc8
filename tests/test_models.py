from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmill.functions.skew import dealt_out
from tabmill.operators import evaluate, knn, knn_hashed, linear_grid, lookup, models, profile, score, validate
from tabmill.operators.transform import fit
from tabmill.schema import COMMODITY_FLOW as S
from tabmill.schema import SAMPLE_TRANSFORMER as T


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(1)
    x, z = rng.normal(50, 10, 600), rng.normal(0, 3, 600)
    y = 3 * x - 7 * z + 11 + rng.normal(0, 0.5, 600)
    stages = np.array(["train"] * 8 + ["valid", "test"])[np.arange(600) % 10]
    rows = [(str(i), float(a), float(b), float(c), s) for i, (a, b, c, s) in enumerate(zip(x, z, y, stages))]
    return spark.createDataFrame(rows, "id string, x double, z double, y double, stage string").cache()


def _xy(df):
    rows = df.where("stage = 'train'").select("x", "z", "y").toPandas()
    return rows[["x", "z"]].to_numpy(), rows["y"].to_numpy()


def _coordinate_descent(X, y, alpha, ratio, sweeps=4000):
    Xc, yc = X - X.mean(0), y - y.mean()
    n, w = len(y), np.zeros(X.shape[1])
    for _ in range(sweeps):
        for j in range(len(w)):
            rest = yc - Xc @ w + Xc[:, j] * w[j]
            rho = Xc[:, j] @ rest / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * ratio, 0) / (Xc[:, j] @ Xc[:, j] / n + alpha * (1 - ratio))
    return w, y.mean() - X.mean(0) @ w


@pytest.mark.parametrize(
    "kind, hp, alpha, ratio",
    [
        ("linear_regression", {}, 0.0, 0.0),
        ("elastic_net", {"alpha": 2.0, "l1_ratio": 0.4}, 2.0, 0.4),
        ("elastic_net", {}, 1.0, 0.5),
        ("lasso", {"alpha": 5.0}, 5.0, 1.0),
    ],
)
def test_linear_models_minimise_the_usual_objective(linear, kind, hp, alpha, ratio):
    model = models.fit_one(models.Candidate("m", kind, hp), linear.where("stage = 'train'"), ["x", "z"], "y", "id").model
    w, b = _coordinate_descent(*_xy(linear), alpha, ratio)
    assert np.allclose(model.coefficients.toArray(), w, rtol=1e-5, atol=1e-6)
    assert model.intercept == pytest.approx(b, rel=1e-5)


@pytest.mark.parametrize("kind", ["decision_tree_regressor", "random_forest_regressor", "gradient_boosting_regressor"])
def test_trees_beat_the_mean(linear, kind):
    hp = {"max_depth": 4, "random_state": 42}
    if kind == "gradient_boosting_regressor":
        hp |= {"n_estimators": 12, "learning_rate": 0.3}
    model = models.fit_one(models.Candidate("m", kind, hp), linear.where("stage = 'train'"), ["x", "z"], "y", "id")
    scored = model.transform(linear).withColumn("mean", F.lit(evaluate.mean_baseline(linear, "y")))
    out = evaluate.metrics_by_stage(scored, "y", {"tree": "prediction", "mean": "mean"}, ("rmse",))
    value = {(r["model_id"], r["stage"]): r["value"] for r in out.collect()}
    assert value["tree", "test"] < 0.6 * value["mean", "test"]


def test_unsupported_options_raise():
    for kind, hp in [
        ("decision_tree_regressor", {"criterion": "absolute_error"}),
        ("random_forest_regressor", {"min_samples_split": 10, "min_samples_leaf": 2}),
        ("linear_regression", {"alpha": 1}),
        ("random_forest_regressor", {"oob_score": True}),
        ("decision_tree_regressor", {"max_depth": 31}),
        ("gradient_boosting_regressor", {"max_depth": None}),
    ]:
        with pytest.raises(ValueError):
            models.estimator(models.Candidate("m", kind, hp), "y", "p", 2)
    with pytest.raises(ValueError):
        models.candidates([{"model_type": "support_vectors"}])
    with pytest.raises(ValueError):
        models.candidates([], "random")


@pytest.mark.parametrize("rate,rounds", [(0.1, 3), (0.5, 2), (1.0, 1), (0.3, 9)])
def test_boosting_starts_at_the_mean(spark, rate, rounds):
    df = spark.createDataFrame([(float(i % 2), 100.0 * (i % 2)) for i in range(40)], "x double, y double")
    hp = {"learning_rate": rate, "n_estimators": rounds, "random_state": 1}
    model = models.fit_one(models.Candidate("m", "gradient_boosting_regressor", hp), df, ["x"], "y", "x")
    found = {r["x"]: r["prediction"] for r in model.transform(df).distinct().collect()}
    moved = 50 * (1 - (1 - rate) ** rounds)
    assert found == {0.0: pytest.approx(50 - moved), 1.0: pytest.approx(50 + moved)}


def test_linear_options_take_effect(linear):
    fit = lambda **hp: models.estimator(models.Candidate("m", "elastic_net", hp), "y", "p", 2)
    assert fit(max_iter=5).getMaxIter() == 5 and fit(solver="l-bfgs").getSolver() == "l-bfgs" and fit().getSolver() == "normal"


def test_min_samples_split_cuts_small_nodes(spark, linear):
    train = linear.where("stage = 'train'")
    hp = {"max_depth": 6, "min_samples_leaf": 1, "random_state": 1}
    full = models.fit_one(models.Candidate("m", "decision_tree_regressor", hp), train, ["x", "z"], "y", "id")
    cut = models.fit_one(models.Candidate("m", "decision_tree_regressor", {**hp, "min_samples_split": 60}), train, ["x", "z"], "y", "id")
    assert cut.model.numNodes < full.model.numNodes
    # every leaf is the mean of its rows, and each inner node of the cut tree had 60 rows at least
    out = cut.transform(train).groupBy("prediction").agg(F.count("y").alias("n"), F.avg("y").alias("mean")).collect()
    assert all(r["prediction"] == pytest.approx(r["mean"]) for r in out)
    grown = full.transform(train).groupBy("prediction").count().collect()
    assert len(out) < len(grown)
    same = full.transform(cut.transform(train).withColumnRenamed("prediction", "p")).groupBy("p").agg(F.countDistinct("prediction").alias("leaves"), F.count("y").alias("n"))
    assert all(r["n"] < 60 for r in same.collect() if r["leaves"] > 1)


def test_spans_of_a_printed_tree(spark, linear):
    train = linear.where("stage = 'train'")
    full = models.fit_one(models.Candidate("m", "decision_tree_regressor", {"max_depth": 5, "random_state": 1}), train, ["x", "z"], "y", "id")
    spans = models.node_spans(full.model)
    leaves = [first for first, last in spans if first == last]
    assert len(spans) == full.model.numNodes and leaves == list(range((full.model.numNodes + 1) // 2)) and spans[0] == (0, len(leaves) - 1)


def test_cut_tree_of_extreme_settings(spark, linear):
    train = linear.where("stage = 'train'")
    root = models.fit_one(models.Candidate("m", "decision_tree_regressor", {"max_depth": 3, "min_samples_split": 10**9}), train, ["x", "z"], "y", "id")
    assert root.model.numNodes == 1
    (only,) = {r["prediction"] for r in root.transform(linear).collect()}
    assert only == pytest.approx(train.agg(F.avg("y")).first()[0])


def test_rows_in_one_task_are_dealt_out(spark):
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(1000).repartition(1)
    spread = dealt_out(one).groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == cores and sum(r["count"] for r in spread) == 1000
    even = spark.range(0, 1000, 1, 2 * cores)
    assert dealt_out(even) is even and dealt_out(even.limit(0)).count() == 0


def test_skipped_candidates_are_reported(linear):
    calls = [
        {"model_type": "decision_tree_regressor", "hyperparameters": {"criterion": ["friedman_mse", "absolute_error"], "max_depth": [2]}},
        {"model_type": "linear_regression", "hyperparameters": {}},
    ]
    with pytest.raises(models.Unsupported):
        models.train_grid(linear, ["x"], "y", "id", calls, ("mae",), "mae")
    out = models.train_grid(linear, ["x"], "y", "id", calls, ("mae",), "mae", unsupported="skip")
    assert len(out.models) == 2 and list(out.skipped) == ["m001-decision_tree_regressor"]


def test_grid_size_of_the_baseline_job():
    calls = [
        {"model_type": "linear_regression", "hyperparameters": {}},
        {
            "model_type": "decision_tree_regressor",
            "hyperparameters": {"max_depth": [5, 10, 15], "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4], "criterion": ["friedman_mse", "absolute_error"], "random_state": [42]},
        },
        {"model_type": "k_nearest_neighbors_regressor", "hyperparameters": {"n_neighbors": [3, 5, 7], "weights": ["uniform", "distance"], "algorithm": ["auto", "ball_tree", "kd_tree"], "p": [1, 2]}},
    ]
    assert len(models.candidates(calls)) == 91


@pytest.fixture(scope="module")
def inputs(spark):
    """Columns far from zero, one that depends on others and one constant."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(600, 3)) * [1, 20, 0.1] + [1e6, -40, 5]
    y = x @ [3.0, -0.2, 8.0] + rng.normal(size=600)
    rows = [(f"k{i}", *v, v[0] - 1e6 + v[1], 7.0, t, "train" if i % 4 else "valid" if i % 8 else "test") for i, (v, t) in enumerate(zip(x.tolist(), y.tolist()))]
    return spark.createDataFrame(rows, "id string, a double, b double, c double, d double, e double, y double, stage string")


def test_shared_moments_are_exact(inputs):
    names = ["a", "b", "c", "d", "e", "y"]
    train = inputs.where("stage = 'train'")
    z = np.array(train.select(names).toPandas())
    for parts in (1, 7, 900):  # more tasks than rows too
        m = linear_grid.moments(models.assemble(train.repartition(parts), names[:-1]), models.INPUTS, "y")
        assert m.rows == len(z) and m.mean == pytest.approx(z.mean(0), rel=1e-13)
        assert m.scatter == pytest.approx((z - z.mean(0)).T @ (z - z.mean(0)), rel=1e-9, abs=1e-6)
    with pytest.raises(Exception, match="missing"):
        linear_grid.moments(models.assemble(train.withColumn("y", F.lit(None).cast("double")), ["a"]), models.INPUTS, "y")
    with pytest.raises(ValueError):
        linear_grid.moments(models.assemble(train.limit(0), ["a"]), models.INPUTS, "y")


@pytest.mark.parametrize("kind,hp", [("linear_regression", {}), ("linear_regression", {"fit_intercept": False}), ("lasso", {"alpha": 0.4}), ("lasso", {"alpha": 1e9}), ("elastic_net", {"alpha": 0.3, "l1_ratio": 0.2}), ("elastic_net", {"alpha": 2.0, "l1_ratio": 0.9})])
def test_candidates_from_moments_equal_single_fits(inputs, kind, hp):
    names = ["b", "c"] if kind == "linear_regression" else ["b", "c", "d"]
    train = inputs.where("stage = 'train'")
    single = models.fit_one(models.Candidate("m", kind, hp), train, names, "y", "id").model
    m = linear_grid.moments(models.assemble(train, names), models.INPUTS, "y")
    weights, intercept = linear_grid.solve(m, *models.shared_settings(models.Candidate("m", kind, hp)))
    assert weights == pytest.approx(np.array(single.coefficients), rel=1e-4, abs=1e-5) and intercept == pytest.approx(single.intercept, rel=1e-5, abs=1e-4)


def test_penalised_solutions_are_optimal(inputs):
    """Where the gradient of the squared errors balances the penalty, nothing can be better."""
    names = ["a", "b", "c", "d", "e"]
    m = linear_grid.moments(models.assemble(inputs, names), models.INPUTS, "y")
    gram, toward = m.scatter[:-1, :-1] / m.rows, m.scatter[:-1, -1] / m.rows
    wanted = {f"{a}-{r}": (a, r, True) for a in (0.01, 0.5, 3.0, 1e5) for r in (0.1, 0.5, 1.0)}
    for name, (w, _) in linear_grid.solve_all(m, wanted).items():
        alpha, ratio, _ = wanted[name]
        slope = toward - gram @ w - alpha * (1 - ratio) * w
        assert np.all(np.abs(slope[w == 0]) <= alpha * ratio * (1 + 1e-6) + 1e-8)
        assert slope[w != 0] == pytest.approx(np.sign(w[w != 0]) * alpha * ratio, rel=1e-5, abs=1e-5)
    w, b = linear_grid.solve(m)
    z = np.array(inputs.select([*names, "y"]).toPandas())
    left = z[:, -1] - z[:, :-1] @ w - b
    assert abs(left.mean()) < 1e-6 and np.abs((z[:, :-1] - z[:, :-1].mean(0)).T @ left).max() < 1e-2


def test_linear_grid_reads_the_rows_once_for_all_candidates(spark, inputs, monkeypatch):
    passes = []
    real = linear_grid.moments
    monkeypatch.setattr(models, "moments", lambda *a: passes.append(1) or real(*a))
    monkeypatch.setattr(models, "_fit_mllib", lambda *a: pytest.fail("a linear candidate was fitted on its own"))
    calls = [{"model_type": "lasso", "hyperparameters": {"alpha": [0.1, 0.2, 0.4, 1.0]}}, {"model_type": "linear_regression"}]
    out = models.train_grid(inputs, ["b", "c"], "y", "id", calls, ("rmse",), "rmse")
    assert passes == [1] and len(out.models) == 5
    tied = models.train_grid(inputs.limit(200), ["b"], "y", "id", [{"model_type": "linear_regression"}], ("rmse",), "rmse").best
    again = tied.transform(inputs.limit(5)).select(tied.prediction).collect()
    assert all(r[0] is not None for r in again)


def test_grid_picks_and_tests_the_winner_only(linear):
    calls = [
        {"model_type": "decision_tree_regressor", "hyperparameters": {"max_depth": [1, 2], "random_state": [1]}},
        {"model_type": "linear_regression", "hyperparameters": {}},
        {"model_type": "k_nearest_neighbors_regressor", "hyperparameters": {"n_neighbors": [3, 5], "p": [1, 2]}},
    ]
    out = models.train_grid(linear, ["x", "z"], "y", "id", calls, ("mae", "rmse"), "rmse")
    assert out.best.candidate.model_type == "linear_regression"
    rows = out.metrics.collect()
    assert {r["model_id"] for r in rows if r["stage"] == "test"} == {out.best.candidate.model_id}
    assert len(rows) == 7 * 2 * 2 + 2
    with pytest.raises(ValueError):
        models.train_grid(linear, ["x"], "y", "id", calls, ("mae",), "rmse")
    with pytest.raises(ValueError):
        models.train_grid(linear, ["x"], "y", "id", calls, ("mae", "r2"), "mae")


def test_metrics(spark):
    df = spark.createDataFrame([("train", 1.0, 2.0), ("train", 3.0, 1.0), ("test", 5.0, 5.0)], "stage string, y double, p double")
    out = {(r["stage"], r["metric"]): r["value"] for r in evaluate.metrics_by_stage(df, "y", {"m": "p"}).collect()}
    assert out["train", "mse"] == 2.5 and out["train", "rmse"] == pytest.approx(2.5**0.5) and out["train", "mae"] == 1.5
    assert out["test", "mse"] == 0.0


def _brute(train, queries, k, weights, p):
    out = {}
    for q in queries:
        near = sorted((float((np.abs(np.subtract(q, v)) ** p).sum() ** (1 / p)), key, y) for key, v, y in train)[:k]
        if weights == "uniform":
            out[q] = np.mean([y for _, _, y in near])
        elif near[0][0] == 0:
            out[q] = np.mean([y for d, _, y in near if d == 0])
        else:
            w = np.array([1 / d for d, _, _ in near])
            out[q] = float(w @ [y for _, _, y in near] / w.sum())
    return out


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("dims", [1, 3])
def test_neighbours_equal_brute_force(spark, dims, p):
    """Many leaves and blocks; a third of the train rows share one vector."""
    rng = np.random.default_rng(dims * 10 + p)
    train = []
    for i in range(900):
        v = tuple([2.0] * dims) if i % 3 == 0 else tuple(float(x) for x in rng.integers(0, 40, dims) / 4)
        train.append((f"k{i:04d}", v, float(rng.integers(0, 100))))
    queries = sorted({tuple(float(x) for x in rng.integers(-4, 44, dims) / 4) for _ in range(150)} | {tuple([2.0] * dims)})
    names = [f"f{d}" for d in range(dims)]
    table = spark.createDataFrame([(key, *v, y) for key, v, y in train], ", ".join(["key string", *[f"{n} double" for n in names], "y double"]))
    asked = spark.createDataFrame([q for q in queries], ", ".join(f"{n} double" for n in names))
    index = knn.build_index(table, names, "y", "key", k=5, p=p, leaf_rows=40, block_rows=16)
    out = index.predict(asked, {"u5": (5, "uniform"), "d5": (5, "distance"), "u2": (2, "uniform")}).collect()
    assert len(out) == len(queries)
    for name, k, weights in (("u5", 5, "uniform"), ("d5", 5, "distance"), ("u2", 2, "uniform")):
        expected = _brute(train, queries, k, weights, p)
        for r in out:
            assert r[name] == pytest.approx(expected[tuple(r[n] for n in names)], rel=1e-9)


def _points(spark, n, dims, seed, asked):
    """Clustered points and queries near some of them."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(scale=4, size=(12, dims))
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dims))
    q = x[rng.choice(n, asked, replace=False)] + rng.normal(scale=0.3, size=(asked, dims))
    names = [f"f{d}" for d in range(dims)]
    ddl = ", ".join(f"{c} double" for c in names)
    train = spark.createDataFrame([(i, *v, float(i % 7)) for i, v in enumerate(x.tolist())], f"key int, {ddl}, y double")
    return train, spark.createDataFrame(q.tolist(), ddl), names


def _found(df):
    return {(tuple(r["q"]), r["key"]) for r in df.collect()}


def test_exact_search_compares_far_fewer_than_all_pairs(spark):
    """Four times the rows and queries: well below sixteen times the pairs."""
    pairs = []
    for n in (1000, 4000):
        train, asked, names = _points(spark, n, 3, 3, n // 10)
        index = knn.build_index(train, names, "y", "key", k=3, leaf_rows=50)
        found = _found(index.neighbours(asked))
        assert len(index.rows) >= n // 60 and len(found) == 3 * (n // 10)
        pairs.append(sum(index.compared))
    assert pairs[1] < 8 * pairs[0] and pairs[1] < 4000 * 400 / 8


def test_exact_search_of_one_hot_inputs(spark):
    rng = np.random.default_rng(2)
    rows = [(i, *[float(j == i % 12) for j in range(12)], float(rng.integers(0, 30)), float(i)) for i in range(1500)]
    names = [f"f{j}" for j in range(13)]
    table = spark.createDataFrame(rows, ", ".join(["key int", *[f"{n} double" for n in names], "y double"]))
    index = knn.build_index(table, names, "y", "key", k=4, leaf_rows=20)
    got = {r[names[-1]]: r["p"] for r in index.predict(table.where("f0 = 1").select(*names).distinct(), {"p": (4, "uniform")}).collect()}
    train = [(r[0], r[1:14], r[14]) for r in rows]
    queries = sorted({r[1:14] for r in rows if r[1] == 1})
    want = _brute(train, queries, 4, "uniform", 2)
    assert got == pytest.approx({q[-1]: want[q] for q in queries})
    assert sum(index.compared) < 0.7 * len(queries) * len(rows)


def test_boxes_find_every_leaf_within_the_radius():
    rng = np.random.default_rng(9)
    points = rng.normal(size=(600, 3))
    tree = knn.plant(points, 40)
    leaf = tree.leaf_of(points)
    count = len(tree.dimension) + 1
    low, high = (np.array([f(points[leaf == i], axis=0) for i in range(count)]) for f in (np.min, np.max))
    for p in (1, 2):
        boxes = knn.boxed(tree, low, high, p)
        asked, radius = rng.normal(size=(50, 3)), rng.uniform(0, 1.5, 50)
        row, found, reach = boxes.within(asked, radius)
        gap = np.maximum(np.maximum(low[None] - asked[:, None], asked[:, None] - high[None]), 0)
        true = gap.sum(2) if p == 1 else np.sqrt((gap**2).sum(2))
        assert set(zip(row.tolist(), found.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(true <= radius[:, None]))))
        assert all(row[i] < row[i + 1] or reach[i] <= reach[i + 1] for i in range(len(row) - 1))


@pytest.mark.parametrize("p", [1, 2])
def test_hashed_search_finds_most_true_neighbours(spark, tmp_path, p):
    train, asked, names = _points(spark, 3000, 4, 5, 150)
    index = knn_hashed.build_hashed_index(train, names, "y", "key", k=5, p=p)
    true = _found(knn.build_index(train, names, "y", "key", k=5, p=p).neighbours(asked))
    found = _found(index.neighbours(asked))
    assert index.recall >= 0.9 and len(true & found) >= 0.9 * len(true) and len(found) == len(true) == 750
    assert index.compared[0] < 3000 * 150 / 2
    # buckets larger than a block are met in blocks, with the same result
    assert _found(replace(index, block_rows=7).candidates(index.neighbours(asked).select("q").distinct())) == _found(index.candidates(index.neighbours(asked).select("q").distinct()))
    card = knn_hashed.save_hashed_index(index, str(tmp_path / "index"))
    assert _found(knn_hashed.load_hashed_index(spark, str(tmp_path / "index"), card).neighbours(asked)) == found


def test_hashed_search_answers_far_queries_and_hot_vectors(spark):
    rows = [(i, 1.0 if i % 3 else i / 50, 2.0 if i % 3 else -i / 70, float(i)) for i in range(900)]  # two thirds are one vector
    train = spark.createDataFrame(rows, "key int, a double, b double, y double")
    index = knn_hashed.build_hashed_index(train, ["a", "b"], "y", "key", k=4)
    asked = spark.createDataFrame([(1.0, 2.0), (1e6, -1e6), (0.5, 0.1), (1.0, 2.0)], "a double, b double")
    out = index.predict(asked, {"p": (4, "uniform")}).collect()
    assert len(out) == 4 and all(r["p"] is not None for r in out)
    assert {r["p"] for r in out if r["a"] == 1.0} == {(1 + 2 + 4 + 5) / 4}
    exact = {r["a"]: r["p"] for r in knn.build_index(train, ["a", "b"], "y", "key", k=4).predict(asked, {"p": (4, "uniform")}).collect()}
    assert {r["p"] for r in out if r["a"] == 1e6} == {exact[1e6]}


def test_hash_tables_follow_from_the_chance():
    assert knn_hashed.meeting_chance(4.0, 2) == pytest.approx(0.8, abs=0.01) and knn_hashed.meeting_chance(4.0, 1) == pytest.approx(0.62, abs=0.01)
    assert knn_hashed.tables_for(0.9, 0.8, 1) == 2 and knn_hashed.tables_for(0.9, 0.8, 4) == 5
    few, more = (knn_hashed.Hashes(3, 2, 1.5, 4, n) for n in (2, 6))
    x = np.random.default_rng(0).normal(size=(50, 3))
    assert (few.buckets(x) == more.buckets(x)[:, :2]).all()


def test_neighbours_reject_missing_values(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", None, 2.0)], "key string, x double, y double")
    with pytest.raises(Exception, match="missing values"):
        knn.build_index(df, ["x"], "y", "key", k=1)
    with pytest.raises(ValueError):
        knn.build_index(df.where("x is not null"), ["x"], "y", "key", k=2)


@pytest.fixture()
def manifest():
    return validate.Manifest((validate.CategoricalInput("COLUMN_CATEGORICAL", ("a", "b")), validate.NumericInput("COLUMN_NUMERICAL", 0.0, 10.0)))


@pytest.fixture()
def arriving(spark):
    rows = [("1", "a", "5"), ("2", "a", "0"), ("3", "b", "10"), ("4", "b", "10.1"), ("5", "c", "1"), ("6", None, "1"), ("7", "a", None), ("8", "a", "x"), ("9", "c", "NaN")]
    return spark.createDataFrame(rows, "COLUMN_ID string, COLUMN_CATEGORICAL string, COLUMN_NUMERICAL string").withColumn("extra", F.lit(1))


def test_accepted_and_quarantined_make_up_the_input(arriving, manifest):
    good = validate.accept(arriving, manifest, keep=("COLUMN_ID",))
    bad = {r["COLUMN_ID"]: [(e["column"], e["rule"], e["value"]) for e in r["errors"]] for r in validate.quarantine(arriving, manifest).collect()}
    assert good.columns == ["COLUMN_ID", "COLUMN_CATEGORICAL", "COLUMN_NUMERICAL"]
    assert sorted(r["COLUMN_ID"] for r in good.collect()) == ["1", "2", "3"]
    assert bad == {
        "4": [("COLUMN_NUMERICAL", "range", "10.1")],
        "5": [("COLUMN_CATEGORICAL", "unknown_value", "c")],
        "6": [("COLUMN_CATEGORICAL", "missing", None)],
        "7": [("COLUMN_NUMERICAL", "missing", None)],
        "8": [("COLUMN_NUMERICAL", "not_a_number", "x")],
        "9": [("COLUMN_CATEGORICAL", "unknown_value", "c"), ("COLUMN_NUMERICAL", "not_a_number", "NaN")],
    }
    reasons = {(r["column"], r["rule"]): r["n_rows"] for r in validate.reasons(validate.check(arriving, manifest)).collect()}
    assert reasons["COLUMN_NUMERICAL", "not_a_number"] == 2
    with pytest.raises(ValueError, match="COLUMN_NUMERICAL"):
        validate.check(arriving.drop("COLUMN_NUMERICAL"), manifest)


def test_large_domains_are_checked_by_a_join(spark, arriving):
    known = spark.createDataFrame([("1", f"v{i}", 1.0, 1.0) for i in range(30)] + [("1", "a", 1.0, 1.0)], "COLUMN_ID string, COLUMN_CATEGORICAL string, COLUMN_NUMERICAL double, COLUMN_TARGET double")
    narrow = validate.build_manifest(known.select("COLUMN_CATEGORICAL"), T)
    wide = validate.build_manifest(known.select("COLUMN_CATEGORICAL"), T, inline_values=5)
    assert wide.inputs[0].table is not None and narrow.inputs[0].values is not None
    for f in (validate.accept, validate.quarantine):
        assert sorted(map(str, f(arriving, narrow).collect())) == sorted(map(str, f(arriving, wide).collect()))


def test_truncated_bounds(spark):
    df = spark.createDataFrame([("1", "a", -3.7, 0.0), ("2", "a", 12.7, 0.0)], "COLUMN_ID string, COLUMN_CATEGORICAL string, COLUMN_NUMERICAL double, COLUMN_TARGET double")
    bounds = {i.name: i for i in validate.build_manifest(df, T, truncate=True).inputs}["COLUMN_NUMERICAL"]
    assert (bounds.min, bounds.max) == (-3.0, 12.0)
    assert tuple(profile.manifest_numeric(df, T, truncate=True).first()) == ("COLUMN_NUMERICAL", "numerical", -3.0, 12.0)
    exact = {i.name: i for i in validate.build_manifest(df, T).inputs}["COLUMN_NUMERICAL"]
    assert (exact.min, exact.max) == (-3.7, 12.7)


def test_scorer_survives_a_round_trip(spark, linear, tmp_path):
    df = linear.select(F.col("id").alias("COLUMN_ID"), F.lit("a").alias("COLUMN_CATEGORICAL"), (F.col("x") + 100).alias("COLUMN_NUMERICAL"), F.exp(F.col("x") / 50).alias("COLUMN_TARGET"), "stage")
    steps = fit(df, [{"type": "log_transformation", "columns": ["column_target"], "condition": "replace"}, {"type": "standardization", "columns": ["column_numerical"], "condition": "replace"}], T)
    from tabmill.operators.transform import apply_steps

    prepared = apply_steps(df, steps)
    model = models.fit_one(models.Candidate("m", "linear_regression"), prepared.where("stage = 'train'"), ["COLUMN_NUMERICAL"], "COLUMN_TARGET", "COLUMN_ID")
    manifest = validate.build_manifest(df.select("COLUMN_NUMERICAL"), T)
    scorer = score.Scorer("s", T, manifest, steps, model)
    scored = score.score(df, scorer, keep=("COLUMN_ID",))
    truth = {r["COLUMN_ID"]: r["COLUMN_TARGET"] for r in df.collect()}
    assert {r["COLUMN_ID"]: r["column_target"] for r in scored.collect()} == pytest.approx(truth, rel=1e-6)
    score.save_scorer(scorer, str(tmp_path / "scorer"))
    again = score.score(df, score.load_scorer(spark, str(tmp_path / "scorer")), keep=("COLUMN_ID",))
    assert sorted(again.collect()) == sorted(scored.collect())
    many = score.score_many(df, [scorer, score.Scorer("t", T, manifest, steps, model)], keep=("COLUMN_ID",))
    assert {r["model_name"]: r["count"] for r in many.groupBy("model_name").count().collect()} == {"s": 600, "t": 600}
    with pytest.raises(ValueError):
        score.score_by_name(df, {"s": scorer}, "u")


def test_several_models_in_one_scan(spark, tmp_path):
    """Different manifests, unreadable and missing inputs: as each model alone, but the rows are read once."""
    rows = [(f"k{i}", "abcd"[i % 4], 1.0 + i, 5.0 + 2 * i + i % 3, "train") for i in range(80)]
    known = spark.createDataFrame(rows, "COLUMN_ID string, COLUMN_CATEGORICAL string, COLUMN_NUMERICAL double, COLUMN_TARGET double, stage string")
    from tabmill.operators.transform import apply_steps

    def scorer(name, part, columns, specs, features, **options):
        steps = fit(part, specs, T)
        model = models.fit_one(models.Candidate("m", options.pop("kind", "linear_regression"), options.pop("hp", {})), apply_steps(part, steps), features, "COLUMN_TARGET", "COLUMN_ID")
        return score.Scorer(name, T, validate.build_manifest(part.select(*columns), T, **options), steps, model)

    log = [{"type": "log_transformation", "columns": ["column_numerical", "column_target"], "condition": "replace"}]
    hot = [{"type": "one_hot_encoding", "columns": ["column_categorical"]}]
    some, names = known.where("COLUMN_NUMERICAL < 41"), ["COLUMN_CATEGORICAL_a", "COLUMN_CATEGORICAL_b", "COLUMN_NUMERICAL"]
    scorers = [
        scorer("log", known, ["COLUMN_NUMERICAL"], log, ["COLUMN_NUMERICAL"]),
        scorer("narrow", some.where("COLUMN_CATEGORICAL < 'c'"), ["COLUMN_NUMERICAL", "COLUMN_CATEGORICAL"], hot, names),
        scorer("wide", known, ["COLUMN_NUMERICAL", "COLUMN_CATEGORICAL"], [], ["COLUMN_NUMERICAL"], inline_values=2),
        scorer("same", known, ["COLUMN_NUMERICAL"], [], ["COLUMN_NUMERICAL"], kind="decision_tree_regressor", hp={"max_depth": 3}),
    ]
    odd = ["heavy", None, "-1", "0", "NaN", "39.5", "79", "1e9", "12"]
    arriving = spark.createDataFrame([(f"r{i}", "abcx"[i % 4] if i % 11 else None, x) for i, x in enumerate(odd * 5)], "COLUMN_ID string, COLUMN_CATEGORICAL string, COLUMN_NUMERICAL string")
    arriving.write.parquet(str(tmp_path / "arriving"))
    arriving = spark.read.parquet(str(tmp_path / "arriving"))
    many = score.score_many(arriving, scorers, keep=("COLUMN_ID",))
    alone = [(*r, s.name) for s in scorers for r in score.score(arriving, s, keep=("COLUMN_ID",)).collect()]
    got = {(r[0], r[2]): r[1] for r in many.collect()}
    assert len(got) == len(alone) > 40 and got == pytest.approx({(i, n): v for i, v, n in alone})
    leaves = many._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("\n")
    assert leaves.count("COLUMN_ID") == 1  # one relation holds the rows; the other is the table of values
    near = score.Scorer("near", T, scorers[0].manifest, [], models.fit_one(models.Candidate("n", "k_nearest_neighbors_regressor", {"n_neighbors": 2}), known, ["COLUMN_NUMERICAL"], "COLUMN_TARGET", "COLUMN_ID"))
    both = score.score_many(arriving, [scorers[0], near], keep=("COLUMN_ID",))
    assert {r["model_name"]: r["count"] for r in both.groupBy("model_name").count().collect()} == {"log": 15, "near": 15}


def test_lookups(spark):
    sizes = {n: len(t) for n, t in lookup.LOOKUPS.items()}
    assert sizes == {"naics": 45, "export_country": 6, "hazmat": 3, "states": 51, "mode": 20, "sctg": 42}
    df = spark.createDataFrame([("1", "06", "N"), ("2", "99", "P"), ("3", None, "N")], "id string, ORIGIN_STATE string, HAZMAT string")
    out = {r["id"]: (r["ORIGIN_STATE_LABEL"], r["HAZMAT_LABEL"]) for r in lookup.decode(df).collect()}
    assert out == {"1": ("California", "Not HAZMAT"), "2": (None, "Flammable Liquids"), "3": (None, "Not HAZMAT")}
    assert [tuple(r) for r in lookup.unknown_codes(df.where("ORIGIN_STATE is not null")).collect()] == [("ORIGIN_STATE", "99", 1)]
    assert lookup.lookup_table(spark).count() == 167


def test_profiles(spark):
    df = spark.createDataFrame([("1", "a", 1.0), ("2", "a", 2.0), ("3", "b", float("nan")), ("4", None, 4.0)], "id string, c string, x double")
    numeric = profile.describe_numeric(df, ["x"]).first()
    assert (numeric["count"], numeric["min"], numeric["q50"], numeric["max"]) == (3, 1.0, 2.0, 4.0)
    assert tuple(profile.describe_categorical(df, ["c"]).first()) == ("c", 3, 2, "a", 2)
    prof = profile.profile_categorical(df, ["c"])
    assert profile.frequency_map(prof).first()["freq"] == {"a": 2, "b": 1}
    halves = profile.frequency_map(prof, max_values=1).collect()
    assert {r["column"] for r in halves} == {"c"} and sorted(i for r in halves for i in r["freq"].items()) == [("a", 2), ("b", 1)]
    a = profile.fingerprint(df).first()
    assert a == profile.fingerprint(df.repartition(5).orderBy(F.desc("id"))).first()
    assert a != profile.fingerprint(df.where("id <> '1'")).first()
    meta = profile.dataset_meta(df).first()
    assert meta["n_rows"] == 4 and meta["schema"] == {"id": "string", "c": "string", "x": "double"}


def test_manifest_json(spark):
    df = spark.createDataFrame([("1", "a", 1.0, 0.0), ("2", "b", 2.5, 0.0)], "COLUMN_ID string, COLUMN_CATEGORICAL string, COLUMN_NUMERICAL double, COLUMN_TARGET double")
    stored = profile.manifest_json(profile.manifest_numeric(df, T), profile.manifest_categorical(df, T))
    rows = profile.manifest_rows(stored).collect()
    again = validate.manifest_from_rows(rows)
    assert set(again.inputs) == set(validate.build_manifest(df, T).inputs)
    # a larger domain is a table, and the manifest read back holds its values too
    stored = profile.manifest_json(profile.manifest_numeric(df, T), profile.manifest_categorical(df, T), max_values=1)
    again = validate.manifest_from_rows(profile.manifest_rows(stored).collect())
    assert [i.name for i in again.inputs if isinstance(i, validate.NumericInput)] == ["COLUMN_NUMERICAL"]
    (wide,) = [i for i in again.inputs if isinstance(i, validate.CategoricalInput)]
    assert wide.values is None and sorted(r["value"] for r in wide.table.collect()) == ["a", "b"]
    arriving = spark.createDataFrame([("1", "a", 1.0), ("2", "c", 1.0)], "COLUMN_ID string, COLUMN_CATEGORICAL string, COLUMN_NUMERICAL double")
    assert [r["COLUMN_ID"] for r in validate.accept(arriving, again, keep=("COLUMN_ID",)).collect()] == ["1"]


def test_wide_domains_keep_every_value(spark):
    df = spark.range(12_000).select(F.concat(F.lit("v"), F.col("id") % 11_000).alias("COLUMN_CATEGORICAL"), F.col("id").cast("double").alias("COLUMN_NUMERICAL"))
    maps = profile.frequency_map(profile.profile_categorical(df, ["COLUMN_CATEGORICAL"])).collect()
    assert len(maps) > 1 and max(len(r["freq"]) for r in maps) <= profile.MANIFEST_VALUES
    assert sum(len(r["freq"]) for r in maps) == 11_000 and sum(n for r in maps for n in r["freq"].values()) == 12_000
    stored = profile.manifest_json(profile.manifest_numeric(df, T), profile.manifest_categorical(df, T))
    (wide,) = [r for r in profile.manifest_rows(stored).collect() if r["type"] == "categorical"]
    assert wide["available_values"] is None and spark.read.parquet(wide["values_path"]).distinct().count() == 11_000


def test_quantiles_of_odd_columns(spark):
    rows = [(float("inf"), None, 1.0), (float("-inf"), None, 1.0), (2.0, None, 1.0), (float("nan"), None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    out = {r["column"]: r for r in profile.describe_numeric(df, ["a", "b", "c"]).collect()}
    assert (out["a"]["q50"], out["b"]["q50"], out["b"]["count"]) == (2.0, None, 0)
    assert (out["c"]["q25"], out["c"]["q75"], out["c"]["count"]) == (1.0, 1.0, 4)
    assert {r["q50"] for r in profile.describe_numeric(df.limit(0), ["a", "c"]).collect()} == {None}
