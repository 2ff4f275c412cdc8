import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabmill.functions.ordering import alphabetical_index, range_pieces, running_min_before
from tabmill.functions.scalar import natural_log, round_half_even
from tabmill.functions import skew
from tabmill.functions.skew import lookup_join
from tabmill.operators import features, models, transform, validate
from tabmill.operators.split import split, split_sizes
from tabmill.schema import COMMODITY_FLOW, SAMPLE, SAMPLE_TRANSFORMER
from tabmill.streaming import score_stream


TEN = [(f"n{i}", "ba"[i in (1, 4, 6, 7, 9)], 12.0 + 0.5 * i * i, 3.0 - i / 7) for i in range(10)]
WEIGHTS = [r[2] for r in TEN]


@pytest.fixture()
def ten(spark):
    return spark.createDataFrame(TEN, "COLUMN_ID string, COLUMN_CATEGORICAL string, COLUMN_NUMERICAL double, COLUMN_TARGET double")


def step(kind, *columns, condition="replace"):
    return {"type": kind, "columns": list(columns), "condition": condition}


def run(df, specs, schema=SAMPLE_TRANSFORMER, **options):
    return transform.apply_steps(df, transform.fit(df, specs, schema, **options))


def test_exact_split_is_8_1_1_of_10(ten):
    out = split(ten, SAMPLE_TRANSFORMER, exact=True)
    assert {r["stage"]: r["count"] for r in out.groupBy("stage").count().collect()} == {"train": 8, "valid": 1, "test": 1}


def test_exact_split_of_identical_rows_and_rows_without_an_id(spark):
    df = spark.range(100).select(F.lit("x").alias("COLUMN_ID"), F.lit(1.0).alias("COLUMN_TARGET"))
    for rows in (df, df.unionByName(df.withColumn("COLUMN_TARGET", F.lit(2.0))), df.withColumn("COLUMN_ID", F.lit(None).cast("string"))):
        out = split(rows, SAMPLE_TRANSFORMER, exact=True)
        assert {r["stage"]: r["count"] for r in out.groupBy("stage").count().collect()} == split_sizes(rows.count())
    no_id = spark.range(500).select(F.lit(None).cast("string").alias("COLUMN_ID"), F.col("id").cast("double").alias("COLUMN_TARGET"))
    assert {r["stage"] for r in split(no_id, SAMPLE_TRANSFORMER).select("stage").distinct().collect()} == {"train", "valid", "test"}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 11, 99, 1003])
def test_exact_split_sizes(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("COLUMN_ID"), F.lit(1.0).alias("COLUMN_TARGET"))
    out = split(df, SAMPLE_TRANSFORMER, exact=True)
    sizes = {r["stage"]: r["count"] for r in out.groupBy("stage").count().collect()}
    assert {k: v for k, v in split_sizes(n).items() if v} == sizes


def test_hash_split_is_stable_disjoint_and_complete(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("COLUMN_ID"), F.lit(1.0).alias("COLUMN_TARGET"))
    a = split(df, SAMPLE_TRANSFORMER)
    b = split(df.repartition(7).orderBy(F.desc("COLUMN_ID")), SAMPLE_TRANSFORMER)
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 4000
    more = split(df.unionByName(df.withColumn("COLUMN_ID", F.concat(F.lit("n"), "COLUMN_ID"))), SAMPLE_TRANSFORMER)
    assert set(a.collect()) <= set(more.collect())
    share = a.where("stage = 'train'").count() / 4000
    assert 0.77 < share < 0.83


def test_log(ten):
    out = run(ten, [step("log_transformation", "column_numerical")])
    assert {r["COLUMN_ID"]: r["COLUMN_NUMERICAL"] for r in out.collect()} == {f"n{i}": math.log(12 + i * i / 2) for i in range(10)}


def test_log_edges(spark):
    df = spark.createDataFrame([(0, 0.0), (1, -1.0), (2, None), (3, float("nan")), (4, 1.0)], "i int, x double")
    out = {r["i"]: r["y"] for r in df.select("i", natural_log(F.col("x")).alias("y")).collect()}
    assert out[0] == -math.inf and math.isnan(out[1]) and out[2] is None and math.isnan(out[3]) and out[4] == 0.0


def test_minmax_of_the_train_minimum_is_zero_and_nothing_is_clipped(ten):
    staged = ten.withColumn("stage", F.when(F.col("COLUMN_ID").isin("n3", "n4", "n5"), "train").otherwise("test"))
    out = {r["COLUMN_ID"]: r["COLUMN_NUMERICAL"] for r in run(staged, [step("min_max_transformation", "column_numerical")]).collect()}
    # 16.5 to 24.5 are the train values
    assert out["n3"] == 0.0 and out["n5"] == 1.0 and out["n9"] == 4.5 and out["n0"] == -0.5625


def test_fit_does_not_see_held_out_rows(ten):
    staged = ten.withColumn("stage", F.when(F.col("COLUMN_ID") < "n5", "train").otherwise("test"))
    changed = staged.withColumn("COLUMN_NUMERICAL", F.when(F.col("stage") == "test", F.lit(1e9)).otherwise(F.col("COLUMN_NUMERICAL")))
    specs = [step("standardization", "column_numerical"), step("one_hot_encoding", "column_categorical")]
    a, b = (transform.fit(d, specs, SAMPLE_TRANSFORMER) for d in (staged, changed))
    assert [(s.params, s.categories) for s in a] == [(s.params, s.categories) for s in b]


def test_constant_column_is_only_shifted(ten):
    flat = ten.withColumn("COLUMN_NUMERICAL", F.lit(4.0))
    for kind in ("min_max_transformation", "standardization"):
        assert {r["COLUMN_NUMERICAL"] for r in run(flat, [step(kind, "column_numerical")]).collect()} == {0.0}


def test_standardize_uses_the_population_deviation(ten):
    out = run(ten, [step("standardization", "column_numerical")]).agg(F.avg("COLUMN_NUMERICAL"), F.stddev_pop("COLUMN_NUMERICAL")).first()
    assert out[0] == pytest.approx(0) and out[1] == pytest.approx(1)


def test_nan_is_skipped_by_the_fit_and_kept(ten):
    holed = ten.withColumn("COLUMN_NUMERICAL", F.when(F.col("COLUMN_ID") == "n9", F.lit(float("nan"))).otherwise(F.col("COLUMN_NUMERICAL")))
    out = {r["COLUMN_ID"]: r["COLUMN_NUMERICAL"] for r in run(holed, [step("min_max_transformation", "column_numerical")]).collect()}
    assert out["n8"] == 1.0 and math.isnan(out["n9"])


def test_infinite_train_values_raise(ten):
    zero = ten.withColumn("COLUMN_NUMERICAL", F.col("COLUMN_NUMERICAL") - 12)
    with pytest.raises(ValueError, match="infinite"):
        transform.fit(zero, [step("log_transformation", "column_numerical"), step("standardization", "column_numerical")], SAMPLE_TRANSFORMER)


def test_one_hot(ten):
    out = run(split(ten, SAMPLE_TRANSFORMER, exact=True), [step("one_hot_encoding", "column_categorical")])
    assert out.columns == ["COLUMN_ID", "COLUMN_NUMERICAL", "COLUMN_TARGET", "stage", "COLUMN_CATEGORICAL_a", "COLUMN_CATEGORICAL_b"]
    rows = {r["COLUMN_ID"]: (r["COLUMN_CATEGORICAL_a"], r["COLUMN_CATEGORICAL_b"]) for r in out.collect()}
    assert rows["n0"] == (0, 1) and rows["n1"] == (1, 0)
    assert all(sum(v) == 1 for v in rows.values())


def test_one_hot_unseen_is_all_zero(ten):
    staged = ten.withColumn("stage", F.when(F.col("COLUMN_CATEGORICAL") == "a", "train").otherwise("test"))
    out = run(staged, [step("one_hot_encoding", "column_categorical")])
    assert {(r["stage"], r["COLUMN_CATEGORICAL_a"]) for r in out.collect()} == {("train", 1), ("test", 0)}


def test_wide_one_hot_equals_narrow(spark):
    rows = [(str(i), f"v{i % 37:02d}", 1.0, 1.0, "train" if i < 200 else "test") for i in range(230)]
    rows.append(("x", "unseen", 1.0, 1.0, "test"))
    df = spark.createDataFrame(rows, "COLUMN_ID string, COLUMN_CATEGORICAL string, COLUMN_NUMERICAL double, COLUMN_TARGET double, stage string")
    spec = [step("one_hot_encoding", "column_categorical")]
    narrow = run(df, spec)
    names = [c for c in narrow.columns if c.startswith("COLUMN_CATEGORICAL_")]
    a = {r["COLUMN_ID"]: [float(r[c]) for c in names] for r in narrow.collect()}
    wide = run(df, spec, max_width=10)
    assert "COLUMN_CATEGORICAL" not in wide.columns
    b = {r["COLUMN_ID"]: r["v"] for r in wide.select("COLUMN_ID", vector_to_array("COLUMN_CATEGORICAL_vector").alias("v")).collect()}
    assert a == b and sum(b["x"]) == 0


@pytest.mark.parametrize("form", ["columns", "vector"])
def test_the_form_of_one_hot_inputs_does_not_depend_on_their_number(spark, form):
    kinds = []
    for n in (199, 200, 201):
        df = spark.range(2 * n).select(F.col("id").cast("string").alias("COLUMN_ID"), (F.col("id") % n).cast("string").alias("COLUMN_CATEGORICAL"), F.lit(1.0).alias("COLUMN_NUMERICAL"), F.lit(1.0).alias("COLUMN_TARGET"))
        out = run(df, [{**step("one_hot_encoding", "column_categorical"), "form": form}])
        kinds.append({t for c, t in out.dtypes if c.startswith("COLUMN_CATEGORICAL")})
        if form == "columns":
            assert len(out.columns) == n + 3
    assert kinds[0] == kinds[1] == kinds[2] and len(kinds[0]) == 1
    with pytest.raises(ValueError):
        transform.parse_steps([{**step("one_hot_encoding", "column_categorical"), "form": "wide"}], SAMPLE_TRANSFORMER)


def test_categories_whose_names_clash_train_a_model(spark):
    values = ["a", "A", "U.S.", "U_S_", "x`y", "", "é", "a b"]
    rows = [(str(i), values[i % 8], 1.0, float(i % 8), "train") for i in range(160)]
    df = spark.createDataFrame(rows, "COLUMN_ID string, COLUMN_CATEGORICAL string, COLUMN_NUMERICAL double, COLUMN_TARGET double, stage string")
    fitted = transform.fit(df, [step("one_hot_encoding", "column_categorical")], SAMPLE_TRANSFORMER)
    names = transform.one_hot_columns(fitted[0])
    assert len({n.lower() for n in names}) == 8 and not any("." in n or "`" in n for n in names)
    assert {"COLUMN_CATEGORICAL_A", "COLUMN_CATEGORICAL_é", "COLUMN_CATEGORICAL_a b"} < set(names)
    out = transform.apply_steps(df, fitted)
    features = transform.transformed_features(SAMPLE_TRANSFORMER, df.columns, fitted)
    assert set(names) < set(features)
    model = models.fit_one(models.Candidate("m", "decision_tree_regressor", {"max_depth": 8}), out, features, "COLUMN_TARGET", "COLUMN_ID")
    assert all(r["prediction"] == pytest.approx(r["COLUMN_TARGET"]) for r in model.transform(out).select("prediction", "COLUMN_TARGET").collect())
    with pytest.raises(ValueError, match="overwrite"):
        transform.apply_steps(df.withColumn("column_categorical_A", F.lit(1)), fitted)


def test_append(ten):
    out = run(ten, [step("log_transformation", "column_numerical", condition="append")])
    assert out.columns[-1] == "COLUMN_NUMERICAL_log" and "COLUMN_NUMERICAL" in out.columns
    fitted = transform.fit(ten, [step("log_transformation", "column_numerical", condition="append")], SAMPLE_TRANSFORMER)
    assert transform.transformed_features(SAMPLE_TRANSFORMER, ten.columns, fitted) == ["COLUMN_CATEGORICAL", "COLUMN_NUMERICAL", "COLUMN_NUMERICAL_log"]


def test_rejected_steps():
    bad = [
        step("log_transformation", "column_target", condition="append"),
        step("normalization", "column_target"),
        step("one_hot_encoding", "column_target"),
        step("log_transformation", "column_numerical", condition="append_and_remove"),
        step("log_transformation", "column_numerical_log"),
        step("anything", "column_numerical"),
        step("log_transformation", "column_numerical", condition="somehow"),
    ]
    for spec in bad:
        with pytest.raises(ValueError):
            transform.parse_steps([spec], SAMPLE_TRANSFORMER)


def test_step_ids_and_order():
    steps = transform.parse_steps([step("log_transformation", "column_numerical", "column_target"), step("standardization", "column_target")], SAMPLE_TRANSFORMER)
    assert [s.id for s in steps] == ["log-00-column_numerical", "log-00-column_target", "std-01-column_target"]
    assert [s.is_target for s in steps] == [False, True, True]


def test_raw_and_chained_fit_differ(ten):
    specs = [step("log_transformation", "column_numerical"), step("standardization", "column_numerical")]
    raw = transform.fit(ten, specs, SAMPLE_TRANSFORMER, fit_mode="raw")[1].params
    chained = transform.fit(ten, specs, SAMPLE_TRANSFORMER)[1].params
    assert raw["mean"] == pytest.approx(sum(WEIGHTS) / 10)
    assert chained["mean"] == pytest.approx(sum(map(math.log, WEIGHTS)) / 10)


def test_target_round_trip(ten):
    specs = [step("log_transformation", "column_target"), step("standardization", "column_target"), step("min_max_transformation", "column_target")]
    fitted = transform.fit(ten, specs, SAMPLE_TRANSFORMER)
    out = transform.apply_steps(ten, fitted).withColumn("back", transform.invert_target(F.col("COLUMN_TARGET"), fitted))
    assert {r["COLUMN_ID"]: r["back"] for r in out.collect()} == pytest.approx({r[0]: r[3] for r in TEN})


def test_replay_from_the_table(spark, ten, tmp_path):
    specs = [step("log_transformation", "column_numerical"), step("min_max_transformation", "column_numerical"), step("one_hot_encoding", "column_categorical")]
    fitted = transform.fit(ten, specs, SAMPLE_TRANSFORMER)
    transform.save_steps(spark, fitted, str(tmp_path / "steps"))
    again = transform.load_steps(spark, str(tmp_path / "steps"))
    assert again == fitted
    assert transform.apply_steps(ten, again).collect() == transform.apply_steps(ten, fitted).collect()


def test_unfitted_steps_cannot_be_applied(ten):
    with pytest.raises(ValueError, match="not fitted"):
        transform.apply_steps(ten, transform.parse_steps([step("log_transformation", "column_numerical")], SAMPLE_TRANSFORMER))


def test_custom_pair(ten):
    transform.register_pair(transform.FunctionPair("shift", lambda x: x + 1, lambda z: z - 1))
    transform.register_pair(transform.FunctionPair("one_way", lambda x: x * 0))
    fitted = transform.fit(ten, [step("shift", "column_target")], SAMPLE_TRANSFORMER)
    out = transform.apply_steps(ten, fitted).withColumn("back", transform.invert_target(F.col("COLUMN_TARGET"), fitted))
    assert [r["COLUMN_TARGET"] for r in out.orderBy("COLUMN_ID").collect()][0] == 4.0
    assert [r["back"] for r in out.orderBy("COLUMN_ID").collect()][0] == 3.0
    with pytest.raises(ValueError):
        transform.parse_steps([step("one_way", "column_target")], SAMPLE_TRANSFORMER)


def test_target_that_is_a_feature_keeps_a_raw_label(spark):
    df = spark.createDataFrame([(str(i), float(i + 1), "x", 300.0 * (i + 1)) for i in range(10)], SAMPLE.typed_struct())
    out = run(split(df, SAMPLE, exact=True), [step("log_transformation", "column_feature", "column_target"), step("normalization", "column_feature", "column_target")], SAMPLE)
    first = out.orderBy("COLUMN_ID").first()
    assert first["COLUMN_TARGET_LABEL"] == 300.0 and first["COLUMN_TARGET"] == 1.0
    assert SAMPLE.features(out.columns) == ["COLUMN_FEATURE", "COLUMN_TARGET"]


def test_fit_is_one_pass(spark, ten):
    """Many steps, one aggregate job over the train rows."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("fit-jobs", "fit")
    transform.fit(
        ten.withColumn("stage", F.lit("train")),
        [step("min_max_transformation", "column_numerical"), step("log_transformation", "column_target"), step("standardization", "column_target")],
        SAMPLE_TRANSFORMER,
    )
    jobs = tracker.getJobIdsForGroup("fit-jobs")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2  # one aggregate: at most a map and a reduce job


def test_round_half_even_is_exact(spark):
    values = [0.0005, 0.0015, 2.0005, 2091.4275, 1.0015, 0.1235, 2.675, 1e17, -2.0005, 5.5555, 1234567.0625, 0.3125]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    out = df.select("x", round_half_even(F.col("x"), 3).alias("y")).collect()
    assert {r["x"]: r["y"] for r in out} == {v: round(v, 3) for v in values}


def test_encodings(spark):
    rows = [("1", "A", "B", 10.0, "train"), ("2", "A", "C", 20.0, "train"), ("3", "B", "C", 60.0, "train"), ("4", "Z", "C", 5.0, "test")]
    df = spark.createDataFrame(rows, "id string, ORIGIN_STATE string, DESTINATION_STATE string, v double, stage string")
    out = {r["id"]: r.asDict() for r in features.geo_features(df, "v", drop=False).collect()}
    assert out["1"]["ORIGIN_STATE_FREQ"] == 2 and out["1"]["ORIGIN_STATE_MEAN"] == 15.0
    assert out["4"]["ORIGIN_STATE_FREQ"] == 0 and out["4"]["ORIGIN_STATE_MEAN"] == 30.0
    assert out["4"]["DESTINATION_STATE_FREQ"] == 2 and out["4"]["DESTINATION_STATE_MEAN"] == 40.0
    assert out["1"]["IS_INTERSTATE"] == 1
    dropped = features.geo_features(df, "v").columns
    assert "ORIGIN_STATE" not in dropped and "DESTINATION_STATE" not in dropped


def test_lookup_join_beyond_the_broadcast_size(spark):
    """A third of the rows share a key and some keys are null; salted and broadcast joins agree."""
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 40).cast("string")).alias("k")
    )
    table = df.where("k is not null").select("k").distinct().withColumn("w", F.length("k")).where("k <> '7'")
    for how in ("left", "inner", "left_semi"):
        small = lookup_join(df, table, ["k"], how)
        salted = lookup_join(df, table, ["k"], how, broadcast_rows=10, rows_per_task=200)
        assert small.columns == salted.columns
        assert sorted(map(str, small.collect())) == sorted(map(str, salted.collect()))


def test_heavy_keys_of_an_encoding_spread_a_lookup(spark, monkeypatch):
    """90 % of the rows share a value: known from the fit, so rows are not counted, and several tasks share them."""
    rows = spark.range(4000, numPartitions=8).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 300)).alias("ORIGIN_STATE"),
        (F.col("id") % 77).cast("double").alias("v"), F.lit("train").alias("stage"), "id",
    )
    encoding = features.fit_encoding(rows, ["ORIGIN_STATE"], "v")
    heavy = {r["ORIGIN_STATE"]: r["_salts"] for r in encoding.heavy["ORIGIN_STATE"].collect()}
    assert heavy["hot"] == 900 and len(heavy) <= skew.HEAVY
    small = sorted(map(str, features.encode(rows, encoding, drop=False).collect()))
    monkeypatch.setattr(features, "lookup_join", lambda *a, **k: lookup_join(*a, broadcast_rows=5, **k))
    counted = []
    monkeypatch.setattr(skew, "rows_up_to", lambda df, limit: counted.append(df) or 10**9)
    salted = features.encode(rows, encoding, drop=False)
    assert len(counted) == 1 and sorted(map(str, salted.collect())) == small  # the table of values alone was counted
    assert plan_text(salted).count("Aggregate") == 0
    monkeypatch.setattr(skew, "rows_up_to", lambda df, limit: 10**9)
    for key, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(key, value)  # the tables are tiny, the plan shall be that of large ones
    try:
        sizes = features.encode(rows, encoding, drop=False).where("ORIGIN_STATE = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 1500


def plan_text(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_salts_do_not_depend_on_the_order_of_rows(spark):
    df = spark.range(500).select("id", F.create_map(F.lit("a"), "id").alias("m"), (F.col("id") % 7).cast("string").alias("k"))
    one, other = (
        {r["id"]: r["s"] for r in d.select("id", skew.row_salt(d, F.lit(13)).alias("s")).collect()}
        for d in (df.coalesce(1).sortWithinPartitions("id"), df.coalesce(1).sortWithinPartitions(F.desc("k")))
    )
    assert one == other and set(one.values()) == set(range(13))


def test_a_wide_domain_is_looked_up_on_a_stream(spark, tmp_path):
    """A quarter of a million values: as in a batch, and the stream is not counted."""
    table = spark.range(250_000).select(F.concat(F.lit("v"), "id").alias("value"))
    rows = spark.range(3000).select("id", F.when(F.col("id") % 50 != 7, F.concat(F.lit("v"), F.col("id") * 167 % 300_000)).alias("COLUMN_CATEGORICAL"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    manifest = validate.Manifest((validate.CategoricalInput("COLUMN_CATEGORICAL", table=table),))
    stream = score_stream.read_stream(spark, str(tmp_path / "in"), rows.schema)
    steps = {"accept": lambda df: validate.accept(df, manifest, keep=("id",)), "quarantine": lambda df: validate.quarantine(df, manifest)}
    for name, step in steps.items():
        out = str(tmp_path / name)
        score_stream.project_stream(stream, step, out, str(tmp_path / f"state-{name}")).awaitTermination()
        found, want = spark.read.parquet(out), step(rows)
        assert sorted(map(str, found.select(want.columns).collect())) == sorted(map(str, want.collect()))
        assert 300 < found.count() < 2700


def test_running_min_across_pieces(spark):
    import random

    random.seed(5)
    rows = [("hot" if i % 3 == 0 else f"g{i % 5}", i, float(random.randint(0, 1000))) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, t int, v double")
    for piece in (F.floor(F.col("t") / 37), None):
        out = running_min_before(df, ["g"], ["t"], "v", "before", piece).collect()
        assert len(out) == 900
        for r in out:
            earlier = [v for g, t, v in rows if g == r["g"] and t < r["t"]]
            assert r["before"] == (min(earlier) if earlier else None)
            assert r["group_before"] == min(v for g, _, v in rows if g == r["g"])


def test_running_min_over_levels_of_pieces(spark):
    """Some hundred pieces under windows of four rows, with a null group and null values."""
    rows = [(None if i % 4 == 1 else "hot", i, None if i % 7 == 3 else float((i * 7919) % 1009)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, t int, v double").repartition(3)
    out = running_min_before(df, ["g"], ["t"], "v", "before", rows_per_piece=17, fan=4).collect()
    assert len(out) == 2000
    low = {}
    for r in sorted(out, key=lambda r: r["t"]):
        assert r["before"] == low.get(r["g"])
        if r["v"] is not None:
            low[r["g"]] = min(r["v"], low.get(r["g"], r["v"]))
    assert all(r["group_before"] == low[r["g"]] for r in out)


@pytest.mark.parametrize("n", [500, 50_000])
def test_pieces_are_bounded_at_any_size_and_cut_through_a_hot_group(spark, n):
    df = spark.range(n).select(F.floor(F.col("id") * 4 / (3 * n)).alias("g"), F.timestamp_seconds(F.floor(F.col("id") / 2)).alias("t"), "id")
    pieced, pieces = range_pieces(df.repartition(4), ["t", "id"], rows_per_piece=100)
    sizes = [r["count"] for r in pieced.groupBy("_piece").count().collect()]
    assert pieces == n // 100 and sum(sizes) == n and max(sizes) <= 200
    ordered = [r["_piece"] for r in pieced.orderBy("t", "id").collect()]
    assert ordered == sorted(ordered)


def test_alphabetical_index(spark):
    values = [f"k{i * 7919 % 1000:03d}" for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    out = {r["value"]: r["index"] for r in alphabetical_index(df, "value", "index", fanout=8).collect()}
    assert out == {v: i for i, v in enumerate(sorted(values))}
