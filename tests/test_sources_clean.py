import pytest
from pyspark.sql import functions as F

from tabmill.functions import selection
from tabmill.operators import clean
from tabmill.schema import COMMODITY_FLOW, SAMPLE, SAMPLE_TRANSFORMER, schema_named
from tabmill.sources import tables


@pytest.fixture()
def frame(spark):
    rows = [(f"k{i}", None if i in (2, 5) else "rail sea road".split()[i % 3], f"note {i}", 7.5 * i) for i in range(7)]
    return spark.createDataFrame(rows, "COLUMN_ID string, COLUMN_FEATURE string, COLUMN_FEATURE_DELETED string, COLUMN_TARGET double")


def test_schema_roles():
    assert "SHIPMENT_VALUE" not in COMMODITY_FLOW.features(COMMODITY_FLOW.columns)
    assert COMMODITY_FLOW.features(["SHIPMENT_WEIGHT", "NAICS", "SHIPMENT_ID"]) == ["NAICS", "SHIPMENT_WEIGHT"]
    assert COMMODITY_FLOW.resolve("shipment_weight") == "SHIPMENT_WEIGHT"
    assert len(COMMODITY_FLOW.columns) == 20
    assert SAMPLE.features(["COLUMN_FEATURE", "COLUMN_TARGET"]) == ["COLUMN_FEATURE", "COLUMN_TARGET"]
    with pytest.raises(ValueError):
        COMMODITY_FLOW.resolve("nothing")
    with pytest.raises(ValueError):
        schema_named("nothing")


def test_remove_columns(frame):
    out = clean.remove_columns(frame, ["COLUMN_FEATURE_DELETED"])
    assert out.columns == ["COLUMN_ID", "COLUMN_FEATURE", "COLUMN_TARGET"] and out.count() == 7
    with pytest.raises(ValueError):
        clean.remove_columns(frame, ["NOTHING"])


def test_filter_columns_keeps_the_given_order(frame):
    assert clean.filter_columns(frame, ["COLUMN_TARGET", "COLUMN_FEATURE"]).columns == ["COLUMN_TARGET", "COLUMN_FEATURE"]


def test_remove_nan_rows_drops_null_and_nan(spark, frame):
    assert sorted(r[0] for r in clean.remove_nan_rows(frame).collect()) == ["k0", "k1", "k3", "k4", "k6"]
    numbers = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert clean.remove_nan_rows(numbers).count() == 1


def test_chain(spark):
    rows = spark.createDataFrame([("1", "5", "del", "300"), ("2", None, "del", "600")], SAMPLE.text_struct())
    steps = [
        {"type": "filter_columns", "columns": ["column_feature", "column_target", "column_feature_deleted"]},
        {"type": "remove_columns", "columns": ["column_feature_deleted"]},
        {"type": "drop_na"},
    ]
    out = clean.clean(rows, SAMPLE, steps)
    assert [tuple(r) for r in out.collect()] == [(5.0, 300.0)]
    assert dict(out.dtypes) == {"COLUMN_FEATURE": "double", "COLUMN_TARGET": "double"}
    carried = clean.clean(rows, SAMPLE, steps, carry_id=True)
    assert carried.columns == ["COLUMN_ID", "COLUMN_FEATURE", "COLUMN_TARGET"]
    with pytest.raises(ValueError):
        clean.clean(rows, SAMPLE, [{"type": "explode_everything"}])


def test_row_filter_follows_the_order_of_steps(spark):
    rows = spark.createDataFrame([("1", "5", None, "300"), ("2", "6", "x", "600")], SAMPLE.text_struct())
    drop_first = [{"type": "drop_na"}, {"type": "remove_columns", "columns": ["column_feature_deleted"]}]
    assert clean.clean(rows, SAMPLE, drop_first).count() == 1
    assert clean.clean(rows, SAMPLE, drop_first[::-1]).count() == 2


def test_typing_raises_and_quarantine_does_not(spark):
    rows = spark.createDataFrame([("1", "5", "x", "300"), ("2", "five", "x", "600"), ("3", None, "x", "1")], SAMPLE.text_struct())
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.typed(rows, SAMPLE).collect()
    good, bad = clean.typed_or_quarantined(rows, SAMPLE)
    assert sorted(r["COLUMN_ID"] for r in good.collect()) == ["1", "3"]
    assert [(r["COLUMN_ID"], r["COLUMN_FEATURE"], r["bad_columns"]) for r in bad.collect()] == [("2", "five", ["COLUMN_FEATURE"])]


def test_csv_with_blanks_and_missing_values(spark, tmp_path):
    (tmp_path / "sample.csv").write_text("\n  key,speed,remark,cost\n  A7,41,NA,8.5\n  B9,,late,17\n")
    out = tables.load_csv(spark, str(tmp_path / "sample.csv"), SAMPLE)
    assert out.columns == list(SAMPLE.columns)
    assert [tuple(r) for r in out.collect()] == [("A7", "41", None, "8.5"), ("B9", None, "late", "17")]
    assert tables.load_csv(spark, str(tmp_path / "sample.csv"), SAMPLE, n_rows=1).count() == 1
    assert tables.load_csv(spark, str(tmp_path / "sample.csv"), SAMPLE, n_rows=50).count() == 2
    with pytest.raises(ValueError):
        tables.load_csv(spark, str(tmp_path / "sample.csv"), COMMODITY_FLOW)
    with pytest.raises(ValueError):
        tables.load_csv(spark, str(tmp_path / "sample.csv"), SAMPLE, n_rows=3, random_state=1)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.load_csv(spark, str(tmp_path / "absent.csv"), SAMPLE)


def test_csv_save(spark, tmp_path):
    texts = ["plain", "  lead ", 'say "hi", twice', "two\nlines", "a\\b", "'", None]
    tables.save_csv(spark.createDataFrame([(i, t, i * 2.5) for i, t in enumerate(texts)], "place int, remark string, cost double"), str(tmp_path / "out"))
    back = tables.read_text_csv(spark, str(tmp_path / "out"), multi_line=True)
    assert back.columns == ["place", "remark", "cost"]
    assert [r["remark"] for r in back.orderBy(F.col("place").cast("int")).collect()] == texts


def test_csv_rows_of_other_lengths(spark, tmp_path):
    (tmp_path / "short.csv").write_text('x,y,z\n1,"a ""b"" c, d",3\n4,5\n')
    assert [tuple(r) for r in tables.read_text_csv(spark, str(tmp_path / "short.csv")).collect()] == [("1", 'a "b" c, d', "3"), ("4", "5", None)]
    (tmp_path / "long.csv").write_text("x,y\n1,2\n3,4,5\n")
    with pytest.raises(Exception, match="more than 2 fields"):
        tables.read_text_csv(spark, str(tmp_path / "long.csv")).select("x").collect()


def test_split_sets(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, "train"), (2.0, "valid"), (3.0, "test")], "x double, stage string")
    tables.save_splits(rows, str(tmp_path / "s"))
    valid = tables.load_splits(spark, str(tmp_path / "s"), "valid")
    assert [r["x"] for r in valid.collect()] == [2.0]
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stage" in plan
    with pytest.raises(ValueError):
        tables.load_splits(spark, str(tmp_path / "s"), "holdout")
    with pytest.raises(ValueError):
        tables.same_columns(rows, rows.drop("stage"))


def test_audit_counts_with_the_action(spark):
    df, seen = tables.audited(spark.range(25).toDF("x"), "audit-test")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 25}


def test_random_rows_are_exact_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    a = selection.random_rows(df, "k", 123, 42)
    b = selection.random_rows(df.repartition(13), "k", 123, 42)
    assert a.count() == 123 and a.distinct().count() == 123
    assert sorted(a.collect()) == sorted(b.collect())
    assert sorted(a.collect()) != sorted(selection.random_rows(df, "k", 123, 43).collect())
    assert selection.random_rows(df, "k", 5000, 1).count() == 5000
    with pytest.raises(ValueError):
        selection.random_rows(df, "k", 5001, 1)


def test_random_rows_with_a_hot_key(spark):
    """A third of the rows share one key; the content settles which of them are chosen."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    for n in (1, 700, 1500, 2400):
        assert selection.random_rows(df, "k", n, 42).count() == n


@pytest.mark.parametrize("n", [1, 17, 500, 999, 1000])
def test_first_rows_by_selection(spark, n):
    df = spark.range(1000).select(F.lpad(((F.col("id") * 7919) % 1000).cast("string"), 4, "0").alias("k"), "id")
    out = selection.first_rows(df, "k", n, small=0)
    assert sorted(r["k"] for r in out.collect()) == [f"{i:04d}" for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 9, 10, 11, 20])
def test_first_rows_with_repeated_rows_and_nulls(spark, n):
    """The same rows by a sort and by selection: ties by content, nulls last, identical rows by number."""
    rows = [("b", 1)] * 4 + [("a", 2), ("b", 0), (None, 5), (None, 5), (None, 4), ("c", 1)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(3)
    by_sort = sorted(map(str, selection.first_rows(df, "k", n).collect()))
    assert len(by_sort) == min(n, 10)
    if n:
        assert sorted(map(str, selection.first_rows(df, "k", n, small=0).collect())) == by_sort


def test_random_rows_of_identical_rows(spark):
    df = spark.range(100).select(F.lit("x").alias("k"), F.lit(1).alias("v"))
    for n in (0, 1, 50, 99, 100):
        assert selection.random_rows(df, "k", n, 42).count() == n


def test_nth_key_with_a_hot_key(spark):
    values = sorted([5] * 400 + list(range(800)))
    df = spark.createDataFrame([(v,) for v in values], "k long")
    for n in (1, 5, 6, 300, 406, 407, 1200):
        bound = selection.nth_key(df, "k", n, fanout=4, finish=3)
        assert bound.value == values[n - 1]
        assert bound.below == sum(v < bound.value for v in values)
        assert bound.equal == values.count(bound.value)
    assert selection.nth_key(df, "k", 1201, fanout=4, finish=3) is None


def test_quantiles_by_brackets_are_exact(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    a = np.concatenate([np.full(4000, 7.0), rng.lognormal(3, 2, 8000)])
    b = np.where(rng.random(12000) < 0.5, 1.0, 2.0)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    probabilities = (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)
    out = selection.exact_quantiles(df, ["a", "b"], probabilities, finish=50, accuracy=200)
    for p in probabilities:
        assert out["a", p] == pytest.approx(np.quantile(a, p), rel=1e-12)
        assert out["b", p] == pytest.approx(np.quantile(b, p), rel=1e-12)
    assert out == pytest.approx(selection.exact_quantiles(df, ["a", "b"], probabilities))
