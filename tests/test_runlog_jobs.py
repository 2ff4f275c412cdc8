import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabmill.operators import profile, runlog, score, validate
from tabmill.plans import job
from tabmill.plans.queries.jobs import HOT_NAICS, LINE, LOG_BOTH, scenario
from tabmill.sources import runlog_store
from tabmill.sources.runlog_store import Recorder
from tabmill.streaming import score_stream

ENTRY = "id string, run_id string, key string, value {}, written_at timestamp"
RUNS = "id string, name string, parent_id string, experiment_id string, written_at timestamp"


def at(day):
    return dt.datetime(2024, 1, day)


@pytest.fixture(scope="module")
def log(spark):
    runs = [("p1", "P1", None, "e", at(1)), ("p2", "P2", None, "e", at(2)), ("c1", "C1", "p1", "e", at(1)), ("c2", "C2", "p1", "e", at(1)), ("c3", "C3", "p2", "e", at(2))]
    metrics = [("m1", "c1", "validation.valid.mae", 5.0, at(1)), ("m2", "c2", "validation.valid.mae", 4.0, at(1)), ("m3", "c2", "validation.valid.mae", 9.0, at(2)), ("m4", "c3", "validation.valid.mae", 4.0, at(2)), ("m5", "c2", "validation.test.mae", 6.0, at(2)), ("m6", "c3", "validation.test.mae", 3.0, at(2)), ("m7", "p1", "time_ms.all", 12.0, at(2)), ("m8", "p2", "time_ms.all", 20.0, at(2))]
    tags = [("t1", "c2", "level", "best", at(1)), ("t2", "c2", "status", "champion", at(1)), ("t3", "p1", "status.deployment", "published", at(1)), ("t4", "p1", "status.deployment", "retracted", at(3)), ("t5", "p2", "status.deployment", "published", at(3)), ("t6", "c3", "level", "best", at(3)), ("t7", "c1", "status", "champion", at(1))]
    properties = [("q1", "p1", "name.intent", "price", at(1)), ("q2", "p1", "name.intent", "other", at(2)), ("q3", "p2", "name.intent", "price", at(2)), ("q4", "c2", "validation.valid.mae", "text", at(1))]
    objects = [("o1", "c1", "model", "a", at(1)), ("o2", "c2", "model", "b", at(2)), ("o3", "c2", "card", "c", at(1))]
    make = spark.createDataFrame
    return {
        "runs": make(runs, RUNS),
        "metrics": make(metrics, ENTRY.format("double")),
        "tags": make(tags, ENTRY.format("string")),
        "properties": make(properties, ENTRY.format("string")),
        "objects": make([(i, r, t, u, w) for i, r, t, u, w in objects], "id string, run_id string, type string, url string, written_at timestamp"),
    }


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_best_child_takes_the_lowest_value_ever_written(log):
    assert rows(runlog.best_child(log["runs"], log["metrics"], "validation.valid.mae")) == [("p1", "C2", 4.0), ("p2", "C3", 4.0)]


def test_champions(log):
    assert rows(runlog.champions(log["runs"], log["metrics"], log["tags"], "validation.valid.mae")) == [("e", "C2", 4.0)]


def test_last_and_first_write(log):
    assert ("c2", "validation.valid.mae", 9.0) in rows(runlog.latest(log["metrics"]))
    assert rows(runlog.intents(log["properties"])) == [("p1", "price"), ("p2", "price")]
    wide = {r["run_id"]: r["name.intent"] for r in runlog.pivot_latest(log["properties"], ["name.intent"]).collect()}
    assert wide == {"p1": "other", "p2": "price"}


def test_children_and_objects(log):
    assert rows(runlog.children(log["runs"], "p1")) == [("p1", "c1", "C1"), ("p1", "c2", "C2")]
    assert rows(runlog.fan_out(log["runs"])) == [("p1", 2), ("p2", 1)]
    assert rows(runlog.objects_under_parents(log["runs"], log["objects"])) == [("p1", "card", "c"), ("p1", "model", "b")]
    assert rows(runlog.run_by_name(log["runs"], "C3")) == [("c3", "p2")]


def test_published_follows_the_latest_tag(log):
    assert rows(runlog.published_candidates(log["runs"], log["tags"])) == [("e", "p2", "P2")]
    found = runlog.previously_published(log["runs"], log["tags"], log["properties"], log["metrics"], "mae")
    assert rows(found) == [("e", "price", "p2", 3.0)]


def test_upsert_keeps_the_first_id(log):
    tags = {(r["run_id"], r["key"]): (r["id"], r["value"], r["writes"]) for r in runlog.current_tags(log["tags"]).collect()}
    assert tags["p1", "status.deployment"] == ("t3", "retracted", 2)


def test_tagged_best_and_cards(log):
    assert rows(runlog.tagged_best(log["runs"], log["tags"])) == [("p1", "c2", "C2"), ("p2", "c3", "C3")]
    cards = {(r["parent_id"], r["part"], r["key"]): (r["text"], r["number"]) for r in runlog.run_cards(log["runs"], log["tags"], log["properties"], log["metrics"]).collect()}
    assert cards["p1", "parent", "name.intent"] == ("other", None)
    assert cards["p1", "children", "validation.valid.mae"] == (None, 9.0)  # the metric covers the property
    assert cards["p2", "parent", "time_ms.all"] == (None, 20.0)


def test_tag_conjunction(log):
    assert rows(runlog.children_with_tags(log["runs"], log["tags"], {"level": "best", "status": "champion"})) == [("p1", "c2", "C2")]


def test_timings(log):
    assert rows(profile.stage_timings(log["metrics"])) == [("time_ms.all", 2, 16.0, 20.0)]


def test_latest_per_base_stage(spark):
    df = spark.createDataFrame([("r1", "b", "production", at(1)), ("r2", "b", "production", at(3)), ("r3", "b", "staging", at(9)), ("r4", "c", "production", at(2))], "run_id string, base string, stage string, created timestamp")
    assert [r[2] for r in rows(runlog.latest_per_base_stage(df))] == ["r2", "r4"]


def _replay(scores):
    status, best = [], None
    for s in scores:
        new, _ = runlog.nominate(s, best)
        if new == runlog.PUBLISHED:
            status = [runlog.RETRACTED if x == runlog.PUBLISHED else x for x in status]
            best = s
        status.append(new)
    return status


def test_nomination_history_equals_one_by_one(spark):
    import random

    random.seed(11)
    groups = {g: [float(random.randint(0, 60)) for _ in range(n)] for g, n in (("hot", 400), ("a", 1), ("b", 37))}
    data = [("e", g, f"{i:05d}", at(1) + dt.timedelta(hours=i), s) for g, scores in groups.items() for i, s in enumerate(scores)]
    df = spark.createDataFrame(data, "experiment_id string, intent string, id string, written_at timestamp, score double")
    for piece in (F.to_date("written_at"), None):
        out = runlog.nomination_history(df, piece).orderBy("id").collect()
        for g, scores in groups.items():
            assert [r["status"] for r in out if r["intent"] == g] == _replay(scores)


def test_store_appends_and_rounds(spark, tmp_path):
    path = str(tmp_path / "log")
    log = Recorder("e")
    run = log.run("R")
    log.metric(run, "validation.valid.mae", 1.23456)
    log.tag(run, "level", "best")
    log.flush(spark, path)
    log.tag(run, "level", "worst")
    log.flush(spark, path)
    assert [r["value"] for r in runlog_store.read(spark, path, "metrics").collect()] == [1.235]
    assert runlog_store.read(spark, path, "tags").count() == 2
    runlog_store.compact_tags(spark, path, str(tmp_path / "tags"))
    assert [r["value"] for r in spark.read.parquet(str(tmp_path / "tags")).collect()] == ["worst"]
    # an update stamped before the compaction and appended after it is newer than what was kept
    kept = spark.read.schema(runlog_store.TABLES["tags"]).parquet(str(tmp_path / "tags"))
    late = kept.select("id", "run_id", "key", F.lit("late").alias("value"), (F.col("written_at") + F.expr("interval 1 millisecond")).alias("written_at"))
    assert [r["value"] for r in runlog.latest(kept.unionByName(late)).collect()] == ["late"]
    assert runlog_store.read(spark, path, "objects").count() == 0
    with pytest.raises(ValueError):
        runlog_store.append(spark.range(1), path, "nothing")


def test_stored_manifest(spark):
    text = '[{"name":"X","type":"numerical","min":1,"max":2.5},{"name":"C","type":"categorical","available_values":["a","b"]}]'
    objects = spark.createDataFrame([("1", "p1", "transformation.allowed_columns", text, at(1)), ("2", "p1", "transformation.allowed_columns", "[]", at(2))], "id string, run_id string, type string, url string, written_at timestamp")
    out = runlog.stored_manifest(objects).drop("run_id").collect()
    manifest = validate.manifest_from_rows(out)
    assert manifest.inputs == (validate.NumericInput("X", 1.0, 2.5), validate.CategoricalInput("C", ("a", "b")))


SAMPLE_ROWS = "parcel,volume,remark,fee\n" + "".join(f"p{i},{4.5 * i + 2},r{i % 3},{11 * i * i + 7}\n" for i in range(1, 11))


@pytest.fixture()
def sample_csv(tmp_path):
    (tmp_path / "sample.csv").write_text(SAMPLE_ROWS)
    return str(tmp_path)


def sample_job(folder, *more, n_rows=None):
    load = {"type": "data_io", "properties": {"path": folder, "file": "sample", "format": "csv", "reference": "sample"}, "call": [{"type": "load", "n_rows": n_rows}]}
    return {"name": "parcels", "description": "fees of ten parcels", "repository": {}, "instructions": [load, *more]}


CLEAN = {"type": "data_cleaner", "properties": {"reference": "sample"}, "call": [{"type": "filter_columns", "columns": ["column_feature", "column_target"]}]}
TRANSFORM = {
    "type": "data_transformer",
    "properties": {"reference": "sample"},
    "call": [
        {"type": "standardization", "condition": "replace", "columns": ["column_feature"]},
        {"type": "log_transformation", "condition": "replace", "columns": ["column_target"]},
    ],
}
TRAIN = {
    "type": "model_trainer",
    "properties": {"objective": "first_model", "random_state": 42, "fold": 5, "parameter_grid": {"type": "exhaustive"}, "metrics": ["mae", "rmse"], "primary_metric": "rmse"},
    "call": [
        {"model_type": "lasso", "hyperparameters": {"alpha": [0.01, 0.2]}},
        {"model_type": "linear_regression", "hyperparameters": {}},
    ],
}


def test_job_load_and_clean(spark, sample_csv):
    assert job.load(spark, sample_job(sample_csv, n_rows=1)).count() == 1
    out = job.cleaned(job.load(spark, sample_job(sample_csv, CLEAN)), sample_job(sample_csv, CLEAN))
    assert out.columns == ["COLUMN_ID", "COLUMN_FEATURE", "COLUMN_TARGET"] and out.count() == 10


def test_job_load_missing_file(spark, sample_csv):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        job.run_scenario(spark, sample_job(sample_csv + "/none", CLEAN))


def test_job_transform(spark, sample_csv):
    out = job.run_scenario(spark, sample_job(sample_csv, CLEAN, TRANSFORM), exact=True).prepared
    assert out.features == ["COLUMN_FEATURE", "COLUMN_TARGET"]
    assert out.rows.where("stage = 'train'").count() == 8


def test_job_train(spark, sample_csv, tmp_path):
    log_path = str(tmp_path / "log")
    out = job.run_scenario(spark, sample_job(sample_csv, CLEAN, TRANSFORM, TRAIN), log_path, exact=True)
    assert len(out.grid.models) == 3
    runs = runlog_store.read(spark, log_path, "runs")
    assert runs.count() == 4 and runs.where("parent_id is null").first()["id"] == out.run_id
    props = {r["key"]: r["value"] for r in runlog.latest(runlog_store.read(spark, log_path, "properties")).where(F.col("run_id") == out.run_id).collect()}
    assert (props["size.load.row"], props["size.clean.row"], props["size.clean.column"], props["size.load.column"]) == ("10", "10", "2", "4")
    assert (props["size.split.train.row"], props["size.split.valid.row"], props["size.split.test.row"]) == ("8", "1", "1")
    assert rows(runlog.published_candidates(runs, runlog_store.read(spark, log_path, "tags")))[0][1] == out.run_id


def test_job_timers(spark, sample_csv, tmp_path):
    """A job times itself as a whole; run by stages it times each of them, with the same model."""
    found, scores = {}, {}
    for timers in ("job", "stages"):
        log_path = str(tmp_path / timers)
        out = job.run_scenario(spark, sample_job(sample_csv, CLEAN, TRANSFORM, TRAIN), log_path, exact=True, timers=timers)
        timings = profile.stage_timings(runlog_store.read(spark, log_path, "metrics")).collect()
        found[timers] = {r["key"].removeprefix("time_ms.") for r in timings}
        assert all(0 <= r["mean_ms"] <= r["max_ms"] for r in timings)
        scores[timers] = sorted((r["model_id"], r["stage"], r["metric"], round(r["value"], 6)) for r in out.metrics.collect())
    assert found["job"] == {"transforming.all", "train", "all"}
    names = {f"transforming.{s.step.name}" for s in out.prepared.steps}
    assert names and found["stages"] == found["job"] | names | {"loading", "cleaning", "validation.train", "validation.valid", "validation.test"}
    assert scores["job"] == scores["stages"]
    with pytest.raises(ValueError):
        job.run_scenario(spark, sample_job(sample_csv, CLEAN), timers="minutes")


def test_job_rejects_unknown_and_misplaced_steps(sample_csv):
    with pytest.raises(ValueError):
        job.check_config(sample_job(sample_csv, {"type": "deploy"}))
    with pytest.raises(ValueError):
        job.check_config(sample_job(sample_csv, TRANSFORM, CLEAN))
    with pytest.raises(ValueError):
        job.check_config({"instructions": [CLEAN]})


def test_publication_over_several_jobs(spark, sf, tmp_path):
    """The same intent three times: better, equal and worse than the one before."""
    from tabmill.plans.derived import shipments

    table = shipments(spark, sf, "SHIPMENT_ID", "NAICS", "SHIPMENT_VALUE", "SHIPMENT_WEIGHT")
    log_path = str(tmp_path / "log")
    line = scenario("same", ("shipment_weight", "shipment_value"), (), (LINE,))
    stump = scenario("same", ("shipment_weight", "shipment_value"), (), ({"model_type": "lasso", "hyperparameters": {"alpha": [1e9]}},))
    ids = [job.run_scenario(spark, c, log_path, table).run_id for c in (stump, line, line)]
    tags = runlog.latest(runlog_store.read(spark, log_path, "tags").where(F.col("key") == runlog.DEPLOYMENT))
    status = {r["run_id"]: r["value"] for r in tags.collect()}
    scores = [r["value"] for r in runlog_store.read(spark, log_path, "metrics").where("key = 'validation.test.mae'").orderBy("id").collect()]
    assert [status[i] for i in ids] == _replay(scores)


@pytest.mark.parametrize("n", [499, 500, 501, 1200])
def test_logged_manifests_keep_all_values(spark, tmp_path, n):
    """Domains on both sides of the list's bound are read back whole from the log, and described whole."""
    values = {f"v{i:04}" for i in range(n)}
    kinds = "SHIPMENT_ID string, NAICS string, SHIPMENT_VALUE double, SHIPMENT_WEIGHT double"
    table = spark.createDataFrame([(f"{v}-{i}", v, 2.0 + i, 3.0 + i) for v in sorted(values) for i in range(2)], kinds)
    log_path = str(tmp_path / "log")
    done = job.run_scenario(spark, scenario("wide", ("naics", "shipment_weight", "shipment_value"), (LOG_BOTH,)), log_path, table)
    stored = runlog.stored_manifest(runlog_store.read(spark, log_path, "objects")).where(F.col("run_id") == done.run_id)
    manifest = validate.manifest_from_rows(stored.collect())
    assert manifest.names == ["NAICS", "SHIPMENT_WEIGHT"]
    arriving = table.union(spark.createDataFrame([("x", "unseen", 2.0, 3.0)], kinds))
    assert validate.accept(arriving, manifest, keep=("SHIPMENT_ID",)).count() == 2 * n
    assert [r["SHIPMENT_ID"] for r in validate.quarantine(arriving, manifest).collect()] == ["x"]
    scorers = [score.Scorer(name, job.reference(scenario("wide", (), ())), manifest, [], None) for name in ("a", "b")]
    described = score.model_inputs(spark, scorers).collect()
    assert sorted((r["model_name"], r["name"]) for r in described) == [("a", "NAICS"), ("a", "SHIPMENT_WEIGHT"), ("b", "NAICS"), ("b", "SHIPMENT_WEIGHT")]
    assert all(r["available_values"] == sorted(values) for r in described if r["name"] == "NAICS")


@pytest.mark.parametrize("call", [LINE, {"model_type": "k_nearest_neighbors_regressor", "hyperparameters": {"n_neighbors": [3]}}, {"model_type": "gradient_boosting_regressor", "hyperparameters": {"n_estimators": [3], "max_depth": [2]}}, {"model_type": "decision_tree_regressor", "hyperparameters": {"max_depth": [5], "min_samples_split": [400]}}])
def test_published_models_are_loaded_from_the_log(spark, sf, tmp_path, call):
    from tabmill.plans.derived import shipments

    table = shipments(spark, sf, "SHIPMENT_ID", "SHIPMENT_VALUE", "SHIPMENT_WEIGHT")
    log_path = str(tmp_path / "log")
    done = job.run_scenario(spark, scenario("kept", ("shipment_weight", "shipment_value"), (LOG_BOTH,), (call,)), log_path, table)
    loaded = job.load_published(spark, log_path, "shipments")
    assert list(loaded) == [done.run_id] and job.load_published(spark, log_path, "other") == {}
    assert runlog_store.read(spark, log_path, "experiments").count() == 1
    some = table.orderBy("SHIPMENT_ID").limit(200)
    before = {r[0]: r[1] for r in score.score(some, done.scorer, keep=("SHIPMENT_ID",)).collect()}
    after = {r[0]: r[1] for r in score.score(some, loaded[done.run_id], keep=("SHIPMENT_ID",)).collect()}
    assert after == pytest.approx(before)


def test_all_log_jobs_run_on_the_shipments(spark, sf):
    from tabmill.plans.derived import shipments

    table = shipments(spark, sf)
    scaled = {"type": "standardization", "condition": "replace", "columns": ["shipment_weight", "shipment_value"]}
    post = {"intent": "measure", "n_samples": 100, "metrics": ["mae"], "seed": 1}
    config = scenario("all", ("shipment_weight", "shipment_value", "naics"), (LOG_BOTH, scaled, HOT_NAICS), (LINE,), ("mae",), post)
    out = job.run_scenario(spark, config, table=table)
    assert out.post_tests[0]["n_rows"] == 100
    # the post-test is on the scale of the raw value, far above the standardised errors of training
    assert out.post_tests[0]["mae"] > 1000 > out.metrics.agg(F.max("value")).first()[0]


def test_stream_equals_batch(spark, sf, tmp_path):
    from tabmill.plans.queries.scoring import _log_scorer

    source = tmp_path / "in"
    data = spark.range(400).select(F.col("id").cast("string").alias("SHIPMENT_ID"), F.when(F.col("id") % 9 == 0, "bad").otherwise((F.col("id") + 1).cast("string")).alias("SHIPMENT_WEIGHT"))
    scorer = _log_scorer(spark, sf)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for part in (data.where("cast(SHIPMENT_ID as int) < 200"), data.where("cast(SHIPMENT_ID as int) >= 200")):
        part.coalesce(1).write.mode("append").parquet(str(source))
        stream = score_stream.read_stream(spark, str(source), data.schema)
        score_stream.score_stream(stream, scorer, out, state, keep=("SHIPMENT_ID",)).awaitTermination()
    assert sorted(spark.read.parquet(out).collect()) == sorted(score.score(data, scorer, keep=("SHIPMENT_ID",)).collect())
    bad, state = str(tmp_path / "bad"), str(tmp_path / "bad-state")
    stream = score_stream.read_stream(spark, str(source), data.schema)
    score_stream.project_stream(stream, lambda df: validate.quarantine(df, scorer.manifest), bad, state).awaitTermination()
    assert spark.read.parquet(bad).count() + spark.read.parquet(out).count() == 400


def test_jobs_from_files(spark, sample_csv, tmp_path, capsys):
    import json
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    import run_job

    train = {**TRAIN, "properties": {**TRAIN["properties"], "objective": "best_model"}, "call": TRAIN["call"][1:]}
    for name in ("one", "two"):
        config = {**sample_job(sample_csv, CLEAN, TRANSFORM, train), "name": name}
        (tmp_path / f"{name}.json").write_text(json.dumps(config))
    run_job.main([str(tmp_path / "one.json"), str(tmp_path / "two.json"), "--log", str(tmp_path / "log"), "--exact-split"])
    shown = capsys.readouterr().out
    assert "one" in shown and "two" in shown and "validation.test.rmse" in shown
