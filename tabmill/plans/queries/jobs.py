"""Declared jobs over the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import profile, score
from ...sources.runlog_store import read
from ...sources.tables import save_csv
from ...sources.workspace import new_path
from .. import job
from ..derived import shipments
from . import sql

WEIGHT, VALUE = "SHIPMENT_WEIGHT", "SHIPMENT_VALUE"


def scenario(name, columns, transforms, models=(), metrics=("mae", "rmse"), post=None, path="", file="shipments"):
    """A declared job over the shipments."""
    steps = [
        {
            "type": "data_io",
            "properties": {"path": path, "file": file, "format": "csv", "reference": "commodity_flow"},
            "call": [{"type": "load", "n_rows": None}],
        },
        {
            "type": "data_cleaner",
            "properties": {"reference": "commodity_flow"},
            "call": [{"type": "filter_columns", "columns": list(columns)}, {"type": "drop_na"}],
        },
        {"type": "data_transformer", "properties": {"reference": "commodity_flow"}, "call": list(transforms)},
    ]
    if models:
        steps.append(
            {
                "type": "model_trainer",
                "properties": {
                    "objective": "best_model",
                    "parameter_grid": {"type": "exhaustive"},
                    "primary_metric": metrics[0],
                    "metrics": list(metrics),
                },
                "call": list(models),
            }
        )
    if post:
        steps.append({"type": "post_test", "properties": {"reference": "commodity_flow"}, "call": [post]})
    return {"name": name, "description": f"{name} over {', '.join(columns)}", "repository": {"experiment_id": "shipments"}, "instructions": steps}


LOG_BOTH = {"type": "log_transformation", "condition": "replace", "columns": ["shipment_weight", "shipment_value"]}
HOT_NAICS = {"type": "one_hot_encoding", "condition": "append_and_remove", "columns": ["naics"]}
LINE = {"model_type": "linear_regression", "hyperparameters": {}}


def job_prepare_scenario(spark, sf_dir):
    """From a CSV file to split, logged and encoded rows, summarised per stage."""
    folder = new_path(spark, "job")
    rows = shipments(spark, sf_dir)
    save_csv(rows, f"{folder}/shipments.csv")
    config = scenario("prepare", ("shipment_weight", "shipment_value", "naics"), (LOG_BOTH, HOT_NAICS), path=folder)
    prepared = job.run_scenario(spark, config).prepared
    hot = [c for c in prepared.rows.columns if c.startswith("NAICS_")]
    return prepared.rows.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg(WEIGHT), 4).alias("mean_log_weight"),
        F.round(F.avg(VALUE), 4).alias("mean_log_value"),
        F.sum(hot[0]).alias("first_category"),
        F.lit(len(prepared.features)).cast("bigint").alias("n_features"),
    )


def job_post_test(spark, sf_dir):
    """Logged line trained by a job, then compared with a random sample on the original scale."""
    post = {"intent": "error on raw values", "n_samples": 5000, "metrics": ["rmse", "mae"], "seed": 42}
    config = scenario("post", ("shipment_weight", "shipment_value"), (LOG_BOTH,), (LINE,), post=post)
    result = job.run_scenario(spark, config, table=shipments(spark, sf_dir, *_TEXT))
    r = result.post_tests[0]
    return spark.createDataFrame([(r["n_rows"], r["rmse"], r["mae"])], "n_rows bigint, rmse double, mae double").select(
        "n_rows", F.round("rmse", 3).alias("rmse"), F.round("mae", 3).alias("mae")
    )


def job_publish_reload_score(spark, sf_dir):
    """The model that a job published, loaded from the run log by a later reader and applied to all rows."""
    log = new_path(spark, "publish-log")
    table = shipments(spark, sf_dir, *_TEXT)
    job.run_scenario(spark, scenario("publish", ("shipment_weight", "shipment_value"), (LOG_BOTH,), (LINE,)), log, table)
    (scorer,) = job.load_published(spark, log, "shipments").values()
    out = score.score(table.select("SHIPMENT_ID", WEIGHT), scorer, keep=("SHIPMENT_ID",))
    return out.select("SHIPMENT_ID", F.round(scorer.output, 3).alias("prediction"))


_TEXT = ("SHIPMENT_ID", "NAICS", "SHIPMENT_VALUE", "SHIPMENT_WEIGHT")


def job_sweep(spark, sf_dir):
    """Three jobs into one log: the comparison of their best models."""
    log = new_path(spark, "sweep-log")
    table = shipments(spark, sf_dir, *_TEXT)
    tree = {"model_type": "decision_tree_regressor", "hyperparameters": {"max_depth": [2, 3], "random_state": [42]}}
    configs = [
        scenario("raw_line", ("shipment_weight", "shipment_value"), (), (LINE,)),
        scenario("logged_line", ("shipment_weight", "shipment_value"), (LOG_BOTH,), (LINE, tree)),
        scenario("logged_naics", ("shipment_weight", "shipment_value", "naics"), (LOG_BOTH, HOT_NAICS), (LINE,)),
    ]
    out = job.run_sweep(spark, configs, log, table)
    return out.select("intent", "model", "key", "value")


def job_stage_timers(spark, sf_dir):
    """The timers that a job leaves in its log when its stages are run one by one, with the rows that it read."""
    log = new_path(spark, "timers-log")
    table = shipments(spark, sf_dir, *_TEXT)
    post = {"intent": "error on raw values", "n_samples": 50, "metrics": ["mae"], "seed": 42}
    config = scenario("timed", ("shipment_weight", "shipment_value", "naics"), (LOG_BOTH, HOT_NAICS), (LINE,), post=post)
    done = job.run_scenario(spark, config, log, table, timers="stages")
    sizes = read(spark, log, "properties").where((F.col("run_id") == done.run_id) & (F.col("key") == "size.load.row"))
    return (
        profile.stage_timings(read(spark, log, "metrics"))
        .select("key", "runs", (F.col("mean_ms") > 0).alias("timed"), F.lit(int(sizes.first()["value"])).cast("bigint").alias("rows_read"))
    )


QUERIES = {
    f.__name__: f
    for f in (job_prepare_scenario, job_post_test, job_sweep, job_publish_reload_score, job_stage_timers)
}

ORACLE = {
    "job_stage_timers": f"""with {sql.SHIP}, keys(key) as (values ('time_ms.loading'), ('time_ms.cleaning'), ('time_ms.transforming.log'),
          ('time_ms.transforming.one_hot_encoding'), ('time_ms.transforming.all'), ('time_ms.train'), ('time_ms.validation.train'),
          ('time_ms.validation.valid'), ('time_ms.validation.test'), ('time_ms.validation.post_test'), ('time_ms.all'))
        select key, cast(1 as bigint) as runs, true as timed, (select count(*) from ship) as rows_read from keys""",
    "job_prepare_scenario": f"""with {sql.STAGED} select stage, count(*) as n_rows, round(avg(ln(SHIPMENT_WEIGHT)), 4) as mean_log_weight,
        round(avg(ln(SHIPMENT_VALUE)), 4) as mean_log_value, count(*) filter (NAICS = 'ECONOMY') as first_category,
        cast(1 + (select count(distinct NAICS) from staged where stage = 'train') as bigint) as n_features from staged group by stage""",
    "job_publish_reload_score": f"""with {sql.STAGED}, {sql.LOG_LINE}
        select SHIPMENT_ID, round(exp(a + b * ln(SHIPMENT_WEIGHT)), 3) as prediction from ship, line""",
    "job_post_test": f"""with {sql.STAGED}, {sql.LOG_LINE}, sampled as (select * from ship order by md5(concat(SHIPMENT_ID, '-42')) limit 5000),
        e as (select SHIPMENT_VALUE - exp(a + b * ln(SHIPMENT_WEIGHT)) as d from sampled, line)
        select count(*) as n_rows, round(sqrt(avg(d * d)), 3) as rmse, round(avg(abs(d)), 3) as mae from e""",
}
