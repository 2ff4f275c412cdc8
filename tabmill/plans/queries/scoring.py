"""Validation, batch and stream scoring, post-test."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import score, validate
from ...operators.models import Candidate, fit_one
from ...operators.transform import fit
from ...schema import COMMODITY_FLOW as SCHEMA
from ...sources.workspace import new_path
from ...streaming import score_stream
from ..derived import shipments, shipments_from, table
from . import sql
from .models import log_model, rows_for

ID, VALUE, WEIGHT = "SHIPMENT_ID", "SHIPMENT_VALUE", "SHIPMENT_WEIGHT"


def _incoming(rows):
    """Arriving rows as text, some with missing, unreadable, too large or unknown values."""
    quarter, mode = F.col("QUARTER"), F.col("MODE")
    weight = (
        F.when((quarter == "1") & (mode == "5-LOW"), None)
        .when((quarter == "2") & (mode == "5-LOW"), F.lit("heavy"))
        .when((quarter == "3") & (mode == "5-LOW"), (F.col(WEIGHT) + 2000).cast("string"))
        .otherwise(F.col(WEIGHT).cast("string"))
    )
    naics = F.when((quarter == "4") & (mode == "2-HIGH"), F.lit("UNKNOWN")).otherwise(F.col("NAICS"))
    return rows.select(ID, weight.alias(WEIGHT), naics.alias("NAICS"), "HAZMAT", "QUARTER")


_ARRIVING = (ID, WEIGHT, "NAICS", "HAZMAT", "QUARTER", "MODE")


def _manifest(spark, sf_dir):
    train = rows_for(spark, sf_dir, WEIGHT, "NAICS").where(F.col("stage") == "train")
    return validate.build_manifest(train.select(WEIGHT, "NAICS"), SCHEMA)


def _checked(spark, sf_dir):
    return validate.check(_incoming(shipments(spark, sf_dir, *_ARRIVING)), _manifest(spark, sf_dir))


def v_accept(spark, sf_dir):
    manifest = _manifest(spark, sf_dir)
    return validate.accept(_incoming(shipments(spark, sf_dir, *_ARRIVING)), manifest, keep=(ID,))


def v_quarantine(spark, sf_dir):
    bad = validate.quarantine(_incoming(shipments(spark, sf_dir, *_ARRIVING)), _manifest(spark, sf_dir))
    text = F.transform("errors", lambda e: F.concat_ws(":", e["column"], e["rule"], F.coalesce(e["value"], F.lit("-"))))
    return bad.select(ID, F.array_join(text, ";").alias("errors"))


def v_quarantine_reasons(spark, sf_dir):
    return validate.reasons(_checked(spark, sf_dir))


def v_wide_domain(spark, sf_dir):
    """A categorical input with many values, checked by a join instead of a list."""
    rows = rows_for(spark, sf_dir, "DESTINATION_CFS_AREA", "QUARTER")
    manifest = validate.build_manifest(
        rows.where(F.col("stage") == "train").select("DESTINATION_CFS_AREA"), SCHEMA, inline_values=20
    )
    odd = F.when(F.col("QUARTER") == "1", F.reverse("DESTINATION_CFS_AREA")).otherwise(F.col("DESTINATION_CFS_AREA"))
    return validate.reasons(validate.check(rows.withColumn("DESTINATION_CFS_AREA", odd), manifest))


def _log_scorer(spark, sf_dir, name="log_line"):
    rows, steps, model = log_model(spark, sf_dir)
    manifest = validate.build_manifest(rows.where(F.col("stage") == "train").select(WEIGHT), SCHEMA)
    return score.Scorer(name, SCHEMA, manifest, steps, model, "weight and value on logarithms")


def _plain_scorer(spark, sf_dir, name="line"):
    rows = rows_for(spark, sf_dir, WEIGHT)
    train = rows.where(F.col("stage") == "train")
    steps = fit(rows, [], SCHEMA)
    model = fit_one(Candidate("line", "linear_regression"), train, [WEIGHT], VALUE, ID)
    manifest = validate.build_manifest(train.select(WEIGHT), SCHEMA)
    return score.Scorer(name, SCHEMA, manifest, steps, model, "weight as it is")


def _scored(df):
    return df.withColumn("shipment_value", F.round("shipment_value", 3))


def s_batch_score(spark, sf_dir):
    rows = _incoming(shipments(spark, sf_dir, *_ARRIVING))
    return _scored(score.score(rows, _log_scorer(spark, sf_dir), keep=(ID,)))


def s_reloaded_scorer(spark, sf_dir):
    """The same scores from a model that was written and read back."""
    path = new_path(spark, "scorer")
    score.save_scorer(_log_scorer(spark, sf_dir), path)
    rows = _incoming(shipments(spark, sf_dir, *_ARRIVING))
    return _scored(score.score(rows, score.load_scorer(spark, path), keep=(ID,)))


def s_multi_model(spark, sf_dir):
    rows = _incoming(shipments(spark, sf_dir, *_ARRIVING))
    return _scored(score.score_many(rows, [_log_scorer(spark, sf_dir), _plain_scorer(spark, sf_dir)], keep=(ID,)))


def s_model_inputs(spark, sf_dir):
    rows, steps, model = log_model(spark, sf_dir)
    manifest = _manifest(spark, sf_dir)
    scorer = score.Scorer("log_line", SCHEMA, manifest, steps, model, "weight and value on logarithms")
    return score.model_inputs(spark, [scorer]).withColumn("available_values", F.array_join("available_values", "|"))


def s_model_inputs_wide(spark, sf_dir):
    """An input with more values than a list in the plan may hold, described whole."""
    rows, steps, model = log_model(spark, sf_dir)
    train = rows_for(spark, sf_dir, WEIGHT).where(F.col("stage") == "train")
    manifest = validate.build_manifest(train.select(F.substring(F.md5(ID), 1, 3).alias("SCTG"), WEIGHT), SCHEMA)
    scorer = score.Scorer("log_line", SCHEMA, manifest, steps, model, "weight and value on logarithms")
    return score.model_inputs(spark, [scorer]).withColumn("available_values", F.array_join("available_values", "|"))


def s_post_test(spark, sf_dir):
    steps = [{"type": "filter_columns", "columns": ["shipment_weight", "shipment_value"]}, {"type": "drop_na"}]
    raw = shipments(spark, sf_dir, ID, WEIGHT, VALUE)
    out = score.post_test(raw, _log_scorer(spark, sf_dir), steps, 5_000, ("rmse", "mae"), seed=7)
    return out.select("n_rows", F.round("rmse", 3).alias("rmse"), F.round("mae", 3).alias("mae"))


def s_stream_score(spark, sf_dir):
    """Lineitems arriving as files, scored by the same projection as the batch."""
    schema = table(spark, sf_dir, "lineitem").schema
    arriving = score_stream.read_stream(spark, f"{sf_dir}/lineitem*.parquet", schema)
    rows = _incoming(shipments_from(arriving, spark, sf_dir, *_ARRIVING))
    out, state = new_path(spark, "stream-scores"), new_path(spark, "stream-state")
    score_stream.score_stream(rows, _log_scorer(spark, sf_dir), out, state, keep=(ID,)).awaitTermination()
    return _scored(spark.read.parquet(out))


QUERIES = {
    f.__name__: f
    for f in (
        v_accept, v_quarantine, v_quarantine_reasons, v_wide_domain, s_batch_score, s_reloaded_scorer, s_multi_model,
        s_model_inputs, s_model_inputs_wide, s_post_test, s_stream_score,
    )
}

_IN = (
    sql.STAGED
    + """,
incoming as (
  select SHIPMENT_ID,
    case when QUARTER = '1' and MODE = '5-LOW' then null when QUARTER = '2' and MODE = '5-LOW' then 'heavy'
      when QUARTER = '3' and MODE = '5-LOW' then cast(SHIPMENT_WEIGHT + 2000 as varchar) else cast(SHIPMENT_WEIGHT as varchar) end as w,
    case when QUARTER = '4' and MODE = '2-HIGH' then 'UNKNOWN' else NAICS end as n
  from ship
),
bounds as (select min(SHIPMENT_WEIGHT) as lo, max(SHIPMENT_WEIGHT) as hi from staged where stage = 'train'),
known as (select distinct NAICS from staged where stage = 'train'),
judged as (
  select SHIPMENT_ID, w, n, try_cast(w as double) as x,
    case when w is null then 'missing' when try_cast(w as double) is null then 'not_a_number'
      when try_cast(w as double) < lo or try_cast(w as double) > hi then 'range' end as w_rule,
    case when n not in (select NAICS from known) then 'unknown_value' end as n_rule
  from incoming, bounds
)"""
)
_SCORED = f"with {_IN}, {sql.LOG_LINE} select SHIPMENT_ID, round(exp(a + b * ln(x)), 3) as shipment_value from judged, line where w_rule is null"

ORACLE = {
    "v_accept": f"with {_IN} select SHIPMENT_ID, x as SHIPMENT_WEIGHT, n as NAICS from judged where w_rule is null and n_rule is null",
    "v_quarantine": f"""with {_IN} select SHIPMENT_ID, concat_ws(';',
          case when n_rule is not null then 'NAICS:' || n_rule || ':' || n end,
          case when w_rule is not null then 'SHIPMENT_WEIGHT:' || w_rule || ':' || coalesce(w, '-') end) as errors
        from judged where w_rule is not null or n_rule is not null""",
    "v_quarantine_reasons": f"""with {_IN} select 'SHIPMENT_WEIGHT' as "column", w_rule as rule, count(*) as n_rows from judged where w_rule is not null group by 2
        union all select 'NAICS', n_rule, count(*) from judged where n_rule is not null group by 2""",
    "v_wide_domain": f"""with {sql.STAGED}, known as (select distinct DESTINATION_CFS_AREA as k from staged where stage = 'train')
        select 'DESTINATION_CFS_AREA' as "column", 'unknown_value' as rule, count(*) as n_rows from staged
        where case when QUARTER = '1' then reverse(DESTINATION_CFS_AREA) else DESTINATION_CFS_AREA end not in (select k from known)""",
    "s_batch_score": _SCORED,
    "s_reloaded_scorer": _SCORED,
    "s_stream_score": _SCORED,
    "s_multi_model": f"""with {_IN}, g as (select regr_slope(ln(SHIPMENT_VALUE), ln(SHIPMENT_WEIGHT)) as lb, regr_intercept(ln(SHIPMENT_VALUE), ln(SHIPMENT_WEIGHT)) as la,
          regr_slope(SHIPMENT_VALUE, SHIPMENT_WEIGHT) as b, regr_intercept(SHIPMENT_VALUE, SHIPMENT_WEIGHT) as a from staged where stage = 'train')
        select SHIPMENT_ID, round(exp(la + lb * ln(x)), 3) as shipment_value, 'log_line' as model_name from judged, g where w_rule is null
        union all select SHIPMENT_ID, round(a + b * x, 3), 'line' from judged, g where w_rule is null""",
    "s_model_inputs": f"""with {sql.STAGED} select 'log_line' as model_name, 'weight and value on logarithms' as description, 'NAICS' as name,
          'categorical' as type, null::double as min, null::double as max, string_agg(distinct NAICS, '|' order by NAICS) as available_values
        from staged where stage = 'train'
        union all select 'log_line', 'weight and value on logarithms', 'SHIPMENT_WEIGHT', 'numerical', min(SHIPMENT_WEIGHT), max(SHIPMENT_WEIGHT), null
        from staged where stage = 'train'""",
    "s_model_inputs_wide": f"""with {sql.STAGED} select 'log_line' as model_name, 'weight and value on logarithms' as description, 'SCTG' as name,
          'categorical' as type, null::double as min, null::double as max,
          string_agg(distinct substr(md5(SHIPMENT_ID), 1, 3), '|' order by substr(md5(SHIPMENT_ID), 1, 3)) as available_values
        from staged where stage = 'train'
        union all select 'log_line', 'weight and value on logarithms', 'SHIPMENT_WEIGHT', 'numerical', min(SHIPMENT_WEIGHT), max(SHIPMENT_WEIGHT), null
        from staged where stage = 'train'""",
    "s_post_test": f"""with {sql.STAGED}, {sql.LOG_LINE}, sampled as (select * from ship order by md5(concat(SHIPMENT_ID, '-7')) limit 5000),
        e as (select SHIPMENT_VALUE - exp(a + b * ln(SHIPMENT_WEIGHT)) as d from sampled, line)
        select count(*) as n_rows, round(sqrt(avg(d * d)), 3) as rmse, round(avg(abs(d)), 3) as mae from e""",
}
