"""Fitted transformations and derived features."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ...operators import features
from ...operators.clean import clean
from ...operators.split import split
from ...operators.transform import (
    FunctionPair,
    apply_steps,
    fit,
    invert_target,
    load_steps,
    register_pair,
    save_steps,
)
from ...schema import COMMODITY_FLOW as SCHEMA
from ...sources.tables import stored_splits
from ...sources.workspace import new_path
from ..derived import shipments
from . import sql

ID, VALUE, WEIGHT = "SHIPMENT_ID", "SHIPMENT_VALUE", "SHIPMENT_WEIGHT"
CIRCLE, ROUTE = "SHIPMENT_DISTANCE_CIRCLE", "SHIPMENT_DISTANCE_ROUTE"

SQUARE = register_pair(FunctionPair("square", lambda x: x * x, F.sqrt))


def _split(spark, sf_dir, *columns):
    return split(shipments(spark, sf_dir, ID, *columns), SCHEMA)


def _stored(spark, sf_dir, *columns):
    """As `_split`, written once because fitting and applying both read it."""
    return stored_splits(_split(spark, sf_dir, *columns))


def _step(kind, *columns, condition="replace"):
    return {"type": kind, "columns": [c.lower() for c in columns], "condition": condition}


def _run(rows, steps, **options):
    return apply_steps(rows, fit(rows, steps, SCHEMA, **options))


def _rounded(df, *columns, digits=4):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


def prep_log_summary(spark, sf_dir):
    steps = [{"type": "filter_columns", "columns": ["shipment_weight", "shipment_value"]}, {"type": "drop_na"}]
    rows = clean(shipments(spark, sf_dir, ID, WEIGHT, VALUE, "NAICS"), SCHEMA, steps, carry_id=True)
    out = _run(split(rows, SCHEMA), [_step("log_transformation", WEIGHT, VALUE)])
    return out.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg(WEIGHT), 4).alias("mean_log_weight"),
        F.round(F.avg(VALUE), 4).alias("mean_log_value"),
        F.round(F.stddev_pop(VALUE), 4).alias("std_log_value"),
    )


def t_log(spark, sf_dir):
    out = _run(_split(spark, sf_dir, WEIGHT, CIRCLE), [_step("log_transformation", WEIGHT, CIRCLE)])
    below = F.col(CIRCLE) == F.lit(float("-inf"))
    return out.select(
        ID, F.round(WEIGHT, 4).alias(WEIGHT), below.alias("zero_distance"), F.round(F.when(~below, F.col(CIRCLE)), 4).alias(CIRCLE)
    )


def t_sign(spark, sf_dir):
    rows = _split(spark, sf_dir, CIRCLE).withColumn(CIRCLE, F.col(CIRCLE) - 500)
    return _run(rows, [_step("normalization", CIRCLE)]).select(ID, "stage", CIRCLE)


def t_minmax(spark, sf_dir):
    out = _run(_stored(spark, sf_dir, WEIGHT, ROUTE), [_step("min_max_transformation", WEIGHT, ROUTE)])
    return _rounded(out, WEIGHT, ROUTE)


def t_minmax_constant_column(spark, sf_dir):
    rows = _split(spark, sf_dir, WEIGHT).withColumn(WEIGHT, F.lit(7.5))
    out = _run(rows, [_step("min_max_transformation", WEIGHT)])
    return out.groupBy("stage", WEIGHT).agg(F.count(F.lit(1)).alias("n_rows"))


def t_standardize(spark, sf_dir):
    out = _run(_stored(spark, sf_dir, WEIGHT, ROUTE), [_step("standardization", WEIGHT, ROUTE)])
    return _rounded(out, WEIGHT, ROUTE)


def t_onehot(spark, sf_dir):
    return _run(_stored(spark, sf_dir, "NAICS", "QUARTER", "HAZMAT"), [_step("one_hot_encoding", "NAICS", "QUARTER", "HAZMAT")])


def t_onehot_unseen(spark, sf_dir):
    rows = _stored(spark, sf_dir, "QUARTER", "HAZMAT")
    late = (F.col("stage") != "train") & (F.col("QUARTER") == "4")
    out = _run(rows.withColumn("HAZMAT", F.when(late, "X").otherwise(F.col("HAZMAT"))), [_step("one_hot_encoding", "HAZMAT")])
    hot = sum((F.col(c) for c in out.columns if c.startswith("HAZMAT_")), F.lit(0))
    return out.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(hot == 0, 1)).alias("all_zero"), F.max(hot).alias("most_hot")
    )


def t_onehot_wide(spark, sf_dir):
    rows = _stored(spark, sf_dir, "DESTINATION_CFS_AREA")
    rows = rows.withColumn("area", F.col("DESTINATION_CFS_AREA"))
    out = _run(rows, [_step("one_hot_encoding", "DESTINATION_CFS_AREA")], max_width=50)
    hot = vector_to_array("DESTINATION_CFS_AREA_vector")
    return out.select(ID, "area", (F.array_position(hot, F.lit(1.0)) - 1).alias("hot_index"), F.size(hot).alias("width"))


def t_append_log(spark, sf_dir):
    out = _run(_split(spark, sf_dir, WEIGHT), [_step("log_transformation", WEIGHT, condition="append")])
    return _rounded(out, f"{WEIGHT}_log")


_LOG_STD = [_step("log_transformation", WEIGHT), _step("standardization", WEIGHT)]


def t_log_then_std_raw(spark, sf_dir):
    return _rounded(_run(_stored(spark, sf_dir, WEIGHT), _LOG_STD, fit_mode="raw"), WEIGHT)


def t_log_then_std_chained(spark, sf_dir):
    return _rounded(_run(_stored(spark, sf_dir, WEIGHT), _LOG_STD), WEIGHT)


_TARGET_CHAIN = [_step("log_transformation", VALUE), _step("standardization", VALUE), _step("min_max_transformation", VALUE)]


def t_inverse_roundtrip(spark, sf_dir):
    rows = _stored(spark, sf_dir, VALUE)
    steps = fit(rows, _TARGET_CHAIN, SCHEMA)
    out = apply_steps(rows, steps)
    return out.select(ID, F.round(VALUE, 4).alias("scaled"), F.round(invert_target(F.col(VALUE), steps), 2).alias("restored"))


_REPLAYED = [
    _step("log_transformation", WEIGHT),
    _step("standardization", WEIGHT),
    _step("min_max_transformation", ROUTE),
    _step("one_hot_encoding", "HAZMAT"),
]


def t_params_table(spark, sf_dir):
    path = new_path(spark, "steps")
    save_steps(spark, fit(_stored(spark, sf_dir, WEIGHT, ROUTE, "HAZMAT"), _REPLAYED, SCHEMA), path)
    saved = spark.read.parquet(path)
    return saved.select(
        "position", "ordinal", "id", "name", "column", "method", "is_target",
        *[F.round(F.element_at("params", F.lit(p)), 4).alias(p) for p in ("mean", "min", "scale")],
        F.array_join("categories", "|").alias("categories"),
    )


def t_params_replay(spark, sf_dir):
    path = new_path(spark, "steps")
    rows = _stored(spark, sf_dir, WEIGHT, ROUTE, "HAZMAT")
    save_steps(spark, fit(rows, _REPLAYED, SCHEMA), path)
    return _rounded(apply_steps(rows, load_steps(spark, path)), WEIGHT, ROUTE)


def t_custom_pair(spark, sf_dir):
    rows = _split(spark, sf_dir, WEIGHT, VALUE)
    steps = fit(rows, [_step("square", WEIGHT, condition="append"), _step("square", VALUE)], SCHEMA)
    out = apply_steps(rows, steps)
    return out.select(ID, f"{WEIGHT}_square", F.round(invert_target(F.col(VALUE), steps), 2).alias("restored"))


_ENDS = ("ORIGIN_STATE", "DESTINATION_STATE")


def f_interstate(spark, sf_dir):
    return features.interstate(shipments(spark, sf_dir, ID, *_ENDS))


def f_freq_encode(spark, sf_dir):
    rows = _stored(spark, sf_dir, VALUE, *_ENDS)
    return features.frequency_encode(rows, features.fit_encoding(rows, _ENDS, VALUE)).drop(VALUE)


def f_mean_encode(spark, sf_dir):
    rows = _stored(spark, sf_dir, VALUE, *_ENDS)
    out = features.mean_encode(rows, features.fit_encoding(rows, _ENDS, VALUE)).drop(VALUE)
    return _rounded(out, *[f"{c}_MEAN" for c in _ENDS])


def f_geo_all(spark, sf_dir):
    rows = _stored(spark, sf_dir, WEIGHT, VALUE, *_ENDS)
    # two states of the held-out rows were never seen in training
    unseen = (F.col("stage") != "train") & F.col("ORIGIN_STATE").isin("03", "07")
    rows = rows.withColumn("ORIGIN_STATE", F.when(unseen, F.concat(F.lit("9"), "ORIGIN_STATE")).otherwise(F.col("ORIGIN_STATE")))
    return _rounded(features.geo_features(rows, VALUE), *[f"{c}_MEAN" for c in _ENDS])


QUERIES = {
    f.__name__: f
    for f in (
        prep_log_summary, t_log, t_sign, t_minmax, t_minmax_constant_column, t_standardize, t_onehot, t_onehot_unseen,
        t_onehot_wide, t_append_log, t_log_then_std_raw, t_log_then_std_chained, t_inverse_roundtrip, t_params_table,
        t_params_replay, t_custom_pair, f_interstate, f_freq_encode, f_mean_encode, f_geo_all,
    )
}

_T = "from staged where stage = 'train'"
_NAICS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
_HOT = ", ".join(
    f"case when {c} = '{v}' then 1 else 0 end as \"{c}_{v}\""
    for c, values in (("NAICS", _NAICS), ("QUARTER", "1234"), ("HAZMAT", "FO"))
    for v in values
)
_LOGSTD = "(ln(SHIPMENT_WEIGHT) - m) / s"
_FREQ = "(select {c} as k, count(*) as n, avg(SHIPMENT_VALUE) as m from staged where stage = 'train' group by 1)"

ORACLE = {
    "prep_log_summary": f"""with {sql.STAGED} select stage, count(*) as n_rows, round(avg(ln(SHIPMENT_WEIGHT)), 4) as mean_log_weight,
        round(avg(ln(SHIPMENT_VALUE)), 4) as mean_log_value, round(stddev_pop(ln(SHIPMENT_VALUE)), 4) as std_log_value
        from staged group by stage""",
    "t_log": f"""with {sql.SHIP} select SHIPMENT_ID, round(ln(SHIPMENT_WEIGHT), 4) as SHIPMENT_WEIGHT,
        SHIPMENT_DISTANCE_CIRCLE = 0 as zero_distance,
        case when SHIPMENT_DISTANCE_CIRCLE > 0 then round(ln(SHIPMENT_DISTANCE_CIRCLE), 4) end as SHIPMENT_DISTANCE_CIRCLE from ship""",
    "t_sign": f"""with {sql.STAGED} select SHIPMENT_ID, stage, cast(sign(SHIPMENT_DISTANCE_CIRCLE - 500) as double) as SHIPMENT_DISTANCE_CIRCLE from staged""",
    "t_minmax": f"""with {sql.STAGED}, p as (select min(SHIPMENT_WEIGHT) as w0, max(SHIPMENT_WEIGHT) as w1,
        min(SHIPMENT_DISTANCE_ROUTE) as r0, max(SHIPMENT_DISTANCE_ROUTE) as r1 {_T})
        select SHIPMENT_ID, stage, round((SHIPMENT_WEIGHT - w0) / (w1 - w0), 4) as SHIPMENT_WEIGHT,
        round((SHIPMENT_DISTANCE_ROUTE - r0) / (r1 - r0), 4) as SHIPMENT_DISTANCE_ROUTE from staged, p""",
    "t_minmax_constant_column": f"with {sql.STAGED} select stage, cast(0 as double) as SHIPMENT_WEIGHT, count(*) as n_rows from staged group by 1",
    "t_standardize": f"""with {sql.STAGED}, p as (select avg(SHIPMENT_WEIGHT) as wm, stddev_pop(SHIPMENT_WEIGHT) as ws,
        avg(SHIPMENT_DISTANCE_ROUTE) as rm, stddev_pop(SHIPMENT_DISTANCE_ROUTE) as rs {_T})
        select SHIPMENT_ID, stage, round((SHIPMENT_WEIGHT - wm) / ws, 4) as SHIPMENT_WEIGHT,
        round((SHIPMENT_DISTANCE_ROUTE - rm) / rs, 4) as SHIPMENT_DISTANCE_ROUTE from staged, p""",
    "t_onehot": f"with {sql.STAGED} select SHIPMENT_ID, stage, {_HOT} from staged",
    "t_onehot_unseen": f"""with {sql.STAGED} select stage, count(*) as n_rows,
        count(*) filter (stage <> 'train' and QUARTER = '4') as all_zero, cast(1 as integer) as most_hot from staged group by stage""",
    "t_onehot_wide": f"""with {sql.STAGED}, domain as (
          select v, row_number() over (order by v) - 1 as i from (select distinct DESTINATION_CFS_AREA as v {_T}))
        select SHIPMENT_ID, DESTINATION_CFS_AREA as area, coalesce(i, -1) as hot_index,
          cast((select count(*) from domain) as integer) as width
        from staged left join domain on v = DESTINATION_CFS_AREA""",
    "t_append_log": f"""with {sql.STAGED} select SHIPMENT_ID, SHIPMENT_WEIGHT, stage, round(ln(SHIPMENT_WEIGHT), 4) as SHIPMENT_WEIGHT_log from staged""",
    "t_log_then_std_raw": f"""with {sql.STAGED}, p as (select avg(SHIPMENT_WEIGHT) as m, stddev_pop(SHIPMENT_WEIGHT) as s {_T})
        select SHIPMENT_ID, stage, round({_LOGSTD}, 4) as SHIPMENT_WEIGHT from staged, p""",
    "t_log_then_std_chained": f"""with {sql.STAGED}, p as (select avg(ln(SHIPMENT_WEIGHT)) as m, stddev_pop(ln(SHIPMENT_WEIGHT)) as s {_T})
        select SHIPMENT_ID, stage, round({_LOGSTD}, 4) as SHIPMENT_WEIGHT from staged, p""",
    "t_inverse_roundtrip": f"""with {sql.STAGED}, p as (select avg(ln(SHIPMENT_VALUE)) as m, stddev_pop(ln(SHIPMENT_VALUE)) as s,
          min(ln(SHIPMENT_VALUE)) as lo, max(ln(SHIPMENT_VALUE)) as hi {_T})
        select SHIPMENT_ID, round(((ln(SHIPMENT_VALUE) - m) / s - (lo - m) / s) / ((hi - m) / s - (lo - m) / s), 4) as scaled,
          round(SHIPMENT_VALUE, 2) as restored from staged, p""",
    "t_params_table": f"""with {sql.STAGED}, p as (select avg(ln(SHIPMENT_WEIGHT)) as m, stddev_pop(ln(SHIPMENT_WEIGHT)) as s,
          min(SHIPMENT_DISTANCE_ROUTE) as lo, max(SHIPMENT_DISTANCE_ROUTE) as hi, string_agg(distinct HAZMAT, '|' order by HAZMAT) as cats {_T})
        select 0::integer as position, 0::integer as ordinal, 'log-00-shipment_weight' as id, 'log' as name, 'SHIPMENT_WEIGHT' as "column",
          'REPLACE' as method, false as is_target, null::double as mean, null::double as min, null::double as scale, null as categories
        union all select 1, 1, 'std-01-shipment_weight', 'standardization', 'SHIPMENT_WEIGHT', 'REPLACE', false, round(m, 4), null, round(s, 4), null from p
        union all select 2, 2, 'minmax-02-shipment_distance_route', 'min_max', 'SHIPMENT_DISTANCE_ROUTE', 'REPLACE', false, null, round(lo, 4), round(hi - lo, 4), null from p
        union all select 3, 3, 'ohe-03-hazmat', 'one_hot_encoding', 'HAZMAT', 'APPEND_AND_REMOVE', false, null, null, null, cats from p""",
    "t_params_replay": f"""with {sql.STAGED}, p as (select avg(ln(SHIPMENT_WEIGHT)) as m, stddev_pop(ln(SHIPMENT_WEIGHT)) as s,
          min(SHIPMENT_DISTANCE_ROUTE) as lo, max(SHIPMENT_DISTANCE_ROUTE) as hi {_T})
        select SHIPMENT_ID, round({_LOGSTD}, 4) as SHIPMENT_WEIGHT, round((SHIPMENT_DISTANCE_ROUTE - lo) / (hi - lo), 4) as SHIPMENT_DISTANCE_ROUTE,
          stage, case when HAZMAT = 'F' then 1 else 0 end as "HAZMAT_F", case when HAZMAT = 'O' then 1 else 0 end as "HAZMAT_O" from staged, p""",
    "t_custom_pair": f"""with {sql.SHIP} select SHIPMENT_ID, SHIPMENT_WEIGHT * SHIPMENT_WEIGHT as SHIPMENT_WEIGHT_square,
        round(SHIPMENT_VALUE, 2) as restored from ship""",
    "f_interstate": f"""with {sql.SHIP} select SHIPMENT_ID, ORIGIN_STATE, DESTINATION_STATE,
        cast(ORIGIN_STATE <> DESTINATION_STATE as integer) as IS_INTERSTATE from ship""",
    "f_freq_encode": f"""with {sql.STAGED}, o as {_FREQ.format(c='ORIGIN_STATE')}, d as {_FREQ.format(c='DESTINATION_STATE')}
        select SHIPMENT_ID, ORIGIN_STATE, DESTINATION_STATE, stage, coalesce(o.n, 0) as ORIGIN_STATE_FREQ,
        coalesce(d.n, 0) as DESTINATION_STATE_FREQ from staged left join o on o.k = ORIGIN_STATE left join d on d.k = DESTINATION_STATE""",
    "f_mean_encode": f"""with {sql.STAGED}, o as {_FREQ.format(c='ORIGIN_STATE')}, d as {_FREQ.format(c='DESTINATION_STATE')},
        g as (select avg(SHIPMENT_VALUE) as m {_T})
        select SHIPMENT_ID, ORIGIN_STATE, DESTINATION_STATE, stage, round(coalesce(o.m, g.m), 4) as ORIGIN_STATE_MEAN,
        round(coalesce(d.m, g.m), 4) as DESTINATION_STATE_MEAN
        from staged cross join g left join o on o.k = ORIGIN_STATE left join d on d.k = DESTINATION_STATE""",
    "f_geo_all": f"""with {sql.STAGED}, o as {_FREQ.format(c='ORIGIN_STATE')}, d as {_FREQ.format(c='DESTINATION_STATE')},
        g as (select avg(SHIPMENT_VALUE) as m {_T}),
        changed as (select * replace (case when stage <> 'train' and ORIGIN_STATE in ('03', '07') then concat('9', ORIGIN_STATE) else ORIGIN_STATE end as ORIGIN_STATE) from staged)
        select SHIPMENT_ID, SHIPMENT_WEIGHT, SHIPMENT_VALUE, stage, cast(ORIGIN_STATE <> DESTINATION_STATE as integer) as IS_INTERSTATE,
        coalesce(o.n, 0) as ORIGIN_STATE_FREQ, round(coalesce(o.m, g.m), 4) as ORIGIN_STATE_MEAN,
        coalesce(d.n, 0) as DESTINATION_STATE_FREQ, round(coalesce(d.m, g.m), 4) as DESTINATION_STATE_MEAN
        from changed cross join g left join o on o.k = ORIGIN_STATE left join d on d.k = DESTINATION_STATE""",
}
