"""Run-log analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import profile, runlog
from ...sources import runlog_store
from ...sources.workspace import materialize, new_path
from .. import derived

TRAIN, VALID, TEST = (derived.METRIC_KEYS[flag] for flag in "ANR")


def r_best_child(spark, sf_dir):
    return runlog.best_child(derived.children_only(spark, sf_dir), derived.metrics(spark, sf_dir), VALID)


def r_champion(spark, sf_dir):
    return runlog.champions(derived.child_runs(spark, sf_dir), derived.metrics(spark, sf_dir), derived.tags(spark, sf_dir), VALID)


def r_latest_metrics(spark, sf_dir):
    return runlog.latest(derived.metrics(spark, sf_dir))


def r_latest_pivot(spark, sf_dir):
    keys = list(derived.METRIC_KEYS.values())
    wide = runlog.pivot_latest(derived.metrics(spark, sf_dir), keys)
    return wide.select("run_id", *[F.col(f"`{k}`").alias(k.split(".")[1]) for k in keys])


def r_children(spark, sf_dir):
    return runlog.children(derived.children_only(spark, sf_dir))


def r_fan_out(spark, sf_dir):
    return runlog.fan_out(derived.children_only(spark, sf_dir))


def r_objects(spark, sf_dir):
    return runlog.objects_of_runs(derived.objects(spark, sf_dir))


def r_objects_under_parent(spark, sf_dir):
    return runlog.objects_under_parents(derived.children_only(spark, sf_dir), derived.objects(spark, sf_dir))


def r_published(spark, sf_dir):
    return runlog.published_candidates(derived.parents(spark, sf_dir), derived.tags(spark, sf_dir))


def r_prev_published(spark, sf_dir):
    return runlog.previously_published(
        derived.runs(spark, sf_dir),
        derived.tags(spark, sf_dir),
        derived.properties(spark, sf_dir),
        derived.metrics(spark, sf_dir),
        "mae",
    )


def r_upsert_tags(spark, sf_dir):
    return runlog.current_tags(derived.event_entries(spark, sf_dir)).drop("written_at")


def r_tagged_best(spark, sf_dir):
    return runlog.tagged_best(derived.children_only(spark, sf_dir), derived.tags(spark, sf_dir))


def r_first_property(spark, sf_dir):
    return runlog.first_property(derived.event_entries(spark, sf_dir), "purchase")


def r_intents(spark, sf_dir):
    return runlog.intents(derived.properties(spark, sf_dir))


def r_run_by_name(spark, sf_dir):
    """Name and id of every run, resolved back through its name."""
    runs = derived.runs(spark, sf_dir)
    return runs.groupBy("name").agg(F.min(F.struct("id", "parent_id")).alias("r")).select("name", "r.id", "r.parent_id")


def r_nominate_history(spark, sf_dir):
    # read twice, by row and by day: join once
    runs = materialize(derived.nominations(spark, sf_dir), "nominations")
    return runlog.nomination_history(runs, F.to_date("written_at")).select("experiment_id", "intent", "id", "score", "status")


def r_run_card(spark, sf_dir):
    return runlog.run_cards(
        derived.children_only(spark, sf_dir),
        derived.tags(spark, sf_dir),
        derived.properties(spark, sf_dir),
        derived.metrics(spark, sf_dir),
    )


def r_latest_per_base_stage(spark, sf_dir):
    out = runlog.latest_per_base_stage(derived.based_runs(spark, sf_dir))
    return out.withColumn("created", F.date_format("created", "yyyy-MM-dd"))


def r_tag_conjunction(spark, sf_dir):
    wanted = {"priority": "1-URGENT", "state": "F"}
    return runlog.children_with_tags(derived.children_only(spark, sf_dir), derived.order_tags(spark, sf_dir), wanted)


def r_metric_rounding(spark, sf_dir):
    metrics = derived.metrics(spark, sf_dir)
    return runlog.round_metrics(metrics.withColumn("value", F.col("value") / 8)).select("id", "key", "value")


def r_timings(spark, sf_dir):
    """Events as timers of the log."""
    timers = derived.event_entries(spark, sf_dir).withColumn("key", F.concat(F.lit("time_ms."), "key"))
    out = profile.stage_timings(timers)
    return out.select("key", "runs", F.round("mean_ms", 4).alias("mean_ms"), "max_ms")


def r_append_read(spark, sf_dir):
    """All metrics appended to the stored log in three batches and read back."""
    path = new_path(spark, "log")
    metrics = derived.metrics(spark, sf_dir)
    for key in (TRAIN, VALID, TEST):
        runlog_store.append(metrics.where(F.col("key") == key), path, "metrics")
    stored = runlog_store.read(spark, path, "metrics")
    return stored.groupBy("key").agg(F.count(F.lit(1)).alias("entries"), F.round(F.sum("value"), 2).alias("total"))


def r_manifest_rows(spark, sf_dir):
    """Manifests stored as JSON, one per segment, read as typed rows."""
    customer = derived.table(spark, sf_dir, "customer")
    bounds = customer.groupBy("c_mktsegment").agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))
    entry = F.array(F.struct(F.lit("balance").alias("name"), F.lit("numerical").alias("type"), F.col("lo").alias("min"), F.col("hi").alias("max")))
    objects = bounds.select(
        F.col("c_mktsegment").alias("id"),
        F.col("c_mktsegment").alias("run_id"),
        F.lit("transformation.allowed_columns").alias("type"),
        F.to_json(entry).alias("url"),
        F.lit(None).cast("timestamp_ntz").alias("written_at"),
    )
    return runlog.stored_manifest(objects).select("run_id", "name", "type", "min", "max")


QUERIES = {
    f.__name__: f
    for f in (
        r_best_child, r_champion, r_latest_metrics, r_latest_pivot, r_children, r_fan_out, r_objects,
        r_objects_under_parent, r_published, r_prev_published, r_upsert_tags, r_tagged_best, r_first_property,
        r_intents, r_run_by_name, r_nominate_history, r_run_card, r_latest_per_base_stage, r_tag_conjunction,
        r_metric_rounding, r_timings, r_append_read, r_manifest_rows,
    )
}

_LOG = """
experiments as (select cast(n_nationkey as varchar) as id, n_name as name from nation),
parents as (select 'P-' || c_custkey as id, c_name as name, cast(null as varchar) as parent_id, cast(c_nationkey as varchar) as experiment_id from customer),
children as (select 'C-' || o_orderkey as id, 'C-' || o_orderkey as name, 'P-' || o_custkey as parent_id, cast(c_nationkey as varchar) as experiment_id
  from orders join customer on o_custkey = c_custkey),
metrics as (select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint)) as id,
  'C-' || l_orderkey as run_id,
  case l_returnflag when 'A' then 'validation.train.mae' when 'N' then 'validation.valid.mae' else 'validation.test.mae' end as key,
  l_extendedprice as value, l_shipdate as written_at from lineitem),
properties as (select 'P-' || c_custkey as run_id, 'name.intent' as key, c_mktsegment as value from customer
  union all select 'P-' || c_custkey, 'name.description', c_name from customer),
tags as (select 'C-' || o_orderkey as run_id, case when o_orderstatus = 'F' then 'level' else 'status' end as key,
    case when o_orderstatus = 'F' then 'best' else 'champion' end as value from orders where o_orderstatus in ('F', 'P')
  union all select 'P-' || c_custkey, 'status.deployment', case when c_acctbal > 5000 then 'published' else 'inferior' end from customer),
last_metrics as (select run_id, key, value from metrics qualify row_number() over (partition by run_id, key order by written_at desc, id desc) = 1),
entries as (select event_id as id, cast(user_id as varchar) as run_id, event_type as key, value, ts as written_at from events),
best as (select c.parent_id, c.id, c.name from children c join tags t on t.run_id = c.id where t.key = 'level' and t.value = 'best'
  qualify row_number() over (partition by c.parent_id order by c.id) = 1)
"""

ORACLE = {
    "r_best_child": f"""with {_LOG} select parent_id, name, m.value from children c join metrics m on m.run_id = c.id where m.key = '{VALID}'
        qualify row_number() over (partition by parent_id order by m.value, c.id) = 1""",
    "r_champion": f"""with {_LOG} select experiment_id, name, m.value from children c join metrics m on m.run_id = c.id
        join tags t on t.run_id = c.id where m.key = '{VALID}' and t.key = 'status' and t.value = 'champion'
        qualify row_number() over (partition by experiment_id order by m.value, c.id) = 1""",
    "r_latest_metrics": f"with {_LOG} select run_id, key, value from last_metrics",
    "r_latest_pivot": f"""with {_LOG} select run_id, max(value) filter (key like '%.train.%') as train, max(value) filter (key like '%.valid.%') as valid,
        max(value) filter (key like '%.test.%') as test from last_metrics group by run_id""",
    "r_children": f"with {_LOG} select parent_id, id, name from children",
    "r_fan_out": f"with {_LOG} select parent_id, count(*) as n_children from children group by 1",
    "r_objects": """select 'C-' || doc_id as run_id, source as type, sha256(text) as url from documents
        qualify row_number() over (partition by doc_id, source order by doc_id desc) = 1""",
    "r_objects_under_parent": f"""with {_LOG} select parent_id, source as type, sha256(text) as url from documents
        join children on id = 'C-' || doc_id qualify row_number() over (partition by parent_id, source order by doc_id desc) = 1""",
    "r_published": f"""with {_LOG} select experiment_id, id, name from parents where id in
        (select run_id from tags where key = 'status.deployment' and value = 'published')""",
    "r_prev_published": f"""with {_LOG} select r.experiment_id, p.value as intent, r.id, m.value
        from parents r join tags t on r.id = t.run_id join children rc on rc.parent_id = r.id
        join properties p on r.id = p.run_id join metrics m on rc.id = m.run_id
        where t.key = 'status.deployment' and t.value = 'published' and p.key = 'name.intent' and m.key = '{TEST}'
        qualify row_number() over (partition by r.experiment_id, p.value order by m.value, r.id) = 1""",
    "r_upsert_tags": f"""with {_LOG} select run_id, key, arg_min(id, (written_at, id)) as id, arg_max(value, (written_at, id)) as value,
        count(*) as writes from entries group by 1, 2""",
    "r_tagged_best": f"with {_LOG} select parent_id, id, name from best",
    "r_first_property": f"""with {_LOG} select run_id, value from entries where key = 'purchase'
        qualify row_number() over (partition by run_id order by written_at, id) = 1""",
    "r_intents": f"with {_LOG} select run_id, value from properties where key = 'name.intent'",
    "r_run_by_name": f"""with {_LOG}, runs as (select * from parents union all select * from children)
        select name, id, parent_id from runs qualify row_number() over (partition by name order by id) = 1""",
    "r_nominate_history": """with n as (select cast(c_nationkey as varchar) as experiment_id, c_mktsegment as intent, o_orderkey as id,
          o_totalprice as score, o_orderdate as written_at from orders join customer on o_custkey = c_custkey),
        seen as (select *, min(score) over (partition by experiment_id, intent order by written_at, id rows between unbounded preceding and 1 preceding) as before,
          min(score) over (partition by experiment_id, intent order by written_at, id rows between 1 following and unbounded following) as later from n)
        select experiment_id, intent, id, score, case when before is not null and score >= before then 'inferior'
          when later < score then 'retracted' else 'published' end as status from seen""",
    "r_run_card": f"""with {_LOG}, parts as (select parent_id, 'parent' as part, parent_id as run_id from best
          union all select parent_id, 'children', id from best),
        cells as (select run_id, key, value as text, null::double as number from properties
          union all select run_id, key, null, value from last_metrics)
        select parent_id, part, key, text, number from parts join cells using (run_id)""",
    "r_latest_per_base_stage": """select concat_ws('/', o_orderpriority, o_custkey % 100) as base, 'production' as stage,
          'C-' || o_orderkey as run_id, strftime(o_orderdate, '%Y-%m-%d') as created from orders where o_orderstatus = 'F'
        qualify row_number() over (partition by base order by o_orderdate desc, 'C-' || o_orderkey desc) = 1""",
    "r_tag_conjunction": f"""with {_LOG} select parent_id, id, name from children where id in
        (select 'C-' || o_orderkey from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'F')""",
    "r_metric_rounding": f"with {_LOG} select id, key, cast(printf('%.3f', value / 8) as double) as value from metrics",
    "r_timings": f"""with {_LOG} select 'time_ms.' || key as key, count(*) as runs, round(avg(value), 4) as mean_ms, max(value) as max_ms
        from entries group by 1""",
    "r_append_read": f"""with {_LOG} select key, count(*) as entries, round(sum(value), 2) as total from metrics group by 1""",
    "r_manifest_rows": """select c_mktsegment as run_id, 'balance' as name, 'numerical' as type, min(c_acctbal) as min, max(c_acctbal) as max
        from customer group by 1""",
}
