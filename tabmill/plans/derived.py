"""Shipments and run-log views over the TPC-H-like tables.

Every foreign key holds, so a join that no requested column needs is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import COMMODITY_FLOW


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table. Its schema is read from a file once per process, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _text(name: str):
    return F.col(name).cast("string")


def _two(name: str):
    return F.lpad(_text(name), 2, "0")


def _district(name: str):
    return F.lpad((F.col(name) % 7).cast("string"), 3, "0")


def shipment_id():
    return F.concat_ws(
        "-",
        _text("l_orderkey"),
        _text("l_linenumber"),
        _text("l_partkey"),
        _text("l_suppkey"),
        F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("string"),
    )


def _shipment_columns() -> dict:
    """Column -> (expression, tables it needs besides lineitem)."""
    gap = (F.abs(F.col("s_nationkey") - F.col("c_nationkey")) * F.lit(100.0)).cast("double")
    exported = F.col("s_regionkey") != F.col("c_regionkey")
    nations, regions = {"supplier", "customer"}, {"supplier", "customer", "nations"}
    return {
        "SHIPMENT_ID": (shipment_id(), set()),
        "ORIGIN_STATE": (_two("s_nationkey"), {"supplier"}),
        "ORIGIN_DISTRICT": (_district("l_suppkey"), set()),
        "ORIGIN_CFS_AREA": (F.concat(_two("s_nationkey"), F.lit("-"), _district("l_suppkey")), {"supplier"}),
        "DESTINATION_STATE": (_two("c_nationkey"), {"customer"}),
        "DESTINATION_DISTRICT": (_district("o_custkey"), {"orders"}),
        "DESTINATION_CFS_AREA": (F.concat(_two("c_nationkey"), F.lit("-"), _district("o_custkey")), {"customer"}),
        "NAICS": (F.col("p_type"), {"part"}),
        "QUARTER": (F.quarter("l_shipdate").cast("string"), set()),
        "SCTG": (F.col("p_brand"), {"part"}),
        "MODE": (F.col("o_orderpriority"), {"orders"}),
        "SHIPMENT_VALUE": (F.col("l_extendedprice"), set()),
        "SHIPMENT_WEIGHT": (F.col("l_quantity") * F.col("p_size"), {"part"}),
        "SHIPMENT_DISTANCE_CIRCLE": (gap, nations),
        "SHIPMENT_DISTANCE_ROUTE": (gap * 1.2 + 10, nations),
        "IS_TEMPERATURE_CONTROLLED": (F.when(F.col("l_returnflag") == "R", "Y").otherwise("N"), set()),
        "IS_EXPORT": (F.when(exported, "Y").otherwise("N"), regions),
        "EXPORT_COUNTRY": (F.when(exported, _text("c_regionkey")).otherwise("N"), regions),
        "HAZMAT": (F.col("l_linestatus"), set()),
        "WEIGHT_FACTOR": (1 + F.col("l_discount") * 100, set()),
        # codes of the survey's own lookups
        "SCTG_CODE": (F.lpad(F.regexp_extract("p_brand", "[0-9]+", 0), 2, "0"), {"part"}),
        "MODE_CODE": (F.substring("o_orderpriority", 1, 1), {"orders"}),
        "NAICS_CODE": ((F.col("p_size") + 300).cast("string"), {"part"}),
        "HAZMAT_CODE": (F.col("l_returnflag"), set()),
    }


def shipments(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per lineitem under the 20 shipment columns, or those asked for."""
    wanted = columns or COMMODITY_FLOW.columns
    lineitem = table(spark, sf_dir, "lineitem")
    return shipments_from(lineitem, spark, sf_dir, *wanted)


def shipments_from(lineitem: DataFrame, spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The same over a given lineitem table or stream."""
    known = _shipment_columns()
    needs = set().union(*[known[c][1] for c in columns])
    rows = lineitem
    if needs & {"orders", "customer"}:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "customer" in needs:
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        rows = rows.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    if "supplier" in needs:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    if "part" in needs:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if "nations" in needs:
        # the list of nations is fixed
        nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
        for side in ("s", "c"):
            rows = rows.join(nation.toDF(f"_{side}_nation", f"{side}_regionkey"), F.col(f"{side}_nationkey") == F.col(f"_{side}_nation"))
    return rows.select(*[known[c][0].alias(c) for c in columns])


def experiments(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select(_text("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def parents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("P-"), _text("c_custkey")).alias("id"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("parent_id"),
        _text("c_nationkey").alias("experiment_id"),
    )


def child_runs(spark, sf_dir) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    run = F.concat(F.lit("C-"), _text("o_orderkey"))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            run.alias("id"),
            run.alias("name"),
            F.concat(F.lit("P-"), _text("o_custkey")).alias("parent_id"),
            _text("c_nationkey").alias("experiment_id"),
        )
    )


def runs(spark, sf_dir) -> DataFrame:
    return parents(spark, sf_dir).unionByName(child_runs(spark, sf_dir))


def children_only(spark, sf_dir) -> DataFrame:
    """Children without their experiment, which needs no join."""
    run = F.concat(F.lit("C-"), _text("o_orderkey"))
    return table(spark, sf_dir, "orders").select(
        run.alias("id"), run.alias("name"), F.concat(F.lit("P-"), _text("o_custkey")).alias("parent_id")
    )


METRIC_KEYS = {"A": "validation.train.mae", "N": "validation.valid.mae", "R": "validation.test.mae"}


def metrics(spark, sf_dir) -> DataFrame:
    flag = F.col("l_returnflag")
    key = F.when(flag == "A", METRIC_KEYS["A"]).when(flag == "N", METRIC_KEYS["N"]).otherwise(METRIC_KEYS["R"])
    return table(spark, sf_dir, "lineitem").select(
        shipment_id().alias("id"),
        F.concat(F.lit("C-"), _text("l_orderkey")).alias("run_id"),
        key.alias("key"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_shipdate").alias("written_at"),
    )


def properties(spark, sf_dir) -> DataFrame:
    run = F.concat(F.lit("P-"), _text("c_custkey"))
    return table(spark, sf_dir, "customer").select(
        F.inline(
            F.array(
                F.struct(
                    F.concat(run, F.lit("-i")).alias("id"),
                    run.alias("run_id"),
                    F.lit("name.intent").alias("key"),
                    F.col("c_mktsegment").alias("value"),
                    F.lit(None).cast("timestamp_ntz").alias("written_at"),
                ),
                F.struct(
                    F.concat(run, F.lit("-d")).alias("id"),
                    run.alias("run_id"),
                    F.lit("name.description").alias("key"),
                    F.col("c_name").alias("value"),
                    F.lit(None).cast("timestamp_ntz").alias("written_at"),
                ),
            )
        )
    )


def tags(spark, sf_dir) -> DataFrame:
    """`level` and `status` of children, `status.deployment` of parents."""
    child = F.concat(F.lit("C-"), _text("o_orderkey"))
    on_child = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus").isin("F", "P"))
        .select(
            F.concat(child, F.lit("-t")).alias("id"),
            child.alias("run_id"),
            F.when(F.col("o_orderstatus") == "F", "level").otherwise("status").alias("key"),
            F.when(F.col("o_orderstatus") == "F", "best").otherwise("champion").alias("value"),
            F.col("o_orderdate").alias("written_at"),
        )
    )
    return on_child.unionByName(deployment_tags(spark, sf_dir))


def deployment_tags(spark, sf_dir) -> DataFrame:
    run = F.concat(F.lit("P-"), _text("c_custkey"))
    return table(spark, sf_dir, "customer").select(
        F.concat(run, F.lit("-t")).alias("id"),
        run.alias("run_id"),
        F.lit("status.deployment").alias("key"),
        F.when(F.col("c_acctbal") > 5000, "published").otherwise("inferior").alias("value"),
        F.lit(None).cast("timestamp_ntz").alias("written_at"),
    )


def order_tags(spark, sf_dir) -> DataFrame:
    """Two tags per child: `priority` and `state`."""
    child = F.concat(F.lit("C-"), _text("o_orderkey"))

    def entry(key, column):
        return F.struct(
            F.concat(child, F.lit(f"-{key}")).alias("id"),
            child.alias("run_id"),
            F.lit(key).alias("key"),
            F.col(column).alias("value"),
            F.col("o_orderdate").alias("written_at"),
        )

    return table(spark, sf_dir, "orders").select(
        F.inline(F.array(entry("priority", "o_orderpriority"), entry("state", "o_orderstatus")))
    )


def event_entries(spark, sf_dir) -> DataFrame:
    """Events as log entries: run = user, key = event type, in order of (ts, event_id)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        _text("user_id").alias("run_id"),
        F.col("event_type").alias("key"),
        "value",
        F.col("ts").alias("written_at"),
    )


def objects(spark, sf_dir) -> DataFrame:
    """One object per document, under the child run of the same number."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("C-"), _text("doc_id")).alias("run_id"),
        F.col("source").alias("type"),
        F.sha2(F.col("text").cast("binary"), 256).alias("url"),
        F.lit(None).cast("timestamp_ntz").alias("written_at"),
    )


def based_runs(spark, sf_dir) -> DataFrame:
    """Orders as runs with a base and a stage tag and their time of creation."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C-"), _text("o_orderkey")).alias("run_id"),
        F.concat_ws("/", F.col("o_orderpriority"), (F.col("o_custkey") % 100).cast("string")).alias("base"),
        F.when(F.col("o_orderstatus") == "F", "production").otherwise("staging").alias("stage"),
        F.col("o_orderdate").alias("created"),
    )


def nominations(spark, sf_dir) -> DataFrame:
    """Orders as nominated runs: experiment = nation, intent = segment, score = price, in order of date and key."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            _text("c_nationkey").alias("experiment_id"),
            F.col("c_mktsegment").alias("intent"),
            F.col("o_orderkey").alias("id"),
            F.col("o_orderdate").alias("written_at"),
            F.col("o_totalprice").alias("score"),
        )
    )
