"""SQL text shared by the oracles."""

from __future__ import annotations

from ...operators.lookup import LOOKUPS

SHIP = """ship as (
  select
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint)) as SHIPMENT_ID,
    lpad(cast(s_nationkey as varchar), 2, '0') as ORIGIN_STATE,
    lpad(cast(l_suppkey % 7 as varchar), 3, '0') as ORIGIN_DISTRICT,
    concat(lpad(cast(s_nationkey as varchar), 2, '0'), '-', lpad(cast(l_suppkey % 7 as varchar), 3, '0')) as ORIGIN_CFS_AREA,
    lpad(cast(c_nationkey as varchar), 2, '0') as DESTINATION_STATE,
    lpad(cast(c_custkey % 7 as varchar), 3, '0') as DESTINATION_DISTRICT,
    concat(lpad(cast(c_nationkey as varchar), 2, '0'), '-', lpad(cast(c_custkey % 7 as varchar), 3, '0')) as DESTINATION_CFS_AREA,
    p_type as NAICS,
    cast(quarter(l_shipdate) as varchar) as QUARTER,
    p_brand as SCTG,
    o_orderpriority as MODE,
    l_extendedprice as SHIPMENT_VALUE,
    l_quantity * p_size as SHIPMENT_WEIGHT,
    cast(abs(s_nationkey - c_nationkey) * 100.0 as double) as SHIPMENT_DISTANCE_CIRCLE,
    cast(abs(s_nationkey - c_nationkey) * 100.0 as double) * cast(1.2 as double) + 10 as SHIPMENT_DISTANCE_ROUTE,
    case when l_returnflag = 'R' then 'Y' else 'N' end as IS_TEMPERATURE_CONTROLLED,
    case when sn.n_regionkey <> cn.n_regionkey then 'Y' else 'N' end as IS_EXPORT,
    case when sn.n_regionkey <> cn.n_regionkey then cast(cn.n_regionkey as varchar) else 'N' end as EXPORT_COUNTRY,
    l_linestatus as HAZMAT,
    1 + l_discount * 100 as WEIGHT_FACTOR,
    lpad(regexp_extract(p_brand, '[0-9]+'), 2, '0') as SCTG_CODE,
    substr(o_orderpriority, 1, 1) as MODE_CODE,
    cast(p_size + 300 as varchar) as NAICS_CODE,
    l_returnflag as HAZMAT_CODE
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey
  join part on l_partkey = p_partkey
  join nation sn on s_nationkey = sn.n_nationkey
  join nation cn on c_nationkey = cn.n_nationkey
)"""

BUCKET = "('0x' || substr(md5(concat(SHIPMENT_ID, '-42')), 1, 8))::bigint % 10"

STAGED = (
    SHIP
    + f""",
staged as (
  select *, case when {BUCKET} < 8 then 'train' when {BUCKET} = 8 then 'valid' else 'test' end as stage from ship
)"""
)

# one-feature least squares on train: value by weight
LINE = """line as (
  select regr_slope(SHIPMENT_VALUE, SHIPMENT_WEIGHT) as b, regr_intercept(SHIPMENT_VALUE, SHIPMENT_WEIGHT) as a
  from staged where stage = 'train'
)"""

# the same on logarithms
LOG_LINE = """line as (
  select regr_slope(ln(SHIPMENT_VALUE), ln(SHIPMENT_WEIGHT)) as b,
         regr_intercept(ln(SHIPMENT_VALUE), ln(SHIPMENT_WEIGHT)) as a
  from staged where stage = 'train'
)"""

NUMERICAL = ("SHIPMENT_VALUE", "SHIPMENT_WEIGHT", "SHIPMENT_DISTANCE_CIRCLE", "SHIPMENT_DISTANCE_ROUTE", "WEIGHT_FACTOR")
CATEGORICAL = (
    "ORIGIN_STATE", "ORIGIN_DISTRICT", "ORIGIN_CFS_AREA", "DESTINATION_STATE", "DESTINATION_DISTRICT",
    "DESTINATION_CFS_AREA", "NAICS", "QUARTER", "SCTG", "MODE", "EXPORT_COUNTRY", "HAZMAT",
)


def union(template: str, columns) -> str:
    return "\nunion all\n".join(template.format(c=c) for c in columns)


def lookup_values() -> str:
    rows = [
        "({})".format(", ".join("'" + v.replace("'", "''") + "'" for v in (name, code, label)))
        for name, table in LOOKUPS.items()
        for code, label in table.items()
    ]
    return "codes(lookup, code, label) as (values " + ", ".join(rows) + ")"
