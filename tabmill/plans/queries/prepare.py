"""Sources and sinks, cleaning, lookups, profiles and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.selection import first_rows
from ...operators import clean, lookup, profile
from ...operators.split import split, stage_sizes
from ...schema import COMMODITY_FLOW as SCHEMA
from ...schema import SAMPLE_TRANSFORMER as SAMPLE
from ...sources import tables
from ...sources.workspace import materialize, new_path
from ..derived import shipments, table
from . import sql

ID, VALUE, WEIGHT = "SHIPMENT_ID", "SHIPMENT_VALUE", "SHIPMENT_WEIGHT"


def csv_roundtrip_rename(spark, sf_dir):
    path = new_path(spark, "csv")
    rows = shipments(spark, sf_dir)
    tables.save_csv(rows.toDF(*[f"c{i}" for i in range(len(rows.columns))]), path)
    return clean.typed(tables.load_csv(spark, path, SCHEMA), SCHEMA)


def csv_quoted_roundtrip(spark, sf_dir):
    """Texts with quotes, commas, line breaks and blanks at their ends, through CSV and back."""
    path = new_path(spark, "csv-texts")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    quoted = F.concat(F.lit('  "'), F.col("lang"), F.lit('", '), F.col("text"), F.lit('\n"" \\ '))
    tables.save_csv(docs.select("doc_id", quoted.alias("text"), "lang"), path)
    back = tables.read_text_csv(spark, path, multi_line=True)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")


def head_n_duplicates(spark, sf_dir):
    """The head by a key that repeats: ties go by content, identical rows by number."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 2).alias("half"))
    return first_rows(rows, "l_orderkey", 20_001, small=0)


def split_exact_duplicates(spark, sf_dir):
    """Exact stage sizes where all rows fall into seven groups of identical rows."""
    line = F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(line.cast("string").alias("COLUMN_ID"), line.cast("double").alias("COLUMN_TARGET"))
    return split(rows, SAMPLE, exact=True).groupBy("stage").agg(F.count(F.lit(1)).alias("n_rows"))


def load_audit(spark, sf_dir):
    rows, seen = tables.audited(shipments(spark, sf_dir, ID, VALUE), "load-audit")
    tables.save_csv(rows, new_path(spark, "audit"))
    return spark.createDataFrame([(seen.get["rows"], len(rows.columns))], "n_rows bigint, n_columns int")


def head_n_by_key(spark, sf_dir):
    return tables.head(shipments(spark, sf_dir, ID, WEIGHT, VALUE), SCHEMA, 1_000)


def head_n_large(spark, sf_dir):
    return tables.head(materialize(shipments(spark, sf_dir, ID, WEIGHT, VALUE), "rows"), SCHEMA, 25_000)


def random_sample_exact(spark, sf_dir):
    return tables.sample_rows(materialize(shipments(spark, sf_dir, ID, WEIGHT, VALUE), "rows"), SCHEMA, 1_000, seed=42)


def split_parquet_roundtrip(spark, sf_dir):
    path = new_path(spark, "splits")
    tables.save_splits(split(shipments(spark, sf_dir, ID, WEIGHT, VALUE), SCHEMA), path)
    parts = [tables.load_splits(spark, path, s) for s in tables.STAGES]
    tables.same_columns(*parts)
    return (
        tables.load_splits(spark, path)
        .groupBy("stage")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(WEIGHT), 2).alias("weight"), F.min(ID).alias("first_id"))
        .withColumn("stage", F.col("stage").cast("string"))
    )


def _with_nulls(spark, sf_dir, *columns):
    rows = shipments(spark, sf_dir, *columns)
    return rows.withColumn("EXPORT_COUNTRY", F.nullif("EXPORT_COUNTRY", F.lit("N")))


def clean_select_drop_dropna(spark, sf_dir):
    steps = [
        {"type": "filter_columns", "columns": ["shipment_id", "shipment_weight", "export_country", "weight_factor", "shipment_value"]},
        {"type": "remove_columns", "columns": ["weight_factor"]},
        {"type": "drop_na"},
    ]
    rows = _with_nulls(spark, sf_dir, ID, VALUE, WEIGHT, "EXPORT_COUNTRY", "WEIGHT_FACTOR", "QUARTER")
    return clean.clean(rows, SCHEMA, steps)


def clean_typed_quarantine(spark, sf_dir):
    rows = shipments(spark, sf_dir, ID, WEIGHT, VALUE, "MODE", "QUARTER")
    text = F.when(F.col("MODE") == "1-URGENT", F.concat(F.col(WEIGHT).cast("string"), F.lit(" lb"))).otherwise(F.col(WEIGHT).cast("string"))
    worth = F.when(F.col("QUARTER") == "2", F.lit("unknown")).otherwise(F.col(VALUE).cast("string"))
    raw = rows.select(ID, text.alias(WEIGHT), worth.alias(VALUE), "QUARTER")
    good, bad = clean.typed_or_quarantined(raw, SCHEMA)
    none = F.lit(None)
    return good.select(
        ID, F.lit("typed").alias("outcome"), F.col(WEIGHT).alias("weight"), F.col(VALUE).alias("value"), none.cast("string").alias("bad_columns")
    ).unionByName(
        bad.select(
            ID,
            F.lit("quarantined").alias("outcome"),
            none.cast("double").alias("weight"),
            none.cast("double").alias("value"),
            F.array_join("bad_columns", ",").alias("bad_columns"),
        )
    )


def feature_projection(spark, sf_dir):
    rows = shipments(spark, sf_dir)
    return rows.select(*SCHEMA.features(rows.columns), SCHEMA.target)


def area_key_check(spark, sf_dir):
    rows = shipments(spark, sf_dir, ID, "ORIGIN_STATE", "ORIGIN_DISTRICT", "ORIGIN_CFS_AREA", "QUARTER", "HAZMAT")
    broken = F.when((F.col("QUARTER") == "3") & (F.col("HAZMAT") == "F"), F.concat("ORIGIN_DISTRICT", F.lit("-"), "ORIGIN_STATE"))
    rows = rows.withColumn("ORIGIN_CFS_AREA", F.coalesce(broken, "ORIGIN_CFS_AREA"))
    return clean.area_mismatches(rows, "ORIGIN").select(ID, "ORIGIN_CFS_AREA", "expected_area")


_CODED = {
    "ORIGIN_STATE": "states",
    "DESTINATION_STATE": "states",
    "SCTG_CODE": "sctg",
    "MODE_CODE": "mode",
    "NAICS_CODE": "naics",
    "EXPORT_COUNTRY": "export_country",
    "HAZMAT_CODE": "hazmat",
}


def decode_codes(spark, sf_dir):
    rows = lookup.decode(shipments(spark, sf_dir, ID, *_CODED), _CODED)
    return rows.select(ID, *[x for c in _CODED for x in (c, f"{c}_LABEL")])


def unknown_codes(spark, sf_dir):
    return lookup.unknown_codes(shipments(spark, sf_dir, *_CODED), _CODED)


def manifest_numeric(spark, sf_dir):
    return profile.manifest_numeric(shipments(spark, sf_dir, *sql.NUMERICAL), SCHEMA)


def manifest_numeric_truncated(spark, sf_dir):
    rows = shipments(spark, sf_dir, *sql.NUMERICAL).withColumn("WEIGHT_FACTOR", F.col("WEIGHT_FACTOR") * 1.55 - 7)
    return profile.manifest_numeric(rows, SCHEMA, truncate=True)


def manifest_categorical(spark, sf_dir):
    return profile.manifest_categorical(shipments(spark, sf_dir, *sql.CATEGORICAL), SCHEMA)


def manifest_json_roundtrip(spark, sf_dir):
    rows = shipments(spark, sf_dir, *sql.NUMERICAL, *sql.CATEGORICAL)
    stored = profile.manifest_json(profile.manifest_numeric(rows, SCHEMA), profile.manifest_categorical(rows, SCHEMA))
    return profile.manifest_rows(stored).select(
        "name", "type", "min", "max", F.array_join("available_values", "|").alias("available_values")
    )


def describe_numeric(spark, sf_dir):
    # several passes over five columns: join once, not per pass
    rows = materialize(shipments(spark, sf_dir, *sql.NUMERICAL), "numbers")
    out = profile.describe_numeric(rows, sql.NUMERICAL)
    return out.select("column", "count", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


def describe_categorical(spark, sf_dir):
    return profile.describe_categorical(shipments(spark, sf_dir, *sql.CATEGORICAL), sql.CATEGORICAL)


def profile_numeric(spark, sf_dir):
    out = profile.profile_numeric(shipments(spark, sf_dir, *sql.NUMERICAL), sql.NUMERICAL)
    return out.select(
        "column", "count", F.round("sum", 2).alias("sum"), *[F.round(c, 4).alias(c) for c in ("mean", "stddev", "min", "max")]
    )


def profile_categorical_freq(spark, sf_dir):
    return profile.profile_categorical(shipments(spark, sf_dir, *sql.CATEGORICAL), sql.CATEGORICAL)


def profile_freq_map(spark, sf_dir):
    rows = profile.profile_categorical(shipments(spark, sf_dir, "NAICS", "QUARTER", "MODE"), ("NAICS", "QUARTER", "MODE"))
    entry = lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    freq = F.array_join(F.transform(F.map_entries("freq"), entry), "|")
    return profile.frequency_map(rows).select("column", freq.alias("freq"))


def dataset_meta(spark, sf_dir):
    out = profile.dataset_meta(shipments(spark, sf_dir, ID, WEIGHT, "QUARTER"))
    return out.select("n_rows", "n_columns", F.element_at("schema", F.lit(WEIGHT)).alias("weight_type"))


def dataset_fingerprint(spark, sf_dir):
    out = profile.fingerprint(shipments(spark, sf_dir))
    return out.select("n_rows", F.col("digest").cast("string").alias("digest"))


def duplicate_content_sha256(spark, sf_dir):
    return profile.duplicate_content(table(spark, sf_dir, "documents"), "doc_id", "text")


def split_hash_counts(spark, sf_dir):
    return stage_sizes(split(shipments(spark, sf_dir, ID, WEIGHT, VALUE), SCHEMA))


def split_hash_rows(spark, sf_dir):
    return split(shipments(spark, sf_dir, ID), SCHEMA)


def split_exact_sizes(spark, sf_dir):
    rows = split(materialize(shipments(spark, sf_dir, ID, WEIGHT), "rows"), SCHEMA, exact=True)
    return rows.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ID).alias("first_id"), F.max(ID).alias("last_id"), F.round(F.sum(WEIGHT), 2).alias("weight")
    )


QUERIES = {
    f.__name__: f
    for f in (
        csv_roundtrip_rename, load_audit, head_n_by_key, head_n_large, random_sample_exact, split_parquet_roundtrip,
        clean_select_drop_dropna, clean_typed_quarantine, feature_projection, area_key_check, decode_codes,
        unknown_codes, manifest_numeric, manifest_numeric_truncated, manifest_categorical, manifest_json_roundtrip,
        describe_numeric, describe_categorical, profile_numeric, profile_categorical_freq, profile_freq_map,
        dataset_meta, dataset_fingerprint, duplicate_content_sha256, split_hash_counts, split_hash_rows,
        split_exact_sizes, csv_quoted_roundtrip, head_n_duplicates, split_exact_duplicates,
    )
}

_FEATURES = ", ".join(SCHEMA.features(SCHEMA.columns))
_DECLARED_CATEGORICAL = [c for c in SCHEMA.columns if c in SCHEMA.categorical]
_DECLARED_NUMERICAL = [c for c in SCHEMA.columns if c in SCHEMA.numerical and c != VALUE]
_ROW_TEXT = " || ".join(
    f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar) || ';', '-;')" for c in SCHEMA.columns
)
_CELLS = "cells as (" + sql.union("select '{c}' as \"column\", {c} as value from ship", sql.CATEGORICAL) + ")"

ORACLE = {
    "csv_quoted_roundtrip": r"""select doc_id, '  "' || lang || '", ' || text || chr(10) || '"" \ ' as text, lang from documents""",
    "head_n_duplicates": """with r as (select l_orderkey, l_linenumber, l_suppkey % 2 as half from lineitem)
        select * from r order by l_orderkey, md5(length(l_orderkey::varchar) || ':' || l_orderkey || ';' || length(l_linenumber::varchar) || ':'
          || l_linenumber || ';' || length(half::varchar) || ':' || half || ';') limit 20001""",
    "split_exact_duplicates": """with n as (select count(*) as n from lineitem), h as (select n, cast(ceil(0.2 * n) as bigint) as held from n),
        t as (select n, held, cast(ceil(0.5 * held) as bigint) as test from h)
        select 'train' as stage, n - held as n_rows from t union all select 'valid', held - test from t union all select 'test', test from t""",
    "csv_roundtrip_rename": f"with {sql.SHIP} select {', '.join(SCHEMA.columns)} from ship",
    "load_audit": f"with {sql.SHIP} select count(*) as n_rows, cast(2 as integer) as n_columns from ship",
    "head_n_by_key": f"with {sql.SHIP} select SHIPMENT_ID, SHIPMENT_WEIGHT, SHIPMENT_VALUE from ship order by SHIPMENT_ID limit 1000",
    "head_n_large": f"with {sql.SHIP} select SHIPMENT_ID, SHIPMENT_WEIGHT, SHIPMENT_VALUE from ship order by SHIPMENT_ID limit 25000",
    "random_sample_exact": f"""with {sql.SHIP} select SHIPMENT_ID, SHIPMENT_WEIGHT, SHIPMENT_VALUE from ship
        order by md5(concat(SHIPMENT_ID, '-42')) limit 1000""",
    "split_parquet_roundtrip": f"""with {sql.STAGED} select stage, count(*) as n_rows, round(sum(SHIPMENT_WEIGHT), 2) as weight,
        min(SHIPMENT_ID) as first_id from staged group by stage""",
    "clean_select_drop_dropna": f"""with {sql.SHIP} select SHIPMENT_ID, SHIPMENT_WEIGHT, EXPORT_COUNTRY, SHIPMENT_VALUE
        from ship where nullif(EXPORT_COUNTRY, 'N') is not null""",
    "clean_typed_quarantine": f"""with {sql.SHIP}, raw as (
          select SHIPMENT_ID,
            case when MODE = '1-URGENT' then concat(cast(SHIPMENT_WEIGHT as varchar), ' lb') else cast(SHIPMENT_WEIGHT as varchar) end as w,
            case when QUARTER = '2' then 'unknown' else cast(SHIPMENT_VALUE as varchar) end as v
          from ship),
        cast_rows as (select SHIPMENT_ID, try_cast(w as double) as w, try_cast(v as double) as v from raw)
        select SHIPMENT_ID,
          case when w is null or v is null then 'quarantined' else 'typed' end as outcome,
          case when w is null or v is null then null else w end as weight,
          case when w is null or v is null then null else v end as value,
          case when w is null and v is null then 'SHIPMENT_WEIGHT,SHIPMENT_VALUE'
               when w is null then 'SHIPMENT_WEIGHT' when v is null then 'SHIPMENT_VALUE' end as bad_columns
        from cast_rows""",
    "feature_projection": f"with {sql.SHIP} select {_FEATURES}, SHIPMENT_VALUE from ship",
    "area_key_check": f"""with {sql.SHIP} select SHIPMENT_ID, concat(ORIGIN_DISTRICT, '-', ORIGIN_STATE) as ORIGIN_CFS_AREA,
        concat(ORIGIN_STATE, '-', ORIGIN_DISTRICT) as expected_area from ship where QUARTER = '3' and HAZMAT = 'F'""",
    "decode_codes": f"with {sql.SHIP}, {sql.lookup_values()} select SHIPMENT_ID, "
    + ", ".join(
        f"{c}, (select label from codes where lookup = '{n}' and code = {c}) as {c}_LABEL" for c, n in _CODED.items()
    )
    + " from ship",
    "unknown_codes": f"with {sql.SHIP}, {sql.lookup_values()}, cells as ("
    + "\nunion all\n".join(f"select '{c}' as \"column\", '{n}' as lookup, {c} as code from ship" for c, n in _CODED.items())
    + """) select "column", code, count(*) as n_rows from cells
        where not exists (select 1 from codes where codes.lookup = cells.lookup and codes.code = cells.code) group by 1, 2""",
    "manifest_numeric": f"with {sql.SHIP} "
    + sql.union("select '{c}' as name, 'numerical' as type, min({c}) as min, max({c}) as max from ship", _DECLARED_NUMERICAL),
    "manifest_numeric_truncated": f"with {sql.SHIP}, moved as (select * replace (WEIGHT_FACTOR * cast(1.55 as double) - 7 as WEIGHT_FACTOR) from ship) "
    + sql.union("select '{c}' as name, 'numerical' as type, trunc(min({c})) as min, trunc(max({c})) as max from moved", _DECLARED_NUMERICAL),
    "manifest_categorical": f"with {sql.SHIP} " + sql.union("select distinct '{c}' as name, {c} as value from ship", sql.CATEGORICAL),
    "manifest_json_roundtrip": f"with {sql.SHIP} "
    + sql.union(
        "select '{c}' as name, 'numerical' as type, min({c}) as min, max({c}) as max, null as available_values from ship",
        _DECLARED_NUMERICAL,
    )
    + "\nunion all\n"
    + sql.union(
        "select '{c}' as name, 'categorical' as type, null as min, null as max, string_agg(distinct {c}, '|' order by {c}) as available_values from ship",
        _DECLARED_CATEGORICAL,
    ),
    "describe_numeric": f"with {sql.SHIP} "
    + sql.union(
        """select '{c}' as "column", count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std,
        round(min({c}), 4) as min, round(quantile_cont({c}, 0.25), 4) as q25, round(quantile_cont({c}, 0.5), 4) as q50,
        round(quantile_cont({c}, 0.75), 4) as q75, round(max({c}), 4) as max from ship""",
        sql.NUMERICAL,
    ),
    "describe_categorical": f"""with {sql.SHIP}, {_CELLS}, counts as (select "column", value, count(*) as n from cells group by 1, 2),
        ranked as (select *, row_number() over (partition by "column" order by n desc, value) as r from counts)
        select "column", cast(sum(n) as bigint) as count, count(*) as "unique", max(case when r = 1 then value end) as top,
        max(case when r = 1 then n end) as freq from ranked group by 1""",
    "profile_numeric": f"with {sql.SHIP} "
    + sql.union(
        """select '{c}' as "column", count({c}) as count, round(sum({c}), 2) as sum, round(avg({c}), 4) as mean,
        round(stddev_samp({c}), 4) as stddev, round(min({c}), 4) as min, round(max({c}), 4) as max from ship""",
        sql.NUMERICAL,
    ),
    "profile_categorical_freq": f"""with {sql.SHIP}, {_CELLS}, counts as (select "column", value, count(*) as n from cells group by 1, 2)
        select "column", value, n as freq, count(*) over (partition by "column") as n_unique,
        cast(sum(n) over (partition by "column") as bigint) as n_rows from counts""",
    "profile_freq_map": f"""with {sql.SHIP}, cells as ({sql.union("select '{c}' as col, {c} as value from ship", ("NAICS", "QUARTER", "MODE"))}),
        counts as (select col, value, count(*) as n from cells group by 1, 2)
        select col as "column", string_agg(value || '=' || n, '|' order by value) as freq from counts group by 1""",
    "dataset_meta": f"with {sql.SHIP} select count(*) as n_rows, cast(3 as bigint) as n_columns, 'double' as weight_type from ship",
    "dataset_fingerprint": f"""with {sql.SHIP} select count(*) as n_rows,
        cast(sum(('0x' || substr(md5({_ROW_TEXT}), 1, 8))::bigint) as varchar) as digest from ship""",
    "duplicate_content_sha256": """select sha256(text) as hash, count(*) as copies, min(doc_id) as first_key
        from documents group by 1 having count(*) > 1""",
    "split_hash_counts": f"with {sql.STAGED} select stage, count(*) as n_rows, cast(3 as bigint) as n_columns from staged group by 1",
    "split_hash_rows": f"with {sql.STAGED} select SHIPMENT_ID, stage from staged",
    "split_exact_sizes": f"""with {sql.SHIP},
        sized as (select count(*) as n, cast(ceil(0.2 * count(*)) as bigint) as held from ship),
        cut as (select n - held as n_train, held - cast(ceil(0.5 * held) as bigint) as n_valid from sized),
        ranked as (select SHIPMENT_ID, SHIPMENT_WEIGHT, row_number() over (order by md5(concat(SHIPMENT_ID, '-42')), SHIPMENT_ID) as r from ship)
        select case when r <= n_train then 'train' when r <= n_train + n_valid then 'valid' else 'test' end as stage,
          count(*) as n_rows, min(SHIPMENT_ID) as first_id, max(SHIPMENT_ID) as last_id, round(sum(SHIPMENT_WEIGHT), 2) as weight
        from ranked, cut group by 1""",
}
