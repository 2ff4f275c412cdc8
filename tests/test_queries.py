"""Registered queries against their SQL, and the shape of a few plans."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check

import __spark_entry__ as entry
from tabmill.plans.derived import shipments
from tabmill.plans.queries import catalog, prepare, transforms


@pytest.fixture(scope="module")
def con(sf):
    return check.duck(sf)


# one or two of every area; `tools/check.py` runs them all
CHOSEN = (
    "csv_roundtrip_rename", "head_n_large", "random_sample_exact", "clean_typed_quarantine", "decode_codes",
    "describe_numeric", "split_exact_sizes", "prep_log_summary", "t_onehot_wide", "t_log_then_std_chained",
    "t_params_replay", "f_geo_all", "m_elastic_net", "m_knn_distance", "m_metrics_original_scale", "v_quarantine",
    "s_batch_score", "s_stream_score", "r_prev_published", "r_nominate_history", "r_metric_rounding",
    "job_prepare_scenario", "csv_quoted_roundtrip", "head_n_duplicates", "split_exact_duplicates", "m_gbt_quarters",
    "job_publish_reload_score", "r_append_read",
)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    found = [tuple(r) for r in df.collect()]
    assert check.compare(df.columns, found, *check.oracle_frame(con, entry.oracle_sql()[name])) is None


def test_registration():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == {"m_tree", "m_forest", "m_gbt", "m_grid_best", "job_sweep"}


def test_entry(spark):
    assert entry.entry(spark).count() == 3


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_and_tables_are_read(spark, sf):
    text = plan(shipments(spark, sf, "SHIPMENT_VALUE", "SHIPMENT_WEIGHT"))
    assert "customer" not in text and "orders" not in text and "nation" not in text
    assert "l_shipdate" not in text


def test_hash_split_and_lookups_do_not_shuffle_the_rows(spark, sf):
    for df in (prepare.split_hash_rows(spark, sf), transforms.t_sign(spark, sf), transforms.f_interstate(spark, sf)):
        text = plan(df)
        assert "SortMergeJoin" not in text
        assert "Exchange hashpartitioning" not in text


def test_fitted_steps_are_one_projection(spark, sf):
    text = plan(transforms.t_onehot(spark, sf))
    assert "Join" not in text and "Aggregate" not in text and "Python" not in text
