import re

import duckdb
import pytest

import __spark_entry__ as contract
from catalog import REGISTRY
from tools.check_queries import TIGHT, normal

TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels".split()
SAMPLE = [
    "segment_revenue", "null_map", "fill_previous", "outlier_flags", "describe_with_nulls", "schema_profile", "limit_ledger",
    "union_of_filters", "chi_square_flags", "histogram", "month_ends", "sheet_portfolio_top_assets", "patient_conditions",
]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, sf, con, name):
    df = REGISTRY[name].run(spark, sf)
    rel = con.sql(REGISTRY[name].sql)
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    mine = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    at = [rel.columns.index(c) for c in order]
    assert mine == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)


def test_contract(spark):
    assert contract.entry(spark).count() == 5
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 200


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_fused_profiles_share_their_scans(spark, sf):
    scans = lambda name: len(re.findall(r"FileScan parquet", _plan(REGISTRY[name].run(spark, sf)).split("== Physical Plan ==")[1]))
    assert scans("describe_lines") <= 2  # moments, percentiles
    assert scans("correlation_matrix") == scans("data_quality") == scans("group_many") == 1


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = _plan(REGISTRY["range_filter"].run(spark, sf))
    assert "GreaterThan(o_totalprice,30000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


#: Tail probabilities and matrices of one result row, arrays summed per task, and functions of the caller's own.
PYTHON = {
    "listing_room_type_test", "patient_age_and_billing", "insight_categories",
    "anova_three_groups", "anova_five_groups", "chi_square_flags", "chi_square_regions", "chi_square_two_by_two", "welch_price_by_type",
    "welch_billing_by_gender", "pearson_test", "ridge_two_features", "ridge_listing_price", "patient_job_tests", "silhouette_sampled",
    "bootstrap_mean_interval", "bootstrap_median_interval", "kmeans_sizes", "kmeans_properties", "group_function_gaps", "group_function_count",
    "group_function_whole", "row_function", "column_function", "map_columns",
}
#: These run streams or write reports while their frame is made.
RUNNING = {"stream_daily_counts", "stream_ledger", "stream_timed_ledger", "listing_report_lines", "text_report_lines", "json_report_rows"}


def test_no_python_workers_and_no_cross_products(spark, sf):
    for name in set(REGISTRY) - RUNNING:
        plan = _plan(REGISTRY[name].run(spark, sf)).split("== Physical Plan ==")[1]
        assert name in PYTHON or not any(x in plan for x in ("Python", "Pandas", "ArrowEval")), name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_rank_limit_applies_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in _plan(REGISTRY["largest_per_group"].run(spark, sf))


NAMES = sorted(set(REGISTRY) - RUNNING)


@pytest.mark.parametrize("part", range(8))
def test_plans_of_large_inputs_give_the_same_tables(spark, sf, con, monkeypatch, part):
    """All queries with plan parameters near zero, so that small tables get the plans of large ones."""
    for (module, name), value in TIGHT.items():
        monkeypatch.setattr(module, name, value)
    for name in NAMES[part::8]:
        if REGISTRY[name].sql:
            df, rel = REGISTRY[name].run(spark, sf), con.sql(REGISTRY[name].sql)
            assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(rel.columns, rel.fetchall()), name
