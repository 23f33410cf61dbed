"""Every registered query against its DuckDB oracle (sf0.001), and plan checks."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402
from revlens.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    # the training-data queries have tests of their own (tests/llm)
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    d_cols, d_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["order_month", "segment"]
    assert df.count() > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_in_plan(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan
    # no pairwise products anywhere
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_filter_and_pruning_reach_the_scan(spark):
    plan = _plan(E.queries()["filter_region_metrics"](spark, SF))
    assert "PushedFilters: [IsNotNull(r_name), EqualTo(r_name,EUROPE)" in plan
    # lineitem scan reads only the columns the query needs
    li = [line for line in plan.splitlines() if "lineitem" in line and "ReadSchema" in line][0]
    assert "l_discount" not in li and "l_tax" not in li and "l_returnflag" not in li


def test_monthly_report_uses_partial_aggregation(spark):
    plan = _plan(E.queries()["monthly_segment_report"](spark, SF))
    assert "partial_count" in plan and "Expand" in plan  # one grouping-sets pass, map-side combine
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["coerce_numeric", "clean_sales_lines", "line_profit", "profit_report"])
def test_number_parse_has_no_regex(spark, name):
    # the optimizer copies a parse into the filter above it, so it must stay cheap
    assert "RLIKE" not in _plan(E.queries()[name](spark, SF))


def test_guarded_dimension_is_shuffled_once(spark):
    """The join takes over the guard's partitioning: one exchange per side."""
    keep = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in keep:
        spark.conf.set(k, "-1")
    try:
        df = E.queries()["enrich_orders"](spark, SF)
        df.collect()
        final = _plan(df).partition("== Initial Plan ==")[0]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in final and final.count("Exchange hashpartitioning") == 2


def test_rollup_expands_customers_not_orders(spark):
    plan = _plan(E.queries()["monthly_segment_report"](spark, SF))
    below = plan[plan.index("Expand"):]
    # under the expand there is the aggregate by month, segment and customer
    assert "HashAggregate(keys=[order_month" in below.split("\n", 4)[1] + below.split("\n", 4)[2]


@pytest.mark.parametrize("name", ["latest_order_version", "state_upsert", "customer_upsert"])
def test_version_picks_are_limited_below_the_shuffle(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:] and "max_by" not in plan
