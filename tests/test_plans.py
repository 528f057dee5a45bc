"""What the optimizer is given: pushed filters, pruned columns, no Python per row."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderlens import suite
from orderlens.plans import metrics, views
from orderlens.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="bundled tables not found")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, file):
    """(pushed filters, read schema) of each scan of a file."""
    found = re.findall(rf"FileScan parquet .*?{file}\.parquet\], PartitionFilters: \[.*?\], PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", text)
    assert found, file
    return found


@pytest.fixture(scope="module")
def t(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return Tables(spark, FOLDER)


def test_day_and_year_predicates_reach_the_scan(spark, t):
    day = plan(entry.queries()["orders_on_day"](spark, FOLDER))
    assert all("GreaterThanOrEqual(o_orderdate" in f and "LessThan(o_orderdate" in f for f, _ in scans(day, "orders"))
    board = plan(views.executive_dashboard(t.customers, t.products, t.orders, t.order_items, t.jobs, "2001-08-02"))
    assert all("o_orderdate" in f for f, _ in scans(board, "orders"))


def test_one_day_of_metrics_reads_one_day(spark, t):
    text = plan(metrics.daily_metrics(t.orders, t.customers, t.order_items, t.jobs, ["2000-03-15"]))
    assert all("GreaterThanOrEqual(o_orderdate" in f for f, _ in scans(text, "orders"))
    assert all("GreaterThanOrEqual(ts" in f for f, _ in scans(text, "events"))


def test_only_used_columns_are_read(spark, t):
    text = plan(views.sales_performance(t.orders, t.order_items, t.products, t.customers))
    assert {s for _, s in scans(text, "customer")} <= {"c_custkey:bigint,c_mktsegment:string", "c_custkey:bigint"}
    columns = {c.split(":")[0] for _, s in scans(text, "lineitem") for c in s.split(",")}
    assert columns == {"l_orderkey", "l_partkey", "l_quantity"}


def test_month_modes_compute_their_join_once(spark, t):
    text = plan(views.sales_performance(t.orders, t.order_items, t.products, t.customers))
    assert len(scans(text, "lineitem")) == 2


STREAMS = ("csv_", "metadata_", "event_dead", "stream_", "event_dedup_stream", "late_", "order_items_refresh", "nudge_cooldown_stream",
           "snapshot_", "job_audit", "report_documents", "feed_status", "pipeline_health", "force_processing_", "schema_compare")


def test_no_query_runs_python_per_row_or_a_cartesian_product(spark):
    for name, fn in suite.queries().items():
        if name.startswith(STREAMS):
            continue
        text = plan(fn(spark, FOLDER))
        assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|PythonUDF|CartesianProduct", text), name


def test_rules_are_a_projection(spark, t):
    from orderlens.plans import rules
    from orderlens.suite.nudges_suite import RULES, enriched

    tree = [r for r in RULES if isinstance(r.conditions, dict)]
    text = plan(rules.matches(t.events.withColumns({"k": F.lit(1), "customer_tier": F.lit("X")}), tree))
    assert "Join" not in text and "Exchange" not in text
    assert "Join" in plan(enriched(t))
