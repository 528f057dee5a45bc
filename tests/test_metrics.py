from decimal import Decimal

from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.plans import jobs as job_plans
from orderlens.plans import metrics, quality
from tests.seed import ts


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_daily_metrics_golden_day(seed):
    row = one(metrics.daily_metrics(seed.orders, seed.customers, seed.items, seed.jobs, ["2024-02-12"]))
    assert (row.total_orders, row.total_revenue, row.products_sold) == (1, 55500.0, 3)
    assert (row.new_customers, row.returning_customers, row.jobs_completed, row.jobs_failed) == (0, 1, 1, 2)
    assert (row.top_selling_product, row.system_health_score) == ("Top Product", 0.95)


def test_day_without_orders_is_a_row_of_zeros(seed):
    row = one(metrics.daily_metrics(seed.orders, seed.customers, seed.items, seed.jobs, ["2023-01-01"]))
    assert (row.total_orders, row.total_revenue, row.average_order_value, row.products_sold) == (0, 0.0, 0.0, 0)


def test_backfill_agrees_with_single_days(seed):
    every = metrics.daily_metrics(seed.orders, seed.customers, seed.items, seed.jobs)
    days = [r.metric_date.isoformat() for r in every.select("metric_date").collect()]
    assert same(every, metrics.daily_metrics(seed.orders, seed.customers, seed.items, seed.jobs, days))


def test_customer_totals_golden_row(seed):
    row = one(metrics.customer_totals(seed.customers, seed.orders, "2024-02-20 00:00:00"))
    assert (row.metric_id, row.total_sales, row.unique_customers, row.average_order_value, row.total_orders) == (
        "ANALYTICS_20240220", 111000.0, 10, 11100.0, 1)


def sequential(orders, target):
    """One order after another, each reading the row as it was before it."""
    table = dict(target)
    for day, amount in orders:
        if day in table:
            sales, n, _ = table[day]
            table[day] = (sales + amount, n + 1, sales / n)
        else:
            table[day] = (amount, 1, float(amount))
    return table


def test_order_batch_equals_one_at_a_time(spark):
    batch = [("o1", "2024-01-01", 10), ("o2", "2024-01-01", 20), ("o3", "2024-01-02", 5), ("o4", "2024-01-03", 7), ("o5", "2024-01-03", 9)]
    target = {"2024-01-01": (100, 4, 25.0), "2024-01-09": (8, 2, 4.0)}
    orders = spark.createDataFrame(
        [(k, ts(d), Decimal(a)) for k, d, a in batch], "order_id string, order_date timestamp_ntz, total_amount decimal(12,2)"
    )
    table = spark.createDataFrame(
        [(ts(d).date(), Decimal(s), n, 1, a) for d, (s, n, a) in target.items()],
        "metric_date date, total_sales decimal(15,2), total_orders bigint, unique_customers bigint, average_order_value double",
    )
    got = {
        r.metric_date.isoformat(): (r.total_sales, r.total_orders, r.average_order_value_faithful)
        for r in metrics.process_orders_metrics(table, orders).collect()
    }
    assert got == sequential([(d, a) for _, d, a in batch], target)


def test_customer_refresh_equals_full_recompute(seed):
    before = seed.orders.filter("order_id NOT IN ('o9', 'o10')")
    changed = metrics.changed_customers(None, seed.orders.filter("order_id IN ('o9', 'o10')"))
    args = (seed.items, seed.products, "2024-03-01 00:00:00")
    old = metrics.customer_analytics(seed.customers, before, *args)
    fresh = metrics.refresh_customer_analytics(old, changed, seed.customers, seed.orders, *args)
    assert same(fresh, metrics.customer_analytics(seed.customers, seed.orders, *args))


def test_reconcile_finds_the_six_unequal_orders(seed):
    out = quality.reconcile(seed.orders, seed.items, "order_id", "total_amount", "total_price").collect()
    assert sorted(r.order_id for r in out if r.outcome == "DIFFERENT") == ["o4", "o5", "o6", "o7", "o8", "o9"]
    missing = quality.reconcile(seed.orders, seed.items.filter("order_id <> 'o1'"), "order_id", "total_amount", "total_price")
    assert one(missing.filter("order_id = 'o1'")).outcome == "MISSING_IN_TARGET"


def test_quality_suite_words(spark, seed):
    ok = quality.run_rules(quality.standard_rules(seed.customers, seed.orders, seed.items, seed.products, "2024-03-01 00:00:00"), "2024-03-01 00:00:00")
    assert one(quality.summary_text(ok)).summary == "All data quality checks passed" and one(quality.gate(ok)).all_passed
    bad_mail = seed.customers.withColumn("email", F.when(F.col("customer_id") == "c1", F.lit("")).when(F.col("customer_id") != "c2", F.col("email")))
    bad = quality.run_rules(quality.standard_rules(bad_mail, seed.orders, seed.items, seed.products, "2024-02-15 00:00:00"), "2024-02-15 00:00:00")
    assert one(quality.summary_text(bad)).summary == (
        "Data quality issues found: Found 2 customers with missing emails; Found 3 orders with future dates"
    )
    assert not one(quality.gate(bad)).all_passed


def test_orphans_leave_null_keys_out(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in quality.orphans(child, parent, "k").collect()] == [2]


def test_health_presets(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 0), (3, 0), (4, 0), (6, 0)], "e int, f int")
    states = lambda name: [r[0] for r in df.select(quality.health(F.col("e"), quality.PRESETS[name], F.col("f"))).collect()]
    assert states("orchestrator") == ["HEALTHY", "HEALTHY", "WARNING", "WARNING", "UNHEALTHY", "UNHEALTHY"]
    assert states("pipeline") == ["HEALTHY", "WARNING", "WARNING", "UNHEALTHY", "UNHEALTHY", "UNHEALTHY"]
    assert states("operational_view") == ["HEALTHY", "HEALTHY", "WARNING", "WARNING", "WARNING", "UNHEALTHY"]


def errors(spark, n_recent, hours_old=30):
    rows = [(f"r{i}", "t", None, ts("2024-01-02 00:30:00"), False, None, "DATA_PIPELINE", "HIGH") for i in range(n_recent)]
    rows.append(("old", "t", None, ts("2023-12-30 00:00:00"), False, None, "DATA_PIPELINE", "HIGH"))
    return spark.createDataFrame(rows, schemas.TASK_ERRORS)


def test_autoresolve_needs_more_than_five_errors(spark):
    state = lambda n: {r.error_id: r.resolved for r in quality.autoresolve(errors(spark, n).drop("resolution_notes"), "2024-01-02 01:00:00").collect()}
    assert state(5)["old"] is False
    assert state(6)["old"] is True and state(6)["r0"] is False


def test_maintenance_counts(seed):
    rows = {r.metric_name: r.metric_value for r in job_plans.maintenance_metrics(seed.jobs, "2024-04-01 00:00:00").collect()}
    assert rows == {"jobs_cleaned_up": 1, "jobs_retried": 1}


def test_add_months_clamps_to_month_end(spark):
    got = spark.range(1).select(F.add_months(F.lit("2024-03-31").cast("date"), -1).alias("d")).first().d
    assert got.isoformat() == "2024-02-29"


def test_clusters_cover_every_customer_with_orders(seed):
    rows = metrics.customer_clusters(seed.customers, seed.orders, "2024-03-01", clusters=3).collect()
    assert len(rows) == 10 and {r.cluster for r in rows} == {0, 1, 2}
