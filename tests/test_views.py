from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.plans import reports, views
from tests.seed import ts

AS_OF = "2025-09-01 00:00:00"


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def by(df, key):
    return {r[key]: r for r in df.collect()}


def c360(seed, **kw):
    return views.customer_360(seed.customers, seed.orders, seed.items, seed.products, AS_OF, **kw)


def test_customer_report_golden_numbers(seed):
    summary = one(reports.customer_report_summary(reports.customer_report(c360(seed))))
    assert summary.total_customers == 10
    assert round(summary.avg_lifetime_value, 2) == 178166.67
    assert summary.total_revenue == 262000.0


def test_customer_view_counts_each_order_once_without_fanout(seed):
    total = one(c360(seed, fanout=False).agg(F.sum("total_spent").alias("s")))
    assert total.s == 111000.0


@pytest.mark.parametrize("fanout", [True, False])
def test_customer_view_is_the_same_without_preferences(seed, fanout):
    narrow = c360(seed, fanout=fanout, with_products=False)
    wide = c360(seed, fanout=fanout).select(*narrow.columns)
    assert narrow.exceptAll(wide).count() == 0 and wide.exceptAll(narrow).count() == 0


def test_customer_without_orders(spark, seed):
    lonely = seed.customers.filter("customer_id = 'c1'").withColumn("customer_id", F.lit("c99"))
    row = by(views.customer_360(seed.customers.unionByName(lonely), seed.orders, seed.items, seed.products, AS_OF), "customer_id")["c99"]
    assert (row.total_orders, row.total_spent, row.avg_order_value) == (0, 0.0, 0.0)
    assert row.preferred_categories == [] and row.customer_status == "Inactive" and row.last_order_date is None
    assert row.street == "c1 road" and row.zip_code is None


@pytest.mark.parametrize("as_of,status", [("2024-03-21", "Active"), ("2024-03-22", "At Risk"), ("2024-05-20", "At Risk"), ("2024-05-21", "Inactive")])
def test_status_boundaries_at_30_and_90_days(seed, as_of, status):
    orders = seed.orders.filter("order_id = 'o10'").withColumn("order_date", F.lit("2024-02-20 09:30:00").cast("timestamp_ntz"))
    got = orders.select(views.customer_status(F.col("order_date"), as_of).alias("s"))
    assert one(got).s == status


def test_sales_performance_golden_months(seed):
    rows = by(views.sales_performance(seed.orders, seed.items, seed.products, seed.customers), "sales_month")
    jan, feb = rows[ts("2024-01-01").date()], rows[ts("2024-02-01").date()]
    assert (jan.total_orders, jan.unique_customers, jan.total_revenue) == (2, 2, 35000.0)
    assert round(jan.avg_order_value, 2) == 11666.67
    assert (jan.total_discounts, jan.total_tax, jan.unique_products_sold, jan.total_items_sold) == (500.0, 3450.0, 2, 5)
    assert jan.prev_month_revenue is None and jan.revenue_growth_pct is None
    assert (feb.total_orders, feb.unique_customers, feb.total_revenue) == (4, 4, 95700.0)
    assert (round(feb.avg_order_value, 2), feb.total_discounts, feb.total_tax) == (10633.33, 4785.0, 8673.0)
    assert (feb.unique_products_sold, feb.total_items_sold) == (6, 12)
    assert (feb.revenue_growth, feb.revenue_growth_pct) == (60700.0, 173.43)


def test_mode_tie_takes_the_smallest_value(seed):
    rows = by(views.sales_performance(seed.orders, seed.items, seed.products, seed.customers), "sales_month")
    # p2, p6 and p8 are sold twice each in February: Mosaic < Rampart < Turnstile.
    assert rows[ts("2024-02-01").date()].top_selling_product == "Mosaic"


def test_product_ranks_put_the_unsold_product_first(seed):
    view = views.product_performance(seed.products, seed.items, seed.orders, seed.customers)
    rows = by(view, "product_id")
    assert {k: rows[k].revenue_rank for k in ("p5", "p1", "p3", "p10")} == {"p5": 1, "p1": 2, "p3": 3, "p10": 4}
    assert rows["p5"].total_revenue is None and rows["p5"].orders_containing_product == 0
    assert rows["p1"].enterprise_customers == 4 and rows["p1"].vendor == "V"


def test_product_report_golden_numbers(seed):
    view = views.product_performance(seed.products, seed.items, seed.orders, seed.customers)
    s = one(reports.product_report_summary(reports.product_report(view)))
    assert (s.total_products, s.top_product, s.total_revenue, round(s.avg_margin, 2)) == (9, "Lantern", 115600.0, 71.51)


def test_zero_price_has_no_margin(spark, seed):
    free = seed.products.filter("product_id = 'p5'").withColumn("price", F.lit(0).cast("decimal(10,2)"))
    row = one(views.product_performance(free, seed.items, seed.orders, seed.customers))
    assert row.margin_percentage is None


def test_item_without_order_still_counts_its_quantity(spark, seed):
    stray = spark.createDataFrame([("x", "nowhere", "p5", 4, Decimal(3500), Decimal(14000))], schemas.ORDER_ITEMS)
    view = views.product_performance(seed.products, seed.items.unionByName(stray), seed.orders, seed.customers)
    row = by(view, "product_id")["p5"]
    assert (row.orders_containing_product, row.total_quantity_sold, row.unique_customers) == (1, 4, 0)
    assert row.first_sale_date is None


def test_executive_dashboard_golden_numbers(seed):
    row = one(views.executive_dashboard(seed.customers, seed.products, seed.orders, seed.items, seed.jobs, "2024-02-12 12:00:00"))
    assert (row.ytd_revenue, row.orders_ytd, round(row.avg_order_value_ytd, 2)) == (61100.0, 6, 10183.33)
    assert (row.products_sold_ytd, row.customers_with_orders_ytd, row.last_year_revenue) == (9, 10, None)
    assert (row.jobs_today, row.jobs_completed_today, row.jobs_failed_today) == (5, 1, 2)
    report = one(reports.executive_report(views.executive_dashboard(seed.customers, seed.products, seed.orders, seed.items, seed.jobs, "2024-02-12 12:00:00")))
    assert report.jobs_success_rate == 20.0


def test_dashboard_of_a_year_without_orders_has_null_sums(seed):
    row = one(views.executive_dashboard(seed.customers, seed.products, seed.orders, seed.items, seed.jobs, "2030-01-01 00:00:00"))
    assert row.ytd_revenue is None and row.orders_ytd == 0 and row.avg_order_value_ytd is None


def test_job_health_and_boundary_minutes(seed):
    rows = by(views.job_monitoring(seed.jobs, "2024-02-12 06:01:00"), "job_id")
    assert rows["j1"].job_health_status == "Success" and rows["j1"].report_type == "sales_report"
    assert rows["j2"].job_health_status == "Failed (Max Retries)"
    assert rows["j3"].job_health_status == "Long Running"  # 03 -> 06 crosses three hours
    assert rows["j3"].report_type is None and rows["j3"].schedule_type == "daily"
    assert rows["j4"].job_health_status == "PENDING" and rows["j4"].total_runtime_minutes == 61
    assert rows["j5"].job_health_status == "Failed (Will Retry)"


def test_operational_status_multiplies_and_empties(seed):
    metrics = seed.spark.createDataFrame([("m1", None, None, 1, 1, None, None, None, ts("2024-02-12 00:00:00")),
                                          ("m2", None, None, 1, 1, None, None, None, None)], schemas.SALES_METRICS)
    row = one(views.operational_status(seed.jobs, seed.orders, metrics, "2024-02-12 06:30:00"))
    assert row.jobs_running == 1 * 10 * 2 and row.jobs_retrying == 20
    assert row.system_health_status == "UNHEALTHY"  # one failure, multiplied
    plain = one(views.operational_status(seed.jobs, seed.orders, metrics, "2024-02-12 06:30:00", fanout=False))
    assert plain.jobs_running == 1 and plain.system_health_status == "WARNING"
    empty = one(views.operational_status(seed.jobs, seed.orders, metrics.filter("1 = 0"), "2024-02-12 06:30:00"))
    assert empty.jobs_running == 0 and empty.last_job_update is None and empty.system_health_status == "HEALTHY"


def test_empty_reports(seed):
    empty = views.sales_performance(seed.orders.filter("1 = 0"), seed.items, seed.products, seed.customers)
    s = one(reports.sales_report_summary(reports.sales_report(empty, AS_OF)))
    assert s.total_months == 0 and s.latest_revenue == 0.0 and s.avg_monthly_revenue != s.avg_monthly_revenue


def test_report_bodies_are_json(seed, tmp_path):
    import json

    perf = views.sales_performance(seed.orders, seed.items, seed.products, seed.customers)
    data = reports.sales_report(perf, "2024-03-01 00:00:00")
    body = reports.report_body("SALES_REPORT", data, reports.sales_report_summary(data), "2024-03-01", {"format": "json"})
    reports.write_report(body, str(tmp_path / "out"))
    doc = json.loads(one(seed.spark.read.text(str(tmp_path / "out"))).value)
    assert doc["report_type"] == "Sales Performance Report" and doc["summary"]["total_months"] == 2
    assert len(doc["data"]) == 2 and doc["parameters"] == {"format": "json"}


def test_report_routing(seed):
    rows = by(reports.run_reports(seed.jobs.withColumn("status", F.lit("PENDING")), "2024-02-12"), "job_id")
    assert rows["j1"].status == "COMPLETED" and rows["j1"].output_location == "reports/sales/j1_sales_report_20240212.json"
    assert rows["j2"].status == "FAILED" and rows["j2"].error_message == "Unsupported report type: ANALYSIS"
