"""Metrics, refreshes, job pipelines and cohorts on the given tables."""

from pyspark.sql import functions as F

from orderlens.functions import dbl, ntz
from orderlens.operators import changes
from orderlens.plans import jobs as job_plans
from orderlens.plans import delta, metrics, reports
from orderlens.session import run_dir
from orderlens.sources.audit import write_with_audit
from orderlens.suite.quality_suite import SUITE_SQL
from orderlens.suite.registry import JOBS_AS_OF, ORDERS_AS_OF, query

NOW = f"TIMESTAMP '{JOBS_AS_OF}'"
TODAY = f"DATE '{ORDERS_AS_OF[:10]}'"
SOLD = "status IN ('COMPLETED', 'SHIPPED')"

# The literals that the daily rows carry.
_LITERALS = "'Top Product' AS top_selling_product, 'Top Category' AS top_selling_category", "0.95::DOUBLE AS system_health_score"
# From one fact an order (its day, customer and number of items) to customers of a day, then to days.
_ALL_DAYS = f"""
    WITH fact AS (SELECT o.order_id, o.customer_id, o.order_date::DATE AS day, c.created_at::DATE AS joined, o.total_amount, greatest(coalesce(i.lines, 0), 1) AS fan
        FROM a_orders o JOIN a_customers c ON c.customer_id = o.customer_id
        LEFT JOIN (SELECT order_id, count(*) AS lines FROM a_order_items GROUP BY 1) i ON i.order_id = o.order_id WHERE o.{SOLD}),
    people AS (SELECT day, customer_id, any_value(joined) AS joined, count(*) AS n, sum(total_amount * fan) AS money, sum(fan) AS weight FROM fact GROUP BY 1, 2),
    days AS (SELECT day, sum(money)::DOUBLE AS money, sum(weight) AS weight, sum(n) AS n, count(*) AS people, count(*) FILTER (joined = day) AS fresh,
        count(*) FILTER (joined < day) AS known FROM people GROUP BY 1),
    goods AS (SELECT day, count(*) AS n FROM (SELECT DISTINCT day, product_id FROM fact JOIN a_order_items USING (order_id)) GROUP BY 1),
    work AS (SELECT created_at::DATE AS day, count(*) FILTER (status = 'COMPLETED') AS done, count(*) FILTER (status = 'FAILED') AS failed FROM a_jobs GROUP BY 1)
    SELECT coalesce(days.day, work.day) AS metric_date, coalesce(money, 0) AS total_revenue, coalesce(days.n, 0)::BIGINT AS total_orders, coalesce(people, 0) AS unique_customers,
        coalesce(fresh, 0) AS new_customers, coalesce(known, 0) AS returning_customers, coalesce(money / weight, 0)::DOUBLE AS average_order_value,
        coalesce(goods.n, 0) AS products_sold, {_LITERALS[0]}, coalesce(done, 0) AS jobs_completed, coalesce(failed, 0) AS jobs_failed, {_LITERALS[1]}
    FROM days FULL JOIN work ON work.day = days.day LEFT JOIN goods ON goods.day = days.day"""


def _one_day_sql(day):
    """One row even for a day without orders: sums are 0 there."""
    return f"""
    SELECT d AS metric_date, coalesce(total_revenue, 0)::DOUBLE AS total_revenue, coalesce(total_orders, 0) AS total_orders,
        coalesce(unique_customers, 0) AS unique_customers, coalesce(new_customers, 0) AS new_customers,
        coalesce(returning_customers, 0) AS returning_customers, coalesce(average_order_value, 0)::DOUBLE AS average_order_value,
        coalesce(products_sold, 0) AS products_sold, 'Top Product' AS top_selling_product, 'Top Category' AS top_selling_category,
        coalesce(jobs_completed, 0) AS jobs_completed, coalesce(jobs_failed, 0) AS jobs_failed, 0.95::DOUBLE AS system_health_score
    FROM (SELECT DATE '{day}' AS d) LEFT JOIN ({_ALL_DAYS}) ON metric_date = d"""


@query("daily_metrics_backfill", _ALL_DAYS)
def _(t):
    return metrics.daily_metrics(t.orders, t.customers, t.order_items, t.jobs)


@query("daily_metrics_one_day", _one_day_sql("2000-03-15"))
def _(t):
    return metrics.daily_metrics(t.orders, t.customers, t.order_items, t.jobs, ["2000-03-15"])


_ANALYTICS = f"""
    SELECT 'ANALYTICS_20010801' AS metric_id, DATE '2001-08-01' AS metric_date, coalesce(sum(o.total_amount), 0)::DOUBLE AS total_sales,
        (SELECT count(*) FROM a_orders WHERE order_date::DATE = DATE '2001-08-01') AS total_orders,
        count(DISTINCT c.customer_id) AS unique_customers, sum(o.total_amount)::DOUBLE / count(o.total_amount) AS average_order_value,
        'N/A' AS top_product, 'Analytics' AS top_category
    FROM a_customers c LEFT JOIN a_orders o ON c.customer_id = o.customer_id WHERE c.is_active"""
_SALES_ROWS = """SELECT metric_id, metric_date, total_sales::DOUBLE AS total_sales, total_orders, unique_customers,
        total_sales::DOUBLE / total_orders AS average_order_value, NULL::VARCHAR AS top_product, NULL::VARCHAR AS top_category FROM a_sales_metrics"""


def _sales_table(t):
    none = F.lit(None).cast("string")
    return t.sales_metrics.select(
        "metric_id", "metric_date", dbl(F.col("total_sales")).alias("total_sales"), "total_orders", "unique_customers",
        (dbl(F.col("total_sales")) / F.col("total_orders")).alias("average_order_value"),
        none.alias("top_product"), none.alias("top_category"),
    )


@query("daily_sales_metrics", f"{_SALES_ROWS} UNION ALL {_ANALYTICS}")
def _(t):
    return metrics.daily_sales_metrics(_sales_table(t), t.customers, t.orders, "2001-08-01 00:00:00")


_LATE = "order_priority = '1-URGENT'"


@query("process_orders_batch", f"""
    WITH t AS (SELECT order_date::DATE AS d, sum(total_amount) AS s, count(*) AS n, count(DISTINCT customer_id) AS c FROM a_orders WHERE NOT {_LATE} GROUP BY 1),
    b AS (SELECT order_date::DATE AS d, sum(total_amount) AS s, count(*) AS n, arg_max(total_amount, order_id) AS last FROM a_orders WHERE {_LATE} GROUP BY 1),
    m AS (SELECT coalesce(t.d, b.d) AS d, coalesce(t.s, 0) + coalesce(b.s, 0) AS s, coalesce(t.n, 0) + coalesce(b.n, 0) AS n, coalesce(t.c, 1) AS c,
          b.n AS bn, b.last, t.s::DOUBLE / t.n AS old_avg FROM t FULL JOIN b ON t.d = b.d)
    SELECT 'SM_' || strftime(d, '%Y%m%d') AS metric_id, d AS metric_date, s::DOUBLE AS total_sales, n::BIGINT AS total_orders, c::BIGINT AS unique_customers,
        CASE WHEN bn IS NULL THEN old_avg ELSE s::DOUBLE / n END AS average_order_value,
        CASE WHEN bn IS NULL THEN old_avg WHEN n = 1 THEN last::DOUBLE ELSE (s - last)::DOUBLE / (n - 1) END AS average_order_value_faithful FROM m""")
def _(t):
    late = F.col("order_priority") == "1-URGENT"
    days = (
        t.orders.filter(~late).groupBy(F.to_date("order_date").alias("metric_date"), "customer_id")
        .agg(F.sum("total_amount").alias("s"), F.count(F.lit(1)).alias("n"))
        .groupBy("metric_date")
        .agg(F.sum("s").alias("total_sales"), F.sum("n").alias("total_orders"), F.count("customer_id").alias("unique_customers"))
        .withColumn("average_order_value", dbl(F.col("total_sales")) / F.col("total_orders"))
    )
    return metrics.process_orders_metrics(days, t.orders.filter(late))


@query("process_orders_customers", f"""
    SELECT customer_id, (lifetime_value + coalesce(s, 0))::DOUBLE AS lifetime_value FROM a_customers
    LEFT JOIN (SELECT customer_id, sum(total_amount) AS s FROM a_orders WHERE {_LATE} GROUP BY 1) USING (customer_id)""")
def _(t):
    customers = t.customers.select("customer_id", F.col("lifetime_value").cast("decimal(28,2)").alias("lifetime_value"))
    out = metrics.process_orders_customers(customers, t.orders.filter(F.col("order_priority") == "1-URGENT"))
    return out.withColumn("lifetime_value", dbl(F.col("lifetime_value")))


# --- refreshes: the incremental result must equal a full recompute ------------

def _customer_sql(as_of, where="TRUE"):
    return f"""
    SELECT customer_id, DATE '{as_of[:10]}' AS analysis_date, orders AS total_orders, spent AS total_spent, coalesce(spent / nullif(orders, 0), 0) AS avg_order_value,
        days AS days_since_last_order, CASE WHEN days <= 30 THEN 'Active' WHEN days <= 90 THEN 'At Risk' ELSE 'Inactive' END AS customer_status,
        spent + 3 * coalesce(spent / nullif(orders, 0), 0) AS predicted_ltv, round(coalesce(least(1.0, days / 180.0), 1.0)::DOUBLE, 2) AS churn_risk_score,
        CASE WHEN spent >= 3000000 THEN 'VIP' WHEN spent >= 1000000 THEN 'REGULAR' ELSE 'OCCASIONAL' END AS customer_segment
    FROM (SELECT c.customer_id, count(o.order_id) AS orders, coalesce(sum(o.total_amount), 0)::DOUBLE AS spent,
                 date_diff('day', max(o.order_date)::DATE, DATE '{as_of[:10]}')::INTEGER AS days
          FROM a_customers c LEFT JOIN a_orders o ON o.customer_id = c.customer_id AND {where} WHERE c.is_active GROUP BY 1)"""


_OLD_AS_OF = "2001-07-01 00:00:00"


@query("customer_analytics_refresh", f"""
    WITH old AS ({_customer_sql(_OLD_AS_OF, f"o.order_date < TIMESTAMP '{_OLD_AS_OF}'")}), new AS ({_customer_sql(ORDERS_AS_OF)}),
    changed AS (SELECT DISTINCT customer_id FROM a_orders WHERE order_date >= TIMESTAMP '{_OLD_AS_OF}')
    SELECT * FROM new WHERE customer_id IN (SELECT customer_id FROM changed)
    UNION ALL SELECT * FROM old WHERE customer_id NOT IN (SELECT customer_id FROM changed)""")
def _(t):
    before = t.orders.filter(F.col("order_date") < ntz(_OLD_AS_OF))
    old = metrics.customer_analytics(t.customers_placed, before, t.order_items, t.products, _OLD_AS_OF, with_categories=False)
    columns = ["order_id", "customer_id", "order_date", "total_amount", "status"]
    feed = changes.change_feed(before.select(*columns), t.orders.select(*columns), ["order_id"])
    changed = metrics.changed_customers(None, feed)
    return metrics.refresh_customer_analytics(
        old, changed, t.customers_placed, t.orders, t.order_items, t.products, ORDERS_AS_OF, with_categories=False
    )


def _product_sql(as_of):
    return f"""
    SELECT product_id, DATE '{as_of[:10]}' AS analysis_date, coalesce(q, 0)::BIGINT AS total_quantity_sold, coalesce(rev, 0)::DOUBLE AS total_revenue,
        round((price - cost)::DOUBLE / nullif(price::DOUBLE, 0) * 100, 2) AS profit_margin,
        coalesce(q, 0)::DOUBLE / nullif(inventory_count, 0) AS inventory_turnover,
        CASE WHEN coalesce(a, 0) > coalesce(b, 0) THEN 'UP' WHEN coalesce(a, 0) < coalesce(b, 0) THEN 'DOWN' ELSE 'FLAT' END AS demand_trend,
        (coalesce(m, 0) * 12)::DOUBLE / nullif(coalesce(rev, 0)::DOUBLE, 0) AS seasonality_factor,
        CASE WHEN coalesce(a, 0) > coalesce(b, 0) AND inventory_count < 10 THEN 'RESTOCK'
             WHEN coalesce(a, 0) < coalesce(b, 0) AND inventory_count > 40 THEN 'PROMOTE' ELSE 'KEEP' END AS recommendation
    FROM a_products p LEFT JOIN (SELECT product_id AS k, sum(quantity) AS q, sum(total_price) AS rev,
            sum(total_price) FILTER (ship_date >= TIMESTAMP '{as_of}' - INTERVAL 30 DAY) AS a,
            sum(total_price) FILTER (ship_date >= TIMESTAMP '{as_of}' - INTERVAL 60 DAY AND ship_date < TIMESTAMP '{as_of}' - INTERVAL 30 DAY) AS b,
            sum(total_price) FILTER (month(ship_date) = {int(as_of[5:7])}) AS m
        FROM a_order_items WHERE ship_date < TIMESTAMP '{as_of}' GROUP BY 1) ON k = product_id WHERE is_active"""


@query("product_analytics_refresh", f"""
    WITH old AS ({_product_sql(_OLD_AS_OF)}), new AS ({_product_sql(ORDERS_AS_OF)}),
    changed AS (SELECT DISTINCT product_id FROM a_order_items WHERE ship_date >= DATE '2001-07-25' AND ship_date < TIMESTAMP '{ORDERS_AS_OF}')
    SELECT * FROM new WHERE product_id IN (SELECT product_id FROM changed)
    UNION ALL SELECT * FROM old WHERE product_id NOT IN (SELECT product_id FROM changed)""")
def _(t):
    old = metrics.product_analytics(t.products, t.order_items, _OLD_AS_OF)
    ship = F.col("ship_date")
    changed = t.order_items.filter((ship >= ntz("2001-07-25")) & (ship < ntz(ORDERS_AS_OF))).select("product_id").distinct()
    return metrics.refresh_product_analytics(old, changed, t.products, t.order_items, ORDERS_AS_OF)


@query("order_metrics_refresh", _ALL_DAYS)
def _(t):
    urgent = F.col("order_priority") == "1-URGENT"
    late = urgent & (F.col("order_date") >= ntz("2001-01-01"))
    before = t.orders.filter(~late)
    target = metrics.daily_metrics(before, t.customers, t.order_items, t.jobs)
    dates = metrics.affected_dates(before, t.orders)
    return metrics.refresh_daily_metrics(target, dates, t.orders, t.customers, t.order_items, t.jobs)


# --- refreshes by delta: counts that change feeds add to and take from ---------

def _yesterday(t):
    """Orders and items before a change with inserts, updates (of amount, day and quantity) and deletes."""
    late = (F.col("order_priority") == "1-URGENT") & (F.col("order_date") >= ntz("2001-01-01"))
    moved = F.col("order_id") % 7 == 0
    orders = t.orders.filter(~late).withColumns({
        "total_amount": F.when(moved, F.col("total_amount") + 100).otherwise(F.col("total_amount")).cast("decimal(12,2)"),
        "order_date": F.when(moved, F.col("order_date") - F.expr("interval 3 days")).otherwise(F.col("order_date")),
    })
    gone = lambda df: df.filter(F.col("order_id") % 11 == 0).withColumn("order_id", F.col("order_id") + 1_000_000_000)
    items = t.order_items.filter("line_number < 6").withColumn(
        "quantity", F.when(F.col("product_id") % 13 == 0, F.col("quantity") + 1).otherwise(F.col("quantity")))
    return orders.unionByName(gone(t.orders)), items.unionByName(gone(t.order_items))


def _changed(t):
    """Yesterday's tables, their counts after adding the change feeds, and what these feeds changed."""
    orders, items = _yesterday(t)
    counts = delta.OrderCounts(t.spark, run_dir(t.spark, "order_counts"), buckets=8).build(orders, items)
    feeds = changes.change_feed(orders, t.orders, ["order_id"]), changes.row_feed(items, t.order_items)
    return orders, items, counts, counts.apply(*feeds, batch=1)


@query("daily_metrics_delta", _ALL_DAYS)
def _(t):
    orders, items, counts, deltas = _changed(t)
    target = metrics.daily_metrics(orders, t.customers, items, t.jobs)
    return delta.refresh_daily(target, counts, deltas, t.customers, t.jobs)


@query("customer_analytics_delta", f"""
    SELECT a.*, coalesce(liked, '') AS preferred_categories FROM ({_customer_sql(ORDERS_AS_OF)}) a
    LEFT JOIN (SELECT customer_id AS k, string_agg(category, '|' ORDER BY category) AS liked FROM (SELECT DISTINCT customer_id, category FROM a_orders
        JOIN a_order_items USING (order_id) JOIN a_products USING (product_id)) GROUP BY 1) ON k = customer_id""")
def _(t):
    orders, items, counts, deltas = _changed(t)
    target = metrics.customer_analytics(t.customers_placed, orders, items, t.products, ORDERS_AS_OF)
    return delta.refresh_customers(target, counts, deltas, t.customers, t.products, ORDERS_AS_OF)


@query("product_analytics_delta", _product_sql(ORDERS_AS_OF))
def _(t):
    _, items, counts, deltas = _changed(t)
    return delta.refresh_products(metrics.product_analytics(t.products, items, ORDERS_AS_OF), counts, deltas, t.products, ORDERS_AS_OF)


@query("order_analytics", """
    SELECT o.order_id, o.customer_id, o.order_date, o.total_amount::DOUBLE AS total_amount,
        round((rev - costs)::DOUBLE / nullif(rev::DOUBLE, 0) * 100, 2) AS profit_margin, coalesce(n, 0)::BIGINT AS n_items,
        CASE WHEN o.total_amount >= 300000 THEN 'LARGE' WHEN o.total_amount >= 100000 THEN 'MEDIUM' ELSE 'SMALL' END AS order_size_category
    FROM a_orders o LEFT JOIN (SELECT order_id AS k, sum(total_price) AS rev, sum(p.cost * quantity) AS costs, count(*) AS n
        FROM a_order_items oi JOIN a_products p ON oi.product_id = p.product_id GROUP BY 1) ON k = o.order_id""")
def _(t):
    return metrics.order_analytics(t.orders, t.order_items, t.products)


@query("product_performance_tier", """
    WITH s AS (SELECT p.product_id, product_name, price, cost, count(oi.product_id) AS n, sum(quantity) AS q, sum(total_price) AS rev
        FROM a_products p LEFT JOIN a_order_items oi ON p.product_id = oi.product_id GROUP BY ALL),
    r AS (SELECT *, rank() OVER (ORDER BY rev DESC NULLS FIRST) AS rk, count(*) OVER () AS total FROM s)
    SELECT product_id, product_name, n AS total_sales, coalesce(q, 0)::BIGINT AS total_quantity_sold, rev::DOUBLE / nullif(q::DOUBLE, 0) AS avg_sale_price,
        round((price - cost)::DOUBLE / nullif(price::DOUBLE, 0) * 100, 2) AS profit_margin,
        CASE floor((rk - 1) * 4 / total)::INTEGER WHEN 0 THEN 'PLATINUM' WHEN 1 THEN 'GOLD' WHEN 2 THEN 'SILVER' ELSE 'BRONZE' END AS performance_tier FROM r""")
def _(t):
    return metrics.product_tiers(t.products, t.order_items)


@query("daily_job_summary", f"""
    SELECT 'daily_metrics' AS step, total_orders AS items, total_revenue AS value FROM ({_one_day_sql("2000-12-31")})
    UNION ALL SELECT 'quality', count(*), count(*) FILTER (status = 'FAIL')::DOUBLE FROM ({SUITE_SQL})
    UNION ALL SELECT 'sales_metrics', (SELECT count(*) FROM a_sales_metrics) + 1,
        ((SELECT sum(total_sales) FROM a_sales_metrics) + (SELECT sum(o.total_amount) FROM a_orders o JOIN a_customers c ON o.customer_id = c.customer_id WHERE c.is_active))::DOUBLE""")
def _(t):
    results = metrics.daily_job(
        t.orders, t.customers, t.order_items, t.products, t.jobs, _sales_table(t), "2001-01-01 00:00:00"
    )
    return metrics.daily_job_summary(results)


# --- job pipelines -----------------------------------------------------------

_OUT = """SELECT job_id AS k, upper(coalesce(report_type, job_type)) AS kind,
    upper(coalesce(report_type, job_type)) IN ('SALES_REPORT', 'CUSTOMER_ANALYSIS', 'PRODUCT_PERFORMANCE', 'EXECUTIVE_DASHBOARD', 'DATA_QUALITY') AS good
    FROM a_jobs WHERE status = 'PENDING' AND created_at >= TIMESTAMP '2024-01-20'"""


@query("job_stream_transition", f"""
    SELECT job_id, CASE WHEN k IS NULL THEN status WHEN good THEN 'SENT_TO_ECS' ELSE 'FAILED' END AS status,
        CASE WHEN k IS NULL OR good THEN retry_count ELSE retry_count + 1 END AS retry_count,
        CASE WHEN k IS NULL OR good THEN error_message ELSE 'dispatch failed: Unsupported report type: ' || kind END AS error_message,
        CASE WHEN k IS NULL THEN updated_at ELSE {NOW} END AS updated_at
    FROM a_jobs LEFT JOIN ({_OUT}) ON job_id = k""")
def _(t):
    columns = ["job_id", "job_type", "status", "priority", "created_at", "input_data"]
    before = t.jobs.filter(F.col("created_at") < ntz("2024-01-20")).select(*columns)
    feed = changes.change_feed(before, t.jobs.select(*columns), ["job_id"])
    ran = reports.run_reports(job_plans.pending_inserts(feed), JOBS_AS_OF)
    outcomes = ran.select("job_id", (F.col("status") == "COMPLETED").alias("accepted"), F.col("error_message").alias("error"))
    return job_plans.dispatch(t.jobs, outcomes, JOBS_AS_OF).select("job_id", "status", "retry_count", "error_message", "updated_at")


@query("job_create", f"""
    SELECT 'JOB_20240130120000_' || substr(md5(event_id || '|20240130120000'), 1, 16) AS job_id, 'signup follow-up' AS job_name, 'REPORT' AS job_type,
        'PENDING' AS status, user_id::VARCHAR AS created_by, {NOW} AS created_at, {NOW} AS updated_at, props AS input_data,
        CASE WHEN value > 20 THEN 1 ELSE 3 END AS priority, 0 AS retry_count, 3 AS max_retries
    FROM a_events WHERE event_type = 'signup'""")
def _(t):
    requests = t.events.filter(F.col("event_type") == "signup").select(
        F.col("event_id").alias("request_id"), F.lit("signup follow-up").alias("job_name"), F.lit("REPORT").alias("job_type"),
        F.col("user_id").cast("string").alias("created_by"), F.col("props").alias("input_data"),
        F.when(F.col("value") > 20, 1).alias("priority"),
    )
    return job_plans.create_jobs(requests, JOBS_AS_OF)


@query("job_maintenance_default", f"""
    SELECT 'jobs_cleaned_up' AS metric_name, count(*) AS metric_value, 'maintenance' AS metric_type FROM a_jobs WHERE status = 'COMPLETED' AND created_at < {NOW} - INTERVAL 30 DAY
    UNION ALL SELECT 'jobs_retried', count(*), 'maintenance' FROM a_jobs WHERE status = 'FAILED' AND retry_count < max_retries AND updated_at < {NOW} - INTERVAL 10 MINUTE""")
def _(t):
    return job_plans.maintenance_metrics(t.jobs, JOBS_AS_OF)


@query("job_maintenance_metrics", f"""
    SELECT 'jobs_cleaned_up' AS metric_name, count(*) AS metric_value, 'maintenance' AS metric_type FROM a_jobs WHERE status = 'COMPLETED' AND created_at < {NOW} - INTERVAL 10 DAY
    UNION ALL SELECT 'jobs_retried', count(*), 'maintenance' FROM a_jobs WHERE status = 'FAILED' AND retry_count < max_retries AND updated_at < {NOW} - INTERVAL 10 MINUTE""")
def _(t):
    return job_plans.maintenance_metrics(t.jobs, JOBS_AS_OF, days=10)


def _runs(t):
    state = F.when(F.col("status") == "COMPLETED", "SUCCESS").when(F.col("status") == "FAILED", "ERROR").otherwise("WARNING")
    return t.jobs.select(
        F.col("job_id").alias("run_id"), F.lower("job_type").alias("task_name"), state.alias("status"),
        F.col("error_message").alias("details"), F.col("created_at").alias("at"),
    )


@query("task_execution_log", """
    WITH r AS (SELECT job_id, lower(job_type) AS task_name, CASE status WHEN 'COMPLETED' THEN 'SUCCESS' WHEN 'FAILED' THEN 'ERROR' ELSE 'WARNING' END AS s,
        coalesce(error_message, '') AS d, created_at FROM a_jobs)
    SELECT 'TASK_' || task_name || '_' || strftime(created_at, '%Y%m%d%H%M%S') || '_' || job_id AS metric_id, created_at AS metric_timestamp,
        'task_execution' AS metric_type, 'task_run' AS metric_name, CASE s WHEN 'SUCCESS' THEN 1.0 WHEN 'WARNING' THEN 0.5 ELSE 0.0 END::DOUBLE AS metric_value,
        '{"task_name":"' || task_name || '","status":"' || s || '","details":"' || d || '"}' AS tags FROM r""")
def _(t):
    return job_plans.execution_log(_runs(t))


@query("task_error_log", """
    SELECT 'ERR_' || lower(job_type) || '_' || strftime(created_at, '%Y%m%d%H%M%S') || '_' || job_id AS error_id, lower(job_type) AS task_name,
        error_message, created_at AS error_timestamp, 'DATA_PIPELINE' AS error_category, 'HIGH' AS severity, FALSE AS resolved
    FROM a_jobs WHERE status = 'FAILED'""")
def _(t):
    return job_plans.error_log(_runs(t))


@query("job_audit_log", """
    SELECT 'order_analytics' AS job_name, count(*) AS rows_processed, sum(total_amount)::DOUBLE AS amount_processed, TRUE AS finished FROM a_orders""")
def _(t):
    table = metrics.order_analytics(t.orders, t.order_items, t.products)
    return write_with_audit(
        table, "order_analytics", run_dir(t.spark, "order_analytics"),
        {"rows_processed": F.count(F.lit(1)), "amount_processed": dbl(F.sum(F.col("total_amount").cast("decimal(18,2)")))},
    ).select("job_name", "rows_processed", "amount_processed", F.col("end_time").isNotNull().alias("finished"))


# --- cohorts, trends, segments -----------------------------------------------

@query("cohort_retention", """
    WITH m AS (SELECT DISTINCT customer_id, date_trunc('month', order_date)::DATE AS month FROM a_orders),
    f AS (SELECT customer_id, min(month) AS cohort_month FROM m GROUP BY 1)
    SELECT cohort_month, date_diff('month', cohort_month, month) AS months_since, count(*) AS customers FROM m JOIN f USING (customer_id) GROUP BY 1, 2""")
def _(t):
    return metrics.cohort_retention(t.orders)


@query("trend_slope", """
    WITH m AS (SELECT date_trunc('month', order_date)::DATE AS month, sum(total_amount)::DOUBLE AS revenue FROM a_orders GROUP BY 1),
    n AS (SELECT *, row_number() OVER (ORDER BY month) AS i FROM m)
    SELECT month, revenue, CASE WHEN i >= 3 THEN round(regr_slope(revenue, i) OVER (ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) END AS slope FROM n""")
def _(t):
    return metrics.trend_slope(t.orders)


@query("rfm_segments", f"""
    WITH s AS (SELECT customer_id, date_diff('day', max(order_date)::DATE, {TODAY})::INTEGER AS recency, count(*) AS frequency, sum(total_amount) AS value
        FROM a_customers JOIN a_orders USING (customer_id) GROUP BY 1),
    r AS (SELECT *, (floor((rank() OVER (ORDER BY recency DESC) - 1) * 5 / count(*) OVER ()) + 1)::INTEGER AS r_score,
        (6 - (floor((rank() OVER (ORDER BY frequency DESC) - 1) * 5 / count(*) OVER ()) + 1))::INTEGER AS f_score,
        (6 - (floor((rank() OVER (ORDER BY value DESC) - 1) * 5 / count(*) OVER ()) + 1))::INTEGER AS m_score FROM s)
    SELECT customer_id, recency, frequency, value::DOUBLE AS value, r_score, f_score, m_score,
        CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'CHAMPION' WHEN r_score <= 2 THEN 'AT_RISK' ELSE 'REGULAR' END AS segment FROM r""")
def _(t):
    return metrics.rfm_segments(t.customers, t.orders, ORDERS_AS_OF)


def _cluster_sql(clusters=4, rounds=6):
    """The rounds one after the other, centres as rows of a table."""
    z = ", ".join(f"({c} - m_{c}) / d_{c} AS z_{c}" for c in metrics.FEATURES)
    spread = ", ".join(f"avg({c}::DOUBLE) AS m_{c}, coalesce(nullif(stddev_pop({c}::DOUBLE), 0), 1) AS d_{c}" for c in metrics.FEATURES)
    apart = " + ".join(f"(z_{c} - c_{c}) ** 2" for c in metrics.FEATURES)
    steps = ["c0 AS (SELECT i::INTEGER AS k, 0.0::DOUBLE AS c_recency, 0.0::DOUBLE AS c_frequency, i - " + str((clusters - 1) / 2) + f"::DOUBLE AS c_cents FROM range({clusters}) r(i))"]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS (SELECT f.customer_id, arg_min(k, ({apart}, k)) AS k FROM z f, c{i} GROUP BY 1)")
        means = ", ".join(f"coalesce(avg(z_{c}), any_value(c_{c})) AS c_{c}" for c in metrics.FEATURES)
        steps.append(f"c{i + 1} AS (SELECT c{i}.k, {means} FROM c{i} LEFT JOIN (SELECT * FROM a{i} JOIN z USING (customer_id)) m ON m.k = c{i}.k GROUP BY c{i}.k)")
    return f"""
    WITH f AS (SELECT customer_id, date_diff('day', max(order_date)::DATE, {TODAY}) AS recency, count(*) AS frequency, any_value((lifetime_value * 100)::BIGINT) AS cents
        FROM a_customers JOIN a_orders USING (customer_id) GROUP BY 1),
    z AS (SELECT f.*, {z} FROM f, (SELECT {spread} FROM f) s), {", ".join(steps)}
    SELECT customer_id, recency::DOUBLE AS recency, frequency::DOUBLE AS frequency, cents / 100.0::DOUBLE AS lifetime_value, a{rounds}.k AS cluster FROM z JOIN a{rounds} USING (customer_id)"""


@query("customer_clusters", _cluster_sql())
def _(t):
    return metrics.customer_clusters(t.customers, t.orders, ORDERS_AS_OF)
