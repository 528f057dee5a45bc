"""Views, reports and canned questions on the given tables."""

from pyspark.sql import functions as F

from orderlens.plans import questions, reports, views
from orderlens.session import run_dir
from orderlens.sources import documents
from orderlens.suite.registry import JOBS_AS_OF, ORDERS_AS_OF, query

TODAY = f"DATE '{ORDERS_AS_OF[:10]}'"
JOB_DAY = f"DATE '{JOBS_AS_OF[:10]}'"
JOB_NOW = f"TIMESTAMP '{JOBS_AS_OF}'"


def joined(df, *arrays):
    return df.withColumns({a: F.array_join(a, "|") for a in arrays})


# --- customer 360 ------------------------------------------------------------

def _c360(t, fanout=True):
    return views.customer_360(t.customers_placed, t.orders, t.order_items, t.products, ORDERS_AS_OF, fanout)


# Every customer-order-item row spelled out, then folded per customer.
_C360_PARTS = f"""
    lines AS (SELECT a_orders.*, i.product_id FROM a_orders LEFT JOIN a_order_items i USING (order_id)),
    bought AS (SELECT customer_id AS k, string_agg(DISTINCT category, '|' ORDER BY category) AS cats,
        string_agg(DISTINCT product_name, '|' ORDER BY product_name) AS names FROM lines JOIN a_products USING (product_id) GROUP BY 1),
    fanned AS (SELECT customer_id AS k, count(DISTINCT order_id) AS n_orders, sum(total_amount)::DOUBLE AS fan_sum, count(*) AS fan_n,
        max(order_date) AS newest, min(order_date) AS oldest FROM lines GROUP BY 1),
    once AS (SELECT customer_id AS k, sum(total_amount)::DOUBLE AS plain_sum, count(*) AS plain_n FROM a_orders GROUP BY 1),
    dated AS (SELECT *, date_diff('day', newest::DATE, {TODAY})::INTEGER AS age FROM fanned)"""


def _c360_sql(total, n):
    return f"""
    WITH {_C360_PARTS}
    SELECT c.customer_id, customer_name, email, phone, customer_tier, lifetime_value::DOUBLE AS lifetime_value, is_active,
        created_at AS customer_since, replace(tags, ',', '|') AS customer_tags, profile_score, coalesce(n_orders, 0) AS total_orders,
        coalesce({total}, 0) AS total_spent, coalesce({total} / {n}, 0) AS avg_order_value, newest AS last_order_date,
        oldest AS first_order_date, coalesce(cats, '') AS preferred_categories, coalesce(names, '') AS purchased_products,
        age AS days_since_last_order, CASE WHEN age <= 30 THEN 'Active' WHEN age <= 90 THEN 'At Risk' ELSE 'Inactive' END AS customer_status,
        street, city, state, zip AS zip_code
    FROM a_customers c LEFT JOIN dated d ON d.k = c.customer_id LEFT JOIN bought b ON b.k = c.customer_id
        LEFT JOIN once o ON o.k = c.customer_id
    WHERE is_active"""


_C360 = _c360_sql("fan_sum", "fan_n")
_C360_ONCE = _c360_sql("plain_sum", "plain_n")


@query("customer_360", _C360)
def _(t):
    return joined(_c360(t), "customer_tags", "preferred_categories", "purchased_products")


@query("customer_360_dedup", _C360_ONCE)
def _(t):
    return joined(_c360(t, False), "customer_tags", "preferred_categories", "purchased_products")


# --- sales -------------------------------------------------------------------

def _sales(t, fanout=True):
    return views.sales_performance(t.orders, t.order_items, t.products, t.customers, fanout)


# One row per sold item of a known product and customer; modes by counting and ranking.
_SALES = """
    WITH lines AS (SELECT *, date_trunc('month', order_date)::DATE AS m FROM a_orders JOIN a_order_items USING (order_id)
        JOIN a_products USING (product_id) JOIN a_customers USING (customer_id) WHERE status IN ('COMPLETED', 'SHIPPED')),
    votes AS (SELECT m, 'p' AS kind, product_name AS v, count(*) AS n FROM lines GROUP BY ALL
        UNION ALL SELECT m, 'c', category, count(*) FROM lines GROUP BY ALL
        UNION ALL SELECT m, 't', customer_tier, count(*) FROM lines GROUP BY ALL),
    winners AS (PIVOT (SELECT m, kind, v FROM votes WHERE v IS NOT NULL QUALIFY row_number() OVER (PARTITION BY m, kind ORDER BY n DESC, v) = 1)
        ON kind IN ('p', 'c', 't') USING first(v) GROUP BY m),
    sums AS (SELECT m, count(DISTINCT order_id) AS n_orders, count(DISTINCT customer_id) AS n_customers, count(DISTINCT product_id) AS n_products,
        sum(total_amount) AS rev, count(*) AS n, sum(discount_amount)::DOUBLE AS disc, sum(tax_amount)::DOUBLE AS tax, sum(quantity)::BIGINT AS q
        FROM lines GROUP BY m),
    steps AS (SELECT *, lag(rev) OVER (ORDER BY m) AS before FROM sums)
    SELECT m AS sales_month, date_trunc('quarter', m)::DATE AS sales_quarter, date_trunc('year', m)::DATE AS sales_year,
        n_orders AS total_orders, n_customers AS unique_customers, rev::DOUBLE AS total_revenue, rev::DOUBLE / n AS avg_order_value,
        disc AS total_discounts, tax AS total_tax, n_products AS unique_products_sold, q AS total_items_sold,
        p AS top_selling_product, c AS top_selling_category, t AS dominant_customer_tier, before::DOUBLE AS prev_month_revenue,
        (rev - before)::DOUBLE AS revenue_growth, round((rev - before)::DOUBLE / nullif(before::DOUBLE, 0) * 100, 2) AS revenue_growth_pct
    FROM steps JOIN winners USING (m)"""


@query("sales_performance", _SALES)
def _(t):
    return _sales(t)


@query("sales_summary", """
    SELECT date_trunc('month', order_date)::DATE AS month, sum(total_amount)::DOUBLE AS total_sales,
           count(*) AS order_count FROM a_orders WHERE status = 'COMPLETED' GROUP BY 1""")
def _(t):
    return views.sales_summary(t.orders)


# --- products ----------------------------------------------------------------

def _products(t):
    return views.product_performance(t.products, t.order_items, t.orders, t.customers)


_PRODUCTS = """
    WITH sold AS (SELECT i.product_id AS k, count(DISTINCT i.order_id) AS n_orders, sum(quantity)::BIGINT AS q, sum(total_price) AS rev, count(*) AS n
        FROM a_order_items i GROUP BY 1),
    buyers AS (SELECT product_id AS k, count(DISTINCT customer_id) AS buyers, count(DISTINCT customer_id) FILTER (customer_tier = 'ENTERPRISE') AS big,
        min(order_date) AS first_day, max(order_date) AS last_day
        FROM a_order_items JOIN a_orders USING (order_id) LEFT JOIN a_customers USING (customer_id) GROUP BY 1),
    wide AS (SELECT p.*, price - cost AS gap, sold.* EXCLUDE (k), buyers.* EXCLUDE (k)
        FROM a_products p LEFT JOIN sold ON sold.k = product_id LEFT JOIN buyers ON buyers.k = product_id WHERE is_active)
    SELECT product_id, product_name, category, price::DOUBLE AS price, cost::DOUBLE AS cost, gap::DOUBLE AS gross_margin,
        round(gap::DOUBLE / nullif(price::DOUBLE, 0) * 100, 2) AS margin_percentage, coalesce(n_orders, 0) AS orders_containing_product,
        q AS total_quantity_sold, rev::DOUBLE AS total_revenue, q::DOUBLE / n AS avg_quantity_per_order,
        coalesce(buyers, 0) AS unique_customers, coalesce(big, 0) AS enterprise_customers, first_day AS first_sale_date,
        last_day AS last_sale_date, date_diff('day', first_day::DATE, last_day::DATE)::INTEGER AS sale_period_days,
        inventory_count, vendor, support_level, rank() OVER by_rev AS revenue_rank,
        rank() OVER (ORDER BY q DESC NULLS FIRST) AS quantity_rank,
        rank() OVER (PARTITION BY category ORDER BY rev DESC NULLS FIRST) AS category_revenue_rank
    FROM wide WINDOW by_rev AS (ORDER BY rev DESC NULLS FIRST)"""


@query("product_performance", _PRODUCTS)
def _(t):
    return _products(t)


# --- jobs and dashboards -----------------------------------------------------

@query("job_monitoring", f"""
    WITH timed AS (SELECT *, date_diff('minute', created_at, coalesce(updated_at, {JOB_NOW})) AS minutes,
        date_diff('hour', created_at, {JOB_NOW}) AS hours FROM a_jobs)
    SELECT job_id, job_name, job_type, status, created_by, created_at, updated_at,
        execution_time_seconds::DOUBLE AS execution_time_seconds, priority, retry_count, max_retries, error_message,
        minutes AS total_runtime_minutes,
        CASE WHEN status = 'COMPLETED' THEN 'Success'
            WHEN status = 'FAILED' AND retry_count >= max_retries THEN 'Failed (Max Retries)'
            WHEN status = 'FAILED' THEN 'Failed (Will Retry)'
            WHEN status = 'RUNNING' AND hours > 2 THEN 'Long Running'
            WHEN status = 'RUNNING' THEN 'In Progress' ELSE status END AS job_health_status,
        report_type, date_range, NULL::VARCHAR AS output_format, schedule AS schedule_type,
        NULL::VARCHAR AS requesting_department, date_trunc('hour', created_at) AS created_hour, created_at::DATE AS created_date
    FROM timed""")
def _(t):
    return views.job_monitoring(t.jobs, JOBS_AS_OF)


def _dashboard(t, as_of=ORDERS_AS_OF):
    return views.executive_dashboard(t.customers, t.products, t.orders, t.order_items, t.jobs, as_of)


_EXEC = f"""
    WITH o AS (SELECT *, year({TODAY}) - year(order_date) AS back, status IN ('COMPLETED', 'SHIPPED') AS is_sold FROM a_orders),
    figures AS (SELECT sum(total_amount) FILTER (back = 0 AND is_sold)::DOUBLE AS ytd, sum(total_amount) FILTER (back = 1 AND is_sold)::DOUBLE AS prior,
        count(DISTINCT customer_id) FILTER (back = 0) AS buyers, count(*) FILTER (back = 0 AND is_sold) AS n FROM o),
    goods AS (SELECT count(DISTINCT product_id) AS n_sold FROM o JOIN a_order_items USING (order_id) WHERE back = 0),
    people AS (SELECT count(*) FILTER (is_active) AS n_active FROM a_customers),
    stock AS (SELECT count(*) FILTER (is_active) AS n_stock FROM a_products),
    work AS (SELECT count(*) AS n_jobs, count(*) FILTER (status = 'COMPLETED') AS n_done, count(*) FILTER (status = 'FAILED') AS n_bad
        FROM a_jobs WHERE created_at::DATE = {TODAY})
    SELECT {TODAY} AS report_date, 'YTD' AS period_type, ytd AS ytd_revenue, prior AS last_year_revenue, n_active AS total_active_customers,
        buyers AS customers_with_orders_ytd, n_stock AS active_products, n_sold AS products_sold_ytd, n AS orders_ytd,
        ytd / n AS avg_order_value_ytd, n_jobs AS jobs_today, n_done AS jobs_completed_today, n_bad AS jobs_failed_today
    FROM figures, goods, people, stock, work"""


@query("executive_dashboard", _EXEC)
def _(t):
    return _dashboard(t)


_OPS = f"""
    WITH j AS (SELECT count(*) AS n, count(*) FILTER (status = 'RUNNING') AS running,
        count(*) FILTER (status = 'PENDING') AS pending,
        count(*) FILTER (status = 'FAILED' AND retry_count < max_retries) AS retrying,
        count(*) FILTER (created_at >= {JOB_NOW} - INTERVAL 24 HOUR) AS recent, max(updated_at) AS last,
        count(*) FILTER (status = 'FAILED' AND created_at >= {JOB_NOW} - INTERVAL 1 HOUR) AS failed FROM a_jobs),
    o AS (SELECT count(*) AS n, count(*) FILTER (order_date >= {TODAY} - INTERVAL 24 HOUR) AS recent, max(order_date) AS last FROM a_orders),
    m AS (SELECT count(*) AS n, max(updated_at) AS last FROM a_sales_metrics)
    SELECT {JOB_NOW} AS last_updated, (running * {{k}})::DECIMAL(38,0) AS jobs_running, (pending * {{k}})::DECIMAL(38,0) AS jobs_pending,
        (retrying * {{k}})::DECIMAL(38,0) AS jobs_retrying, (j.recent * {{k}})::DECIMAL(38,0) AS jobs_last_24h,
        (o.recent * {{kj}})::DECIMAL(38,0) AS orders_last_24h, j.last AS last_job_update, o.last AS last_order_created,
        m.last AS last_metrics_update,
        CASE WHEN failed * {{k}} > 5 THEN 'UNHEALTHY' WHEN failed * {{k}} > 0 THEN 'WARNING' ELSE 'HEALTHY' END AS system_health_status
    FROM j, o, m"""


@query("operational_status", _OPS.format(k="o.n * m.n", kj="j.n * m.n"))
def _(t):
    return views.operational_status(t.jobs, t.orders, t.sales_metrics, JOBS_AS_OF, ORDERS_AS_OF)


@query("operational_status_dedup", _OPS.format(k="1", kj="1"))
def _(t):
    return views.operational_status(t.jobs, t.orders, t.sales_metrics, JOBS_AS_OF, ORDERS_AS_OF, fanout=False)


# --- reports -----------------------------------------------------------------

_R_SALES = f"""
    SELECT sales_month, total_orders, unique_customers, total_revenue, avg_order_value, revenue_growth_pct,
           top_selling_product, top_selling_category
    FROM ({{view}}) WHERE sales_month >= {TODAY} - INTERVAL 6 MONTH""".replace("{view}", _SALES)


@query("report_sales", _R_SALES)
def _(t):
    return reports.sales_report(_sales(t), ORDERS_AS_OF)


@query("report_sales_summary", f"""
    SELECT count(*) AS total_months, coalesce(arg_max(total_revenue, sales_month), 0)::DOUBLE AS latest_revenue,
           sum(total_orders)::BIGINT AS total_orders_ytd,
           sum(total_revenue::DECIMAL(18,2))::DOUBLE / count(*) AS avg_monthly_revenue
    FROM ({_R_SALES})""")
def _(t):
    return reports.sales_report_summary(reports.sales_report(_sales(t), ORDERS_AS_OF))


_R_CUSTOMER = f"""
    SELECT customer_tier, customer_status, count(*) AS customer_count,
           sum(lifetime_value::DECIMAL(18,2))::DOUBLE / count(*) AS avg_ltv,
           sum(total_orders)::DOUBLE / count(*) AS avg_orders,
           sum(total_spent::DECIMAL(18,2))::DOUBLE AS total_revenue
    FROM ({_C360}) GROUP BY 1, 2"""


def _narrow_c360(t):
    """The view without its preference arrays, which the report does not read."""
    return views.customer_360(
        t.customers_placed, t.orders, t.order_items, t.products, ORDERS_AS_OF, with_products=False
    )


@query("report_customer", _R_CUSTOMER)
def _(t):
    return reports.customer_report(_narrow_c360(t))


@query("report_customer_summary", f"""
    SELECT sum(customer_count)::BIGINT AS total_customers, round(avg(avg_ltv), 6) AS avg_lifetime_value,
           round(sum(avg_ltv * customer_count) / sum(customer_count), 6) AS weighted_lifetime_value,
           sum(total_revenue::DECIMAL(18,2))::DOUBLE AS total_revenue
    FROM ({_R_CUSTOMER})""")
def _(t):
    return reports.customer_report_summary(reports.customer_report(_narrow_c360(t)))


_R_PRODUCT = f"""
    SELECT product_id, product_name, category, total_revenue, total_quantity_sold, margin_percentage, revenue_rank,
           unique_customers, last_sale_date
    FROM ({_PRODUCTS}) WHERE total_revenue > 0 ORDER BY total_revenue DESC, product_id LIMIT 50"""


@query("report_product", _R_PRODUCT)
def _(t):
    return reports.product_report(_products(t))


@query("product_report_top50", f"SELECT product_id, total_revenue FROM ({_R_PRODUCT})")
def _(t):
    revenue = t.order_items.groupBy("product_id").agg(F.sum("total_price").cast("double").alias("total_revenue"))
    active = t.products.filter("is_active").select("product_id")
    return (
        revenue.join(active, "product_id", "left_semi")
        .orderBy(F.col("total_revenue").desc(), "product_id")
        .limit(50)
    )


@query("report_product_summary", f"""
    SELECT count(*) AS total_products, arg_max(product_name, total_revenue) AS top_product,
           sum(total_revenue::DECIMAL(18,2))::DOUBLE AS total_revenue,
           sum(margin_percentage::DECIMAL(18,2))::DOUBLE / count(*) AS avg_margin
    FROM ({_R_PRODUCT})""")
def _(t):
    return reports.product_report_summary(reports.product_report(_products(t)))


@query("report_executive", f"""
    SELECT ytd_revenue, ytd_revenue - last_year_revenue AS revenue_growth, total_active_customers AS active_customers,
           orders_ytd, avg_order_value_ytd AS avg_order_value, jobs_today,
           jobs_completed_today::DOUBLE / greatest(jobs_today, 1) * 100 AS jobs_success_rate
    FROM ({_EXEC})""")
def _(t):
    return reports.executive_report(_dashboard(t))


_R_QUALITY = f"SELECT check_name, table_name, check_type, status, check_timestamp, expected_result, actual_result, error_details FROM a_quality_checks WHERE check_timestamp >= {JOB_DAY} - INTERVAL 7 DAY"


@query("report_data_quality", _R_QUALITY)
def _(t):
    return reports.quality_report(t.quality_checks, JOBS_AS_OF)


@query("report_data_quality_summary", f"""
    SELECT count(*) AS total_checks, count(*) FILTER (status = 'PASS') AS passed_checks,
           count(*) FILTER (status = 'FAIL') AS failed_checks,
           count(*) FILTER (status = 'PASS')::DOUBLE / greatest(count(*), 1) * 100 AS success_rate FROM ({_R_QUALITY})""")
def _(t):
    return reports.quality_report_summary(reports.quality_report(t.quality_checks, JOBS_AS_OF))


@query("job_metrics_24h", f"""
    SELECT count(*) AS total_jobs, count(*) FILTER (status = 'COMPLETED') AS completed_jobs,
           count(*) FILTER (status = 'FAILED') AS failed_jobs, count(*) FILTER (status = 'RUNNING') AS running_jobs,
           coalesce(sum(execution_time_seconds)::DOUBLE / count(*), 0) AS avg_execution_time,
           count(*) FILTER (status = 'COMPLETED')::DOUBLE / greatest(count(*), 1) * 100 AS success_rate
    FROM a_jobs WHERE created_at >= {JOB_NOW} - INTERVAL 24 HOUR""")
def _(t):
    return reports.job_metrics(t.jobs, JOBS_AS_OF)


@query("report_periods", """
    WITH k AS (SELECT job_id, upper(coalesce(report_type, job_type)) AS report_type, created_at::DATE AS d FROM a_jobs)
    SELECT job_id, report_type,
        (CASE report_type WHEN 'SALES_REPORT' THEN d - 1 WHEN 'CUSTOMER_ANALYSIS' THEN d - 1
             WHEN 'PRODUCT_PERFORMANCE' THEN d - 7 WHEN 'EXECUTIVE_DASHBOARD' THEN d - 7
             WHEN 'DATA_QUALITY' THEN date_trunc('month', d) - INTERVAL 1 MONTH END)::DATE AS start_date,
        (CASE WHEN report_type = 'DATA_QUALITY' THEN date_trunc('month', d)
             WHEN report_type IN ('SALES_REPORT', 'CUSTOMER_ANALYSIS', 'PRODUCT_PERFORMANCE', 'EXECUTIVE_DASHBOARD') THEN d END)::DATE AS end_date
    FROM k""")
def _(t):
    return reports.report_periods(t.jobs)


@query("report_batch", """
    WITH k AS (SELECT job_id, status, upper(coalesce(report_type, job_type)) AS r FROM a_jobs),
    f AS (SELECT * FROM (VALUES ('SALES_REPORT', 'sales'), ('CUSTOMER_ANALYSIS', 'customers'),
        ('PRODUCT_PERFORMANCE', 'products'), ('EXECUTIVE_DASHBOARD', 'executive'), ('DATA_QUALITY', 'quality')) v(r, folder))
    SELECT job_id, k.r AS report_type, CASE WHEN folder IS NULL THEN 'FAILED' ELSE 'COMPLETED' END AS status,
        'reports/' || folder || '/' || job_id::VARCHAR || '_' || lower(k.r) || '_20240130.json' AS output_location,
        CASE WHEN folder IS NULL THEN 'Unsupported report type: ' || k.r END AS error_message
    FROM k LEFT JOIN f ON k.r = f.r WHERE status = 'PENDING'""")
def _(t):
    return reports.run_reports(t.jobs, JOBS_AS_OF)


_DOCUMENTS = f"""
    WITH k AS (SELECT job_id, upper(coalesce(report_type, job_type)) AS report_type, created_at::DATE AS d FROM a_jobs WHERE status = 'PENDING'),
    b AS (SELECT 'SALES_REPORT' AS r, 'sales' AS folder, 'Sales Performance Report' AS title, (SELECT count(*) FROM ({_R_SALES})) AS n, (SELECT arg_max(total_revenue, sales_month) FROM ({_R_SALES}))::DOUBLE AS headline
        UNION ALL SELECT 'CUSTOMER_ANALYSIS', 'customers', 'Customer Analysis Report', (SELECT count(*) FROM ({_R_CUSTOMER})), (SELECT sum(customer_count) FROM ({_R_CUSTOMER}))::DOUBLE
        UNION ALL SELECT 'PRODUCT_PERFORMANCE', 'products', 'Product Performance Report', (SELECT count(*) FROM ({_R_PRODUCT})), (SELECT sum(total_revenue::DECIMAL(18,2)) FROM ({_R_PRODUCT}))::DOUBLE
        UNION ALL SELECT 'EXECUTIVE_DASHBOARD', 'executive', 'Executive Dashboard', NULL, (SELECT ytd_revenue FROM ({_EXEC}))::DOUBLE
        UNION ALL SELECT 'DATA_QUALITY', 'quality', 'Data Quality Report', (SELECT count(*) FROM ({_R_QUALITY})), (SELECT count(*) FILTER (status = 'PASS') FROM ({_R_QUALITY}))::DOUBLE)
    SELECT job_id, 'reports/' || folder || '/' || job_id::VARCHAR || '_' || lower(r) || '_20240130.json' AS output_location, title AS report_type,
        (CASE r WHEN 'SALES_REPORT' THEN d - 1 WHEN 'CUSTOMER_ANALYSIS' THEN d - 1 WHEN 'DATA_QUALITY' THEN date_trunc('month', d) - INTERVAL 1 MONTH ELSE d - 7 END)::DATE AS start_date,
        n AS data_rows, headline FROM k JOIN b ON k.report_type = r"""


@query("report_documents", _DOCUMENTS)
def _(t):
    """A batch of all report types, a file for each job: read back from the published locations, by typed fields."""
    sales = reports.sales_report(_sales(t), ORDERS_AS_OF)
    tiers = reports.customer_report(_narrow_c360(t))
    products = reports.product_report(_products(t))
    checks = reports.quality_report(t.quality_checks, JOBS_AS_OF)
    bodies = {
        "SALES_REPORT": (sales, reports.sales_report_summary(sales)),
        "CUSTOMER_ANALYSIS": (tiers, reports.customer_report_summary(tiers)),
        "PRODUCT_PERFORMANCE": (products, reports.product_report_summary(products)),
        "EXECUTIVE_DASHBOARD": (None, reports.executive_report(_dashboard(t))),
        "DATA_QUALITY": (None, reports.quality_report_summary(checks)),
    }
    folder = run_dir(t.spark, "reports")
    made = {k: reports.report_body(k, data, summary, ORDERS_AS_OF) for k, (data, summary) in bodies.items()}
    reports.publish(t.spark, t.jobs, made, {"DATA_QUALITY": checks}, folder, JOBS_AS_OF)
    lines = t.spark.read.schema(checks.schema).json(f"{folder}/reports/quality/data").agg(F.count(F.lit(1)).alias("lines"))
    kind = ("job_id long, report_type string, parameters struct<start_date: date, end_date: date>, data array<struct<x: int>>,"
            " summary struct<latest_revenue: double, total_customers: double, total_revenue: double, ytd_revenue: double, passed_checks: double>")
    read = documents.read_documents(t.spark, folder).select("output_location", F.from_json("document", kind).alias("d")).crossJoin(lines)
    got = F.col("d.summary")
    return read.select(
        "d.job_id", "output_location", "d.report_type", F.col("d.parameters.start_date").alias("start_date"),
        F.when(F.col("d.report_type") == "Data Quality Report", F.col("lines")).otherwise(F.size("d.data").cast("long")).alias("data_rows"),
        F.coalesce(got["latest_revenue"], got["ytd_revenue"], got["passed_checks"], F.when(F.col("d.report_type") == "Customer Analysis Report", got["total_customers"]),
                   got["total_revenue"]).alias("headline"),
    )



# --- canned questions --------------------------------------------------------

@query("top_customers", """
    SELECT customer_id, customer_name, customer_tier, lifetime_value::DOUBLE AS lifetime_value, email,
           CASE WHEN is_active THEN 'Active' ELSE 'Inactive' END AS status
    FROM a_customers ORDER BY a_customers.lifetime_value DESC NULLS FIRST, customer_id LIMIT 10""")
def _(t):
    return questions.top_customers(t.customers)


@query("customers_by_tier", """
    SELECT customer_tier, count(*) AS customer_count, sum(lifetime_value)::DOUBLE / count(*) AS avg_lifetime_value,
           sum(lifetime_value)::DOUBLE AS total_lifetime_value FROM a_customers WHERE is_active GROUP BY 1""")
def _(t):
    return questions.customers_by_tier(t.customers)


@query("customer_tier_span", """
    SELECT customer_tier, count(*) AS customer_count, sum(lifetime_value)::DOUBLE / count(*) AS avg_ltv,
           min(created_at) AS first_customer, max(created_at) AS latest_customer FROM a_customers GROUP BY 1""")
def _(t):
    return questions.customer_tier_span(t.customers)


@query("top_products_by_price", """
    SELECT product_id, product_name, category, price::DOUBLE AS price, cost::DOUBLE AS cost,
           round((price - cost)::DOUBLE / nullif(price::DOUBLE, 0) * 100, 2) AS margin_percentage, is_active
    FROM a_products ORDER BY a_products.price DESC NULLS FIRST, product_id LIMIT 15""")
def _(t):
    return questions.top_products_by_price(t.products)


@query("category_summary", """
    SELECT category, count(*) AS product_count, sum(price)::DOUBLE / count(*) AS avg_price,
           sum(cost)::DOUBLE / count(*) AS avg_cost,
           sum(((price - cost)::DOUBLE / nullif(price::DOUBLE, 0) * 100)::DECIMAL(18,6))::DOUBLE / count(*) AS avg_margin_pct
    FROM a_products WHERE is_active GROUP BY 1""")
def _(t):
    return questions.category_summary(t.products)


@query("recent_orders", """
    SELECT o.order_id, c.customer_name, o.order_date, o.total_amount::DOUBLE AS total_amount, o.status
    FROM a_orders o JOIN a_customers c ON o.customer_id = c.customer_id
    ORDER BY o.order_date DESC NULLS FIRST, o.order_id LIMIT 20""")
def _(t):
    return questions.recent_orders(t.orders, t.customers)


@query("monthly_orders", f"""
    SELECT date_trunc('month', order_date)::DATE AS month, count(*) AS order_count, sum(total_amount)::DOUBLE AS total_revenue,
           sum(total_amount)::DOUBLE / count(*) AS avg_order_value
    FROM a_orders WHERE order_date >= {TODAY} - INTERVAL 12 MONTH GROUP BY 1""")
def _(t):
    return questions.monthly_orders(t.orders, ORDERS_AS_OF)


@query("jobs_by_type_status", f"""
    SELECT job_type, status, count(*) AS job_count, sum(execution_time_seconds)::DOUBLE / count(*) AS avg_execution_time,
           max(created_at) AS latest_job
    FROM a_jobs WHERE created_at >= {JOB_DAY} - INTERVAL 7 DAY GROUP BY 1, 2""")
def _(t):
    return questions.jobs_by_type_status(t.jobs, JOBS_AS_OF)


def _any(words):
    return "(" + " OR ".join(f"contains(q, '{w}')" for w in words) + ")"


_FAM, _REF = questions.FAMILIES, questions.REFINEMENTS


@query("question_routing", f"""
    WITH l AS (SELECT conv_id, turn, lower(question) AS q FROM a_questions)
    SELECT conv_id, turn, CASE
        WHEN {_any(_FAM['customer'])} THEN CASE WHEN {_any(_REF['top'])} THEN 'top_customers'
             WHEN {_any(_REF['count'])} THEN 'customers_by_tier' ELSE 'customer_tier_span' END
        WHEN {_any(_FAM['product'])} THEN CASE WHEN {_any(_REF['price'])} THEN 'top_products_by_price' ELSE 'category_summary' END
        WHEN {_any(_FAM['order'])} THEN CASE WHEN {_any(_REF['recent'])} THEN 'recent_orders' ELSE 'monthly_orders' END
        WHEN {_any(_FAM['job'])} THEN 'jobs_by_type_status' ELSE 'fallback' END AS template
    FROM l""")
def _(t):
    return t.questions.select("conv_id", "turn", questions.route(F.col("question")).alias("template"))
