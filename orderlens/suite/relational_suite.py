"""Filters, joins, sorts, set operations, aggregates and windows on the given tables."""

from pyspark.sql import functions as F

from orderlens.functions import dbl, mean, money, ntz
from orderlens.operators import nested_schemas
from orderlens.operators.ranking import rank_desc
from orderlens.plans import relational, views
from orderlens.plans.quality import orphans
from orderlens.session import run_dir, settle
from orderlens.suite.registry import JOBS_AS_OF, ORDERS_AS_OF, query

TODAY = f"DATE '{ORDERS_AS_OF[:10]}'"
NOW = f"TIMESTAMP '{JOBS_AS_OF}'"


@query("scan_orders", """
    SELECT order_id, customer_id, order_date, total_amount::DOUBLE AS total_amount, status,
           discount_amount::DOUBLE AS discount_amount, tax_amount::DOUBLE AS tax_amount FROM a_orders""")
def _(t):
    amounts = {c: dbl(F.col(c)) for c in ("total_amount", "discount_amount", "tax_amount")}
    return t.orders.withColumns(amounts).drop("order_priority")


@query("inline_values_json", """
    WITH v AS (SELECT * FROM (VALUES
        ('click', '{"label": "Click", "weight": 2}', '["web", "app"]'),
        ('purchase', '{"label": "Purchase", "weight": 10}', '["web"]'),
        ('error', '{"label": "Error"}', '[]')) v(event_type, doc, channels))
    SELECT v.event_type, doc->>'$.label' AS label, (doc->>'$.weight')::INTEGER AS weight,
           json_array_length(channels)::INTEGER AS n_channels,
           count(*) AS events, sum(value)::DOUBLE AS value
    FROM v JOIN a_events e ON v.event_type = e.event_type GROUP BY ALL""")
def _(t):
    labels = relational.inline_labels(t.spark)
    sums = t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), dbl(F.sum("value")).alias("value")
    )
    return sums.join(labels, "event_type").select(
        "event_type", "label", "weight", F.size("channels").alias("n_channels"), "events", "value"
    )


# --- filters -----------------------------------------------------------------

@query("sold_orders", """
    SELECT order_id, status, total_amount::DOUBLE AS total_amount FROM a_orders
    WHERE status IN ('COMPLETED', 'SHIPPED')""")
def _(t):
    return views.sold(t.orders).select("order_id", "status", dbl(F.col("total_amount")).alias("total_amount"))


@query("recent_window_filter", f"""
    SELECT 'last_24_hours' AS span, count(*) AS n FROM a_jobs WHERE created_at >= {NOW} - INTERVAL 24 HOUR
    UNION ALL SELECT 'last_7_days', count(*) FROM a_jobs WHERE created_at >= {NOW} - INTERVAL 7 DAY
    UNION ALL SELECT 'last_6_months', count(*) FROM a_orders WHERE order_date >= {TODAY} - INTERVAL 6 MONTH""")
def _(t):
    return relational.recent_counts(t.jobs, t.orders, JOBS_AS_OF, ORDERS_AS_OF)


@query("orders_on_day", f"""
    SELECT order_id, order_date, total_amount::DOUBLE AS total_amount FROM a_orders
    WHERE order_date::DATE = {TODAY} - INTERVAL 1 DAY""")
def _(t):
    return relational.on_day(t.orders, "order_date", "2001-08-01").select(
        "order_id", "order_date", dbl(F.col("total_amount")).alias("total_amount")
    )


@query("regex_conformity", r"""
    SELECT 'customer_phone' AS test_name, CASE WHEN count(*) FILTER (NOT regexp_full_match(phone, '\+1-555-[0-9]{9}')) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
           count(*) FILTER (NOT regexp_full_match(phone, '\+1-555-[0-9]{9}')) AS bad_rows FROM a_customers
    UNION ALL
    SELECT 'customer_email', CASE WHEN count(*) FILTER (NOT regexp_full_match(coalesce(email, ''), '[^@ ]+@[^@ ]+')) = 0 THEN 'PASS' ELSE 'FAIL' END,
           count(*) FILTER (NOT regexp_full_match(coalesce(email, ''), '[^@ ]+@[^@ ]+')) FROM a_customers
    UNION ALL
    SELECT 'product_name_ring', CASE WHEN count(*) FILTER (product_name NOT LIKE '%ring%') = 0 THEN 'PASS' ELSE 'FAIL' END,
           count(*) FILTER (product_name NOT LIKE '%ring%') FROM a_products""")
def _(t):
    c = relational.pattern_checks(
        t.customers, {"customer_phone": ("phone", r"\+1-555-[0-9]{9}"), "customer_email": ("email", r"[^@ ]+@[^@ ]+")}
    )
    return c.unionByName(relational.like_check(t.products, "product_name_ring", "product_name", "%ring%"))


@query("job_status_lookup", """
    SELECT job_id, status, created_at, execution_time_seconds::DOUBLE AS execution_time_seconds
    FROM a_jobs WHERE job_id = 4711""")
def _(t):
    return relational.lookup(t.jobs, "job_id", 4711).select(
        "job_id", "status", "created_at", dbl(F.col("execution_time_seconds")).alias("execution_time_seconds")
    )


@query("orders_without_items", """
    SELECT o.order_id, o.customer_id FROM a_orders o LEFT JOIN a_order_items oi ON o.order_id = oi.order_id
    WHERE oi.order_id IS NULL""")
def _(t):
    return orphans(t.orders, t.order_items, "order_id").select("order_id", "customer_id")


@query("customers_with_orders", f"""
    SELECT customer_id, customer_name FROM a_customers c
    WHERE EXISTS (SELECT 1 FROM a_orders o WHERE o.customer_id = c.customer_id AND o.order_date >= {TODAY} - INTERVAL 3 MONTH)""")
def _(t):
    recent = t.orders.filter(F.col("order_date") >= ntz(F.add_months(views.as_date(ORDERS_AS_OF), -3)))
    return t.customers.join(recent.select("customer_id").distinct(), "customer_id", "left_semi").select(
        "customer_id", "customer_name"
    )


@query("catalog_compare", f"""
    WITH a AS (SELECT DISTINCT product_id FROM a_order_items WHERE ship_date >= DATE '2001-08-01'),
    b AS (SELECT DISTINCT product_id FROM a_order_items WHERE ship_date >= DATE '2001-07-01' AND ship_date < DATE '2001-08-01')
    SELECT 'PRODUCT' AS object_type, coalesce(a.product_id, b.product_id)::VARCHAR AS object_name,
           a.product_id IS NOT NULL AS exists_in_first, b.product_id IS NOT NULL AS exists_in_second
    FROM a FULL JOIN b ON a.product_id = b.product_id
    UNION ALL
    SELECT 'CUSTOMER', coalesce(a.customer_id, b.customer_id)::VARCHAR, a.customer_id IS NOT NULL, b.customer_id IS NOT NULL
    FROM (SELECT DISTINCT customer_id FROM a_orders WHERE order_date >= DATE '2001-07-01') a
    FULL JOIN (SELECT DISTINCT customer_id FROM a_orders WHERE order_date >= DATE '2001-06-01' AND order_date < DATE '2001-07-01') b
    ON a.customer_id = b.customer_id""")
def _(t):
    ship, day = F.col("ship_date"), F.col("order_date")
    return relational.compare_catalogs(
        {
            "PRODUCT": (
                t.order_items.filter(ship >= ntz("2001-08-01")).select("product_id"),
                t.order_items.filter((ship >= ntz("2001-07-01")) & (ship < ntz("2001-08-01"))).select("product_id"),
            ),
            "CUSTOMER": (
                t.orders.filter(day >= ntz("2001-07-01")).select("customer_id"),
                t.orders.filter((day >= ntz("2001-06-01")) & (day < ntz("2001-07-01"))).select("customer_id"),
            ),
        }
    )


def _order_documents(t, later):
    """Orders with their items nested in them; the later form has wider amounts, one field more and one less."""
    amount = "decimal(14,2)" if later else "decimal(12,2)"
    item = [F.col("product_id"), F.col("quantity").cast("bigint" if later else "int").alias("quantity"), F.col("total_price").cast(amount).alias("price")]
    item.append(F.col("ship_date").alias("shipped") if later else F.col("line_number").alias("line"))
    items = t.order_items.groupBy("order_id").agg(F.collect_list(F.struct(*item)).alias("items"))
    head = F.struct("customer_id", F.col("total_amount").cast("decimal(10,2)" if later else amount).alias("amount"), "status")
    return t.orders.select("order_id", head.alias("head")).join(items, "order_id", "left")


@query("schema_compare", """
    SELECT * FROM (VALUES
        ('orders', 'head.amount', 'NARROWED', 'decimal(12,2)', 'decimal(10,2)'),
        ('orders', 'items[].quantity', 'WIDENED', 'int', 'bigint'),
        ('orders', 'items[].price', 'WIDENED', 'decimal(12,2)', 'decimal(14,2)'),
        ('orders', 'items[].shipped', 'ADDED', NULL, 'timestamp_ntz'),
        ('orders', 'items[].line', 'DROPPED', 'int', NULL)
    ) AS v(table_name, path, change, first_type, second_type) WHERE (SELECT count(*) FROM orders) > 0""")
def _(t):
    """The schemas of two written forms of the order documents, as their files hold them."""
    schemas = []
    for later in (False, True):
        path = run_dir(t.spark, "order_documents")
        _order_documents(t, later).write.parquet(path)
        schemas.append({"orders": t.spark.read.parquet(path).schema})
    return nested_schemas.compare(t.spark, *schemas).drop("first_nullable", "second_nullable")


@query("schema_minus", """
    WITH dev AS (SELECT 'customer' AS table_name, k AS column_name FROM (SELECT DISTINCT unnest(
            [CASE WHEN c_custkey IS NOT NULL THEN 'key' END, CASE WHEN c_name IS NOT NULL THEN 'name' END,
             CASE WHEN c_acctbal IS NOT NULL THEN 'acctbal' END, CASE WHEN c_mktsegment IS NOT NULL THEN 'mktsegment' END]) AS k FROM customer) WHERE k IS NOT NULL),
    prod AS (SELECT 'customer' AS table_name, k AS column_name FROM (SELECT DISTINCT unnest(
            [CASE WHEN s_suppkey IS NOT NULL THEN 'key' END, CASE WHEN s_name IS NOT NULL THEN 'name' END,
             CASE WHEN s_acctbal IS NOT NULL THEN 'acctbal' END]) AS k FROM supplier) WHERE k IS NOT NULL)
    SELECT 'only_in_first' AS side, * FROM (SELECT * FROM dev EXCEPT SELECT * FROM prod)
    UNION ALL SELECT 'only_in_second', * FROM (SELECT * FROM prod EXCEPT SELECT * FROM dev)""")
def _(t):
    first = relational.used_columns(t.base("customer"), "customer", "c_", {"custkey": "key"})
    second = relational.used_columns(t.base("supplier"), "customer", "s_", {"suppkey": "key"})
    return relational.drift(first.filter("column_name <> 'nationkey'"), second.filter("column_name <> 'nationkey'"))


@query("table_counts", """
    SELECT 'customers' AS table_name, count(*) AS record_count FROM a_customers
    UNION ALL SELECT 'products', count(*) FROM a_products UNION ALL SELECT 'orders', count(*) FROM a_orders
    UNION ALL SELECT 'order_items', count(*) FROM a_order_items UNION ALL SELECT 'jobs', count(*) FROM a_jobs
    UNION ALL SELECT 'sales_metrics', count(*) FROM a_sales_metrics""")
def _(t):
    names = ("customers", "products", "orders", "order_items", "jobs", "sales_metrics")
    return relational.table_counts({n: getattr(t, n) for n in names})


@query("workflow_counts", f"""
    SELECT 'Raw data' AS stage, (SELECT count(*) FROM a_customers) + (SELECT count(*) FROM a_products)
        + (SELECT count(*) FROM a_orders) + (SELECT count(*) FROM a_order_items) AS record_count
    UNION ALL SELECT 'Metrics', (SELECT count(*) FROM a_sales_metrics)
    UNION ALL SELECT 'Jobs', (SELECT count(*) FROM a_jobs WHERE status = 'COMPLETED')""")
def _(t):
    return relational.stage_counts(
        {
            "Raw data": [t.customers, t.products, t.orders, t.order_items],
            "Metrics": [t.sales_metrics],
            "Jobs": [t.jobs.filter(F.col("status") == "COMPLETED")],
        }
    )


@query("latest_metric", """
    SELECT metric_id, metric_date, total_sales::DOUBLE AS total_sales, total_orders FROM a_sales_metrics
    ORDER BY metric_date DESC LIMIT 1""")
def _(t):
    return (
        t.sales_metrics.orderBy(F.col("metric_date").desc()).limit(1)
        .select("metric_id", "metric_date", dbl(F.col("total_sales")).alias("total_sales"), "total_orders")
    )


@query("active_customers", """
    SELECT customer_id, customer_name, email, phone, created_at FROM a_customers WHERE is_active""")
def _(t):
    df = t.customers.filter("is_active").select("customer_id", "customer_name", "email", "phone", "created_at")
    df.createOrReplaceTempView("active_customers")
    return t.spark.table("active_customers")


@query("compat_view", """
    SELECT order_id, customer_id, order_date, order_priority AS shipping_priority, order_priority FROM a_orders""")
def _(t):
    return relational.renamed_with_old(
        t.orders.select("order_id", "customer_id", "order_date", "order_priority"), "order_priority", "shipping_priority"
    )


@query("flag_switched_source", """
    SELECT customer_tier, count(*) AS customers, sum(lifetime_value)::DOUBLE AS lifetime_value
    FROM a_customers WHERE is_active GROUP BY 1""")
def _(t):
    source = relational.switched(
        relational.feature_flags(t.spark), "ACTIVE_ONLY_CUSTOMERS", "prod",
        on=lambda: t.customers.filter("is_active"), off=lambda: t.customers,
    )
    return source.groupBy("customer_tier").agg(
        F.count(F.lit(1)).alias("customers"), dbl(F.sum("lifetime_value")).alias("lifetime_value")
    )


# --- aggregates --------------------------------------------------------------

@query("agg_distinct_case", """
    SELECT date_trunc('month', o.order_date)::DATE AS month, count(DISTINCT o.customer_id) AS customers,
           count(DISTINCT CASE WHEN c.customer_tier = 'ENTERPRISE' THEN o.customer_id END) AS enterprise_customers
    FROM a_orders o JOIN a_customers c ON o.customer_id = c.customer_id GROUP BY 1""")
def _(t):
    pairs = t.orders.select(F.trunc("order_date", "month").alias("month"), "customer_id").distinct()
    return (
        pairs.join(t.customers.select("customer_id", "customer_tier"), "customer_id")
        .groupBy("month")
        .agg(
            F.count("customer_id").alias("customers"),
            F.count(F.when(F.col("customer_tier") == "ENTERPRISE", F.col("customer_id"))).alias("enterprise_customers"),
        )
    )


@query("agg_conditional_counts", """
    SELECT job_type, count(CASE WHEN status = 'RUNNING' THEN 1 END) AS running, count_if(status = 'FAILED')::BIGINT AS failed,
           sum(CASE WHEN status = 'COMPLETED' THEN 1 ELSE 0 END)::BIGINT AS completed FROM a_jobs GROUP BY 1""")
def _(t):
    return t.jobs.groupBy("job_type").agg(
        F.count(F.when(F.col("status") == "RUNNING", 1)).alias("running"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.sum(F.when(F.col("status") == "COMPLETED", 1).otherwise(0)).alias("completed"),
    )


@query("agg_basic", """
    SELECT status, coalesce(sum(total_amount), 0)::DOUBLE AS total, sum(total_amount)::DOUBLE / count(*) AS mean,
           min(total_amount)::DOUBLE AS low, max(total_amount)::DOUBLE AS high FROM a_orders GROUP BY 1""")
def _(t):
    amount = money(F.col("total_amount"))
    return t.orders.groupBy("status").agg(
        dbl(F.coalesce(F.sum(amount), F.lit(0))).alias("total"),
        mean(F.sum(amount), F.count(amount)).alias("mean"),
        dbl(F.min(amount)).alias("low"),
        dbl(F.max(amount)).alias("high"),
    )


@query("agg_sorted_distinct_array", """
    SELECT o.customer_id, string_agg(DISTINCT p.category, '|' ORDER BY p.category) AS categories,
           count(DISTINCT p.category) AS n FROM a_orders o
    JOIN a_order_items oi ON o.order_id = oi.order_id JOIN a_products p ON oi.product_id = p.product_id GROUP BY 1""")
def _(t):
    liked = views.customer_products(t.orders, t.order_items, t.products)
    return liked.select(
        "customer_id",
        F.array_join("preferred_categories", "|").alias("categories"),
        F.size("preferred_categories").cast("bigint").alias("n"),
    ).filter("n > 0")


@query("agg_mode", """
    SELECT user_id, event_type AS usual_event FROM (SELECT user_id, event_type,
        row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM a_events GROUP BY 1, 2) WHERE r = 1""")
def _(t):
    events = t.events.withColumn("one", F.lit(1))
    return views.most_frequent(events, "user_id", "event_type", "one", "usual_event")


@query("deployment_success_rate", """
    SELECT job_type, created_at::DATE AS date, count(*) AS total, count_if(status = 'COMPLETED')::BIGINT AS successful,
           count_if(status = 'COMPLETED')::DOUBLE / nullif(count(*), 0) * 100 AS success_rate
    FROM a_jobs GROUP BY 1, 2""")
def _(t):
    return relational.success_by_day(t.jobs, "job_type")


@query("activity_by_actor", """
    SELECT created_by AS actor, count(*) AS runs, max(created_at) AS last_run FROM a_jobs GROUP BY 1""")
def _(t):
    return t.jobs.groupBy(F.col("created_by").alias("actor")).agg(
        F.count(F.lit(1)).alias("runs"), F.max("created_at").alias("last_run")
    )


@query("task_performance", f"""
    SELECT 'Performance summary' AS summary_type, count(*) AS total_executions,
        sum(CASE WHEN status = 'COMPLETED' THEN 1 ELSE 0 END)::BIGINT AS successful_executions,
        sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END)::BIGINT AS failed_executions,
        sum(date_diff('second', created_at, updated_at))::DOUBLE / count(updated_at) AS avg_execution_seconds
    FROM a_jobs WHERE job_type IN ('REPORT', 'ANALYSIS', 'VALIDATION') AND created_at >= {NOW} - INTERVAL 7 DAY""")
def _(t):
    return relational.task_performance(t.jobs, JOBS_AS_OF)


# --- windows -----------------------------------------------------------------

@query("window_lag_growth", """
    WITH m AS (SELECT date_trunc('month', order_date)::DATE AS month, sum(total_amount) AS s FROM a_orders GROUP BY 1)
    SELECT month, s::DOUBLE AS revenue, (lag(s) OVER (ORDER BY month))::DOUBLE AS prev_month_revenue,
        (s - lag(s) OVER (ORDER BY month))::DOUBLE AS revenue_growth,
        round((s - lag(s) OVER (ORDER BY month))::DOUBLE / (lag(s) OVER (ORDER BY month))::DOUBLE * 100, 2) AS revenue_growth_pct FROM m""")
def _(t):
    monthly = t.orders.groupBy(F.trunc("order_date", "month").alias("month")).agg(
        F.sum(money(F.col("total_amount"))).alias("revenue")
    )
    return views.growth(monthly, "month", "revenue").withColumn("revenue", dbl(F.col("revenue")))


def _quantities(t):
    sums = t.order_items.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    return settle(t.products.select("product_id", "category").join(sums, "product_id", "left"))


@query("window_rank_global", """
    SELECT p.product_id, sum(quantity)::BIGINT AS quantity, rank() OVER (ORDER BY sum(quantity) DESC NULLS FIRST) AS quantity_rank
    FROM a_products p LEFT JOIN a_order_items oi ON p.product_id = oi.product_id GROUP BY 1""")
def _(t):
    return rank_desc(_quantities(t).select("product_id", "quantity"), "quantity", "quantity_rank")


@query("window_rank_category", """
    SELECT p.product_id, p.category, sum(quantity)::BIGINT AS quantity,
           rank() OVER (PARTITION BY p.category ORDER BY sum(quantity) DESC NULLS FIRST) AS category_rank
    FROM a_products p LEFT JOIN a_order_items oi ON p.product_id = oi.product_id GROUP BY 1, 2""")
def _(t):
    return rank_desc(_quantities(t), "quantity", "category_rank", ["category"])
