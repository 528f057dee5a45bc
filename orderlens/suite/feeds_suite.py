"""Change feeds in folders: what a consumer has left to do, health over it, forced processing."""

from pyspark.sql import functions as F

from orderlens.functions import ntz
from orderlens.operators import changes
from orderlens.plans import quality
from orderlens.session import run_dir
from orderlens.streaming import feeds
from orderlens.suite.registry import JOBS_AS_OF, query

NOW = f"TIMESTAMP '{JOBS_AS_OF}'"
#: The orders feed holds two publications; its consumer has finished the first.
FIRST, SECOND = "2000-01-01", "2001-01-01"


def _orders(t, before):
    return t.orders.filter(F.col("order_date") < ntz(before)).select("order_id", "customer_id", "order_date", "total_amount", "status")


def _keep(t, name):
    """A handler that stores each batch in a folder of its own."""
    target = run_dir(t.spark, f"feed_{name}_applied")

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return store


def published(t):
    """Feeds from snapshots of four tables; the jobs are consumed in full, the orders in part.

    Customers without an e-mail get a placeholder, products below zero go, orders arrive by
    date and jobs by time.
    """
    mail = F.coalesce("email", F.concat(F.lit("missing-"), F.col("customer_id").cast("string")))
    customers = t.customers.select("customer_id", "email", "customer_tier")
    products = t.products.select("product_id", "price")
    jobs = t.jobs.select("job_id", "status", "created_at")
    feed = {
        "customers": changes.change_feed(customers, customers.withColumn("email", mail), ["customer_id"]),
        "products": changes.change_feed(products, products.filter("price >= 1000 OR price IS NULL"), ["product_id"]),
        "orders": changes.change_feed(_orders(t, FIRST), _orders(t, SECOND), ["order_id"]),
        "jobs": changes.change_feed(jobs.filter(F.col("created_at") < ntz(JOBS_AS_OF) - F.expr("interval 1 day")), jobs, ["job_id"]),
    }
    out = [feeds.publish(rows, name, run_dir(t.spark, f"feed_{name}"), run_dir(t.spark, f"consumer_{name}")) for name, rows in feed.items()]
    for f in out[2:]:
        feeds.consume(t.spark, f, _keep(t, f.name))
    later = changes.change_feed(_orders(t, SECOND), t.orders.select(*_orders(t, SECOND).columns), ["order_id"])
    feeds.publish(later, "orders", out[2].folder, out[2].consumer)
    return out


_FEEDS = f"""
    SELECT 'customers' AS feed, 2 * count(*) AS pending_changes FROM a_customers WHERE email IS NULL
    UNION ALL SELECT 'products', count(*) FROM a_products WHERE price < 1000
    UNION ALL SELECT 'orders', count(*) FROM a_orders WHERE order_date >= DATE '{SECOND}'
    UNION ALL SELECT 'jobs', 0"""


@query("feed_status", f"SELECT *, CASE WHEN pending_changes > 0 THEN 'HAS_DATA' ELSE 'UP_TO_DATE' END AS state FROM ({_FEEDS})")
def _(t):
    return feeds.status(t.spark, published(t))


@query("pipeline_health", f"""
    WITH e AS (SELECT count(*) AS error_count FROM a_task_errors WHERE error_timestamp >= {NOW} - INTERVAL 1 HOUR
               AND error_category = 'DATA_PIPELINE' AND NOT resolved),
    f AS (SELECT count(*) FILTER (pending_changes > 0) AS streams_with_data FROM ({_FEEDS})),
    h AS (SELECT CASE WHEN error_count = 0 THEN 'HEALTHY' WHEN error_count <= 3 THEN 'WARNING' ELSE 'UNHEALTHY' END AS health_status, * FROM e, f)
    SELECT *, CASE health_status WHEN 'HEALTHY' THEN 1.0 WHEN 'WARNING' THEN 0.5 ELSE 0.0 END::DOUBLE AS metric_value,
        '{{"health_status":"' || health_status || '","error_count":' || error_count || ',"streams_with_data":' || streams_with_data || '}}' AS tags,
        'Pipeline Health: ' || health_status || ' | Recent Errors: ' || error_count || ' | Streams with Data: ' || streams_with_data AS summary FROM h""")
def _(t):
    return quality.pipeline_health(t.task_errors, feeds.status(t.spark, published(t)), JOBS_AS_OF)


def _forced(t):
    known = published(t)
    return feeds.force_processing(t.spark, known, {f.name: _keep(t, f.name) for f in known})


@query("force_processing_feeds", f"SELECT feed, pending_changes AS pending_before, 0::BIGINT AS pending_after FROM ({_FEEDS})")
def _(t):
    return _forced(t).drop("place")


@query("force_processing_summary", f"""
    SELECT coalesce('Forced processing completed for: ' || string_agg(feed, ', ' ORDER BY o), 'No pending data found in streams. Nothing to process.') AS summary
    FROM (SELECT *, row_number() OVER () AS o FROM ({_FEEDS})) WHERE pending_changes > 0""")
def _(t):
    return feeds.summary(_forced(t))
