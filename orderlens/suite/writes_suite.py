"""Upserts, updates, deletes, change feeds and versioned writes on the given tables."""

from pyspark.sql import functions as F

from orderlens.functions import dbl, mean, money, ntz
from orderlens.operators import changes, partitioned, retention, upsert
from orderlens.plans import jobs as job_plans
from orderlens.session import run_dir
from orderlens.sources import ingest, versions
from orderlens.suite.registry import JOBS_AS_OF, query

NOW = f"TIMESTAMP '{JOBS_AS_OF}'"


def order_columns(df):
    return df.select("order_id", "customer_id", "order_date", dbl(F.col("total_amount")).alias("total_amount"), "status")


_ORDER = "order_id, customer_id, order_date, total_amount::DOUBLE AS total_amount, status"


@query("incremental_pull", f"""
    WITH loaded AS (SELECT order_id, order_date FROM a_orders WHERE order_date <= DATE '2001-01-01' AND order_id % 2 = 0)
    SELECT {_ORDER} FROM a_orders WHERE order_date >= (SELECT max(order_date) FROM loaded) AND order_id NOT IN (SELECT order_id FROM loaded)""")
def _(t):
    """Orders that share their date with the mark arrive after it was set."""
    loaded = t.orders.filter((F.col("order_date") <= ntz("2001-01-01")) & (F.col("order_id") % 2 == 0))
    return order_columns(ingest.incremental_pull(t.orders, loaded, "order_date", ["order_id"]))


@query("append_insert", """
    SELECT metric_id, metric_date, total_sales::DOUBLE AS total_sales, total_orders, unique_customers, 'none' AS top_product FROM a_sales_metrics
    UNION ALL SELECT 'CAT_' || category, DATE '2001-08-02', sum(price)::DOUBLE, count(*), 0, 'none' FROM a_products GROUP BY category""")
def _(t):
    table = t.sales_metrics.select(
        "metric_id", "metric_date", "total_sales", "total_orders", "unique_customers", F.lit("none").alias("top_product")
    )
    rows = t.products.groupBy("category").agg(
        F.sum("price").alias("total_sales"), F.count(F.lit(1)).alias("total_orders")
    ).select(
        F.concat(F.lit("CAT_"), F.col("category")).alias("metric_id"),
        F.lit("2001-08-02").cast("date").alias("metric_date"), "total_sales", "total_orders",
    )
    defaults = {"unique_customers": F.lit(0), "top_product": F.lit("none")}
    return upsert.append(table, rows, defaults).withColumn("total_sales", dbl(F.col("total_sales")))


@query("insert_select_metrics", """
    SELECT metric_date, total_sales::DOUBLE AS total_revenue, total_orders, unique_customers AS total_customers,
           total_sales::DOUBLE / total_orders AS avg_order_value FROM a_sales_metrics
    UNION ALL SELECT DATE '2001-08-02', sum(total_amount)::DOUBLE, count(*), count(DISTINCT customer_id), sum(total_amount)::DOUBLE / count(*)
    FROM a_orders WHERE status = 'PENDING'""")
def _(t):
    table = t.sales_metrics.select(
        "metric_date", F.col("total_sales").cast("decimal(28,2)").alias("total_revenue"), "total_orders",
        F.col("unique_customers").alias("total_customers"), mean(F.col("total_sales"), F.col("total_orders")).alias("avg_order_value"),
    )
    per_customer = t.orders.filter(F.col("status") == "PENDING").groupBy("customer_id").agg(
        F.sum(money(F.col("total_amount"))).alias("amount"), F.count(F.lit(1)).alias("n")
    )
    row = per_customer.agg(
        F.lit("2001-08-02").cast("date").alias("metric_date"), F.sum("amount").alias("total_revenue"),
        F.sum("n").alias("total_orders"), F.count("customer_id").alias("total_customers"),
        mean(F.sum("amount"), F.sum("n")).alias("avg_order_value"),
    )
    return upsert.append(table, row).withColumn("total_revenue", dbl(F.col("total_revenue")))


# Older and newer copies of the orders, both derived from the whole table: the older
# one lacks the last year and has urgent orders still pending, the newer one has lost
# the first year.
def _older(t):
    urgent = F.col("order_priority") == "1-URGENT"
    return t.orders.filter(F.col("order_date") < ntz("2001-01-01")).select(
        "order_id", "customer_id", "order_date", "total_amount",
        F.when(urgent, "PENDING").otherwise(F.col("status")).alias("status"),
    )


def _newer(t):
    return t.orders.filter(F.col("order_date") >= ntz("1996-01-01")).select(
        "order_id", "customer_id", "order_date", "total_amount", "status"
    )


_OLDER = """older AS (SELECT order_id, customer_id, order_date, total_amount,
        CASE WHEN order_priority = '1-URGENT' THEN 'PENDING' ELSE status END AS status FROM a_orders WHERE order_date < DATE '2001-01-01')"""
_NEWER = """newer AS (SELECT order_id, customer_id, order_date, total_amount, status FROM a_orders WHERE order_date >= DATE '1996-01-01')"""


@query("merge_upsert", f"""
    WITH {_OLDER}, {_NEWER}
    SELECT {_ORDER} FROM newer UNION ALL SELECT {_ORDER} FROM older WHERE order_id NOT IN (SELECT order_id FROM newer)""")
def _(t):
    return order_columns(upsert.upsert(_older(t), _newer(t), ["order_id"]))


def _latest_sql(kind, where="TRUE"):
    return f"""SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS seen FROM a_events
        WHERE event_type = '{kind}' AND user_id IS NOT NULL AND {where} GROUP BY 1"""


_MERGE_GROUPS = (3, 7)


def _latest(t, kind):
    """The last event of a kind of each user, in sixteen groups of users."""
    last = t.events.filter((F.col("event_type") == kind) & F.col("user_id").isNotNull()).groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("e"))
    return last.select("user_id", F.col("e.event_id").alias("event_id"), F.col("e.ts").alias("seen"), (F.col("user_id") % 16).cast("int").alias("user_group"))


def _merged_if_newer(t):
    """Last views, partitioned, after a MERGE of the last clicks of two groups that takes only what is newer."""
    path = run_dir(t.spark, "last_seen")
    schema = partitioned.create(_latest(t, "view"), path, "user_group")
    files = lambda: partitioned.load(t.spark, path, schema).select("user_group", F.input_file_name().alias("file")).distinct()
    before = run_dir(t.spark, "files_before")
    files().write.parquet(before)
    clicks = _latest(t, "click").filter(F.col("user_group").isin(*_MERGE_GROUPS))
    partitioned.merge(t.spark, path, schema, clicks, ["user_id"], "user_group", when=lambda old, new: new("seen") > old("seen"))
    return partitioned.load(t.spark, path, schema), t.spark.read.parquet(before), files()


@query("merge_if_newer", f"""
    WITH v AS ({_latest_sql("view")}), c AS ({_latest_sql("click", f"user_id % 16 IN {_MERGE_GROUPS}")})
    SELECT coalesce(v.user_id, c.user_id) AS user_id, CASE WHEN v.seen IS NULL OR c.seen > v.seen THEN c.event_id ELSE v.event_id END AS event_id,
        CASE WHEN v.seen IS NULL OR c.seen > v.seen THEN c.seen ELSE v.seen END AS seen FROM v FULL JOIN c ON v.user_id = c.user_id""")
def _(t):
    return _merged_if_newer(t)[0].select("user_id", "event_id", "seen")


@query("merge_partitions_rewritten", f"""
    SELECT (user_id % 16)::INTEGER AS user_group, bool_or(user_id % 16 IN {_MERGE_GROUPS}) AS rewritten FROM ({_latest_sql("view")}) GROUP BY 1""")
def _(t):
    """Whether a group's files changed in the MERGE: those of groups without a source row did not."""
    _, before, after = _merged_if_newer(t)
    kept = after.join(before.withColumn("same", F.lit(True)), ["user_group", "file"], "left")
    return kept.groupBy("user_group").agg(F.max(F.col("same").isNull()).alias("rewritten"))


@query("merge_accumulate", """
    WITH urgent AS (SELECT 'SM_' || strftime(order_date, '%Y%m%d') AS metric_id, sum(total_amount) AS s, count(*) AS n FROM a_orders WHERE order_priority = '1-URGENT' GROUP BY 1),
    base AS (SELECT 'SM_' || strftime(order_date, '%Y%m%d') AS metric_id, sum(total_amount) AS s, count(*) AS n FROM a_orders WHERE order_priority <> '1-URGENT' GROUP BY 1)
    SELECT coalesce(b.metric_id, u.metric_id) AS metric_id, (coalesce(b.s, 0) + coalesce(u.s, 0))::DOUBLE AS total_sales,
           (coalesce(b.n, 0) + coalesce(u.n, 0))::BIGINT AS total_orders FROM base b FULL JOIN urgent u ON b.metric_id = u.metric_id""")
def _(t):
    def by_day(df):
        return df.groupBy(F.concat(F.lit("SM_"), F.date_format("order_date", "yyyyMMdd")).alias("metric_id")).agg(
            F.sum(money(F.col("total_amount"))).alias("total_sales"), F.count(F.lit(1)).alias("total_orders")
        )

    late = F.col("order_priority") == "1-URGENT"
    merged = upsert.upsert(
        by_day(t.orders.filter(~late)), by_day(t.orders.filter(late)), ["metric_id"],
        update={
            "total_sales": lambda old, new: old("total_sales") + new("total_sales"),
            "total_orders": lambda old, new: old("total_orders") + new("total_orders"),
        },
        check_source=False,
    )
    return merged.withColumn("total_sales", dbl(F.col("total_sales")))


@query("job_status_update", f"""
    WITH u AS (SELECT error_id, task_name, severity FROM a_task_errors WHERE error_category = 'JOB_PROCESSING')
    SELECT job_id, CASE WHEN u.error_id IS NULL THEN status ELSE 'COMPLETED' END AS status,
        CASE WHEN u.error_id IS NULL THEN error_message WHEN severity = 'CRITICAL' THEN 'see log' END AS error_message,
        CASE WHEN u.error_id IS NULL THEN 'default.json' WHEN severity = 'MEDIUM' THEN 'default.json' ELSE task_name END AS output_location,
        CASE WHEN u.error_id IS NULL THEN updated_at ELSE {NOW} END AS updated_at
    FROM a_jobs LEFT JOIN u ON job_id = error_id""")
def _(t):
    jobs = t.jobs.withColumn("output_location", F.lit("default.json"))
    updates = t.task_errors.filter(F.col("error_category") == "JOB_PROCESSING").select(
        F.col("error_id").alias("job_id"),
        F.lit("COMPLETED").alias("status"),
        F.when(F.col("severity") != "MEDIUM", F.col("task_name")).alias("output_location"),
        F.when(F.col("severity") == "CRITICAL", "see log").alias("error_message"),
        F.lit(None).cast("decimal(10,2)").alias("execution_time_seconds"),
    )
    return job_plans.update_status(jobs, updates, JOBS_AS_OF).select(
        "job_id", "status", "error_message", "output_location", "updated_at"
    )


_RETRY = f"status = 'FAILED' AND retry_count < max_retries AND updated_at < {NOW} - INTERVAL 10 MINUTE"


@query("job_retry_update", f"""
    SELECT job_id, CASE WHEN {_RETRY} THEN 'PENDING' ELSE status END AS status,
        CASE WHEN {_RETRY} THEN retry_count + 1 ELSE retry_count END AS retry_count,
        CASE WHEN {_RETRY} THEN {NOW} ELSE updated_at END AS updated_at,
        CASE WHEN {_RETRY} THEN NULL ELSE error_message END AS error_message FROM a_jobs""")
def _(t):
    return job_plans.retry_failed(t.jobs, JOBS_AS_OF).select("job_id", "status", "retry_count", "updated_at", "error_message")


@query("job_cleanup", f"""
    SELECT job_id, status, created_at FROM a_jobs WHERE NOT (status = 'COMPLETED' AND created_at < {NOW} - INTERVAL 10 DAY)""")
def _(t):
    # Published retention is 30 days; the bundled jobs cover 30 days, so 10 here.
    return job_plans.cleanup(t.jobs, JOBS_AS_OF, days=10).select("job_id", "status", "created_at")


_KEEP = {"api_calls": "call_timestamp", "system_metrics": "metric_timestamp", "task_errors": "error_timestamp",
         "quality_checks": "check_timestamp", "audit_log": "event_timestamp"}
_RETENTION = " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, count(*) FILTER ({c} < {NOW} - INTERVAL 7 DAY{' AND resolved' if n == 'task_errors' else ''}) AS deleted_rows,
        count(*) FILTER (NOT ({c} < {NOW} - INTERVAL 7 DAY{' AND resolved' if n == 'task_errors' else ''})) AS kept_rows FROM a_{n}"""
    for n, c in _KEEP.items()
)


def _expired(name):
    expired = F.col(_KEEP[name]) < ntz(JOBS_AS_OF) - F.expr("interval 7 days")
    return expired & F.col("resolved") if name == "task_errors" else expired


@query("retention_tables", " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, {c} AS at FROM a_{n}
        WHERE ({c} < {NOW} - INTERVAL 7 DAY{' AND resolved' if n == 'task_errors' else ''}) IS NOT TRUE"""
    for n, c in _KEEP.items()
))
def _(t):
    """The five tables as they are after the deletes, read back from their new snapshots."""
    rows = None
    for name, ts in _KEEP.items():
        path, _ = retention.rewrite(getattr(t, name), _expired(name), run_dir(t.spark, f"kept_{name}"))
        part = t.spark.read.parquet(path).select(F.lit(name).alias("table_name"), F.col(ts).alias("at"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query("retention_partitions", " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, day, d AS deleted_rows, k AS kept_rows, CASE WHEN d = 0 THEN 'untouched' WHEN k = 0 THEN 'dropped' ELSE 'rewritten' END AS files
        FROM (SELECT {c}::DATE AS day, count(*) FILTER ({e}) AS d, count(*) FILTER (({e}) IS NOT TRUE) AS k FROM a_{n} GROUP BY 1)"""
    for n, c, e in ((n, c, f"{c} < {NOW} - INTERVAL 7 DAY" + (" AND resolved" if n == "task_errors" else "")) for n, c in _KEEP.items())
))
def _(t):
    """The five tables by day: expired days are dropped, days that lose some rows rewritten, the others left alone."""
    rows = None
    for name, ts in _KEEP.items():
        path = run_dir(t.spark, f"daily_{name}")
        schema = partitioned.create(getattr(t, name).withColumn("day", F.to_date(ts)), path, "day")
        report = partitioned.delete(t.spark, path, schema, _expired(name), "day").withColumn("table_name", F.lit(name))
        rows = report if rows is None else rows.unionByName(report)
    return rows.select("table_name", "day", "deleted_rows", "kept_rows", "files")


@query("retention_cleanup", f"""
    WITH r AS ({_RETENTION}) SELECT * FROM r
    UNION ALL SELECT 'TOTAL', sum(deleted_rows)::BIGINT, sum(kept_rows)::BIGINT FROM r""")
def _(t):
    tables = {name: (getattr(t, name), _expired(name)) for name in _KEEP}
    return retention.retention_report(tables)


@query("archive_split", f"""
    SELECT CASE WHEN metric_timestamp < {NOW} - INTERVAL 15 DAY THEN 'archived' ELSE 'kept' END AS part, metric_id, metric_timestamp FROM a_system_metrics""")
def _(t):
    gone, kept = retention.split_where(
        t.system_metrics, F.col("metric_timestamp") < ntz(JOBS_AS_OF) - F.expr("interval 15 days")
    )
    both = gone.withColumn("part", F.lit("archived")).unionByName(kept.withColumn("part", F.lit("kept")))
    return both.select("part", "metric_id", "metric_timestamp")


@query("archive_delete", f"""
    SELECT CASE WHEN metric_timestamp < {NOW} - INTERVAL 15 DAY THEN 'archive' ELSE 'table' END AS place, metric_id, metric_timestamp FROM a_system_metrics""")
def _(t):
    """Both snapshots of an archive-then-delete run, read back."""
    expired = F.col("metric_timestamp") < ntz(JOBS_AS_OF) - F.expr("interval 15 days")
    kept, archived = retention.rewrite(
        t.system_metrics, expired, run_dir(t.spark, "metrics_kept"), run_dir(t.spark, "metrics_archive"))
    parts = [t.spark.read.parquet(p).withColumn("place", F.lit(k)) for k, p in (("table", kept), ("archive", archived))]
    return parts[0].unionByName(parts[1]).select("place", "metric_id", "metric_timestamp")


@query("snapshot_write", """
    SELECT customer_tier, count(*) AS customers, sum(lifetime_value)::DOUBLE AS lifetime_value FROM a_customers GROUP BY 1""")
def _(t):
    path = versions.write_snapshot(
        t.customers.select("customer_id", "customer_tier", "lifetime_value"), run_dir(t.spark, "customers_snapshot"), sort_by=["customer_tier"])
    return t.spark.read.parquet(path).groupBy("customer_tier").agg(
        F.count(F.lit(1)).alias("customers"), dbl(F.sum("lifetime_value")).alias("lifetime_value")
    )


# --- change feeds ------------------------------------------------------------

_FEED = f"""
    SELECT {{cols}}, 'DELETE' AS action, n.order_id IS NOT NULL AS is_update, md5(o.order_id::VARCHAR) AS row_id
    FROM older o LEFT JOIN newer n ON o.order_id = n.order_id WHERE n.order_id IS NULL OR o.status <> n.status
    UNION ALL
    SELECT {{ncols}}, 'INSERT', o.order_id IS NOT NULL, md5(n.order_id::VARCHAR)
    FROM newer n LEFT JOIN older o ON o.order_id = n.order_id WHERE o.order_id IS NULL OR o.status <> n.status"""


def _side(a):
    return f"{a}.order_id, {a}.customer_id, {a}.order_date, {a}.total_amount::DOUBLE AS total_amount, {a}.status"


@query("change_feed", f"WITH {_OLDER}, {_NEWER} " + _FEED.format(cols=_side("o"), ncols=_side("n")))
def _(t):
    feed = changes.change_feed(_older(t), _newer(t), ["order_id"])
    return feed.withColumn("total_amount", dbl(F.col("total_amount")))


@query("pending_job_feed", f"""
    SELECT job_id, job_type, priority, created_at FROM a_jobs
    WHERE status = 'PENDING' AND (created_at >= TIMESTAMP '2024-01-20' OR job_id % 3 = 0)""")
def _(t):
    """Of the older jobs, every third pending one had failed before a retry set it back."""
    retried = (F.col("status") == "PENDING") & (F.col("job_id") % 3 == 0)
    before = t.jobs.filter(F.col("created_at") < ntz("2024-01-20")).withColumn("status", F.when(retried, "FAILED").otherwise(F.col("status")))
    columns = ["job_id", "job_type", "status", "priority", "created_at"]
    feed = changes.change_feed(before.select(*columns), t.jobs.select(*columns), ["job_id"])
    return job_plans.pending_inserts(feed).select("job_id", "job_type", "priority", "created_at")
