"""Ingestion, change capture and event-time operators on the given tables."""

from pyspark.sql import functions as F

from orderlens.functions import dbl, mean, ntz
from orderlens.operators.timeline import asof_latest
from orderlens.plans import metrics
from orderlens.session import run_dir
from orderlens.sources import ingest
from orderlens.streaming import consume, keyed, limits, windows
from orderlens.streaming.source import event_stream, file_stream, run_available
from orderlens.suite.registry import ORDERS_AS_OF, query

# --- ingestion ---------------------------------------------------------------

_CSV = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def _event_lines(t):
    """Events as text lines; error events carry a value that is not a number."""
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return t.events.select(F.concat_ws(",", F.col("event_id").cast("string"), stamp, F.coalesce(F.col("user_id").cast("string"), F.lit("")), "event_type", value).alias("line"))


@query("csv_ingest_quarantine", """
    SELECT CASE WHEN event_type = 'error' THEN 'quarantine' ELSE 'good' END AS outcome, event_type, count(*) AS n,
           sum(CASE WHEN event_type <> 'error' THEN value END)::DOUBLE AS total_value FROM a_events GROUP BY 1, 2""")
def _(t):
    root = run_dir(t.spark, "csv")
    _event_lines(t).write.text(f"{root}/in")
    stream = ingest.csv_stream(t.spark, f"{root}/in", _CSV, pattern="*.txt")
    ingest.land(stream, f"{root}/out", f"{root}/checkpoint")
    rows = ingest.landed(t.spark, f"{root}/out", _CSV)
    kind = F.coalesce(F.col("event_type"), F.split(ingest.CORRUPT, ",")[3])
    return rows.groupBy("outcome", kind.alias("event_type")).agg(
        F.count(F.lit(1)).alias("n"), dbl(F.sum(F.col("value").cast("decimal(12,2)"))).alias("total_value")
    )


@query("metadata_ingest", """
    SELECT 'raw_customers' AS table_name, 'good' AS outcome, count(*) AS n FROM customer
    UNION ALL SELECT 'raw_events', 'good', count(*) FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 'raw_events', 'quarantine', count(*) FROM events WHERE event_type = 'error'""")
def _(t):
    root = run_dir(t.spark, "pipes")
    _event_lines(t).write.text(f"{root}/events")
    t.base("customer").write.json(f"{root}/customers")
    pipes = [
        ingest.Pipe("events_pipe", f"{root}/events", "raw_events", "csv", _CSV, "*.txt"),
        ingest.Pipe("customers_pipe", f"{root}/customers", "raw_customers", "json", "c_custkey bigint, c_name string, c_acctbal double", "*.json"),
    ]
    out = None
    for name, df in ingest.run_pipes(t.spark, pipes, f"{root}/tables").items():
        rows = df.groupBy("outcome").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        out = rows if out is None else out.unionByName(rows)
    return out


_PROBLEM = """CASE WHEN event_type NOT IN ('click', 'signup', 'view', 'purchase', 'error') THEN 'unknown event type'
    WHEN k IS NULL THEN 'payload lacks k' WHEN value <= 0 OR value > 100 THEN 'value out of range' END"""


@query("event_source_validate", f"SELECT event_id, user_id, event_type, value::DOUBLE AS value, k, {_PROBLEM} AS problem FROM a_events")
def _(t):
    log = t.events.select(
        F.col("user_id").cast("string").alias("key"), F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props")).alias("value")
    )
    schema = "event_id bigint, user_id bigint, event_type string, value decimal(12,2), props string"
    rows = ingest.from_log(log, schema)
    return rows.select("event_id", "user_id", "event_type", dbl(F.col("value")).alias("value"), "k", "problem")


@query("event_dead_letter", f"""
    SELECT CASE WHEN problem IS NULL THEN 'accepted' ELSE 'dead_letter' END AS route, coalesce(problem, '') AS problem, event_type, count(*) AS n
    FROM (SELECT *, {_PROBLEM} AS problem FROM a_events) GROUP BY 1, 2, 3""")
def _(t):
    root = run_dir(t.spark, "dead_letter")
    checked = ingest.validate(event_stream(t.spark, t.folder))
    routed = checked.withColumn("route", F.when(F.col("problem").isNull(), "accepted").otherwise("dead_letter"))
    run_available(
        routed.writeStream.format("parquet").partitionBy("route").option("path", f"{root}/out"), f"{root}/checkpoint"
    )
    back = t.spark.read.parquet(f"{root}/out")
    return back.groupBy("route", F.coalesce("problem", F.lit("")).alias("problem"), "event_type").agg(F.count(F.lit(1)).alias("n"))


# --- change capture ----------------------------------------------------------

@query("stream_consume_once", """
    SELECT 'first_run' AS run, count(*) AS n FROM events UNION ALL SELECT 'second_run', 0
    UNION ALL SELECT 'copy', count(*) FROM events""")
def _(t):
    root = run_dir(t.spark, "consume")
    source = lambda: event_stream(t.spark, t.folder)
    consume.consume(source(), f"{root}/a", f"{root}/checkpoint_a")
    consume.consume(source(), f"{root}/a2", f"{root}/checkpoint_a")
    consume.consume(source(), f"{root}/b", f"{root}/checkpoint_b")
    out = None
    schema = t.base("events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("value", F.col("value").cast("decimal(12,2)")).schema
    for run, folder in (("first_run", "a"), ("second_run", "a2"), ("copy", "b")):
        row = t.spark.read.schema(schema).parquet(f"{root}/{folder}").agg(F.lit(run).alias("run"), F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


def _event_rows(df):
    return df.select("event_id", "user_id", "event_type", dbl(F.col("value")).alias("value"))


@query("event_dedup", "SELECT event_id, user_id, event_type, value::DOUBLE AS value FROM a_events")
def _(t):
    copies = t.events.filter(F.col("event_type").isin("purchase", "error"))
    return _event_rows(t.events.unionByName(copies).dropDuplicates(["event_id"]))


@query("event_dedup_stream", "SELECT event_id, user_id, event_type, value::DOUBLE AS value FROM a_events")
def _(t):
    root = run_dir(t.spark, "dedup")
    twice = t.base("events").unionByName(t.base("events").filter(F.col("event_type").isin("purchase", "error")))
    twice.write.parquet(f"{root}/events.parquet")
    consume.dedup(event_stream(t.spark, root, 1), f"{root}/out", f"{root}/checkpoint")
    return _event_rows(t.spark.read.parquet(f"{root}/out"))


def _tumbling_sql(minutes):
    return f"""
    SELECT time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS events,
           sum(value)::DOUBLE AS total_value, sum(value)::DOUBLE / count(*) AS mean_value FROM a_events GROUP BY 1, 2"""


@query("tumbling_5m", _tumbling_sql(5))
def _(t):
    return windows.tumbling(t.events, 5)


@query("tumbling_15m", _tumbling_sql(15))
def _(t):
    return windows.tumbling(t.events, 15)


@query("sliding_30m_5m", """
    WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') - to_minutes(5 * i) AS window_start, event_type, value
        FROM a_events, range(6) r(i))
    SELECT window_start, event_type, count(*) AS events, sum(value)::DOUBLE AS total_value, sum(value)::DOUBLE / count(*) AS mean_value FROM w GROUP BY 1, 2""")
def _(t):
    return windows.sliding(t.events, 30, 5)


_MARKED = """m AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no
    FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM a_events))"""


@query("session_30m", f"""
    WITH {_MARKED} SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events,
        sum(value)::DOUBLE AS total_value FROM m GROUP BY user_id, session_no""")
def _(t):
    return windows.session_totals(t.events)


@query("event_pattern", f"""
    WITH {_MARKED},
    v AS (SELECT user_id, session_no, arg_min(ts, (ts, event_id)) AS opened_at, min((ts, event_id)) AS o FROM m WHERE event_type = 'view' GROUP BY 1, 2),
    p AS (SELECT user_id, session_no, arg_max(ts, (ts, event_id)) AS closed_at, max((ts, event_id)) AS c FROM m WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT v.user_id, v.session_no::BIGINT AS session_no, opened_at, closed_at FROM v JOIN p ON v.user_id = p.user_id AND v.session_no = p.session_no
    WHERE EXISTS (SELECT 1 FROM m WHERE m.user_id = v.user_id AND m.session_no = v.session_no AND m.event_type = 'click'
        AND (m.ts, m.event_id) > o AND (m.ts, m.event_id) < c)""")
def _(t):
    # One month of sparse events: sessions of 30 minutes would rarely hold three kinds.
    return windows.pattern_sessions(t.events, "view", "click", "purchase")


@query("event_pattern_day", """
    WITH g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM a_events),
    m AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 12 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM g),
    v AS (SELECT user_id, session_no, min(ts) AS opened_at FROM m WHERE event_type = 'view' GROUP BY 1, 2),
    p AS (SELECT user_id, session_no, max(ts) AS closed_at FROM m WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT v.user_id, v.session_no::BIGINT AS session_no, opened_at, closed_at FROM v JOIN p ON v.user_id = p.user_id AND v.session_no = p.session_no
    WHERE EXISTS (SELECT 1 FROM m WHERE m.user_id = v.user_id AND m.session_no = v.session_no AND m.event_type = 'click' AND m.ts > opened_at AND m.ts < closed_at)""")
def _(t):
    return windows.pattern_sessions(t.events, "view", "click", "purchase", gap_minutes=720)


def closing(t):
    """An event behind all others that only moves the watermark."""
    at = t.base("events").agg(F.max("event_id").alias("e"), F.max("ts").alias("t"))
    return at.select(
        (F.col("e") + 1).alias("event_id"), (F.col("t") + F.expr("interval 400 days")).alias("ts"), F.lit(None).cast("bigint").alias("user_id"),
        F.lit(keyed.CLOSING).alias("event_type"), F.lit(0.0).alias("value"), F.lit("{}").alias("props"))


def replayed(t, make, name):
    """The events in two arrivals and the closing one, through ``make`` (stream to stream) into a folder, read back."""
    root, early = run_dir(t.spark, name), F.col("ts") < ntz("2024-01-15")
    base = t.base("events")
    with keyed.rocksdb(t.spark):
        for part in (base.filter(early), base.filter(~early), closing(t)):
            part.write.mode("append").parquet(f"{root}/events.parquet")
            out = make(event_stream(t.spark, root))
            run_available(out.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint")
    return t.spark.read.schema(out.schema).parquet(f"{root}/out")


@query("session_stream_state", f"""
    WITH {_MARKED} SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events,
        sum(value)::DOUBLE AS total_value FROM m GROUP BY user_id, session_no""")
def _(t):
    return keyed.session_totals(replayed(t, lambda events: keyed.open_sessions(events, 30, "10 minutes"), "sessions"))


@query("event_pattern_stream", """
    WITH g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM a_events),
    m AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 12 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM g),
    v AS (SELECT user_id, session_no, min(ts) AS opened_at FROM m WHERE event_type = 'view' GROUP BY 1, 2),
    p AS (SELECT user_id, session_no, max(ts) AS closed_at FROM m WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT v.user_id, opened_at, closed_at FROM v JOIN p ON v.user_id = p.user_id AND v.session_no = p.session_no
    WHERE EXISTS (SELECT 1 FROM m WHERE m.user_id = v.user_id AND m.session_no = v.session_no AND m.event_type = 'click' AND m.ts > opened_at AND m.ts < closed_at)""")
def _(t):
    return keyed.pattern_sessions(replayed(t, lambda events: keyed.open_sessions(events, 720, "10 minutes"), "patterns"))


@query("late_event_split", """
    WITH b AS (SELECT max(ts) AS newest FROM a_events WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'signup')
    SELECT CASE WHEN (event_type = 'signup' OR ts >= TIMESTAMP '2024-01-20') AND ts < newest - INTERVAL 10 MINUTE THEN 'late' ELSE 'on_time' END AS outcome,
        event_type, count(*) AS n FROM a_events, b GROUP BY 1, 2""")
def _(t):
    root = run_dir(t.spark, "late")
    first = (F.col("ts") < ntz("2024-01-20")) & (F.col("event_type") != "signup")
    mark = None
    for part in (t.base("events").filter(first), t.base("events").filter(~first)):
        part.write.mode("append").parquet(f"{root}/events.parquet")
        consume.split_late(event_stream(t.spark, root, 1), f"{root}/out", f"{root}/checkpoint", mark)
        mark = consume.newest(t.spark, f"{root}/out")
    return t.spark.read.parquet(f"{root}/out").groupBy("outcome", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_upsert_metrics", """
    SELECT ts::DATE AS metric_date, event_type, count(*) AS events, sum(value)::DOUBLE AS total_value FROM a_events GROUP BY 1, 2""")
def _(t):
    root = run_dir(t.spark, "metrics")
    keys = ["metric_date", "event_type"]
    stream = event_stream(t.spark, t.folder).withColumn("metric_date", F.to_date("ts"))
    consume.upsert_metrics(
        stream, keys, {"events": F.count(F.lit(1)), "total_value": F.sum("value")}, f"{root}/out", f"{root}/checkpoint"
    )
    table = consume.read_metrics(t.spark, f"{root}/out", keys, ["events", "total_value"])
    return table.withColumn("total_value", dbl(F.col("total_value")))


_FRESH = "ship_date >= DATE '2001-07-25'"


@query("order_items_refresh", f"""
    SELECT count(*) AS changes, count(DISTINCT product_id) AS products_refreshed,
        (SELECT count(DISTINCT o.customer_id) FROM a_orders o JOIN a_order_items i ON o.order_id = i.order_id WHERE i.{_FRESH}) AS customers_refreshed,
        (SELECT sum(i.total_price)::DOUBLE FROM a_order_items i JOIN a_products p ON i.product_id = p.product_id WHERE is_active AND ship_date < TIMESTAMP '{ORDERS_AS_OF}'
            AND i.product_id IN (SELECT product_id FROM a_order_items WHERE {_FRESH})) AS refreshed_revenue
    FROM a_order_items WHERE {_FRESH}""")
def _(t):
    """Item changes arrive as a stream; the second run sees only the new files and
    refreshes the products and customers they name."""
    root = run_dir(t.spark, "items")
    fresh = F.col("l_shipdate") >= ntz("2001-07-25")
    for n, part in enumerate((t.base("lineitem").filter(~fresh), t.base("lineitem").filter(fresh))):
        part.write.mode("append").parquet(f"{root}/lineitem.parquet")
        stream = file_stream(t.spark, f"{root}/lineitem.parquet", "l_orderkey bigint, l_partkey bigint")
        consume.changed_keys(stream, ["l_orderkey", "l_partkey"], f"{root}/keys{n}", f"{root}/checkpoint")
    keys = t.spark.read.parquet(f"{root}/keys1").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), "changes"
    )
    changed = keys.select("product_id").distinct()
    some = t.products.join(changed, "product_id", "left_semi")
    theirs = t.order_items.join(changed, "product_id", "left_semi")
    revenue = metrics.product_analytics(some, theirs, ORDERS_AS_OF).agg(
        dbl(F.sum(F.col("total_revenue").cast("decimal(18,2)"))).alias("refreshed_revenue")
    )
    customers = t.orders.join(keys.select("order_id").distinct(), "order_id", "left_semi").select("customer_id").distinct()
    return (
        keys.agg(F.sum("changes").alias("changes"))
        .crossJoin(changed.agg(F.count("product_id").alias("products_refreshed")))
        .crossJoin(customers.agg(F.count("customer_id").alias("customers_refreshed")))
        .crossJoin(revenue)
    )


# --- per-user order ----------------------------------------------------------

@query("rate_limit", """
    SELECT event_id, user_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS r FROM a_events) WHERE r <= 2""")
def _(t):
    # Published bound: 100 a minute.  The events are sparser, so 2 a day shows the cut.
    return limits.rate_limit(t.events, per_minute=2, unit="day").select("event_id", "user_id", "ts")


@query("rate_limit_minute", """
    SELECT event_id, user_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('minute', ts) ORDER BY ts, event_id) AS r FROM a_events) WHERE r <= 100""")
def _(t):
    return limits.rate_limit(t.events).select("event_id", "user_id", "ts")


@query("event_features", """
    SELECT event_id, user_id, hour(ts)::INTEGER AS hour, (dayofweek(ts) + 1)::INTEGER AS weekday,
        floor((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000)::BIGINT AS seconds_since_previous, row_number() OVER w AS running_count
    FROM a_events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t):
    return limits.event_features(t.events)


@query("asof_history", """
    SELECT p.event_id, p.user_id, p.ts, v.ts AS state_ts, v.event_id AS state_event_id, v.value::DOUBLE AS state_value
    FROM (SELECT * FROM a_events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM a_events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def _(t):
    left = t.events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = t.events.filter(F.col("event_type") == "view").select("user_id", "ts", "event_id", "value")
    found = asof_latest(left, right, "user_id", "ts", "ts", ["event_id", "value"])
    return found.withColumn("state_value", dbl(F.col("state_value")))


@query("asof_stream", """
    SELECT p.event_id, p.user_id, p.ts, v.ts AS state_ts, v.event_id AS state_event_id, v.value::DOUBLE AS state_value
    FROM (SELECT * FROM a_events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM a_events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def _(t):
    """The same join where the state arrives as a stream of its own; the closing event moves both watermarks."""
    def make(events):
        kind = F.col("event_type")
        found = keyed.asof_state(events.filter(kind.isin("purchase", keyed.CLOSING)), events.filter(kind.isin("view", keyed.CLOSING)), "10 minutes")
        return found

    return replayed(t, make, "asof")


@query("event_enrichment", """
    SELECT e.event_id, e.user_id, e.event_type, e.value::DOUBLE AS value, c.customer_tier, c.state, h.orders, h.spent::DOUBLE / h.orders AS mean_order
    FROM a_events e LEFT JOIN a_customers c ON e.user_id = c.customer_id
    LEFT JOIN (SELECT customer_id, count(*) AS orders, sum(total_amount) AS spent FROM a_orders GROUP BY 1) h ON e.user_id = h.customer_id""")
def _(t):
    history = t.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("spent"))
    profile = t.customers_placed.select("customer_id", "customer_tier", "state").join(history, "customer_id", "left")
    return t.events.join(profile, F.col("user_id") == F.col("customer_id"), "left").select(
        "event_id", "user_id", "event_type", dbl(F.col("value")).alias("value"), "customer_tier", "state", "orders",
        mean(F.col("spent"), F.col("orders")).alias("mean_order"),
    )
