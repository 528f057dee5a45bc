"""Data quality, health and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import boundaries, dbl, money, ntz, ratio


def check(name: str, df: DataFrame, bad: Column) -> DataFrame:
    """(test_name, status, details) for a predicate that must hold for no row."""
    return df.agg(F.count_if(F.coalesce(bad, F.lit(False))).alias("n")).select(
        F.lit(name).alias("test_name"),
        F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.concat(F.col("n").cast("string"), F.lit(" bad records")).alias("details"),
    )


def count_bad(df: DataFrame, bad: Column, out: str = "issues") -> DataFrame:
    return df.agg(F.count_if(F.coalesce(bad, F.lit(False))).alias(out))


def missing_email() -> Column:
    return F.col("email").isNull() | (F.col("email") == "")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent; a NULL key references nothing and is left out.

    Parent keys are made distinct first: an anti join cannot be split on its right
    side, and the "parent" may well be a table with one hot key.
    """
    keys = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")


@dataclass(frozen=True)
class Rule:
    """One check: a one-row count frame and how its result is worded."""

    code: str
    name: str
    table: str
    kind: str
    description: str
    expected: str
    actual_key: str
    message: str
    issues: DataFrame


def standard_rules(
    customers: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame, as_of: str
) -> list[Rule]:
    return [
        Rule(
            "DQ_CUSTOMER_EMAIL", "Customer Email Validation", "customers", "NULL_CHECK",
            "Customers with missing email addresses", '{"expected_nulls":0}', "actual_nulls",
            "customers with missing emails", count_bad(customers, missing_email()),
        ),
        Rule(
            "DQ_ORDER_ITEMS", "Order Items Validation", "orders", "REFERENTIAL_INTEGRITY",
            "Orders without order items", '{"expected_orphans":0}', "actual_orphans",
            "orders without items", orphans(orders, items, "order_id").agg(F.count(F.lit(1)).alias("issues")),
        ),
        Rule(
            "DQ_PRODUCT_PRICE", "Product Price Validation", "products", "RANGE_CHECK",
            "Products with negative prices", '{"min_price":0}', "negative_prices",
            "products with negative prices", count_bad(products, F.col("price") < 0),
        ),
        Rule(
            "DQ_ORDER_DATE", "Order Date Validation", "orders", "TEMPORAL_CHECK",
            "Orders with future dates", f'{{"max_date":"{as_of}"}}', "future_orders",
            "orders with future dates", count_bad(orders, F.col("order_date") > ntz(as_of)),
        ),
    ]


def run_rules(rules: Sequence[Rule], as_of: str) -> DataFrame:
    """One result row per rule.  Every rule is a one-row aggregate; the union has no shuffle."""
    stamp = as_of.replace("-", "").replace(":", "").replace(" ", "")
    out = None
    for order, r in enumerate(rules):
        row = r.issues.select(
            F.lit(order).alias("check_no"),
            F.lit(f"{r.code}_{stamp}").alias("check_id"),
            F.lit(r.name).alias("check_name"),
            F.lit(r.table).alias("table_name"),
            F.lit(r.kind).alias("check_type"),
            F.lit(r.description).alias("check_description"),
            F.lit(r.expected).alias("expected_result"),
            F.to_json(F.struct(F.col("issues").alias(r.actual_key))).alias("actual_result"),
            F.when(F.col("issues") == 0, "PASS").otherwise("FAIL").alias("status"),
            ntz(as_of).alias("check_timestamp"),
            F.when(
                F.col("issues") > 0, F.concat(F.lit("Found "), F.col("issues").cast("string"), F.lit(f" {r.message}"))
            ).alias("error_details"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def summary_text(results: DataFrame) -> DataFrame:
    """All failures in one sentence, in check order (one short entry per rule)."""
    found = F.array_sort(F.collect_list(F.when(F.col("status") == "FAIL", F.struct("check_no", "error_details"))))
    return results.agg(found.alias("found")).select(
        F.when(F.size("found") == 0, "All data quality checks passed")
        .otherwise(
            F.concat(
                F.lit("Data quality issues found: "),
                F.array_join(F.transform("found", lambda r: r["error_details"]), "; "),
            )
        )
        .alias("summary")
    )


def duplicates(df: DataFrame, keys: Mapping[str, Sequence[str]], tolerance: float = 0.01) -> DataFrame:
    """Per key: rows beyond the first of each value, their share, and the verdict."""
    out = None
    for name, columns in keys.items():
        per_key = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
        row = per_key.agg(
            F.lit(name).alias("key_name"),
            F.sum("n").alias("total_rows"),
            (F.sum("n") - F.count(F.lit(1))).alias("duplicate_rows"),
            F.count_if(F.col("n") > 1).alias("repeated_keys"),
        )
        out = row if out is None else out.unionByName(row)
    share = ratio(F.col("duplicate_rows"), F.col("total_rows"))
    return out.withColumn("duplicate_rate", share).withColumn(
        "status", F.when(F.coalesce(share, F.lit(0.0)) <= tolerance, "PASS").otherwise("FAIL")
    )


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Filled share of each column, all columns in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(c).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in columns])
    return one.select("total", F.inline(rows)).select(
        "column_name", "filled", F.col("total").alias("total_rows"),
        (ratio(F.col("filled"), F.col("total")) * 100).alias("completeness_pct"),
    )


# Ingestion + transformation limits per data class, in minutes.
SLA_MINUTES = {"real_time": 3, "near_real_time": 15, "micro_batch": 180, "full_batch": 600}


def freshness(sources: Mapping[str, tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Lag of each source's newest row behind ``as_of`` against its class limit.

    ``sources`` maps a name to (frame, timestamp column, data class, as_of).
    """
    out = None
    for name, (df, ts, kind, as_of) in sources.items():
        lag = boundaries("MINUTE", F.col("latest"), ntz(as_of))
        row = df.agg(F.max(ts).alias("latest")).select(
            F.lit(name).alias("source"),
            F.lit(kind).alias("data_class"),
            "latest",
            lag.alias("lag_minutes"),
            F.when(lag <= SLA_MINUTES[kind], "MET").otherwise("MISSED").alias("sla_status"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def reconcile(
    source: DataFrame, target: DataFrame, key: str, source_amount: str, target_amount: str
) -> DataFrame:
    """Per-key totals of both sides and how they differ.

    Both sides are summed per key before the full outer join, so a key with many
    rows is one row per task by then.
    """
    s = source.groupBy(key).agg(F.sum(money(F.col(source_amount))).alias("source_total"), F.count(F.lit(1)).alias("source_rows"))
    g = target.groupBy(F.col(key).alias("__k")).agg(
        F.sum(money(F.col(target_amount))).alias("target_total"), F.count(F.lit(1)).alias("target_rows")
    )
    both = s.join(g, F.col(key) == F.col("__k"), "full_outer")
    outcome = (
        F.when(F.col("target_rows").isNull(), "MISSING_IN_TARGET")
        .when(F.col("source_rows").isNull(), "EXTRA_IN_TARGET")
        .when(F.col("source_total").eqNullSafe(F.col("target_total")), "MATCH")
        .otherwise("DIFFERENT")
    )
    return both.select(
        F.coalesce(F.col(key), F.col("__k")).alias(key),
        dbl(F.col("source_total")).alias("source_total"),
        dbl(F.col("target_total")).alias("target_total"),
        outcome.alias("outcome"),
    )


def gate(results: DataFrame) -> DataFrame:
    """Pass only when every check passed."""
    return results.agg(
        F.coalesce(F.every(F.col("status") == "PASS"), F.lit(True)).alias("all_passed"),
        F.count_if(F.col("status") != "PASS").alias("failed_checks"),
    )


def error_bursts(errors: DataFrame, limit: int = 10, minutes: int = 5) -> DataFrame:
    """Windows with more than ``limit`` errors, plus each window's share by severity."""
    return (
        errors.groupBy(F.window("error_timestamp", f"{minutes} minutes").alias("w"))
        .agg(F.count(F.lit(1)).alias("errors"), F.count_if(F.col("severity") == "CRITICAL").alias("critical"))
        .filter(F.col("errors") > limit)
        .select(ntz(F.col("w.start")).alias("window_start"), "errors", "critical", F.lit("High").alias("alert_level"))
    )


def low_quality_days(checks: DataFrame, minimum_pct: float = 95.0) -> DataFrame:
    """Days whose share of passed checks is below the minimum."""
    passed = ratio(F.count_if(F.col("status") == "PASS"), F.count(F.lit(1))) * 100
    return (
        checks.groupBy(F.to_date("check_timestamp").alias("day"))
        .agg(F.count(F.lit(1)).alias("checks"), passed.alias("pass_pct"))
        .filter(F.col("pass_pct") < minimum_pct)
    )


# --- health ------------------------------------------------------------------


@dataclass(frozen=True)
class HealthPreset:
    """Largest error count still HEALTHY / WARNING; pending feeds may be limited too."""

    healthy_errors: int
    warning_errors: int
    healthy_feeds: int | None = None


# The thresholds of the four health procedures.
PRESETS = {
    "orchestrator": HealthPreset(0, 3),
    "pipeline": HealthPreset(0, 2, healthy_feeds=1),
    "system": HealthPreset(0, 3),
    "operational_view": HealthPreset(0, 5),
}


def health(errors: Column, preset: HealthPreset, pending_feeds: Column | None = None) -> Column:
    good = errors <= preset.healthy_errors
    if preset.healthy_feeds is not None and pending_feeds is not None:
        good = good & (pending_feeds <= preset.healthy_feeds)
    return F.when(good, "HEALTHY").when(errors <= preset.warning_errors, "WARNING").otherwise("UNHEALTHY")


def health_value(state: Column) -> Column:
    return F.when(state == "HEALTHY", 1.0).when(state == "WARNING", 0.5).otherwise(0.0)


def open_pipeline_errors(errors: DataFrame, as_of: str, hours: int = 1) -> DataFrame:
    since = ntz(as_of) - F.expr(f"interval {int(hours)} hours")
    return errors.filter(
        (F.col("error_timestamp") >= since) & (F.col("error_category") == "DATA_PIPELINE") & ~F.col("resolved")
    )


def system_health(jobs: DataFrame, errors: DataFrame, as_of: str) -> DataFrame:
    """Job counts of the last day, open errors of the last hour, overall state and sentence."""
    now = ntz(as_of)
    j = jobs.filter(F.col("created_at") >= now - F.expr("interval 1 day")).agg(
        F.count_if(F.col("status") == "PENDING").alias("pending_jobs"),
        F.count_if((F.col("status") == "FAILED") & (F.col("retry_count") >= F.col("max_retries"))).alias("failed_jobs"),
        F.count_if(F.col("status") == "RUNNING").alias("running_jobs"),
    )
    e = errors.filter((F.col("error_timestamp") >= now - F.expr("interval 1 hour")) & ~F.col("resolved")).agg(
        F.count(F.lit(1)).alias("recent_errors")
    )
    failed, recent = F.col("failed_jobs"), F.col("recent_errors")
    state = (
        F.when((failed > 5) | (recent > 3), "UNHEALTHY")
        .when((failed > 0) | (recent > 0), "WARNING")
        .otherwise("HEALTHY")
    )
    text = F.concat(
        F.lit("System Health Summary: Pending Jobs: "), F.col("pending_jobs").cast("string"),
        F.lit(", Failed Jobs: "), failed.cast("string"),
        F.lit(", Running Jobs: "), F.col("running_jobs").cast("string"),
        F.lit(", Recent Errors: "), recent.cast("string"), F.lit(" - STATUS: "), state,
    )
    return j.crossJoin(e).select("*", state.alias("status"), text.alias("summary"))


def pipeline_health(errors: DataFrame, feeds: DataFrame, as_of: str) -> DataFrame:
    """State, its logged metric value and tags, and the sentence.

    ``feeds`` has one row per feed with ``pending_changes``.
    """
    e = open_pipeline_errors(errors, as_of).agg(F.count(F.lit(1)).alias("error_count"))
    f = feeds.agg(F.count_if(F.col("pending_changes") > 0).alias("streams_with_data"))
    state = health(F.col("error_count"), PRESETS["orchestrator"])
    tags = F.to_json(F.struct(F.col("health_status"), F.col("error_count"), F.col("streams_with_data")))
    text = F.concat(
        F.lit("Pipeline Health: "), F.col("health_status"), F.lit(" | Recent Errors: "),
        F.col("error_count").cast("string"), F.lit(" | Streams with Data: "), F.col("streams_with_data").cast("string"),
    )
    return (
        e.crossJoin(f)
        .withColumn("health_status", state)
        .select(
            "health_status", "error_count", "streams_with_data",
            health_value(F.col("health_status")).alias("metric_value"),
            tags.alias("tags"), text.alias("summary"),
        )
    )


def autoresolve(errors: DataFrame, as_of: str, threshold: int = 5) -> DataFrame:
    """Errors after the volume rule: with more than ``threshold`` open pipeline errors in
    the last hour, open pipeline errors older than a day are marked resolved."""
    count = open_pipeline_errors(errors, as_of).agg(F.count(F.lit(1)).alias("__open"))
    old = (
        (F.col("error_timestamp") < ntz(as_of) - F.expr("interval 1 day"))
        & (F.col("error_category") == "DATA_PIPELINE")
        & ~F.col("resolved")
        & (F.col("__open") > threshold)
    )
    note = "Auto-resolved by orchestrator due to high error volume"
    return errors.crossJoin(count).select(
        *[F.col(c) for c in errors.columns if c != "resolved"],
        (F.col("resolved") | old).alias("resolved"),
        F.when(old, note).alias("resolution_notes"),
    )


def metric_count(metrics: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    since = ntz(as_of) - F.expr(f"interval {int(days)} days")
    return metrics.filter((F.col("metric_type") == "data_processing") & (F.col("metric_timestamp") >= since)).agg(
        F.count(F.lit(1)).alias("metrics_count")
    )
