"""Small relational jobs: filters, lookups, comparisons, counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import boundaries, mean, ntz, ratio
from orderlens.plans.views import as_date


def inline_labels(spark: SparkSession) -> DataFrame:
    """Inline rows whose documents are parsed on the way in."""
    rows = spark.createDataFrame(
        [
            ("click", '{"label": "Click", "weight": 2}', '["web", "app"]'),
            ("purchase", '{"label": "Purchase", "weight": 10}', '["web"]'),
            ("error", '{"label": "Error"}', "[]"),
        ],
        "event_type string, doc string, channels string",
    )
    doc = F.from_json("doc", "label string, weight int")
    return rows.select(
        "event_type",
        doc["label"].alias("label"),
        doc["weight"].alias("weight"),
        F.from_json("channels", "array<string>").alias("channels"),
    )


def recent_counts(jobs: DataFrame, orders: DataFrame, jobs_as_of: str, orders_as_of: str) -> DataFrame:
    now = ntz(jobs_as_of)

    def one(df: DataFrame, span: str, where) -> DataFrame:
        return df.filter(where).agg(F.lit(span).alias("span"), F.count(F.lit(1)).alias("n"))

    months = ntz(F.add_months(as_date(orders_as_of), -6))
    return (
        one(jobs, "last_24_hours", F.col("created_at") >= now - F.expr("interval 24 hours"))
        .unionByName(one(jobs, "last_7_days", F.col("created_at") >= now - F.expr("interval 7 days")))
        .unionByName(one(orders, "last_6_months", F.col("order_date") >= months))
    )


def on_day(df: DataFrame, ts: str, day: str) -> DataFrame:
    """``date(ts) = day`` as a half-open range that reaches the scan."""
    start = ntz(day)
    return df.filter((F.col(ts) >= start) & (F.col(ts) < start + F.expr("interval 1 day")))


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def pattern_checks(df: DataFrame, rules: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One scan for all patterns; a pattern must match the whole text, NULL counts as bad."""
    counts = df.agg(
        *[
            F.count_if(~F.coalesce(F.col(column), F.lit("")).rlike(f"^(?:{pattern})$")).alias(name)
            for name, (column, pattern) in rules.items()
        ]
    )
    return _verdicts(counts, list(rules))


def like_check(df: DataFrame, name: str, column: str, pattern: str) -> DataFrame:
    return _verdicts(df.agg(F.count_if(~F.col(column).like(pattern)).alias(name)), [name])


def _verdicts(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(n).alias("test_name"), F.col(n).alias("bad_rows")) for n in names])
    return counts.select(F.inline(rows)).select(
        "test_name", F.when(F.col("bad_rows") == 0, "PASS").otherwise("FAIL").alias("status"), "bad_rows"
    )


def compare_catalogs(kinds: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """For each kind, every name of either side and where it exists."""
    out = None
    for kind, (first, second) in kinds.items():
        a = first.select(F.col(first.columns[0]).cast("string").alias("a")).distinct()
        b = second.select(F.col(second.columns[0]).cast("string").alias("b")).distinct()
        rows = a.join(b, F.col("a") == F.col("b"), "full_outer").select(
            F.lit(kind).alias("object_type"),
            F.coalesce("a", "b").alias("object_name"),
            F.col("a").isNotNull().alias("exists_in_first"),
            F.col("b").isNotNull().alias("exists_in_second"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def used_columns(df: DataFrame, table: str, prefix: str = "", rename: Mapping[str, str] | None = None) -> DataFrame:
    """(table, column) for every column that holds at least one value: a one-pass profile."""
    rename = rename or {}
    short = {c: c.removeprefix(prefix) for c in df.columns}
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = F.array(
        *[
            F.struct(F.lit(rename.get(short[c], short[c])).alias("column_name"), F.col(c).alias("n"))
            for c in df.columns
        ]
    )
    return (
        filled.select(F.inline(rows)).filter("n > 0").select(F.lit(table).alias("table_name"), "column_name")
    )


def drift(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of either side the other lacks."""
    return (
        first.subtract(second).withColumn("side", F.lit("only_in_first"))
        .unionByName(second.subtract(first).withColumn("side", F.lit("only_in_second")))
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("record_count"))
        out = row if out is None else out.unionByName(row)
    return out


def stage_counts(stages: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    """One row per stage: the sum of its tables' row counts."""
    parts = None
    for stage, frames in stages.items():
        for df in frames:
            row = df.agg(F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("n"))
            parts = row if parts is None else parts.unionByName(row)
    return parts.groupBy("stage").agg(F.sum("n").alias("record_count"))


def renamed_with_old(df: DataFrame, old: str, new: str) -> DataFrame:
    """A column under its new name and, for compatibility, its old one."""
    return df.select("*", F.col(old).alias(new))


def feature_flags(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("ACTIVE_ONLY_CUSTOMERS", "prod", True), ("ACTIVE_ONLY_CUSTOMERS", "dev", False)],
        "feature_name string, environment string, enabled boolean",
    )


def switched(
    flags: DataFrame, feature: str, environment: str, on: Callable[[], DataFrame], off: Callable[[], DataFrame]
) -> DataFrame:
    """The source a flag selects; one flag row is read on the driver, a missing flag is off."""
    row = flags.filter(
        (F.col("feature_name") == feature) & (F.col("environment") == environment)
    ).select("enabled").first()
    return on() if row is not None and row["enabled"] else off()


def success_by_day(jobs: DataFrame, group: str) -> DataFrame:
    return (
        jobs.groupBy(group, F.to_date("created_at").alias("date"))
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "COMPLETED").alias("successful"))
        .withColumn("success_rate", ratio(F.col("successful"), F.col("total")) * 100)
    )


def task_performance(jobs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    kinds = ("REPORT", "ANALYSIS", "VALIDATION")
    spent = boundaries("SECOND", F.col("created_at"), F.col("updated_at"))
    recent = jobs.filter(
        F.col("job_type").isin(*kinds) & (F.col("created_at") >= ntz(as_of) - F.expr(f"interval {int(days)} days"))
    )
    return recent.agg(
        F.lit("Performance summary").alias("summary_type"),
        F.count(F.lit(1)).alias("total_executions"),
        F.count_if(F.col("status") == "COMPLETED").alias("successful_executions"),
        F.count_if(F.col("status") == "FAILED").alias("failed_executions"),
        mean(F.sum(spent), F.count(spent)).alias("avg_execution_seconds"),
    )
