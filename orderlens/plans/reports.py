"""Reports over the views: result frames, their summaries and the JSON sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import dbl, json_text, mean, money, ntz, ratio
from orderlens.plans.views import as_date
from orderlens.schemas import REPORT_TYPES
from orderlens.sources import documents

TITLES = {
    "SALES_REPORT": "Sales Performance Report",
    "CUSTOMER_ANALYSIS": "Customer Analysis Report",
    "PRODUCT_PERFORMANCE": "Product Performance Report",
    "EXECUTIVE_DASHBOARD": "Executive Dashboard",
    "DATA_QUALITY": "Data Quality Report",
}
FOLDERS = {
    "SALES_REPORT": "sales",
    "CUSTOMER_ANALYSIS": "customers",
    "PRODUCT_PERFORMANCE": "products",
    "EXECUTIVE_DASHBOARD": "executive",
    "DATA_QUALITY": "quality",
}


def sales_report(performance: DataFrame, as_of: str, months: int = 6) -> DataFrame:
    return performance.filter(F.col("sales_month") >= F.add_months(as_date(as_of), -months)).select(
        "sales_month",
        "total_orders",
        "unique_customers",
        "total_revenue",
        "avg_order_value",
        "revenue_growth_pct",
        "top_selling_product",
        "top_selling_category",
    )


def sales_report_summary(report: DataFrame) -> DataFrame:
    """Rows, newest month's revenue (0 when empty), orders, mean monthly revenue (NaN when empty)."""
    return report.agg(
        F.count(F.lit(1)).alias("total_months"),
        F.coalesce(F.max_by("total_revenue", "sales_month"), F.lit(0.0)).alias("latest_revenue"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).cast("bigint").alias("total_orders_ytd"),
        F.coalesce(
            mean(F.sum(money(F.col("total_revenue"))), F.count("total_revenue")), F.lit(float("nan"))
        ).alias("avg_monthly_revenue"),
    )


def customer_report(view: DataFrame) -> DataFrame:
    return view.groupBy("customer_tier", "customer_status").agg(
        F.count(F.lit(1)).alias("customer_count"),
        mean(F.sum(money(F.col("lifetime_value"))), F.count("lifetime_value")).alias("avg_ltv"),
        mean(F.sum("total_orders"), F.count("total_orders")).alias("avg_orders"),
        dbl(F.sum(money(F.col("total_spent")))).alias("total_revenue"),
    )


def customer_report_summary(report: DataFrame) -> DataFrame:
    """``avg_lifetime_value`` is the published mean of group means; the weighted mean stands beside it."""
    return report.agg(
        F.sum("customer_count").alias("total_customers"),
        F.round(F.avg("avg_ltv"), 6).alias("avg_lifetime_value"),
        F.round(
            ratio(F.sum(F.col("avg_ltv") * F.col("customer_count")), F.sum("customer_count")), 6
        ).alias("weighted_lifetime_value"),
        dbl(F.sum(money(F.col("total_revenue")))).alias("total_revenue"),
    )


def product_report(view: DataFrame, limit: int = 50) -> DataFrame:
    """Top products by revenue; top-k keeps ``limit`` rows per task before the merge."""
    return (
        view.filter(F.col("total_revenue") > 0)
        .orderBy(F.col("total_revenue").desc(), F.col("product_id"))
        .limit(limit)
        .select(
            "product_id",
            "product_name",
            "category",
            "total_revenue",
            "total_quantity_sold",
            "margin_percentage",
            "revenue_rank",
            "unique_customers",
            "last_sale_date",
        )
    )


def product_report_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.min_by("product_name", F.struct(-F.col("total_revenue"), F.col("product_id"))).alias("top_product"),
        dbl(F.sum(money(F.col("total_revenue")))).alias("total_revenue"),
        mean(F.sum(money(F.col("margin_percentage"))), F.count("margin_percentage")).alias("avg_margin"),
    )


def success_rate(good: Column, total: Column) -> Column:
    return dbl(good) / F.greatest(total, F.lit(1)) * 100


def executive_report(dashboard: DataFrame) -> DataFrame:
    return dashboard.select(
        "ytd_revenue",
        (F.col("ytd_revenue") - F.col("last_year_revenue")).alias("revenue_growth"),
        F.col("total_active_customers").alias("active_customers"),
        "orders_ytd",
        F.col("avg_order_value_ytd").alias("avg_order_value"),
        "jobs_today",
        success_rate(F.col("jobs_completed_today"), F.col("jobs_today")).alias("jobs_success_rate"),
    )


def quality_report(checks: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """The checks of the last days, newest first."""
    start = ntz(F.date_sub(as_date(as_of), days))
    return checks.filter(F.col("check_timestamp") >= start).orderBy(F.col("check_timestamp").desc(), "check_id").select(
        "check_name", "table_name", "check_type", "status", "check_timestamp", "expected_result", "actual_result", "error_details"
    )


def quality_report_summary(report: DataFrame) -> DataFrame:
    passed = F.count_if(F.col("status") == "PASS")
    return report.agg(
        F.count(F.lit(1)).alias("total_checks"),
        passed.alias("passed_checks"),
        F.count_if(F.col("status") == "FAIL").alias("failed_checks"),
        success_rate(passed, F.count(F.lit(1))).alias("success_rate"),
    )


def job_metrics(jobs: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    done = F.count_if(F.col("status") == "COMPLETED")
    return jobs.filter(F.col("created_at") >= ntz(as_of) - F.expr(f"interval {int(hours)} hours")).agg(
        F.count(F.lit(1)).alias("total_jobs"),
        done.alias("completed_jobs"),
        F.count_if(F.col("status") == "FAILED").alias("failed_jobs"),
        F.count_if(F.col("status") == "RUNNING").alias("running_jobs"),
        F.coalesce(
            mean(F.sum(money(F.col("execution_time_seconds"))), F.count("execution_time_seconds")), F.lit(0.0)
        ).alias("avg_execution_time"),
        success_rate(done, F.count(F.lit(1))).alias("success_rate"),
    )


def report_periods(jobs: DataFrame) -> DataFrame:
    """Start and end date of the period each job's report type covers, from its run date."""
    run = F.to_date("created_at")
    kind = report_type(jobs)
    start = (
        F.when(kind == "SALES_REPORT", F.date_sub(run, 1))
        .when(kind == "CUSTOMER_ANALYSIS", F.date_sub(run, 1))
        .when(kind == "PRODUCT_PERFORMANCE", F.date_sub(run, 7))
        .when(kind == "EXECUTIVE_DASHBOARD", F.date_sub(run, 7))
        .when(kind == "DATA_QUALITY", F.add_months(F.trunc(run, "month"), -1))
    )
    end = F.when(kind == "DATA_QUALITY", F.trunc(run, "month")).otherwise(run)
    return jobs.select(
        "job_id", kind.alias("report_type"), start.alias("start_date"), F.when(start.isNotNull(), end).alias("end_date")
    )


def report_type(jobs: DataFrame) -> Column:
    """The type named in the job's input, else the job type, upper-cased."""
    return F.upper(F.coalesce(json_text(F.col("input_data"), "report_type"), F.col("job_type")))


def run_reports(jobs: DataFrame, as_of: str) -> DataFrame:
    """Next state of every pending job: COMPLETED with a location, or FAILED with a reason.

    Routing is a projection.  The report bodies are computed once per type (see
    ``report_bodies``), not once per job.
    """
    stamp = as_of[:10].replace("-", "")
    folder = F.create_map(*[F.lit(x) for pair in FOLDERS.items() for x in pair])
    kind = report_type(jobs)
    known = kind.isin(*REPORT_TYPES)
    name = F.concat(
        F.lit("reports/"), F.element_at(folder, kind), F.lit("/"), F.col("job_id").cast("string"),
        F.lit("_"), F.lower(kind), F.lit(f"_{stamp}.json"),
    )
    return jobs.filter(F.col("status") == "PENDING").select(
        "job_id",
        kind.alias("report_type"),
        F.when(known, "COMPLETED").otherwise("FAILED").alias("status"),
        F.when(known, name).alias("output_location"),
        F.when(~known, F.concat(F.lit("Unsupported report type: "), kind)).alias("error_message"),
    )


def run_batch(jobs: DataFrame, bodies: Mapping[str, DataFrame], folder: str, as_of: str) -> DataFrame:
    """Runs the reports the pending jobs ask for and returns the jobs' next states.

    The distinct report types (at most five) are read on the driver; each is computed
    and written once, however many jobs want it.
    """
    states = run_reports(jobs, as_of)
    wanted = [r.report_type for r in states.filter(F.col("status") == "COMPLETED").select("report_type").distinct().collect()]
    for kind in sorted(wanted):
        write_report(bodies[kind], f"{folder}/{FOLDERS[kind]}")
    return states


def report_body(kind: str, data: DataFrame | None, summary: DataFrame, as_of: str, parameters: dict | None = None) -> DataFrame:
    """One JSON document for a bounded report (months, tiers, top 50): header, summary, records."""
    head = [F.lit(kind).alias("report_kind"), F.lit(TITLES[kind]).alias("report_type"), F.lit(as_of).alias("generated_at")]
    params = [F.lit(v).alias(k) for k, v in (parameters or {}).items()]
    if params:
        head.append(F.struct(*params).alias("parameters"))
    one = summary.select(F.struct(*summary.columns).alias("summary"))
    if data is not None:
        rows = data.agg(F.collect_list(F.struct(*data.columns)).alias("data"))
        one = one.crossJoin(rows)
    columns = [c for c in one.columns]
    doc = one.select(*head, *columns)
    keep = [c for c in doc.columns if c != "report_kind"]
    return doc.select("report_kind", F.to_json(F.struct(*keep)).alias("document"))


def write_report(body: DataFrame, folder: str) -> None:
    """Each document as one text file set under its kind."""
    body.write.mode("overwrite").partitionBy("report_kind").text(folder)


# --- a document for each job --------------------------------------------------------------------


def job_documents(jobs: DataFrame, bodies: Mapping[str, DataFrame], as_of: str) -> tuple[DataFrame, DataFrame]:
    """The next states of the pending jobs, and a document for each of those that completes.

    A body is computed once for a type.  Few bodies meet many jobs, so their join keeps the
    jobs where they are; a document holds its job, its period and the body of its type.
    """
    states = run_reports(jobs, as_of)
    united = None
    for body in bodies.values():
        united = body if united is None else united.unionByName(body)
    periods = report_periods(jobs).select("job_id", F.struct("start_date", "end_date").alias("period"))
    done = states.filter(F.col("status") == "COMPLETED").join(periods, "job_id").join(united, F.col("report_type") == F.col("report_kind"))
    # The body is JSON already: its fields follow those of the job in one object.
    head = F.to_json(F.struct(F.col("job_id"), F.col("period").alias("parameters")))
    text = F.concat(F.substring(head, 1, F.length(head) - 1), F.lit(","), F.substring("document", 2, 2_000_000_000))
    return states, done.select("output_location", text.alias("document"))


def publish(spark, jobs: DataFrame, bodies: Mapping[str, DataFrame], rows: Mapping[str, DataFrame], folder: str, as_of: str) -> DataFrame:
    """Writes a file for each job, unbounded data as JSON lines beside them, and returns the jobs' next states.

    The states are returned only after the commit has published the manifest, so no job is
    COMPLETED with a location that does not exist.
    """
    documents.register(spark)
    for kind, data in rows.items():
        data.write.mode("overwrite").json(f"{folder}/reports/{FOLDERS[kind]}/data")
    states, made = job_documents(jobs, bodies, as_of)
    made.write.format("documents").option("folder", folder).mode("append").save()
    return states
