"""Canned analytic questions and the keyword router that picks one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import dbl, mean, money, ntz, pct, ratio
from orderlens.plans.views import as_date

# Keyword families of the question router, first match wins.
FAMILIES = {
    "customer": ("customer", "client"),
    "product": ("product", "item"),
    "order": ("order", "sale", "revenue"),
    "job": ("job", "task", "process"),
}
REFINEMENTS = {
    "top": ("top", "best", "highest"),
    "count": ("count", "total", "number"),
    "price": ("price", "cost", "expensive"),
    "recent": ("recent", "latest", "new"),
}


def top_customers(customers: DataFrame, limit: int = 10) -> DataFrame:
    return (
        customers.orderBy(F.col("lifetime_value").desc_nulls_first(), "customer_id")
        .limit(limit)
        .select(
            "customer_id",
            "customer_name",
            "customer_tier",
            dbl(F.col("lifetime_value")).alias("lifetime_value"),
            "email",
            F.when(F.col("is_active"), "Active").otherwise("Inactive").alias("status"),
        )
    )


def customers_by_tier(customers: DataFrame) -> DataFrame:
    ltv = money(F.col("lifetime_value"))
    return customers.filter("is_active").groupBy("customer_tier").agg(
        F.count(F.lit(1)).alias("customer_count"),
        mean(F.sum(ltv), F.count(ltv)).alias("avg_lifetime_value"),
        dbl(F.sum(ltv)).alias("total_lifetime_value"),
    )


def customer_tier_span(customers: DataFrame) -> DataFrame:
    ltv = money(F.col("lifetime_value"))
    return customers.groupBy("customer_tier").agg(
        F.count(F.lit(1)).alias("customer_count"),
        mean(F.sum(ltv), F.count(ltv)).alias("avg_ltv"),
        F.min("created_at").alias("first_customer"),
        F.max("created_at").alias("latest_customer"),
    )


def top_products_by_price(products: DataFrame, limit: int = 15) -> DataFrame:
    return (
        products.orderBy(F.col("price").desc_nulls_first(), "product_id")
        .limit(limit)
        .select(
            "product_id",
            "product_name",
            "category",
            dbl(F.col("price")).alias("price"),
            dbl(F.col("cost")).alias("cost"),
            pct(F.col("price") - F.col("cost"), F.col("price")).alias("margin_percentage"),
            "is_active",
        )
    )


def category_summary(products: DataFrame) -> DataFrame:
    """Means per category; a product priced zero has no margin and is left out of that mean."""
    margin = (ratio(F.col("price") - F.col("cost"), F.col("price")) * 100).cast("decimal(18,6)")
    return products.filter("is_active").groupBy("category").agg(
        F.count(F.lit(1)).alias("product_count"),
        mean(F.sum(money(F.col("price"))), F.count("price")).alias("avg_price"),
        mean(F.sum(money(F.col("cost"))), F.count("cost")).alias("avg_cost"),
        mean(F.sum(margin), F.count(margin)).alias("avg_margin_pct"),
    )


def recent_orders(orders: DataFrame, customers: DataFrame, limit: int = 20) -> DataFrame:
    """Newest orders that have a customer: top-k over the join, merged from per-task top-k."""
    return (
        orders.join(customers.select("customer_id", "customer_name"), "customer_id")
        .orderBy(F.col("order_date").desc_nulls_first(), "order_id")
        .limit(limit)
        .select("order_id", "customer_name", "order_date", dbl(F.col("total_amount")).alias("total_amount"), "status")
    )


def monthly_orders(orders: DataFrame, as_of: str, months: int = 12) -> DataFrame:
    amount = money(F.col("total_amount"))
    since = ntz(F.add_months(as_date(as_of), -months))
    return (
        orders.filter(F.col("order_date") >= since)
        .groupBy(F.trunc("order_date", "month").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            dbl(F.sum(amount)).alias("total_revenue"),
            mean(F.sum(amount), F.count(amount)).alias("avg_order_value"),
        )
    )


def jobs_by_type_status(jobs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    spent = money(F.col("execution_time_seconds"))
    since = ntz(F.date_sub(as_date(as_of), days))
    return jobs.filter(F.col("created_at") >= since).groupBy("job_type", "status").agg(
        F.count(F.lit(1)).alias("job_count"),
        mean(F.sum(spent), F.count(spent)).alias("avg_execution_time"),
        F.max("created_at").alias("latest_job"),
    )


def mentions(text: Column, words: tuple[str, ...]) -> Column:
    """True when the lower-cased text contains any of the words."""
    return text.rlike("|".join(words))


def route(question: Column) -> Column:
    """Template name for a question: nested keyword families, first match wins."""
    text = F.lower(question)
    has = lambda name: mentions(text, REFINEMENTS[name])
    return (
        F.when(
            mentions(text, FAMILIES["customer"]),
            F.when(has("top"), "top_customers").when(has("count"), "customers_by_tier").otherwise("customer_tier_span"),
        )
        .when(
            mentions(text, FAMILIES["product"]),
            F.when(has("price"), "top_products_by_price").otherwise("category_summary"),
        )
        .when(
            mentions(text, FAMILIES["order"]),
            F.when(has("recent"), "recent_orders").otherwise("monthly_orders"),
        )
        .when(mentions(text, FAMILIES["job"]), "jobs_by_type_status")
        .otherwise("fallback")
    )
