"""Reporting views.

Several published numbers sum an order amount after joining its items, so an
order counts once per item.  The views keep that reading; the ``fanout=False``
variants count each order once.  Neither materialises the fan-out: items are
counted per order first and the count is used as a weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions import boundaries, dbl, hour_floor, json_text, mean, money, ntz, pct
from orderlens.operators.ranking import rank_desc
from orderlens.schemas import ADDRESS, SOLD
from orderlens.session import settle_counted


def sold(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status").isin(*SOLD))


def as_date(as_of: str) -> Column:
    return F.lit(as_of[:10]).cast("date")


def customer_status(last_order: Column, as_of: str) -> Column:
    """Active up to 30 days, At Risk up to 90, else (and without orders) Inactive."""
    age = F.datediff(as_date(as_of), last_order)
    return F.when(age <= 30, "Active").when(age <= 90, "At Risk").otherwise("Inactive")


def item_weights(items: DataFrame) -> DataFrame:
    """Rows per order: the factor by which a join with items repeats an order."""
    return items.groupBy("order_id").agg(F.count(F.lit(1)).alias("fan"))


def order_totals(orders: DataFrame, items: DataFrame, by: list, fanout: bool = True) -> DataFrame:
    """Exact order sums per group, weighted by item count when ``fanout``.

    Counts distinct order ids per group without an expand: the join leaves the
    data partitioned by order_id, so grouping by it first needs no new shuffle.
    """
    if fanout:
        weighted = orders.join(item_weights(items), "order_id", "left").withColumn(
            "w", F.coalesce(F.col("fan"), F.lit(1))
        )
    else:
        weighted = orders.withColumn("w", F.lit(1))
    one = weighted.groupBy("order_id", *by).agg(
        F.sum(money(F.col("total_amount")) * F.col("w")).alias("amount"),
        F.sum("w").alias("weight"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )
    return one.groupBy(*by).agg(
        F.count("order_id").alias("orders"),
        F.sum("amount").alias("amount"),
        F.sum("weight").alias("weight"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )


def customer_products(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Sorted distinct categories and product names per customer.

    The inner join may be split by Spark when one order is hot on either side.  Pairs
    (customer, product) are made distinct before anything is gathered, so a customer
    holding a third of all rows is spread over its products and ends as at most one
    row per product.
    """
    pairs = (
        items.select("order_id", "product_id")
        .join(orders.select("order_id", "customer_id"), "order_id")
        .select("customer_id", "product_id")
        .distinct()
    )
    named = pairs.join(products.select("product_id", "category", "product_name"), "product_id")
    return named.groupBy("customer_id").agg(
        F.array_sort(F.collect_set("category")).alias("preferred_categories"),
        F.array_sort(F.collect_set("product_name")).alias("purchased_products"),
    )


def customer_360(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    as_of: str,
    fanout: bool = True,
    with_products: bool = True,
) -> DataFrame:
    """One row per active customer with order, preference and address columns.

    ``with_products=False`` leaves the two preference arrays out for callers that do
    not read them, and with them the join of items and products.
    """
    totals = order_totals(orders, items, ["customer_id"], fanout).withColumnRenamed("customer_id", "k1")
    wide = customers.filter("is_active").join(totals, F.col("customer_id") == F.col("k1"), "left")
    if with_products:
        liked = customer_products(orders, items, products).withColumnRenamed("customer_id", "k2")
        wide = wide.join(liked, F.col("customer_id") == F.col("k2"), "left")
    none = F.array().cast("array<string>")
    arrays = ("preferred_categories", "purchased_products") if with_products else ()
    return wide.withColumn("place", F.from_json("address", ADDRESS)).select(
        "customer_id",
        "customer_name",
        "email",
        "phone",
        "customer_tier",
        dbl(F.col("lifetime_value")).alias("lifetime_value"),
        "is_active",
        F.col("created_at").alias("customer_since"),
        F.col("tags").alias("customer_tags"),
        "profile_score",
        F.coalesce("orders", F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce(dbl(F.col("amount")), F.lit(0.0)).alias("total_spent"),
        F.coalesce(mean(F.col("amount"), F.col("weight")), F.lit(0.0)).alias("avg_order_value"),
        F.col("last_date").alias("last_order_date"),
        F.col("first_date").alias("first_order_date"),
        *[F.coalesce(a, none).alias(a) for a in arrays],
        F.datediff(as_date(as_of), F.col("last_date")).alias("days_since_last_order"),
        customer_status(F.col("last_date"), as_of).alias("customer_status"),
        F.col("place.street").alias("street"),
        F.col("place.city").alias("city"),
        F.col("place.state").alias("state"),
        F.col("place.zip").alias("zip_code"),
    )


def mode_of(value: str | Column, weight: str, where: Column | None = None) -> Column:
    """MODE from pre-summed weights: the heaviest value, the smallest one on a tie, NULLs left out."""
    v = F.col(value) if isinstance(value, str) else value
    counts = v.isNotNull() if where is None else v.isNotNull() & where
    return F.min_by(v, F.when(counts, F.struct(-F.col(weight), v)))


def most_frequent(df: DataFrame, group: str, value: str, weight: str, out: str) -> DataFrame:
    summed = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.sum(weight).alias("w"))
    return summed.groupBy(group).agg(mode_of(value, "w").alias(out))


def product_modes(per_product: DataFrame) -> DataFrame:
    """Distinct products and the modes of name and category per month, in one pass.

    Each (month, product) row gives one entry for its name and one for its category,
    so the join below it is computed once for all three results.
    """
    kinds = F.array(
        F.struct(F.lit("name").alias("kind"), F.col("product_name").alias("v")),
        F.struct(F.lit("category").alias("kind"), F.col("category").alias("v")),
    )
    summed = (
        per_product.select("month", "n", F.explode(kinds).alias("e"))
        .groupBy("month", "e.kind", "e.v")
        .agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("products"))
    )
    is_name = F.col("kind") == "name"
    return summed.groupBy("month").agg(
        F.sum(F.when(is_name, F.col("products"))).alias("unique_products_sold"),
        mode_of("v", "w", is_name).alias("top_selling_product"),
        mode_of("v", "w", ~is_name).alias("top_selling_category"),
    )


def sales_performance(
    orders: DataFrame, items: DataFrame, products: DataFrame, customers: DataFrame, fanout: bool = True
) -> DataFrame:
    """Monthly sales of sold orders with modes and month-over-month growth.

    Months are few and one may hold most rows, so nothing is grouped by month
    before it has been grouped by (month, customer) or (month, product).
    """
    kept = (
        sold(orders)
        .join(customers.select("customer_id", "customer_tier"), "customer_id")
        .withColumn("month", F.trunc("order_date", "month"))
    )
    known = items.join(products.select("product_id"), "product_id", "left_semi")
    fans = known.groupBy("order_id").agg(F.count(F.lit(1)).alias("fan"), F.sum("quantity").alias("qty"))
    w = F.col("fan") if fanout else F.lit(1)
    per_customer = (
        kept.join(fans, "order_id")
        .groupBy("month", "customer_id", "customer_tier")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum(money(F.col("total_amount")) * w).alias("revenue"),
            F.sum(money(F.col("discount_amount")) * w).alias("discounts"),
            F.sum(money(F.col("tax_amount")) * w).alias("tax"),
            F.sum(w).alias("weight"),
            F.sum("fan").alias("rows"),
            F.sum("qty").alias("qty"),
        )
    )
    figures = ("orders", "customers", "revenue", "discounts", "tax", "weight", "rows", "qty")
    per_tier = per_customer.groupBy("month", "customer_tier").agg(
        F.count("customer_id").alias("customers"), *[F.sum(c).alias(c) for c in figures if c != "customers"]
    )
    months = per_tier.groupBy("month").agg(
        *[F.sum(c).alias(c) for c in figures], mode_of("customer_tier", "rows").alias("dominant_customer_tier")
    )
    per_product = (
        items.select("order_id", "product_id")
        .join(kept.select("order_id", "month"), "order_id")
        .groupBy("month", "product_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(products.select("product_id", "product_name", "category"), "product_id")
    )
    wide = months.join(product_modes(per_product), "month", "left")
    return growth(
        wide.select(
            F.col("month").alias("sales_month"),
            F.trunc("month", "quarter").alias("sales_quarter"),
            F.trunc("month", "year").alias("sales_year"),
            F.col("orders").alias("total_orders"),
            F.col("customers").alias("unique_customers"),
            F.col("revenue"),
            mean(F.col("revenue"), F.col("weight")).alias("avg_order_value"),
            dbl(F.col("discounts")).alias("total_discounts"),
            dbl(F.col("tax")).alias("total_tax"),
            "unique_products_sold",
            F.col("qty").alias("total_items_sold"),
            "top_selling_product",
            "top_selling_category",
            "dominant_customer_tier",
        ),
        "sales_month",
        "revenue",
    ).withColumn("revenue", dbl(F.col("revenue"))).withColumnRenamed("revenue", "total_revenue")


def growth(monthly: DataFrame, month: str, revenue: str) -> DataFrame:
    """LAG, difference and percent over the month rows (bounded by the calendar)."""
    prev = F.lag(revenue, 1).over(Window.orderBy(month))
    return (
        monthly.withColumn("prev", prev)
        .withColumn("prev_month_revenue", dbl(F.col("prev")))
        .withColumn("revenue_growth", dbl(F.col(revenue) - F.col("prev")))
        .withColumn("revenue_growth_pct", pct(F.col(revenue) - F.col("prev"), F.col("prev")))
        .drop("prev")
    )


def product_sales(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales measures per product.

    Item measures go (product, order) -> product without touching orders; customer
    measures go through the join and (product, customer) -> product.  Both first
    steps are combined before their shuffle or may be split by Spark, so neither a
    best-seller, nor one huge order, nor one huge customer ends up in one task.
    """
    per_order = items.groupBy("product_id", "order_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("quantity").alias("qty"),
        F.sum(money(F.col("total_price"))).alias("revenue"),
    )
    sales = per_order.groupBy("product_id").agg(
        F.count("order_id").alias("orders_containing_product"),
        F.sum("qty").alias("total_quantity_sold"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("rows").alias("item_rows"),
    )
    bought = (
        items.select("order_id", "product_id")
        .join(orders.select("order_id", "customer_id", "order_date"), "order_id")
        .groupBy("product_id", "customer_id")
        .agg(F.min("order_date").alias("first_sale"), F.max("order_date").alias("last_sale"))
    )
    tiers = customers.select("customer_id", "customer_tier")
    buyers = (
        bought.join(tiers, "customer_id", "left")
        .groupBy(F.col("product_id").alias("__p"))
        .agg(
            F.count("customer_id").alias("unique_customers"),
            F.count(F.when(F.col("customer_tier") == "ENTERPRISE", F.col("customer_id"))).alias(
                "enterprise_customers"
            ),
            F.min("first_sale").alias("first_sale_date"),
            F.max("last_sale").alias("last_sale_date"),
        )
    )
    return sales.join(buyers, F.col("product_id") == F.col("__p"), "left").drop("__p")


def product_base(
    products: DataFrame, items: DataFrame, orders: DataFrame, customers: DataFrame
) -> DataFrame:
    """Active products with their sales measures, unranked."""
    measures = product_sales(items, orders, customers).withColumnRenamed("product_id", "k")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return (
        products.filter("is_active")
        .join(measures, F.col("product_id") == F.col("k"), "left")
        .select(
            "product_id",
            "product_name",
            "category",
            "price",
            "cost",
            dbl(F.col("price") - F.col("cost")).alias("gross_margin"),
            pct(F.col("price") - F.col("cost"), F.col("price")).alias("margin_percentage"),
            zero("orders_containing_product"),
            "total_quantity_sold",
            "total_revenue",
            mean(F.col("total_quantity_sold"), F.col("item_rows")).alias("avg_quantity_per_order"),
            zero("unique_customers"),
            zero("enterprise_customers"),
            "first_sale_date",
            "last_sale_date",
            F.datediff("last_sale_date", "first_sale_date").alias("sale_period_days"),
            "inventory_count",
            json_text(F.col("supplier_info"), "vendor").alias("vendor"),
            json_text(F.col("supplier_info"), "support_level").alias("support_level"),
        )
    )


def product_performance(
    products: DataFrame, items: DataFrame, orders: DataFrame, customers: DataFrame
) -> DataFrame:
    """Product sales with revenue, quantity and category ranks (unsold products rank first)."""
    base, rows = settle_counted(product_base(products, items, orders, customers))
    ranks = (
        ("total_revenue", "revenue_rank", ()),
        ("total_quantity_sold", "quantity_rank", ()),
        ("total_revenue", "category_revenue_rank", ("category",)),
    )
    ranked = base
    for value, out, within in ranks:
        ranked = add_rank(ranked, base, "product_id", value, out, within, rows)
    return ranked.withColumns({c: dbl(F.col(c)) for c in ("price", "cost", "total_revenue")})


def add_rank(
    df: DataFrame, base: DataFrame, key: str, value: str, out: str, within: Sequence[str] = (), rows: int | None = None,
) -> DataFrame:
    """Adds a rank over the settled ``base``, joined back by key."""
    ranks = rank_desc(base.select(key, value, *within), value, out, within, rows)
    return df.join(ranks.select(key, out), key, "left")


def job_monitoring(jobs: DataFrame, as_of: str) -> DataFrame:
    """One row per job: a pure projection."""
    now = ntz(as_of)
    health = (
        F.when(F.col("status") == "COMPLETED", "Success")
        .when((F.col("status") == "FAILED") & (F.col("retry_count") >= F.col("max_retries")), "Failed (Max Retries)")
        .when(F.col("status") == "FAILED", "Failed (Will Retry)")
        .when((F.col("status") == "RUNNING") & (boundaries("HOUR", F.col("created_at"), now) > 2), "Long Running")
        .when(F.col("status") == "RUNNING", "In Progress")
        .otherwise(F.col("status"))
    )
    extra = {
        "report_type": ("input_data", "report_type"),
        "date_range": ("input_data", "date_range"),
        "output_format": ("input_data", "format"),
        "schedule_type": ("metadata", "schedule"),
        "requesting_department": ("metadata", "department"),
    }
    return jobs.select(
        "job_id",
        "job_name",
        "job_type",
        "status",
        "created_by",
        "created_at",
        "updated_at",
        dbl(F.col("execution_time_seconds")).alias("execution_time_seconds"),
        "priority",
        "retry_count",
        "max_retries",
        "error_message",
        boundaries("MINUTE", F.col("created_at"), F.coalesce(F.col("updated_at"), now)).alias(
            "total_runtime_minutes"
        ),
        health.alias("job_health_status"),
        *[json_text(F.col(doc), key).alias(name) for name, (doc, key) in extra.items()],
        hour_floor(F.col("created_at")).alias("created_hour"),
        F.to_date("created_at").alias("created_date"),
    )


def year_range(column: Column, year: int) -> Column:
    """A year predicate as a half-open range, so that it is pushed to the scan."""
    return (column >= ntz(f"{year}-01-01 00:00:00")) & (column < ntz(f"{year + 1}-01-01 00:00:00"))


def executive_dashboard(
    customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame, jobs: DataFrame, as_of: str
) -> DataFrame:
    """One row of year-to-date and job figures: one conditional aggregate per table."""
    year = int(as_of[:4])
    this_year = year_range(F.col("order_date"), year)
    last_year = year_range(F.col("order_date"), year - 1)
    is_sold = F.col("status").isin(*SOLD)
    # Two calendar years are enough for every order figure; the range is pushed down.
    recent = orders.filter(this_year | last_year)
    per_customer = recent.groupBy("customer_id").agg(
        F.sum(F.when(this_year & is_sold, money(F.col("total_amount")))).alias("ytd"),
        F.count_if(this_year & is_sold).alias("ytd_n"),
        F.sum(F.when(last_year & is_sold, money(F.col("total_amount")))).alias("last"),
        F.count_if(this_year).alias("any_n"),
    )
    order_figures = per_customer.agg(
        dbl(F.sum("ytd")).alias("ytd_revenue"),
        dbl(F.sum("last")).alias("last_year_revenue"),
        F.count(F.when(F.col("any_n") > 0, F.col("customer_id"))).alias("customers_with_orders_ytd"),
        F.coalesce(F.sum("ytd_n"), F.lit(0)).alias("orders_ytd"),
        mean(F.sum("ytd"), F.sum("ytd_n")).alias("avg_order_value_ytd"),
    )
    active = (
        customers.filter("is_active").groupBy("customer_id").agg(F.lit(1).alias("one"))
        .agg(F.count("customer_id").alias("total_active_customers"))
    )
    active_products = products.filter("is_active").agg(F.count(F.lit(1)).alias("active_products"))
    sold_products = (
        items.select("order_id", "product_id")
        .join(orders.filter(this_year).select("order_id"), "order_id", "left_semi")
        .select("product_id")
        .distinct()
        .agg(F.count("product_id").alias("products_sold_ytd"))
    )
    start = ntz(as_of[:10] + " 00:00:00")
    today = (F.col("created_at") >= start) & (F.col("created_at") < start + F.expr("interval 1 day"))
    job_figures = jobs.filter(today).agg(
        F.count(F.lit(1)).alias("jobs_today"),
        F.count_if(F.col("status") == "COMPLETED").alias("jobs_completed_today"),
        F.count_if(F.col("status") == "FAILED").alias("jobs_failed_today"),
    )
    return (
        order_figures.crossJoin(active)
        .crossJoin(active_products)
        .crossJoin(sold_products)
        .crossJoin(job_figures)
        .select(
            as_date(as_of).alias("report_date"),
            F.lit("YTD").alias("period_type"),
            "ytd_revenue",
            "last_year_revenue",
            "total_active_customers",
            "customers_with_orders_ytd",
            "active_products",
            "products_sold_ytd",
            "orders_ytd",
            "avg_order_value_ytd",
            "jobs_today",
            "jobs_completed_today",
            "jobs_failed_today",
        )
    )


def error_health(errors: Column, warn_above: int = 0, bad_above: int = 5) -> Column:
    return F.when(errors > bad_above, "UNHEALTHY").when(errors > warn_above, "WARNING").otherwise("HEALTHY")


def operational_status(
    jobs: DataFrame,
    orders: DataFrame,
    metrics: DataFrame,
    as_of: str,
    orders_as_of: str | None = None,
    fanout: bool = True,
) -> DataFrame:
    """Counts and freshness over jobs × orders × metrics without building the product.

    The published view cross-joins three tables, so a count of one is multiplied
    by the sizes of the others and an empty table empties all of them; with
    ``fanout`` that is reproduced by arithmetic on one-row aggregates.
    """
    now, orders_now = ntz(as_of), ntz(orders_as_of or as_of)
    day, hour = F.expr("interval 24 hours"), F.expr("interval 1 hour")
    j = jobs.agg(
        F.count(F.lit(1)).alias("j_rows"),
        F.count_if(F.col("status") == "RUNNING").alias("running"),
        F.count_if(F.col("status") == "PENDING").alias("pending"),
        F.count_if((F.col("status") == "FAILED") & (F.col("retry_count") < F.col("max_retries"))).alias("retrying"),
        F.count_if(F.col("created_at") >= now - day).alias("j_recent"),
        F.max("updated_at").alias("j_last"),
        F.count_if((F.col("status") == "FAILED") & (F.col("created_at") >= now - hour)).alias("failed_hour"),
    )
    o = orders.agg(
        F.count(F.lit(1)).alias("o_rows"),
        F.count_if(F.col("order_date") >= orders_now - day).alias("o_recent"),
        F.max("order_date").alias("o_last"),
    )
    m = metrics.agg(F.count(F.lit(1)).alias("m_rows"), F.max("updated_at").alias("m_last"))
    one = j.crossJoin(o).crossJoin(m)
    if fanout:
        # Products of three counts pass 2^63 at scale.
        wide = lambda c: F.col(c).cast("decimal(38,0)")
        by_orders = (wide("o_rows") * F.col("m_rows")).cast("decimal(38,0)")
        by_jobs = (wide("j_rows") * F.col("m_rows")).cast("decimal(38,0)")
        filled = (F.col("j_rows") > 0) & (F.col("o_rows") > 0) & (F.col("m_rows") > 0)
    else:
        by_orders = by_jobs = F.lit(1).cast("decimal(38,0)")
        filled = F.lit(True)
    return one.select(
        now.alias("last_updated"),
        (F.col("running") * by_orders).cast("decimal(38,0)").alias("jobs_running"),
        (F.col("pending") * by_orders).cast("decimal(38,0)").alias("jobs_pending"),
        (F.col("retrying") * by_orders).cast("decimal(38,0)").alias("jobs_retrying"),
        (F.col("j_recent") * by_orders).cast("decimal(38,0)").alias("jobs_last_24h"),
        (F.col("o_recent") * by_jobs).cast("decimal(38,0)").alias("orders_last_24h"),
        F.when(filled, F.col("j_last")).alias("last_job_update"),
        F.when(filled, F.col("o_last")).alias("last_order_created"),
        F.when(filled, F.col("m_last")).alias("last_metrics_update"),
        error_health(F.col("failed_hour") * by_orders).alias("system_health_status"),
    )


def sales_summary(orders: DataFrame) -> DataFrame:
    """Monthly total and count of completed orders."""
    month = F.trunc("order_date", "month")
    return (
        orders.filter(F.col("status") == "COMPLETED")
        .groupBy(month.alias("month"))
        .agg(dbl(F.sum(money(F.col("total_amount")))).alias("total_sales"), F.count(F.lit(1)).alias("order_count"))
    )
