"""Metrics tables: daily figures, order processing and change-driven refreshes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import boundaries, dbl, mean, money, ntz, pct, ratio
from orderlens.operators.changes import change_feed
from orderlens.operators.ranking import rank_desc, tile
from orderlens.operators.upsert import upsert
from orderlens.plans.views import add_rank, as_date, customer_360, item_weights, sold
from orderlens.session import settle, settle_counted

# --- daily figures -----------------------------------------------------------


def daily_orders(orders: DataFrame, customers: DataFrame, items: DataFrame, fanout: bool = True) -> DataFrame:
    """Sold-order figures for every date in one pass.

    Dates are few and one may hold most rows: counts go (date, customer) -> date
    and (date, product) -> date, never straight to the date.
    """
    kept = sold(orders).select("order_id", "customer_id", F.to_date("order_date").alias("metric_date"), "total_amount")
    w = F.coalesce(F.col("fan"), F.lit(1)) if fanout else F.lit(1)
    members = customers.select("customer_id", F.to_date("created_at").alias("joined"))
    per_customer = (
        kept.join(item_weights(items), "order_id", "left")
        .groupBy("metric_date", "customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum(money(F.col("total_amount")) * w).alias("amount"),
            F.sum(w).alias("weight"),
        )
        .join(members, "customer_id")
    )
    figures = per_customer.groupBy("metric_date").agg(
        F.sum("amount").alias("amount"),
        F.sum("weight").alias("weight"),
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.count_if(F.col("joined") == F.col("metric_date")).alias("new_customers"),
        F.count_if(F.col("joined") < F.col("metric_date")).alias("returning_customers"),
    )
    products = (
        items.select("order_id", "product_id")
        .join(kept.join(members.select("customer_id"), "customer_id", "left_semi").select("order_id", "metric_date"), "order_id")
        .select("metric_date", "product_id")
        .distinct()
        .groupBy("metric_date")
        .agg(F.count("product_id").alias("products_sold"))
    )
    return figures.join(products, "metric_date", "left")


def daily_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(F.to_date("created_at").alias("job_date")).agg(
        F.count_if(F.col("status") == "COMPLETED").alias("jobs_completed"),
        F.count_if(F.col("status") == "FAILED").alias("jobs_failed"),
    )


# The literals the daily procedure writes.
TOP_PRODUCT, TOP_CATEGORY, HEALTH_SCORE = "Top Product", "Top Category", 0.95


def items_of(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items of the given orders only; few orders are broadcast by their size and filter
    the items where they are read."""
    return items.join(orders.select("order_id"), "order_id", "left_semi")


def daily_metrics(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    jobs: DataFrame,
    dates: Sequence[str] | None = None,
    fanout: bool = True,
) -> DataFrame:
    """Daily metrics for all dates, or for exactly the given ones (zero rows included).

    With ``dates`` the date range is pushed into both scans before anything is joined.
    """
    if dates is not None:
        def during(ts: str) -> Column:
            hit = F.lit(False)
            for d in dates:
                hit = hit | ((F.col(ts) >= ntz(d)) & (F.col(ts) < ntz(d) + F.expr("interval 1 day")))
            return hit

        orders, jobs = orders.filter(during("order_date")), jobs.filter(during("created_at"))
        items = items_of(items, orders)
    wide = _days(daily_orders(orders, customers, items, fanout), daily_jobs(jobs))
    if dates is not None:
        wanted = orders.sparkSession.createDataFrame([(d,) for d in dates], "wanted string")
        wanted = wanted.select(F.col("wanted").cast("date").alias("metric_date"))
        wide = wanted.join(wide, "metric_date", "left")
    return _daily_columns(wide)


def _days(figures: DataFrame, jobs: DataFrame) -> DataFrame:
    """Days that have orders or jobs."""
    return figures.join(jobs, F.col("metric_date") == F.col("job_date"), "full_outer").withColumn(
        "metric_date", F.coalesce("metric_date", "job_date")
    ).drop("job_date")


def daily_rows(figures: DataFrame, jobs: DataFrame) -> DataFrame:
    """Metric rows from figures of orders and jobs, however these were computed."""
    return _daily_columns(_days(figures, jobs))


def _daily_columns(wide: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return wide.select(
        "metric_date",
        F.coalesce(dbl(F.col("amount")), F.lit(0.0)).alias("total_revenue"),
        zero("total_orders"),
        zero("unique_customers"),
        zero("new_customers"),
        zero("returning_customers"),
        F.coalesce(mean(F.col("amount"), F.col("weight")), F.lit(0.0)).alias("average_order_value"),
        zero("products_sold"),
        F.lit(TOP_PRODUCT).alias("top_selling_product"),
        F.lit(TOP_CATEGORY).alias("top_selling_category"),
        zero("jobs_completed"),
        zero("jobs_failed"),
        F.lit(HEALTH_SCORE).alias("system_health_score"),
    )


def customer_totals(customers: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """The one analytics row of a day: sales over active customers, orders of that day."""
    active = customers.filter("is_active").select("customer_id")
    per_customer = orders.groupBy("customer_id").agg(
        F.sum(money(F.col("total_amount"))).alias("amount"), F.count(F.lit(1)).alias("n")
    )
    totals = active.join(per_customer, "customer_id", "left").agg(
        F.sum("amount").alias("amount"), F.sum("n").alias("n"), F.count("customer_id").alias("unique_customers")
    )
    start = ntz(as_of[:10])
    today = orders.filter((F.col("order_date") >= start) & (F.col("order_date") < start + F.expr("interval 1 day"))).agg(
        F.count(F.lit(1)).alias("total_orders")
    )
    return totals.crossJoin(today).select(
        F.lit("ANALYTICS_" + as_of[:10].replace("-", "")).alias("metric_id"),
        as_date(as_of).alias("metric_date"),
        F.coalesce(dbl(F.col("amount")), F.lit(0.0)).alias("total_sales"),
        "total_orders",
        "unique_customers",
        F.coalesce(mean(F.col("amount"), F.col("n")), F.lit(0.0)).alias("average_order_value"),
        F.lit("N/A").alias("top_product"),
        F.lit("Analytics").alias("top_category"),
    )


def daily_sales_metrics(metrics: DataFrame, customers: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """The metrics table after merging the day's analytics row by id."""
    row = customer_totals(customers, orders, as_of)
    named = ("total_sales", "total_orders", "unique_customers", "average_order_value")
    return upsert(
        metrics, row, ["metric_id"],
        update={c: (lambda t, s, c=c: s(c)) for c in named},
        check_source=False,
    )


# --- order processing --------------------------------------------------------


def process_orders_metrics(metrics: DataFrame, batch: DataFrame) -> DataFrame:
    """Daily sales rows after adding a batch of orders.

    The procedure adds one order at a time and sets the average from the values
    *before* the order, so the average lags one order behind and the first order
    of a new day stores itself.  That result has a closed form; ``_faithful``
    holds it, ``average_order_value`` the running average it should be.  The
    customer count stays as it was, as in the procedure.
    """
    amount = money(F.col("total_amount"))
    source = batch.groupBy(F.to_date("order_date").alias("metric_date")).agg(
        F.sum(amount).alias("add_sales"),
        F.count(F.lit(1)).alias("add_orders"),
        F.max_by(amount, F.col("order_id")).alias("last_amount"),
    )
    t = metrics.select(
        F.col("metric_date").alias("old_date"),
        money(F.col("total_sales")).alias("old_sales"),
        F.col("total_orders").alias("old_orders"),
        F.col("unique_customers").alias("old_customers"),
        dbl(F.col("average_order_value")).alias("old_average"),
    )
    both = t.join(source, F.col("old_date") == F.col("metric_date"), "full_outer")
    sales = F.coalesce(F.col("old_sales"), F.lit(0)) + F.coalesce(F.col("add_sales"), F.lit(0))
    orders = F.coalesce(F.col("old_orders"), F.lit(0)) + F.coalesce(F.col("add_orders"), F.lit(0))
    before_sales, before_orders = sales - F.col("last_amount"), orders - 1
    faithful = (
        F.when(F.col("add_orders").isNull(), F.col("old_average"))
        .when(before_orders == 0, dbl(F.col("last_amount")))
        .otherwise(ratio(before_sales, before_orders))
    )
    day = F.coalesce("metric_date", "old_date")
    return both.select(
        F.concat(F.lit("SM_"), F.date_format(day, "yyyyMMdd")).alias("metric_id"),
        day.alias("metric_date"),
        dbl(sales).alias("total_sales"),
        orders.alias("total_orders"),
        F.coalesce(F.col("old_customers"), F.lit(1)).cast("bigint").alias("unique_customers"),
        F.when(F.col("add_orders").isNull(), F.col("old_average")).otherwise(ratio(sales, orders)).alias("average_order_value"),
        faithful.alias("average_order_value_faithful"),
    )


def process_orders_customers(customers: DataFrame, batch: DataFrame) -> DataFrame:
    """Customers with the batch amounts added to their lifetime value."""
    source = batch.groupBy("customer_id").agg(F.sum(money(F.col("total_amount"))).alias("amount"))
    return upsert(
        customers, source, ["customer_id"],
        update={"lifetime_value": lambda t, s: t("lifetime_value") + s("amount")}, insert={}, check_source=False,
    )


# --- change-driven refreshes -------------------------------------------------


def segment(total: Column) -> Column:
    """Our segments by total spent (the reference leaves the formula open)."""
    return F.when(total >= 3_000_000, "VIP").when(total >= 1_000_000, "REGULAR").otherwise("OCCASIONAL")


def customer_analytics(
    customers: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame, as_of: str,
    with_categories: bool = True,
) -> DataFrame:
    """One analytics row per active customer.

    Our formulas: predicted value = spent + 3 mean orders; churn risk = days since
    the last order over 180, at most 1, and 1 without orders.
    """
    view = customer_360(customers, orders, items, products, as_of, fanout=False, with_products=with_categories)
    return analytics_rows(view, as_of, with_categories)


def analytics_rows(view: DataFrame, as_of: str, with_categories: bool = True) -> DataFrame:
    """Analytics rows from a customer's totals, however these were computed."""
    risk = F.coalesce(F.least(F.lit(1.0), F.col("days_since_last_order") / F.lit(180.0)), F.lit(1.0))
    columns = [
        "customer_id",
        as_date(as_of).alias("analysis_date"),
        "total_orders",
        "total_spent",
        "avg_order_value",
        "days_since_last_order",
        "customer_status",
        (F.col("total_spent") + 3 * F.col("avg_order_value")).alias("predicted_ltv"),
        F.round(risk, 2).alias("churn_risk_score"),
        segment(F.col("total_spent")).alias("customer_segment"),
    ]
    if with_categories:
        columns.append(F.array_join("preferred_categories", "|").alias("preferred_categories"))
    return view.select(*columns)


def changed_customers(customers_feed: DataFrame | None, orders_feed: DataFrame | None) -> DataFrame:
    """Distinct customers named by either feed."""
    parts = [f.select("customer_id") for f in (customers_feed, orders_feed) if f is not None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("customer_id IS NOT NULL").distinct()


def refresh_customer_analytics(
    target: DataFrame, changed: DataFrame, customers: DataFrame, orders: DataFrame, items: DataFrame,
    products: DataFrame, as_of: str, with_categories: bool = True,
) -> DataFrame:
    """Recomputes only the changed customers and merges them.

    The key list filters customers and orders first, items by the orders that are
    left, so the work follows the size of the change.
    """
    some = customers.join(changed, "customer_id", "left_semi")
    their = orders.join(changed, "customer_id", "left_semi")
    fresh = customer_analytics(some, their, items_of(items, their), products, as_of, with_categories)
    return upsert(target, fresh, ["customer_id"], check_source=False)


def product_analytics(products: DataFrame, items: DataFrame, as_of: str) -> DataFrame:
    """One analytics row per active product, by ship date.

    Our formulas: turnover = quantity over stock; trend = sign of the last 30 days'
    revenue against the 30 before; season = this calendar month's share of revenue
    times twelve; recommendation from trend and stock.
    """
    end = ntz(as_of)
    month = int(as_of[5:7])
    since = lambda days: end - F.expr(f"interval {days} days")
    amount = money(F.col("total_price"))
    in_month = F.month("ship_date") == month
    sums = items.filter(F.col("ship_date") < end).groupBy("product_id").agg(
        F.sum("quantity").alias("quantity"),
        F.sum(amount).alias("revenue"),
        F.sum(F.when(F.col("ship_date") >= since(30), amount)).alias("last30"),
        F.sum(F.when((F.col("ship_date") >= since(60)) & (F.col("ship_date") < since(30)), amount)).alias("prior30"),
        F.sum(F.when(in_month, amount)).alias("in_month"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    trend = (
        F.when(zero("last30") > zero("prior30"), "UP").when(zero("last30") < zero("prior30"), "DOWN").otherwise("FLAT")
    )
    wide = products.filter("is_active").join(sums.withColumnRenamed("product_id", "k"), F.col("product_id") == F.col("k"), "left")
    return wide.withColumn("demand_trend", trend).select(
        "product_id",
        as_date(as_of).alias("analysis_date"),
        zero("quantity").cast("bigint").alias("total_quantity_sold"),
        dbl(zero("revenue")).alias("total_revenue"),
        pct(F.col("price") - F.col("cost"), F.col("price")).alias("profit_margin"),
        ratio(zero("quantity"), F.col("inventory_count")).alias("inventory_turnover"),
        "demand_trend",
        ratio(zero("in_month") * 12, zero("revenue")).alias("seasonality_factor"),
        F.when((F.col("demand_trend") == "UP") & (F.col("inventory_count") < 10), "RESTOCK")
        .when((F.col("demand_trend") == "DOWN") & (F.col("inventory_count") > 40), "PROMOTE")
        .otherwise("KEEP")
        .alias("recommendation"),
    )


def refresh_product_analytics(
    target: DataFrame, changed: DataFrame, products: DataFrame, items: DataFrame, as_of: str
) -> DataFrame:
    some = products.join(changed, "product_id", "left_semi")
    theirs = items.join(changed, "product_id", "left_semi")
    return upsert(target, product_analytics(some, theirs, as_of), ["product_id"], check_source=False)


def affected_dates(before: DataFrame, after: DataFrame) -> DataFrame:
    """Dates touched by any change of an order, on its old or its new date."""
    feed = change_feed(before, after, ["order_id"])
    return feed.select(F.to_date("order_date").alias("metric_date")).distinct()


def refresh_daily_metrics(
    target: DataFrame, dates: DataFrame, orders: DataFrame, customers: DataFrame, items: DataFrame, jobs: DataFrame
) -> DataFrame:
    """Daily metrics with the affected dates recomputed.  The date list is at most the calendar."""
    some = orders.withColumn("metric_date", F.to_date("order_date")).join(dates, "metric_date", "left_semi").drop("metric_date")
    jobs_some = jobs.join(dates, F.to_date("created_at") == F.col("metric_date"), "left_semi")
    fresh = daily_metrics(some, customers, items_of(items, some), jobs_some)
    return upsert(target, fresh, ["metric_date"], check_source=False)


def order_analytics(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Margin and size class per order (class limits are ours)."""
    priced = items.join(products.select("product_id", "cost"), "product_id")
    per_order = priced.groupBy("order_id").agg(
        F.sum(money(F.col("total_price"))).alias("revenue"),
        F.sum(F.col("cost") * F.col("quantity")).alias("costs"),
        F.count(F.lit(1)).alias("n_items"),
    )
    total = F.col("total_amount")
    return orders.join(per_order, "order_id", "left").select(
        "order_id",
        "customer_id",
        "order_date",
        dbl(total).alias("total_amount"),
        pct(F.col("revenue") - F.col("costs"), F.col("revenue")).alias("profit_margin"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.when(total >= 300000, "LARGE").when(total >= 100000, "MEDIUM").otherwise("SMALL").alias("order_size_category"),
    )


def product_tiers(products: DataFrame, items: DataFrame) -> DataFrame:
    """Sales, mean sale price, margin and revenue quartile per product."""
    sums = items.groupBy("product_id").agg(
        F.sum("quantity").alias("quantity"),
        F.sum(money(F.col("total_price"))).alias("revenue"),
        F.count(F.lit(1)).alias("n"),
    )
    base, rows = settle_counted(
        products.select("product_id", "product_name", "price", "cost").join(sums, "product_id", "left")
    )
    ranked = rank_desc(base, "revenue", "__rank", rows=rows).withColumn("__total", F.lit(rows))
    names = F.array(*map(F.lit, ("PLATINUM", "GOLD", "SILVER", "BRONZE")))
    return ranked.select(
        "product_id",
        "product_name",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("total_sales"),
        F.coalesce("quantity", F.lit(0)).cast("bigint").alias("total_quantity_sold"),
        ratio(F.col("revenue"), F.col("quantity")).alias("avg_sale_price"),
        pct(F.col("price") - F.col("cost"), F.col("price")).alias("profit_margin"),
        F.element_at(names, tile("__rank", "__total", 4)).alias("performance_tier"),
    )


# --- composites --------------------------------------------------------------


def daily_job(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame, jobs: DataFrame,
    metrics: DataFrame, as_of: str,
) -> dict[str, DataFrame]:
    """The daily run: yesterday's metrics, the quality suite and the analytics merge."""
    from datetime import date, timedelta

    from orderlens.plans import quality

    yesterday = (date.fromisoformat(as_of[:10]) - timedelta(days=1)).isoformat()
    rules = quality.standard_rules(customers, orders, items, products, as_of)
    return {
        "daily_metrics": daily_metrics(orders, customers, items, jobs, [yesterday]),
        "quality": quality.run_rules(rules, as_of),
        "sales_metrics": daily_sales_metrics(metrics, customers, orders, as_of),
    }


def daily_job_summary(results: dict[str, DataFrame]) -> DataFrame:
    """What the run produced, one row per step."""
    m = results["daily_metrics"].select(
        F.lit("daily_metrics").alias("step"), F.col("total_orders").alias("items"), F.col("total_revenue").alias("value")
    )
    q = results["quality"].agg(
        F.lit("quality").alias("step"), F.count(F.lit(1)).alias("items"), dbl(F.count_if(F.col("status") == "FAIL")).alias("value")
    )
    s = results["sales_metrics"].agg(
        F.lit("sales_metrics").alias("step"), F.count(F.lit(1)).alias("items"), dbl(F.sum(money(F.col("total_sales")))).alias("value")
    )
    return m.unionByName(q).unionByName(s)


# --- trends and cohorts ------------------------------------------------------


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Customers of each first-order month still ordering k months later.

    (customer, month) pairs are made distinct first, so what a customer adds is
    bounded by the calendar.
    """
    active = orders.select("customer_id", F.trunc("order_date", "month").alias("month")).distinct()
    first = orders.groupBy("customer_id").agg(F.trunc(F.min("order_date"), "month").alias("cohort_month"))
    offset = boundaries("MONTH", F.col("cohort_month"), F.col("month"))
    return (
        active.join(first, "customer_id")
        .groupBy("cohort_month", offset.alias("months_since"))
        .agg(F.count("customer_id").alias("customers"))
    )


def trend_slope(orders: DataFrame, months: int = 3) -> DataFrame:
    """Least-squares slope of the last ``months`` monthly revenues up to each month.

    With equally spaced months the slope of three points is (last - first) / 2;
    the general form is a weighted sum over the window.
    """
    from pyspark.sql import Window

    monthly = orders.groupBy(F.trunc("order_date", "month").alias("month")).agg(
        F.sum(money(F.col("total_amount"))).alias("revenue")
    )
    recent = Window.orderBy("month").rowsBetween(-(months - 1), 0)
    middle = (months - 1) / 2
    spread = sum((i - middle) ** 2 for i in range(months))
    values = F.collect_list(dbl(F.col("revenue"))).over(recent)
    weighted = F.aggregate(
        F.transform("v", lambda x, i: x * (i - F.lit(middle))), F.lit(0.0), lambda a, x: a + x
    )
    return monthly.withColumn("v", values).select(
        "month",
        dbl(F.col("revenue")).alias("revenue"),
        F.when(F.size("v") == months, F.round(weighted / spread, 4)).alias("slope"),
    )


def rfm_segments(customers: DataFrame, orders: DataFrame, as_of: str, tiles: int = 5) -> DataFrame:
    """Recency, frequency and value tiles per customer from global ranks (ties share a tile)."""
    sums = orders.groupBy("customer_id").agg(
        F.max("order_date").alias("last"), F.count(F.lit(1)).alias("frequency"), F.sum(money(F.col("total_amount"))).alias("value")
    )
    recency = F.datediff(as_date(as_of), F.col("last"))
    base, rows = settle_counted(
        customers.select("customer_id").join(sums, "customer_id").select(
            "customer_id", recency.alias("recency"), "frequency", "value"
        )
    )
    out = base
    for measure in ("recency", "frequency", "value"):
        out = add_rank(out, base, "customer_id", measure, f"__{measure}", (), rows)
    out = out.withColumn("__total", F.lit(rows))
    # Recency counts days, so the largest value is the worst tile; the others are turned round.
    r = tile("__recency", "__total", tiles)
    f = F.lit(tiles + 1) - tile("__frequency", "__total", tiles)
    m = F.lit(tiles + 1) - tile("__value", "__total", tiles)
    return out.select(
        "customer_id",
        "recency",
        "frequency",
        dbl(F.col("value")).alias("value"),
        r.alias("r_score"),
        f.cast("int").alias("f_score"),
        m.cast("int").alias("m_score"),
        F.when((r >= 4) & (f >= 4) & (m >= 4), "CHAMPION").when(r <= 2, "AT_RISK").otherwise("REGULAR").alias("segment"),
    )


FEATURES = ("recency", "frequency", "cents")


def customer_clusters(customers: DataFrame, orders: DataFrame, as_of: str, clusters: int = 4, rounds: int = 6) -> DataFrame:
    """Customers grouped by Lloyd's rounds over scaled recency, frequency and lifetime value.

    Nothing is drawn by chance: the first centres lie on the value axis, one standard
    deviation apart around the mean, and sums are exact integers, so that the rounds give the
    same groups anywhere.  A round is a projection (the centres are literals) and one
    aggregate of ``clusters`` rows; a centre without customers stays where it is, and equal
    distances go to the smaller number.
    """
    sums = orders.groupBy("customer_id").agg(F.max("order_date").alias("last"), F.count(F.lit(1)).alias("frequency"))
    features = settle(customers.filter("lifetime_value IS NOT NULL").join(sums, "customer_id").select(
        "customer_id", F.datediff(as_date(as_of), F.col("last")).cast("long").alias("recency"), "frequency",
        (money(F.col("lifetime_value")) * 100).cast("long").alias("cents"),
    ))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    totals = features.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(wide(c)).alias(f"s_{c}") for c in FEATURES], *[F.sum(F.col(c) * wide(c)).alias(f"q_{c}") for c in FEATURES]
    ).first()
    n = totals["n"]
    means = {c: float(totals[f"s_{c}"]) / n if n else 0.0 for c in FEATURES}
    spread = {c: max((float(totals[f"q_{c}"]) / n - means[c] ** 2) if n else 0.0, 0.0) ** 0.5 or 1.0 for c in FEATURES}
    centres = [[0.0, 0.0, k - (clusters - 1) / 2] for k in range(clusters)]

    def nearest() -> Column:
        apart = [
            F.struct(sum((((F.col(c) - F.lit(means[c])) / F.lit(spread[c]) - F.lit(m)) ** 2 for c, m in zip(FEATURES, centre)), F.lit(0.0)).alias("d"), F.lit(k).alias("k"))
            for k, centre in enumerate(centres)
        ]
        return F.array_min(F.array(*apart))["k"]

    for _ in range(rounds):
        found = features.groupBy(nearest().alias("k")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(wide(c)).alias(c) for c in FEATURES]).collect()
        for r in found:
            centres[r["k"]] = [(float(r[c]) / r["n"] - means[c]) / spread[c] for c in FEATURES]
    return features.select(
        "customer_id", dbl(F.col("recency")).alias("recency"), dbl(F.col("frequency")).alias("frequency"), (F.col("cents") / F.lit(100.0)).alias("lifetime_value"), nearest().alias("cluster"))
