"""Scalar function families and SQL functions on the given tables."""

from pyspark.sql import functions as F

from orderlens.functions import boundaries, dbl, hour_floor, json_text, ntz, pct, time_floor
from orderlens.functions.sql import define_functions
from orderlens.plans.questions import FAMILIES, mentions
from orderlens.suite.registry import JOBS_AS_OF, query

NOW = f"TIMESTAMP '{JOBS_AS_OF}'"


@query("scalar_date", f"""
    SELECT job_id, {NOW}::DATE AS today, {NOW} AS now_ts,
        date_trunc('hour', created_at) AS hour, created_at::DATE AS day, date_trunc('month', created_at)::DATE AS month,
        date_trunc('quarter', created_at)::DATE AS quarter, date_trunc('year', created_at)::DATE AS year_start,
        date_diff('day', created_at::DATE, {NOW}::DATE)::INTEGER AS age_days,
        date_diff('minute', created_at, {NOW}) AS age_minutes, date_diff('hour', created_at, {NOW}) AS age_hours,
        date_diff('second', created_at, {NOW}) AS age_seconds,
        created_at + INTERVAL 10 MINUTE AS plus_minutes, created_at - INTERVAL 24 HOUR AS minus_hours,
        created_at::DATE - 1 AS day_before, created_at::DATE - 7 AS week_before,
        (created_at::DATE + INTERVAL 1 MONTH)::DATE AS plus_month, (created_at::DATE - INTERVAL 11 MONTH)::DATE AS minus_months,
        year(created_at)::INTEGER AS year_no, strftime(created_at, '%Y%m%d') AS ymd, strftime(created_at, '%Y%m%d%H%M%S') AS ymdhms,
        strftime(created_at, '%Y-%m-%d %H:%M:%S') AS readable, created_at::DATE::VARCHAR AS day_text,
        strftime(created_at, '%Y%m%d')::INTEGER AS day_key
    FROM a_jobs""")
def _(t):
    at, now = F.col("created_at"), ntz(JOBS_AS_OF)
    day = F.to_date(at)
    return t.jobs.select(
        "job_id",
        F.to_date(now).alias("today"),
        now.alias("now_ts"),
        hour_floor(at).alias("hour"),
        F.to_date(time_floor("day", at)).alias("day"),
        F.trunc(at, "month").alias("month"),
        F.trunc(at, "quarter").alias("quarter"),
        F.trunc(at, "year").alias("year_start"),
        F.datediff(F.to_date(now), day).alias("age_days"),
        boundaries("MINUTE", at, now).alias("age_minutes"),
        boundaries("HOUR", at, now).alias("age_hours"),
        boundaries("SECOND", at, now).alias("age_seconds"),
        (at + F.expr("interval 10 minutes")).alias("plus_minutes"),
        (at - F.expr("interval 24 hours")).alias("minus_hours"),
        F.date_add(day, -1).alias("day_before"),
        F.date_sub(day, 7).alias("week_before"),
        F.add_months(day, 1).alias("plus_month"),
        F.add_months(day, -11).alias("minus_months"),
        F.year(at).alias("year_no"),
        F.date_format(at, "yyyyMMdd").alias("ymd"),
        F.date_format(at, "yyyyMMddHHmmss").alias("ymdhms"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("readable"),
        day.cast("string").alias("day_text"),
        F.date_format(at, "yyyyMMdd").cast("int").alias("day_key"),
    )


@query("scalar_conditional", """
    SELECT job_id, CASE WHEN status = 'FAILED' AND retry_count >= max_retries THEN 'dead' WHEN status = 'FAILED' THEN 'retry' ELSE 'fine' END AS searched,
        CASE status WHEN 'COMPLETED' THEN 1.0 WHEN 'RUNNING' THEN 0.5 ELSE 0.0 END::DOUBLE AS simple,
        coalesce(error_message, date_range, 'none') AS first_known, nullif(retry_count, 0) AS no_zero,
        updated_at IS NULL AS unfinished, status IN ('PENDING', 'RUNNING') AS open,
        NOT (status = 'FAILED' OR retry_count > 2) AND priority < 3 AS healthy
    FROM a_jobs""")
def _(t):
    status = F.col("status")
    return t.jobs.select(
        "job_id",
        F.when((status == "FAILED") & (F.col("retry_count") >= F.col("max_retries")), "dead")
        .when(status == "FAILED", "retry")
        .otherwise("fine")
        .alias("searched"),
        F.when(status == "COMPLETED", 1.0).when(status == "RUNNING", 0.5).otherwise(0.0).alias("simple"),
        F.coalesce("error_message", json_text(F.col("input_data"), "date_range"), F.lit("none")).alias("first_known"),
        F.nullif(F.col("retry_count"), F.lit(0)).alias("no_zero"),
        F.col("updated_at").isNull().alias("unfinished"),
        status.isin("PENDING", "RUNNING").alias("open"),
        (~((status == "FAILED") | (F.col("retry_count") > 2)) & (F.col("priority") < 3)).alias("healthy"),
    )


@query("scalar_math", """
    SELECT product_id, round(price * 0.333::DECIMAL(4,3), 2)::DOUBLE AS rounded, (price + cost)::DOUBLE AS added,
        (price - cost)::DOUBLE AS gap, (price * cost)::DOUBLE AS product,
        round((price - cost)::DOUBLE / nullif(price::DOUBLE, 0) * 100, 2) AS margin,
        'METRIC_' || substr(md5(product_id::VARCHAR), 1, 12) AS stable_id
    FROM a_products""")
def _(t):
    price, cost = F.col("price"), F.col("cost")
    return t.products.select(
        "product_id",
        dbl(F.round(price * F.lit("0.333").cast("decimal(4,3)"), 2)).alias("rounded"),
        dbl(price + cost).alias("added"),
        dbl(price - cost).alias("gap"),
        dbl(price * cost).alias("product"),
        pct(price - cost, price).alias("margin"),
        F.concat(F.lit("METRIC_"), F.substring(F.md5(F.col("product_id").cast("string")), 1, 12)).alias("stable_id"),
    )


@query("scalar_string", """
    SELECT customer_id, 'Customer ' || customer_id || ' has ' || lifetime_value AS sentence, email || '!' AS null_absorbs,
        replace(phone, '-', '_') AS replaced, split_part('Job created: ' || customer_id, ': ', 2) AS part_two,
        contains(lower(customer_name), 'customer') OR contains(lower(customer_name), 'client') AS about_customer,
        customer_name LIKE '%#00000000%' AS low_name, regexp_full_match(phone, '\\+1-555-[0-9]+') AS good_phone,
        upper(customer_tier) AS tier, replace(replace('Hi {name}, your tier is {tier}', '{name}', customer_name), '{tier}', customer_tier) AS filled
    FROM a_customers""")
def _(t):
    phone, name, tier = F.col("phone"), F.col("customer_name"), F.col("customer_tier")
    key = F.col("customer_id").cast("string")
    filled = F.replace(F.lit("Hi {name}, your tier is {tier}"), F.lit("{name}"), name)
    return t.customers.select(
        "customer_id",
        F.concat(F.lit("Customer "), key, F.lit(" has "), F.col("lifetime_value").cast("string")).alias("sentence"),
        F.concat(F.col("email"), F.lit("!")).alias("null_absorbs"),
        F.replace(phone, F.lit("-"), F.lit("_")).alias("replaced"),
        F.split_part(F.concat(F.lit("Job created: "), key), F.lit(": "), F.lit(2)).alias("part_two"),
        mentions(F.lower(name), FAMILIES["customer"]).alias("about_customer"),
        name.like("%#00000000%").alias("low_name"),
        phone.rlike(r"^\+1-555-[0-9]+$").alias("good_phone"),
        F.upper(tier).alias("tier"),
        F.replace(filled, F.lit("{tier}"), tier).alias("filled"),
    )


@query("scalar_array", """
    SELECT customer_id, len(list_filter([CASE WHEN email IS NULL THEN 'no email' END, CASE WHEN email = '' THEN 'empty email' END,
            CASE WHEN NOT is_active THEN 'inactive' END], lambda x: x IS NOT NULL))::INTEGER AS n_issues,
        array_to_string(list_filter([CASE WHEN email IS NULL THEN 'no email' END, CASE WHEN email = '' THEN 'empty email' END,
            CASE WHEN NOT is_active THEN 'inactive' END], lambda x: x IS NOT NULL), '; ') AS issues,
        replace(tags, ',', '|') || '|' || customer_tier AS tags_plus, 2 AS n_parsed
    FROM a_customers""")
def _(t):
    email = F.col("email")
    issues = F.array_compact(
        F.array(
            F.when(email.isNull(), "no email"), F.when(email == "", "empty email"), F.when(~F.col("is_active"), "inactive")
        )
    )
    parsed = F.from_json(F.to_json(F.col("tags")), "array<string>")
    return t.customers.select(
        "customer_id",
        F.size(issues).alias("n_issues"),
        F.array_join(issues, "; ").alias("issues"),
        F.array_join(F.array_append(F.col("tags"), F.col("customer_tier")), "|").alias("tags_plus"),
        F.size(parsed).alias("n_parsed"),
    )


@query("scalar_json", """
    SELECT job_id, props->>'$.k' AS k_text, (props->>'$.k')::INTEGER AS k, NULL::VARCHAR AS missing,
        '{"job_id":' || job_id || CASE WHEN error_message IS NULL THEN '' ELSE ',"error":"' || error_message || '"' END || '}' AS built,
        '{"task":"a \\"quoted\\" ' || job_name || '"}' AS escaped
    FROM a_jobs JOIN events ON event_id = job_id""")
def _(t):
    doc = F.try_parse_json(F.col("input_data"))
    return t.jobs.select(
        "job_id",
        json_text(F.col("input_data"), "k").alias("k_text"),
        F.variant_get(doc, "$.k", "int").alias("k"),
        F.variant_get(doc, "$.nothing", "string").alias("missing"),
        F.to_json(F.struct("job_id", F.col("error_message").alias("error"))).alias("built"),
        F.to_json(F.struct(F.concat(F.lit('a "quoted" '), F.col("job_name")).alias("task"))).alias("escaped"),
    )


@query("scalar_json_records", f"""
    SELECT status, '[' || string_agg('{{{{"job_type":"' || job_type || '","n":' || n || ',"latest":"' || latest || '"}}}}', ',' ORDER BY job_type) || ']' AS records
    FROM (SELECT status, job_type, count(*) AS n, max(created_at)::DATE::VARCHAR AS latest FROM a_jobs GROUP BY 1, 2) GROUP BY 1""".replace("{{", "{").replace("}}", "}"))
def _(t):
    rows = t.jobs.groupBy("status", "job_type").agg(
        F.count(F.lit(1)).alias("n"), F.to_date(F.max("created_at")).cast("string").alias("latest")
    )
    records = F.array_sort(F.collect_list(F.struct("job_type", "n", "latest")))
    return rows.groupBy("status").agg(F.to_json(records).alias("records"))


@query("sql_udf_datediff", f"""
    SELECT job_id, date_diff('minute', created_at, coalesce(updated_at, {NOW})) AS minutes,
           date_diff('hour', created_at, {NOW}) AS hours FROM a_jobs""")
def _(t):
    define_functions(t.spark)
    return t.spark.sql(
        """SELECT job_id, minutes_crossed(created_at, coalesce(updated_at, :now ::timestamp_ntz)) AS minutes,
                  hours_crossed(created_at, :now ::timestamp_ntz) AS hours FROM {jobs}""",
        args={"now": JOBS_AS_OF},
        jobs=t.jobs,
    )


@query("sql_udf_default", """
    SELECT job_id, greatest(3 - retry_count, 0)::INTEGER AS usual, greatest(5 - retry_count, 0)::INTEGER AS longer FROM a_jobs""")
def _(t):
    """A default argument left out, and given by name."""
    define_functions(t.spark)
    return t.spark.sql("SELECT job_id, retries_left(retry_count) AS usual, retries_left(retry_count, most => 5) AS longer FROM {jobs}", jobs=t.jobs)


def _order_checks(high):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS test_name, CASE WHEN count(*) FILTER (NOT ({cond})) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) FILTER (NOT ({cond})) || ' bad records' AS details FROM a_orders"
        for name, cond in (("total_positive", "total_amount > 0"), ("total_in_range", f"total_amount <= {high}"), ("discount_below_total", "discount_amount < total_amount"))
    )


@query("sql_table_function", f"SELECT 'default' AS bound, * FROM ({_order_checks(400000)}) UNION ALL SELECT 'given', * FROM ({_order_checks(250000)})")
def _(t):
    """Checks by a table function over all orders, with its default bound and with another."""
    define_functions(t.spark)
    text = """
        SELECT '{bound}' AS bound, c.check_name AS test_name, CASE WHEN count_if(NOT c.passed) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
               concat(count_if(NOT c.passed), ' bad records') AS details
        FROM {{orders}} o, LATERAL order_checks(o.total_amount, o.discount_amount{more}) c GROUP BY c.check_name"""
    made = [t.spark.sql(text.format(bound=b, more=m), orders=t.orders) for b, m in (("default", ""), ("given", ", 250000"))]
    return made[0].unionByName(made[1])


@query("check_template", """
    SELECT 'order_total_positive' AS test_name, 'PASS' AS status, count(*) || ' bad records' AS details FROM a_orders WHERE total_amount <= 0 HAVING count(*) = 0
    UNION ALL SELECT 'order_total_positive', 'FAIL', count(*) || ' bad records' FROM a_orders WHERE total_amount <= 0 HAVING count(*) > 0
    UNION ALL SELECT 'customer_active', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) || ' bad records' FROM a_customers WHERE NOT is_active""")
def _(t):
    from orderlens.plans.quality import check

    return check("order_total_positive", t.orders, F.col("total_amount") <= 0).unionByName(
        check("customer_active", t.customers, ~F.col("is_active"))
    )
