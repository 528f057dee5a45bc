"""Rules and nudges on the given events."""

from pyspark.sql import functions as F

from orderlens.functions import dbl, ntz
from orderlens.plans import nudges, rule_index, rules
from orderlens.plans.rules import Rule
from orderlens.session import run_dir
from orderlens.streaming import keyed, nudge_stream
from orderlens.streaming.source import event_stream
from orderlens.suite.registry import JOBS_AS_OF, query

NOW = f"TIMESTAMP '{JOBS_AS_OF}'"

RULES = [
    Rule("big_purchase", "purchase", {"operator": "AND", "conditions": [
        {"operator": "GREATER_THAN", "field": "value", "value": 20},
        {"operator": "OR", "conditions": [
            {"operator": "EQUALS", "field": "customer_tier", "value": "ENTERPRISE"},
            {"operator": "GREATER_THAN", "field": "k", "value": 50}]}]},
        priority=5, nudge_type="EMAIL", channels=("EMAIL", "IN_APP"), template_id="thanks", cooldown_hours=48),
    Rule("error_help", "error", {"operator": "CONTAINS", "field": "props", "value": "9"},
         priority=9, nudge_type="PUSH", channels=("PUSH",), template_id="help", cooldown_hours=6, audience=("PREMIUM", "ENTERPRISE")),
    Rule("welcome", "signup", [
        {"sequence_order": 1, "field": "k", "operator": "BETWEEN", "value": "10, 80"},
        {"sequence_order": 2, "field": "customer_tier", "operator": "IN", "value": "STANDARD, PREMIUM", "logical_operator": "AND"},
        {"sequence_order": 3, "field": "value", "operator": ">", "value": "100", "logical_operator": "OR"}],
        priority=3, kind="hybrid", template_id="welcome", cooldown_hours=72),
    Rule("above_k", "view", [
        {"sequence_order": 1, "field": "value", "operator": ">", "value": "k", "value_type": "dynamic"},
        {"sequence_order": 2, "field": "props", "operator": "REGEX", "value": r'"k": [1-4]', "logical_operator": "AND"}],
        priority=1, template_id="browse", cooldown_hours=12),
    Rule("rich_click", "click", [
        {"sequence_order": 1, "field": "lifetime_value", "operator": ">", "value": "score_bar", "value_type": "reference"},
        {"sequence_order": 2, "field": "event_type", "operator": "!=", "value": "view"},
        {"sequence_order": 3, "field": "k", "operator": "<", "value": "90"}],
        priority=2, kind="batch", effective_from="2024-01-10 00:00:00", effective_to="2024-01-25 00:00:00", template_id="thanks", cooldown_hours=24),
    Rule("retired", "click", {"operator": "GREATER_THAN", "field": "k", "value": 0}, is_active=False),
]

TEMPLATES = [
    ("thanks", "Thank you, user {user}, for {value}", "en", 1), ("thanks", "Thanks {user}: {value} ({tier})", "en", 2),
    ("thanks", "Merci {user}", "fr", 1), ("help", "Need help after the {event}?", "en", 1), ("help", "Besoin d'aide ?", "fr", 3),
    ("welcome", "Welcome {user} ({tier})", "en", 1), ("browse", "Still looking, {user}?", "en", 4),
]

# The same conditions spelled out for SQL.
_E = """e AS (SELECT a.*, c.customer_tier, c.lifetime_value, c.profile_score * 50 AS score_bar,
    CASE WHEN c.state = 'EUROPE' THEN 'fr' ELSE 'en' END AS locale FROM a_events a LEFT JOIN a_customers c ON a.user_id = c.customer_id)"""
_R = [
    ("big_purchase", "event_type = 'purchase'", "value > 20 AND (customer_tier = 'ENTERPRISE' OR k > 50)", "EMAIL", 5, "thanks", 48),
    ("error_help", "event_type = 'error'", "contains(props, '9')", "PUSH", 9, "help", 6),
    ("welcome", "event_type = 'signup'", "(k BETWEEN 10 AND 80 AND customer_tier IN ('STANDARD', 'PREMIUM')) OR value > 100", "IN_APP", 3, "welcome", 72),
    ("above_k", "event_type = 'view'", "value > k AND regexp_matches(props, '\"k\": [1-4]')", "IN_APP", 1, "browse", 12),
    ("rich_click", "event_type = 'click' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-25'",
     "lifetime_value > score_bar AND event_type <> 'view' AND k < 90", "IN_APP", 2, "thanks", 24),
]
_O = "o AS (" + " UNION ALL ".join(
    f"SELECT e.*, '{r}' AS rule_id, coalesce({cond}, FALSE) AS matched FROM e WHERE {force}" for r, force, cond, *_ in _R
) + ")"
_ACTIONS = "act AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{r}', '{kind}', {prio}, '{tpl}', {cool})" for r, _, _, kind, prio, tpl, cool in _R
) + ") v(rule_id, nudge_type, priority, template_id, cooldown_hours))"
_TPL = "tpl AS (SELECT * FROM (VALUES " + ", ".join(
    "('{}', '{}', '{}', {})".format(a, b.replace("'", "''"), c, d) for a, b, c, d in TEMPLATES
) + ") v(template_id, text, locale, version) QUALIFY row_number() OVER (PARTITION BY template_id, locale ORDER BY version DESC) = 1)"
_N = f"""{_E}, {_O}, {_ACTIONS}, {_TPL},
    n AS (SELECT md5(rule_id || '|' || event_id) AS nudge_id, user_id, rule_id, nudge_type, event_id,
        replace(replace(replace(replace(text, '{{user}}', user_id::VARCHAR), '{{event}}', event_type), '{{value}}', value::VARCHAR), '{{tier}}', customer_tier) AS content,
        priority, ts AS generated_at, ts + INTERVAL 7 DAY AS expires_at, customer_tier, cooldown_hours, k, value
      FROM o JOIN act USING (rule_id) LEFT JOIN tpl USING (template_id, locale) WHERE matched)"""


def enriched(t):
    return enrich(t, t.events)


def enrich(t, events):
    """Events with the user's profile fields the rules read."""
    profile = t.customers_placed.select(
        F.col("customer_id").alias("c"), "customer_tier", "lifetime_value", (F.col("profile_score") * 50).alias("score_bar"),
        F.when(F.col("state") == "EUROPE", "fr").otherwise("en").alias("locale"),
    )
    events = events.withColumn("k", F.from_json("props", "k int")["k"])
    return events.join(profile, F.col("user_id") == F.col("c"), "left").drop("c").withColumn(
        "locale", F.coalesce("locale", F.lit("en"))
    )


def templates(t):
    return rules.config_frame(t.spark, TEMPLATES, "template_id string, content_template string, locale string, version int")


def made(t):
    return nudges.generate(enriched(t), RULES, templates(t))




@query("rules_json_eval", f"WITH {_E}, {_O} SELECT event_id, rule_id, matched FROM o WHERE rule_id IN ('big_purchase', 'error_help')")
def _(t):
    tree = [r for r in RULES if isinstance(r.conditions, dict)]
    return rules.outcomes(enriched(t), tree).select("event_id", "rule_id", "matched")


@query("rules_flat_eval", f"WITH {_E}, {_O} SELECT event_id, rule_id FROM o WHERE matched AND rule_id IN ('welcome', 'above_k', 'rich_click')")
def _(t):
    flat = [r for r in RULES if isinstance(r.conditions, list)]
    return rules.matches(enriched(t), flat).select("event_id", "rule_id")


_RULE_FIELDS = ("event_type", "user_id", "value", "k", "props", "customer_tier", "lifetime_value", "score_bar", "locale")


@query("rules_indexed", f"WITH {_E}, {_O} SELECT event_id, rule_id FROM o WHERE matched")
def _(t):
    events = enriched(t)
    fields = rule_index.Fields(events, _RULE_FIELDS)
    index = rule_index.build(rule_index.clauses(t.spark, RULES, fields))
    return rule_index.matches(events, index, fields).select("event_id", "rule_id")


@query("rules_from_tables", """
    SELECT event_id, 'customer ' || customer_id AS rule_id FROM a_events JOIN a_customers ON event_type = 'purchase' AND user_id = customer_id AND value::DOUBLE > profile_score * 0.4
    UNION ALL SELECT event_id, 'product ' || product_id FROM a_events JOIN (SELECT product_id, (product_id % 1000) / 20.0::DOUBLE AS low FROM a_products)
        ON event_type = 'view' AND value::DOUBLE BETWEEN low AND low + 0.5""")
def _(t):
    """A rule for each customer and each product, as rows that Spark derives from the tables."""
    fields = rule_index.Fields(t.events, ("user_id", "value"))
    user, value, none = F.lit(0), F.lit(1), F.lit(None)

    def one(field, op, num, high=none):
        parts = dict(field=field, op=F.lit(op), num=num.cast("double"), high=high.cast("double"), text=none.cast("string"), texts=none.cast("array<string>"), other=none.cast("int"))
        return F.struct(*[c.alias(n) for n, c in parts.items()])

    def rows(df, name, event_type, *terms):
        return df.select(
            name.alias("rule_id"), F.lit(event_type).alias("event_type"), ntz("2000-01-01").alias("valid_from"), ntz("2100-01-01").alias("valid_to"),
            F.lit(0).alias("clause"), F.array(*terms).alias("terms"))

    low = (F.col("product_id") % 1000) / F.lit(20.0)
    people = rows(t.customers, F.concat(F.lit("customer "), F.col("customer_id").cast("string")), "purchase",
                  one(user, "n=", F.col("customer_id")), one(value, "n>", F.col("profile_score") * F.lit(0.4)))
    goods = rows(t.products, F.concat(F.lit("product "), F.col("product_id").cast("string")), "view", one(value, "nBETWEEN", low, low + F.lit(0.5)))
    return rule_index.matches(t.events, rule_index.build(people.unionByName(goods)), fields).select("event_id", "rule_id")


@query("rule_candidates", f"WITH {_E}, {_O} SELECT event_id, rule_id, CASE rule_id WHEN 'welcome' THEN 'hybrid' WHEN 'rich_click' THEN 'batch' ELSE 'real_time' END AS kind FROM o")
def _(t):
    return rules.candidates(t.events, RULES).select("event_id", "rule_id", "kind")


@query("rule_execution_log", f"""
    WITH {_E}, {_O} SELECT md5(rule_id || '|' || event_id) AS execution_id, rule_id, event_id, user_id, ts AS execution_timestamp,
        CASE WHEN k IS NULL THEN 'FAILED' WHEN matched THEN 'SUCCESS' ELSE 'SKIPPED' END AS execution_status FROM o""")
def _(t):
    return rules.execution_log(enriched(t), RULES)


@query("rule_hit_rate", f"""
    WITH {_E}, {_O} SELECT rule_id, count(*) AS evaluations, count(*) FILTER (matched) AS hits, count(*) FILTER (matched)::DOUBLE / count(*) AS hit_rate FROM o GROUP BY 1""")
def _(t):
    return rules.hit_rates(enriched(t), [r for r in RULES if r.is_active])


@query("nudge_generate", f"""
    WITH {_N} SELECT nudge_id, user_id, rule_id, nudge_type, event_id, content, priority, generated_at, expires_at,
        CASE rule_id WHEN 'big_purchase' THEN 'EMAIL=PENDING|IN_APP=PENDING' WHEN 'error_help' THEN 'PUSH=PENDING' ELSE 'IN_APP=PENDING' END AS delivery FROM n""")
def _(t):
    states = F.transform(F.map_entries("delivery_status"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return made(t).withColumn("delivery", F.array_join(states, "|")).select(
        "nudge_id", "user_id", "rule_id", "nudge_type", "event_id", "content", "priority", "generated_at", "expires_at", "delivery"
    )


_AUD = """x AS (SELECT n.* FROM n JOIN a_customers c ON n.user_id = c.customer_id WHERE c.is_active
    AND (rule_id <> 'error_help' OR n.customer_tier IN ('PREMIUM', 'ENTERPRISE')))"""


@query("nudge_audience", f"WITH {_N}, {_AUD} SELECT nudge_id, user_id, rule_id FROM x")
def _(t):
    return nudges.audience(made(t), t.customers, RULES).select("nudge_id", "user_id", "rule_id")


@query("nudge_prioritize", f"""
    WITH {_N} SELECT nudge_id, user_id, rule_id, priority FROM n
    QUALIFY row_number() OVER (PARTITION BY user_id, nudge_type, generated_at::DATE ORDER BY priority DESC, generated_at, nudge_id) = 1""")
def _(t):
    return nudges.prioritize(made(t)).select("nudge_id", "user_id", "rule_id", "priority")


_CAP = """d AS (SELECT *, date_trunc('week', generated_at) AS wk FROM n QUALIFY row_number() OVER (PARTITION BY user_id, generated_at::DATE ORDER BY generated_at, nudge_id) <= {d}),
    w AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY user_id, wk ORDER BY generated_at, nudge_id) <= {w})"""


@query("nudge_frequency_cap", f"WITH {_N}, {_CAP.format(d=1, w=3)} SELECT nudge_id, user_id, generated_at FROM w")
def _(t):
    # Published caps are 5 and 15; the events are sparser, so 1 and 3 show both cuts.
    return nudges.frequency_cap(made(t), daily=1, weekly=3).select("nudge_id", "user_id", "generated_at")


@query("nudge_frequency_cap_default", f"WITH {_N}, {_CAP.format(d=5, w=15)} SELECT nudge_id, user_id, generated_at FROM w")
def _(t):
    return nudges.frequency_cap(made(t)).select("nudge_id", "user_id", "generated_at")


_COOL = f"""
    WITH RECURSIVE {_N},
    q AS (SELECT user_id, nudge_type, rule_id, cooldown_hours AS c, nudge_id, generated_at, date_diff('hour', TIMESTAMP '1970-01-01', generated_at) AS h,
        row_number() OVER (PARTITION BY user_id, nudge_type, rule_id ORDER BY generated_at, nudge_id) AS i FROM n),
    r AS (SELECT user_id, nudge_type, rule_id, i, nudge_id, generated_at, TRUE AS sent, h AS last FROM q WHERE i = 1
        UNION ALL SELECT q.user_id, q.nudge_type, q.rule_id, q.i, q.nudge_id, q.generated_at, q.h - r.last >= q.c, CASE WHEN q.h - r.last >= q.c THEN q.h ELSE r.last END
        FROM r JOIN q ON q.user_id = r.user_id AND q.nudge_type = r.nudge_type AND q.rule_id = r.rule_id AND q.i = r.i + 1)"""


@query("nudge_cooldown", f"{_COOL} SELECT nudge_id, user_id, rule_id, generated_at FROM r WHERE sent")
def _(t):
    return nudges.cooldown(made(t)).select("nudge_id", "user_id", "rule_id", "generated_at")


@query("nudge_cooldown_stream", f"{_COOL} SELECT nudge_id, user_id, rule_id, generated_at FROM r WHERE sent")
def _(t):
    """The same events in two arrivals, the later ones first."""
    root = run_dir(t.spark, "nudges")
    early = F.col("ts") < ntz("2024-01-15")
    for part in (t.base("events").filter(~early), t.base("events").filter(early)):
        part.write.mode("append").parquet(f"{root}/events.parquet")
        nudge_stream.run(
            event_stream(t.spark, root), lambda batch: enrich(t, batch), RULES, templates(t), f"{root}/sent", f"{root}/checkpoint"
        )
    return nudge_stream.sent(t.spark, f"{root}/sent").select("nudge_id", "user_id", "rule_id", "generated_at")


@query("nudge_cooldown_state", f"{_COOL} SELECT nudge_id, user_id, rule_id, generated_at FROM r WHERE sent")
def _(t):
    """The same nudges, decided by keyed state as the watermark passes."""
    from orderlens.suite.streaming_suite import replayed

    made_of = lambda events: nudges.generate(enrich(t, events.withWatermark("ts", "10 minutes")), RULES, templates(t))
    return replayed(t, lambda events: keyed.cooldown(made_of(events)), "cooldown")


@query("nudge_history", f"""
    WITH {_N} SELECT user_id, nudge_type, rule_id, max(generated_at) AS last_sent_at, max(generated_at + to_hours(cooldown_hours)) AS cooldown_until,
        count(*) AS total_sent FROM n GROUP BY 1, 2, 3""")
def _(t):
    sent = made(t).select("user_id", "nudge_type", "rule_id", "generated_at", "cooldown_hours")
    early = F.col("generated_at") < ntz("2024-01-15")
    empty = sent.filter("1 = 0").groupBy("user_id", "nudge_type", "rule_id").agg(
        F.max("generated_at").alias("last_sent_at"), F.max("generated_at").alias("cooldown_until"), F.count(F.lit(1)).alias("total_sent")
    )
    return nudges.history(nudges.history(empty, sent.filter(early)), sent.filter(~early))


@query("nudge_publish", f"""
    WITH {_N} SELECT CASE WHEN content IS NULL OR expires_at < {NOW} THEN 'nudge.failed' ELSE 'nudge.generated' END AS topic, user_id::VARCHAR AS key,
        '{{"nudge_id":"' || nudge_id || '","rule_id":"' || rule_id || '","nudge_type":"' || nudge_type || '","priority":' || priority
        || CASE WHEN content IS NULL THEN '' ELSE ',"content":"' || content || '"' END || '}}' AS value FROM n""")
def _(t):
    return nudges.publish(made(t), ntz(JOBS_AS_OF))


@query("user_nudges_page", f"""
    WITH {_N}, p AS (SELECT user_id, nudge_id, row_number() OVER (PARTITION BY user_id ORDER BY generated_at DESC, nudge_id) AS r FROM n)
    SELECT user_id, nudge_id, r::INTEGER AS position FROM p WHERE r BETWEEN 6 AND 10""")
def _(t):
    return nudges.page(made(t), size=5, number=2).select("user_id", "nudge_id", "position")


# Delivery attempts and interactions, derived from the nudges: a small value fails the
# first attempt, a small k the second; k also decides how far the user goes.
_LOG = """log AS (
    SELECT nudge_id, 1 AS delivery_attempt, generated_at + INTERVAL 1 MINUTE AS delivery_timestamp, CASE WHEN value < 8 THEN 'FAILED' ELSE 'DELIVERED' END AS delivery_status FROM n
    UNION ALL SELECT nudge_id, 2, generated_at + INTERVAL 16 MINUTE, CASE WHEN k < 40 THEN 'FAILED' ELSE 'DELIVERED' END FROM n WHERE value < 8),
    st AS (SELECT nudge_id, count(*) AS attempts, arg_max(delivery_status, delivery_timestamp) AS status, max(delivery_timestamp) AS last_attempt_at,
        arg_max(CASE WHEN delivery_status = 'FAILED' THEN delivery_timestamp + INTERVAL 15 MINUTE ELSE TIMESTAMP '1970-01-01' END, delivery_timestamp) AS ra FROM log GROUP BY 1)"""


def delivery_log(made_nudges):
    status1 = F.when(F.col("value") < 8, "FAILED").otherwise("DELIVERED")
    status2 = F.when(F.col("k") < 40, "FAILED").otherwise("DELIVERED")
    attempt = lambda n, minutes, status: F.struct(
        F.lit(n).alias("delivery_attempt"),
        (F.col("generated_at") + F.expr(f"interval {minutes} minutes")).alias("delivery_timestamp"),
        status.alias("delivery_status"),
    )
    tries = F.array_compact(F.array(attempt(1, 1, status1), F.when(F.col("value") < 8, attempt(2, 16, status2))))
    log = made_nudges.select("nudge_id", F.explode(tries).alias("a")).select("nudge_id", "a.*")
    return log.withColumn(
        "retry_after",
        F.when(F.col("delivery_status") == "FAILED", F.col("delivery_timestamp") + F.expr("interval 15 minutes")),
    )


@query("nudge_delivery_state", f"WITH {_N}, {_LOG} SELECT nudge_id, attempts, status, last_attempt_at, nullif(ra, TIMESTAMP '1970-01-01') AS retry_after FROM st")
def _(t):
    return nudges.delivery_state(delivery_log(made(t)))


@query("nudge_funnel", f"""
    WITH {_N}, {_LOG} SELECT rule_id, count(*) AS generated, count(*) FILTER (status = 'DELIVERED') AS delivered,
        count(*) FILTER (k >= 30) AS viewed, count(*) FILTER (k >= 60) AS clicked, count(*) FILTER (k >= 85) AS converted,
        count(*) FILTER (status = 'DELIVERED')::DOUBLE / count(*) AS delivery_rate,
        count(*) FILTER (k >= 60)::DOUBLE / nullif(count(*) FILTER (k >= 30), 0) AS click_rate,
        count(*) FILTER (k >= 85)::DOUBLE / nullif(count(*) FILTER (k >= 60), 0) AS conversion_rate
    FROM n JOIN st USING (nudge_id) GROUP BY 1""")
def _(t):
    all_nudges = made(t)
    steps = F.array_compact(
        F.array(
            F.when(F.col("k") >= 30, "VIEWED"), F.when(F.col("k") >= 60, "CLICKED"), F.when(F.col("k") >= 85, "CONVERTED"),
            F.when(F.col("k") >= 30, "VIEWED"), F.when(F.col("k") < 10, "DISMISSED"),
        )
    )
    interactions = all_nudges.select("nudge_id", F.explode(steps).alias("interaction_type"))
    return nudges.funnel(all_nudges, nudges.delivery_state(delivery_log(all_nudges)), interactions)


@query("nudges_per_hour", f"""
    WITH {_N} SELECT date_trunc('hour', generated_at) AS hour, count(*) AS nudges, sum(priority)::DOUBLE / count(*) AS mean_priority FROM n GROUP BY 1""")
def _(t):
    return nudges.per_hour(made(t))


@query("pii_mask", """
    SELECT customer_id, sha256(customer_name) AS name_token, '***@' || split_part(email, '@', -1) AS email_masked,
        regexp_replace(phone, '[0-9]', '#', 'g') AS phone_masked, customer_tier FROM a_customers""")
def _(t):
    return nudges.mask_pii(t.customers)


@query("erase_users", """
    SELECT event_id, user_id, event_type, value::DOUBLE AS value FROM a_events
    WHERE user_id NOT IN (SELECT user_id FROM a_events WHERE event_type = 'error' AND value > 150)""")
def _(t):
    listed = t.events.filter((F.col("event_type") == "error") & (F.col("value") > 150))
    return nudges.erase(t.events, listed, "user_id").select("event_id", "user_id", "event_type", dbl(F.col("value")).alias("value"))
