"""Nudges: generation from matched rules, eligibility, delivery, history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions import mean, ratio, time_floor
from orderlens.operators.upsert import upsert
from orderlens.plans.rules import Rule, config_frame, matches

DAILY_LIMIT, WEEKLY_LIMIT = 5, 15
EXPIRES_DAYS = 7


def latest_templates(templates: DataFrame) -> DataFrame:
    """The highest version of each (template, locale)."""
    return templates.groupBy("template_id", "locale").agg(F.max_by("content_template", "version").alias("text"))


def fill(text: Column, values: dict[str, Column]) -> Column:
    """Replaces ``{name}`` by its value; a NULL value fills in as empty."""
    out = text
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def nudge_id() -> Column:
    """Derived from rule and event, so a replay makes the same id."""
    return F.md5(F.concat_ws("|", F.col("rule_id"), F.col("event_id").cast("string")))


def generate(events: DataFrame, rules: Sequence[Rule], templates: DataFrame) -> DataFrame:
    """One nudge per matched rule: a projection, an explode and two joins with
    configuration.  The same function runs on a stream."""
    rows = [
        (r.rule_id, r.nudge_type, list(r.channels), r.priority, r.template_id, r.cooldown_hours) for r in rules
    ]
    actions = config_frame(
        events.sparkSession, rows,
        "rule_id string, nudge_type string, channels array<string>, priority int, template_id string, cooldown_hours int",
    )
    texts = latest_templates(templates)
    made = matches(events, rules).join(actions, "rule_id").join(texts, ["template_id", "locale"], "left")
    content = fill(
        F.col("text"),
        {"user": F.col("user_id"), "event": F.col("event_type"), "value": F.col("value"), "tier": F.col("customer_tier")},
    )
    states = F.map_from_arrays("channels", F.transform("channels", lambda c: F.lit("PENDING")))
    return made.select(
        nudge_id().alias("nudge_id"),
        "user_id",
        "rule_id",
        "nudge_type",
        "event_id",
        content.alias("content"),
        "channels",
        "priority",
        F.col("ts").alias("generated_at"),
        (F.col("ts") + F.expr(f"interval {EXPIRES_DAYS} days")).alias("expires_at"),
        states.alias("delivery_status"),
        "customer_tier",
        "cooldown_hours",
        "k",
        "value",
    )


def audience(nudges: DataFrame, customers: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Nudges for consenting (active) customers inside the rule's tiers."""
    rows = [(r.rule_id, tier) for r in rules for tier in r.audience]
    allowed = config_frame(nudges.sparkSession, rows, "rule_id string, customer_tier string")
    consent = customers.filter("is_active").select(F.col("customer_id").alias("user_id"))
    return nudges.join(allowed, ["rule_id", "customer_tier"], "left_semi").join(consent, "user_id", "left_semi")


def prioritize(nudges: DataFrame) -> DataFrame:
    """The most important nudge per user, type and day; earlier and smaller ids break ties.

    The row_number bound is applied in every task before the shuffle.
    """
    w = Window.partitionBy("user_id", "nudge_type", "__day").orderBy(
        F.col("priority").desc(), "generated_at", "nudge_id"
    )
    return (
        nudges.withColumn("__day", F.to_date("generated_at"))
        .withColumn("__rn", F.row_number().over(w))
        .filter(F.col("__rn") == 1)
        .drop("__day", "__rn")
    )


def frequency_cap(nudges: DataFrame, daily: int = DAILY_LIMIT, weekly: int = WEEKLY_LIMIT) -> DataFrame:
    """First ``daily`` nudges of a user's day, then first ``weekly`` of the week over those left."""
    by_day = Window.partitionBy("user_id", "__day").orderBy("generated_at", "nudge_id")
    by_week = Window.partitionBy("user_id", "__week").orderBy("generated_at", "nudge_id")
    return (
        nudges.withColumn("__day", F.to_date("generated_at"))
        .withColumn("__d", F.row_number().over(by_day))
        .filter(F.col("__d") <= daily)
        .withColumn("__week", F.trunc("generated_at", "week"))
        .withColumn("__w", F.row_number().over(by_week))
        .filter(F.col("__w") <= weekly)
        .drop("__day", "__d", "__week", "__w")
    )


def hour_number(ts: Column) -> Column:
    return F.timestamp_diff("HOUR", F.lit("1970-01-01").cast("timestamp_ntz"), time_floor("hour", ts))


def cooldown(nudges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Nudges left after the cooldown of their (user, type, rule).

    ``known`` is the nudge history (``last_sent_at`` per key): a daily or streaming run
    passes what earlier runs sent, and gets what one run over everything would send.

    Cooldowns are whole hours and count hour boundaries, so within one hour only the
    first nudge can be sent: the rest is dropped by a partial aggregate before the
    shuffle.  A key then holds at most one entry per hour of the horizon, however
    many nudges it had, and an ordered fold picks those at least ``cooldown_hours``
    after the last one *sent* (a suppressed nudge does not restart the clock).
    """
    key = ["user_id", "nudge_type", "rule_id"]
    first = nudges.groupBy(*key, "cooldown_hours", hour_number(F.col("generated_at")).alias("h")).agg(
        F.min(F.struct("generated_at", "nudge_id", "event_id")).alias("n")
    )
    entries = F.array_sort(F.collect_list(F.struct("h", "n")))
    folded = first.groupBy(*key, "cooldown_hours").agg(entries.alias("entries"))
    entry_type = folded.schema["entries"].dataType.simpleString()
    if known is None:
        folded = folded.withColumn("before", F.lit(None).cast("bigint"))
    else:
        last = known.select(*key, hour_number(F.col("last_sent_at")).alias("before"))
        folded = folded.join(last, key, "left")
    start = F.struct(F.col("before").alias("last"), F.array().cast(entry_type).alias("kept"))

    def step(acc: Column, e: Column) -> Column:
        free = acc["last"].isNull() | (e["h"] - acc["last"] >= F.col("cooldown_hours"))
        return F.when(
            free, F.struct(e["h"].alias("last"), F.concat(acc["kept"], F.array(e)).alias("kept"))
        ).otherwise(acc)

    sent = F.aggregate("entries", start, step, lambda acc: acc["kept"])
    return folded.select(*key, "cooldown_hours", F.explode(sent).alias("e")).select(*key, "cooldown_hours", "e.n.*")


def history(existing: DataFrame, sent: DataFrame) -> DataFrame:
    """Per (user, type, rule): last sent, cooldown end and total, merged into what was known."""
    key = ["user_id", "nudge_type", "rule_id"]
    fresh = sent.groupBy(*key).agg(
        F.max("generated_at").alias("last_sent_at"),
        F.max(F.col("generated_at") + F.make_dt_interval(hours=F.col("cooldown_hours"))).alias("cooldown_until"),
        F.count(F.lit(1)).alias("total_sent"),
    )
    return upsert(
        existing, fresh, key,
        update={
            "last_sent_at": lambda t, s: F.greatest(t("last_sent_at"), s("last_sent_at")),
            "cooldown_until": lambda t, s: F.greatest(t("cooldown_until"), s("cooldown_until")),
            "total_sent": lambda t, s: t("total_sent") + s("total_sent"),
        },
        check_source=False,
    )


def publish(nudges: DataFrame, as_of: Column) -> DataFrame:
    """Log records keyed by user: topic, key and JSON value.  Empty or expired nudges fail."""
    bad = F.col("content").isNull() | (F.col("expires_at") < as_of)
    body = F.to_json(F.struct("nudge_id", "rule_id", "nudge_type", "priority", "content"))
    return nudges.select(
        F.when(bad, "nudge.failed").otherwise("nudge.generated").alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        body.alias("value"),
    )


def page(nudges: DataFrame, size: int, number: int) -> DataFrame:
    """Page ``number`` (from 1) of every user's nudges, newest first."""
    w = Window.partitionBy("user_id").orderBy(F.col("generated_at").desc(), "nudge_id")
    last = size * number
    return (
        nudges.withColumn("position", F.row_number().over(w).cast("int"))
        .filter(F.col("position") <= last)
        .filter(F.col("position") > last - size)
    )


# --- delivery and interaction logs -------------------------------------------


def delivery_state(log: DataFrame) -> DataFrame:
    """Latest state, attempt count and next retry per nudge."""
    at = F.struct("delivery_timestamp", "delivery_attempt")
    return log.groupBy("nudge_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.max_by("delivery_status", at).alias("status"),
        F.max("delivery_timestamp").alias("last_attempt_at"),
        F.max_by("retry_after", at).alias("retry_after"),
    )


def funnel(nudges: DataFrame, states: DataFrame, interactions: DataFrame) -> DataFrame:
    """Distinct nudges per rule at each stage, with the rates between stages.

    Counted per nudge first: rules are few and one may hold most nudges.
    """
    seen = interactions.groupBy(F.col("nudge_id").alias("i")).agg(
        *[F.max((F.col("interaction_type") == kind).cast("int")).alias(kind) for kind in ("VIEWED", "CLICKED", "CONVERTED")]
    )
    delivered = states.select(F.col("nudge_id").alias("d"), (F.col("status") == "DELIVERED").cast("int").alias("ok"))
    one = nudges.select("nudge_id", "rule_id").distinct()
    wide = one.join(delivered, F.col("nudge_id") == F.col("d"), "left").join(seen, F.col("nudge_id") == F.col("i"), "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    sums = wide.groupBy("rule_id").agg(
        F.count("nudge_id").alias("generated"),
        total("ok").alias("delivered"),
        total("VIEWED").alias("viewed"),
        total("CLICKED").alias("clicked"),
        total("CONVERTED").alias("converted"),
    )
    return sums.withColumns(
        {
            "delivery_rate": ratio(F.col("delivered"), F.col("generated")),
            "click_rate": ratio(F.col("clicked"), F.col("viewed")),
            "conversion_rate": ratio(F.col("converted"), F.col("clicked")),
        }
    )


def per_hour(nudges: DataFrame) -> DataFrame:
    return nudges.groupBy(time_floor("hour", F.col("generated_at")).alias("hour")).agg(
        F.count(F.lit(1)).alias("nudges"), mean(F.sum("priority"), F.count("priority")).alias("mean_priority")
    )


# --- privacy -----------------------------------------------------------------


def mask_pii(customers: DataFrame) -> DataFrame:
    """E-mail by its domain, phone by its shape, name by a one-way token."""
    return customers.select(
        "customer_id",
        F.sha2("customer_name", 256).alias("name_token"),
        F.concat(F.lit("***@"), F.substring_index("email", "@", -1)).alias("email_masked"),
        F.mask("phone", digitChar=F.lit("#")).alias("phone_masked"),
        "customer_tier",
    )


def erase(df: DataFrame, erased: DataFrame, key: str, erased_key: str = "user_id") -> DataFrame:
    """Rows of users not on the erasure list."""
    listed = erased.select(F.col(erased_key).alias(key)).distinct()
    return df.join(listed, key, "left_anti")
