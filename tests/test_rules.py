from datetime import datetime, timedelta
from decimal import Decimal
import random

import pytest
from pyspark.sql import functions as F

from orderlens.plans import nudges, rules
from orderlens.plans.rules import Rule

DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value decimal(12,2), k int, customer_tier string, locale string, bar int"


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        (1, datetime(2024, 1, 1), 1, "click", Decimal("10"), 5, "PREMIUM", "en", 3),
        (2, datetime(2024, 1, 2), 2, "click", Decimal("3"), 50, None, "fr", 90),
        (3, datetime(2024, 1, 3), 3, "view", None, None, "STANDARD", "en", 1),
    ]
    return spark.createDataFrame(rows, DDL)


def ids(df, column):
    return [r.event_id for r in df.filter(column).orderBy("event_id").collect()]


def tree(op, *children):
    return {"operator": op, "conditions": list(children)}


def leaf(op, field, value):
    return {"operator": op, "field": field, "value": value}


@pytest.mark.parametrize("node,want", [
    (leaf("EQUALS", "event_type", "click"), [1, 2]),
    (leaf("GREATER_THAN", "value", 5), [1]),
    (leaf("CONTAINS", "customer_tier", "REM"), [1]),
    (tree("AND", leaf("EQUALS", "event_type", "click"), leaf("GREATER_THAN", "k", 20)), [2]),
    (tree("OR", leaf("EQUALS", "event_type", "view"), leaf("GREATER_THAN", "k", 20)), [2, 3]),
    (tree("AND"), [1, 2, 3]),
    (tree("OR"), []),
])
def test_trees(events, node, want):
    assert ids(events, rules.compile_tree(node, rules.event_fields(events))) == want


def test_unknown_operators_raise(events):
    fields = rules.event_fields(events)
    with pytest.raises(ValueError, match="Unknown operator: XOR"):
        rules.compile_tree(tree("AND", leaf("XOR", "k", 1)), fields)
    with pytest.raises(ValueError, match="Unknown operator: LIKE"):
        rules.compile_rows([{"sequence_order": 1, "field": "k", "operator": "LIKE", "value": "x"}], fields)


def row(order, field, operator, value, logic="AND", kind="static"):
    return {"sequence_order": order, "field": field, "operator": operator, "value": value, "logical_operator": logic, "value_type": kind}


@pytest.mark.parametrize("conditions,want", [
    ([row(1, "k", "=", "5")], [1]),
    ([row(1, "k", "!=", "5")], [2]),
    ([row(1, "value", ">", "k", kind="dynamic")], [1]),
    ([row(1, "k", "<", "bar", kind="reference")], [2]),
    ([row(1, "event_type", "IN", "view, other")], [3]),
    ([row(1, "k", "BETWEEN", "5, 49")], [1]),
    ([row(1, "event_type", "REGEX", "^cl.*k$")], [1, 2]),
    ([row(2, "k", ">", "20", "AND"), row(1, "event_type", "=", "click")], [2]),
    ([row(1, "event_type", "=", "view"), row(2, "k", ">", "20", "OR"), row(3, "user_id", "<", "3", "AND")], [2]),  # left fold
    ([], [1, 2, 3]),
])
def test_rows(events, conditions, want):
    assert ids(events, rules.compile_rows(conditions, rules.event_fields(events))) == want


def test_validity_interval_and_inactive_rules(events):
    always = leaf("GREATER_THAN", "user_id", 0)
    some = [
        Rule("early", "click", always, effective_to="2024-01-02 00:00:00"),
        Rule("late", "click", always, effective_from="2024-01-02 00:00:00"),
        Rule("off", "click", always, is_active=False),
        Rule("views", "view", always, kind="batch"),
    ]
    pairs = lambda df: sorted((r.event_id, r.rule_id) for r in df.collect())
    assert pairs(rules.matches(events, some)) == [(1, "early"), (2, "late"), (3, "views")]
    assert pairs(rules.candidates(events, some)) == [(1, "early"), (2, "late"), (3, "views")]
    assert pairs(rules.candidates(events, some, ["batch"])) == [(3, "views")]
    rates = {r.rule_id: (r.evaluations, r.hits) for r in rules.hit_rates(events, some).collect()}
    assert rates == {"early": (1, 1), "late": (1, 1), "off": (0, 0), "views": (1, 1)}
    log = {r.event_id: r.execution_status for r in rules.execution_log(events, some).collect()}
    assert log == {1: "SUCCESS", 2: "SUCCESS", 3: "FAILED"}


def test_many_rules_of_many_types_against_a_plain_evaluation(spark):
    kinds = [f"type{i}" for i in range(20)]
    rows = [(i, datetime(2024, 1, 1) + timedelta(hours=i), i % 7, kinds[i % 23] if i % 23 < 20 else None, i % 50) for i in range(300)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, k int")
    many = [Rule(f"r{i}", kinds[i % 20], leaf("GREATER_THAN", "k", i % 60), is_active=i % 9 > 0) for i in range(1000)]
    holds = lambda r, e: r.is_active and r.event_type == e[3]
    want = {}
    for r in many:
        mine = [e for e in rows if holds(r, e)]
        want[r.rule_id] = (len(mine), sum(e[4] > r.conditions["value"] for e in mine))
    assert {r.rule_id: (r.evaluations, r.hits) for r in rules.hit_rates(events, many).collect()} == want
    pairs = {(r.event_id, r.rule_id) for r in rules.matches(events, many).collect()}
    assert pairs == {(e[0], r.rule_id) for r in many for e in rows if holds(r, e) and e[4] > r.conditions["value"]}


def test_generation_fills_the_newest_template(spark, events):
    rule = Rule("r", "click", leaf("GREATER_THAN", "user_id", 0), channels=("PUSH", "SMS"), template_id="t")
    texts = spark.createDataFrame(
        [("t", "old {user}", "en", 1), ("t", "user {user}, {value}, {tier}, {other}", "en", 2), ("t", "fr {tier}!", "fr", 1)],
        "template_id string, content_template string, locale string, version int",
    )
    got = {r.event_id: r for r in nudges.generate(events, [rule], texts).collect()}
    assert got[1].content == "user 1, 10.00, PREMIUM, {other}" and got[2].content == "fr !"
    assert got[1].delivery_status == {"PUSH": "PENDING", "SMS": "PENDING"}
    assert got[1].expires_at - got[1].generated_at == timedelta(days=7)
    again = {r.nudge_id for r in nudges.generate(events, [rule], texts).collect()}
    assert again == {r.nudge_id for r in got.values()}


def nudge_rows(spark, n=500, hot=0.4, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 1 if rng.random() < hot else rng.randint(2, 6)
        at = datetime(2024, 1, 1) + timedelta(minutes=rng.randint(0, 60 * 24 * 12))
        rows.append((f"n{i:04}", user, rng.choice(["r1", "r2"]), "PUSH", i, at, rng.randint(1, 3), 7))
    return spark.createDataFrame(
        rows, "nudge_id string, user_id bigint, rule_id string, nudge_type string, event_id bigint, generated_at timestamp_ntz, priority int, cooldown_hours int"
    )


def test_cooldown_equals_a_sequential_scan(spark):
    df = nudge_rows(spark)
    kept, last = set(), {}
    for r in sorted(df.collect(), key=lambda r: (r.generated_at, r.nudge_id)):
        hour = int(r.generated_at.replace(minute=0).timestamp() // 3600)
        key = (r.user_id, r.nudge_type, r.rule_id)
        if key not in last or hour - last[key] >= 7:
            last[key] = hour
            kept.add(r.nudge_id)
    assert {r.nudge_id for r in nudges.cooldown(df).collect()} == kept


def test_cooldown_in_two_runs_equals_one(spark):
    df = nudge_rows(spark)
    early = F.col("generated_at") < F.lit("2024-01-06 10:30:00").cast("timestamp_ntz")
    first = nudges.cooldown(df.filter(early))
    sent = first.groupBy("user_id", "nudge_type", "rule_id").agg(F.max("generated_at").alias("last_sent_at"))
    second = nudges.cooldown(df.filter(~early), sent)
    ids = lambda *frames: sorted(r.nudge_id for f in frames for r in f.collect())
    assert ids(first, second) == ids(nudges.cooldown(df))


def test_daily_cap_first_then_weekly(spark):
    df = nudge_rows(spark)
    kept, day, week = set(), {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.generated_at, r.nudge_id)):
        d = (r.user_id, r.generated_at.date())
        day[d] = day.get(d, 0) + 1
        if day[d] > 2:
            continue
        w = (r.user_id, r.generated_at.isocalendar()[:2])
        week[w] = week.get(w, 0) + 1
        if week[w] <= 6:
            kept.add(r.nudge_id)
    assert {r.nudge_id for r in nudges.frequency_cap(df, 2, 6).collect()} == kept


def test_pages_cover_everything_once(spark):
    df = nudge_rows(spark, n=60)
    seen = [r.nudge_id for p in range(1, 20) for r in nudges.page(df, 4, p).collect()]
    assert sorted(seen) == sorted(r.nudge_id for r in df.collect())


def test_erasure_and_masking(seed):
    listed = seed.spark.createDataFrame([("c1",), ("c1",), (None,)], "user_id string")
    assert nudges.erase(seed.orders, listed, "customer_id").count() == 9
    masked = nudges.mask_pii(seed.customers.withColumn("phone", F.lit("+1-555-0199"))).filter("customer_id = 'c1'").first()
    assert masked.email_masked == "***@example.org" and masked.phone_masked == "+#-###-####" and len(masked.name_token) == 64
