"""Rules as an index against compiled rules and a plain evaluation."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from orderlens.plans import rule_index, rules
from orderlens.plans.rules import Rule

DDL = "event_id long, ts timestamp_ntz, event_type string, value decimal(12,2), k int, score double, tier string, note string"
NAMES = ("event_type", "value", "k", "score", "tier", "note")


@pytest.fixture(scope="module")
def events(spark):
    import decimal
    r = random.Random(2)
    pick = lambda *xs: r.choice([*xs, None])
    rows = [
        (i, dt.datetime(2024, 1, 1 + i % 28), r.choice(["view", "click", "buy", "other"]), pick(decimal.Decimal(r.randint(0, 4000)).scaleb(-2)),
         pick(r.randint(-3, 30)), pick(0.0, -0.0, 1.5, r.random() * 10, 1e300, float("nan")), pick("A", "B", "C", ""), pick("abc", "b.c", "xyz 9"))
        for i in range(250)
    ]
    return spark.createDataFrame(rows, DDL).repartition(3).persist()


def leaf(r):
    kind = r.randint(0, 5)
    if kind == 0:
        return {"operator": "EQUALS", "field": "tier", "value": r.choice("ABCD")}
    if kind == 1:
        return {"operator": "EQUALS", "field": r.choice(["k", "score"]), "value": r.choice([0, 1.5, r.randint(-3, 30)])}
    if kind == 2:
        return {"operator": "CONTAINS", "field": "note", "value": r.choice(["b", "9", "."])}
    return {"operator": "GREATER_THAN", "field": r.choice(["value", "k", "score"]), "value": r.randint(-2, 38)}


def tree(r, depth=2):
    if depth == 0 or r.random() < 0.4:
        return leaf(r)
    return {"operator": r.choice(["AND", "OR"]), "conditions": [tree(r, depth - 1) for _ in range(r.randint(1, 3))]}


def flat(r):
    rows = []
    for i in range(r.randint(0, 3)):
        field, operator, value, kind = r.choice([
            ("k", "IN", "1, 2, 5, 8", "static"), ("tier", "IN", "A, C", "static"), ("value", "BETWEEN", f"{r.randint(0, 20)}, {r.randint(10, 40)}", "static"),
            ("k", "<", str(r.randint(0, 30)), "static"), ("k", "!=", "7", "static"), ("tier", "!=", "B", "static"), ("value", ">", "k", "dynamic"), ("k", "=", "score", "reference"),
            ("note", "REGEX", "b.c", "static"), ("tier", ">", "A", "static"), ("tier", "=", "note", "dynamic"),
        ])
        rows.append(dict(sequence_order=i, field=field, operator=operator, value=value, value_type=kind, logical_operator=r.choice(["AND", "AND", "OR"])))
    return rows


def some_rules(r, n):
    out = []
    for i in range(n):
        late = r.random() < 0.2
        out.append(Rule(f"r{i}", r.choice(["view", "click", "buy"]), tree(r) if r.random() < 0.6 else flat(r), is_active=r.random() < 0.95,
                        effective_from="2024-01-10 00:00:00" if late else "2000-01-01 00:00:00", effective_to="2024-01-20 00:00:00" if late else "2100-01-01 00:00:00"))
    return out


def pairs(df):
    return sorted((r.event_id, r.rule_id) for r in df.select("event_id", "rule_id").collect())


def test_index_equals_compiled_rules(spark, events):
    made = some_rules(random.Random(4), 200)
    fields = rule_index.Fields(events, NAMES)
    index = rule_index.build(rule_index.clauses(spark, made, fields))
    found = pairs(rule_index.matches(events, index, fields))
    assert found == pairs(rules.matches(events, made)) and len(found) > 1000
    assert len(found) == len(set(found))


def test_no_rules_and_clashing_names(spark, events):
    fields = rule_index.Fields(events, NAMES)
    for made in ([], [Rule("off", "view", [], is_active=False)]):
        index = rule_index.build(rule_index.clauses(spark, made, fields))
        assert rule_index.matches(events, index, fields).collect() == []
    odd = events.withColumns({"terms": F.lit(1), "earlier": F.lit("x"), "key": F.lit(2), "event": F.lit(3)})
    index = rule_index.build(rule_index.clauses(spark, [Rule("all", "view", [])], fields))
    found = rule_index.matches(odd, index, fields)
    assert found.columns == [*odd.columns, "rule_id"] and found.count() == events.filter("event_type = 'view'").count()
    with pytest.raises(ValueError):
        rule_index.clauses(spark, [Rule("bad", "view", {"operator": "NEAR", "field": "k", "value": 1})], fields)


def test_ten_thousand_rules(spark, events):
    r = random.Random(8)
    low = [(r.choice(["view", "click"]), r.choice("ABCD"), r.randint(0, 38), r.randint(0, 8)) for _ in range(10_000)]
    made = [
        Rule(f"r{i}", e, [dict(sequence_order=0, field="value", operator="BETWEEN", value=f"{a}, {a + w}")] if i % 2 else
             {"operator": "AND", "conditions": [{"operator": "EQUALS", "field": "tier", "value": t}, {"operator": "GREATER_THAN", "field": "k", "value": a}]})
        for i, (e, t, a, w) in enumerate(low)
    ]
    fields = rule_index.Fields(events, NAMES)
    want = sorted(
        (x.event_id, f"r{i}") for x in events.collect() for i, (e, t, a, w) in enumerate(low)
        if x.event_type == e and (x.value is not None and a <= x.value <= a + w if i % 2 else x.tier == t and x.k is not None and x.k > a)
    )
    index = rule_index.build(rule_index.clauses(spark, made, fields))
    found = rule_index.matches(events, index, fields)
    assert pairs(found) == want
    # An event is tested by part of the rules of its type.
    asked = index.table.filter("event_type = 'view' AND place = 'cell'").groupBy("key").count().agg(F.max("count")).first()[0]
    assert asked < 0.5 * sum(1 for i, (e, *_) in enumerate(low) if i % 2 and e == "view")


def test_plan_size_does_not_follow_the_rules(spark, events):
    fields = rule_index.Fields(events, NAMES)

    def size(n):
        made = [Rule(f"r{i}", "view", {"operator": "AND", "conditions": [{"operator": "EQUALS", "field": "tier", "value": "A"}, {"operator": "GREATER_THAN", "field": "k", "value": i % 40}]}) for i in range(n)]
        rows = rule_index.clauses(spark, made, fields)
        plan = rule_index.matches(events, rule_index.build(rows), fields)._jdf.queryExecution().optimizedPlan().toString()
        return len(re.sub(r"LocalRelation.*|LogicalRDD.*", "", plan))

    assert size(2_000) < 1.2 * size(20)


def _intervals(spark, rows):
    """Rules on ``value`` as data: (id, operator, num, high)."""
    table = spark.createDataFrame(rows, "rule_id string, op string, num double, high double")
    term = "struct(1 AS field, op, num, high, cast(null AS string) AS text, cast(null AS array<string>) AS texts, cast(null AS int) AS other)"
    return table.selectExpr(
        "rule_id", "'view' AS event_type", "timestamp_ntz'2000-01-01' AS valid_from", "timestamp_ntz'2100-01-01' AS valid_to", "0 AS clause", f"array({term}) AS terms")


@pytest.mark.parametrize("few", [True, False])
def test_a_match_of_an_interval_needs_no_test(spark, monkeypatch, few):
    inf, nan = float("inf"), float("nan")
    r = random.Random(3)
    if not few:  # more ends than cuts: the cells of the ends are tested
        monkeypatch.setattr(rule_index, "CELLS", 8)
    ends = [0.0, -0.0, 1.5, 2.0, 2.5, 7.0, 7.25, 9.0] + ([] if few else [r.random() * 10 for _ in range(60)])
    rules_ = [(f"b{i}", "nBETWEEN", r.choice(ends), r.choice(ends)) for i in range(80)]
    rules_ += [(f"{op}{i}", op, r.choice(ends), None) for i in range(40) for op in ("n>", "n<")]
    rules_ += [("twice", "nBETWEEN", 1.5, 7.0)] * 2 + [("none", "nBETWEEN", 1.5, None), ("null", "n>", None, None), (None, "n>", 1.0, None)]
    rules_ += [("all", "nBETWEEN", -inf, inf), ("top", "n>", inf, None), ("nan", "n<", nan, None), ("end", "nBETWEEN", 2.0, nan), ("inf", "n<", inf, None)]
    values = [None, nan, inf, -inf, *ends, *[e + 0.01 for e in ends], 100.0, -5.0]
    events = spark.createDataFrame([(i, dt.datetime(2024, 1, 1), "view", v) for i, v in enumerate(values)], "event_id long, ts timestamp_ntz, event_type string, value double")
    fields = rule_index.Fields(events, ("event_type", "value"))
    index = rule_index.build(_intervals(spark, rules_))
    found = pairs(rule_index.matches(events, index, fields))
    key = lambda x: (x != x, 0 if x != x else x)  # noqa: E731 NaN is the largest number

    def holds(op, v, num, high):
        if v is None or num is None or (op == "nBETWEEN" and high is None):
            return False
        return key(v) > key(num) if op == "n>" else key(v) < key(num) if op == "n<" else key(num) <= key(v) <= key(high)

    assert found == sorted((i, name) for i, v in enumerate(values) for name, op, num, high in rules_ if name and holds(op, v, num, high))
    cell = index.table.filter("place = 'cell'")
    tested = cell.filter("size(terms) > 0").select("rule_id").distinct().count()
    if few:  # all but bounds that are no finite number
        assert {x.rule_id for x in cell.filter("size(terms) > 0").collect()} <= {"all", "top", "nan", "end", "inf"}
    else:
        asked = cell.filter("size(terms) > 0").groupBy("key").count().agg(F.max("count")).first()[0]
        assert asked < 0.5 * tested
    # Nodes, not cells: a wide interval is a few rows.
    assert cell.groupBy("rule_id").count().agg(F.max("count")).first()[0] <= 2 * 2 * rule_index._depth(index.cuts["view", 1])
