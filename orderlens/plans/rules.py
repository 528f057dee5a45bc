"""Rules compiled to column expressions.

A rule set is configuration: it is compiled once on the driver into one boolean
Column per rule, so evaluating any number of events is a projection, with no join and
no Python per row.  Rules are grouped by event type: an event is tested by the rules of
its own type only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import ntz


def config_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A configuration table; the planner broadcasts it if its size allows that."""
    return spark.createDataFrame(list(rows), schema)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    event_type: str
    conditions: Mapping | Sequence
    priority: int = 1
    kind: str = "real_time"
    is_active: bool = True
    effective_from: str = "2000-01-01 00:00:00"
    effective_to: str = "2100-01-01 00:00:00"
    nudge_type: str = "IN_APP"
    channels: tuple[str, ...] = ("IN_APP",)
    template_id: str = "basic"
    cooldown_hours: int = 24
    audience: tuple[str, ...] = field(default=("STANDARD", "PREMIUM", "ENTERPRISE"))


def compile_tree(node: Mapping, fields: Mapping[str, Column]) -> Column:
    """A JSON condition tree: AND, OR, EQUALS, GREATER_THAN, CONTAINS; unknown operators raise."""
    operator = node.get("operator")
    if operator in ("AND", "OR"):
        parts = [compile_tree(child, fields) for child in node["conditions"]]
        if not parts:
            return F.lit(operator == "AND")
        out = parts[0]
        for part in parts[1:]:
            out = (out & part) if operator == "AND" else (out | part)
        return out
    if operator not in ("EQUALS", "GREATER_THAN", "CONTAINS"):
        raise ValueError(f"Unknown operator: {operator}")
    column, value = fields[node["field"]], F.lit(node["value"])
    if operator == "EQUALS":
        test = column == value
    elif operator == "GREATER_THAN":
        test = column > value
    else:
        test = F.contains(column.cast("string"), value.cast("string"))
    return F.coalesce(test, F.lit(False))


def compile_rows(rows: Sequence[Mapping], fields: Mapping[str, Column]) -> Column:
    """Flat condition rows folded left by ``sequence_order``.

    A row has field, operator (=, !=, >, <, IN, BETWEEN, REGEX), value, value_type
    (static text, dynamic: another event field, reference: an enrichment field) and
    the logical operator that joins it to the rows before it.
    """
    out = None
    for row in sorted(rows, key=lambda r: r["sequence_order"]):
        column = fields[row["field"]]

        def operand(text: str) -> Column:
            if row.get("value_type", "static") == "static":
                return F.lit(text)
            return fields[text]

        text, operator = row["value"], row["operator"]
        if operator == "=":
            test = column == operand(text)
        elif operator == "!=":
            test = column != operand(text)
        elif operator == ">":
            test = column > operand(text)
        elif operator == "<":
            test = column < operand(text)
        elif operator == "IN":
            test = column.isin(*[v.strip() for v in text.split(",")])
        elif operator == "BETWEEN":
            low, high = [v.strip() for v in text.split(",")]
            test = column.between(operand(low), operand(high))
        elif operator == "REGEX":
            test = column.cast("string").rlike(text)
        else:
            raise ValueError(f"Unknown operator: {operator}")
        test = F.coalesce(test, F.lit(False))
        if out is None:
            out = test
        else:
            out = (out | test) if row.get("logical_operator", "AND") == "OR" else (out & test)
    return F.lit(True) if out is None else out


def compile_rule(rule: Rule, fields: Mapping[str, Column]) -> Column:
    if isinstance(rule.conditions, Mapping):
        return compile_tree(rule.conditions, fields)
    return compile_rows(rule.conditions, fields)


def in_force(rule: Rule, ts: Column) -> Column:
    """In force at the event's time."""
    return (ts >= ntz(rule.effective_from)) & (ts < ntz(rule.effective_to))


def by_type(rules: Sequence[Rule], test: Callable[[int, Rule], Column]) -> Column:
    """The non-NULL tests of the active rules for the event's type, as an array; NULL where the type has none."""
    groups: dict[str, list[Column]] = {}
    for i, rule in enumerate(rules):
        if rule.is_active:
            groups.setdefault(rule.event_type, []).append(test(i, rule))
    out = F.when(F.lit(False), F.array(*[test(i, r) for i, r in enumerate(rules[:1])]))  # gives the type without any active rule
    for event_type, tests in groups.items():
        out = out.when(F.col("event_type") == event_type, F.array_compact(F.array(*tests)))
    return out


def event_fields(events: DataFrame) -> dict[str, Column]:
    return {c: F.col(c) for c in events.columns}


def candidates(events: DataFrame, rules: Sequence[Rule], kinds: Sequence[str] = ("real_time", "batch", "hybrid")) -> DataFrame:
    """Events joined with the rules in force for them: a broadcast join with a time range."""
    rows = [
        (r.rule_id, r.event_type, r.kind, r.priority, r.effective_from, r.effective_to)
        for r in rules
        if r.is_active and r.kind in kinds
    ]
    schema = "rule_id string, rule_event string, kind string, priority int, valid_from string, valid_to string"
    table = config_frame(events.sparkSession, rows, schema)
    ts = F.col("ts").cast("timestamp_ntz")
    on = (
        (F.col("event_type") == F.col("rule_event"))
        & (ts >= F.col("valid_from").cast("timestamp_ntz"))
        & (ts < F.col("valid_to").cast("timestamp_ntz"))
    )
    return events.join(table, on).drop("rule_event", "valid_from", "valid_to")


def outcomes(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per event and rule in force, with whether the conditions hold."""
    fields = event_fields(events)
    ts = F.col("ts").cast("timestamp_ntz")

    def test(_, r: Rule) -> Column:
        return F.when(in_force(r, ts), F.struct(F.lit(r.rule_id).alias("rule_id"), compile_rule(r, fields).alias("matched")))

    return events.withColumn("hit", F.explode(by_type(rules, test))).select("*", "hit.*").drop("hit")


def matches(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per event and matching rule; unmatched pairs are dropped before the explode."""
    fields = event_fields(events)
    ts = F.col("ts").cast("timestamp_ntz")
    found = by_type(rules, lambda _, r: F.when(in_force(r, ts) & compile_rule(r, fields), F.lit(r.rule_id)))
    return events.withColumn("rule_id", F.explode(found))


def hit_rates(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Evaluations and hits per rule; (rule, matched) pairs are counted in each task before the shuffle."""
    fields = event_fields(events)
    ts = F.col("ts").cast("timestamp_ntz")

    def test(i: int, r: Rule) -> Column:
        return F.when(in_force(r, ts), F.struct(F.lit(i).alias("rule_no"), compile_rule(r, fields).alias("matched")))

    counted = (
        events.select(F.inline(by_type(rules, test))).groupBy("rule_no")
        .agg(F.count(F.lit(1)).alias("evaluations"), F.count_if("matched").alias("hits"))
    )
    named = config_frame(events.sparkSession, [(i, r.rule_id) for i, r in enumerate(rules)], "rule_no int, rule_id string")
    none = F.lit(0).cast("long")
    rate = F.col("hits") / F.nullif(F.col("evaluations").cast("double"), F.lit(0.0))
    return named.join(counted, "rule_no", "left").select(
        "rule_id", F.coalesce("evaluations", none).alias("evaluations"), F.coalesce("hits", none).alias("hits"),
    ).withColumn("hit_rate", rate)


def execution_log(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every candidate with SUCCESS (matched), SKIPPED (not matched) or FAILED (unreadable payload)."""
    status = (
        F.when(F.col("k").isNull(), "FAILED").when(F.col("matched"), "SUCCESS").otherwise("SKIPPED")
    )
    done = outcomes(events, rules)
    return done.select(
        F.md5(F.concat_ws("|", "rule_id", F.col("event_id").cast("string"))).alias("execution_id"),
        "rule_id", "event_id", "user_id", F.col("ts").alias("execution_timestamp"), status.alias("execution_status"),
    )
