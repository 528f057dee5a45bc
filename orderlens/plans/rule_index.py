"""Rules as a table: an index of conditions joined to events.

Compiled rules (``rules.py``) are one expression each, so the plan grows with their number.
Here a rule is rows: its conditions become clauses (an OR of ANDs), and a clause is an array
of terms.  Every clause is filed under one of its terms, by event type:

* an equality or IN with fixed values: under (field, value), once for each value;
* else the fixed bounds of one number: under (field, node).  The bounds that occur, or
  quantiles of them, cut the field into cells, the leaves of a binary tree; an interval is the
  few nodes that make up the cells wholly inside it, and the cells in which its ends lie;
* else under the event type alone.

An event looks up its own values, one key for each field in use and one for each level of a
tree.  What is found under a node needs no test of the bounds; only clauses with more terms,
or found at an end, are tested term by term with one expression for all rules.  Plan size follows the
number of fields and event types.  The join is an equality join: Spark broadcasts a small
index by its size, and splits a hot key of events where the index is large.

Numbers are compared as doubles.  A comparison with NULL is false; a clause without terms is
true.  Rules that are not active, or not in force at the event's time, do not match.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from orderlens.plans.rules import Rule

CELLS = 4096
BLOCK = 1 << 17  #: rules packed into one row, about
TERM = "field int, op string, num double, high double, text string, texts array<string>, other int"
CLAUSES = f"rule_id string, event_type string, valid_from timestamp_ntz, valid_to timestamp_ntz, clause int, terms array<struct<{TERM}>>"

_OPERATORS = {"EQUALS": "=", "GREATER_THAN": ">", "CONTAINS": "CONTAINS", "=": "=", "!=": "!=", ">": ">", "<": "<", "IN": "IN", "BETWEEN": "BETWEEN", "REGEX": "REGEX"}


def term(field: int, op: str, number: bool, value, other: int | None = None) -> tuple:
    """One comparison as a row of ``TERM``; ``op`` is marked ``n`` for numbers and ``t`` for texts."""
    if op in ("CONTAINS", "REGEX"):
        return field, op, None, None, str(value), None, None
    kind = ("n" if number else "t") + op
    if other is not None:
        return field, kind + "f", None, None, None, None, other
    if op == "IN":
        values = [v.strip() for v in str(value).split(",")]
        return field, kind, None, None, None, [repr(float(v)) for v in values] if number else values, None
    if op == "BETWEEN":
        low, high = [v.strip() for v in str(value).split(",")]
        return (field, kind, float(low), float(high), None, None, None) if number else (field, kind, None, None, low, [high], None)
    if number:
        return field, kind, float(value), None, None, None, None
    return field, kind, None, None, str(value), None, None


class Fields:
    """The event columns that rules may read, with their numbers and whether they hold numbers."""

    def __init__(self, events: DataFrame, names: Sequence[str]):
        self.names = list(names)
        self.numeric = [isinstance(events.schema[n].dataType, NumericType) for n in self.names]

    def values(self) -> Column:
        """All of them as (number, text), by number of the field."""
        return F.array(*[
            F.struct((F.col(n).cast("double") if number else F.lit(None).cast("double")).alias("num"), F.col(n).cast("string").alias("text"))
            for n, number in zip(self.names, self.numeric)
        ])

    def term(self, name: str, operator: str, value, dynamic: bool = False) -> tuple:
        if operator not in _OPERATORS:
            raise ValueError(f"Unknown operator: {operator}")
        at = self.names.index(name)
        return term(at, _OPERATORS[operator], self.numeric[at], value, self.names.index(value) if dynamic else None)


def _tree(node: Mapping, fields: Fields) -> list[list[tuple]]:
    """A condition tree as an OR of ANDs."""
    operator = node.get("operator")
    if operator == "AND":
        parts = [_tree(c, fields) for c in node["conditions"]]
        return [list(itertools.chain(*choice)) for choice in itertools.product(*parts)]
    if operator == "OR":
        return [clause for c in node["conditions"] for clause in _tree(c, fields)]
    return [[fields.term(node["field"], operator, node["value"])]]


def _flat(rows: Sequence[Mapping], fields: Fields) -> list[list[tuple]]:
    """Condition rows folded from the left, as an OR of ANDs."""
    out = None
    for row in sorted(rows, key=lambda r: r["sequence_order"]):
        one = fields.term(row["field"], row["operator"], row["value"], row.get("value_type", "static") != "static")
        if out is None:
            out = [[one]]
        elif row.get("logical_operator", "AND") == "OR":
            out.append([one])
        else:
            out = [clause + [one] for clause in out]
    return [[]] if out is None else out


def clauses(spark: SparkSession, rules: Sequence[Rule], fields: Fields) -> DataFrame:
    """Clauses of configured rules; rules that come as data have this schema already."""
    rows = []
    for rule in rules:
        if rule.is_active:
            found = _tree(rule.conditions, fields) if isinstance(rule.conditions, Mapping) else _flat(rule.conditions, fields)
            rows += [(rule.rule_id, rule.event_type, rule.effective_from, rule.effective_to, i, terms) for i, terms in enumerate(found)]
    plain = CLAUSES.replace("timestamp_ntz", "string")
    df = spark.createDataFrame(rows, plain)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})


def _together(parts: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


# --- filing -----------------------------------------------------------------------------------

_EQUAL = ("n=", "t=", "nIN", "tIN")
_BOUND = ("n>", "n<", "nBETWEEN")


def _filed_under(terms: Column) -> Column:
    """The term that a clause is filed under; NULL where there is none to use."""
    equal = F.filter(terms, lambda t: t["op"].isin(*_EQUAL))
    bound = F.filter(terms, lambda t: t["op"].isin(*_BOUND))
    return F.coalesce(F.get(equal, F.lit(0)), F.get(bound, F.lit(0)))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once a row: the optimizer copies no expression across a generator."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _bounds(filed: DataFrame) -> DataFrame:
    """The interval of one number: from all the clause's bounds of the same field; an open end is NULL.

    A bound that is NULL never holds, nor does a clause with one.
    """
    top = lambda t: F.when(t["op"] == "nBETWEEN", t["high"]).otherwise(t["num"])
    filed = _once(filed, bounds=F.filter("terms", lambda t: t["op"].isin(*_BOUND) & (t["field"] == F.col("filed.field"))))
    ends = _once(
        filed.filter(F.forall("bounds", lambda t: t["num"].isNotNull() & top(t).isNotNull())), field=F.col("filed.field"),
        low=F.array_max(F.transform(F.filter("bounds", lambda t: t["op"] != "n<"), lambda t: t["num"])),
        high=F.array_min(F.transform(F.filter("bounds", lambda t: t["op"] != "n>"), top)),
    )
    return ends.filter(F.coalesce(F.col("low") <= F.col("high"), F.lit(True))).withColumns({
        "above": F.exists("bounds", lambda t: (t["op"] == "n>") & (t["num"] == F.col("low"))),
        "below": F.exists("bounds", lambda t: (t["op"] == "n<") & (t["num"] == F.col("high"))),
    })


class Index:
    """Filed clauses and the cuts of their cells."""

    def __init__(self, table: DataFrame, cuts: dict, lookups: list, blocks: int = 1):
        self.table = table  #: event_type, place, field, key, rule_id, terms, earlier clauses, validity
        self.cuts = cuts  #: (event type, field) → rising cuts, fewer than CELLS
        self.lookups = lookups  #: (event type, field or None, "equal" / "cell" / "all", whether all is settled by the key, levels) in use
        self.blocks = blocks  #: blocks that the rules of one key are packed in


def _number_key(value: Column) -> Column:
    """A number as text, zero without a sign."""
    return (value + F.lit(0.0)).cast("string")


# The cells of a field are its cuts and the gaps around them, in order: gap, cut, gap, cut, …, gap.
# They are the leaves of a binary tree, numbered as in a heap: 1 is the root, n has 2n and 2n + 1.

_BLOCK = 64


def _doubles(values: Sequence[float]) -> str:
    return f"array({', '.join(repr(float(v)) + 'D' for v in values)})" if values else "cast(array() as array<double>)"


def _cell(value: Column, cuts: Sequence[float]) -> Column:
    """The number of the value's cell, by two short searches; NULL for NULL."""
    blocks = [cuts[i : i + _BLOCK] for i in range(0, len(cuts), _BLOCK)] or [[]]
    ends, parts = F.expr(_doubles([b[-1] for b in blocks[:-1]])), F.expr(f"array({', '.join(_doubles(b) for b in blocks)})")

    def search(v: Column) -> Column:
        below = lambda of: F.size(F.filter(of, lambda c: c < v))
        within = lambda block: _let(F.get(parts, block), lambda mine: 2 * (block * _BLOCK + below(mine)) + F.array_contains(mine, v).cast("int"))
        return F.when(v.isNotNull(), _let(below(ends), within))

    return _let(value, search)


def _depth(cuts: Sequence[float]) -> int:
    return (2 * len(cuts)).bit_length()


def _path(cell: Column, cuts: Sequence[float], levels: int) -> Column:
    """The nodes above a cell and its leaf, as far as ``levels`` above the leaves."""
    up = F.array(*[F.lit(j) for j in range(levels + 1)])
    return _let(cell + F.lit(1 << _depth(cuts)), lambda leaf: F.when(leaf.isNotNull(), F.transform(up, lambda j: F.call_function("shiftright", leaf, j))))


def _cover(cuts: Sequence[float]) -> Column:
    """The fewest nodes whose leaves are the cells from ``first`` to ``last``; none is wider than their number."""
    depth = _depth(cuts)
    ends = F.struct((F.col("first") + F.lit(1 << depth)).alias("a"), (F.col("last") + F.lit((1 << depth) + 1)).alias("b"))
    # On each level: the left end if it is a right child, the right end if its neighbour to the left is a left child.
    level = lambda e, j: F.struct(
        F.call_function("shiftright", e["a"] + F.call_function("shiftleft", F.lit(1), j) - 1, j).alias("a"), F.call_function("shiftright", e["b"], j).alias("b"))
    nodes = lambda x: F.when(x["a"] < x["b"], F.array(F.when(x["a"] % 2 == 1, x["a"]), F.when(x["b"] % 2 == 1, x["b"] - 1)))
    found = _let(ends, lambda e: F.transform(F.transform(F.sequence(F.lit(0), F.col("levels")), lambda j: level(e, j)), nodes))
    return F.array_compact(F.flatten(F.filter(found, lambda x: x.isNotNull())))


def _in_cells(clauses: DataFrame, cuts: Sequence[float]) -> DataFrame:
    """Intervals with the cells that lie wholly inside, ``first`` to ``last``, and those cut by an end, ``edges``."""
    last = 2 * len(cuts)
    placed = _once(clauses, at_low=_cell(F.col("low"), cuts), at_high=_cell(F.col("high"), cuts))
    cut = lambda c: F.col(c) % 2 == 1
    return _once(placed, **{
        "first": F.when(F.col("low").isNull(), 0).when(cut("at_low") & ~F.col("above"), F.col("at_low")).otherwise(F.col("at_low") + 1),
        "last": F.when(F.col("high").isNull(), last).when(cut("at_high") & ~F.col("below"), F.col("at_high")).otherwise(F.col("at_high") - 1),
        "edges": F.array_compact(F.array_distinct(F.array(*[F.when(~cut(c), F.col(c)) for c in ("at_low", "at_high")]))),
    })


def _leaves(cuts: Sequence[float]) -> Column:
    return F.transform("edges", lambda c: c + F.lit(1 << _depth(cuts)))


def _cuts(in_cells: DataFrame) -> dict:
    """For each event type and field with bounds, its finite ends if they are few, else quantiles of them."""
    ends = in_cells.select("event_type", "field", F.explode(F.array("low", "high")).alias("end")).filter(F.abs("end") < float("inf"))
    found = {}
    many = False
    steps = [i / CELLS for i in range(1, CELLS)]
    asked = F.percentile_approx("end", F.expr(_doubles(steps)), 100 * CELLS).alias("cuts")
    for r in ends.distinct().groupBy("event_type", "field").agg(F.count("end").alias("n"), asked).collect():
        found[r["event_type"], r["field"]] = r["cuts"]
        many |= r["n"] >= CELLS
    if many:
        # Each end counts as often as it occurs: an end that many clauses share becomes a cut.
        for r in ends.groupBy("event_type", "field").agg(F.count_distinct("end").alias("n"), asked).collect():
            if r["n"] >= CELLS:
                found[r["event_type"], r["field"]] = r["cuts"]
    return {k: sorted({float(c) + 0.0 for c in v}) for k, v in found.items()}


def build(rules: DataFrame) -> Index:
    """Files the clauses (schema ``CLAUSES``).

    Each clause brings the earlier ones of its rule: it counts only where none of them holds,
    so a rule matches an event once, and no matches need to meet to be told apart.
    """
    rules = rules.filter("rule_id IS NOT NULL").withColumn("filed", _filed_under(F.col("terms")))
    op = F.col("filed.op")
    rules = rules.withColumn("place", F.when(op.isNull(), "all").when(op.isin(*_EQUAL), "equal").otherwise("cell"))
    cuts = _cuts(_bounds(rules.filter("place = 'cell'")))
    none = F.array().cast(rules.select(F.array("terms").alias("terms")).schema["terms"].dataType)
    # Only rules with several clauses have earlier ones.
    several = rules.groupBy("rule_id").agg(F.min("clause").alias("a"), F.max("clause").alias("b")).filter("a < b").select("rule_id")
    if several.isEmpty():
        filed = rules.withColumn("earlier", none)
    else:
        whole = rules.join(several, "rule_id", "left_semi").groupBy("rule_id").agg(F.collect_list(F.struct("clause", "terms")).alias("all_clauses"))
        earlier = F.transform(F.filter("all_clauses", lambda c: c["clause"] < F.col("clause")), lambda c: c["terms"])
        filed = rules.join(whole, "rule_id", "left").withColumn("earlier", F.coalesce(earlier, none))

    kept = ["event_type", "place", "field", "key", "rule_id", "terms", "earlier", "valid_from", "valid_to"]
    number = F.substring(op, 1, 1) == "n"
    single = F.when(number, _number_key(F.col("filed.num"))).otherwise(F.col("filed.text"))
    listed = F.transform("filed.texts", lambda v: F.when(number, _number_key(v.try_cast("double"))).otherwise(v))
    # The term that the key stands for holds wherever the key is found: it is not tested again.
    rest = F.filter("terms", lambda t: ~t.eqNullSafe(F.col("filed")))
    everywhere = filed.filter("place = 'all'").withColumns({"field": F.lit(-1), "levels": F.lit(0), "keys": F.array(F.lit(""))})
    equal = filed.filter("place = 'equal'").withColumns({
        "field": F.col("filed.field"), "levels": F.lit(0), "terms": rest, "keys": F.array_distinct(F.when(op.endswith("IN"), listed).otherwise(F.array(single)))})
    parts = [everywhere, equal]
    in_cells = _bounds(filed.filter("place = 'cell'"))
    # So do the bounds, in cells wholly inside.
    other = F.filter("terms", lambda t: ~(t["op"].isin(*_BOUND) & (t["field"] == F.col("field"))))
    for (event_type, field), points in cuts.items():
        mine = _in_cells(in_cells.filter((F.col("event_type") == event_type) & (F.col("field") == field)), points)
        inside = _once(mine.filter("first <= last"), levels=F.floor(F.log2(F.col("last") - F.col("first") + 1)).cast("int"))
        parts.append(inside.withColumns({"terms": other, "keys": _cover(points).cast("array<string>")}))
        parts.append(mine.filter(F.size("edges") > 0).withColumns({
            "levels": F.lit(0), "keys": _leaves(points).cast("array<string>")}))
    settled = ((F.size("terms") == 0) & (F.size("earlier") == 0)).alias("settled")
    marks = [df.select(F.lit(i).alias("part"), "event_type", "field", "place", "levels", settled) for i, df in enumerate(parts)]
    used = _together(marks).groupBy("part", "event_type", "field", "place", "settled").agg(F.max("levels").alias("levels"), F.count("part").alias("n")).collect()
    levels = {}
    for r in used:
        key = r["event_type"], r["field"], r["place"], r["settled"]
        levels[key] = max(levels.get(key, 0), r["levels"])
    found = sorted({r["part"] for r in used}) or [0]
    table = _together([parts[i].withColumn("key", F.explode("keys")).select(*kept) for i in found])
    blocks = 1 + sum(r["n"] for r in used if r["settled"]) // BLOCK
    return Index(table, cuts, sorted(((*k, v) for k, v in levels.items()), key=repr), blocks)


# --- matching ---------------------------------------------------------------------------------


def _holds(t: Column, values: Column) -> Column:
    """Whether one term holds; the same expression for all rules."""
    mine, other, op = F.get(values, t["field"]), F.get(values, t["other"]), t["op"]
    num, text = mine["num"], mine["text"]
    test = (
        F.when(op == "n>", num > t["num"]).when(op == "n<", num < t["num"]).when(op == "n=", num == t["num"]).when(op == "n!=", num != t["num"])
        .when(op == "nBETWEEN", num.between(t["num"], t["high"])).when(op == "nIN", F.array_contains(F.transform(t["texts"], lambda v: v.try_cast("double")), num))
        .when(op == "t=", text == t["text"]).when(op == "t!=", text != t["text"]).when(op == "t>", text > t["text"]).when(op == "t<", text < t["text"])
        .when(op == "tIN", F.array_contains(t["texts"], text)).when(op == "tBETWEEN", text.between(t["text"], F.get(t["texts"], F.lit(0))))
        .when(op == "CONTAINS", F.contains(text, t["text"])).when(op == "REGEX", F.rlike(text, t["text"]))
        .when(op == "n>f", num > other["num"]).when(op == "n<f", num < other["num"]).when(op == "n=f", num == other["num"]).when(op == "n!=f", num != other["num"])
        .when(op == "t>f", text > other["text"]).when(op == "t<f", text < other["text"]).when(op == "t=f", text == other["text"]).when(op == "t!=f", text != other["text"])
    )
    return F.coalesce(test, F.lit(False))


def _asks(keys: Column, place: str, field: int) -> Column:
    return F.transform(keys, lambda k: F.struct(F.lit(place).alias("place"), F.lit(field).alias("field"), k.alias("key")))


def _asked(index: Index, fields: Fields, settled: bool) -> Column | None:
    """The keys that an event looks up, by its type."""
    asked = None
    for event_type in sorted({e for e, _, _, s, _ in index.lookups if s == settled}):
        keys = []
        for _, field, place, _, levels in (x for x in index.lookups if x[0] == event_type and x[3] == settled):
            if place == "all":
                found = F.array(F.lit(""))
            elif place == "equal":
                name = fields.names[field]
                found = F.array(_number_key(F.col(name).cast("double")) if fields.numeric[field] else F.col(name).cast("string"))
            else:
                cuts = index.cuts[event_type, field]
                found = F.coalesce(_path(_cell(F.col(fields.names[field]).cast("double"), cuts), cuts, levels), F.array().cast("array<int>")).cast("array<string>")
            keys.append(_asks(found, place, field))
        asked = F.when(F.col("event_type") == event_type, F.concat(*keys)) if asked is None else asked.when(F.col("event_type") == event_type, F.concat(*keys))
    return asked


def matches(events: DataFrame, index: Index, fields: Fields) -> DataFrame:
    """The events with ``rule_id``, once for each rule that matches; columns of the events stay.

    Most pairs are settled by their key.  These are joined apart: the rules of a key are
    packed, no terms are carried or tested, so a match costs no more than its row.
    """
    table = index.table.withColumnsRenamed({"event_type": "r_type", "place": "r_place", "field": "r_field", "key": "r_key"})
    alone = (F.size("terms") == 0) & (F.size("earlier") == 0)
    holds = lambda terms: F.forall(terms, lambda t: _holds(t, F.col("field_values")))
    parts = []
    for settled in (True, False):
        asked = _asked(index, fields, settled)
        if asked is None:
            continue
        types = sorted({x[0] for x in index.lookups if x[3] == settled})
        own = [F.col(c).alias(f"event_{i}") for i, c in enumerate(events.columns)]
        rows = events.filter(F.col("event_type").isin(types)).select(
            *own, F.col("ts").cast("timestamp_ntz").alias("at"), fields.values().alias("field_values"), F.col("event_type").alias("of_type"), F.explode(asked).alias("ask"))
        on = (
            (F.col("of_type") == F.col("r_type")) & (F.col("ask.place") == F.col("r_place")) & (F.col("ask.field") == F.col("r_field"))
            & (F.col("ask.key") == F.col("r_key")) & (F.col("at") >= F.col("valid_from")) & (F.col("at") < F.col("valid_to"))
        )
        if settled:
            block = F.pmod(F.xxhash64("rule_id"), F.lit(index.blocks)).alias("block")
            packed = table.filter(alone).groupBy("r_type", "r_place", "r_field", "r_key", "valid_from", "valid_to", block).agg(F.collect_list("rule_id").alias("rule_ids"))
            # What a task puts out does not follow what it reads: adaptive execution must not merge these tasks by their size.
            tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            packed = packed.repartition(tasks, "r_type", "r_place", "r_field", "r_key")
            hit = packed.join(rows, on).withColumn("rule_id", F.explode("rule_ids"))
        else:
            hit = table.filter(~alone).join(rows, on).filter(holds(F.col("terms")) & ~F.exists("earlier", holds))
        parts.append(hit.select(*[F.col(f"event_{i}").alias(c) for i, c in enumerate(events.columns)], "rule_id"))
    return _together(parts) if parts else events.withColumn("rule_id", F.lit("")).limit(0)
