"""Auction and fragments against a plain search over edit strings, the query against its contract."""

import os
import random
import zlib
from collections import defaultdict

import pytest

from orderlens.llm import dialogue_repair as repair
from orderlens.llm import queries
from tests.llm.brute import sha

FOLDER = os.environ.get("SUITE_SF_DIR", "/root/testdata/sf0.001")
WHITE = " \t\n\x0b\x0c\r"


def best_edits(turns):
    """(cost, letters, lines) of one conversation given as (role, text, fault), by a full table of suffixes."""
    def better(a, b):
        return b if a is None or b[:2] < a[:2] else a

    n = len(turns)
    table = [{} for _ in range(n + 1)]
    for k in range(n, -1, -1):
        here = {s: None for s in "-sua"}
        if k == n:
            here["-"], here["a"] = (0, "", ()), (0, "", ())
        else:
            role, text, fault = turns[k]
            for s in here:
                more = 5 if fault == "truncated" else 0
                after = table[k + 1]
                if after[s]:
                    here[s] = better(here[s], (2 + after[s][0], "D" + after[s][1], after[s][2]))
                if fault in ("blank", "duplicate"):
                    continue
                free = "a" if s == "u" else "u"
                if role[:1] == free or (role[:1] == "s" and s == "-"):
                    to = after[role[:1]]
                    if to:
                        here[s] = better(here[s], (more + to[0], "K" + to[1], (f"{role}:{text}", *to[2])))
                if after[free]:
                    name = "user" if free == "u" else "assistant"
                    here[s] = better(here[s], (1 + more + after[free][0], "R" + after[free][1], (f"{name}:{text}", *after[free][2])))
        for _ in range(4):
            for s in list(here):
                free = "a" if s == "u" else "u"
                if here[free]:
                    c, letters, lines = here[free]
                    here[s] = better(here[s], (5 + c, "I" + letters, (("user:" if free == "u" else "assistant:"), *lines)))
        table[k] = here
    return table[0]["-"]


def expected(rows, also=()):
    """Rows (conv, turn, role, text) as the contract judges them."""
    by = defaultdict(list)
    for conv in also:
        by[conv]
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, judged = set(), []
        for _, role, text in turns:
            bare = text.rstrip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        known = [t[0] for t in turns if t[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        count = lambda f: sum(j[2] == f for j in judged)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, letters, lines = best_edits(judged)
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, letters, sha("\n".join(lines))))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def got(summary):
    rows = summary.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", summary.columns[-1]).collect()
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0))


def hurt(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        for _ in range(0 if kind == 0 else 2 if kind == 3 else 1):
            yield conv, turn, "user" if kind == 4 else role, text


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.QUERIES["op12_dialogue_repair"](spark, FOLDER)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got(found) == expected(hurt(rows), {r[0] for r in rows})


def random_rows(r, convs, most):
    rows = []
    for conv in convs:
        for k in range(r.randint(0, most)):
            turn = r.choice([k, k, k, k, k + 2, None, 0])
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u2"])
            text = r.choice(["Yes.", "No!", f"Text {k}.", f"Text {k}?  ", f"cut {k}", "cut", "", " \t", None, "é。"])
            rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("rows_most,partitions", [(20_000, 4), (5, 3)])
def test_random_conversations_whatever_the_fragments(spark, monkeypatch, rows_most, partitions):
    monkeypatch.setattr(repair, "ROWS", rows_most)
    r = random.Random(rows_most)
    rows = random_rows(r, range(25), 9) + random_rows(r, [None, 100], 40)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = repair.repair(df)
        assert got(found.summary) == expected(rows)
        turns = found.turns.orderBy("conv_id", "part", "chunk", "seq").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    lines = defaultdict(list)
    for t in turns:
        lines[t.conv_id].append(f"{t.role}:{t.text}")
    assert all(sha("\n".join(lines[x[0]])) == x[-1] for x in expected(rows))


def test_odd_rows(spark):
    rows = [(1, 0, "user", "Hi.")] * 500 + [(1, 1, "assistant", "Yes.")] + [(2, None, None, None)] * 3 + [(3, 5, "system", "Be kind."), (3, 9, "user", "x" * 100_000)]
    df = spark.createDataFrame([(*r, 7, "c") for r in rows], "conv_id long, turn long, role string, text string, blank int, conv string")
    also = spark.createDataFrame([(9,), (9,), (1,), (None,)], "conv_id long")
    assert got(repair.repair(df, also=also).summary) == expected(rows, [9, 1, None])
    empty = repair.repair(df.limit(0))
    assert empty.summary.collect() == [] and empty.turns.collect() == []
    wide = spark.createDataFrame([("a", -(2**63), "user", "x."), ("a", 2**63 - 1, "assistant", "y.")], "conv_id string, turn long, role string, text string")
    assert [r.gaps for r in repair.repair(wide).summary.collect()] == [None]


def test_auction_prices_are_distances():
    r = random.Random(1)
    for _ in range(400):
        steps = [r.choice(["s", "u", "a", "o", "S", "U", "A", 1, 3]) for _ in range(r.randint(0, 9))]
        ends = repair.ENDS if r.random() < 0.5 else tuple(r.randint(0, 6) for _ in range(4))
        found = repair.prices(steps, ends)
        far = [[ends[s] if k == len(steps) else repair.FAR for s in range(4)] for k in range(len(steps) + 1)]
        for _ in range(len(steps) + 6):  # plain relaxation
            for k in range(len(steps), -1, -1):
                for s in range(4):
                    far[k][s] = min([far[k][s], *(c + far[layer][t] for _, c, layer, t in repair.arcs(steps, k, s))])
        assert found == far
        # Cut anywhere, the matrices of the parts give the same distance.
        cut = r.randint(0, len(steps))
        a, b = repair.matrix(steps[:cut]), repair.matrix(steps[cut:])
        for s in range(4):
            assert found[0][s] == min(a[4 * s + t] + b[4 * t + u] + ends[u] for t in range(4) for u in range(4))


def test_long_conversation_takes_linear_time():
    r = random.Random(4)
    steps = [r.choice(["u", "a", "U", "A", "o", 1]) for _ in range(20_000)]
    cost, letters = repair.cheapest(steps)
    assert len(letters) >= 20_000 and cost > 0
