"""Digest reconciliation against a plain comparison; equal tables exchange digests only."""

import random
from collections import Counter, defaultdict

import pytest

from orderlens.operators import digests

DDL = "k long, part string, v string, w double"


def plain(a, b):
    out, sides = [], []
    for rows in (a, b):
        by = defaultdict(Counter)
        for r in rows:
            by[r[:2]][r[2:]] += 1
        sides.append(by)
    for key in {*sides[0], *sides[1]}:
        x, y = (s.get(key, Counter()) for s in sides)
        if x != y:
            n, m = sum(x.values()), sum(y.values())
            out.append((*key, n, m, "only_in_first" if not m else "only_in_second" if not n else "changed"))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [1, 2])
def test_all_differences_are_found(spark, levels):
    r = random.Random(levels)
    a = [(r.choice([i, i, None]), r.choice(["x", "y", None]), r.choice(["p", "q", "", None]), r.choice([1.0, None])) for i in range(600) for _ in range(r.choice([1, 1, 2]))]
    b = [x if r.random() < 0.97 else (*x[:2], "changed", x[3]) for x in a if r.random() < 0.98] + [(9999, "x", "new", 1.0)] + a[:3]
    first, second = (spark.createDataFrame(rows, DDL) for rows in (a, b))
    found = sorted(map(tuple, digests.reconcile(first, second, ["k", "part"], levels=levels).collect()), key=repr)
    assert found == plain(a, b)
    assert digests.reconcile(first, first.orderBy("v"), ["k", "part"], levels=levels).count() == 0
    assert digests.reconcile(first.limit(0), second.limit(0), ["k", "part"]).count() == 0


def test_levels_nest_and_few_ranges_are_opened(spark):
    rows = [(i, "x", "v", 1.0) for i in range(5_000)]
    first = spark.createDataFrame(rows, DDL)
    second = spark.createDataFrame([x if x[0] != 77 else (77, "x", "other", 1.0) for x in rows], DDL)
    sides = [digests.hashed(d, ["k", "part"], ["v", "w"]) for d in (first, second)]
    outer, inner = (digests.differing_ranges(*sides, ["k", "part"], level).collect() for level in (0, 1))
    assert len(outer) == len(inner) == 1 and inner[0].r % digests.FAN == outer[0].r
