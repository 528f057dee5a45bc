"""Ranks and per-key timelines against plain windows, with hot keys and ties."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.operators import ranking
from orderlens.operators.ranking import rank_desc
from orderlens.operators.timeline import asof_latest, with_history
from orderlens.streaming import limits, windows


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        v = None if i % 9 == 0 else rng.choice([5, 5, 5, rng.randint(0, 400), 10_000_000])  # ties and outliers
        rows.append((i, rng.choice(["a", "a", "b", None]), v))
    return spark.createDataFrame(rows, "id int, g string, v bigint").cache()


@pytest.mark.parametrize("within", [[], ["g"]])
@pytest.mark.parametrize("kind", ["bigint", "decimal(18,2)", "double"])
def test_bucketed_rank_equals_window_rank(values, within, kind, monkeypatch):
    df = values.withColumn("v", F.col("v").cast(kind))
    want = df.withColumn("r", F.rank().over(Window.partitionBy(*within).orderBy(F.col("v").desc_nulls_first())).cast("bigint"))
    assert same(rank_desc(df, "v", "r", within), want)
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 60)
    assert same(rank_desc(df, "v", "r", within, rows=900), want)


@pytest.mark.parametrize("where", ["1 = 0", "v IS NULL", "v = 5"])
def test_rank_of_odd_frames(values, where):
    df = values.filter(where)
    want = df.withColumn("r", F.lit(1).cast("bigint"))
    assert same(rank_desc(df, "v", "r"), want)


def events(spark, n=600, hot=0.4, seed=3, spread_minutes=60 * 24 * 5):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        user = 1 if rng.random() < hot else (None if rng.random() < 0.02 else rng.randint(2, 9))
        at = start + timedelta(minutes=rng.randint(0, spread_minutes), seconds=rng.choice([0, 0, 17]))
        rows.append((i, at, user, rng.choice(["view", "click", "purchase", "error"]), rng.randint(1, 50), '{"k": 5}'))
    return spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value int, props string").withColumn(
        "value", F.col("value").cast("decimal(12,2)")
    )


def test_history_equals_plain_windows(spark):
    df = events(spark)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = df.withColumn("prev_ts", F.lag("ts").over(w)).withColumn("seq", F.row_number().over(w).cast("bigint"))
    assert same(with_history(df, "user_id", "ts", ["ts", "event_id"]), want)


def test_asof_equals_brute_force(spark):
    df = events(spark).filter("user_id IS NOT NULL")
    left, right = df.filter("event_type = 'purchase'"), df.filter("event_type = 'view'").select("user_id", "ts", "event_id")
    got = asof_latest(left, right, "user_id", "ts", "ts", ["event_id"])
    views = right.collect()
    for r in got.collect():
        before = [(v.ts, v.event_id) for v in views if v.user_id == r.user_id and v.ts <= r.ts]
        assert ((r.state_ts, r.state_event_id) if r.state_ts else None) == (max(before) if before else None)


def test_sessions_equal_spark_session_windows(spark):
    df = events(spark, n=400, spread_minutes=60 * 24).filter("user_id IS NOT NULL")
    ours = windows.session_totals(df)
    theirs = (
        df.withColumn("ts", F.col("ts").cast("timestamp"))
        .groupBy("user_id", F.session_window("ts", "30 minutes").alias("w"))
        .agg(F.count(F.lit(1)).alias("events"), F.sum("value").cast("double").alias("total_value"))
        .select("user_id", F.col("w.start").cast("timestamp_ntz").alias("session_start"),
                F.col("w.end").cast("timestamp_ntz").alias("session_end"), "events", "total_value")
    )
    assert same(ours, theirs)


def test_sliding_panes_equal_the_built_in_window(spark):
    df = events(spark)
    theirs = df.groupBy(F.window("ts", "30 minutes", "5 minutes").alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("value").cast("double").alias("total_value")
    ).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", "total_value")
    assert same(theirs, windows.sliding(df, 30, 5))
    with pytest.raises(ValueError):
        windows.sliding(df, 30, 7)


def test_pattern_equals_a_scan_of_each_session(spark):
    df = events(spark, n=500, spread_minutes=60 * 30).filter("user_id IS NOT NULL")
    got = {(r.user_id, r.session_no) for r in windows.pattern_sessions(df, "view", "click", "purchase").collect()}
    want, per_user = set(), {}
    for r in sorted(df.collect(), key=lambda r: (r.ts, r.event_id)):
        per_user.setdefault(r.user_id, []).append(r)
    for user, rows in per_user.items():
        session, step, last = 0, 0, None
        for r in rows:
            if last is None or r.ts > last + timedelta(minutes=30):
                session, step = session + 1, 0
            last = r.ts
            if r.event_type == ("view", "click", "purchase", None)[step]:
                step += 1
                if step == 3:
                    want.add((user, session))
    assert got == want and got


def test_rate_limit_keeps_the_first(spark):
    df = events(spark, spread_minutes=30)
    kept = limits.rate_limit(df, per_minute=2)
    w = Window.partitionBy("user_id", F.date_trunc("minute", "ts")).orderBy("ts", "event_id")
    assert same(kept, df.withColumn("r", F.row_number().over(w)).filter("r <= 2").drop("r"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # bounded before and after the shuffle
