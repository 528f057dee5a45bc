"""Keyed state on streams against the batch forms, for other orders of arrival, and its size."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderlens.plans import nudges, rules
from orderlens.plans.rules import Rule
from orderlens.streaming import keyed, windows
from orderlens.streaming.source import event_stream
from tests.test_order import events


@pytest.fixture(scope="module")
def base(spark):
    return events(spark, n=240, spread_minutes=60 * 20).withColumn("value", F.col("value").cast("double")).persist()


def arrivals(spark, base, folder, order):
    """One file for each of six slices of time, written in the given order, then the closing event."""
    slices = [base.filter(F.pmod(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (4 * 3_600_000_000)), F.lit(6)) == i) for i in order]
    last = spark.createDataFrame([(9999, datetime(2025, 6, 1), None, keyed.CLOSING, 0.0, "{}")], base.schema)
    for part in [*slices, last]:
        part.select(*base.columns).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


def run(spark, stream, folder):
    """Rows of the stream's sink and the number of keys that its state still holds."""
    with keyed.rocksdb(spark):
        query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start()
        query.awaitTermination()
    left = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    return spark.read.schema(stream.schema).parquet(f"{folder}/out"), left


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("order,lateness", [((0, 1, 2, 3, 4, 5), "400 days"), ((5, 2, 0, 4, 1, 3), "400 days")])
def test_sessions_and_patterns_in_any_order(spark, base, tmp_path, order, lateness):
    arrivals(spark, base, str(tmp_path), order)
    found, left = run(spark, keyed.open_sessions(event_stream(spark, str(tmp_path), 1), 45, lateness), str(tmp_path))
    batch = base.withColumn("value", F.col("value").cast("decimal(12,2)"))
    assert rows(keyed.session_totals(found)) == rows(windows.session_totals(batch, 45))
    wanted = windows.pattern_sessions(batch, "view", "click", "purchase", gap_minutes=45).drop("session_no")
    assert rows(keyed.pattern_sessions(found)) == rows(wanted)
    assert left <= 1  # what came behind the closing event's watermark, if anything


def test_merging_sessions_finds_patterns_across_pieces():
    a = [0, 10, 2, 5, [1, 1], None, [[10, 2]], False]
    b = [20, 30, 1, 5, None, [30, 9], [], False]
    assert keyed.joined(a, b) == keyed.joined(b, a) == [0, 30, 3, 10, [1, 1], [30, 9], [], True]
    c = [20, 30, 1, 5, None, [30, 9], [[40, 1]], False]
    assert keyed.joined([0, 10, 1, 5, [12, 1], None, [[10, 2]], False], c) == [0, 30, 2, 10, [12, 1], [30, 9], [[10, 2], [40, 1]], False]


RULE = Rule("r", "view", {"operator": "GREATER_THAN", "field": "value", "value": 5}, nudge_type="IN_APP", template_id="t", cooldown_hours=3)


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4, 5), (3, 5, 1, 0, 4, 2)])
def test_cooldown_in_any_order(spark, base, tmp_path, order):
    arrivals(spark, base, str(tmp_path), order)
    templates = rules.config_frame(spark, [("t", "hi {user}", "en", 1)], "template_id string, content_template string, locale string, version int")
    dressed = lambda df: df.withColumns({"locale": F.lit("en"), "customer_tier": F.lit("STANDARD"), "k": F.lit(1)})
    made = nudges.generate(dressed(event_stream(spark, str(tmp_path), 1).withWatermark("ts", "400 days")), [RULE], templates)
    found, left = run(spark, keyed.cooldown(made), str(tmp_path))
    batch = nudges.cooldown(nudges.generate(dressed(base.withColumn("value", F.col("value").cast("decimal(12,2)"))), [RULE], templates))
    assert rows(found) == rows(batch.filter("user_id IS NOT NULL").select(*found.columns).unionByName(batch.filter("user_id IS NULL").select(*found.columns)))
    assert left == 0


def asof(spark, folder, lateness, per_batch=1):
    stream = event_stream(spark, folder, per_batch)
    kind = F.col("event_type")
    return keyed.asof_state(stream.filter(kind.isin("purchase", keyed.CLOSING)), stream.filter(kind.isin("view", keyed.CLOSING)), lateness)


def test_state_as_of_in_any_order(spark, base, tmp_path):
    from orderlens.operators.timeline import asof_latest

    arrivals(spark, base, str(tmp_path), (4, 1, 5, 0, 3, 2))
    found, _ = run(spark, asof(spark, str(tmp_path), "400 days"), str(tmp_path))
    left, right = (base.filter(F.col("event_type") == k).select("user_id", "ts", "event_id", F.col("value").cast("decimal(12,2)").cast("double").alias("value")) for k in ("purchase", "view"))
    want = asof_latest(left.select("event_id", "user_id", "ts"), right, "user_id", "ts", "ts", ["event_id", "value"])
    assert rows(found) == rows(want.select(*found.columns))


def test_a_state_behind_the_watermark_changes_nothing(spark, base, tmp_path):
    at = lambda h: datetime(2024, 1, 1, h)
    first = [(1, at(1), 7, "view", 1.0, "{}"), (2, at(2), 7, "purchase", 1.0, "{}"), (3, at(9), 7, "purchase", 1.0, "{}"), (4, at(9), 7, "view", 2.0, "{}")]
    late = [(5, at(8), 7, "view", 3.0, "{}"), (6, at(10), 7, "purchase", 1.0, "{}"), (7, at(1), 7, "view", 4.0, "{}")]
    last = [(9, datetime(2025, 6, 1), None, keyed.CLOSING, 0.0, "{}")]
    for part in (first, late, last):
        spark.createDataFrame(part, base.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    found, _ = run(spark, asof(spark, str(tmp_path), "10 minutes"), str(tmp_path))
    assert sorted((r.event_id, r.state_event_id) for r in found.collect()) == [(2, 1), (3, 4), (6, 4)]
