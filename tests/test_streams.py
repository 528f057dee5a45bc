from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderlens.plans import nudges, rules
from orderlens.sources import ingest
from orderlens.streaming import consume, nudge_stream, windows
from orderlens.streaming.source import event_stream, run_available
from tests.test_order import events


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture()
def folder(spark, tmp_path):
    base = events(spark, n=300, spread_minutes=60 * 24).withColumn("value", F.col("value").cast("double"))
    base.write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def static(spark, folder):
    return spark.read.parquet(f"{folder}/events.parquet").withColumn("value", F.col("value").cast("decimal(12,2)"))


def test_stream_and_batch_windows_agree(spark, folder, tmp_path):
    stream = event_stream(spark, folder)
    w = F.window("ts", "15 minutes").alias("w")
    totals = stream.withWatermark("ts", "10 minutes").groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("events"))
    out = totals.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "events")
    # Append mode emits a window once the watermark has passed it: a later event closes the rest.
    late = spark.createDataFrame(
        [(9999, datetime(2024, 1, 9), 1, "view", 1.0, "{}")], spark.read.parquet(f"{folder}/events.parquet").schema
    )
    for _ in range(2):
        run_available(out.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "check"))
        late.write.mode("append").parquet(f"{folder}/events.parquet")
    run_available(out.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "check"))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = windows.tumbling(static(spark, folder).filter("event_id <> 9999"), 15).select("window_start", "event_type", "events")
    assert same(got, want)


def test_session_stream_agrees_with_batch(spark, folder, tmp_path):
    stream = windows.session_stream(event_stream(spark, folder).filter("user_id IS NOT NULL"))
    sink = lambda: stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    run_available(sink(), str(tmp_path / "check"))
    late = spark.createDataFrame([(9999, datetime(2024, 1, 9), 1, "view", 1.0, "{}")], spark.read.parquet(f"{folder}/events.parquet").schema)
    late.write.mode("append").parquet(f"{folder}/events.parquet")
    run_available(sink(), str(tmp_path / "check"))
    want = windows.session_totals(static(spark, folder).filter("user_id IS NOT NULL AND event_id <> 9999"))
    assert same(spark.read.parquet(str(tmp_path / "out")), want)


def test_each_change_is_seen_once(spark, folder, tmp_path):
    for _ in range(2):
        consume.consume(event_stream(spark, folder), str(tmp_path / "out"), str(tmp_path / "check"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 300


def test_replayed_metric_batch_does_not_count_twice(spark, folder, tmp_path):
    run = lambda check: consume.upsert_metrics(
        event_stream(spark, folder), ["event_type"], {"n": F.count(F.lit(1))}, str(tmp_path / "out"), str(tmp_path / check)
    )
    run("a")
    run("b")  # a lost checkpoint replays batch 0 into the same folder
    total = consume.read_metrics(spark, str(tmp_path / "out"), ["event_type"], ["n"]).agg(F.sum("n")).first()[0]
    assert total == 300


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_late_rows_go_aside(spark, tmp_path, files_per_batch):
    at = datetime(2024, 1, 1, 12)
    ddl = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    row = lambda i, minutes: (i, at + timedelta(minutes=minutes), 1, "view", 1.0, "{}")
    mark = None
    for rows in ([row(1, 0), row(2, -60)], [row(5, 30), row(3, -10), row(4, -11)]):
        spark.createDataFrame(rows, ddl).repartition(3).write.mode("append").parquet(str(tmp_path / "events.parquet"))
        consume.split_late(event_stream(spark, str(tmp_path), files_per_batch), str(tmp_path / "out"), str(tmp_path / "check"), mark)
        mark = consume.newest(spark, str(tmp_path / "out"))
    got = {r.event_id: r.outcome for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: "on_time", 2: "on_time", 3: "on_time", 4: "late", 5: "on_time"}


def test_bad_lines_are_quarantined_with_their_text(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1,x\n2,y\nnope,z\n")
    (tmp_path / "in" / "b.txt").write_text("7,ignored\n")
    stream = ingest.csv_stream(spark, str(tmp_path / "in"), "id int, name string")
    ingest.land(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    rows = ingest.landed(spark, str(tmp_path / "out"), "id int, name string").collect()
    assert sorted(r.id for r in rows if r.outcome == "good") == [1, 2]
    assert [r[ingest.CORRUPT] for r in rows if r.outcome == "quarantine"] == ["nope,z"]


def test_event_problems(spark):
    ddl = "event_id int, event_type string, value double, props string"
    rows = [(1, "view", 5.0, '{"k": 1}'), (2, "nap", 5.0, '{"k": 1}'), (3, "view", 5.0, "{broken"), (4, "view", None, '{"k": 1}'), (5, "view", 500.0, '{"k": 1}')]
    got = {r.event_id: r.problem for r in ingest.validate(spark.createDataFrame(rows, ddl)).collect()}
    assert got == {1: None, 2: "unknown event type", 3: "payload lacks k", 4: "value out of range", 5: "value out of range"}


def test_nudges_from_a_stream_equal_nudges_from_a_table(spark, folder, tmp_path):
    rule = rules.Rule("r", "view", {"operator": "GREATER_THAN", "field": "value", "value": 20}, template_id="t")
    texts = spark.createDataFrame([("t", "hello {user}", "en", 1)], "template_id string, content_template string, locale string, version int")
    prepare = lambda df: df.withColumns({"locale": F.lit("en"), "customer_tier": F.lit("STANDARD"), "k": F.lit(1)})
    pick = lambda df: nudges.generate(prepare(df), [rule], texts).select("nudge_id", "user_id", "content")
    run_available(pick(event_stream(spark, folder)).writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "check"))
    assert same(spark.read.parquet(str(tmp_path / "out")), pick(static(spark, folder)))


def test_replayed_nudge_batch_sends_the_same(spark, folder, tmp_path):
    rule = rules.Rule("r", "view", {"operator": "GREATER_THAN", "field": "value", "value": 0}, template_id="t", cooldown_hours=3)
    texts = spark.createDataFrame([("t", "hello {user}", "en", 1)], "template_id string, content_template string, locale string, version int")
    prepare = lambda df: df.withColumns({"locale": F.lit("en"), "customer_tier": F.lit("STANDARD"), "k": F.lit(1)})
    sent = lambda: sorted((r.nudge_id, r.batch_id) for r in spark.read.parquet(str(tmp_path / "sent")).collect())
    run = lambda check: nudge_stream.run(event_stream(spark, folder), prepare, [rule], texts, str(tmp_path / "sent"), str(tmp_path / check))
    run("a")
    first = sent()
    run("b")  # the checkpoint is lost after the nudges were written
    assert sent() == first and first


def _shuffled(spark, folder, tmp_path):
    """The events twice, in eight files without order."""
    df = spark.read.parquet(f"{folder}/events.parquet")
    df.unionByName(df).orderBy(F.xxhash64("event_id", F.rand(3))).repartition(8).write.parquet(str(tmp_path / "mixed" / "events.parquet"))
    return str(tmp_path / "mixed")


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_dedup_does_not_depend_on_batches(spark, folder, tmp_path, files_per_batch):
    mixed = _shuffled(spark, folder, tmp_path)
    consume.dedup(event_stream(spark, mixed, files_per_batch), str(tmp_path / "out"), str(tmp_path / "check"))
    got = spark.read.parquet(str(tmp_path / "out")).select("event_id")
    assert same(got, static(spark, folder).select("event_id"))


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_cooldown_does_not_depend_on_batches(spark, folder, tmp_path, files_per_batch):
    rule = rules.Rule("r", "view", {"operator": "GREATER_THAN", "field": "value", "value": 0}, template_id="t", cooldown_hours=3)
    texts = spark.createDataFrame([("t", "hello {user}", "en", 1)], "template_id string, content_template string, locale string, version int")
    prepare = lambda df: df.withColumns({"locale": F.lit("en"), "customer_tier": F.lit("STANDARD"), "k": F.lit(1)})
    mixed = _shuffled(spark, folder, tmp_path)
    nudge_stream.run(event_stream(spark, mixed, files_per_batch), prepare, [rule], texts, str(tmp_path / "made"), str(tmp_path / "check"))
    got = nudge_stream.sent(spark, str(tmp_path / "made")).select("nudge_id")
    want = nudges.cooldown(nudges.generate(prepare(static(spark, folder)), [rule], texts)).select("nudge_id")
    assert want.count() and same(got, want)
