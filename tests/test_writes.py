import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlens.operators import changes, retention, upsert
from orderlens.plans import jobs as job_plans
from orderlens.sources import ingest
from orderlens.sources.versions import write_clustered, write_snapshot

DDL = "k int, v string, n int"
rows = st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 3))), max_size=6)
QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, d):
    return spark.createDataFrame([(k, *v) for k, v in d.items()], DDL)


def as_dict(df):
    got = [tuple(r) for r in df.select("k", "v", "n").collect()]
    out = {k: (v, n) for k, v, n in got}
    assert len(out) == len(got)
    return out


@QUICK
@given(a=rows, b=rows)
def test_feed_turns_the_first_snapshot_into_the_second(spark, a, b):
    before, after = frame(spark, a), frame(spark, b)
    feed = changes.change_feed(before, after, ["k"])
    assert as_dict(changes.apply_feed(before, feed, ["k"])) == b
    assert changes.change_feed(after, after, ["k"]).count() == 0


@QUICK
@given(a=rows, b=rows)
def test_upsert_is_a_dictionary_update_and_idempotent(spark, a, b):
    target, source = frame(spark, a), frame(spark, b)
    once = upsert.upsert(target, source, ["k"])
    assert as_dict(once) == {**a, **b}
    assert as_dict(upsert.upsert(once, source, ["k"])) == {**a, **b}


def test_update_is_a_delete_and_an_insert(spark):
    feed = changes.change_feed(frame(spark, {1: ("a", 1), 2: ("b", None)}), frame(spark, {1: ("a", 2), 2: ("b", None)}), ["k"]).collect()
    assert sorted((r.k, r.n, r.action, r.is_update) for r in feed) == [(1, 1, "DELETE", True), (1, 2, "INSERT", True)]


def test_duplicate_source_key_raises(spark):
    source = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], DDL)
    with pytest.raises(PySparkException, match="duplicate key"):
        upsert.upsert(frame(spark, {1: ("x", 0)}), source, ["k"]).collect()
    # also when only the key is read
    with pytest.raises(PySparkException, match="duplicate key"):
        upsert.upsert(frame(spark, {1: ("x", 0)}), source, ["k"]).select("k").collect()


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, "t", 1)], DDL)
    source = spark.createDataFrame([(None, "s", 2), (None, "s", 3)], DDL)
    out = sorted((r.v, r.n) for r in upsert.upsert(target, source, ["k"]).collect())
    assert out == [("s", 2), ("s", 3), ("t", 1)]
    kept = upsert.keyed_update(target, source, ["k"], {"v": lambda t, s: s("v")}).collect()
    assert [(r.v, r.n) for r in kept] == [("t", 1)]


def test_update_sees_old_values_and_condition(spark):
    target, source = frame(spark, {1: ("a", 1), 2: ("b", 5)}), frame(spark, {1: ("x", 10), 2: ("y", 1), 3: ("z", 3)})
    out = upsert.upsert(
        target, source, ["k"], update={"n": lambda t, s: t("n") + s("n"), "v": lambda t, s: F.concat(t("v"), t("n").cast("string"))},
        when=lambda t, s: s("n") > t("n"),
    )
    assert as_dict(out) == {1: ("a1", 11), 2: ("b", 5), 3: ("z", 3)}


def test_append_fills_defaults(spark):
    out = upsert.append(frame(spark, {1: ("a", 1)}), spark.createDataFrame([(2,)], "k int"), {"v": F.lit("d")})
    assert as_dict(out) == {1: ("a", 1), 2: ("d", None)}


def test_delete_keeps_rows_with_unknown_predicate(spark):
    df = frame(spark, {1: ("a", 1), 2: ("b", None), 3: ("c", 3)})
    gone, kept = retention.split_where(df, F.col("n") > 2)
    assert sorted(as_dict(kept)) == [1, 2] and sorted(as_dict(gone)) == [3]


def test_retry_needs_more_than_ten_idle_minutes(seed):
    at = lambda now: {r.job_id: r.status for r in job_plans.retry_failed(seed.jobs, now).collect()}
    assert at("2024-02-12 06:20:00")["j5"] == "FAILED"  # idle exactly ten minutes
    later = at("2024-02-12 06:20:01")
    assert later["j5"] == "PENDING" and later["j2"] == "FAILED"  # j2 has no retry left


def test_status_update_keeps_location_and_overwrites_error(seed):
    jobs = seed.jobs.withColumn("output_location", F.lit("old"))
    updates = seed.spark.createDataFrame(
        [("j2", "RUNNING", None, None, None), ("nope", "RUNNING", None, None, None)],
        "job_id string, status string, output_location string, error_message string, execution_time_seconds decimal(10,2)",
    )
    out = {r.job_id: r for r in job_plans.update_status(jobs, updates, "2024-03-01").collect()}
    assert len(out) == 5 and out["j2"].status == "RUNNING" and out["j2"].output_location == "old" and out["j2"].error_message is None
    assert out["j5"].error_message == "boom"


def test_dispatch_states(seed):
    outcomes = seed.spark.createDataFrame([("j4", True, None), ("j3", False, "no worker")], "job_id string, accepted boolean, error string")
    out = {r.job_id: r for r in job_plans.dispatch(seed.jobs, outcomes, "2024-03-01").collect()}
    assert out["j4"].status == "SENT_TO_ECS" and out["j3"].status == "FAILED"
    assert out["j3"].retry_count == 1 and out["j3"].error_message == "dispatch failed: no worker"


def test_created_ids_repeat(seed):
    requests = seed.spark.range(3).select(
        F.col("id").alias("request_id"), F.lit("n").alias("job_name"), F.lit("REPORT").alias("job_type"),
        F.lit("u").alias("created_by"), F.lit("{}").alias("input_data"), F.lit(None).cast("int").alias("priority"),
    )
    first = sorted(r.job_id for r in job_plans.create_jobs(requests, "2024-01-01 00:00:00").collect())
    again = job_plans.create_jobs(requests, "2024-01-01 00:00:00").collect()
    assert first == sorted(r.job_id for r in again) and len(set(first)) == 3 and again[0].priority == 3


def test_force_processing_text(seed):
    none = seed.orders.filter("1 = 0")
    text = lambda feeds: job_plans.force_processing(feeds).first().summary
    assert text({"a": none, "b": none}) == "No pending data found in streams. Nothing to process."
    assert text({"a": seed.orders, "b": none, "c": seed.items}) == "Forced processing completed for: a, c"


def test_snapshots_keep_the_old_one_readable(spark, tmp_path):
    first = write_snapshot(frame(spark, {1: ("a", 1)}), str(tmp_path), sort_by=["k"], bloom_on=["k"])
    reader = spark.read.parquet(first)
    second = write_snapshot(upsert.upsert(reader, frame(spark, {1: ("b", 2), 2: ("c", 3)}), ["k"]), str(tmp_path))
    assert as_dict(reader) == {1: ("a", 1)} and as_dict(spark.read.parquet(second)) == {1: ("b", 2), 2: ("c", 3)}


def test_clustered_tables_hold_the_same_rows(spark, seed, tmp_path):
    for name, df in (("jobs", seed.jobs), ("orders", seed.orders), ("products", seed.products)):
        path = write_clustered(str(tmp_path / name), name, df)
        assert spark.read.parquet(path).exceptAll(df).count() == 0


def test_null_keys_make_no_false_changes(spark):
    ddl = "k int, v string"
    before = spark.createDataFrame([(1, "a"), (None, "n"), (None, "n"), (None, "gone")], ddl)
    after = spark.createDataFrame([(1, "b"), (None, "n"), (None, "n"), (None, "new")], ddl)
    feed = changes.change_feed(before, after, ["k"])
    got = sorted((r.k or 0, r.v, r.action, r.is_update) for r in feed.collect())
    assert got == [(0, "gone", "DELETE", False), (0, "new", "INSERT", False), (1, "a", "DELETE", True), (1, "b", "INSERT", True)]
    assert changes.change_feed(before, before, ["k"]).count() == 0
    back = changes.apply_feed(before, feed, ["k"])
    assert back.exceptAll(after).count() == 0 and after.exceptAll(back).count() == 0


def test_rows_that_tie_with_the_mark_are_pulled(spark):
    source = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02"), (4, "2024-01-03")], "k int, d string").selectExpr("k", "cast(d as timestamp_ntz) as d")
    assert sorted(r.k for r in ingest.incremental_pull(source, source.filter("k <= 2"), "d", ["k"]).collect()) == [3, 4]


def test_rewrite_archives_and_keeps_every_row_once(spark, tmp_path):
    df = frame(spark, {1: ("a", 1), 2: ("b", None), 3: (None, 3), 4: ("a", 0)})
    kept, archived = retention.rewrite(df, F.col("n") > 0, str(tmp_path / "kept"), str(tmp_path / "archive"))
    assert as_dict(spark.read.parquet(kept)) == {2: ("b", None), 4: ("a", 0)}
    assert as_dict(spark.read.parquet(archived)) == {1: ("a", 1), 3: (None, 3)}
    again, none = retention.rewrite(spark.read.parquet(kept), F.lit(False), str(tmp_path / "kept"))
    assert again != kept and none is None and spark.read.parquet(kept).count() == spark.read.parquet(again).count() == 2
