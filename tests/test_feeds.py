"""Feeds as folders: positions of consumers, failures between batch and position, pending counts."""

import pytest

from orderlens.operators import changes
from orderlens.streaming import feeds


def rows(spark, values):
    return spark.createDataFrame([(k, v) for k, v in values.items()], "k int, v int")


@pytest.fixture()
def feed(spark, tmp_path):
    change = changes.change_feed(rows(spark, {1: 1, 2: 2}), rows(spark, {1: 5, 3: 3}), ["k"])
    return feeds.publish(change, "f", str(tmp_path / "feed"), str(tmp_path / "consumer"))


def left(spark, feed):
    return feeds.pending(spark, feed).first().pending_changes


def keeper(spark, target):
    return lambda batch, n: batch.write.mode("overwrite").parquet(f"{target}/batch_id={n}")


def test_position_moves_with_what_is_processed(spark, feed, tmp_path):
    assert left(spark, feed) == 4  # an update is two rows
    target = str(tmp_path / "applied")
    feeds.consume(spark, feed, keeper(spark, target))
    assert left(spark, feed) == 0
    later = changes.change_feed(rows(spark, {1: 5, 3: 3}), rows(spark, {1: 5}), ["k"])
    feeds.publish(later, "f", feed.folder, feed.consumer)
    assert left(spark, feed) == 1
    feeds.consume(spark, feed, keeper(spark, target))
    feeds.consume(spark, feed, keeper(spark, target))
    assert left(spark, feed) == 0
    got = spark.read.parquet(target).select("k", "v", "action").collect()
    assert sorted(map(tuple, got)) == [(1, 1, "DELETE"), (1, 5, "INSERT"), (2, 2, "DELETE"), (3, 3, "DELETE"), (3, 3, "INSERT")]


def test_a_failed_batch_stays_pending_and_is_applied_once(spark, feed, tmp_path):
    target = str(tmp_path / "applied")

    def fails(batch, n):
        keeper(spark, target)(batch, n)
        raise ValueError("stopped after writing")

    with pytest.raises(Exception, match="stopped after writing"):
        feeds.consume(spark, feed, fails)
    assert left(spark, feed) == 4
    feeds.consume(spark, feed, keeper(spark, target))
    assert left(spark, feed) == 0 and spark.read.parquet(target).count() == 4


def test_consumers_have_positions_of_their_own(spark, feed, tmp_path):
    other = feeds.Feed("g", feed.folder, feed.schema, str(tmp_path / "other"))
    feeds.consume(spark, feed, keeper(spark, str(tmp_path / "one")))
    assert {r.feed: (r.pending_changes, r.state) for r in feeds.status(spark, [feed, other]).collect()} == {"f": (0, "UP_TO_DATE"), "g": (4, "HAS_DATA")}
    runs = feeds.force_processing(spark, [feed, other], {"f": None, "g": keeper(spark, str(tmp_path / "two"))})
    assert [tuple(r)[:3] for r in runs.orderBy("place").collect()] == [("f", 0, 0), ("g", 4, 0)]
    assert feeds.summary(runs).first().summary == "Forced processing completed for: g"
    again = feeds.force_processing(spark, [feed, other], {})
    assert feeds.summary(again).first().summary == "No pending data found in streams. Nothing to process."


def test_an_empty_publication_leaves_nothing_to_do(spark, tmp_path):
    none = changes.change_feed(rows(spark, {1: 1}), rows(spark, {1: 1}), ["k"])
    feed = feeds.publish(none, "f", str(tmp_path / "feed"), str(tmp_path / "consumer"))
    assert left(spark, feed) == 0
    feeds.consume(spark, feed, keeper(spark, str(tmp_path / "applied")))
    assert left(spark, feed) == 0
