"""Change feeds kept as folders, each read by consumers with positions of their own.

A feed is a folder of parquet files to which changes are appended.  A consumer is a folder
with the checkpoint of its stream and, for each batch it has finished, the names of the files
that the batch held.  The names are written last, so a batch that fails stays pending and is
handed over again under the same number; a handler that overwrites its own folder for that
number has applied each change once.  Pending changes are the rows of files without a name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlens.operators.changes import with_state
from orderlens.streaming.source import run_available

_FILE = "__feed_file"
_NAMES = "file string, batch_id bigint"


@dataclass(frozen=True)
class Feed:
    """A named feed: its folder, the schema of its rows, and the folder of one consumer."""

    name: str
    folder: str
    schema: StructType
    consumer: str

    @property
    def finished(self) -> str:
        return f"{self.consumer}/files"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def publish(changes: DataFrame, name: str, folder: str, consumer: str) -> Feed:
    """Appends changes to the feed's folder."""
    changes.write.mode("append").parquet(folder)
    return Feed(name, folder, changes.schema, consumer)


def _files(spark: SparkSession, feed: Feed) -> DataFrame:
    """(file, n): the rows of each file of the feed, from the files' own counts."""
    return spark.read.schema(feed.schema).parquet(feed.folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))


def pending(spark: SparkSession, feed: Feed) -> DataFrame:
    """One row: the changes of the feed that its consumer has not finished."""
    files = _files(spark, feed)
    if _exists(spark, feed.finished):
        files = files.join(spark.read.schema(_NAMES).parquet(feed.finished).select("file").distinct(), "file", "left_anti")
    return files.agg(F.lit(feed.name).alias("feed"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("pending_changes"))


def status(spark: SparkSession, feeds: Sequence[Feed]) -> DataFrame:
    """A row for each feed: pending changes and a state word."""
    out = None
    for feed in feeds:
        row = pending(spark, feed)
        out = row if out is None else out.unionByName(row)
    return with_state(out)


def consume(spark: SparkSession, feed: Feed, handle: Callable[[DataFrame, int], None]) -> None:
    """Hands what is pending to ``handle(batch, batch_id)`` and moves the consumer's position."""
    rows = (
        spark.readStream.schema(feed.schema).parquet(feed.folder).select("*", F.col("_metadata.file_path").alias(_FILE))
    )

    def step(batch: DataFrame, batch_id: int) -> None:
        handle(batch.drop(_FILE), batch_id)
        names = batch.select(F.col(_FILE).alias("file")).distinct()
        names.write.mode("overwrite").parquet(f"{feed.finished}/batch_id={batch_id}")

    run_available(rows.writeStream.foreachBatch(step), f"{feed.consumer}/checkpoint")


def force_processing(spark: SparkSession, feeds: Sequence[Feed], handlers: Mapping[str, Callable[[DataFrame, int], None]]) -> DataFrame:
    """Processes every feed that holds data; (feed, pending_before, pending_after) in the order given.

    The counts, one row a feed, are read before and after.
    """
    before = {r.feed: r.pending_changes for r in status(spark, feeds).collect()}
    for feed in feeds:
        if before[feed.name]:
            consume(spark, feed, handlers[feed.name])
    counts = F.create_map(*[x for f in feeds for x in (F.lit(f.name), F.lit(before[f.name]).cast("bigint"))])
    order = F.create_map(*[x for k, f in enumerate(feeds) for x in (F.lit(f.name), F.lit(k))])
    return status(spark, feeds).select(
        "feed", counts[F.col("feed")].alias("pending_before"), F.col("pending_changes").alias("pending_after"), order[F.col("feed")].alias("place"))


def summary(runs: DataFrame) -> DataFrame:
    """Names of the feeds that were processed, in their order, as one sentence."""
    named = F.array_sort(F.collect_list(F.when(F.col("pending_before") > 0, F.struct("place", "feed"))))  # one row a feed
    names = F.array_join(F.transform(F.col("named"), lambda x: x["feed"]), ", ")
    return runs.agg(named.alias("named")).select(
        F.when(F.size("named") > 0, F.concat(F.lit("Forced processing completed for: "), names))
        .otherwise("No pending data found in streams. Nothing to process.")
        .alias("summary")
    )
