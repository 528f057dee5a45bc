"""Feed consumption: read once, late rows apart, idempotent metric batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.streaming.source import run_available


def consume(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Appends unseen rows; a second run with the same checkpoint finds nothing."""
    run_available(stream.writeStream.format("parquet").option("path", target), checkpoint)


def dedup(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Appends the first copy of each event id, however the copies fall into batches.

    Copies of an event carry its time, so a batch is compared with the written days that
    it touches and with no others.  No row is dropped for being late, and a replayed
    batch compares itself with the batches before it and rewrites its own folder.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropDuplicates(["event_id"]).withColumn("day", F.to_date("ts"))
        if batch_id > 0:
            days = fresh.select("day").distinct()
            known = spark.read.schema(f"event_id {dict(batch.dtypes)['event_id']}, batch_id bigint, day date").parquet(target)
            known = known.filter(F.col("batch_id") < batch_id).join(days, "day", "left_semi").select("event_id")
            fresh = fresh.join(known, "event_id", "left_anti")
        fresh.write.mode("overwrite").partitionBy("day").parquet(f"{target}/batch_id={batch_id}")

    run_available(stream.writeStream.foreachBatch(write), checkpoint)


def newest(spark: SparkSession, target: str):
    """The newest event time written so far: the mark for the next run."""
    return spark.read.parquet(target).agg(F.max("ts").alias("newest")).first()["newest"]


def split_late(stream: DataFrame, target: str, checkpoint: str, mark=None, lateness_minutes: int = 10) -> None:
    """Writes every row with ``outcome`` on_time or late.

    A row is late when it lies more than the allowed time behind ``mark``, the newest
    event of earlier *runs*.  The caller sets it once for a run, and again when the run
    is repeated, so the outcome does not depend on how files fall into batches.
    """
    late = F.lit(False) if mark is None else F.col("ts") < F.lit(mark) - F.make_dt_interval(mins=F.lit(lateness_minutes))

    def write(batch: DataFrame, batch_id: int) -> None:
        split = batch.withColumn("outcome", F.when(late, "late").otherwise("on_time"))
        split.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    run_available(stream.writeStream.foreachBatch(write), checkpoint)


def upsert_metrics(stream: DataFrame, keys: list[str], sums: dict, target: str, checkpoint: str) -> None:
    """Keeps additive metrics from a stream without rewriting the table per batch.

    Each micro-batch stores its partial sums in a folder of its own, overwritten on
    replay, so the table is idempotent by batch id.  ``read_metrics`` adds them up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        partial = batch.groupBy(*keys).agg(*[expr.alias(name) for name, expr in sums.items()])
        partial.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    run_available(stream.writeStream.foreachBatch(write), checkpoint)


def read_metrics(spark: SparkSession, target: str, keys: list[str], sums: list[str]) -> DataFrame:
    return spark.read.parquet(target).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def changed_keys(stream: DataFrame, keys: list[str], target: str, checkpoint: str) -> None:
    """Per batch: distinct changed keys with their change counts, written once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("changes")).write.mode("overwrite").parquet(
            f"{target}/batch_id={batch_id}"
        )

    run_available(stream.writeStream.foreachBatch(write), checkpoint)
