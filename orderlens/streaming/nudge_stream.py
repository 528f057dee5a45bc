"""Nudges from an event stream; the cooldown is applied over all micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.plans import nudges
from orderlens.plans.rules import Rule
from orderlens.streaming.source import run_available


def run(
    stream: DataFrame,
    enrich: Callable[[DataFrame], DataFrame],
    rules: Sequence[Rule],
    templates: DataFrame,
    target: str,
    checkpoint: str,
) -> None:
    """Writes the nudges that each batch makes to a folder named by the batch.

    Which of them are sent is decided from event time over all batches (:func:`sent`),
    so it does not depend on how events fall into batches or in what order they arrive.
    Of the nudges of one key and hour only the first can ever be sent; the others are
    dropped before they are written.  A replayed batch rewrites its own folder.
    """
    key = ["user_id", "nudge_type", "rule_id", "cooldown_hours"]

    def step(batch: DataFrame, batch_id: int) -> None:
        events = batch.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        made = nudges.generate(enrich(events), rules, templates)
        names = made.columns
        first = made.groupBy(*key, nudges.hour_number(F.col("generated_at")).alias("h")).agg(
            F.min_by(F.struct(*names), F.struct("generated_at", "nudge_id")).alias("n"))
        first.select("n.*").write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    run_available(stream.writeStream.foreachBatch(step), checkpoint)


def sent(spark: SparkSession, target: str, known: DataFrame | None = None) -> DataFrame:
    """The nudges left after the cooldown, over all batches; ``known`` is an older history."""
    return nudges.cooldown(spark.read.parquet(target), known)
