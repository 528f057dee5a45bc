"""Per-user limits and features over event order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions import time_floor
from orderlens.operators.timeline import with_history


def rate_limit(events: DataFrame, per_minute: int = 100, unit: str = "minute") -> DataFrame:
    """The first ``per_minute`` events of each user and minute.

    Spark applies the row_number bound in every task before the shuffle, so a
    flooding user sends at most the bound per task.
    """
    slot = Window.partitionBy("user_id", "__slot").orderBy("ts", "event_id")
    return (
        events.withColumn("__slot", time_floor(unit, F.col("ts")))
        .withColumn("__rn", F.row_number().over(slot))
        .filter(F.col("__rn") <= per_minute)
        .drop("__slot", "__rn")
    )


def event_features(events: DataFrame) -> DataFrame:
    """Hour, weekday, seconds since the user's previous event and running event number."""
    seen = with_history(events, "user_id", "ts", ["ts", "event_id"])
    return seen.select(
        "event_id",
        "user_id",
        F.hour("ts").alias("hour"),
        F.dayofweek("ts").alias("weekday"),
        F.timestamp_diff("SECOND", F.col("prev_ts"), F.col("ts")).alias("seconds_since_previous"),
        F.col("seq").alias("running_count"),
    )
