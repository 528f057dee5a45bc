"""Per-key ordered computations that split a hot key by time.

A window partitioned by user alone puts a user's whole history into one task.
Here the window runs per (key, time slice) and a small per-slice summary carries
the state from slice to slice, so one key is spread over as many tasks as it has
slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions import time_floor


def plain_key(key: str) -> Column:
    """The key as text that is never NULL, so joins on it stay plain equalities and reuse
    the partitioning of the window before them."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null"))


def with_history(
    df: DataFrame, key: str, ts: str, order: Sequence[str], slice_unit: str = "hour"
) -> DataFrame:
    """Adds ``prev_ts`` (LAG) and ``seq`` (ROW_NUMBER) per key in event order."""
    sliced = df.withColumn("__slice", time_floor(slice_unit, F.col(ts))).withColumn("__of", plain_key(key))
    summary = sliced.groupBy("__of", "__slice").agg(
        F.count(F.lit(1)).alias("__n"), F.max(ts).alias("__last")
    )
    by_slice = Window.partitionBy("__of").orderBy("__slice")
    carried = summary.select(
        F.col("__of").alias("__key"),
        F.col("__slice").alias("__at"),
        F.coalesce(
            F.sum("__n").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__seen"),
        F.lag("__last").over(by_slice).alias("__prev"),
    )
    inside = Window.partitionBy("__of", "__slice").orderBy(*order)
    local = sliced.withColumns(
        {"__rn": F.row_number().over(inside), "__lag": F.lag(ts).over(inside)}
    )
    on = (F.col("__of") == F.col("__key")) & (F.col("__slice") == F.col("__at"))
    return (
        local.join(carried, on, "left")
        .withColumn("prev_ts", F.coalesce("__lag", "__prev"))
        .withColumn("seq", (F.col("__seen") + F.col("__rn")).cast("bigint"))
        .drop("__slice", "__of", "__rn", "__lag", "__key", "__at", "__seen", "__prev")
    )


def asof_latest(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    state: Sequence[str],
    slice_unit: str = "hour",
) -> DataFrame:
    """Left rows with the newest right state at or before their time.

    Right rows with the same (key, time) resolve to the largest state.
    """
    slice_of = lambda c: time_floor(slice_unit, F.col(c))
    value = F.struct(F.col(right_ts).alias("at"), *[F.col(c) for c in state])
    # A NULL key equals nothing: such right rows are left out, such left rows find no state.
    r = right.filter(F.col(key).isNotNull()).select(
        plain_key(key).alias("__key"), slice_of(right_ts).alias("__slice"), F.col(right_ts).alias("__ts"),
        F.lit(0).alias("__side"), value.alias("__state"), F.lit(None).cast(left.schema.simpleString()).alias("__row"),
    )
    l = left.select(
        plain_key(key).alias("__key"), slice_of(left_ts).alias("__slice"), F.col(left_ts).alias("__ts"),
        F.lit(1).alias("__side"), F.lit(None).cast(r.schema["__state"].dataType).alias("__state"),
        F.struct(*left.columns).alias("__row"),
    )
    both = r.unionByName(l)
    inside = (
        Window.partitionBy("__key", "__slice")
        .orderBy("__ts", "__side", "__state")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = both.withColumn("__now", F.last("__state", ignorenulls=True).over(inside)).filter("__side = 1")
    per_slice = both.groupBy("__key", "__slice").agg(F.max("__state").alias("__state"))
    earlier = Window.partitionBy("__key").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select(
        F.col("__key").alias("__k"),
        F.col("__slice").alias("__at"),
        F.last("__state", ignorenulls=True).over(earlier).alias("__carry"),
    )
    found = local.join(
        carried, (F.col("__key") == F.col("__k")) & (F.col("__slice") == F.col("__at")), "left"
    ).withColumn("__hit", F.coalesce("__now", "__carry"))
    return found.select(
        "__row.*",
        F.col("__hit.at").alias("state_ts"),
        *[F.col("__hit")[c].alias(f"state_{c}") for c in state],
    )


def sessions(df: DataFrame, key: str, ts: str, gap_minutes: int, sums: dict[str, Column]) -> DataFrame:
    """Session windows per key: events at most ``gap_minutes`` apart belong together.

    Events inside one slot of gap length are always in one session, so they are
    combined before the shuffle; what reaches a key's task is bounded by the
    number of slots, not by the number of events.
    """
    slots = slot_rows(df, key, ts, gap_minutes, sums)
    marked = mark_sessions(slots, key, gap_minutes)
    return (
        marked.groupBy(key, "session_no")
        .agg(
            F.min("first_ts").alias("session_start"),
            F.max("last_ts").alias("last_event"),
            F.sum("n").alias("n"),
            *[F.sum(name).alias(name) for name in sums],
        )
        .withColumn("session_end", F.col("last_event") + F.make_dt_interval(mins=F.lit(gap_minutes)))
    )


def slot_of(ts: Column, minutes: int) -> Column:
    return F.window(ts, f"{minutes} minutes")["start"]


def slot_rows(df: DataFrame, key: str, ts: str, minutes: int, sums: dict[str, Column]) -> DataFrame:
    return df.groupBy(key, slot_of(F.col(ts), minutes).alias("slot")).agg(
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.count(F.lit(1)).alias("n"),
        *[F.sum(expr).alias(name) for name, expr in sums.items()],
    )


def mark_sessions(slots: DataFrame, key: str, gap_minutes: int) -> DataFrame:
    """Slots with the number of the session they belong to (1, 2, … per key)."""
    order = Window.partitionBy(key).orderBy("slot")
    gap = F.make_dt_interval(mins=F.lit(gap_minutes))
    prev = F.lag("last_ts").over(order)
    starts = F.when(prev.isNull() | (F.col("first_ts") > prev + gap), 1).otherwise(0)
    return slots.withColumn("__new", starts).withColumn(
        "session_no", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("__new")
