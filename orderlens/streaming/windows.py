"""Event-time windows for static and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import dbl, mean, ntz
from orderlens.operators.timeline import mark_sessions, sessions, slot_of, slot_rows


def _figures(n: Column, total: Column) -> list[Column]:
    return [n.alias("events"), dbl(total).alias("total_value"), mean(total, n).alias("mean_value")]


def tumbling(events: DataFrame, minutes: int) -> DataFrame:
    """Count, sum and mean per event type and window; partial sums are formed before the shuffle."""
    w = F.window("ts", f"{minutes} minutes")
    grouped = events.groupBy(w.alias("w"), "event_type").agg(*_figures(F.count(F.lit(1)), F.sum("value")))
    return grouped.select(ntz(F.col("w.start")).alias("window_start"), "event_type", "events", "total_value", "mean_value")


def sliding(events: DataFrame, minutes: int, slide: int) -> DataFrame:
    """Sliding windows from panes: events are summed once per slide, then panes are
    copied into the windows they belong to, rather than every event."""
    if minutes % slide:
        raise ValueError("the window length must be a multiple of the slide")
    panes = events.groupBy(slot_of(F.col("ts"), slide).alias("pane"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")
    )
    starts = F.array(
        *[F.col("pane") - F.make_dt_interval(mins=F.lit(i * slide)) for i in range(minutes // slide)]
    )
    return (
        panes.select(F.explode(starts).alias("start"), "event_type", "n", "v")
        .groupBy("start", "event_type")
        .agg(*_figures(F.sum("n"), F.sum("v")))
        .select(ntz(F.col("start")).alias("window_start"), "event_type", "events", "total_value", "mean_value")
    )


def session_totals(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    s = sessions(events, "user_id", "ts", gap_minutes, {"value": F.col("value")})
    return s.select(
        "user_id", ntz(F.col("session_start")).alias("session_start"), ntz(F.col("session_end")).alias("session_end"),
        F.col("n").alias("events"), dbl(F.col("value")).alias("total_value"),
    )


def session_stream(events: DataFrame, gap_minutes: int = 30, lateness: str = "10 minutes") -> DataFrame:
    """The same sessions on a stream, where Spark keeps the open ones as state."""
    w = F.session_window("ts", f"{gap_minutes} minutes")
    grouped = events.withWatermark("ts", lateness).groupBy(w.alias("w"), "user_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("value").alias("v")
    )
    return grouped.select(
        "user_id", ntz(F.col("w.start")).alias("session_start"), ntz(F.col("w.end")).alias("session_end"),
        "events", dbl(F.col("v")).alias("total_value"),
    )


def labelled(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Events with their session number, joined by (user, slot) so a busy user spreads out."""
    slots = slot_rows(events, "user_id", "ts", gap_minutes, {})
    marks = mark_sessions(slots, "user_id", gap_minutes).select(
        F.col("user_id").alias("u"), F.col("slot").alias("s"), "session_no"
    )
    tagged = events.withColumn("slot", slot_of(F.col("ts"), gap_minutes))
    return tagged.join(marks, (F.col("user_id") == F.col("u")) & (F.col("slot") == F.col("s"))).drop("u", "s", "slot")


def pattern_sessions(events: DataFrame, first: str, then: str, last: str, gap_minutes: int = 30) -> DataFrame:
    """Sessions that hold ``first``, later ``then``, later ``last``.

    The pattern exists exactly when some ``then`` lies after the earliest ``first``
    and before the latest ``last``, so two extremes per session and one join
    replace an ordered array of the session's events.  Order is (time, event id).
    """
    at = F.struct("ts", "event_id")
    kind = F.col("event_type")
    marked = labelled(events, gap_minutes).filter(kind.isin(first, then, last))
    ends = marked.groupBy("user_id", "session_no").agg(
        F.min(F.when(kind == first, at)).alias("opened"), F.max(F.when(kind == last, at)).alias("closed")
    )
    ends = ends.filter(F.col("opened") < F.col("closed"))
    middle = marked.filter(kind == then).select(F.col("user_id").alias("u"), F.col("session_no").alias("n"), at.alias("at"))
    # Clicks on the left: an inner join may be split when one session is hot.
    hit = (
        (F.col("user_id") == F.col("u")) & (F.col("session_no") == F.col("n"))
        & (F.col("at") > F.col("opened")) & (F.col("at") < F.col("closed"))
    )
    return (
        middle.join(ends, hit)
        .groupBy("user_id", "session_no", "opened", "closed")
        .agg(F.count(F.lit(1)).alias("hits"))
        .select("user_id", "session_no", ntz(F.col("opened.ts")).alias("opened_at"), ntz(F.col("closed.ts")).alias("closed_at"))
    )
