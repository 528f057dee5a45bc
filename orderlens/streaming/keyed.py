"""Keyed state on event streams: open sessions with their pattern, and pending nudges.

Both processors keep little for each key and let event-time timers decide when a result is
final, that is when the watermark has passed all that could still change it.  So a result
does not depend on how events fall into batches or in what order they arrive, as long as
none is later than the watermark allows; later ones are dropped (``consume.split_late`` keeps
such rows apart).  The state lives in RocksDB and in the checkpoint.

What is kept: of a user, the sessions that the watermark has not closed, each with its sums,
its first and last event of the pattern and, until the pattern is found, the times of its
middle events; of a nudge key, the last hour sent and one nudge for each hour that is not yet
closed.  A key whose cooldown has run out is forgotten.  Of a user whose state arrives as a
stream, the newest state before the watermark, those after it, and the rows that wait.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderlens.functions import dbl

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CLOSING = "__closing"  #: type of an event that only moves the watermark


@contextmanager
def rocksdb(spark: SparkSession):
    """Keyed state needs the RocksDB store; other streams of the session keep theirs."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class _Kept(StatefulProcessor):
    """A JSON value for each key and one timer, moved as the value changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("kept", "body string")

    def load(self, empty):
        return json.loads(self.state.get()[0]) if self.state.exists() else empty

    def store(self, value, wake_ms: int | None) -> None:
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if value:
            self.state.update((json.dumps(value),))
            self.handle.registerTimer(wake_ms)
        elif self.state.exists():
            self.state.clear()

    def close(self) -> None:
        pass

    @staticmethod
    def timely(frame: pd.DataFrame, timerValues) -> pd.DataFrame:
        """Without the rows at or behind the watermark: Spark itself may pass them on for one batch more."""
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        return frame[frame["us"] > mark] if mark > 0 else frame


# --- sessions ---------------------------------------------------------------------------------

# An open session: start, end, events, cents, first opening event, last closing event, middle events, found.
START, END, EVENTS, CENTS, OPENED, CLOSED, MIDDLE, FOUND = range(8)
SESSION = "user_id long, start_us long, end_us long, events long, cents long, opened_us long, closed_us long, found boolean"


def joined(a: list, b: list) -> list:
    """Two sessions as one."""
    opened = min((x for x in (a[OPENED], b[OPENED]) if x), default=None)
    closed = max((x for x in (a[CLOSED], b[CLOSED]) if x), default=None)
    middle, found = a[MIDDLE] + b[MIDDLE], a[FOUND] or b[FOUND]
    # What lies between the ends stays between them: they only move apart.
    found = found or bool(opened and closed and any(opened < m < closed for m in middle))
    return [min(a[START], b[START]), max(a[END], b[END]), a[EVENTS] + b[EVENTS], a[CENTS] + b[CENTS], opened, closed, [] if found else middle, found]


class Sessions(_Kept):
    """Sessions of one user, emitted when the watermark has passed their end and the gap."""

    def __init__(self, gap_minutes: int, first: str, then: str, last: str):
        self.gap, self.kinds = gap_minutes * 60_000_000, (first, then, last)

    def _wake(self, sessions: list) -> int | None:
        return min((s[END] + self.gap) // 1000 + 1 for s in sessions) if sessions else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, then, last = self.kinds
        sessions = self.load([])
        for frame in (self.timely(f, timerValues) for f in rows):
            for us, event, kind, cents in zip(frame["us"], frame["event_id"], frame["event_type"], frame["cents"]):
                if kind == CLOSING:
                    continue
                us, at = int(us), [int(us), int(event)]
                new = [us, us, 1, 0 if pd.isna(cents) else int(cents), at if kind == first else None, at if kind == last else None, [at] if kind == then else [], False]
                apart = []
                for s in sessions:
                    if s[START] - self.gap <= new[END] and new[START] <= s[END] + self.gap:
                        new = joined(s, new)
                    else:
                        apart.append(s)
                sessions = [*apart, new]
        self.store(sessions, self._wake(sessions))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        sessions = self.load([])
        done = [s for s in sessions if s[END] + self.gap < mark]
        left = [s for s in sessions if s[END] + self.gap >= mark]
        self.store(left, self._wake(left))
        if done:
            user = int(key[0]) if key[0] else None
            rows = [(user, s[START], s[END] + self.gap, s[EVENTS], s[CENTS], s[OPENED] and s[OPENED][0], s[CLOSED] and s[CLOSED][0], s[FOUND]) for s in done]
            out = pd.DataFrame(rows, columns=[f.split()[0] for f in SESSION.split(", ")])
            yield out.astype({c: "Int64" for c in ("user_id", "opened_us", "closed_us")})


def _at(us: str) -> Column:
    return F.timestamp_micros(F.col(us)).cast("timestamp_ntz")


def open_sessions(events: DataFrame, gap_minutes: int, lateness: str, first: str = "view", then: str = "click", last: str = "purchase") -> DataFrame:
    """Closed sessions of a stream of events, with whether they hold ``first``, later ``then``, later ``last``."""
    rows = events.withWatermark("ts", lateness).select(
        F.coalesce(F.col("user_id").cast("string"), F.lit("")).alias("who"), "ts", F.unix_micros("ts").alias("us"), "event_id", "event_type",
        (F.col("value").cast("decimal(18,2)") * 100).cast("long").alias("cents"),
    )
    return rows.groupBy("who").transformWithStateInPandas(Sessions(gap_minutes, first, then, last), SESSION, "Append", "EventTime")


def session_totals(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "user_id", _at("start_us").alias("session_start"), _at("end_us").alias("session_end"), "events", dbl((F.col("cents") / F.lit(100)).cast("decimal(18,2)")).alias("total_value"),
    )


def pattern_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.filter("found").select("user_id", _at("opened_us").alias("opened_at"), _at("closed_us").alias("closed_at"))


# --- state as of an event ---------------------------------------------------------------------

AS_OF = "user_id long, event_id long, us long, state_us long, state_id long, state_value long"


class AsOf(_Kept):
    """Events of one user with the newest state at or before their time, once the watermark has passed it.

    States of one time resolve to the largest (event id, value).  A state row behind the
    watermark is dropped and changes nothing.
    """

    def _keep(self, states: list, wait: list, mark: int) -> None:
        cut = min([mark, *(w[0] for w in wait)])  # rows that wait may need an older state than the mark's
        past = [s for s in states if s[0] <= cut]
        states = [*([max(past)] if past else []), *(s for s in states if s[0] > cut)]
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if states or wait:
            self.state.update((json.dumps([states, wait]),))
        elif self.state.exists():
            self.state.clear()
        if wait:
            self.handle.registerTimer(min(wait)[0] // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        states, wait = self.load([[], []])
        for frame in (self.timely(f, timerValues) for f in rows):
            for us, event, is_state, value in zip(frame["us"], frame["event_id"], frame["is_state"], frame["value"]):
                if not is_state:
                    wait.append([int(us), int(event)])
                elif key[0]:  # nobody's state is the state of nobody
                    states.append([int(us), int(event), -1 if pd.isna(value) else int(value)])
        self._keep(states, wait, timerValues.getCurrentWatermarkInMs() * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        states, wait = self.load([[], []])
        states.sort()
        user, out, at = (int(key[0]) if key[0] else None), [], -1
        ready = sorted(w for w in wait if w[0] < mark)
        for us, event in ready:
            while at + 1 < len(states) and states[at + 1][0] <= us:
                at += 1
            out.append((user, event, us, *(states[at] if at >= 0 else (None, None, None))))
        self._keep(states, [w for w in wait if w[0] >= mark], mark)
        if out:
            yield pd.DataFrame(out, columns=[f.split()[0] for f in AS_OF.split(", ")]).astype({c: "Int64" for c in ("user_id", "state_us", "state_id", "state_value")})


def asof_state(events: DataFrame, states: DataFrame, lateness: str) -> DataFrame:
    """Two streams (user_id, ts, event_id, and value of a state) joined as of each event's time; amounts of 0.01 or more."""
    def side(df: DataFrame, is_state: bool) -> DataFrame:
        value = (F.col("value").cast("decimal(18,2)") * 100).cast("long") if is_state else F.lit(None).cast("long")
        return df.withWatermark("ts", lateness).select(
            F.coalesce(F.col("user_id").cast("string"), F.lit("")).alias("who"), "ts", F.unix_micros("ts").alias("us"), "event_id", F.lit(is_state).alias("is_state"), value.alias("value"))

    both = side(events, False).unionByName(side(states, True))
    found = both.groupBy("who").transformWithStateInPandas(AsOf(), AS_OF, "Append", "EventTime")
    return found.select(
        "event_id", "user_id", _at("us").alias("ts"), _at("state_us").alias("state_ts"), F.col("state_id").alias("state_event_id"),
        dbl((F.nullif("state_value", F.lit(-1)) / F.lit(100)).cast("decimal(18,2)")).alias("state_value"),
    )


# --- cooldown ---------------------------------------------------------------------------------

HOUR = 3_600_000  # milliseconds
SENT = "nudge_id string, user_id long, rule_id string, generated_us long"


class Cooldown(_Kept):
    """Nudges of one (user, type, rule): an hour is decided when the watermark has passed it."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = self.load({"last": None, "wait": {}})
        for frame in (self.timely(f, timerValues) for f in rows):
            for us, nudge, hours in zip(frame["us"], frame["nudge_id"], frame["cooldown_hours"]):
                hour, new = str(int(us) // 1000 // HOUR), [int(us), nudge, int(hours)]
                kept["wait"][hour] = min(kept["wait"].get(hour, new), new)
        self._keep(kept)
        return iter(())

    def _keep(self, kept: dict) -> None:
        wait = kept["wait"]
        if wait:
            self.store(kept, (min(map(int, wait)) + 1) * HOUR)
        elif kept["last"] is not None:
            self.store(kept, (kept["last"][0] + kept["last"][1]) * HOUR)
        else:
            self.store(None, None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        kept, sent = self.load({"last": None, "wait": {}}), []
        for hour in sorted(h for h in map(int, kept["wait"]) if (h + 1) * HOUR <= mark):
            us, nudge, hours = kept["wait"].pop(str(hour))
            if kept["last"] is None or hour - kept["last"][0] >= hours:
                kept["last"] = [hour, hours]
                sent.append((nudge, int(key[0]) if key[0] else None, key[2], us))
        if kept["last"] is not None and not kept["wait"] and sum(kept["last"]) * HOUR <= mark:
            kept["last"] = None  # whatever comes now is free
        self._keep(kept)
        if sent:
            yield pd.DataFrame(sent, columns=[f.split()[0] for f in SENT.split(", ")]).astype({"user_id": "Int64"})


def cooldown(nudges: DataFrame) -> DataFrame:
    """The nudges left after the cooldown of their key, from a stream whose watermark is on ``generated_at``.

    Nudges made from a stream of events (``nudges.generate``) carry the events' watermark.
    """
    rows = nudges.select(
        F.coalesce(F.col("user_id").cast("string"), F.lit("")).alias("who"), "nudge_type", "rule_id", "generated_at",
        F.unix_micros("generated_at").alias("us"), "nudge_id", F.col("cooldown_hours").cast("long").alias("cooldown_hours"),
    )
    sent = rows.groupBy("who", "nudge_type", "rule_id").transformWithStateInPandas(Cooldown(), SENT, "Append", "EventTime")
    return sent.select("nudge_id", "user_id", "rule_id", _at("generated_us").alias("generated_at"))
