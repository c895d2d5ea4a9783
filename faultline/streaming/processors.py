"""Stateful processors: rules of every window length, silence, spikes, sessions and rolling counts on a stream that is read once.

Events are counted in short windows first, by Spark's own aggregation, with partial sums before the shuffle; a processor sees closed counts, some a service
and minute and no events. Watermarks release counts in time order, and timers say when the watermark has come to a point, so state is
dropped as soon as nothing can change it. Each processor is fed and judged by event time alone: what it puts out does not depend on
how the stream was cut into batches.

Classes are made in functions, so that they travel to the executors with the query and need no copy of this package there. Text columns leave them as
objects: Spark takes no text column that pandas keeps in several Arrow chunks.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from faultline.contract import is_error
from faultline.functions.timeframe import Moment, moment
from faultline.operators.alerts import Rule, broken_rules, with_rules
from faultline.operators.analytics import error_counts
from faultline.streaming.jobs import with_event_time


def _from_seconds(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.timestamp_seconds(c).cast("timestamp_ntz") for c in columns})


def _from_micros(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.timestamp_micros(c).cast("timestamp_ntz") for c in columns})


def _window_counts(events: DataFrame, length: str, delay: str) -> DataFrame:
    """Closed windows: service, second (of the start), total_events, error_events."""
    counted = with_event_time(events, delay).groupBy("service", F.window("ts", length)).agg(*error_counts())
    return counted.select("service", F.unix_seconds("window.start").alias("second"), "total_events", "error_events")


# Rules


def longer_windows(steps: Sequence[int]) -> StatefulProcessor:
    """Adds the counts of short windows up to windows of each length, in seconds, and puts a window out when it has ended.

    The state is the windows that are open, read and written once a batch; one timer waits for the first of them to end.
    """

    class LongerWindows(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.open = handle.getListState("open", "step long, start long, total long, errors long")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            counts = pd.concat(list(rows))
            parts = [counts.assign(step=step, start=counts["second"] - counts["second"] % step) for step in steps]
            now = pd.concat(parts)[["step", "start", "total_events", "error_events"]]
            return self._close(key, pd.concat([self._waiting(), now]), timerValues)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            return self._close(key, self._waiting(), timerValues)

        def _waiting(self) -> pd.DataFrame:
            rows = list(self.open.get()) if self.open.exists() else []
            return pd.DataFrame(rows, columns=["step", "start", "total_events", "error_events"]).astype("int64")

        def _close(self, key, windows: pd.DataFrame, timerValues) -> Iterator[pd.DataFrame]:
            windows = windows.groupby(["step", "start"], as_index=False).sum()
            ends = (windows["step"] + windows["start"]) * 1000
            ended = ends <= timerValues.getCurrentWatermarkInMs()
            if ended.all():
                self.open.clear()
            else:
                self.open.put([tuple(int(x) for x in row) for row in windows[~ended].itertuples(index=False)])
                self.handle.registerTimer(int(ends[~ended].min()))
            closed = windows[ended]
            out = {"service": key[0], "window_minutes": (closed["step"] // 60).astype("int32"), "second": closed["start"]}
            yield pd.DataFrame(out | {c: closed[c] for c in ("total_events", "error_events")}).astype({"service": object})

        def close(self) -> None:
            pass

    return LongerWindows()


def stream_threshold_alerts(events: DataFrame, rules: Sequence[Rule], delay: str) -> DataFrame:
    """Rule breaches of closed windows, for rules of any window length, from one read of the stream and one set of counts.

    Events are counted in the longest windows that all lengths are whole numbers of.
    """
    lengths = sorted({rule.window_minutes for rule in rules})
    closed = (
        _window_counts(events, f"{math.gcd(*lengths)} minutes", delay)
        .groupBy("service")
        .transformWithStateInPandas(
            longer_windows([minutes * 60 for minutes in lengths]),
            outputStructType="service string, window_minutes int, second bigint, total_events bigint, error_events bigint",
            outputMode="append",
            timeMode="EventTime",
        )
    )
    broken = broken_rules(with_rules(_from_seconds(closed.withColumnRenamed("second", "window_start"), "window_start"), rules))
    return broken.select("rule", "service", "window_start", "window_minutes", "total_events", "error_events", "error_rate_pct")


# Silence


def silent_windows(step: int) -> StatefulProcessor:
    """Puts out the windows of a known service that ended without an event; timers fire whether or not any rows come."""

    class SilentWindows(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.next = handle.getValueState("next", "start long")
            self.seen = handle.getMapState("seen", "start long", "total long")

        def _wait(self, start: int) -> None:
            self.next.update((start,))
            self.handle.registerTimer((start + step) * 1000)

        def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
            self._wait(int(initialState["first"].min()))

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            windows = pd.concat(list(rows))
            if not self.next.exists():
                # A service that nobody named is known from its first window on.
                self._wait(int(windows["second"].min()))
            for start, total in zip(windows["second"].tolist(), windows["total_events"].tolist()):
                self.seen.updateValue((start,), (total,))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            start, silent = self.next.get()[0], []
            while (start + step) * 1000 <= timerValues.getCurrentWatermarkInMs():
                if self.seen.containsKey((start,)):
                    self.seen.removeKey((start,))
                else:
                    silent.append(start)
                start += step
            if start != self.next.get()[0]:
                self._wait(start)
            yield pd.DataFrame({"service": [key[0]] * len(silent), "second": silent}).astype({"service": object})

        def close(self) -> None:
            pass

    return SilentWindows()


def stream_silent_services(events: DataFrame, known: DataFrame, since: Moment, minutes: int, delay: str) -> DataFrame:
    """service, window_start and window_end of closed windows from `since` on in which a known service has no event.

    known: the services to watch, a table and no stream. A service that turns up by itself is watched from its first window.
    Windows are as epoch-aligned as those of the rates; the one that `since` falls into is the first.
    """
    step = minutes * 60
    second = int((moment(since) - dt.datetime(1970, 1, 1)).total_seconds())
    first = known.select("service", F.lit(second - second % step).cast("bigint").alias("first")).groupBy("service")
    silent = (
        _window_counts(events, f"{minutes} minutes", delay)
        .groupBy("service")
        .transformWithStateInPandas(
            silent_windows(step), outputStructType="service string, second bigint", outputMode="append", timeMode="EventTime", initialState=first
        )
    )
    return _from_seconds(silent.select("service", F.col("second").alias("window_start"), (F.col("second") + step).alias("window_end")), "window_start", "window_end")


# Spikes


def spikes(step: int, history: int, factor: int, min_errors: int) -> StatefulProcessor:
    """Passes on windows with more errors than the `history` windows before them allow.

    The state is the errors of the windows that one of those to come can look back at, and the first window of the service. Counts come
    in time order, so a window that has not come by then had no events and counts as zero.
    """

    class Spikes(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.first = handle.getValueState("first", "start long")
            self.recent = handle.getListState("recent", "start long, errors long")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            windows = pd.concat(list(rows)).sort_values("second")
            recent = list(self.recent.get()) if self.recent.exists() else []
            if not self.first.exists():
                self.first.update((int(windows["second"].iloc[0]),))
            first, found = self.first.get()[0], []
            for start, errors in zip(windows["second"].tolist(), windows["error_events"].tolist()):
                recent = [(at, n) for at, n in recent if at >= start - history * step]
                before = sum(n for _, n in recent)
                if errors >= min_errors and start - first >= history * step and errors * history > before * factor:
                    found.append((key[0], start, errors, before))
                recent.append((start, errors))
            self.recent.put(recent)
            yield pd.DataFrame(found, columns=["service", "second", "error_events", "previous_errors"]).astype({"service": object})

        def close(self) -> None:
            pass

    return Spikes()


def stream_error_spikes(events: DataFrame, delay: str, minutes: int = 60, history: int = 6, factor: int = 2, min_errors: int = 3) -> DataFrame:
    """The spikes of alerts.error_spikes among closed windows."""
    found = (
        _window_counts(events, f"{minutes} minutes", delay)
        .groupBy("service")
        .transformWithStateInPandas(
            spikes(minutes * 60, history, factor, min_errors),
            outputStructType="service string, second bigint, error_events bigint, previous_errors bigint",
            outputMode="append",
            timeMode="EventTime",
        )
    )
    return _from_seconds(found.withColumnRenamed("second", "window_start"), "window_start")


# Sessions


def merged_slots(gap: int) -> StatefulProcessor:
    """Joins slots of errors, in microseconds, whose errors are no further apart than the gap, and puts a session out when the gap has passed."""

    class MergedSlots(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.open = handle.getValueState("open", "first long, last long, errors long")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            slots = pd.concat(list(rows)).sort_values("first")
            session, done = (tuple(self.open.get()) if self.open.exists() else None), []
            for first, last, errors in slots[["first", "last", "error_events"]].itertuples(index=False):
                if session and session[1] + gap >= first:
                    session = (session[0], max(session[1], int(last)), session[2] + int(errors))
                else:
                    if session:
                        done.append(session)
                    session = (int(first), int(last), int(errors))
            self.open.update(session)
            self.handle.registerTimer(self._end(session))
            yield self._frame(key, done)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            # A session that has grown since has a later timer.
            if self.open.exists() and self._end(self.open.get()) == expiredTimerInfo.getExpiryTimeInMs():
                session = tuple(self.open.get())
                self.open.clear()
                yield self._frame(key, [session])

        @staticmethod
        def _end(session) -> int:
            """The first whole millisecond at which the gap has passed."""
            return -(-(session[1] + gap) // 1000)

        @staticmethod
        def _frame(key, sessions) -> pd.DataFrame:
            rows = [(key[0], first, last + gap, errors) for first, last, errors in sessions]
            return pd.DataFrame(rows, columns=["service", "session_start", "session_end", "error_events"]).astype({"service": object})

        def close(self) -> None:
            pass

    return MergedSlots()


def stream_error_sessions(events: DataFrame, gap: dt.timedelta, delay: str) -> DataFrame:
    """Runs of errors no further apart than the gap, when the watermark has come to their end.

    Errors are joined within slots of half a gap first, by Spark's own aggregation: a service sends a row a slot to its task, however many errors it has. Slots of
    services without errors close too and are left out after that, so a session ends when time has passed, not when the next error comes.
    """
    micros = gap // dt.timedelta(microseconds=1)
    at = F.when(is_error(), F.unix_micros("ts"))
    slots = (
        with_event_time(events, delay)
        .groupBy("service", F.window("ts", f"{micros // 2} microseconds"))
        .agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(at).alias("error_events"))
        .filter("error_events > 0")
        .select("service", "first", "last", "error_events")
    )
    sessions = slots.groupBy("service").transformWithStateInPandas(
        merged_slots(micros),
        outputStructType="service string, session_start bigint, session_end bigint, error_events bigint",
        outputMode="append",
        timeMode="EventTime",
    )
    return _from_micros(sessions, "session_start", "session_end")


# Rolling counts


def running_sums(length: int) -> StatefulProcessor:
    """The running sum of the changes in one chunk of time, put out when the chunk has ended.

    A chunk is a group of its own, as in alerts.rolling_errors, so the state of a service is spread over chunks, and a chunk holds
    no more changes than it has milliseconds, times two, and those carried over from the window before it.
    """

    class RunningSums(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.changes = handle.getListState("changes", "time long, change long, total long, own boolean")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            if not self.changes.exists():
                self.handle.registerTimer(-(-(key[1] + length) // 1000))
            for batch in rows:
                self.changes.appendList(list(batch[["time", "change", "total", "own"]].itertuples(index=False, name=None)))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            marks = pd.DataFrame(list(self.changes.get()), columns=["time", "change", "total", "own"])
            self.changes.clear()
            # All changes of one time count before any row of that time is put out.
            sums = marks.groupby("time")["change"].sum().sort_index().cumsum()
            own = marks[marks["own"]].groupby("time")["total"].sum()
            rolled = {"service": key[0], "time": own.index, "total_events": own.to_numpy(), "errors_in_window": sums[own.index].to_numpy()}
            yield pd.DataFrame(rolled).astype({"service": object})

        def close(self) -> None:
            pass

    return RunningSums()


def stream_rolling_errors(
    events: DataFrame, delay: str, window: dt.timedelta = dt.timedelta(minutes=5), chunk: dt.timedelta | None = None
) -> DataFrame:
    """service, ts, total_events and errors_in_window for each time a service has events at: its errors in the window that ends there, both ends counted.

    Times come out when the chunk of time they fall in has closed. Chunks are as long as the window unless `chunk` makes them longer: that is later and fewer groups.
    alerts.rolling_errors has the same numbers, once for each event.
    """
    width, length = (span // dt.timedelta(microseconds=1) for span in (window, chunk or window))
    if length < width:
        raise ValueError("a chunk is no shorter than the window")
    times = (
        with_event_time(events, delay)
        .groupBy("service", "ts")
        .agg(*error_counts())
        .select("service", F.unix_micros("ts").alias("at"), "total_events", "error_events")
        .selectExpr("*", f"at - pmod(at, {length}L) AS chunk")
    )

    def mark(chunk: str, time: str, change: str, total: str, own: str) -> str:
        return f"named_struct('chunk', {chunk}, 'time', {time}, 'change', {change}, 'total', {total}, 'own', {own})"

    # The window includes its lower end, so an error leaves one microsecond after it, in its own chunk or in the next, which it is then carried to.
    leaves = f"at + {width + 1}L"
    event = mark("chunk", "at", "error_events", "total_events", "true")
    gone = mark("chunk", leaves, "-error_events", "0L", "false")
    carried = mark(f"chunk + {length}L", "at", "error_events", "0L", "false")
    gone_later = mark(f"chunk + {length}L", leaves, "-error_events", "0L", "false")
    changes = f"CASE WHEN error_events = 0 THEN array({event}) WHEN {leaves} < chunk + {length}L THEN array({event}, {gone}) ELSE array({event}, {carried}, {gone_later}) END"
    rolled = times.selectExpr("service", f"inline({changes})").groupBy("service", "chunk").transformWithStateInPandas(
        running_sums(length),
        outputStructType="service string, time bigint, total_events bigint, errors_in_window bigint",
        outputMode="append",
        timeMode="EventTime",
    )
    return _from_micros(rolled.withColumnRenamed("time", "ts"), "ts")
