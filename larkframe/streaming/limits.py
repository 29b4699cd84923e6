"""A rate limit as keyed state with timers.

A key's first call opens a period; the period ends a fixed time after that call, not at a full hour. Inside it calls are allowed until more than
``limit`` have been counted: call number limit + 1 is the last allowed one, rejected calls are not counted. The first call after the end opens a new period.

Files bring calls in any order within the lateness, and decisions depend on the order. So a call is held in the key's state until the
watermark has passed its time; a timer at the earliest held call then decides all calls that are due, in order of (time, id). When a period is over and no
call is held, the key's state is cleared: state grows with the keys that are active within lateness and period, not with the history.

Calls without a time cannot be ordered and are left out, as are calls later than the lateness. A call with a null key belongs to the key null.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from larkframe.streaming import jobs

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DECIDED = "key string, id long, ts timestamp, start timestamp, calls long, allowed boolean"
MICROS = 1_000_000


def decide(calls: list[tuple[int, int]], start: int | None, count: int, limit: int, period: int) -> tuple[list[tuple], int | None, int]:
    """(time, id, start, calls, allowed) of calls (time, id) in order, and the period's start and count after them; times in microseconds."""
    out = []
    for ts, i in calls:
        if start is None or ts > start + period * MICROS:
            start, count, ok = ts, 1, True
        elif count > limit:
            ok = False
        else:
            count, ok = count + 1, True
        out.append((ts, i, start, count, ok))
    return out, start, count


class Limiter(StatefulProcessor):
    def __init__(self, limit: int, period: int):
        self.limit, self.period = limit, period

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "start long, calls long")
        self.held = handle.getListState("held", "ts long, id long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(ts), int(i)) for batch in rows for ts, i, beat in zip(batch["us"], batch["id"], batch["beat"]) if not beat]
        if new:
            self.held.appendList(new)
            self._timer(min(new)[0])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted((r[0], r[1]) for r in self.held.get()) if self.held.exists() else []
        due, rest = [c for c in held if c[0] < now], [c for c in held if c[0] >= now]
        state = self.open.get() if self.open.exists() else None
        rows, start, count = decide(due, *((state[0], state[1]) if state else (None, 0)), self.limit, self.period)
        if rest:
            self.held.put(rest)
            self._timer(rest[0][0])
        else:
            self.held.clear()
        over = start is None or start + self.period * MICROS < now
        if over and not rest:
            self.open.clear()
        else:
            self.open.update((start, count))
            if not rest:
                self._timer(start + self.period * MICROS)
        if rows:
            times = pd.to_datetime([r[0] for r in rows], unit="us")
            yield pd.DataFrame({"key": [key[0]] * len(rows), "id": [r[1] for r in rows], "ts": times, "start": pd.to_datetime([r[2] for r in rows], unit="us"),
                                "calls": [r[3] for r in rows], "allowed": [r[4] for r in rows]})

    def _timer(self, micros: int) -> None:
        """Once the watermark has passed the time; timers count milliseconds."""
        self.handle.registerTimer(micros // 1000 + 1)

    def close(self) -> None:
        pass


def limiter(calls: DataFrame, late: str, limit: int, period: int) -> DataFrame:
    """The stream of decisions on a stream of calls (key, id, ts, beat); rows with ``beat`` only move the watermark."""
    rows = calls.withColumn("us", F.unix_micros("ts")).withWatermark("ts", late).groupBy("key")
    return rows.transformWithStateInPandas(Limiter(limit, period), DECIDED, "Append", "EventTime")


def rate_limited(calls: DataFrame, unit: str, late: str, limit: int = 100, period: int = 3600, state: str | None = None) -> DataFrame:
    """Decisions on the calls (key, id, ts), arriving ``unit`` by unit. A last row without a call, later than all, moves the watermark past the end."""
    spark = calls.sparkSession
    timed = calls.where("ts IS NOT NULL").select("key", "id", "ts", F.lit(False).alias("beat"))
    end = timed.agg(F.max("ts").alias("ts")).first()["ts"]
    if end is None:
        return spark.createDataFrame([], DECIDED)
    beat = spark.createDataFrame([(None, -1, end + timedelta(days=400), True)], "key string, id long, ts timestamp, beat boolean")
    path = jobs.landed_in_order(timed.unionByName(beat), "ts", unit, "calls")
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)  # the store that keeps lists and timers
    try:
        return jobs.run(limiter(jobs.stream(spark, path, timed.schema), late, limit, period), "append", "decisions", state).drop("batch")
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
