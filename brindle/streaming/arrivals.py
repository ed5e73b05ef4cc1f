"""Arrivals per region and window as event-time streams.

Events are counted per pane, the longest stretch of which windows and slides are whole numbers, by the built-in
aggregation in append mode; a pane leaves it once the watermark has passed its end.  A keyed state operator behind
it slides a sum over the panes and adds silent windows and the previous count.  Its state is the panes of one window
per region, and its input is one row per region and pane, however much windows overlap.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from brindle.operators.arrivals import HOURLY, PAGE, TEN_MINUTES, Box, milliseconds, pane_of, region_of

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# The state holds a row per region and open window, which a few partitions carry at any event rate.
STATE_PARTITIONS = 8


@contextmanager
def stream_settings(spark: SparkSession, partitions: int = STATE_PARTITIONS):
    """Settings a stateful query has to start with; it keeps them, the session gets its own back."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        "spark.sql.shuffle.partitions": str(partitions),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def busy_panes(events: DataFrame, boxes: list[Box], pane: str, delay: str) -> DataFrame:
    """(region, pane, count) of stretches of time with arrivals, from a stream of (x, y, ts timestamp).

    All events drive the watermark, also those outside every region: the region filter refers to the
    event time, which keeps the optimizer from moving it below the watermark.
    """
    placed = events.withColumn("region", region_of(boxes)).select("region", "ts").withWatermark("ts", delay)
    inside = placed.where(F.when(F.col("ts").isNotNull(), F.col("region")).isNotNull())
    return inside.groupBy("region", F.window("ts", pane).alias("pane")).agg(F.count("*").alias("count"))


class SlidingCounts(StatefulProcessor):
    """Per region: slide a sum over panes and emit each complete window with the count of the one before.

    The state holds the start of the next window, the count of the last one and the panes from there on, which are
    length / pane at most and those that have arrived since.  A window is complete when the watermark has passed
    its end; a timer at the end of the next window emits those in which nothing has arrived.  Moving on by one slide
    adds the panes that enter the window and subtracts those that leave it.  Rows leave in frames of PAGE rows, so a
    long silence is never held as a whole.  Without ``fill`` windows without arrivals are left out.
    """

    def __init__(self, length_ms: int, slide_ms: int, fill: bool) -> None:
        self.length_ms = length_ms
        self.slide_ms = slide_ms
        self.fill = fill

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "start_ms bigint, previous bigint")
        self.panes = handle.getMapState("panes", "start_ms bigint", "count bigint")

    def _windows(self, start: int, previous: int, panes: list[tuple[int, int]], reached: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pages of (starts, counts) of all windows from ``start`` on that end by ``reached``."""
        entering = leaving = total = 0
        starts: list[int] = []
        counts: list[int] = []
        while start + self.length_ms <= reached:
            while entering < len(panes) and panes[entering][0] < start + self.length_ms:
                total += panes[entering][1]
                entering += 1
            while leaving < entering and panes[leaving][0] < start:
                total -= panes[leaving][1]
                leaving += 1
            # Nothing in the window: the same holds until the next pane enters.
            silent = (reached - self.length_ms - start) // self.slide_ms + 1
            if total == 0 and entering < len(panes):
                silent = min(silent, (panes[entering][0] - self.length_ms - start) // self.slide_ms + 1)
            if total == 0:
                if self.fill:
                    if starts:
                        yield np.array(starts), np.array(counts)
                        starts, counts = [], []
                    for first in range(0, silent, PAGE):
                        places = np.arange(first, min(first + PAGE, silent))
                        yield start + places * self.slide_ms, np.zeros(len(places), dtype=np.int64)
                start += silent * self.slide_ms
                continue
            starts.append(start)
            counts.append(total)
            if len(starts) == PAGE:
                yield np.array(starts), np.array(counts)
                starts, counts = [], []
            start += self.slide_ms
        if starts:
            yield np.array(starts), np.array(counts)

    def _emit(self, key, reached: int) -> Iterator[pd.DataFrame]:
        start, previous = self.next.get()
        panes = sorted((k[0], v[0]) for k, v in self.panes.iterator())
        for starts, counts in self._windows(start, previous, panes, reached):
            frame = pd.DataFrame({"start_ms": starts, "count": counts, "previous": np.r_[previous, counts[:-1]]}, dtype="int64")
            frame.insert(0, "region", key[0])
            previous = int(counts[-1])
            yield frame
        if start + self.length_ms <= reached:
            start += ((reached - self.length_ms - start) // self.slide_ms + 1) * self.slide_ms
            self.next.update((start, previous))
            for place, _ in panes:
                if place < start:
                    self.panes.removeKey((place,))
        if self.fill or (panes and panes[-1][0] >= start):
            # Timers fire when the watermark is behind them.
            self.handle.registerTimer(start + self.length_ms - 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows)).sort_values("start_ms")
        # A pane that lies between two windows belongs to none.
        first = (arrived["start_ms"] - self.length_ms) // self.slide_ms * self.slide_ms + self.slide_ms
        held = first <= arrived["start_ms"]
        arrived, first = arrived[held], first[held]
        if arrived.empty:
            return
        known = self.next.get() if self.next.exists() else None
        if known is None:
            self.next.update((int(first.iloc[0]), 0))
        elif self.fill or self.panes.exists():
            self.handle.deleteTimer(known[0] + self.length_ms - 1)
        for place, count in zip(arrived["start_ms"].tolist(), arrived["count"].tolist()):
            self.panes.updateValue((place,), (count,))
        yield from self._emit(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._emit(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def arrivals_stream(
    events: DataFrame,
    boxes: list[Box],
    length: str = TEN_MINUTES,
    slide: str | None = None,
    delay: str = HOURLY,
    fill: bool = True,
) -> DataFrame:
    """(region, window_start, window_end, count, previous) for every window since a region's first one.

    Every event is counted once, in its pane; overlapping windows share the panes.  Without ``fill`` only windows
    with arrivals come out, ``previous`` being the count of the last one of them.
    Start the query inside ``stream_settings``.  ``alerts`` of the batch module applies to the result.
    """
    length_ms, slide_ms = milliseconds(length), milliseconds(slide or length)
    counted = busy_panes(events, boxes, pane_of(length, slide or length), delay).select(
        "region",
        F.unix_millis("pane.start").alias("start_ms"),
        "count",
        F.window_time("pane").alias("event_time"),
    )
    history = counted.groupBy("region").transformWithStateInPandas(
        statefulProcessor=SlidingCounts(length_ms, slide_ms, fill),
        outputStructType="region string, start_ms bigint, count bigint, previous bigint",
        outputMode="append",
        timeMode="eventTime",
    )
    return history.select(
        "region",
        F.timestamp_millis("start_ms").alias("window_start"),
        F.timestamp_millis(F.col("start_ms") + length_ms).alias("window_end"),
        "count",
        "previous",
    )


def region_stream(
    events: DataFrame,
    boxes: list[Box],
    length: str = HOURLY,
    slide: str | None = None,
    delay: str = HOURLY,
    fill: bool = True,
) -> DataFrame:
    """(region, window_start, window_end, count); ``fill`` adds the silent windows."""
    return arrivals_stream(events, boxes, length, slide, delay, fill).drop("previous")
