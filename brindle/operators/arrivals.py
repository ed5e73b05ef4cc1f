"""Arrivals per region and time window, over a finite table.

Events are (x, y, ts, ...).  The same window and region expressions serve the streaming jobs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bounding boxes of the two original regions, window lengths, the alert rule and its text.
MIN_ARRIVALS = 10
GROWTH = 2
HOURLY = "60 minutes"
TEN_MINUTES = "10 minutes"
#: Rows that a list of windows may hold.
PAGE = 10_000
ALERT_TEXT = "Number of arrivals to %s has doubled from %d to %d at %d!"


@dataclass(frozen=True)
class Box:
    """A named region; points on its border are outside."""

    name: str
    min_x: float
    max_x: float
    min_y: float
    max_y: float
    title: str | None = None


CITY_BOXES = [
    Box("goldman", -74.0144185, -74.013777, 40.7138745, 40.7152275, "Goldman Sachs"),
    Box("citigroup", -74.012083, -74.009867, 40.720053, 40.7217236, "Citigroup"),
]


def region_of(boxes: list[Box], x: str = "x", y: str = "y") -> Column:
    """Name of the first box that holds the point, else NULL."""
    region = F.lit(None).cast("string")
    for box in reversed(boxes):
        inside = (
            (F.col(x) > box.min_x) & (F.col(x) < box.max_x) & (F.col(y) > box.min_y) & (F.col(y) < box.max_y)
        )
        region = F.when(inside, box.name).otherwise(region)
    return region


def milliseconds(text: str) -> int:
    """Length of an interval such as ``10 minutes``."""
    number, unit = text.split()
    return int(number) * {"second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]


def pane_of(length: str, slide: str) -> str:
    """The longest stretch of time of which every window and every slide is a whole number."""
    return f"{math.gcd(milliseconds(length), milliseconds(slide)) // 1000} seconds"


def _span(text: str) -> Column:
    return F.expr(f"INTERVAL '{milliseconds(text) // 1000}' SECOND")


def _floor(time: Column | str, step: str) -> Column:
    """Start of the step, counted from the epoch, that the time lies in."""
    return F.window(time, step)["start"]


def region_counts(
    events: DataFrame, boxes: list[Box], length: str = HOURLY, slide: str | None = None, fill: bool = True
) -> DataFrame:
    """(region, window_start, window_end, count) for windows of ``length`` every ``slide`` (default: length).

    Every event is counted once, in its pane (``pane_of``).  A pane is added to the running count at the first window
    that holds it and subtracted behind the last one, so an event is never copied for overlapping windows; between
    two such changes the count stays as it is.

    With ``fill`` a region has a row for every window from its first busy one to the last window the events reach,
    count 0 included.  Those rows are opened in pages of at most PAGE windows.  Events without a time are left out.
    """
    slide = slide or length
    inside = events.select(region_of(boxes).alias("region"), "ts").where(F.col("region").isNotNull())
    panes = inside.groupBy("region", F.window("ts", pane_of(length, slide)).alias("pane")).agg(F.count("*").alias("n"))
    panes = panes.select("region", "n", F.col("pane.start").alias("pane"))
    # Windows start at multiples of the slide: the first one that holds a pane, and the first one behind it that does not.
    entering = panes.select("*", _floor(F.col("pane") - _span(length), slide).alias("before"))
    leaving = entering.select("*", _floor("pane", slide).alias("at"))
    moves = leaving.select("region", "n", (F.col("before") + _span(slide)).alias("enters"), (F.col("at") + _span(slide)).alias("leaves"))
    changes = moves.where("enters < leaves").select(
        "region",
        F.explode(
            F.array(F.struct(F.col("enters").alias("start"), "n"), F.struct(F.col("leaves").alias("start"), (-F.col("n")).alias("n")))
        ).alias("change"),
    )
    changes = changes.groupBy("region", F.col("change.start").alias("start")).agg(F.sum("change.n").alias("n"))
    in_order = Window.partitionBy("region").orderBy("start")
    steady = changes.select(
        "region",
        "start",
        F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("count"),
        F.coalesce(F.lead("start").over(in_order), _last_start(events, slide) + _span(slide)).alias("until"),
    )
    if not fill:
        steady = steady.where("count > 0")
    windows = _opened(steady, slide)
    return windows.select(
        "region", "window_start", (F.col("window_start") + _span(length)).alias("window_end"), "count"
    )


def _last_start(events: DataFrame, slide: str) -> Column:
    """Start of the latest window that the events reach."""
    latest = events.agg(F.max("ts").alias("ts"))
    return latest.select(_floor("ts", slide).alias("start")).agg(F.max("start")).scalar()


def _opened(steady: DataFrame, slide: str) -> DataFrame:
    """(region, window_start, count): a row for every slide from ``start`` to before ``until``."""
    step = milliseconds(slide) // 1000
    # The difference of two times is the same with and without a time zone.
    seconds = F.expr("cast(cast(until - start as interval second) as bigint)")
    pages = steady.withColumn("n", F.floor(seconds / step)).where("n > 0").withColumn(
        "page", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / PAGE)))
    )
    rest = F.least(F.lit(PAGE), F.col("n") - F.col("page") * PAGE)
    rows = pages.withColumn("row", F.explode(F.sequence(F.lit(0), rest - 1))).withColumn("place", F.col("page") * PAGE + F.col("row"))
    shift = F.make_dt_interval(secs=(F.col("place") * step).cast("decimal(18,6)"))
    return rows.select("region", (F.col("start") + shift).alias("window_start"), "count")


def arrivals_with_previous(
    events: DataFrame, boxes: list[Box], length: str = TEN_MINUTES
) -> DataFrame:
    """``region_counts`` with ``previous``, the count of the window right before (0 at first)."""
    in_order = Window.partitionBy("region").orderBy("window_start")
    return region_counts(events, boxes, length).withColumn("previous", F.lag("count", 1, 0).over(in_order))


def alerts(
    arrivals: DataFrame, boxes: list[Box], minimum: int = MIN_ARRIVALS, growth: int = GROWTH
) -> DataFrame:
    """Windows with enough arrivals that also grew enough, with the alert text.

    Works on a table and on a stream.  The text gives the window end in epoch milliseconds.
    """
    title = F.col("region")
    for box in boxes:
        title = F.when(F.col("region") == box.name, box.title or box.name).otherwise(title)
    hot = (F.col("count") >= minimum) & (F.col("count") >= growth * F.col("previous"))
    at = F.unix_millis(F.col("window_end").cast("timestamp"))
    text = F.format_string(ALERT_TEXT, title, F.col("previous"), F.col("count"), at)
    return arrivals.where(hot).withColumn("message", text)
