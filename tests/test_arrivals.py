"""Region counts, silent windows, alerts; streams against their batch forms."""

import datetime as dt
import math
import os
import random

import pandas as pd
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from brindle.operators import arrivals as ar
from brindle.operators.arrivals import Box
from brindle.session import work_path
from brindle.sources import readers, sinks
from brindle.streaming import arrivals as st

START = dt.datetime(2024, 1, 1)
BOXES = [Box("a", 0, 10, 0, 10, "Area A"), Box("b", 5, 20, 0, 10)]


def events_of(spark, points):
    """(minutes, x, y) as events."""
    data = [(float(x), float(y), START + dt.timedelta(minutes=m)) for m, x, y in points]
    return spark.createDataFrame(data, "x double, y double, ts timestamp")


def shown(df, *columns):
    start = ((F.unix_seconds("window_start") - F.unix_seconds(F.lit(START))) / 60).cast("int").alias("minute")
    return sorted(tuple(r) for r in df.select("region", start, *columns).collect())


def test_box_borders_are_outside_and_first_box_wins(spark):
    points = [(0, 0), (10, 5), (5, 10), (7, 5), (5, 5), (19.99, 5), (20, 5), (-1, 5)]
    df = spark.createDataFrame([(float(x), float(y)) for x, y in points], "x double, y double")
    assert [r[0] for r in df.select(ar.region_of(BOXES)).collect()] == [None, "b", None, "a", "a", "b", None, None]


def test_silent_windows(spark):
    # a: busy in windows 0 and 3; b: first seen in window 2; the last event is outside, in window 4.
    events = events_of(spark, [(1, 1, 1), (2, 1, 1), (35, 1, 1), (22, 15, 1), (41, 99, 99)])
    counts = ar.region_counts(events, BOXES, "10 minutes")
    assert shown(counts, "count") == [
        ("a", 0, 2), ("a", 10, 0), ("a", 20, 0), ("a", 30, 1), ("a", 40, 0), ("b", 20, 1), ("b", 30, 0), ("b", 40, 0),
    ]
    assert shown(ar.region_counts(events, BOXES, "10 minutes", fill=False), "count") == [("a", 0, 2), ("a", 30, 1), ("b", 20, 1)]
    previous = ar.arrivals_with_previous(events, BOXES, "10 minutes")
    assert [r[3] for r in shown(previous, "count", "previous")] == [0, 2, 0, 0, 1, 0, 1, 0]


def test_sliding_windows(spark):
    events = events_of(spark, [(25, 1, 1), (41, 99, 99)])
    assert shown(ar.region_counts(events, BOXES, "30 minutes", "10 minutes"), "count") == [
        ("a", 0, 1), ("a", 10, 1), ("a", 20, 1), ("a", 30, 0), ("a", 40, 0),
    ]


def test_alert_rule_and_text(spark):
    # window counts of a: 10 (first), 19 (not doubled), 38 (exactly doubled), 9; b: 9 only, then 10
    sizes = {"a": [10, 19, 38, 9], "b": [9, 10, 0, 10]}
    x = {"a": 1, "b": 15}
    points = [(10 * w + 1, x[r], 1) for r, counts in sizes.items() for w, n in enumerate(counts) for _ in range(n)]
    alerts = ar.alerts(ar.arrivals_with_previous(events_of(spark, points), BOXES, "10 minutes"), BOXES)
    assert shown(alerts, "count", "previous") == [("a", 0, 10, 0), ("a", 20, 38, 19), ("b", 30, 10, 0)]
    end = int(START.replace(tzinfo=dt.timezone.utc).timestamp() * 1000) + 10 * 60_000
    texts = [r.message for r in alerts.orderBy("region", "window_start").collect()]
    assert texts[0] == f"Number of arrivals to Area A has doubled from 0 to 10 at {end}!"
    assert texts[2].startswith("Number of arrivals to b has doubled from 0 to 10 at ")


def test_trip_layouts(spark, tmp_path):
    path = tmp_path / "trips.txt"
    path.write_text("Green_2015,t,2,3,4,5,6,7,1.5,2.5,0,0\nyellow,t,2,3,4,5,6,7,0,0,3.5,4.5\nNEWGREEN,t,2,3,4,5,6,7,8,9,0,0\n")
    got = [tuple(r) for r in readers.decode_trips(readers.text_lines(spark, str(path))).collect()]
    assert got == [("Green_2015", 1.5, 2.5), ("yellow", 3.5, 4.5), ("NEWGREEN", 8.0, 9.0)]
    assert ar.CITY_BOXES[0].title == "Goldman Sachs" and ar.CITY_BOXES[1].max_y == 40.7217236


@pytest.fixture(scope="module")
def busy_events(spark):
    """Three hours; a is silent from minute 40 to 110, b is seen late and ends early."""
    rng = random.Random(4)
    points = [(rng.uniform(0, 40), 1, 1) for _ in range(60)] + [(rng.uniform(110, 175), 1, 1) for _ in range(80)]
    points += [(rng.uniform(60, 100), 15, 1) for _ in range(50)] + [(rng.uniform(0, 179), 99, 99) for _ in range(30)]
    return events_of(spark, points)


def with_closing(spark, events, closing):
    """The events and one outside every region that moves the watermark on."""
    nowhere = spark.createDataFrame([(None, None, closing)], "x double, y double, ts timestamp")
    return events.select("x", "y", "ts").unionByName(nowhere)


def replayed(spark, events, build, length_minutes, slide_minutes, delay_minutes=40):
    """Run a stream over files of the events by name; the closing event lies a delay after the last window's end."""
    folder, out, log = (work_path(spark, n) for n in ("events", "out", "log"))
    last = events.agg(F.max("ts")).first()[0]
    slide = dt.timedelta(minutes=slide_minutes)
    last_start = START + (last - START) // slide * slide
    closing = last_start + dt.timedelta(minutes=length_minutes + delay_minutes)
    sinks.write_in_ranges(with_closing(spark, events, closing), folder, "ts", 5)
    source = readers.named_file_stream(spark, folder, "x double, y double, ts timestamp", log)
    with st.stream_settings(spark, 3):
        query = sinks.stream_to_parquet(build(source, f"{delay_minutes} minutes"), out, log, available_now=False)
    query.processAllAvailable()
    assert len(query.recentProgress) >= 5
    query.stop()
    return spark.read.parquet(out)


def test_stream_history_equals_batch(spark, busy_events):
    out = replayed(spark, busy_events, lambda e, d: st.arrivals_stream(e, BOXES, "10 minutes", delay=d), 10, 10)
    batch = ar.arrivals_with_previous(busy_events, BOXES, "10 minutes").select(*out.columns)
    assert rows(out) == rows(batch)
    assert batch.where("count = 0").count() > 5


def test_stream_sliding_without_fill_equals_batch(spark, busy_events):
    out = replayed(
        spark, busy_events, lambda e, d: st.region_stream(e, BOXES, "30 minutes", "10 minutes", d, fill=False), 30, 10
    )
    batch = ar.region_counts(busy_events, BOXES, "30 minutes", "10 minutes", fill=False).select(*out.columns)
    assert rows(out) == rows(batch)


def test_stream_sliding_with_fill_equals_batch(spark, busy_events):
    out = replayed(spark, busy_events, lambda e, d: st.region_stream(e, BOXES, "30 minutes", "10 minutes", d), 30, 10)
    batch = ar.region_counts(busy_events, BOXES, "30 minutes", "10 minutes").select(*out.columns)
    assert rows(out) == rows(batch)


def test_stream_of_trip_text_equals_batch(spark, busy_events):
    folder, out, log = (work_path(spark, n) for n in ("trips", "out", "log"))
    line = F.concat_ws(",", F.lit("green"), F.col("ts").cast("string"), F.lit("2,3,4,5,6,7"), "x", "y", F.lit("0,0"))
    closing = START + dt.timedelta(hours=5)
    spark.range(1).select(F.lit(f"end,{closing},2,3,4,5,6,7,0,0,999,999").alias("value")).write.text(folder)
    busy_events.coalesce(1).select(line.alias("value")).write.mode("append").text(folder)
    source = readers.ordered_file_stream(spark, folder, "value string", files_per_batch=10, format="text")
    trips = readers.decode_trips(source, "value", time_field=1)
    with st.stream_settings(spark, 2):
        sinks.stream_to_parquet(st.region_stream(trips, BOXES, "60 minutes", delay="2 hours"), out, log).awaitTermination()
    batch = ar.region_counts(busy_events, BOXES, "60 minutes")
    assert rows(spark.read.parquet(out), *batch.columns) == rows(batch)


def test_stream_sink_in_folders_per_window(spark, busy_events):
    folder, out, log = (work_path(spark, n) for n in ("events", "out", "log"))
    sinks.write_in_ranges(with_closing(spark, busy_events, START + dt.timedelta(hours=9)), folder, "ts", 2)
    source = readers.named_file_stream(spark, folder, "x double, y double, ts timestamp", log)
    hourly = st.region_stream(source, BOXES, "60 minutes", delay="2 hours", fill=False)
    with st.stream_settings(spark, 2):
        sinks.run_to_end(sinks.stream_to_parquet(hourly, out, log, ["window_start"], available_now=False))
    assert sorted(p for p in os.listdir(out) if p.startswith("window_start=")) == [
        f"window_start=2024-01-01 0{hour}%3A00%3A00" for hour in range(3)
    ]
    batch = ar.region_counts(busy_events, BOXES, "60 minutes", fill=False)
    assert rows(spark.read.parquet(out), "region", "window_start", "count") == rows(batch, "region", "window_start", "count")


def test_stream_settings_are_restored(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with st.stream_settings(spark):
        assert spark.conf.get(key) == st.STATE_STORE
    assert spark.conf.get(key) == before and spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_missing_stream_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="does not exist|PATH_NOT_FOUND"):
        readers.ordered_file_stream(spark, str(tmp_path / "nothing"), "x double, y double, ts timestamp")


def test_sliding_counts_any_length_and_slide(spark):
    """Pane sums against a count per window, overlapping, touching and with gaps."""
    rng = random.Random(8)
    points = [(rng.choice([0, 1, 2, 400]) + rng.uniform(0, 90), rng.choice([1, 15, 99]), 1) for _ in range(150)]
    events = events_of(spark, points)
    last = max(m for m, _, _ in points)
    for length, slide in [(30, 10), (25, 10), (10, 10), (10, 25), (60, 7), (1, 1), (90, 60)]:
        epoch = int(START.replace(tzinfo=dt.timezone.utc).timestamp()) // 60
        first = (epoch - length) // slide * slide - epoch
        starts = [s for s in range(first, int(last) + 1, slide)]
        expected = []
        for region, x in (("a", 1), ("b", 15)):
            counts = [(s, sum(s <= m < s + length for m, px, _ in points if px == x)) for s in starts]
            busy = [s for s, n in counts if n]
            expected += [(region, s, n) for s, n in counts if busy and s >= busy[0] and s <= last]
        got = shown(ar.region_counts(events, BOXES, f"{length} minutes", f"{slide} minutes"), "count")
        assert got == sorted(expected), (length, slide)
        bare = shown(ar.region_counts(events, BOXES, f"{length} minutes", f"{slide} minutes", fill=False), "count")
        assert bare == [r for r in sorted(expected) if r[2]], (length, slide)


def test_an_event_is_counted_once(spark):
    """No copy of an event per window: the plan expands nothing before the first count."""
    text = plan(ar.region_counts(events_of(spark, [(1, 1, 1)]), BOXES, "24 hours", "1 minute", fill=False), "simple")
    below = text[text.rindex("HashAggregate(keys=[region"):]
    assert "Expand" not in text and "Generate" not in below


def test_long_silence_in_a_table(spark):
    points = [(0, 1, 1), (1_000_000, 1, 1)]
    counts = ar.region_counts(events_of(spark, points), BOXES, "1 minute")
    assert counts.count() == 1_000_001 and counts.where("count > 0").count() == 2
    assert tuple(counts.agg(F.countDistinct("window_start"), F.max("window_start")).first()) == (1_000_001, START + dt.timedelta(minutes=1_000_000))


def windows_of(length, slide, fill, batches):
    """(start, count, previous) that the state operator emits; batches are (panes, watermark)."""

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

    class Panes(dict):
        def exists(self):
            return bool(self)

        def iterator(self):
            return iter(list(self.items()))

        def removeKey(self, key):
            del self[key]

        def updateValue(self, key, value):
            self[key] = value

    class Handle:
        def __init__(self):
            self.timers = set()

        def getValueState(self, *_):
            return Value()

        def getMapState(self, *_):
            return Panes()

        def registerTimer(self, at):
            self.timers.add(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    class Times:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return self.at

    handle = Handle()
    own = st.SlidingCounts(length, slide, fill)
    own.init(handle)
    sizes, out = [], []
    for panes, reached in batches:
        frames = []
        if panes:
            frame = pd.DataFrame(panes, columns=["start_ms", "count"])
            frames += own.handleInputRows(("r",), iter([frame]), Times(reached))
        while fired := {t for t in handle.timers if t < reached}:
            handle.timers -= fired
            frames += own.handleExpiredTimer(("r",), Times(reached), None)
        sizes += map(len, frames)
        out += [row for f in frames for row in zip(f["start_ms"].tolist(), f["count"].tolist(), f["previous"].tolist())]
    return out, max(sizes, default=0)


@pytest.mark.parametrize("length, slide", [(30, 10), (10, 10), (20, 50), (25, 10)])
@pytest.mark.parametrize("fill", [True, False])
def test_state_operator_against_counts(length, slide, fill):
    rng = random.Random(length + slide)
    pane = math.gcd(length, slide)
    places = {rng.randrange(40) * pane for _ in range(20)} | {300 * pane + rng.randrange(5) * pane for _ in range(3)}
    panes = sorted((p, rng.randint(1, 5)) for p in places)
    batches, done = [], 0
    for reached in [pane * k for k in (5, 6, 20, 41, 42, 43, 250, 301, 306, 500)]:
        batches.append(([p for p in panes if done < p[0] + pane <= reached or (done == 0 and p[0] + pane <= reached)], reached))
        done = reached
    got, _ = windows_of(length, slide, fill, batches)
    expected, previous, busy = [], 0, False
    for start in range(-length // slide * slide, 500 * pane, slide):
        count = sum(n for p, n in panes if start <= p < start + length)
        busy |= count > 0
        if busy and start + length <= 500 * pane and (fill or count):
            expected.append((start, count, previous))
            previous = count
    assert got == expected


def test_long_silence_in_a_stream():
    """A million silent windows leave in frames of a bounded size."""
    got, largest = windows_of(10, 10, True, [([(0, 3)], 10), ([(10_000_000, 4)], 10_000_010)])
    assert len(got) == 1_000_001 and largest <= st.PAGE
    assert got[:2] == [(0, 3, 0), (10, 0, 3)] and got[-1] == (10_000_000, 4, 0)
    quiet, largest = windows_of(10, 10, True, [([(0, 3)], 10), ([], 10_000_010)])
    assert len(quiet) == 1_000_001 and largest <= st.PAGE and quiet[-1] == (10_000_000, 0, 0)


@pytest.fixture
def reversed_files(spark):
    """Files whose order of names is that of time and whose modification times are the other way round."""
    folder = work_path(spark, "reversed")
    for hour in range(4):
        events = events_of(spark, [(60 * hour + k, 1, 1) for k in range(hour + 1)])
        frame = events.toPandas()
        os.makedirs(folder, exist_ok=True)
        path = f"{folder}/part-{hour:04d}.parquet"
        frame.to_parquet(path, coerce_timestamps="us")
        os.utime(path, (2_000_000_000 - 1000 * hour,) * 2)
    open(f"{folder}/_SUCCESS", "w").close()
    return folder


def test_stream_takes_files_by_name(spark, reversed_files):
    """No delay: a file taken out of order would be late and lost."""
    out, log = (work_path(spark, n) for n in ("out", "log"))

    def run():
        source = readers.named_file_stream(spark, reversed_files, "x double, y double, ts timestamp", log)
        hourly = st.region_stream(source, BOXES, "60 minutes", delay="0 seconds", fill=False)
        with st.stream_settings(spark, 2):
            query = sinks.stream_in_batches(hourly, out, log)
        query.processAllAvailable()
        sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        query.stop()
        return sizes

    assert run() == [1, 2, 3, 4]
    written = spark.read.parquet(out)
    assert shown(written, "count") == [("a", 0, 1), ("a", 60, 2), ("a", 120, 3)]
    # Restarted, it takes later files one by one, and none under an earlier name.
    for name, minute in (("part-0009.parquet", 600), ("part-0010.parquet", 700), ("part-0000a.parquet", 30)):
        events_of(spark, [(minute, 1, 1)]).toPandas().to_parquet(f"{reversed_files}/{name}", coerce_timestamps="us")
    assert run() == [1, 1]
    assert shown(spark.read.parquet(out), "count") == [("a", 0, 1), ("a", 60, 2), ("a", 120, 3), ("a", 180, 4), ("a", 600, 1)]


def test_a_repeated_batch_replaces_itself(spark, reversed_files):
    """A batch whose commit was lost runs again under its number."""
    out, log = (work_path(spark, n) for n in ("out", "log"))

    def run():
        source = readers.named_file_stream(spark, reversed_files, "x double, y double, ts timestamp", log, files_per_batch=3)
        sinks.run_to_end(sinks.stream_in_batches(source.select("x", "ts"), out, log))
        return rows(spark.read.parquet(out), "batch", "ts")

    first = run()
    assert len(first) == 10 and {r[0] for r in first} == {0, 1}
    commits = f"{log}/commits"
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    assert run() == first
    sinks.write_batch(spark.range(2), out, 1)
    assert spark.read.parquet(f"{out}/batch=1").count() == 2


def test_text_files_by_name(spark, tmp_path):
    for k, text in enumerate(["one\ntwo\n", "", "three"]):
        (tmp_path / f"part-{k}").write_text(text)
    (tmp_path / "other").write_text("no")
    out, log = (work_path(spark, n) for n in ("out", "log"))
    source = readers.named_file_stream(spark, f"file://{tmp_path}", "value string", log, format="text")
    sinks.run_to_end(sinks.stream_in_batches(source, out, log))
    assert rows(spark.read.parquet(out), "value") == [("one",), ("three",), ("two",)]
    missing = readers.named_file_stream(spark, str(tmp_path / "nothing"), "value string", log, format="text")
    with pytest.raises(Exception, match="nothing"):
        query = sinks.stream_in_batches(missing, work_path(spark, "out"), work_path(spark, "log"))
        sinks.run_to_end(query)


def test_ranges_are_in_order_of_names(spark):
    folder = work_path(spark, "ranges")
    sinks.write_in_ranges(spark.range(1000).selectExpr("(id * 7919) % 1000 as v"), folder, "v", 4)
    names = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    values = [v for n in names for (v,) in spark.read.parquet(f"{folder}/{n}").collect()]
    assert len(names) == 4 and values == list(range(1000))
