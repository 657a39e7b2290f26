import itertools
import random

import pytest
from conftest import at, frame
from pyspark.sql import functions as F

from headway.operators.change import consecutive_skip, first_by_value
from headway.operators.dedupe import dedupe, latest_state
from headway.operators.merge import merge_stop_events
from headway.operators.stale import is_fresh
from headway.operators.versions import events_with_trip, version_as_of, version_by_date
from headway.schemas import RAW, TRIP_KEYS, VEHICLE_KEYS

STU = RAW["stop_time_updates"].schema
TU = RAW["trip_updates"].schema


def stop(**cols):
    base = {
        "poll_time": at("2026-01-02 10:25"),
        "feed_timestamp": at("2026-01-02 10:25"),
        "trip_id": "trip_A",
        "start_date": "20260101",
        "route_id": "route_1",
        "stop_sequence": 1,
        "stop_id": "stop_100",
        "stop_schedule_relationship": 0,
    }
    return {**base, **cols}


def test_survivors_do_not_depend_on_layout(spark):
    rows = [
        (v, s, p, f"x{n}")
        for n, (v, s, p) in enumerate(
            itertools.product(["a", "b", None], [1, 2], [5, 5, 6])
        )
    ]
    schema = "vehicle_id string, feed_timestamp int, poll_time int, label string"
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, schema).repartition(1 + 2 * seed)
        for out in (
            dedupe(df, VEHICLE_KEYS),
            latest_state(df, ["vehicle_id"]),
        ):
            results.add(
                (len(out.columns), tuple(sorted(map(str, out.collect()))))
            )
    # One result per operator, whatever the order and partitions.
    assert len(results) == 2


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame(
        [(None, 1, 1), (None, 1, 2), ("a", 1, 1)],
        "vehicle_id string, feed_timestamp int, poll_time int",
    )
    got = {tuple(r) for r in dedupe(df, VEHICLE_KEYS).collect()}
    assert got == {(None, 1, 2), ("a", 1, 1)}


def test_a_hot_key_shrinks_before_the_exchange(spark):
    df = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") >= 0, "hot").alias("k"),
        F.col("id").alias("poll_time"),
    )
    out = dedupe(df, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert [tuple(r) for r in out.collect()] == [("hot", 999)]


def test_merge_mixes_maxima_of_confirmed_rows(spark):
    rows = [
        stop(
            arrival_delay=90,
            arrival_time=at("2026-01-02 10:20"),
            arrival_uncertainty=0,
        ),
        stop(
            arrival_delay=30,
            arrival_time=at("2026-01-02 10:25"),
            arrival_uncertainty=0,
            route_id="route_2",
        ),
        stop(
            arrival_delay=900,
            arrival_time=at("2026-01-02 11:25"),
            arrival_uncertainty=120,
        ),
    ]
    out = merge_stop_events(frame(spark, STU, rows)).collect()
    assert len(out) == 1
    assert out[0].arrival_delay == 90
    assert out[0].arrival_time.minute == 25
    assert out[0].route_id == "route_2"
    assert out[0].departure_time is None


def test_predictions_only_stay_without_times(spark):
    rows = [
        stop(
            arrival_delay=30,
            arrival_time=at("2026-01-02 10:25"),
            arrival_uncertainty=120,
        )
    ]
    (row,) = merge_stop_events(frame(spark, STU, rows)).collect()
    assert (row.arrival_delay, row.arrival_time) == (None, None)
    assert row.arrival_uncertainty is None


def test_uncertainty_zero_is_confirmed_and_null_is_not(spark):
    time = at("2026-01-02 10:25")
    rows = [
        stop(arrival_time=time, arrival_uncertainty=0, arrival_delay=0),
        stop(
            stop_id="s2",
            arrival_time=time,
            arrival_uncertainty=None,
            arrival_delay=7,
        ),
    ]
    out = merge_stop_events(frame(spark, STU, rows)).orderBy("stop_id")
    assert [r.arrival_delay for r in out.collect()] == [None, 0]


def test_same_sequence_at_two_stops_is_two_events(spark):
    rows = [stop(), stop(stop_id="stop_101")]
    assert merge_stop_events(frame(spark, STU, rows)).count() == 2


def test_staleness_limits(spark):
    poll = 1_700_000_000
    offsets = [-901, -900, -899, 0, 899, 900, 901]
    stamps = [poll + o for o in offsets] + [0]
    df = spark.createDataFrame([(s,) for s in stamps], "s bigint")
    keep = df.where(is_fresh(F.timestamp_seconds(F.lit(poll)), F.col("s")))
    assert sorted(r.s - poll for r in keep.collect()) == [
        -900, -899, 0, 899, 900
    ]


def _skip(spark, rows, width=10):
    df = spark.createDataFrame(rows, "feed string, t int, md5 string")
    chunk = (F.col("t") / width).cast("int")
    out = consecutive_skip(df, "feed", ["t"], "md5", chunk)
    return sorted(((r.feed, r.t) for r in out.collect()), key=str)


@pytest.mark.parametrize("width", [1, 2, 10])
def test_consecutive_skip_is_not_distinct(spark, width):
    rows = [("f", t, m) for t, m in enumerate("AABA")]
    assert _skip(spark, rows, width) == [("f", 0), ("f", 2), ("f", 3)]


@pytest.mark.parametrize("width", [1, 7, 50, 1000])
def test_consecutive_skip_with_hot_sources(spark, width):
    rng = random.Random(3)
    sizes = {"f": 60, "g": 60, None: 80, "h": 2}
    rows = [
        (feed, t, rng.choice(["A", "B", None]))
        for feed, size in sizes.items()
        for t in rng.sample(range(200), size)
    ]
    want = []
    for feed in sizes:
        before = object()
        for _, t, m in sorted((r for r in rows if r[0] == feed), key=lambda r: r[1]):
            if m != before:
                want.append((feed, t))
            before = m
    assert _skip(spark, rows, width) == sorted(want, key=str)


def test_first_by_value(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "id int, h string")
    got = {tuple(r) for r in first_by_value(df, "h", "id").collect()}
    assert got == {("a", 1), ("b", 2)}


def test_merge_sorts_nothing_before_the_exchange(spark):
    plan = merge_stop_events(frame(spark, STU, [stop()]))
    nodes = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    exchanges = [i for i, line in enumerate(nodes) if "Exchange" in line]
    assert exchanges
    assert not any("Sort" in line for line in nodes[exchanges[-1] :])
    assert not any("SortAggregate" in line for line in nodes[exchanges[-1] - 1 :])


def test_merge_sorts_once(spark):
    plan = merge_stop_events(frame(spark, STU, [stop()]))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1


def test_version_in_force(spark):
    versions = spark.createDataFrame(
        [
            ("20260101", "20260110"),
            ("20260105", "20260107"),
            ("20260105", "20260106"),
            # Ends before it begins: never in force.
            ("20260109", "20260102"),
        ],
        "valid_from string, valid_to string",
    )
    days = {
        r.start_date: (r.valid_from, r.valid_to)
        for r in version_by_date(versions).collect()
    }
    assert len(days) == 10
    assert days["20260104"] == ("20260101", "20260110")
    assert days["20260106"] == ("20260105", "20260107")
    assert days["20260108"] == ("20260101", "20260110")

    static = versions.selectExpr("'s' AS stop_id", "*", "valid_from AS name")
    facts = spark.createDataFrame(
        [("20260106", "s"), ("20260109", "s"), ("20270101", "s")],
        "start_date string, stop_id string",
    )
    out = version_as_of(facts, static, ["stop_id"])
    got = {r.start_date: r.name for r in out.collect()}
    assert got == {"20260106": "20260105", "20260109": "20260101", "20270101": None}


def test_events_keep_their_number_when_joined(spark):
    events = merge_stop_events(frame(spark, STU, [stop(), stop(stop_id="s2")]))
    trips = frame(
        spark,
        TU,
        [{"trip_id": "trip_A", "start_date": "20260101", "schedule_relationship": 3}],
    )
    out = events_with_trip(events, latest_state(trips, TRIP_KEYS))
    assert [r.trip_schedule_relationship for r in out.collect()] == [3, 3]
