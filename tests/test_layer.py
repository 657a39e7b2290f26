"""Dates of the processed layer close by the clock of the polls."""

from datetime import timedelta

import pytest
from conftest import at, frame

from headway.plans.daily import run_daily
from headway.schemas import PROCESSED, RAW
from headway.streaming.layer import closing_time, late_spec, run_layer
from headway.tables import append, read_table, table_exists


def test_a_date_closes_four_hours_after_its_local_day():
    # Summer time is 13 hours ahead of UTC, winter time 12.
    assert closing_time("20260101") == at("2026-01-01 15:00")
    assert closing_time("20260701") == at("2026-07-01 16:00")
    assert closing_time("20260101", "UTC", timedelta(0)) == at("2026-01-02 00:00")


def trip(trip_id, date, poll, route="R"):
    polled = at(poll)
    return {
        "poll_time": polled, "feed_timestamp": polled, "trip_id": trip_id,
        "route_id": route, "start_date": date, "schedule_relationship": 0,
    }


def position(vehicle, date, poll):
    return {**trip("t", date, poll), "vehicle_id": vehicle}


def land(spark, root, load, trips=(), positions=()):
    for table, rows in (("trip_updates", trips), ("vehicle_positions", positions)):
        if rows:
            spec = RAW[table]
            append(frame(spark, spec.schema, rows), root, spec, load)


def trips_of(spark, root):
    spec = PROCESSED["trip_updates"]
    if not table_exists(spark, root, spec):
        return set()
    rows = read_table(spark, root, spec).collect()
    return {(r.start_date, r.trip_id, f"{r.poll_time:%d %H:%M}") for r in rows}


@pytest.mark.parametrize("follow", [False, True])
def test_dates_close_in_order_and_late_rows_are_kept(spark, raw, processed, tmp_path, follow):
    def drain():
        run_layer(
            spark, raw, processed, str(tmp_path / "checkpoint"),
            zone="UTC", follow_late=follow, interval=None,
        ).awaitTermination()

    land(spark, raw, "1", [trip("a", "20260101", "2026-01-01 09:00"),
                           trip("x", "UNKNOWN", "2026-01-01 09:00")])
    drain()
    assert trips_of(spark, processed) == set()
    # Out of order, but the date is open until 04:00.
    land(spark, raw, "2", [trip("b", "20260102", "2026-01-02 03:59")])
    land(spark, raw, "3", [trip("a", "20260101", "2026-01-01 08:00"),
                           trip("c", "20260101", "2026-01-01 07:00")])
    drain()
    assert trips_of(spark, processed) == set()
    land(spark, raw, "4", positions=[position("v", "20260102", "2026-01-02 04:01")])
    drain()
    first = {("20260101", "a", "01 09:00"), ("20260101", "c", "01 07:00")}
    assert trips_of(spark, processed) == first
    # Late for the first date, in time for the second, which closes much later.
    land(spark, raw, "5", [trip("d", "20260101", "2026-01-01 23:00"),
                           trip("b", "20260102", "2026-01-02 05:00")])
    land(spark, raw, "6", positions=[position("v", "20260105", "2026-01-05 00:00")])
    drain()
    drain()
    late = late_spec("trip_updates")
    assert [r.trip_id for r in read_table(spark, processed, late).collect()] == ["d"]
    assert not table_exists(spark, processed, late_spec("vehicle_positions"))
    second = {("20260102", "b", "02 05:00")}
    more = {("20260101", "d", "01 23:00")} if follow else set()
    assert trips_of(spark, processed) == first | second | more
    spec = PROCESSED["vehicle_positions"]
    assert {r.start_date for r in read_table(spark, processed, spec).collect()} == {"20260102"}
    if follow:
        again = str(tmp_path / "again")
        run_daily(spark, raw, again, dates=["20260101", "20260102"])
        assert trips_of(spark, again) == trips_of(spark, processed)


def test_what_compaction_rewrites_is_not_new(spark, raw, processed, tmp_path):
    def drain():
        run_layer(
            spark, raw, processed, str(tmp_path / "checkpoint"), zone="UTC", interval=None
        ).awaitTermination()

    land(spark, raw, "1", [trip("a", "20260101", "2026-01-01 09:00")])
    land(spark, raw, "2", [trip("b", "20260103", "2026-01-03 09:00")])
    drain()
    land(spark, raw, "merged-1", [trip("a", "20260101", "2026-01-01 09:00")])
    drain()
    assert not table_exists(spark, processed, late_spec("trip_updates"))


def test_state_does_not_grow_with_shuffle_partitions(spark, raw, processed, tmp_path):
    """A store for each of a few partitions, and processing with the session's own."""
    from headway.session import conf
    from headway.streaming.layer import STATE_PARTITIONS

    checkpoint = tmp_path / "checkpoint"
    with conf(spark, {"spark.sql.shuffle.partitions": "9"}):
        for n, poll in enumerate(("2026-01-01 09:00", "2026-01-03 09:00")):
            date = poll[:10].replace("-", "")
            land(spark, raw, str(n), [trip("a", date, poll)])
            run_layer(
                spark, raw, processed, str(checkpoint), zone="UTC", interval=None
            ).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "9"
    assert trips_of(spark, processed) == {("20260101", "a", "01 09:00")}
    stores = [d for d in (checkpoint / "state" / "0").iterdir() if d.name.isdecimal()]
    assert len(stores) == STATE_PARTITIONS
