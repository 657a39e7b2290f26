import logging

import pytest
from conftest import at, land

from headway.plans.daily import (
    process_stop_time_events,
    process_trip_updates,
    process_vehicle_positions,
    run_daily,
)
from headway.schemas import PROCESSED
from headway.store import Store
from headway.tables import read_table

NOW = at("2026-01-01 15:00")
DAY = "20260101"


def vehicle(name, poll="2026-01-02 10:30", stamp="2026-01-02 10:25", **cols):
    return {
        "poll_time": at(poll),
        "feed_timestamp": at(stamp),
        "vehicle_id": name,
        "route_id": "route_1" if name == "vehicle_A" else "route_2",
        "start_date": DAY,
        "latitude": -36.8485,
        "longitude": 174.7633,
        **cols,
    }


def stop_row(seq, side, delay, uncertainty=0):
    minute = "10:25" if side == "arrival" else "10:26"
    time = at(f"2026-01-02 {minute}")
    return {
        "poll_time": time,
        "feed_timestamp": time,
        "trip_id": "trip_A",
        "start_date": DAY,
        "route_id": "route_1",
        "stop_sequence": seq,
        "stop_id": f"stop_{seq}00",
        "stop_schedule_relationship": 0,
        f"{side}_delay": delay,
        f"{side}_time": time,
        f"{side}_uncertainty": uncertainty,
    }


VEHICLES = [
    vehicle(v, f"2026-01-02 10:30:{s}")
    for v in ("vehicle_A", "vehicle_B")
    for s in ("00", "30")
]
STOPS = [
    stop_row(1, "arrival", 30),
    stop_row(1, "departure", 45),
    stop_row(2, "arrival", 60),
    stop_row(2, "departure", 75),
]


def read(spark, root, table):
    return read_table(spark, root, PROCESSED[table])


def test_dedupes_positions(spark, raw, processed):
    land(spark, raw, "vehicle_positions", VEHICLES)
    assert process_vehicle_positions(spark, raw, processed, NOW) == 2
    rows = read(spark, processed, "vehicle_positions").collect()
    assert {r.vehicle_id for r in rows} == {"vehicle_A", "vehicle_B"}
    assert {r.poll_time.second for r in rows} == {30}
    assert {r.start_date for r in rows} == {DAY}


def test_keeps_unique_positions(spark, raw, processed):
    rows = [
        vehicle(f"v{n}", stamp=f"2026-01-02 10:25:0{n}") for n in range(5)
    ]
    land(spark, raw, "vehicle_positions", rows)
    assert process_vehicle_positions(spark, raw, processed, NOW) == 5


def test_missing_table_is_skipped(spark, raw, processed, caplog):
    with caplog.at_level(logging.WARNING):
        assert process_vehicle_positions(spark, raw, processed, NOW) == 0
    assert "is missing" in caplog.text
    assert not Store(spark, processed).exists(processed)


def test_empty_day_keeps_what_was_there(spark, raw, processed, caplog):
    land(spark, raw, "vehicle_positions", VEHICLES)
    process_vehicle_positions(spark, raw, processed, NOW)
    with caplog.at_level(logging.INFO):
        later = at("2026-02-01 15:00")
        assert process_vehicle_positions(spark, raw, processed, later) == 0
    assert "raw vehicle_positions is empty" in caplog.text
    assert read(spark, processed, "vehicle_positions").count() == 2


def test_latest_trip_state(spark, raw, processed):
    rows = [
        {
            "poll_time": at(f"2026-01-02 {clock}"),
            "feed_timestamp": at(f"2026-01-02 {clock}"),
            "trip_id": "trip_A",
            "route_id": "route_1",
            "schedule_relationship": status,
            "start_date": DAY,
        }
        for clock, status in (("10:25", 0), ("10:55", 3))
    ]
    land(spark, raw, "trip_updates", rows)
    assert process_trip_updates(spark, raw, processed, NOW) == 1
    (row,) = read(spark, processed, "trip_updates").collect()
    assert row.schedule_relationship == 3


def test_merges_arrival_and_departure(spark, raw, processed):
    land(spark, raw, "stop_time_updates", STOPS)
    assert process_stop_time_events(spark, raw, processed, NOW) == 2
    rows = read(spark, processed, "stop_time_events").orderBy("stop_sequence")
    assert [(r.arrival_delay, r.departure_delay) for r in rows.collect()] == [
        (30, 45),
        (60, 75),
    ]
    assert Store(spark, processed).child_dirs(processed) == ["stop_time_events"]


def test_excludes_predictions(spark, raw, processed):
    rows = [stop_row(1, "arrival", 30, 120), stop_row(1, "departure", 45)]
    land(spark, raw, "stop_time_updates", rows)
    process_stop_time_events(spark, raw, processed, NOW)
    (row,) = read(spark, processed, "stop_time_events").collect()
    assert (row.arrival_delay, row.departure_delay) == (None, 45)


def test_all_tables_and_reruns(spark, raw, processed, caplog):
    land(spark, raw, "vehicle_positions", VEHICLES)
    land(spark, raw, "stop_time_updates", STOPS)
    for _ in range(2):
        with caplog.at_level(logging.WARNING):
            assert run_daily(spark, raw, processed, NOW) == {
                "vehicle_positions": 2,
                "trip_updates": 0,
                "stop_time_events": 2,
            }
    assert "trip_updates" in caplog.text
    assert read(spark, processed, "vehicle_positions").count() == 2


def test_nothing_landed(spark, raw, processed):
    assert sum(run_daily(spark, raw, processed, NOW).values()) == 0


def test_unknown_date_is_never_processed(spark, raw, processed):
    land(
        spark,
        raw,
        "vehicle_positions",
        [*VEHICLES, vehicle("v", start_date="UNKNOWN", route_id="NA")],
    )
    assert process_vehicle_positions(spark, raw, processed, NOW) == 2


@pytest.mark.parametrize("together", [True, False])
def test_several_dates_are_each_date(spark, raw, processed, together):
    rows = VEHICLES + [vehicle("vehicle_A", start_date="20260102")]
    land(spark, raw, "vehicle_positions", rows)
    days = [DAY, "20260102"]
    for dates in [days] if together else [[d] for d in days]:
        process_vehicle_positions(spark, raw, processed, dates=dates)
    out = read(spark, processed, "vehicle_positions")
    counts = {r[0]: r[1] for r in out.groupBy("start_date").count().collect()}
    assert counts == {DAY: 2, "20260102": 1}
