"""Tables merged batch by batch equal those of the daily job."""

import random

import pytest
from conftest import at, frame

from headway.plans.daily import run_daily
from headway.schemas import PROCESSED, RAW
from headway.store import Store
from headway.streaming.incremental import REFINEMENTS, run_incremental
from headway.tables import append, read_table, table_path

KINDS = list(REFINEMENTS)


def some_rows(rng, table, n):
    rows = []
    for _ in range(n):
        minute = rng.randrange(60 * 20)
        poll = at(f"2026-01-0{rng.randint(1, 2)} {minute // 60:02d}:{minute % 60:02d}")
        row = {
            "poll_time": poll, "feed_timestamp": at(f"2026-01-01 0{rng.randint(0, 3)}:00"),
            "trip_id": f"t{rng.randrange(6)}", "start_date": f"2026010{rng.randint(1, 2)}",
            "route_id": f"R{rng.randrange(3)}", "schedule_relationship": rng.randrange(4),
        }
        if table == "vehicle_positions":
            row |= {"vehicle_id": f"v{rng.randrange(5)}", "latitude": rng.random()}
        if table == "stop_time_updates":
            row |= {
                "stop_sequence": rng.randrange(3), "stop_id": "s",
                "arrival_time": rng.choice([None, poll]), "arrival_delay": rng.randrange(90),
                "arrival_uncertainty": rng.choice([0, 0, 120]),
                "departure_time": rng.choice([None, poll]), "departure_delay": rng.randrange(90),
                "departure_uncertainty": rng.choice([0, 120]),
            }
        rows.append(row)
    return rows


def contents(spark, root, target):
    return sorted(map(repr, read_table(spark, root, PROCESSED[target]).collect()))


def stamps(spark, root, target):
    """When each folder was made."""
    path = table_path(root, PROCESSED[target])
    store = Store(spark, path)
    return {
        f"{day}/{route}": store._fs.getFileStatus(store._path(f"{path}/{day}/{route}")).getModificationTime()
        for day in store.child_dirs(path) if day.startswith("start_date")
        for route in store.child_dirs(f"{path}/{day}")
    }


@pytest.mark.parametrize("target", KINDS)
def test_equal_to_the_daily_job_after_every_landing(spark, raw, processed, tmp_path, target):
    rng = random.Random(target)
    what = REFINEMENTS[target]
    spec = RAW[what.source]
    unknown = {"start_date": "UNKNOWN", "route_id": "R0", "trip_id": "t0", "poll_time": at("2026-01-01 00:00")}
    for n in range(3):
        rows = some_rows(rng, what.source, 60) + [unknown]
        append(frame(spark, spec.schema, rows), raw, spec, f"load-{n}")
        run_incremental(
            spark, raw, processed, str(tmp_path / "checkpoint"), target=target, interval=None
        ).awaitTermination()
        whole = str(tmp_path / f"whole{n}")
        run_daily(spark, raw, whole, dates=["20260101", "20260102"])
        assert contents(spark, processed, target) == contents(spark, whole, target)


def test_only_touched_folders_are_written_and_repeats_change_nothing(spark, raw, processed, tmp_path):
    target, spec = "stop_time_events", RAW["stop_time_updates"]
    checkpoint = str(tmp_path / "checkpoint")

    def load(name, rows, where):
        append(frame(spark, spec.schema, rows), raw, spec, name)
        run_incremental(spark, raw, processed, where, target=target, interval=None).awaitTermination()

    rows = some_rows(random.Random(1), "stop_time_updates", 80)
    load("a", rows, checkpoint)
    before = stamps(spark, processed, target)
    seen = {(r["trip_id"], r["start_date"], r["stop_sequence"]) for r in rows}
    new = {**rows[0], "trip_id": "new", "start_date": "20260101", "route_id": "R1"}
    assert ("new", "20260101", new["stop_sequence"]) not in seen
    load("b", [new], checkpoint)
    after = stamps(spark, processed, target)
    assert {f for f in after if after[f] != before.get(f)} == {"start_date=20260101/route_id=R1"}
    # A greater route moves the stop, and leaves the folder of the old one.
    load("c", [{**new, "route_id": "R9"}], checkpoint)
    found = read_table(spark, processed, PROCESSED[target]).where("trip_id = 'new'").collect()
    assert [r.route_id for r in found] == ["R9"]
    held = contents(spark, processed, target)
    # All loads once more, as after a lost checkpoint.
    run_incremental(
        spark, raw, processed, str(tmp_path / "other"), target=target, interval=None
    ).awaitTermination()
    assert contents(spark, processed, target) == held
