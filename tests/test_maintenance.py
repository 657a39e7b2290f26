import logging

import pytest
from conftest import at, frame, land
from test_daily import vehicle

from headway.plans.maintenance import (
    compact_table,
    expire_table,
    run_maintenance,
)
from headway.schemas import RAW
from headway.store import Store
from headway.swap import STAGING, new_staging, recover
from headway.tables import append, partition_values, read_table

TABLE = "vehicle_positions"
SPEC = RAW[TABLE]


def files(spark, root):
    return len(spark.read.parquet(f"{root}/{TABLE}").inputFiles())


def rows(spark, root):
    return sorted(map(str, read_table(spark, root, SPEC).collect()))


def test_compacts_files(spark, raw):
    land(spark, raw, TABLE, [vehicle("vehicle_A") for _ in range(4)])
    before = rows(spark, raw)
    assert files(spark, raw) == 2
    assert compact_table(spark, raw, TABLE) == 2
    assert files(spark, raw) == 1
    assert rows(spark, raw) == before
    assert Store(spark, raw).child_dirs(f"{raw}/{TABLE}/{STAGING}") == []


def test_missing_table_is_skipped(spark, raw, caplog):
    with caplog.at_level(logging.INFO):
        assert compact_table(spark, raw, TABLE) == 0
        assert expire_table(spark, raw, TABLE, at("2026-01-02 12:00")) == 0
    assert caplog.text.count(f"no {TABLE} yet") == 2


def test_rows_are_preserved_over_routes_and_dates(spark, raw):
    data = [
        vehicle(f"v{n}", route_id=f"r{n % 3}", start_date=f"2026010{1 + n % 2}")
        for n in range(30)
    ]
    land(spark, raw, TABLE, data, writes=3)
    before = rows(spark, raw)
    compact_table(spark, raw, TABLE)
    assert rows(spark, raw) == before
    assert files(spark, raw) == 6


def test_nothing_new_nothing_done(spark, raw):
    land(spark, raw, TABLE, [vehicle("vehicle_A") for _ in range(4)])
    compact_table(spark, raw, TABLE)
    assert compact_table(spark, raw, TABLE) == 0
    # A single new write of one file is compact as it is ...
    land(spark, raw, TABLE, [vehicle("vehicle_B")], writes=1)
    assert compact_table(spark, raw, TABLE) == 0
    # ... and results whose files have the wanted size are left alone.
    land(spark, raw, TABLE, [vehicle("vehicle_C")] * 2, writes=1)
    assert compact_table(spark, raw, TABLE, target_bytes=1) == 2


def test_a_single_write_of_many_files_is_compacted(spark, raw):
    data = frame(spark, SPEC.schema, [vehicle("vehicle_A")] * 8)
    spread = data.repartition(4).selectExpr("*", "'load-x' AS load_id")
    spread.write.partitionBy(*SPEC.partition_by).parquet(f"{raw}/{TABLE}")
    assert files(spark, raw) == 4
    compact_table(spark, raw, TABLE)
    assert files(spark, raw) == 1


def test_last_micro_batch_is_left_for_a_replay(spark, raw):
    for n in range(3):
        data = frame(spark, SPEC.schema, [vehicle(f"v{n}")])
        append(data, raw, SPEC, load_id=f"poll-q-{n:012d}")
    before = rows(spark, raw)
    assert compact_table(spark, raw, TABLE) == 2
    append(
        frame(spark, SPEC.schema, [vehicle("v2")]), raw, SPEC, "poll-q-000000000002"
    )
    assert rows(spark, raw) == before


def failing_rename(monkeypatch, at):
    """Make the rename number ``at`` fail, counting from 1."""
    rename, seen = Store.rename, []

    def fail(self, source, target):
        seen.append(target)
        if len(seen) == at:
            raise OSError("injected")
        rename(self, source, target)

    monkeypatch.setattr(Store, "rename", fail)


@pytest.mark.parametrize("at_rename", [1, 2, 3, 4, 5, 6, 7])
def test_interrupted_swap_loses_nothing(spark, raw, monkeypatch, at_rename):
    days = ["20260101", "20260102"]
    data = [vehicle(f"v{n}", start_date=days[n % 2]) for n in range(8)]
    land(spark, raw, TABLE, [d for i in (0, 1) for d in data[i::2]])
    for n in (0, 1):
        append(frame(spark, SPEC.schema, [data[n]]), raw, SPEC)
    before = rows(spark, raw)
    with monkeypatch.context() as patch:
        failing_rename(patch, at_rename)
        with pytest.raises(OSError):
            compact_table(spark, raw, TABLE)
    store = Store(spark, raw)
    recover(store, f"{raw}/{TABLE}", abandoned_seconds=0)
    assert rows(spark, raw) == before
    assert store.child_dirs(f"{raw}/{TABLE}/{STAGING}") == []


def test_output_of_a_running_job_is_left_alone(spark, raw):
    land(spark, raw, TABLE, [vehicle("vehicle_A")])
    path, store = f"{raw}/{TABLE}", Store(spark, raw)
    staged = new_staging(path)
    store.make_dir(staged)
    recover(store, path)
    assert len(store.child_dirs(f"{path}/{STAGING}")) == 1
    recover(store, path, abandoned_seconds=0)
    assert store.child_dirs(f"{path}/{STAGING}") == []


def test_results_are_merged_with_their_own_size_only(spark, raw):
    """An hour's writes do not rewrite the day so far."""
    first = [vehicle(f"v{n}", trip_id=f"t{n * 7919}") for n in range(4000)]
    land(spark, raw, TABLE, first)
    compact_table(spark, raw, TABLE)
    folder = f"{raw}/{TABLE}/start_date=20260101"
    large = set(Store(spark, raw).child_dirs(folder))
    before = rows(spark, raw)
    for _ in range(2):
        land(spark, raw, TABLE, [vehicle("w"), vehicle("x")])
        assert compact_table(spark, raw, TABLE) == 2
    assert large < set(Store(spark, raw).child_dirs(folder))
    # The third small result is merged with the two before it.
    land(spark, raw, TABLE, [vehicle("w"), vehicle("x")])
    assert compact_table(spark, raw, TABLE) == 4
    assert large < set(Store(spark, raw).child_dirs(folder))
    assert len(rows(spark, raw)) == len(before) + 6


def test_deletes_old_dates(spark, raw):
    days = ["20260101", "20260103", "20260105", "20260110", "UNKNOWN"]
    land(spark, raw, TABLE, [vehicle("v", start_date=d) for d in days])
    # Seven days before the tenth: the third is kept, it is the cutoff.
    assert expire_table(spark, raw, TABLE, at("2026-01-10 12:00"), 7) == 1
    assert partition_values(spark, raw, SPEC) == days[1:]


def test_keeps_recent_dates(spark, raw):
    land(spark, raw, TABLE, [vehicle("v", start_date="20260109")])
    assert expire_table(spark, raw, TABLE, at("2026-01-10 12:00"), 7) == 0
    assert read_table(spark, raw, SPEC).count() == 1


def test_all_tables(spark, raw):
    land(spark, raw, TABLE, [vehicle("vehicle_A") for _ in range(4)])
    done = run_maintenance(spark, raw, at("2026-01-02 12:00"))
    assert done == {
        "vehicle_positions": (2, 0),
        "trip_updates": (0, 0),
        "stop_time_updates": (0, 0),
    }
    assert files(spark, raw) == 1
