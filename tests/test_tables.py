import pytest
from conftest import at, frame
from test_daily import vehicle
from test_maintenance import failing_rename

from headway.schemas import PROCESSED, RAW, STATIC
from headway.store import Store
from headway.swap import recover
from headway.tables import (
    append,
    read_table,
    register_views,
    replace_dates,
    replace_version,
    table_info,
)

DAYS = PROCESSED["vehicle_positions"]


def load(spark, rows):
    return frame(spark, DAYS.schema, rows)


def routes(spark, root):
    out = read_table(spark, root, DAYS).select("start_date", "route_id")
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_replaced_date_loses_routes_it_no_longer_has(spark, processed, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        first = [
            vehicle("a", route_id="101"),
            vehicle("b", route_id="102"),
            vehicle("c", route_id="101", start_date="20260102"),
        ]
        replace_dates(
            load(spark, first), processed, DAYS, ["20260101", "20260102"]
        )
        again = [vehicle("d", route_id="103")]
        assert (
            replace_dates(load(spark, again), processed, DAYS, ["20260101"])
            == 1
        )
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert routes(spark, processed) == [
        ("20260101", "103"),
        ("20260102", "101"),
    ]


def test_rows_of_other_dates_are_refused(spark, processed):
    replace_dates(load(spark, [vehicle("a")]), processed, DAYS, ["20260101"])
    before = routes(spark, processed)
    other = load(spark, [vehicle("a", start_date="20260105")])
    with pytest.raises(ValueError, match="20260105"):
        replace_dates(other, processed, DAYS, ["20260101"])
    assert routes(spark, processed) == before


def test_failed_write_leaves_old_rows(spark, processed):
    rows = load(spark, [vehicle("a")])
    replace_dates(rows, processed, DAYS, ["20260101"])
    broken = rows.selectExpr(
        *[c for c in rows.columns if c != "label"],
        "raise_error('broken') AS label",
    ).select(rows.columns)
    with pytest.raises(Exception, match="broken"):
        replace_dates(broken, processed, DAYS, ["20260101"])
    assert len(routes(spark, processed)) == 1


@pytest.mark.parametrize("at_rename", [1, 2, 3, 4, 5])
def test_interrupted_replacement_loses_no_date(
    spark, processed, monkeypatch, at_rename
):
    """Renames: the plan, then for each date the old one and the new one."""
    days = ["20260101", "20260102"]

    def put(label):
        data = [vehicle(label, start_date=d) for d in days]
        return replace_dates(load(spark, data), processed, DAYS, days)

    def stored():
        rows = read_table(spark, processed, DAYS).collect()
        return sorted((r.start_date, r.vehicle_id) for r in rows)

    put("old")
    with monkeypatch.context() as patch:
        failing_rename(patch, at_rename)
        with pytest.raises(OSError):
            put("new")
    path = f"{processed}/{DAYS.name}"
    recover(Store(spark, path), path, abandoned_seconds=0)
    want = "old" if at_rename == 1 else "new"
    assert stored() == [(d, want) for d in days]
    put("newest")
    assert stored() == [(d, "newest") for d in days]


@pytest.mark.parametrize("at_rename", [1, 2, 3])
def test_interrupted_version_is_recovered(spark, tmp_path, monkeypatch, at_rename):
    root, spec = str(tmp_path / "static"), STATIC["calendar_dates"]

    def put(service):
        rows = frame(spark, spec.schema, [{"service_id": service}])
        replace_version(rows, root, spec, "20260101", "20260630")

    put("old")
    with monkeypatch.context() as patch:
        failing_rename(patch, at_rename)
        with pytest.raises(OSError):
            put("new")
    path = f"{root}/{spec.name}"
    recover(Store(spark, path), path, abandoned_seconds=0)
    want = "old" if at_rename == 1 else "new"
    rows = read_table(spark, root, spec).collect()
    assert [r.service_id for r in rows] == [want]


def test_partition_values_stay_text(spark, raw):
    spec = RAW["vehicle_positions"]
    odd = ["0042", "NA", "a/b c", "x=y"]
    data = [vehicle("v", route_id=r) for r in odd]
    append(frame(spark, spec.schema, data), raw, spec)
    out = read_table(spark, raw, spec)
    assert out.schema["start_date"].dataType.simpleString() == "string"
    assert {r.route_id for r in out.collect()} == set(odd)
    assert out.columns == spec.schema.names
    one = read_table(spark, raw, spec, ["20260101"])
    assert one.count() == 4
    assert read_table(spark, raw, spec, ["20990101"]).count() == 0


def test_date_filter_prunes_folders_and_columns(spark, raw):
    spec = RAW["vehicle_positions"]
    append(frame(spark, spec.schema, [vehicle("v")]), raw, spec)
    out = (
        read_table(spark, raw, spec)
        .where("start_date = '20260101'")
        .select("vehicle_id", "latitude")
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(start_date" in plan
    assert "ReadSchema: struct<vehicle_id:string,latitude:double>" in plan


def test_repeated_load_replaces_itself(spark, raw):
    spec = RAW["vehicle_positions"]
    data = frame(spark, spec.schema, [vehicle("a"), vehicle("b")])
    for load_id in ("poll-q-1", "poll-q-2", "poll-q-2"):
        assert append(data, raw, spec, load_id) == 2
    assert read_table(spark, raw, spec).count() == 4
    append(data, raw, spec)
    append(data, raw, spec)
    assert read_table(spark, raw, spec).count() == 8


def test_empty_append_makes_the_table(spark, raw):
    spec = RAW["trip_updates"]
    nothing = spark.createDataFrame([], spec.schema)
    assert append(nothing, raw, spec) == 0
    assert read_table(spark, raw, spec).count() == 0


def test_versions(spark, tmp_path):
    root, spec = str(tmp_path / "static"), STATIC["calendar_dates"]

    def put(service, start, end):
        rows = [{"service_id": s, "date": "20260101"} for s in service]
        return replace_version(
            frame(spark, spec.schema, rows), root, spec, start, end
        )

    assert put(["a", "b"], "20260101", "20260630") == 2
    put(["c"], "20260101", "20261231")
    put(["d"], "20260101", "20260630")
    out = read_table(spark, root, spec).collect()
    assert sorted((r.service_id, r.valid_to) for r in out) == [
        ("c", "20261231"),
        ("d", "20260630"),
    ]
    assert put([], "20260101", "20260630") == 0
    assert [r.service_id for r in read_table(spark, root, spec).collect()] == ["c"]


def test_seconds_survive_storage(spark, raw):
    spec = RAW["vehicle_positions"]
    append(frame(spark, spec.schema, [vehicle("v")]), raw, spec)
    row = read_table(spark, raw, spec).selectExpr(
        "unix_seconds(feed_timestamp) AS s"
    )
    assert row.first().s == int(at("2026-01-02 10:25").timestamp())


def test_views_for_sql(spark, raw):
    spec = RAW["vehicle_positions"]
    append(frame(spark, spec.schema, [vehicle("a"), vehicle("b")]), raw, spec)
    assert register_views(spark, raw, RAW.values(), "raw_") == [
        "raw_vehicle_positions"
    ]
    query = "SELECT vehicle_id FROM raw_vehicle_positions WHERE route_id = 'route_2'"
    assert [r.vehicle_id for r in spark.sql(query).collect()] == ["a", "b"]


def test_table_info_is_kept_beside_the_data(spark, raw, tmp_path):
    spec = RAW["vehicle_positions"]
    append(frame(spark, spec.schema, [vehicle("a")]), raw, spec)
    assert table_info(spark, raw, spec) == {
        "entity": "vehicle_positions",
        "version": "1",
        "partition_columns": ["start_date", "load_id", "route_id"],
    }
    assert spark.read.parquet(f"{raw}/vehicle_positions").count() == 1
