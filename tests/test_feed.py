import logging
import os
import shutil
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pytest
from conftest import at
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from headway.operators import flatten
from headway.schemas import RAW
from headway.sources import feed
from headway.sources.feed import decode, read_payloads
from headway.sources.feed_message import feed_message_class
from headway.streaming.realtime import (
    _load_kept,
    _places,
    ingest_landed,
    run_realtime,
    slice_payloads,
)
from headway.tables import read_table

POLL = at("2026-01-02 10:30")
STAMP = int(POLL.timestamp())


def message(*entities):
    """A feed of entities, each given as a function that fills it."""
    feed = feed_message_class()()
    for n, fill in enumerate(entities):
        fill(feed.entity.add(id=f"e{n}"))
    return feed.SerializeToString()


def bare_vehicle(entity):
    entity.vehicle.timestamp = STAMP


def full_vehicle(entity):
    seen = entity.vehicle
    seen.timestamp = STAMP - 5
    seen.trip.trip_id, seen.trip.route_id = "t1", "r1"
    seen.trip.start_date, seen.trip.start_time = "20260102", "10:00:00"
    seen.trip.direction_id, seen.trip.schedule_relationship = 1, 3
    seen.vehicle.id, seen.vehicle.label = "v1", "Bus 1"
    seen.vehicle.license_plate = "ABC1"
    seen.position.latitude, seen.position.longitude = -36.8485, 174.7633
    seen.position.bearing, seen.position.odometer = 90.5, 1234.5
    seen.position.speed, seen.occupancy_status = 8.5, 5
    entity.is_deleted = True


def trip(entity, stops=2, stamp=STAMP):
    update = entity.trip_update
    update.timestamp = stamp
    update.trip.trip_id, update.trip.start_date = "t2", "20260102"
    if stops:
        first = update.stop_time_update.add(stop_sequence=1, stop_id="s1")
        first.arrival.time, first.arrival.delay = STAMP, -30
    if stops > 1:
        second = update.stop_time_update.add(
            stop_sequence=2, schedule_relationship=1
        )
        second.departure.delay, second.departure.uncertainty = 60, 120


def payload_rows(spark, *contents):
    rows = [("feed", POLL, f"p{n}", c) for n, c in enumerate(contents)]
    return spark.createDataFrame(
        rows,
        "feed_id string, poll_time timestamp, payload_id string, content binary",
    )


def test_vehicle_fields(spark):
    entities = decode(payload_rows(spark, message(full_vehicle)))
    out = flatten.vehicle_positions(entities)
    assert out.schema.names == RAW["vehicle_positions"].schema.names
    row = out.withColumn("s", F.unix_seconds("feed_timestamp")).first()
    assert row.s == STAMP - 5
    assert (row.vehicle_id, row.label, row.license_plate) == ("v1", "Bus 1", "ABC1")
    assert (row.trip_id, row.route_id, row.start_date) == ("t1", "r1", "20260102")
    assert (row.direction_id, row.schedule_relationship) == (1, 3)
    assert row.start_time == "10:00:00"
    # The feed holds single precision; the table widens it.
    assert row.latitude == -36.8484992980957
    assert (row.bearing, row.speed, row.odometer) == (90.5, 8.5, 1234.5)
    assert row.occupancy_status == 5 and row.entity_is_deleted is True


def test_unset_fields(spark):
    entities = decode(payload_rows(spark, message(bare_vehicle)))
    row = flatten.vehicle_positions(entities).first()
    assert (row.start_date, row.route_id) == ("UNKNOWN", "NA")
    assert (row.vehicle_id, row.label, row.trip_id, row.start_time) == (None,) * 4
    assert (row.latitude, row.bearing, row.direction_id) == (0.0, 0.0, 0)
    assert row.entity_is_deleted is False


def test_stop_rows(spark):
    entities = decode(
        payload_rows(
            spark, message(trip, lambda e: trip(e, stops=0), bare_vehicle)
        )
    )
    assert flatten.trip_updates(entities).count() == 2
    first, second = (
        flatten.stop_time_updates(entities).orderBy("stop_sequence").collect()
    )
    assert (first.stop_id, first.arrival_delay) == ("s1", -30)
    assert first.arrival_time is not None and first.departure_time is None
    # Unset numbers are 0, so an arrival without uncertainty is confirmed.
    assert (first.arrival_uncertainty, first.departure_delay) == (0, 0)
    assert (second.stop_id, second.stop_schedule_relationship) == (None, 1)
    assert (second.departure_delay, second.departure_uncertainty) == (60, 120)
    assert second.departure_time is None


@pytest.mark.parametrize("offset", [-901, -900, -899, 899, 900, 901, -STAMP])
def test_stale_entities(spark, offset):
    content = message(lambda e: trip(e, stamp=STAMP + offset))
    entities = decode(payload_rows(spark, content))
    kept = 1 if abs(offset) <= 900 else 0
    assert flatten.trip_updates(entities).count() == kept
    assert flatten.stop_time_updates(entities).count() == 2 * kept


def test_kinds_and_bad_payloads(spark):
    def alert_only(entity):
        entity.is_deleted = False

    def too_large(entity):
        trip(entity)
        entity.trip_update.stop_time_update[0].stop_sequence = 2**31

    contents = [
        message(full_vehicle, trip, alert_only),
        b"\xff\xff not a feed",
        message(too_large),
        b"",
    ]
    entities = decode(payload_rows(spark, *contents)).persist()
    bad = entities.where("decode_error IS NOT NULL").collect()
    assert sorted(r.payload_id for r in bad) == ["p1", "p2"]
    counts = {
        r.kind: r.entities for r in flatten.entity_counts(entities).collect()
    }
    assert counts == {"vehicle": 1, "trip_update": 1, "other": 1}


def numbered(n):
    def fill(entity):
        full_vehicle(entity)
        entity.vehicle.vehicle.id = f"v{n}"

    return message(fill)


def land_file(landing, feed, minute, content):
    """One payload file; the modification times follow the polls."""
    folder = f"{landing}/feed_id={feed}"
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/20260102T10{minute:02d}00Z.pb"
    with open(path, "wb") as file:
        file.write(content)
    os.utime(path, (1_700_000_000 + minute * 60,) * 2)


def stored(spark, raw):
    out = read_table(spark, raw, RAW["vehicle_positions"])
    return sorted((r.poll_time.minute, r.vehicle_id) for r in out.collect())


def drain(spark, landing, raw, checkpoint, **options):
    counts = []
    run_realtime(
        spark,
        landing,
        raw,
        checkpoint,
        interval=None,
        on_batch=counts.append,
        **options,
    ).awaitTermination()
    return counts


def test_poll_time_and_feed_come_from_the_name(spark, tmp_path):
    landing = str(tmp_path / "landing")
    land_file(landing, "north", 31, b"x")
    with open(f"{landing}/other.pb", "wb") as file:
        file.write(b"y")
    os.utime(f"{landing}/other.pb", (STAMP, STAMP))
    rows = read_payloads(spark, landing).select(
        "feed_id", F.unix_seconds("poll_time").alias("s")
    )
    got = {tuple(r) for r in rows.collect()}
    assert got == {("north", STAMP + 60), ("default", STAMP)}


@pytest.mark.parametrize("max_files", [1, 2, 100])
def test_repeats_are_skipped_and_the_state_survives(
    spark, tmp_path, raw, max_files
):
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    a, b = numbered(1), numbered(2)
    for minute, content in ((20, a), (21, a), (22, b)):
        land_file(landing, "f", minute, content)
    land_file(landing, "g", 22, b)
    first = drain(spark, landing, raw, state, max_files=max_files)
    assert sum(c.vehicle_positions for c in first) == 3
    # After a restart: B repeats the last payload, A is new again.
    land_file(landing, "f", 23, b)
    land_file(landing, "f", 24, a)
    again = drain(spark, landing, raw, state, max_files=max_files)
    assert [c.total for c in again if c.total] == [1]
    assert stored(spark, raw) == [(20, "v1"), (22, "v2"), (22, "v2"), (24, "v1")]
    assert drain(spark, landing, raw, state) == []


def test_stream_and_backfill_agree(spark, tmp_path, raw):
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    for minute, n in enumerate([1, 1, 2, 1, 1, 3, 3, 2], start=20):
        land_file(landing, "f", minute, numbered(n))
    drain(spark, landing, raw, state, max_files=3)
    batch = str(tmp_path / "batch")
    counts = ingest_landed(spark, landing, batch)
    assert counts.vehicle_positions == counts.total == 5
    assert stored(spark, batch) == stored(spark, raw)


def test_undecodable_payload_is_dropped_and_counts_as_the_last(
    spark, tmp_path, raw, caplog
):
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    a, bad = numbered(1), b"\xff\xff\xff"
    for minute, content in enumerate([a, bad, bad, a], start=20):
        land_file(landing, "f", minute, content)
    with caplog.at_level(logging.WARNING):
        drain(spark, landing, raw, state)
    assert stored(spark, raw) == [(20, "v1"), (23, "v1")]
    assert "1 payloads could not be decoded" in caplog.text


def test_replayed_batch_does_not_double(spark, tmp_path, raw):
    """A crash after the write, before the commit: the batch runs again."""
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    land_file(landing, "f", 20, numbered(1))
    drain(spark, landing, raw, state)
    land_file(landing, "f", 21, numbered(2))
    drain(spark, landing, raw, state)
    before = stored(spark, raw)
    commits = f"{state}/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    drain(spark, landing, raw, state)
    assert stored(spark, raw) == before == [(20, "v1"), (21, "v2")]


@pytest.mark.parametrize("max_bytes", [1 << 30, 1])
def test_packed_landing(spark, tmp_path, raw, max_bytes):
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    polls = [
        ("f", datetime(2026, 1, 2, 10, m, tzinfo=timezone.utc), numbered(n))
        for m, n in ((20, 1), (21, 1), (22, 2), (23, 1))
    ]
    # Two files, the second landed later.
    for part in (polls[:2], polls[2:]):
        spark.createDataFrame(
            part, "feed_id string, poll_time timestamp, content binary"
        ).coalesce(1).write.mode("append").parquet(landing)
    drain(spark, landing, raw, state, packed=True, max_bytes=max_bytes)
    assert stored(spark, raw) == [(20, "v1"), (22, "v2"), (23, "v1")]
    batch = str(tmp_path / "batch")
    ingest_landed(spark, landing, batch, packed=True)
    assert stored(spark, batch) == stored(spark, raw)


@pytest.mark.parametrize("packed", [True, False])
def test_names_with_signs_that_are_escaped(spark, tmp_path, raw, packed):
    landing = str(tmp_path / "with space 50% + é")
    folder = f"{landing}/part [1] {{x}}"
    if packed:
        polled = datetime(2026, 1, 2, 10, 20, tzinfo=timezone.utc)
        spark.createDataFrame(
            [("f", polled, numbered(1))],
            "feed_id string, poll_time timestamp, content binary",
        ).coalesce(1).write.parquet(f"{tmp_path}/made")
        shutil.copytree(f"{tmp_path}/made", folder)
    else:
        land_file(folder, "f", 20, numbered(1))
    drain(spark, landing, raw, str(tmp_path / "state"), packed=packed)
    assert stored(spark, raw) == [(20, "v1")]


def test_a_backfill_run_again_replaces_itself(spark, tmp_path, raw):
    landing = str(tmp_path / "landing")
    land_file(landing, "f", 20, numbered(1))
    for _ in range(2):
        ingest_landed(spark, landing, raw, load_id="backfill-1")
        assert stored(spark, raw) == [(20, "v1")]


def test_slices_are_bounded_and_repeat(spark):
    rows = [
        (POLL + timedelta(minutes=n // 7), f"p{n:03d}", 10 + 1000 * (n % 50 == 3))
        for n in range(200)
    ] + [(None, "untimed", 5)]
    kept = spark.createDataFrame(rows, "poll_time timestamp, payload_id string, n_bytes long")
    got = slice_payloads(kept, 700, 70).collect()
    assert sorted(r.payload_id for r in got) == sorted(r[1] for r in rows)
    assert got and {tuple(r) for r in got} == {
        tuple(r) for r in slice_payloads(kept.orderBy(F.rand(3)), 700, 70).collect()
    }
    sizes = {}
    for r in got:
        sizes.setdefault(r.slice, []).append(r.n_bytes)
    # At most one payload of a slice is larger than a slice by itself.
    assert all(sum(s) - max(s) <= 700 and len(s) <= 70 for s in sizes.values())
    assert len(sizes) > 3


@pytest.mark.parametrize("packed", [True, False])
def test_a_backfill_in_slices(spark, tmp_path, raw, packed):
    landing, whole = str(tmp_path / "landing"), str(tmp_path / "whole")
    ids = [1, 1, 2, 3, 3, 1, 4, 4, 5]
    if packed:
        polls = [
            ("f", datetime(2026, 1, 2, 10, 20 + m, tzinfo=timezone.utc), numbered(n))
            for m, n in enumerate(ids)
        ]
        spark.createDataFrame(
            polls, "feed_id string, poll_time timestamp, content binary"
        ).repartition(2).write.parquet(landing)
    else:
        for minute, n in enumerate(ids, start=20):
            land_file(landing, "f", minute, numbered(n))
    want = ingest_landed(spark, landing, whole, packed=packed)
    seen = []
    for _ in range(2):
        got = ingest_landed(
            spark, landing, raw, packed=packed, load_id="again", max_payloads=2,
            max_bytes=1 << 20, on_slice=seen.append,
        )
        assert got == want and want.vehicle_positions == 6
        assert stored(spark, raw) == stored(spark, whole)
    assert len(seen) == 6 and all(c.total <= 2 for c in seen)
    assert not os.listdir(f"{raw}/_staging")


def test_a_late_poll_is_kept_and_changes_no_state(spark, tmp_path, raw):
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    land_file(landing, "f", 20, numbered(1))
    land_file(landing, "f", 25, numbered(2))
    drain(spark, landing, raw, state)
    land_file(landing, "f", 22, numbered(1))  # late
    land_file(landing, "f", 26, numbered(2))  # equals the newest
    land_file(landing, "f", 27, numbered(1))
    drain(spark, landing, raw, state)
    assert stored(spark, raw) == [(20, "v1"), (22, "v1"), (25, "v2"), (27, "v1")]


def test_feeds_are_compared_by_themselves_within_a_group():
    """A, A, B, A of each feed over two micro-batches, and a late poll."""
    import pandas as pd

    from headway.streaming.skip import _keep_changed

    class State:
        exists, value = False, None

        @property
        def get(self):
            return self.value

        def update(self, value):
            self.exists, self.value = True, value

    def polls(*rows):
        made = [(f, pd.Timestamp(2024, 1, 1, 0, m), f"{m}", "file", v) for f, m, v in rows]
        names = ["feed_id", "poll_time", "payload_id", "source_file", "md5"]
        return pd.DataFrame(made, columns=names)

    def kept(state, *frames):
        (out,) = _keep_changed((0,), iter(frames), state)
        return list(zip(out["feed_id"], out["payload_id"]))

    state = State()
    first = [polls(("g", 3, "B"), ("f", 2, "A")), polls(("f", 1, "A"), ("g", 1, "A"))]
    assert kept(state, *first) == [("f", "1"), ("g", "1"), ("g", "3")]
    later = polls(("f", 4, "A"), ("g", 4, "B"), ("g", 2, "B"), ("f", 5, "B"), ("h", 1, "A"))
    assert kept(state, later) == [("f", "5"), ("g", "2"), ("h", "1")]
    feeds, md5s, newest = state.get
    assert dict(zip(feeds, md5s)) == {"f": "B", "g": "B", "h": "A"}
    assert len(newest) == 3


def test_a_payload_is_a_run_of_rows_however_they_are_batched():
    import pyarrow as pa

    from headway.adapters import _encode_sorted
    from headway.sources.feed_message import feed_message_class

    rows = [
        {
            "event_id": n, "event_type": "view", "feed_id": feed, "user": "u",
            "start_date": "20240101", "relationship": 0, "direction": 0,
            "value": 1.0, "hour": at(f"2024-01-01 {hour:02d}:00"), "stamp": 1,
        }
        for n, (feed, hour) in enumerate(
            [("a", 0)] * 5 + [("a", 1)] * 2 + [("b", 1)] * 3
        )
    ]
    for size in (1, 2, 4, 100):
        batches = [
            pa.RecordBatch.from_pylist(rows[n : n + size]) for n in range(0, len(rows), size)
        ]
        made = [r for b in _encode_sorted(iter(batches)) for r in b.to_pylist()]
        found = [
            (
                r["feed_id"],
                r["poll_time"].hour,
                len(feed_message_class().FromString(r["content"]).entity),
            )
            for r in made
        ]
        # Every event is a vehicle and a trip.
        assert found == [("a", 0, 10), ("a", 1, 4), ("b", 1, 6)]


def test_equal_payloads_are_parsed_once(monkeypatch):
    parses = []

    class Counted:
        @staticmethod
        def FromString(content):
            parses.append(content)
            return feed_message_class().FromString(content)

    state, other = message(full_vehicle, trip), message(bare_vehicle)
    contents = [state, other, b"\xff", state, b"", state, other]
    batch = pa.RecordBatch.from_pydict(
        {
            "feed_id": ["feed"] * len(contents),
            "poll_time": pa.array([POLL] * len(contents), pa.timestamp("us", tz="UTC")),
            "payload_id": [f"p{n}" for n in range(len(contents))],
            "content": pa.array(contents, pa.binary()),
        }
    )
    schema = to_arrow_schema(feed.ENTITY)
    alone = [
        row
        for n in range(len(contents))
        for found in feed._decode_batch(batch.slice(n, 1), schema)
        for row in found.to_pylist()
    ]
    monkeypatch.setattr(feed, "feed_message_class", lambda: Counted)
    together = [r for b in feed._decode_batch(batch, schema) for r in b.to_pylist()]

    def named(rows):
        return sorted(rows, key=lambda r: (r["payload_id"], r["entity_id"] or ""))

    assert named(together) == named(alone)
    assert len(together) == 3 * 2 + 2 + 1
    assert sorted(parses) == sorted([state, other, b"\xff", b""])


def test_stale_entities_are_left_out_when_decoding(spark):
    def both(entity, vehicle, trips):
        entity.vehicle.timestamp = STAMP + vehicle
        trip(entity, stamp=STAMP + trips)

    def too_large(entity):
        trip(entity, stamp=STAMP + 901)
        entity.trip_update.stop_time_update[0].stop_sequence = 2**31

    offsets = [-STAMP, -901, -900, 0, 900, 901]
    contents = [
        message(*[lambda e, o=o: trip(e, stamp=STAMP + o) for o in offsets]),
        message(*[lambda e, o=o, p=p: both(e, o, p) for o in offsets for p in offsets]),
        message(bare_vehicle, lambda e: None),
        b"\xff\xff not a feed",
        message(),
    ]
    rows = payload_rows(spark, *contents)
    later = F.col("poll_time") + F.expr("INTERVAL 1800 SECONDS")
    unknown = rows.withColumn("poll_time", F.lit(None).cast("timestamp"))
    polls = rows.unionAll(rows.withColumn("poll_time", later)).unionAll(unknown).coalesce(1)
    fresh, every = decode(polls, fresh_only=True), decode(polls)
    for flatten_one in flatten.FLATTENERS.values():
        got, want = (sorted(map(repr, flatten_one(e).collect())) for e in (fresh, every))
        assert got == want and got
    kept = fresh.where("decode_error IS NULL")
    # At the first poll 3, 27 and 1 of the three feeds; later 2, 20 and none.
    assert kept.count() == 31 + 22
    assert fresh.where("decode_error IS NOT NULL").count() == 3
    # A stale entity's other fields are not read, so they reject nothing.
    payload = payload_rows(spark, message(bare_vehicle, too_large))
    assert flatten.vehicle_positions(decode(payload, fresh_only=True)).count() == 1


def test_packed_payloads_stay_where_they_are_read(spark, tmp_path):
    rows = [("feed", POLL + timedelta(seconds=n), b"%d" % n) for n in range(4_000)]
    landing = str(tmp_path / "landing")
    packed = spark.createDataFrame(rows, feed._PACKED).repartition(2)
    packed.write.parquet(landing)
    landed = read_payloads(spark, landing, packed=True)
    kept = landed.where("CAST(CAST(content AS string) AS int) % 3 <> 0").select("payload_id", "source_file", "poll_time")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    # The names of these payloads are ten times as long.
    spark.conf.set(limit, "50000")
    places = _places(kept, True).persist()
    try:
        found = _load_kept(spark, places, True)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = sorted(bytes(r.content) for r in found.collect())
    finally:
        places.unpersist()
        spark.conf.set(limit, before)
    assert got == sorted(b"%d" % n for n in range(4_000) if n % 3)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_an_event_leaves_nothing_in_the_next():
    from headway.adapters import _event_encoder

    encode = _event_encoder()
    events = [
        (7, "view", "user", "20240101", 3, 1, 2.5, STAMP),
        (8, "", "", "", 0, 0, 0.0, 0),
    ]
    together = b"".join(encode(*event) for event in events)
    assert together == b"".join(_event_encoder()(*event) for event in events)
    entities = feed_message_class().FromString(together).entity
    assert [e.id for e in entities] == ["v7", "t7", "v8", "t8"]
    assert entities[0].vehicle.trip == entities[1].trip_update.trip
    assert entities[3].trip_update.trip.trip_id == ""
    first, second = entities[1].trip_update.stop_time_update
    assert (first.arrival.time, first.arrival.delay) == (STAMP, 1)
    assert (second.departure.time, second.departure.uncertainty) == (STAMP + 60, 120)
