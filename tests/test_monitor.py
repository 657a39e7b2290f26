"""Counts that a listener stores equal those that the ingest reports."""

from conftest import at, frame

from headway.schemas import RAW
from headway.streaming.monitor import MetricsListener, ingest_metrics, watch_raw
from headway.tables import append


def rows(n, hour):
    return [
        {"poll_time": at(f"2026-01-01 {hour:02d}:{m:02d}"), "trip_id": f"t{m}",
         "start_date": "UNKNOWN" if m % 3 else "20260101", "route_id": f"R{m % 2}"}
        for m in range(n)
    ]


def test_every_batch_is_counted_once(spark, raw, tmp_path):
    root, checkpoint = str(tmp_path / "metrics"), str(tmp_path / "checkpoint")
    assert ingest_metrics(spark, root).count() == 0
    listener = MetricsListener(spark, root)
    spark.streams.addListener(listener)
    try:
        for load, (trips, stops) in enumerate([(4, 7), (0, 5), (9, 0)]):
            for table, n in (("trip_updates", trips), ("stop_time_updates", stops)):
                if n:
                    spec = RAW[table]
                    written = append(frame(spark, spec.schema, rows(n, load)), raw, spec, f"l{load}")
                    assert written == n
            query = watch_raw(spark, raw, checkpoint, interval=None)
            query.awaitTermination()
            listener.wait(query)
        # Nothing new, and what compaction writes.
        spec = RAW["trip_updates"]
        append(frame(spark, spec.schema, rows(4, 0)), raw, spec, "merged-x")
        query = watch_raw(spark, raw, checkpoint, interval=None)
        query.awaitTermination()
        listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    found = ingest_metrics(spark, root).where("n_rows > 0").orderBy("batch_id", "table_name").collect()
    assert [(r.table_name, r.n_rows) for r in found] == [
        ("stop_time_updates", 7), ("trip_updates", 4),
        ("stop_time_updates", 5), ("trip_updates", 9),
    ]
    assert len({r.query_id for r in found}) == 1
    assert found[2].first_poll.strftime("%H:%M") == "01:00"
    assert found[3].last_poll.strftime("%H:%M") == "02:08"
