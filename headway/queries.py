"""Registered queries: each runs an operator or a job over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import adapters as A
from headway.functions import normalise as N
from headway.functions.times import retention_cutoff_col, target_date_col
from headway.operators import flatten
from headway.operators.change import consecutive_skip, first_by_value
from headway.operators.dedupe import dedupe, first_by_key, latest_state
from headway.operators.merge import merge_stop_events
from headway.operators.stale import is_fresh
from headway.operators.versions import events_with_trip, version_as_of
from headway.plans.daily import run_daily
from headway.plans.maintenance import compact_table, expire_table, run_maintenance
from headway.schemas import (
    PROCESSED,
    RAW,
    SHOWN,
    STATIC,
    TRIP_KEYS,
    VEHICLE_KEYS,
    TableSpec,
)
from headway.session import scratch_dir, ship_package, side_by_side
from headway.sources.archive import (
    FeedInfo,
    extract_lines,
    read_archives,
    stamp,
    typed,
)
from headway.sources.feed import decode
from headway.plans.static import prepare, run_static
from headway.sources.checked import read_rejects
from headway.sources.ledger import Ledger
from headway.streaming.incremental import run_incremental
from headway.streaming.layer import late_spec, run_layer
from headway.streaming.monitor import MetricsListener, ingest_metrics, watch_raw
from headway.streaming.realtime import (
    IngestCounts,
    ingest_landed,
    run_realtime,
)
from headway.streaming.skip import changed_payloads
from headway.tables import (
    append,
    partition_values,
    read_table,
    replace_dates,
    replace_version,
    table_exists,
)

Query = Callable[[SparkSession, str], DataFrame]

# The day the retention queries pretend it is.
NOW = datetime(2024, 1, 16, 12, tzinfo=timezone.utc)
KEEP_DAYS = 7


def _merge_stop_events(spark: SparkSession, sf: str) -> DataFrame:
    return merge_stop_events(A.stop_time_updates_raw(spark, sf))


def _dedupe_positions(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe(A.vehicle_positions_raw(spark, sf), VEHICLE_KEYS)


def _latest_trip_state(spark: SparkSession, sf: str) -> DataFrame:
    return latest_state(A.trip_updates_raw(spark, sf), TRIP_KEYS)


def _dedupe_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    lines = A.table(spark, sf, "lineitem")
    return first_by_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def _stale_filter(spark: SparkSession, sf: str) -> DataFrame:
    events = A.table(spark, sf, "events")
    poll = F.col("ts").cast("timestamp")
    hour = F.unix_seconds(F.date_trunc("hour", poll))
    return events.where(is_fresh(poll, hour)).select("event_id", "ts")


def _consecutive_skip(spark: SparkSession, sf: str) -> DataFrame:
    events = A.table(spark, sf, "events")
    return consecutive_skip(
        events.select("user_id", "ts", "event_id", "event_type"),
        "user_id",
        ["ts", "event_id"],
        "event_type",
        F.date_trunc("minute", F.col("ts")),
    )


# Parts in which the streams' inputs are landed, each drained by itself.
LANDINGS = 4


def _land_in_order(
    rows: DataFrame, time: str, folder: str, drain: Callable[[], object]
) -> None:
    """Land rows in parts by their time, and drain after each part."""
    bounds = rows.agg(
        F.min(F.unix_micros(time)).alias("low"),
        F.max(F.unix_micros(time)).alias("high"),
    ).first()
    low, width = bounds["low"] or 0, (bounds["high"] or 0) - (bounds["low"] or 0) + 1
    part = F.floor((F.unix_micros(time) - low) * LANDINGS / width)
    placed = rows.withColumn("_part", part.cast("int"))
    for n in range(LANDINGS):
        placed.where(F.col("_part") == n).drop("_part").write.mode(
            "append"
        ).parquet(folder)
        drain()


def _stream_skip(spark: SparkSession, sf: str) -> DataFrame:
    """The same rule on a stream over several micro-batches, one state a user."""
    scratch = scratch_dir(spark, "stream-skip")
    rows = A.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("feed_id"),
        F.col("ts").cast("timestamp").alias("poll_time"),
        F.format_string("%020d", "event_id").alias("payload_id"),
        F.encode("event_type", "utf-8").alias("content"),
    )

    def drain() -> None:
        stream = (
            spark.readStream.schema(rows.schema)
            .parquet(f"{scratch}/landing")
            .withColumn("source_file", F.lit(""))
        )
        changed_payloads(stream).writeStream.option(
            "checkpointLocation", f"{scratch}/checkpoint"
        ).outputMode("append").format("parquet").trigger(availableNow=True).start(
            f"{scratch}/kept"
        ).awaitTermination()

    _land_in_order(rows, "poll_time", f"{scratch}/landing", drain)
    return spark.read.parquet(f"{scratch}/kept").select(
        F.col("feed_id").cast("bigint").alias("user_id"),
        F.col("payload_id").cast("bigint").alias("event_id"),
    )


def _normalise_defaults(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    text = F.when(kind != "error", kind).otherwise("")
    number = F.pmod("event_id", F.lit(3)).cast("int")
    return A.table(spark, sf, "events").select(
        "event_id",
        N.blank_to_null(text).alias("label"),
        N.or_default(text, N.UNKNOWN_DATE).alias("start_date"),
        N.or_default(text, N.NO_ROUTE).alias("route_id"),
        N.zero_to_null(number).alias("event_time"),
        N.or_zero(N.zero_to_null(number)).alias("delay"),
    )


def _flatten_vehicles(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.vehicle_positions(A.event_entities(spark, sf))


def _flatten_trips(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.trip_updates(A.event_entities(spark, sf))


def _explode_nested(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.stop_time_updates(A.vector_entities(spark, sf))


def _entity_counts(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.entity_counts(A.event_entities(spark, sf))


def _target_date(spark: SparkSession, sf: str) -> DataFrame:
    return A.table(spark, sf, "events").select(
        "event_id",
        target_date_col(F.col("ts")).alias("target_date"),
        retention_cutoff_col(F.col("ts"), KEEP_DAYS).alias("cutoff"),
    )


def _content_hash(spark: SparkSession, sf: str) -> DataFrame:
    texts = A.table(spark, sf, "documents")
    hashed = texts.select("doc_id", F.md5("text").alias("content_hash"))
    return first_by_value(hashed, "content_hash", "doc_id")


def _json_state(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties read from JSON and written back."""
    state = F.from_json("props", "k int")
    return A.table(spark, sf, "events").select(
        "event_id",
        state["k"].alias("k"),
        F.to_json(F.struct(state["k"].alias("k"), "user_id")).alias("state"),
    )


def _land_positions(spark: SparkSession, sf: str, root: str, waves: int) -> None:
    """All events as positions, in several writes of about equal size."""
    rows = A.vehicle_positions_raw(spark, sf)
    wave = F.pmod(F.hash("label"), F.lit(waves))
    rows = rows.withColumn("_wave", wave)
    for n in range(waves):
        append(rows.where(F.col("_wave") == n), root, RAW["vehicle_positions"])


def _land_all(spark: SparkSession, sf: str, root: str, stops: DataFrame) -> None:
    """All three raw tables, each in two writes."""

    def land(table: str, rows: DataFrame, key: str) -> Callable[[], None]:
        placed = rows.withColumn("_wave", F.pmod(F.hash(key), F.lit(2)))

        def run() -> None:
            for n in range(2):
                wave = placed.where(F.col("_wave") == n).drop("_wave")
                append(wave, root, RAW[table])

        return run

    side_by_side(
        spark,
        [
            land("vehicle_positions", A.vehicle_positions_raw(spark, sf), "label"),
            land("trip_updates", A.trip_updates_raw(spark, sf), "label"),
            land("stop_time_updates", stops, "trip_id"),
        ],
    )


def _partition_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Two columns of the errors of every date, from the stored table."""
    root = scratch_dir(spark, "scan")
    _land_positions(spark, sf, root, 1)
    return (
        read_table(spark, root, RAW["vehicle_positions"])
        .where(F.col("route_id") == "error")
        .select("vehicle_id", "latitude")
    )


def _replace_date(spark: SparkSession, sf: str) -> DataFrame:
    """Every date replaced by its purchases, but for the first of the month."""
    root = scratch_dir(spark, "replace-date")
    spec = PROCESSED["vehicle_positions"]
    rows = A.vehicle_positions_raw(spark, sf)
    days = _days(rows)
    replace_dates(rows, root, spec, days)
    later = rows.where(
        (F.col("start_date") != "20240101") & (F.col("route_id") == "purchase")
    )
    replace_dates(later, root, spec, days)
    return read_table(spark, root, spec)


def _days(rows: DataFrame) -> list[str]:
    """The dates that occur: as many as the calendar has."""
    return [r[0] for r in rows.select("start_date").distinct().collect()]


def _replace_version(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions with one start, then one of them republished."""
    root = scratch_dir(spark, "replace-version")
    spec = STATIC["agency"]
    rows = A.customer_agencies(spark, sf)
    renamed = rows.withColumn("agency_name", F.upper("agency_name")).where(
        F.col("agency_lang") != "BUILDING"
    )
    ranges = [
        (rows, "20240101", "20240630"),
        (rows, "20240101", "20241231"),
        (renamed, "20240101", "20240630"),
    ]
    for contents, start, end in ranges:
        stamped = stamp(contents, spec, FeedInfo(start, end, ""), 0)
        replace_version(typed(stamped, spec), root, spec, start, end)
    return read_table(spark, root, spec)


def _retention(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "retention")
    _land_positions(spark, sf, root, 1)
    expire_table(spark, root, "vehicle_positions", NOW, KEEP_DAYS)
    return read_table(spark, root, RAW["vehicle_positions"])


def _compaction(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "compaction")
    _land_positions(spark, sf, root, 2)
    compact_table(spark, root, "vehicle_positions")
    return read_table(spark, root, RAW["vehicle_positions"])


def _maintenance_job(spark: SparkSession, sf: str) -> DataFrame:
    """What compaction and retention leave of all raw tables."""
    root = scratch_dir(spark, "maintenance")
    stops = A.stop_time_updates_raw(spark, sf)
    day = F.concat(F.lit("202401"), F.date_format("poll_time", "dd"))
    _land_all(spark, sf, root, stops.withColumn("start_date", day))
    run_maintenance(spark, root, NOW, KEEP_DAYS)
    return _in_one(spark, root, RAW.values())


def _in_one(
    spark: SparkSession, root: str, specs: Iterable[TableSpec]
) -> DataFrame:
    """The tables of a layer under the columns that any of them has."""
    parts = []
    for spec in specs:
        has = set(spec.schema.names)
        cols = [
            (F.col(n) if n in has else F.lit(None)).cast(kind).alias(n)
            for n, kind in SHOWN.items()
        ]
        rows = read_table(spark, root, spec)
        parts.append(rows.select(F.lit(spec.name).alias("table_name"), *cols))
    return reduce(DataFrame.unionAll, parts)


def _daily_job(spark: SparkSession, sf: str) -> DataFrame:
    """All raw dates processed: the rows of the three tables."""
    raw = scratch_dir(spark, "raw")
    processed = scratch_dir(spark, "processed")
    _land_all(spark, sf, raw, A.stop_time_updates_raw(spark, sf))
    days = {d for s in RAW.values() for d in partition_values(spark, raw, s)}
    run_daily(spark, raw, processed, NOW, days)
    return _in_one(spark, processed, PROCESSED.values())


def _land_out_of_order(
    spark: SparkSession,
    sf: str,
    raw: str,
    drain: Callable[[], object],
    wanted: Iterable[str] = RAW,
) -> None:
    """Land raw tables in parts by poll time, and drain after each part.

    Every tenth row, by its number, comes one part later than its time says.
    """
    positions = A.vehicle_positions_raw(spark, sf)
    tables = {
        "vehicle_positions": (positions, "label"),
        "trip_updates": (A.trip_updates_raw(spark, sf), "label"),
        "stop_time_updates": (A.january_stops(spark, sf), "trip_id"),
    }
    polled = F.unix_micros("poll_time")
    bounds = positions.agg(
        F.min(polled).alias("low"), F.max(polled).alias("high")
    ).first()
    low, width = bounds["low"] or 0, (bounds["high"] or 0) - (bounds["low"] or 0) + 1
    placed = {}
    for table in wanted:
        rows, number = tables[table]
        part = F.floor((polled - low) * LANDINGS / width).cast("int")
        late = (F.col(number).cast("bigint") % 10 == 0).cast("int")
        landing = F.least(F.greatest(part, F.lit(0)) + late, F.lit(LANDINGS - 1))
        placed[table] = rows.withColumn("_part", landing)
    for n in range(LANDINGS):
        side_by_side(
            spark,
            [
                partial(
                    append,
                    rows.where(F.col("_part") == n).drop("_part"),
                    raw,
                    RAW[table],
                    f"landing-{n}",
                )
                for table, rows in placed.items()
            ],
        )
        drain()


def _continuous_layer(spark: SparkSession, sf: str) -> DataFrame:
    """The processed tables of all dates that close, and the rows that were late.

    Late rows are followed, so the tables equal those of the daily job.
    """
    raw, processed = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    checkpoint = scratch_dir(spark, "checkpoint")

    def drain() -> None:
        run_layer(
            spark, raw, processed, checkpoint, follow_late=True, zone="UTC", interval=None
        ).awaitTermination()

    _land_out_of_order(spark, sf, raw, drain)
    late = [late_spec(table) for table in RAW]
    shown = [*PROCESSED.values(), *late]
    return _in_one(spark, processed, [s for s in shown if table_exists(spark, processed, s)])


def _incremental_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Stop events, merged with every landing into the folders that it touches."""
    raw, processed = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    checkpoint = scratch_dir(spark, "checkpoint")

    def drain() -> None:
        run_incremental(
            spark, raw, processed, checkpoint, interval=None
        ).awaitTermination()

    _land_out_of_order(spark, sf, raw, drain, ["stop_time_updates"])
    return read_table(spark, processed, PROCESSED["stop_time_events"])


def _observed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the listener stored of every landing: rows and polls of each table."""
    raw, metrics = scratch_dir(spark, "raw"), scratch_dir(spark, "metrics")
    checkpoint = scratch_dir(spark, "checkpoint")
    listener = MetricsListener(spark, metrics)
    spark.streams.addListener(listener)

    def drain() -> None:
        query = watch_raw(spark, raw, checkpoint, interval=None)
        query.awaitTermination()
        listener.wait(query)

    try:
        _land_out_of_order(spark, sf, raw, drain)
    finally:
        spark.streams.removeListener(listener)
    return ingest_metrics(spark, metrics).where("n_rows > 0").drop("query_id")


def _csv_static_load(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines through zip archives into the typed stop_times table."""
    spec = STATIC["stop_times"]
    lines = extract_lines(A.stop_times_archives(spark, sf), [spec.member])
    info = FeedInfo("20240101", "20240630", "1")
    return prepare(lines, spec, info, 0)


# Archives in the order they land: (name, mark, validity within their year, file
# with a bad header). The second corrects the first, the third repeats the
# second, and one file of the last cannot be loaded.
STATIC_ARCHIVES = (
    ("a", "A", "0101", "0630", None),
    ("b", "B", "0101", "0630", None),
    ("c", "B", "0101", "0630", None),
    ("d", "D", "0701", "1231", "routes"),
)


def _static_job(spark: SparkSession, sf: str) -> DataFrame:
    """All static tables and the ledger after two runs over four archives."""
    landing, root = scratch_dir(spark, "archives"), scratch_dir(spark, "static")
    for name, mark, start, end, broken in STATIC_ARCHIVES:
        A.land_static_archives(spark, sf, landing, name, mark, start, end, broken)
    for _ in range(2):
        run_static(spark, landing, root)
    parts = []
    for spec in STATIC.values():
        cells = [
            F.coalesce(F.col(n).cast("string"), F.lit(""))
            for n in spec.data_schema.names
        ]
        parts.append(
            read_table(spark, root, spec).select(
                F.lit(spec.name).alias("table_name"),
                "valid_from",
                "valid_to",
                F.concat_ws("|", *cells).alias("contents"),
            )
        )
    seen = Ledger(spark, root).read()
    name = F.substring_index("archive", "/", -1)
    parts.append(
        seen.select(
            F.lit("load_ledger").alias("table_name"),
            "valid_from",
            "valid_to",
            F.concat_ws("|", name, "feed_version", "status").alias("contents"),
        )
    )
    parts.append(_downloads(spark, landing, root))
    return reduce(DataFrame.unionAll, parts)


def _static_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Cells that their columns cannot hold, after two runs over the archives."""
    landing, root = scratch_dir(spark, "archives"), scratch_dir(spark, "static")
    A.land_static_archives(
        spark, sf, landing, "q", "Q", "0101", "0630", spoiled=A.STATIC_SPOILED
    )
    for _ in range(2):
        run_static(spark, landing, root)
    name = F.substring_index("archive", "/", -1)
    return read_rejects(spark, root).select(
        name.alias("archive"), "member", "line_no", "column_name", "text", "reason"
    )


def _downloads(spark: SparkSession, landing: str, root: str) -> DataFrame:
    """Whether each version says when its archive was downloaded.

    That is the second in which an archive with its mark and year landed.
    """
    name = F.substring_index("archive", "/", -1)
    landed = read_archives(spark, landing).select(
        F.upper(F.substring(F.regexp_replace(name, "^c", "b"), 1, 1)).alias("mark"),
        F.regexp_extract(name, r"(\d{4})\.zip", 1).alias("year"),
        F.date_trunc("second", "modified").alias("at"),
    )
    version = read_table(spark, root, STATIC["feed_info"]).select(
        F.col("feed_version").alias("mark"),
        F.substring("valid_from", 1, 4).alias("year"),
        "valid_from",
        "valid_to",
        "downloaded_at",
    ).distinct()
    return (
        version.join(landed, ["mark", "year"])
        .groupBy("valid_from", "valid_to")
        .agg(F.max(F.col("at") == F.col("downloaded_at")).alias("same"))
        .select(
            F.lit("downloaded_at").alias("table_name"),
            "valid_from",
            "valid_to",
            F.col("same").cast("string").alias("contents"),
        )
    )


def _feed_decode(spark: SparkSession, sf: str) -> DataFrame:
    payloads = A.event_payloads(spark, sf)
    entities = decode(payloads.withColumn("payload_id", F.lit("")))
    return flatten.vehicle_positions(entities).select(
        "poll_time",
        "feed_timestamp",
        "vehicle_id",
        "label",
        "license_plate",
        "route_id",
        "direction_id",
        "schedule_relationship",
        "start_date",
        "start_time",
        "latitude",
        "longitude",
        "bearing",
        "entity_is_deleted",
    )


def _raw_in_one(spark: SparkSession, root: str) -> DataFrame:
    """The three raw tables as (table, trip, stop, times)."""
    parts = []
    for spec in RAW.values():
        has_stop = "stop_id" in spec.schema.names
        label = F.lit(None).cast("string")
        parts.append(
            read_table(spark, root, spec).select(
                F.lit(spec.name).alias("table_name"),
                "poll_time",
                "feed_timestamp",
                "trip_id",
                "route_id",
                "start_date",
                (label if has_stop else F.col("label")).alias("label"),
                (F.col("stop_id") if has_stop else label).alias("stop_id"),
                (
                    F.col("arrival_time")
                    if has_stop
                    else F.lit(None).cast("timestamp")
                ).alias("arrival_time"),
            )
        )
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def _stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Repeating payloads streamed, in time order, into the three raw tables."""
    root = scratch_dir(spark, "stream")
    once = A.feed_payloads(spark, sf, "hour")
    once.write.parquet(f"{root}/made")

    def drain() -> None:
        run_realtime(
            spark,
            f"{root}/landing",
            f"{root}/raw",
            f"{root}/checkpoint",
            packed=True,
            interval=None,
        ).awaitTermination()

    payloads = A.repeated(spark.read.schema(once.schema).parquet(f"{root}/made"))
    _land_in_order(payloads, "poll_time", f"{root}/landing", drain)
    return _raw_in_one(spark, f"{root}/raw")


def _batch_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The same payloads as one backfill in slices, run twice under one load id.

    A slice takes a fifth of the payloads, so there are four or so of those
    that are kept.
    """
    root = scratch_dir(spark, "batch")
    A.repeated_payloads(spark, sf, "hour").write.parquet(f"{root}/landing")
    landed = spark.read.parquet(f"{root}/landing").count()
    for _ in range(2):
        ingest_landed(
            spark,
            f"{root}/landing",
            f"{root}/raw",
            packed=True,
            load_id="backfill",
            max_payloads=landed // 5 + 1,
        )
    return _raw_in_one(spark, f"{root}/raw")


def _ingest_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that a stream over one file a payload reports for each table."""
    root = scratch_dir(spark, "files")
    A.land_files(A.repeated_payloads(spark, sf, "day"), f"{root}/landing")
    counts: list[IngestCounts] = []
    run_realtime(
        spark,
        f"{root}/landing",
        f"{root}/raw",
        f"{root}/checkpoint",
        interval=None,
        on_batch=counts.append,
    ).awaitTermination()
    rows = [(t, sum(getattr(c, t) for c in counts)) for t in RAW]
    return spark.createDataFrame(rows, "table_name string, n_rows long")


def _version_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the customer version in force when they were placed."""
    facts = A.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("agency_id"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("start_date"),
    )
    rows = A.customer_agencies(spark, sf).select("agency_id", "agency_name")

    def version(start: str, end: str) -> DataFrame:
        return rows.select(
            "agency_id",
            F.concat_ws("/", "agency_name", F.lit(start)).alias("agency_name"),
            F.lit(start).alias("valid_from"),
            F.lit(end).alias("valid_to"),
        )

    versions = version("19950101", "19971231").unionAll(
        version("19970701", "20001231")
    )
    return version_as_of(facts, versions, ["agency_id"])


def _events_with_trip(spark: SparkSession, sf: str) -> DataFrame:
    events = merge_stop_events(A.stop_time_updates_raw(spark, sf))
    trips = latest_state(A.order_trips(spark, sf), TRIP_KEYS)
    return events_with_trip(events, trips)


_QUERIES: dict[str, Query] = {
    "merge_stop_events": _merge_stop_events,
    "dedupe_positions": _dedupe_positions,
    "latest_trip_state": _latest_trip_state,
    "dedupe_lineitem": _dedupe_lineitem,
    "stale_filter": _stale_filter,
    "consecutive_skip": _consecutive_skip,
    "stream_skip": _stream_skip,
    "normalise_defaults": _normalise_defaults,
    "flatten_vehicles": _flatten_vehicles,
    "flatten_trips": _flatten_trips,
    "explode_nested": _explode_nested,
    "entity_counts": _entity_counts,
    "target_date": _target_date,
    "content_hash": _content_hash,
    "json_state": _json_state,
    "partition_scan": _partition_scan,
    "replace_date": _replace_date,
    "replace_version": _replace_version,
    "retention": _retention,
    "compaction": _compaction,
    "maintenance_job": _maintenance_job,
    "daily_job": _daily_job,
    "csv_static_load": _csv_static_load,
    "static_job": _static_job,
    "static_rejects": _static_rejects,
    "feed_decode": _feed_decode,
    "stream_ingest": _stream_ingest,
    "batch_ingest": _batch_ingest,
    "ingest_counts": _ingest_counts,
    "continuous_layer": _continuous_layer,
    "incremental_merge": _incremental_merge,
    "observed_counts": _observed_counts,
    "version_as_of": _version_as_of,
    "events_with_trip": _events_with_trip,
}


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        return A.plain_times(query(spark, sf_dir))

    return run


def registered() -> dict[str, Query]:
    return {name: _in_utc(query) for name, query in _QUERIES.items()}
