"""The driver's tables under transit column names.

Pure projections: they let the real operators run on the test data. Event
times become observations, order lines become stop updates.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Mapping
from contextlib import ExitStack
from functools import reduce
from types import MappingProxyType

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.schemas import RAW, STATIC, conform
from headway.sources.feed import ENTITY
from headway.sources.feed_message import feed_message_class


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as zone-less UTC, as the source tables hold them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.date_trunc("second", F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "value",
        second.cast("timestamp").alias("second"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp").alias("hour"),
        F.date_format("ts", "yyyyMMdd").alias("start_date"),
        F.date_format("ts", "HH:mm:ss").alias("start_time"),
        F.col("user_id").cast("string").alias("user"),
        F.when(F.col("event_type") == "error", 3)
        .otherwise(0)
        .alias("relationship"),
        F.pmod("user_id", F.lit(2)).cast("int").alias("direction"),
    )


def vehicle_positions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as positions: a user's vehicle, stamped by the hour."""
    rows = _events(spark, sf_dir).select(
        F.col("second").alias("poll_time"),
        F.col("hour").alias("feed_timestamp"),
        F.col("user").alias("vehicle_id"),
        F.col("event_id").cast("string").alias("label"),
        _null("string").alias("license_plate"),
        F.col("user").alias("trip_id"),
        F.col("event_type").alias("route_id"),
        F.col("direction").alias("direction_id"),
        F.col("relationship").alias("schedule_relationship"),
        "start_date",
        "start_time",
        F.col("value").alias("latitude"),
        (-F.col("value")).alias("longitude"),
        F.lit(0.0).alias("bearing"),
        F.lit(0.0).alias("speed"),
        F.col("value").alias("odometer"),
        F.lit(0).alias("occupancy_status"),
        F.lit(False).alias("entity_is_deleted"),
    )
    return conform(rows, RAW["vehicle_positions"].schema)


def trip_updates_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as states of a user's trip of the day."""
    rows = _events(spark, sf_dir).select(
        F.col("second").alias("poll_time"),
        F.col("second").alias("feed_timestamp"),
        F.col("user").alias("trip_id"),
        F.col("event_type").alias("route_id"),
        F.col("direction").alias("direction_id"),
        F.col("relationship").alias("schedule_relationship"),
        "start_date",
        "start_time",
        F.col("user").alias("vehicle_id"),
        F.col("event_id").cast("string").alias("label"),
        _null("string").alias("license_plate"),
        F.lit(False).alias("entity_is_deleted"),
    )
    return conform(rows, RAW["trip_updates"].schema)


def stop_time_updates_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as stop updates; their flags decide what is confirmed."""
    shipped = F.col("l_shipdate").cast("timestamp")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    line = F.col("l_linenumber").cast("string")
    rows = table(spark, sf_dir, "lineitem").select(
        shipped.alias("poll_time"),
        shipped.alias("feed_timestamp"),
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.date_format("l_shipdate", "yyyy0101").alias("start_date"),
        F.concat(F.lit("R"), F.pmod("l_suppkey", F.lit(20))).alias("route_id"),
        F.col("l_linenumber").alias("stop_sequence"),
        F.concat(F.lit("S"), line).alias("stop_id"),
        F.lit(0).alias("stop_schedule_relationship"),
        F.col("l_quantity").cast("int").alias("arrival_delay"),
        F.when(flag != "R", shipped).alias("arrival_time"),
        F.when(flag == "N", 120).otherwise(0).alias("arrival_uncertainty"),
        (F.col("l_quantity").cast("int") - 25).alias("departure_delay"),
        (shipped + F.expr("INTERVAL 1 MINUTE")).alias("departure_time"),
        F.when(status == "O", 120).otherwise(0).alias("departure_uncertainty"),
    )
    return conform(rows, RAW["stop_time_updates"].schema)


def january_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as stop updates of January 2024, polled within their date."""
    rows = stop_time_updates_raw(spark, sf_dir)
    day = F.concat(F.lit("202401"), F.date_format("poll_time", "dd"))
    order = F.col("trip_id").cast("bigint") * 7919
    second = (order + F.col("stop_sequence") * 613) % 86400
    midnight = F.unix_seconds(F.to_timestamp(day, "yyyyMMdd"))
    return rows.withColumns(
        {
            "start_date": day,
            "poll_time": F.timestamp_seconds(midnight + second),
            "route_id": F.concat(F.lit("J"), F.col("stop_sequence") % 2),
        }
    )


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trip states."""
    placed = F.col("o_orderdate").cast("timestamp")
    rows = table(spark, sf_dir, "orders").select(
        placed.alias("poll_time"),
        placed.alias("feed_timestamp"),
        F.col("o_orderkey").cast("string").alias("trip_id"),
        F.lit("NA").alias("route_id"),
        F.lit(0).alias("direction_id"),
        F.when(F.col("o_orderstatus") == "F", 3)
        .otherwise(0)
        .alias("schedule_relationship"),
        F.date_format("o_orderdate", "yyyy0101").alias("start_date"),
        _null("string").alias("start_time"),
        F.col("o_custkey").cast("string").alias("vehicle_id"),
        F.col("o_orderpriority").alias("label"),
        _null("string").alias("license_plate"),
        F.lit(False).alias("entity_is_deleted"),
    )
    return conform(rows, RAW["trip_updates"].schema)


def _as_entities(rows: DataFrame, **cols: Column) -> DataFrame:
    """Rows in the entity schema; what is not given is NULL."""
    return rows.select(
        *[
            cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ENTITY.fields
        ]
    )


def event_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as decoded entities, with unset fields where a feed has them.

    Errors are trip updates, the others vehicles; sign-ups have no date, views
    no route; odd users carry no label.
    """
    e = _events(spark, sf_dir)
    kind = F.col("event_type")
    trip = F.struct(
        F.col("user").alias("trip_id"),
        F.lit("").alias("start_time"),
        F.when(kind == "signup", "").otherwise(F.col("start_date")).alias("d"),
        F.col("relationship"),
        F.when(kind == "view", "").otherwise(kind).alias("route_id"),
        F.col("direction"),
    )
    vehicle = F.struct(
        F.col("user").alias("id"),
        F.when(F.col("direction") == 1, "")
        .otherwise(F.col("event_id").cast("string"))
        .alias("label"),
        F.lit("").alias("license_plate"),
    )
    position = F.struct(
        F.col("value").alias("latitude"),
        F.col("value").alias("longitude"),
        F.lit(0).alias("bearing"),
        F.col("value").alias("odometer"),
        F.lit(0).alias("speed"),
    )
    stamp = F.unix_seconds("second")
    seen = F.struct(trip, position, stamp, vehicle, F.lit(0))
    stops = F.array().cast(ENTITY["trip_update"].dataType["stop_time_update"].dataType)
    update = F.struct(trip, stops, vehicle, stamp)
    return _as_entities(
        e,
        feed_id=kind,
        poll_time=F.col("hour"),
        payload_id=F.col("event_id").cast("string"),
        entity_id=F.col("event_id").cast("string"),
        is_deleted=F.lit(False),
        vehicle=F.when(kind != "error", seen),
        trip_update=F.when(kind == "error", update),
    )


def vector_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as trips with one stop per component."""
    base = F.lit(1_700_000_000).cast("bigint")
    nothing = F.struct(F.lit(0), F.lit(0), F.lit(0))
    stops = F.transform(
        "embedding",
        lambda x, i: F.struct(
            i + 1,
            F.struct(
                F.round(x * 1000).cast("int"),
                F.when(x > 0, base + i).otherwise(0),
                F.lit(0),
            ),
            nothing,
            F.concat(F.lit("S"), i.cast("string")),
            F.lit(0),
        ),
    )
    trip = F.struct(
        F.col("vec_id").cast("string"),
        F.lit(""),
        F.lit("20231114"),
        F.lit(0),
        F.concat(F.lit("R"), F.col("label").cast("string")),
        F.lit(0),
    )
    unnamed = F.struct(F.lit(""), F.lit(""), F.lit(""))
    return _as_entities(
        table(spark, sf_dir, "embeddings"),
        feed_id=F.lit("vectors"),
        poll_time=F.timestamp_seconds(base),
        payload_id=F.col("vec_id").cast("string"),
        entity_id=F.col("vec_id").cast("string"),
        is_deleted=F.lit(False),
        trip_update=F.struct(trip, stops, unnamed, base),
    )


def _spread(df: DataFrame) -> DataFrame:
    """Give the Python steps every core when the input is a single file."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


_PACKED = "feed_id string, poll_time timestamp, content binary"
_PACKED_ARROW = pa.schema(
    [
        ("feed_id", pa.string()),
        ("poll_time", pa.timestamp("us", tz="UTC")),
        ("content", pa.binary()),
    ]
)


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events encoded as feed payloads, polled on the hour.

    Every event is a vehicle and a trip with two stops: an arrival, and a
    predicted departure. Payloads gather the events that one Arrow batch holds
    for a feed and an hour, so what they decode to does not depend on batches.
    """
    rows = _events(spark, sf_dir).select(
        "event_id",
        "event_type",
        "user",
        "start_date",
        "relationship",
        "direction",
        "value",
        "hour",
        F.unix_seconds("second").alias("stamp"),
    )
    return _spread(rows).mapInArrow(_encode, _PACKED)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    entities = _event_encoder()
    for batch in batches:
        feeds: dict[tuple, list[bytes]] = {}
        hours, kinds = (batch.column(n).to_pylist() for n in ("hour", "event_type"))
        for feed, hour, *event in zip(kinds, hours, *_event_columns(batch)):
            feeds.setdefault((feed, hour), []).append(entities(*event))
        out = [
            {"feed_id": feed, "poll_time": hour, "content": b"".join(parts)}
            for (feed, hour), parts in feeds.items()
        ]
        yield pa.RecordBatch.from_pylist(out, schema=_PACKED_ARROW)


# Minutes after a poll at which it is repeated, answered without entities, and
# repeated again: A, A, nothing, A.
REPEATS = (0, 10, 20, 30)
_NO_ENTITIES = 20
# A message with one field that no reader knows. (Spark leaves out files
# without any bytes.)
_EMPTY_MESSAGE = b"\xf8\x7f\x01"


# Ids of events that one feed reports.
FEED_EVENTS = 20_000
_PAYLOADS_PER_BATCH = 100


def repeated_payloads(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    """The payloads of feeds as they are polled: A, A, B, A, ten minutes apart.

    The second is to be skipped; B has no entities.
    """
    return repeated(feed_payloads(spark, sf_dir, unit))


def repeated(once: DataFrame) -> DataFrame:
    """Payloads polled four times; see ``repeated_payloads``."""
    minutes = F.explode(F.array(*[F.lit(m) for m in REPEATS])).alias("minutes")
    return once.select("*", minutes).select(
        "feed_id",
        F.timestamp_seconds(
            F.unix_seconds("poll_time") + 60 * F.col("minutes")
        ).alias("poll_time"),
        F.when(F.col("minutes") == _NO_ENTITIES, F.lit(_EMPTY_MESSAGE))
        .otherwise(F.col("content"))
        .alias("content"),
    )


def feed_payloads(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    """Events encoded as one payload for each feed and hour or day.

    A feed is the events of a type whose ids are in one range, so a payload is
    bounded however busy its type is. A day's payload is polled at noon.
    """
    polled = F.col("hour")
    if unit == "day":
        polled = F.date_trunc("day", "hour") + F.expr("INTERVAL 12 HOURS")
    part = F.floor(F.col("event_id") / FEED_EVENTS).cast("string")
    rows = _events(spark, sf_dir).select(
        "event_id",
        "event_type",
        F.concat_ws("-", "event_type", part).alias("feed_id"),
        "user",
        "start_date",
        "relationship",
        "direction",
        "value",
        polled.alias("hour"),
        F.unix_seconds("second").alias("stamp"),
    )
    # There are as many payloads as feeds and hours, of few events each: they are
    # told apart as the sorted rows come, without a call for each.
    payload = ["feed_id", "hour"]
    return (
        rows.repartition(*payload)
        .sortWithinPartitions(*payload, "event_id")
        .mapInArrow(_encode_sorted, _PACKED)
    )


def _encode_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A payload for each run of rows with one feed and hour."""
    entities = _event_encoder()
    key, parts, polled, out = None, [], None, []

    def payload() -> dict:
        return {"feed_id": key[0], "poll_time": polled, "content": b"".join(parts)}

    for batch in batches:
        # Times become Python's once a payload, not once a row.
        hours = _cells(batch.column("hour").cast(pa.int64()))
        feeds = _cells(batch.column("feed_id"))
        rows = zip(feeds, hours, *_event_columns(batch))
        for n, (feed, hour, *event) in enumerate(rows):
            if (feed, hour) != key:
                if parts:
                    out.append(payload())
                if len(out) >= _PAYLOADS_PER_BATCH:
                    yield pa.RecordBatch.from_pylist(out, schema=_PACKED_ARROW)
                    out = []
                key, parts = (feed, hour), []
                polled = batch.column("hour")[n].as_py()
            parts.append(entities(*event))
    if parts:
        out.append(payload())
        yield pa.RecordBatch.from_pylist(out, schema=_PACKED_ARROW)


def land_files(payloads: DataFrame, landing: str) -> None:
    """Write each payload to a file of its own, from where it is."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        address = landing if "://" in landing else landing.removeprefix("file:")
        fs, base = pa.fs.FileSystem.from_uri(address)
        for batch in batches:
            for row in batch.to_pylist():
                folder = f"{base}/feed_id={row['feed_id']}"
                fs.create_dir(folder)
                name = row["poll_time"].strftime("%Y%m%dT%H%M%SZ")
                with fs.open_output_stream(f"{folder}/{name}.pb") as file:
                    file.write(row["content"])
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    payloads.mapInArrow(write, "n long").agg(F.sum("n")).collect()


# What an event's entities are made of, in the order their encoder takes it.
_EVENT = (
    "event_id",
    "event_type",
    "user",
    "start_date",
    "relationship",
    "direction",
    "value",
    "stamp",
)


def _event_columns(batch: pa.RecordBatch) -> list[list]:
    return [_cells(batch.column(name)) for name in _EVENT]


def _cells(column: pa.Array) -> list:
    """Its values as Python's, by numpy where no NULL is lost by it."""
    if column.null_count:
        return column.to_pylist()
    return column.to_numpy(zero_copy_only=False).tolist()


def _event_encoder() -> Callable[..., bytes]:
    """Encodes an event as a vehicle and a trip with two stops.

    The messages are made once and every field is set anew for each event, as
    making them takes several times as long. A feed's bytes are those of its
    entities in a row, so those of several events may be joined.
    """
    message = feed_message_class()()
    first, second = message.entity.add(), message.entity.add()
    seen, update = first.vehicle, second.trip_update
    trips = seen.trip, update.trip
    vehicle, position = seen.vehicle, seen.position
    named = vehicle, update.vehicle
    arrival = update.stop_time_update.add(stop_sequence=1, stop_id="first").arrival
    leaving = update.stop_time_update.add(stop_sequence=2, stop_id="second").departure
    leaving.uncertainty = 120

    def encode(event_id, kind, user, start_date, relationship, direction, value, stamp):
        event = str(event_id)
        first.id, second.id = f"v{event}", f"t{event}"
        for trip in trips:
            trip.trip_id = user
            trip.start_date = start_date
            trip.route_id = kind
            trip.direction_id = direction
            trip.schedule_relationship = relationship
        for one in named:
            one.label = event
        vehicle.id = user
        position.latitude, position.longitude = value, -value
        seen.timestamp = update.timestamp = arrival.time = stamp
        arrival.delay = direction
        leaving.time = stamp + 60
        return message.SerializeToString(deterministic=True)

    return encode


def stop_times_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as stop_times files in zip archives, one per Arrow batch.

    Clock times run past 24:00, ids keep leading zeros, text holds commas and
    quotes, and some numbers are empty.
    """
    part = F.col("l_partkey")
    quantity = F.col("l_quantity").cast("int")
    line = F.col("l_linenumber")
    cols = {
        "trip_id": F.lpad(F.col("l_orderkey").cast("string"), 10, "0"),
        "arrival_time": F.format_string("%02d:10:00", 20 + line),
        "departure_time": F.format_string("%02d:11:00", 20 + line),
        "stop_id": part.cast("string"),
        "stop_sequence": line.cast("string"),
        "stop_headsign": F.concat(
            F.col("l_returnflag"), F.lit(', "'), F.col("l_linestatus"), F.lit('"')
        ),
        "pickup_type": F.when(quantity > 25, quantity.cast("string")),
        "drop_off_type": F.lit("0"),
        "shape_dist_traveled": F.col("l_discount").cast("string"),
        "timepoint": F.lit("1"),
    }
    names = STATIC["stop_times"].data_schema.names
    quoted = [
        F.concat(
            F.lit('"'),
            F.replace(F.coalesce(cols[n], F.lit("")), F.lit('"'), F.lit('""')),
            F.lit('"'),
        )
        for n in names
    ]
    text = _spread(table(spark, sf_dir, "lineitem")).select(
        F.concat_ws(",", *quoted).alias("line")
    )
    header = ",".join(names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
                lines = [header, *batch.column(0).to_pylist()]
                archive.writestr("stop_times.txt", "\n".join(lines) + "\n")
            yield pa.RecordBatch.from_pydict(
                {"archive": ["orders.zip"], "content": [held.getvalue()]}
            )

    return text.mapInArrow(pack, "archive string, content binary")


def customer_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under the columns of the agency table, unversioned."""
    names = STATIC["agency"].data_schema.names
    given = {
        "agency_id": F.col("c_custkey").cast("string"),
        "agency_name": F.col("c_name"),
        "agency_lang": F.col("c_mktsegment"),
    }
    return table(spark, sf_dir, "customer").select(
        *[given.get(n, _null("string")).alias(n) for n in names]
    )


# The thirteen static files: source table, and columns as expressions that
# Spark and other engines read alike. ``{mark}`` tells archives apart; columns
# that are not named stay empty.
STATIC_FROM: dict[str, tuple[str, dict[str, str]]] = {
    "agency": (
        "customer",
        {
            "agency_id": "c_custkey",
            "agency_name": "concat(c_name, ', {mark}')",
            "agency_lang": "c_mktsegment",
        },
    ),
    "stops": (
        "supplier",
        {
            "stop_id": "concat('00', s_suppkey)",
            "stop_name": "concat(s_name, ' \"{mark}\"')",
            "stop_lat": "s_acctbal",
            "location_type": "s_nationkey",
        },
    ),
    "routes": (
        "part",
        {
            "route_id": "p_partkey",
            "route_long_name": "concat(p_name, '{mark}')",
            "route_type": "p_size",
        },
    ),
    "trips": (
        "orders",
        {
            "route_id": "o_custkey",
            "service_id": "o_orderstatus",
            "trip_id": "o_orderkey",
            "trip_headsign": "concat(o_orderpriority, '{mark}')",
        },
    ),
    "stop_times": (
        "lineitem",
        {
            "trip_id": "l_orderkey",
            "arrival_time": "concat(20 + l_linenumber, ':10:00')",
            "stop_id": "l_suppkey",
            "stop_sequence": "l_linenumber",
            "stop_headsign": "concat(l_returnflag, '{mark}')",
            "shape_dist_traveled": "l_discount",
        },
    ),
    "calendar": (
        "nation",
        {"service_id": "n_name", "monday": "n_nationkey", "sunday": "'{mark}'"},
    ),
    "calendar_dates": (
        "nation",
        {"service_id": "n_name", "date": "'{mark}'", "exception_type": "n_regionkey"},
    ),
    "shapes": (
        "lineitem",
        {
            "shape_id": "concat(l_orderkey, '{mark}')",
            "shape_pt_lat": "l_tax",
            "shape_pt_lon": "l_quantity",
            "shape_pt_sequence": "l_linenumber",
        },
    ),
    "fare_attributes": (
        "part",
        {"fare_id": "concat(p_partkey, '{mark}')", "price": "p_retailprice"},
    ),
    "fare_rules": ("nation", {"fare_id": "n_name", "route_id": "'{mark}'"}),
    "frequencies": (
        "orders",
        {
            "trip_id": "concat(o_orderkey, '{mark}')",
            "start_time": "'25:00:00'",
            "headway_secs": "o_custkey",
        },
    ),
    "transfers": (
        "supplier",
        {
            "from_stop_id": "s_suppkey",
            "to_stop_id": "'{mark}'",
            "transfer_type": "s_nationkey",
        },
    ),
    "feed_info": (
        "region",
        {
            "feed_publisher_name": "r_name",
            "feed_start_date": "{start}",
            "feed_end_date": "{end}",
            "feed_version": "'{mark}'",
        },
    ),
}


# Columns of static files as expressions that give cells they cannot hold.
STATIC_SPOILED = {
    ("stops", "location_type"): (
        "concat(s_nationkey, CASE WHEN s_nationkey % 5 = 1 THEN '.5' ELSE '' END)"
    ),
    ("fare_attributes", "price"): (
        "CASE WHEN p_size % 10 = 1 THEN 'free' ELSE CAST(p_retailprice AS STRING) END"
    ),
    ("frequencies", "headway_secs"): (
        "concat(o_custkey, CASE WHEN o_custkey % 7 = 0 THEN ' s' ELSE '' END)"
    ),
    ("frequencies", "exact_times"): (
        "CASE WHEN o_custkey % 21 = 0 THEN 'no' WHEN o_custkey % 2 = 0 THEN 'n/a' "
        "ELSE '1' END"
    ),
}


# The key of each source table, and how many keys an archive takes: the rows of
# larger tables are spread over several, each with a validity of its own.
STATIC_KEYS = {
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "nation": "n_nationkey",
    "region": "r_regionkey",
}
ARCHIVE_KEYS = 1_000_000

# Characters by which the lines of a file are dealt, and lines of a text.
_HEAD, _TEXT_LINES = 4, 1_000
# Printed characters that can be digits of a number, the first of them, and how
# many characters behind the first of a line are sorted by before whole lines.
_DIGITS, _FIRST_DIGIT, _SORTED = 90, 33, 6
_TEXTS = "year int, member string, head string, place int, text string"
_TEXTS_ARROW = pa.schema(
    [
        ("year", pa.int32()),
        ("member", pa.string()),
        ("head", pa.string()),
        ("place", pa.int32()),
        ("text", pa.string()),
    ]
)


def year_of(source: str) -> str:
    """The year of validity of the archive that a row falls in."""
    return f"2024 + CAST(floor({STATIC_KEYS[source]} / {ARCHIVE_KEYS}.0) AS INT)"


def static_expressions(name: str, mark: str, start: str, end: str) -> dict[str, str]:
    """All columns of a static file as expressions over its source table.

    ``start`` and ``end`` are expressions of the validity.
    """
    _, given = STATIC_FROM[name]
    return {
        column: given.get(column, "NULL").format(mark=mark, start=start, end=end)
        for column in STATIC[name].data_schema.names
    }


def static_line(cells: Mapping[str, str]) -> str:
    """The expression of a line of CSV text, all cells quoted."""
    quoted = [
        f"concat('\"', replace(coalesce(CAST({e} AS STRING), ''), '\"', '\"\"'), '\"')"
        for e in cells.values()
    ]
    return f"concat_ws(',', {', '.join(quoted)})"


def land_static_archives(
    spark: SparkSession,
    sf_dir: str,
    landing: str,
    name: str,
    mark: str,
    start: str,
    end: str,
    broken: str | None = None,
    spoiled: Mapping[tuple[str, str], str] = MappingProxyType({}),
) -> None:
    """Write archives of all thirteen files, one file with a bad header.

    ``spoiled`` gives other expressions for some (table, column).

    Archive ``<name>-<year>.zip`` has the rows of a range of keys, and is valid
    from ``start`` to ``end`` (MMdd) of its year. Many tasks sort the lines of an
    archive, dealt by their first characters, and join them to texts; one writes
    the texts in order, so no file is held whole. Equal arguments give equal bytes.
    """
    validity = {
        "start": f"concat(CAST(year AS STRING), '{start}')",
        "end": f"concat(CAST(year AS STRING), '{end}')",
    }
    sources = {
        source: table(spark, sf_dir, source).withColumn("year", F.expr(year_of(source)))
        for source in STATIC_KEYS
    }
    last = reduce(
        DataFrame.unionAll, [rows.select("year") for rows in sources.values()]
    ).agg(F.max("year")).first()[0]
    years = F.explode(F.sequence(F.lit(2024), F.lit(last or 2024)))
    # Every archive has a validity, also that of a range with few tables.
    sources["region"] = table(spark, sf_dir, "region").withColumn("year", years)
    headers = {s.member: ",".join(s.data_schema.names) for s in STATIC.values()}
    if broken:
        headers[STATIC[broken].member] += ",extra"
    parts = [
        spark.createDataFrame(sorted(headers.items()), "member string, line string")
        .withColumn("year", years)
        .select("year", "member", F.lit("").alias("head"), "line")
    ]
    for file, (source, _) in STATIC_FROM.items():
        given = static_expressions(file, mark, **validity)
        given |= {column: e for (f, column), e in spoiled.items() if f == file}
        rows = sources[source].select(
            "year",
            F.lit(STATIC[file].member).alias("member"),
            F.expr(static_line(given)).alias("line"),
        )
        # In the order of lines. All cells are quoted, so it is never empty.
        head = F.substring("line", 1, _HEAD).alias("head")
        parts.append(rows.select("year", "member", head, "line"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        address = landing if "://" in landing else landing.removeprefix("file:")
        fs, base = pa.fs.FileSystem.from_uri(address)
        fs.create_dir(base)
        open_year, open_member = None, None
        with ExitStack() as archives, ExitStack() as members:
            zipped = file = None
            for batch in batches:
                for year, member, text in zip(
                    *[batch.column(n).to_pylist() for n in ("year", "member", "text")]
                ):
                    if (year, member) != (open_year, open_member):
                        members.close()
                        if year != open_year:
                            archives.close()
                            out = fs.open_output_stream(f"{base}/{name}-{year}.zip")
                            archives.enter_context(out)
                            zipped = archives.enter_context(
                                zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                            )
                        info = zipfile.ZipInfo(member)
                        info.compress_type = zipfile.ZIP_DEFLATED
                        info._compresslevel = 1
                        # Its size is not known before it is written.
                        opened = zipped.open(info, "w", force_zip64=True)
                        file = members.enter_context(opened)
                        open_year, open_member = year, member
                    file.write(text.encode())
                yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    order = ["year", "member", "head"]
    names = ", ".join(f"'{name}'" for name in sorted(headers))
    code = _file_code(f"array_position(array({names}), member) - 1", last)
    start_of = F.when(F.col("head") != "", F.substring("line", 2, _SORTED)).otherwise("")
    texts = (
        reduce(DataFrame.unionAll, parts)
        .repartition(*order)
        .withColumn("first", F.concat(code, start_of))
        # As by year, member, head and line, but most lines differ in the few
        # bytes of the first column that Spark compares at once.
        .sortWithinPartitions("first", "year", "member", "line")
        .select(*order, "line")
        .mapInArrow(_joined_lines, _TEXTS)
    )
    (
        _dealt(texts, last)
        .sortWithinPartitions(*order, "place")
        .mapInArrow(write, "n long")
        .agg(F.sum("n"))
        .collect()
    )


def _file_code(number: str, last: int | None) -> Column:
    """The place of a file among those of all years, as text of equal length.

    ``number`` is the expression of its place among those of a year.
    """
    files = len(STATIC_FROM)
    place = f"((year - 2024) * {files} + {number})"
    digits = 1
    while _DIGITS**digits < files * max(1, (last or 2024) - 2023):
        digits += 1
    return F.concat(
        *[
            F.expr(f"chr({_FIRST_DIGIT} + pmod(floor({place} / {_DIGITS**n}), {_DIGITS}))")
            for n in reversed(range(digits))
        ]
    )


def _dealt(texts: DataFrame, last: int | None) -> DataFrame:
    """A task an archive: by hash, some tasks would write several in turn."""
    return texts.repartitionById(max(1, (last or 2024) - 2023), F.col("year") - 2024)


def _joined_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted lines (year, member, head, line) as texts of at most ``_TEXT_LINES``.

    A text has the lines of one head; its place is its number among theirs.
    """
    key, place, held, count = None, 0, [], 0

    def text() -> pa.RecordBatch:
        lines = pa.concat_arrays(held)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(lines)], lines), "\n")
        row = [*key, place, f"{joined[0].as_py()}\n"]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(row, _TEXTS_ARROW)], schema=_TEXTS_ARROW
        )

    for batch in batches:
        keys = [batch.column(n) for n in ("year", "member", "head")]
        new = reduce(
            pc.or_, [pc.not_equal(k.slice(1), k.slice(0, len(k) - 1)) for k in keys]
        )
        starts = [0, *(n + 1 for n in pc.indices_nonzero(new).to_pylist())]
        for at, end in zip(starts, [*starts[1:], batch.num_rows]):
            found = tuple(k[at].as_py() for k in keys)
            if found != key:
                if held:
                    yield text()
                key, place, held, count = found, 0, [], 0
            while at < end:
                if count == _TEXT_LINES:
                    yield text()
                    place, held, count = place + 1, [], 0
                take = min(end - at, _TEXT_LINES - count)
                held.append(batch.column("line").slice(at, take))
                at, count = at + take, count + take
    if held:
        yield text()
