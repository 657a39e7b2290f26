"""Landed realtime payloads, and their decoding into entities.

A payload row is (feed_id, poll_time, payload_id, source_file, content).
Payloads land either one per file, ``feed_id=<feed>/<yyyyMMddTHHmmssZ>.pb``,
or packed many to a Parquet file with (feed_id, poll_time, content), which
spares a large deployment millions of small files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain, compress
from operator import attrgetter, methodcaller
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from headway.operators.stale import STALE_MINUTES
from headway.sources.feed_message import feed_message_class

PAYLOAD_COLUMNS = (
    "feed_id",
    "poll_time",
    "payload_id",
    "source_file",
    "content",
)
DEFAULT_FEED = "default"

# Column schemas of the two landing layouts, as streams must be given them.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_PACKED = "feed_id string, poll_time timestamp, content binary"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_STR, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_FLOAT, _DOUBLE = T.FloatType(), T.DoubleType()

TRIP = _struct(
    trip_id=_STR,
    start_time=_STR,
    start_date=_STR,
    schedule_relationship=_INT,
    route_id=_STR,
    direction_id=_INT,
)
VEHICLE = _struct(id=_STR, label=_STR, license_plate=_STR)
POSITION = _struct(
    latitude=_FLOAT,
    longitude=_FLOAT,
    bearing=_FLOAT,
    odometer=_DOUBLE,
    speed=_FLOAT,
)
STOP_EVENT = _struct(delay=_INT, time=_LONG, uncertainty=_INT)
STOP_UPDATE = _struct(
    stop_sequence=_INT,
    arrival=STOP_EVENT,
    departure=STOP_EVENT,
    stop_id=_STR,
    schedule_relationship=_INT,
)
ENTITY = _struct(
    feed_id=_STR,
    poll_time=T.TimestampType(),
    payload_id=_STR,
    entity_id=_STR,
    is_deleted=T.BooleanType(),
    vehicle=_struct(
        trip=TRIP,
        position=POSITION,
        timestamp=_LONG,
        vehicle=VEHICLE,
        occupancy_status=_INT,
    ),
    trip_update=_struct(
        trip=TRIP,
        stop_time_update=T.ArrayType(STOP_UPDATE),
        vehicle=VEHICLE,
        timestamp=_LONG,
    ),
    decode_error=_STR,
)

_MAX_LONG = 2**63 - 1
_ENTITIES_PER_BATCH = 5_000


def payloads(landed: DataFrame, packed: bool) -> DataFrame:
    """Payload rows from either landing layout, batch or stream.

    A packed payload is named by its place in its file; a file by its path.
    The poll time of a file is in its name, else its modification time.
    """
    if packed:
        place = F.concat_ws(
            "#", "_metadata.file_path", "_metadata.row_index"
        )
        return landed.select(
            F.coalesce("feed_id", F.lit(DEFAULT_FEED)).alias("feed_id"),
            "poll_time",
            place.alias("payload_id"),
            F.col("_metadata.file_path").alias("source_file"),
            F.coalesce("content", F.lit(b"")).alias("content"),
        )
    feed = F.regexp_extract("path", r"/feed_id=([^/]+)/", 1)
    stamp = F.regexp_extract("path", r"/(\d{8}T\d{6})Z[^/]*$", 1)
    polled = F.try_to_timestamp(
        F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd'T'HHmmss")
    )
    return landed.select(
        F.coalesce(F.nullif(feed, F.lit("")), F.lit(DEFAULT_FEED)).alias(
            "feed_id"
        ),
        F.coalesce(polled, F.col("modificationTime")).alias("poll_time"),
        F.col("path").alias("payload_id"),
        F.col("path").alias("source_file"),
        "content",
    )


def plain_path(name: str, encoded: bool) -> str:
    """A file's name as a reader takes it.

    The metadata of a file holds its address with URL escapes. Characters
    that a reader would take for a pattern are escaped its own way.
    """
    path = unquote(name) if encoded else name
    return re.sub(r"[\\\[\]{}*?]", lambda m: "\\" + m[0], path)


def read_payloads(
    spark: SparkSession, paths: str | Sequence[str], packed: bool = False
) -> DataFrame:
    """Payload rows of landed files or folders."""
    if packed:
        landed = spark.read.schema(_PACKED).parquet(*_listed(paths))
    else:
        landed = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(_listed(paths))
        )
    return payloads(landed, packed)


def stream_payloads(
    spark: SparkSession,
    landing: str,
    packed: bool = False,
    max_files: int = 1_000,
    max_bytes: int = 1 << 30,
) -> DataFrame:
    """The same rows as a stream with bounded micro-batches.

    Single payloads are bounded by their number, packed files by their size,
    as one such file may hold any number of payloads.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if packed:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
        landed = reader.schema(_PACKED).parquet(landing)
    else:
        reader = reader.option("maxFilesPerTrigger", max_files)
        landed = reader.schema(_FILES).format("binaryFile").load(landing)
    return payloads(landed, packed)


def _listed(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def decode(payload_rows: DataFrame, fresh_only: bool = False) -> DataFrame:
    """Payload rows to entity rows (``ENTITY``).

    A payload that does not parse yields one row with ``decode_error`` and is
    otherwise lost, as it is when polled: it is not tried again. With
    ``fresh_only`` an entity of which neither part is fresh is left out, as the
    raw tables take nothing of it, before any other field of it is read.
    """
    arrow_schema = to_arrow_schema(ENTITY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _decode_batch(batch, arrow_schema, fresh_only)

    return payload_rows.select(
        "feed_id", "poll_time", "payload_id", "content"
    ).mapInArrow(run, ENTITY)


def _decode_batch(
    batch: pa.RecordBatch, schema: pa.Schema, fresh_only: bool = False
) -> Iterator[pa.RecordBatch]:
    """Entities of a batch of payloads, a bounded number at a time.

    Payloads of the same bytes, as of a feed that returns to an earlier state,
    are parsed once, and share one list of entities.
    """
    message_class = feed_message_class()
    held: list[tuple[int, list]] = []
    parsed: dict[bytes, list] = {}
    clocks: dict[bytes, list] = {}
    waiting = 0
    polls = _seconds(batch.column("poll_time")) if fresh_only else None
    for row, content in enumerate(batch.column("content")):
        content = content.as_py()
        found = parsed.get(content)
        if found is None:
            try:
                found = list(message_class.FromString(content).entity)
            except Exception as error:  # noqa: BLE001 - any bad payload is data
                yield _failed(batch, row, error, schema)
                continue
            parsed[content] = found
            if fresh_only:
                clocks[content] = list(map(_clocks, found))
        waiting += len(found)
        if fresh_only:
            found = _fresh(found, clocks[content], polls[row])
        if found:
            held.append((row, found))
        if waiting >= _ENTITIES_PER_BATCH:
            yield from _build(batch, held, schema)
            held, parsed, clocks, waiting = [], {}, {}, 0
    if held:
        yield from _build(batch, held, schema)


# The clocks of an entity's parts; 0 for one that it lacks, far from any poll.
_clocks = attrgetter("vehicle.timestamp", "trip_update.timestamp")


def _seconds(times: pa.Array) -> list[int | None]:
    micros = times.cast(pa.timestamp("us", "UTC")).cast(pa.int64()).to_pylist()
    return [None if m is None else m // 1_000_000 for m in micros]


def _fresh(found: list, clocks: list, poll: int | None) -> list:
    """Entities with a part that ``is_fresh`` keeps; none of an unknown time."""
    if poll is None:
        return []
    low, high = poll - STALE_MINUTES * 60, poll + STALE_MINUTES * 60
    return [
        entity
        for entity, (vehicle, trip) in zip(found, clocks)
        if low <= vehicle <= high or low <= trip <= high
    ]


def _build(
    batch: pa.RecordBatch, held: list[tuple[int, list]], schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Entity columns of some payloads.

    A number outside its column's range rejects its payload and no other.
    """
    try:
        yield _entities(batch, held, schema)
    except (OverflowError, pa.ArrowInvalid) as error:
        if len(held) == 1:
            yield _failed(batch, held[0][0], error, schema)
        else:
            for one in held:
                yield from _build(batch, [one], schema)


def _failed(
    batch: pa.RecordBatch, row: int, error: Exception, schema: pa.Schema
) -> pa.RecordBatch:
    payload = batch.slice(row, 1).drop_columns(["content"]).to_pylist()[0]
    reason = f"{type(error).__name__}: {error}"
    return pa.RecordBatch.from_pylist(
        [{**payload, "decode_error": reason}], schema=schema
    )


def _entities(
    batch: pa.RecordBatch, held: list[tuple[int, list]], schema: pa.Schema
) -> pa.RecordBatch:
    starts: dict[int, int] = {}
    entities: list = []
    for _, found in held:
        if id(found) not in starts:
            starts[id(found)] = len(entities)
            entities.extend(found)
    lengths = [len(found) for _, found in held]
    rows = pa.array(np.repeat([row for row, _ in held], lengths), pa.int64())
    places = None
    if len(starts) < len(held):
        spans = [range(starts[id(found)], starts[id(found)] + len(found)) for _, found in held]
        places = pa.array(list(chain.from_iterable(spans)), pa.int32())
    columns = []
    for field in schema:
        if field.name in ("vehicle", "trip_update"):
            column = _optional(entities, field)
        elif field.name in ("entity_id", "is_deleted"):
            name = "id" if field.name == "entity_id" else field.name
            column = pa.array(list(map(attrgetter(name), entities)), field.type)
        elif field.name == "decode_error":
            columns.append(pa.nulls(len(rows), field.type))
            continue
        else:
            columns.append(batch.column(field.name).take(rows).cast(field.type))
            continue
        columns.append(column if places is None else column.take(places))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _has(messages: Sequence, name: str) -> np.ndarray:
    found = map(methodcaller("HasField", name), messages)
    return np.fromiter(found, bool, len(messages))


def _optional(entities: Sequence, field: pa.Field) -> pa.Array:
    """A nested message of those entities that have it, NULL for others."""
    has = _has(entities, field.name)
    having = map(attrgetter(field.name), compress(entities, has.tolist()))
    column = _struct_column(list(having), field.type)
    return column.take(pa.array(np.cumsum(has) - 1, pa.int32(), mask=~has))


def _struct_column(messages: Sequence, kind: pa.StructType) -> pa.Array:
    children = [_column(messages, child) for child in kind]
    return pa.StructArray.from_arrays(children, fields=list(kind))


def _column(messages: Sequence, field: pa.Field) -> pa.Array:
    """One field of many messages, nested as the schema says.

    Reading an unset field gives its default, also inside unset messages, of
    which one is read for all.
    """
    read = attrgetter(field.name)
    if pa.types.is_struct(field.type):
        has = _has(messages, field.name)
        if has.all():
            return _struct_column(list(map(read, messages)), field.type)
        having = list(map(read, compress(messages, has.tolist())))
        places = np.where(has, np.cumsum(has) - 1, len(having))
        having.append(read(messages[int(np.argmin(has))]))
        return _struct_column(having, field.type).take(pa.array(places, pa.int32()))
    values = list(map(read, messages))
    if pa.types.is_list(field.type):
        ends = accumulate(map(len, values), initial=0)
        items = list(chain.from_iterable(values))
        item_type = field.type.value_type
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), _struct_column(items, item_type), type=field.type
        )
    if field.name == "timestamp":
        # Unsigned in the feed; what does not fit is far from any poll.
        values = [min(v, _MAX_LONG) for v in values]
    return pa.array(values, field.type)
