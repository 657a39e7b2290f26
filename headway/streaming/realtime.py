"""The realtime job: landed payloads to the three raw tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import astuple, dataclass
from datetime import timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators.change import consecutive_skip
from headway.operators.flatten import FLATTENERS
from headway.schemas import RAW
from headway.session import ship_package
from headway.sources.feed import (
    decode,
    plain_path,
    read_payloads,
    stream_payloads,
)
from headway.store import Store
from headway.streaming.skip import changed_payloads
from headway.swap import STAGING
from headway.tables import append

log = logging.getLogger("headway.realtime")


@dataclass(frozen=True)
class IngestCounts:
    """Rows appended to each raw table by one batch."""

    vehicle_positions: int
    trip_updates: int
    stop_time_updates: int

    @property
    def total(self) -> int:
        return (
            self.vehicle_positions + self.trip_updates + self.stop_time_updates
        )


def append_entities(
    entities: DataFrame, raw_root: str, load_id: str | None = None
) -> IngestCounts:
    """Decode once, write three tables, in order.

    The writes are not atomic together; a repeat under the same ``load_id``
    replaces what an earlier try had written.
    """
    entities = entities.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = {
            table: append(flatten(entities), raw_root, RAW[table], load_id)
            for table, flatten in FLATTENERS.items()
        }
        bad = entities.where(F.col("decode_error").isNotNull()).count()
        if bad:
            log.warning("%d payloads could not be decoded", bad)
    finally:
        entities.unpersist()
    counts = IngestCounts(**rows)
    log.info("%s: %d rows written", counts, counts.total)
    return counts


def _row() -> Column:
    """A packed payload's row in its file, which its name ends in."""
    return F.substring_index("payload_id", "#", -1).cast("long")


def _places(kept: DataFrame, packed: bool) -> DataFrame:
    """The files of kept payloads; of packed files 64 rows each, as bits.

    The names of all of a micro-batch's packed payloads are too many to be sent
    to where its files are read. Its payloads would be shuffled to the names
    instead, and torn from those of equal bytes, which are parsed together.
    """
    if not packed:
        return kept.select("source_file").distinct()
    bit = F.expr("shiftleft(1L, cast(_row & 63 as int))")
    return (
        kept.withColumn("_row", _row())
        .groupBy("source_file", F.shiftright("_row", 6).alias("_block"))
        .agg(
            F.bit_or(bit).alias("_rows"),
            F.min("poll_time").alias("_low"),
            F.max("poll_time").alias("_high"),
        )
        .withColumnRenamed("source_file", "_file")
    )


def _load_kept(
    spark: SparkSession, places: DataFrame, packed: bool
) -> DataFrame | None:
    """Payload rows of some kept payloads, None without any.

    Only the files that hold them are named: a micro-batch's or a slice's,
    which its limits bound. Packed files are read where their statistics say
    that they may hold polls of these times.
    """
    named = places.select("_file" if packed else "source_file").distinct().collect()
    files = [plain_path(r[0], packed) for r in named]
    if not files:
        return None
    rows = read_payloads(spark, files, packed)
    if not packed:
        return rows
    low, high = places.agg(F.min("_low"), F.max("_high")).first()
    if low is not None:
        times = [F.lit(t.astimezone(timezone.utc)) for t in (low, high)]
        rows = rows.where(F.col("poll_time").isNull() | F.col("poll_time").between(*times))
    here = (F.col("source_file") == F.col("_file")) & (
        F.shiftright(_row(), 6) == F.col("_block")
    )
    kept = F.getbit("_rows", _row().bitwiseAND(63)) == 1
    return rows.join(places.drop("_low", "_high"), here & kept, "left_semi")


def run_realtime(
    spark: SparkSession,
    landing: str,
    raw_root: str,
    checkpoint: str,
    *,
    packed: bool = False,
    max_files: int = 1_000,
    max_bytes: int = 1 << 30,
    interval: str | None = "30 seconds",
    on_batch: Callable[[IngestCounts], None] | None = None,
) -> StreamingQuery:
    """Start the stream; ``interval=None`` drains the landing and stops.

    Micro-batches are written under a load id made of the query's own id and
    the batch number, so a batch replayed after a failure replaces itself.
    """
    ship_package(spark)
    kept = changed_payloads(
        stream_payloads(spark, landing, packed, max_files, max_bytes)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(
            "sql.streaming.queryId"
        )
        if query is None:
            raise RuntimeError("not called by a streaming query")
        # Once these are held, Spark knows how few they are and sends them.
        places = _places(batch, packed).persist()
        try:
            rows = _load_kept(spark, places, packed)
            if rows is None:
                log.info("batch %d: feed unchanged, skipped", batch_id)
                return
            load_id = f"poll-{query}-{batch_id:012d}"
            counts = append_entities(decode(rows, fresh_only=True), raw_root, load_id)
        finally:
            places.unpersist()
        if on_batch:
            on_batch(counts)

    writer = (
        kept.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


# A backfill's slice: bytes of payloads, and payloads.
SLICE_BYTES, SLICE_PAYLOADS = 8 << 30, 100_000
# Parts of an hour over which its payloads are numbered.
_HOUR_PARTS = 256
_KEPT = (
    "feed_id string, poll_time timestamp, payload_id string, "
    "source_file string, slice long"
)


def slice_payloads(kept: DataFrame, max_bytes: int, max_payloads: int) -> DataFrame:
    """``kept(poll_time, payload_id, n_bytes)`` with the number of its ``slice``.

    Slices are in the order of hours, and none has more payloads or, but for
    one that is larger by itself, more bytes than given. Equal rows give equal
    slices. Payloads are numbered within parts of an hour; what comes before a
    part is summed over one row for each, which the calendar bounds.
    """
    unit = max(1, max_bytes // max_payloads)
    part = [
        F.date_trunc("hour", "poll_time").alias("_hour"),
        F.pmod(F.xxhash64("payload_id"), F.lit(_HOUR_PARTS)).alias("_part"),
    ]
    cost = F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / unit)).cast("long")
    priced = kept.select("*", *part, F.least(cost, F.lit(max_payloads)).alias("_cost"))
    before = Window.orderBy(F.col("_hour").asc_nulls_first(), "_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        priced.groupBy("_hour", "_part")
        .agg(F.sum("_cost").alias("_sum"))
        .select(
            F.col("_hour").alias("_h"),
            F.col("_part").alias("_p"),
            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
        )
    )
    inside = (
        Window.partitionBy("_hour", "_part")
        .orderBy("poll_time", "payload_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = priced.withColumn("_upto", F.sum("_cost").over(inside)).join(
        starts, F.col("_hour").eqNullSafe(F.col("_h")) & (F.col("_part") == F.col("_p"))
    )
    # A slice begins with the payload whose cost passes a multiple.
    number = F.floor((F.col("_start") + F.col("_upto") - 1) / max_payloads)
    return placed.select(*kept.columns, number.cast("long").alias("slice"))


def _write_slices(
    rows: DataFrame, scratch: str, max_bytes: int, max_payloads: int
) -> list[int]:
    """Store the names of the payloads to be kept, by slice; their numbers.

    Payloads are hashed where they are read; their bytes are not shuffled.
    """
    spark = rows.sparkSession
    hashed = rows.select(
        "feed_id",
        "poll_time",
        "payload_id",
        "source_file",
        F.length("content").cast("long").alias("n_bytes"),
        F.md5("content").alias("md5"),
    )
    changed = consecutive_skip(
        hashed,
        "feed_id",
        ["poll_time", "payload_id"],
        "md5",
        F.date_trunc("minute", F.col("poll_time")),
    )
    changed.write.parquet(f"{scratch}/changed")
    kept = spark.read.schema(changed.schema).parquet(f"{scratch}/changed")
    sliced = slice_payloads(kept, max_bytes, max_payloads)
    (
        sliced.select(*[part.split()[0] for part in _KEPT.split(", ")])
        .repartition("slice")
        .write.partitionBy("slice")
        .parquet(f"{scratch}/kept")
    )
    made = spark.read.schema(_KEPT).parquet(f"{scratch}/kept")
    return sorted(r["slice"] for r in made.select("slice").distinct().collect())


def ingest_landed(
    spark: SparkSession,
    landing: str,
    raw_root: str,
    *,
    packed: bool = False,
    load_id: str | None = None,
    max_bytes: int = SLICE_BYTES,
    max_payloads: int = SLICE_PAYLOADS,
    on_slice: Callable[[IngestCounts], None] | None = None,
) -> IngestCounts:
    """The same as one batch over everything landed (a backfill), in slices.

    The comparison with the payload before is over everything; only names and
    hashes take part in it. What is kept is then read, decoded and written in
    slices of bounded size, so that no more than a slice is held at a time. A
    backfill that may be run again over the same landing after a failure
    passes the same ``load_id`` again; each slice then replaces what the first
    try wrote.
    """
    ship_package(spark)
    scratch = f"{raw_root.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}"
    load_id = load_id or f"load-{uuid.uuid4().hex}"
    totals = [0, 0, 0]
    try:
        rows = read_payloads(spark, landing, packed)
        for number in _write_slices(rows, scratch, max_bytes, max_payloads):
            kept = spark.read.schema(_KEPT).parquet(f"{scratch}/kept")
            # ``max_payloads`` names at most.
            places = _places(kept.where(F.col("slice") == number), packed)
            wanted = _load_kept(spark, F.broadcast(places), packed)
            entities = decode(wanted, fresh_only=True)
            counts = append_entities(entities, raw_root, f"{load_id}-{number:06d}")
            if on_slice:
                on_slice(counts)
            totals = [a + b for a, b in zip(totals, astuple(counts))]
    finally:
        Store(spark, raw_root).delete(scratch)
    return IngestCounts(*totals)
