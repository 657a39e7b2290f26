"""Processed tables that are kept merged while their dates are open.

What the daily job makes of all rows of a date can be put together from parts:
the merge of stops takes maxima, and the other two tables the greatest row of a
key in a total order. A stored row stands for all rows it was made of, so
refining it again with new ones gives what refining everything gives, and doing
so twice changes nothing. The table itself is therefore all the state there is:
a micro-batch reads the (date, route) folders that its keys are in, and replaces
these. Keys are never held in memory, no watermark closes a date, and a
micro-batch that is repeated after a failure has no effect.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators.dedupe import dedupe, latest_state
from headway.operators.merge import merge_stop_events
from headway.schemas import (
    LOAD_ID,
    PROCESSED,
    RAW,
    STOP_KEYS,
    TRIP_KEYS,
    VEHICLE_KEYS,
    TableSpec,
    conform,
)
from headway.session import scratch_dir, ship_package
from headway.store import Store
from headway.tables import (
    MERGED_PREFIX,
    partition_values,
    read_leaves,
    read_stored,
    replace_leaves,
    table_path,
)

log = logging.getLogger("headway.incremental")


@dataclass(frozen=True)
class Refinement:
    """How a raw table becomes a processed one, over any of its rows again."""

    source: str
    target: str
    keys: tuple[str, ...]
    refine: Callable[[DataFrame], DataFrame]

    @property
    def spec(self) -> TableSpec:
        return PROCESSED[self.target]


_POSITION_KEYS = (*VEHICLE_KEYS, "start_date")
REFINEMENTS = {
    r.target: r
    for r in (
        Refinement(
            "vehicle_positions",
            "vehicle_positions",
            _POSITION_KEYS,
            lambda df: dedupe(df, _POSITION_KEYS),
        ),
        Refinement(
            "trip_updates",
            "trip_updates",
            TRIP_KEYS,
            lambda df: latest_state(df, TRIP_KEYS),
        ),
        Refinement(
            "stop_time_updates", "stop_time_events", STOP_KEYS, merge_stop_events
        ),
    )
}


def merge_rows(
    rows: DataFrame, processed_root: str, what: Refinement, scratch: str
) -> int:
    """Merge raw rows into a processed table; rows now in the folders touched.

    Rows of dates that are not processed (``UNKNOWN``) are left out.
    """
    spark, spec = rows.sparkSession, what.spec
    # Refined before it is shuffled any further: a hot key is one row from here.
    usable = rows.where(F.col("start_date").rlike(r"^\d{8}$"))
    part = what.refine(conform(usable, RAW[what.source].schema))
    part.write.mode("overwrite").parquet(scratch)
    part = spark.read.schema(spec.schema).parquet(scratch)

    place = list(spec.partition_by)
    # Folders, of which there are as many as dates and routes in the batch.
    new = {tuple(r) for r in part.select(*place).distinct().collect()}
    if not new:
        return 0
    path = table_path(processed_root, spec)
    Store(spark, path).make_dir(path)
    dates = {date for date, _ in new} & set(partition_values(spark, processed_root, spec))
    stored = read_stored(spark, processed_root, spec, dates)
    # A key may have been filed under another route; only key columns are read.
    keys = part.select(*what.keys).distinct()
    old = (
        stored.select(*dict.fromkeys([*what.keys, *place]))
        .join(keys, list(what.keys), "left_semi")
        .select(*place)
        .distinct()
        .collect()
    )
    touched = new | {tuple(r) for r in old}
    held = read_leaves(spark, processed_root, spec, touched)
    return replace_leaves(
        what.refine(held.unionByName(part)), processed_root, spec, touched
    )


def run_incremental(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    checkpoint: str,
    *,
    target: str = "stop_time_events",
    max_files: int = 10_000,
    interval: str | None = "10 minutes",
) -> StreamingQuery:
    """Keep one processed table merged with what is appended to its raw table.

    ``interval=None`` takes what is there and stops. The table equals that of
    the daily job over all dates that have rows, after every micro-batch. What
    compaction writes again is left out.
    """
    ship_package(spark)
    what = REFINEMENTS[target]
    source = RAW[what.source]
    path = table_path(raw_root, source)
    Store(spark, path).make_dir(path)
    rows = (
        spark.readStream.schema(source.stored_schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(path)
        .where(~F.startswith(F.col(LOAD_ID), F.lit(MERGED_PREFIX)))
        .select(*source.schema.names)
    )
    scratch = scratch_dir(spark, f"merge-{target}")

    def merge(batch: DataFrame, batch_id: int) -> None:
        count = merge_rows(batch, processed_root, what, f"{scratch}/{batch_id}")
        log.info("batch %d: %s, %d rows in touched folders", batch_id, target, count)

    writer = (
        rows.writeStream.foreachBatch(merge)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.start()
