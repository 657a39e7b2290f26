"""The processed layer as a stream: a date is processed when it closes.

The stream reads what is appended to the raw tables. Of each write it takes only
the date, the load and the times, summed up in the task that reads them, so what
is shuffled and held as state grows with dates and loads and not with rows. A
date is open from its first row on. It closes a while after its day has ended in
the operating zone, by the clock of the polls: an event-time timer fires, the
date is processed by the jobs of ``headway.plans.daily``, and its state is gone.

Polls may land in any order while their date is open. Rows that land after it
has closed are late: they are copied to the tables ``late_<table>``, and with
``follow_late`` their dates are processed again.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from functools import partial, reduce
from zoneinfo import ZoneInfo

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import (
    StatefulProcessor,
    StatefulProcessorHandle,
    StreamingQuery,
)

from headway.functions.times import OPERATING_ZONE
from headway.plans.daily import run_daily
from headway.schemas import LOAD_ID, RAW, TableSpec
from headway.session import conf, ship_package, side_by_side
from headway.store import Store
from headway.tables import (
    MERGED_PREFIX,
    append_rows,
    read_stored,
    table_path,
)

log = logging.getLogger("headway.layer")

# A date is processed so long after its day has ended.
CLOSE_AFTER = timedelta(hours=4)
# Late rows are told apart for so long after their date has closed; Spark drops
# what is later still, and counts it in the query's progress.
LATE_FOR = timedelta(days=30)
# A day has at most so many hours where clocks are put back.
_LONGEST_DAY = timedelta(hours=25)

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state."
        "RocksDBStateStoreProvider"
    )
}

# The state is a row for each open date and table, however many rows there are;
# every partition of it costs a store and a Python worker in each micro-batch.
STATE_PARTITIONS = 4

SEEN = (
    "table_name string, start_date string, load_id string, "
    "first_poll timestamp, last_poll timestamp, n_rows long"
)
EVENTS = f"kind string, {SEEN}"
CLOSED, LATE = "closed", "late"


def closing_time(
    date: str, zone: str = OPERATING_ZONE, close_after: timedelta = CLOSE_AFTER
) -> datetime:
    """When a date closes, in UTC."""
    next_day = datetime.strptime(date, "%Y%m%d") + timedelta(days=1)
    local = next_day.replace(tzinfo=ZoneInfo(zone))
    return local.astimezone(timezone.utc) + close_after


def late_spec(table: str) -> TableSpec:
    """Where late rows of a raw table are kept, by date and load."""
    return replace(
        RAW[table], name=f"late_{table}", partition_by=("start_date", LOAD_ID)
    )


class _Dates(StatefulProcessor):
    """State of one date: rows, and first and last poll, of each table."""

    def __init__(self, zone: str, close_after: timedelta, delay: timedelta) -> None:
        self._zone, self._close_after, self._delay = zone, close_after, delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getMapState(
            "open", "table_name string", "n_rows long, first long, last long"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (date,) = key
        closes = closing_time(date, self._zone, self._close_after)
        # The watermark lags behind the newest poll by the delay.
        clock = timerValues.getCurrentWatermarkInMs() + _ms(self._delay)
        late = clock >= _ms(closes)
        for seen in rows:
            if late:
                yield seen.assign(kind=LATE)[[c for c, *_ in _columns(EVENTS)]]
            else:
                self._note(seen)
        if not late:
            self._handle.registerTimer(_ms(closes) - _ms(self._delay))

    def _note(self, seen: pd.DataFrame) -> None:
        for table, part in seen.groupby("table_name"):
            first = int(part["first_poll"].min().timestamp() * 1_000_000)
            last = int(part["last_poll"].max().timestamp() * 1_000_000)
            n = int(part["n_rows"].sum())
            if self._open.containsKey((table,)):
                held = self._open.getValue((table,))
                n, first, last = n + held[0], min(first, held[1]), max(last, held[2])
            self._open.updateValue((table,), (n, first, last))

    def handleExpiredTimer(
        self, key, timerValues, expiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        found = [
            {
                "kind": CLOSED,
                "table_name": table,
                "start_date": key[0],
                "load_id": None,
                "first_poll": pd.Timestamp(first, unit="us"),
                "last_poll": pd.Timestamp(last, unit="us"),
                "n_rows": n,
            }
            for (table,), (n, first, last) in self._open.iterator()
        ]
        self._open.clear()
        yield pd.DataFrame(found, columns=[c for c, *_ in _columns(EVENTS)])

    def close(self) -> None:
        pass


def _columns(ddl: str) -> list[list[str]]:
    return [c.split() for c in ddl.split(", ")]


def _ms(value: datetime | timedelta) -> int:
    if isinstance(value, timedelta):
        return int(value.total_seconds() * 1000)
    return int(value.timestamp() * 1000)


def stream_loads(spark: SparkSession, raw_root: str, max_files: int) -> DataFrame:
    """(table_name, start_date, load_id, poll_time) of what is appended.

    Only these columns are read. What compaction writes again is not new; it
    leaves the newest write of a stream alone, so it may run beside.
    """
    parts = []
    for table, spec in RAW.items():
        path = table_path(raw_root, spec)
        Store(spark, path).make_dir(path)
        rows = (
            spark.readStream.schema(spec.stored_schema)
            .option("maxFilesPerTrigger", max_files)
            .parquet(path)
            .where(~F.startswith(F.col(LOAD_ID), F.lit(MERGED_PREFIX)))
        )
        parts.append(
            rows.select(F.lit(table).alias("table_name"), "start_date", LOAD_ID, "poll_time")
        )
    return reduce(DataFrame.unionAll, parts)


def summed_up(loads: DataFrame) -> DataFrame:
    """One row (``SEEN``) for each date and load of a batch that a task reads."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            found = table.group_by(["table_name", "start_date", "load_id"]).aggregate(
                [("poll_time", "min"), ("poll_time", "max"), ("poll_time", "count")]
            )
            names = ["poll_time_min", "poll_time_max", "poll_time_count"]
            found = found.select(["table_name", "start_date", "load_id", *names])
            yield from found.rename_columns(
                [name for name, _ in _columns(SEEN)]
            ).to_batches()

    return loads.mapInArrow(combine, SEEN)


def date_events(
    loads: DataFrame,
    zone: str = OPERATING_ZONE,
    close_after: timedelta = CLOSE_AFTER,
    late_for: timedelta = LATE_FOR,
) -> DataFrame:
    """(kind, table_name, start_date, load_id, first_poll, last_poll, n_rows).

    ``closed``: a table of a date that closes, with all that was seen of it.
    ``late``: a load that came for a date already closed.
    """
    # Rows without a usable date are never processed.
    day = F.try_to_timestamp(F.col("start_date"), F.lit("yyyyMMdd"))
    usable = F.col("start_date").rlike(r"^\d{8}$") & day.isNotNull()
    loads = loads.where(usable & F.col("poll_time").isNotNull())
    # Rows polled on a date that is still open are never behind the watermark.
    delay = _LONGEST_DAY + close_after + late_for
    marked = summed_up(loads).withWatermark(
        "last_poll", f"{int(delay.total_seconds())} seconds"
    )
    return marked.groupBy("start_date").transformWithStateInPandas(
        _Dates(zone, close_after, delay),
        outputStructType=EVENTS,
        outputMode="append",
        timeMode="EventTime",
    )


def run_layer(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    checkpoint: str,
    *,
    follow_late: bool = False,
    zone: str = OPERATING_ZONE,
    close_after: timedelta = CLOSE_AFTER,
    late_for: timedelta = LATE_FOR,
    max_files: int = 10_000,
    interval: str | None = "5 minutes",
) -> StreamingQuery:
    """Start the layer; ``interval=None`` takes what is there and stops.

    What a micro-batch does can be repeated: processing replaces whole dates,
    and late rows replace themselves by load.
    """
    ship_package(spark)
    events = date_events(
        stream_loads(spark, raw_root, max_files), zone, close_after, late_for
    )

    def act(batch: DataFrame, batch_id: int) -> None:
        # A row for each date that closes, and for each late load.
        found = batch.collect()
        late = [r for r in found if r["kind"] == LATE]
        dates = {r["start_date"] for r in found if r["kind"] == CLOSED}
        # The session that was given, as that of the batch has the settings of
        # the state. What the steps write does not depend on each other.
        steps = []
        for table in RAW:
            mine = {(r["start_date"], r["load_id"]) for r in late if r["table_name"] == table}
            if mine:
                steps.append(
                    partial(_keep_late, spark, raw_root, processed_root, table, mine)
                )
        if follow_late:
            dates |= {r["start_date"] for r in late}
        if dates:
            steps.append(
                partial(run_daily, spark, raw_root, processed_root, dates=dates)
            )
        if steps:
            side_by_side(spark, steps)
        if found:
            log.info("batch %d: %s closed, %d loads late", batch_id, sorted(dates), len(late))

    writer = (
        events.writeStream.foreachBatch(act)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    # The state of timers needs this store; a query keeps what it starts with.
    partitions = min(STATE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    state = {**ROCKSDB, "spark.sql.shuffle.partitions": str(partitions)}
    with conf(spark, state):
        return writer.start()


def _keep_late(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    table: str,
    loads: set[tuple[str, str]],
) -> None:
    """Copy the rows of late loads, which is a copy of whole folders."""
    rows = read_stored(spark, raw_root, RAW[table], {date for date, _ in loads})
    wanted = spark.createDataFrame(sorted(loads), f"start_date string, {LOAD_ID} string")
    mine = rows.join(F.broadcast(wanted), ["start_date", LOAD_ID], "left_semi")
    append_rows(mine, processed_root, late_spec(table))
