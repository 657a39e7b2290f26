"""Row counts of the raw tables, observed by a stream over what is written.

The stream computes nothing but its metrics: rows of each table, and the first
and last poll. A listener gets them with the progress of every micro-batch and
stores them as one small file each, named after query and batch, so that a batch
that is run again replaces its own. No function of the ingest is involved, and
no row leaves the executors.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from headway.schemas import RAW
from headway.session import ship_package
from headway.store import Store
from headway.streaming.layer import stream_loads

METRICS = "ingest_metrics"
OBSERVED = "raw_rows"
_COUNTS = (
    "query_id string, batch_id long, table_name string, n_rows long, "
    "first_poll timestamp, last_poll timestamp"
)


class MetricsListener(StreamingQueryListener):
    """Stores the observed metrics of the queries that have them."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._path = f"{root.rstrip('/')}/{METRICS}"
        self._store = Store(spark, root)
        self._ended: dict[str, threading.Event] = {}
        self._failed: Exception | None = None

    def _end(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(OBSERVED)
        if row is None or not progress.numInputRows:
            return
        lines = []
        for table in RAW:
            found = row[table]
            lines.append(
                json.dumps(
                    {
                        "query_id": str(progress.id),
                        "batch_id": progress.batchId,
                        "table_name": table,
                        "n_rows": found["n_rows"],
                        "first_poll": _text(found["first_poll"]),
                        "last_poll": _text(found["last_poll"]),
                    }
                )
            )
        name = f"{progress.id}-{progress.batchId:012d}.json"
        try:
            self._store.write_text(f"{self._path}/{name}", "\n".join(lines) + "\n")
        except Exception as error:
            # A listener's failure would only be logged by Spark.
            self._failed = error
            raise

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all progress of a query that has ended is stored.

        Events come after the query's own end. Raises what storing them raised.
        """
        if not self._end(query.runId).wait(seconds):
            raise TimeoutError("the query's end was not reported")
        if self._failed is not None:
            raise self._failed


def _text(micros: int | None) -> str | None:
    return None if micros is None else f"{micros}"


def observed_rows(loads: DataFrame) -> DataFrame:
    """The same stream, with counts and polls of each table as its metrics."""
    polled = F.unix_micros("poll_time")
    metrics = []
    for table in RAW:
        mine = F.col("table_name") == table
        metrics.append(
            F.struct(
                F.count(F.when(mine, 1)).alias("n_rows"),
                F.min(F.when(mine, polled)).alias("first_poll"),
                F.max(F.when(mine, polled)).alias("last_poll"),
            ).alias(table)
        )
    return loads.observe(OBSERVED, *metrics)


def watch_raw(
    spark: SparkSession,
    raw_root: str,
    checkpoint: str,
    *,
    max_files: int = 10_000,
    interval: str | None = "1 minute",
) -> StreamingQuery:
    """Start the stream whose metrics a ``MetricsListener`` stores.

    The listener is to be added to the session's streams before. Rows without a
    date count too; what compaction writes again does not.
    """
    ship_package(spark)
    writer = (
        observed_rows(stream_loads(spark, raw_root, max_files))
        .writeStream.format("noop")
        .option("checkpointLocation", checkpoint)
    )
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def ingest_metrics(spark: SparkSession, root: str) -> DataFrame:
    """(query_id, batch_id, table_name, n_rows, first_poll, last_poll).

    One row a batch and table; none before the first batch.
    """
    path = f"{root.rstrip('/')}/{METRICS}"
    if not Store(spark, path).exists(path):
        return spark.createDataFrame([], _COUNTS)
    plain = _COUNTS.replace("timestamp", "string")
    rows = spark.read.schema(plain).json(path)
    polls = {
        c: F.timestamp_micros(F.col(c).cast("long")) for c in ("first_poll", "last_poll")
    }
    return rows.withColumns(polls)
