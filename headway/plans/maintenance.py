"""Maintenance of the raw layer: compact small files, expire old dates.

Run hourly, later in the hour than the staleness limit.
"""

from __future__ import annotations

import logging
import re
import uuid
from datetime import datetime
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from headway.functions.times import retention_cutoff, utc_now
from headway.schemas import LOAD_ID, RAW, TableSpec
from headway.session import conf, side_by_side
from headway.store import Store, partition_dir
from headway.swap import Step, new_staging, recover, swap
from headway.tables import (
    MERGED_PREFIX,
    partition_values,
    read_table,
    table_path,
    write_clustered,
)

log = logging.getLogger("headway.maintenance")

RETENTION_DAYS = 2
TARGET_BYTES = 128 * 1024 * 1024
# Results of one size class that are merged into one of the next.
FAN_IN = 3
_FILE_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

_MERGED = f"{LOAD_ID}={MERGED_PREFIX}"
_POLL = re.compile(rf"{LOAD_ID}=poll-(.+)-(\d{{12}})")


def _newest_polls(loads: dict[str, list[str]]) -> set[str]:
    """The last micro-batch of each stream, which may still be replayed."""
    newest: dict[str, str] = {}
    for names in loads.values():
        for name in names:
            if poll := _POLL.fullmatch(name):
                stream = poll.group(1)
                newest[stream] = max(newest.get(stream, ""), name)
    return set(newest.values())


def _to_merge(
    store: Store, folder: str, names: list[str], hold: set[str], target: int
) -> list[str]:
    """Writes of one date worth merging, none if nothing new has come.

    Writes are merged with others of their size only: a size class spans a
    factor of four, and ``FAN_IN`` earlier results of a class are merged into
    one of the next. So a row is rewritten as often as there are classes, not
    every hour. New writes are merged at once, as the smallest class.
    """
    new = [n for n in names if not n.startswith(_MERGED) and n not in hold]
    if not new:
        return []
    if len(new) == 1:
        # A single write may itself hold several files per route.
        routes = store.child_dirs(f"{folder}/{new[0]}")
        size, files = store.size(f"{folder}/{new[0]}")
    else:
        size, files, routes = 0, len(new), []
        for name in new:
            size += store.size(f"{folder}/{name}")[0]
    classes: dict[int, list[tuple[str, int]]] = {}
    for name in names:
        if name.startswith(_MERGED):
            held, count = store.size(f"{folder}/{name}")
            if held < count * target / 2:
                classes.setdefault(_size_class(held), []).append((name, held))
    chosen = list(new)
    while True:
        equals = classes.pop(_size_class(size), [])
        if len(equals) < FAN_IN - 1:
            break
        chosen += [name for name, _ in equals]
        size += sum(held for _, held in equals)
    if len(chosen) > 1:
        return chosen
    return new if files > len(routes) else []


def _size_class(size: int) -> int:
    return max(size, 1).bit_length() // 2


def compact_table(
    spark: SparkSession,
    raw_root: str,
    table: str,
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Merge small writes within each date; return how many were merged.

    Rows do not change. Folder operations are per (date, write), whatever the
    number of routes or files below. The last micro-batch of a running stream
    is left out, as it may be replayed.
    """
    spec = RAW[table]
    path = table_path(raw_root, spec)
    store = Store(spark, path)
    if not store.exists(path):
        log.info("compaction: no %s yet", table)
        return 0
    recover(store, path)

    loads = {
        day: [
            n
            for n in store.child_dirs(f"{path}/{day}")
            if n.startswith(f"{LOAD_ID}=")
        ]
        for day in store.child_dirs(path)
        if day.startswith("start_date=")
    }
    hold = _newest_polls(loads)
    merged = {
        day: chosen
        for day, names in loads.items()
        if (chosen := _to_merge(store, f"{path}/{day}", names, hold, target_bytes))
    }
    remove = [f"{day}/{name}" for day, names in merged.items() for name in names]
    if not remove:
        log.info("compaction: %s has no new writes", table)
        return 0

    run = uuid.uuid4().hex
    staged = new_staging(path)
    rows = (
        spark.read.schema(spec.stored_schema)
        .option("basePath", path)
        .parquet(*[f"{path}/{folder}" for folder in remove])
        .withColumn(LOAD_ID, F.lit(f"{MERGED_PREFIX}{run}"))
    )
    try:
        with conf(spark, {_FILE_SIZE: str(target_bytes)}):
            write_clustered(rows, staged, spec.partition_by)
    except BaseException:
        store.delete(staged)
        raise
    # Day by day, so that readers miss a day for a few renames only.
    steps = [
        Step([f"{day}/{n}" for n in names], [f"{day}/{_MERGED}{run}"])
        for day, names in merged.items()
    ]
    swap(store, path, staged, steps)
    log.info("compaction: %s, %d writes became %d", table, len(remove), len(steps))
    return len(remove)


def expire_table(
    spark: SparkSession,
    raw_root: str,
    table: str,
    now: datetime | None = None,
    retention_days: int = RETENTION_DAYS,
) -> int:
    """Delete dates before the cutoff; return the number of rows deleted.

    Dates compare as text, so ``UNKNOWN`` never expires.
    """
    spec = RAW[table]
    path = table_path(raw_root, spec)
    store = Store(spark, path)
    if not store.exists(path):
        log.info("retention: no %s yet", table)
        return 0
    cutoff = retention_cutoff(now or utc_now(), retention_days)
    old = [d for d in partition_values(spark, raw_root, spec) if d < cutoff]
    if not old:
        return 0
    rows = read_table(spark, raw_root, spec, old).count()
    for day in old:
        store.delete(f"{path}/{partition_dir(spark, 'start_date', day)}")
    log.info("retention: %s before %s gone, %d rows", table, cutoff, rows)
    return rows


def run_maintenance(
    spark: SparkSession,
    raw_root: str,
    now: datetime | None = None,
    retention_days: int = RETENTION_DAYS,
    target_bytes: int = TARGET_BYTES,
) -> dict[str, tuple[int, int]]:
    """(writes merged, rows expired) for each raw table."""
    now = now or utc_now()

    def maintain(table: str) -> tuple[int, int]:
        return (
            compact_table(spark, raw_root, table, target_bytes),
            expire_table(spark, raw_root, table, now, retention_days),
        )

    size = {_FILE_SIZE: str(target_bytes)}
    with conf(spark, size):
        done = side_by_side(spark, [partial(maintain, t) for t in RAW])
    return dict(zip(RAW, done))
