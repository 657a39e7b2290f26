"""Daily job: raw tables to the processed layer.

Run some hours after the operational day ends (04:00 in the operating zone,
say), so that late observations are in.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from headway.functions.times import target_date, utc_now
from headway.operators.dedupe import dedupe, latest_state
from headway.operators.merge import merge_stop_events
from headway.schemas import PROCESSED, RAW, TRIP_KEYS, VEHICLE_KEYS
from headway.session import side_by_side
from headway.tables import read_table, replace_dates, table_exists

log = logging.getLogger("headway.daily")


def _process(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    source: str,
    target: str,
    refine: Callable[[DataFrame], DataFrame],
    now: datetime | None,
    dates: Iterable[str] | None,
) -> int:
    """Refine the dates of one raw table; rows written, 0 when skipped.

    Several dates (a backfill) are one Spark job; the keys of ``refine`` hold
    the date, so each date gets what a run of its own would give it. Rows
    without a trip are filed under ``UNKNOWN``, which no run asks for.
    """
    if not table_exists(spark, raw_root, RAW[source]):
        log.warning("daily: raw %s is missing", source)
        return 0
    if dates is None:
        dates = [target_date(now or utc_now())]
    wanted = sorted(dates)
    raw = read_table(spark, raw_root, RAW[source], wanted)
    rows = replace_dates(
        refine(raw), processed_root, PROCESSED[target], wanted
    )
    if rows:
        log.info("daily: %s of %s now has %d rows", target, wanted, rows)
    else:
        log.info("daily: raw %s is empty on %s", source, wanted)
    return rows


def process_vehicle_positions(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    now: datetime | None = None,
    dates: Iterable[str] | None = None,
) -> int:
    """One row per vehicle and stamp within a date, the last polled."""
    keys = [*VEHICLE_KEYS, "start_date"]
    return _process(
        spark,
        raw_root,
        processed_root,
        "vehicle_positions",
        "vehicle_positions",
        lambda df: dedupe(df, keys),
        now,
        dates,
    )


def process_trip_updates(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    now: datetime | None = None,
    dates: Iterable[str] | None = None,
) -> int:
    """The last known state of each trip."""
    return _process(
        spark,
        raw_root,
        processed_root,
        "trip_updates",
        "trip_updates",
        lambda df: latest_state(df, TRIP_KEYS),
        now,
        dates,
    )


def process_stop_time_events(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    now: datetime | None = None,
    dates: Iterable[str] | None = None,
) -> int:
    """Confirmed arrival and departure of each stop in one row."""
    return _process(
        spark,
        raw_root,
        processed_root,
        "stop_time_updates",
        "stop_time_events",
        merge_stop_events,
        now,
        dates,
    )


def run_daily(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    now: datetime | None = None,
    dates: Iterable[str] | None = None,
) -> dict[str, int]:
    """All three tables, for the day before ``now`` or the given dates.

    The tables do not depend on each other and run side by side.
    """
    now = now or utc_now()
    dates = sorted(dates) if dates is not None else None
    steps = {
        "vehicle_positions": process_vehicle_positions,
        "trip_updates": process_trip_updates,
        "stop_time_events": process_stop_time_events,
    }
    done = side_by_side(
        spark,
        [
            partial(step, spark, raw_root, processed_root, now, dates)
            for step in steps.values()
        ],
    )
    return dict(zip(steps, done))
