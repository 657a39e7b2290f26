"""Joins over the stored tables (documented extensions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DAY = "yyyyMMdd"


def version_by_date(versions: DataFrame) -> DataFrame:
    """(start_date, valid_from, valid_to) in force on every covered day.

    Where ranges overlap the latest ``valid_from`` wins, then the latest
    ``valid_to``. Ranges are unrolled to days, so later joins are equi-joins
    instead of comparing every row with every version. A range that ends
    before it begins covers no day.
    """
    days = F.sequence(
        F.to_date("valid_from", _DAY), F.to_date("valid_to", _DAY)
    )
    ranges = versions.select("valid_from", "valid_to").distinct()
    unrolled = ranges.where("valid_from <= valid_to").select(
        F.explode(days).alias("_day"), "valid_from", "valid_to"
    )
    newest = F.max(F.struct("valid_from", "valid_to")).alias("_v")
    return (
        unrolled.groupBy(F.date_format("_day", _DAY).alias("start_date"))
        .agg(newest)
        .select("start_date", "_v.valid_from", "_v.valid_to")
    )


def version_as_of(
    facts: DataFrame, static: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Facts with the static row that was in force on their ``start_date``.

    Facts without one keep NULLs. The day table has a row per calendar day;
    the join with the static rows is on (keys, version), where AQE splits a
    hot key on the fact side.
    """
    dated = facts.join(version_by_date(static), "start_date", "left")
    return dated.join(static, [*keys, "valid_from", "valid_to"], "left")


def events_with_trip(events: DataFrame, trips: DataFrame) -> DataFrame:
    """Stop events with the final state of their trip, where known.

    ``trips`` has one row per key, so a hot trip grows nothing.
    """
    keys = ["trip_id", "start_date"]
    state = trips.select(
        *keys,
        F.col("schedule_relationship").alias("trip_schedule_relationship"),
        F.col("vehicle_id").alias("trip_vehicle_id"),
        F.col("feed_timestamp").alias("trip_feed_timestamp"),
    )
    return events.join(state, keys, "left")
