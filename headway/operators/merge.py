"""Merge the observations of a stop into one event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.schemas import PROCESSED, STOP_KEYS

SIDES = ("arrival", "departure")


def confirmed(side: str) -> Column:
    """The vehicle was there: a time without uncertainty."""
    has_time = F.col(f"{side}_time").isNotNull()
    return has_time & (F.col(f"{side}_uncertainty") == 0)


def max_where(condition: Column, name: str) -> Column:
    """MAX over the rows that meet a condition, NULL if none does."""
    return F.max(F.when(condition, F.col(name))).alias(name)


def merge_stop_events(stop_updates: DataFrame) -> DataFrame:
    """One row per (trip, date, stop sequence, stop).

    The fields of a side are taken from its confirmed rows, each by its own
    maximum; a stop with predictions only stays, with NULLs. All aggregates
    are partial, so a hot stop shrinks before the exchange.

    A maximum of text cannot be kept in a hash table, and would have all rows
    sorted. The route is therefore a key of a first aggregate, and the largest
    route is taken from the few rows that leaves of a stop.
    """
    numbers = ("poll_time", "feed_timestamp", "stop_schedule_relationship")
    fields = [
        f"{side}_{field}"
        for side in SIDES
        for field in ("delay", "time", "uncertainty")
    ]
    by_route = stop_updates.groupBy(*STOP_KEYS, "route_id").agg(
        *[F.max(c).alias(c) for c in numbers],
        *[max_where(confirmed(f.partition("_")[0]), f) for f in fields],
    )
    # They are shuffled as they are: no two of a stop met before, and to look
    # for some would sort all rows twice.
    merged = by_route.repartition(*STOP_KEYS).groupBy(*STOP_KEYS).agg(
        *[F.max(c).alias(c) for c in ("route_id", *numbers, *fields)]
    )
    return merged.select(*PROCESSED["stop_time_events"].schema.names)
