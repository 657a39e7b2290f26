"""Feed entities to rows of the three realtime tables.

Input: one row per entity (see ``headway.sources.feed``), with ``vehicle`` or
``trip_update`` NULL where the entity is of another kind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.normalise import (
    NO_ROUTE,
    UNKNOWN_DATE,
    blank_to_null,
    or_default,
    or_zero,
    zero_to_null,
)
from headway.functions.times import epoch_to_timestamp, whole_seconds
from headway.operators.stale import is_fresh
from headway.schemas import RAW, conform


def _fresh(entities: DataFrame, kind: str) -> DataFrame:
    stamp = or_zero(F.col(f"{kind}.timestamp"))
    return entities.where(F.col(kind).isNotNull()).where(
        is_fresh(F.col("poll_time"), stamp)
    )


def _times(kind: str) -> dict[str, Column]:
    return {
        "poll_time": whole_seconds(F.col("poll_time")),
        "feed_timestamp": epoch_to_timestamp(F.col(f"{kind}.timestamp")),
    }


def _partition(trip: str) -> dict[str, Column]:
    return {
        "start_date": or_default(F.col(f"{trip}.start_date"), UNKNOWN_DATE),
        "route_id": or_default(F.col(f"{trip}.route_id"), NO_ROUTE),
    }


def _trip(kind: str) -> dict[str, Column]:
    trip, vehicle = f"{kind}.trip", f"{kind}.vehicle"
    return {
        **_partition(trip),
        "trip_id": blank_to_null(F.col(f"{trip}.trip_id")),
        "direction_id": or_zero(F.col(f"{trip}.direction_id")),
        "schedule_relationship": or_zero(
            F.col(f"{trip}.schedule_relationship")
        ),
        "start_time": blank_to_null(F.col(f"{trip}.start_time")),
        "vehicle_id": blank_to_null(F.col(f"{vehicle}.id")),
        "label": blank_to_null(F.col(f"{vehicle}.label")),
        "license_plate": blank_to_null(F.col(f"{vehicle}.license_plate")),
        "entity_is_deleted": F.coalesce(F.col("is_deleted"), F.lit(False)),
    }


def _rows(df: DataFrame, cols: dict[str, Column], table: str) -> DataFrame:
    named = df.select(*[c.alias(n) for n, c in cols.items()])
    return conform(named, RAW[table].schema)


def vehicle_positions(entities: DataFrame) -> DataFrame:
    """One row per fresh vehicle entity."""
    position = {
        n: or_zero(F.col(f"vehicle.position.{n}"))
        for n in ("latitude", "longitude", "bearing", "speed", "odometer")
    }
    return _rows(
        _fresh(entities, "vehicle"),
        {
            **_times("vehicle"),
            **_trip("vehicle"),
            **position,
            "occupancy_status": or_zero(F.col("vehicle.occupancy_status")),
        },
        "vehicle_positions",
    )


def trip_updates(entities: DataFrame) -> DataFrame:
    """One row per fresh trip entity."""
    return _rows(
        _fresh(entities, "trip_update"),
        {**_times("trip_update"), **_trip("trip_update")},
        "trip_updates",
    )


def stop_time_updates(entities: DataFrame) -> DataFrame:
    """One row per stop of a fresh trip entity; none for a trip without."""
    stops = _fresh(entities, "trip_update").select(
        "poll_time",
        F.struct("trip_update.timestamp", "trip_update.trip").alias("t"),
        F.explode("trip_update.stop_time_update").alias("stop"),
    )
    sides = {}
    for side in ("arrival", "departure"):
        event = f"stop.{side}"
        sides[f"{side}_delay"] = or_zero(F.col(f"{event}.delay"))
        sides[f"{side}_time"] = epoch_to_timestamp(
            zero_to_null(F.col(f"{event}.time"))
        )
        sides[f"{side}_uncertainty"] = or_zero(F.col(f"{event}.uncertainty"))
    return _rows(
        stops,
        {
            **_times("t"),
            **_partition("t.trip"),
            "trip_id": blank_to_null(F.col("t.trip.trip_id")),
            "stop_sequence": or_zero(F.col("stop.stop_sequence")),
            "stop_id": blank_to_null(F.col("stop.stop_id")),
            "stop_schedule_relationship": or_zero(
                F.col("stop.schedule_relationship")
            ),
            **sides,
        },
        "stop_time_updates",
    )


# What a feed fans out to, in the order it is written.
FLATTENERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "vehicle_positions": vehicle_positions,
    "trip_updates": trip_updates,
    "stop_time_updates": stop_time_updates,
}


def entity_counts(entities: DataFrame) -> DataFrame:
    """Entities of each kind in the decoded feed."""
    kind = (
        F.when(F.col("vehicle").isNotNull(), "vehicle")
        .when(F.col("trip_update").isNotNull(), "trip_update")
        .otherwise("other")
    )
    decoded = entities.where(F.col("decode_error").isNull())
    return decoded.groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("entities")
    )
