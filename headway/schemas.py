"""Declared tables: names, types, partitions and keys."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(*lines: str) -> T.StructType:
    """A schema from lines of ``type: name name ...``."""
    kinds: dict[str, T.DataType] = {
        "ts": T.TimestampType(),
        "str": T.StringType(),
        "int": T.IntegerType(),
        "float": T.FloatType(),
        "double": T.DoubleType(),
        "bool": T.BooleanType(),
    }
    schema = T.StructType()
    for line in lines:
        kind, names = line.split(":")
        for name in names.split():
            schema.add(name, kinds[kind])
    return schema


# Partition column that only exists on disk in the raw layer: which write a
# row came from. It makes a repeated micro-batch replace itself, and lets
# compaction swap a whole write at once.
LOAD_ID = "load_id"


@dataclass(frozen=True)
class TableSpec:
    """One stored table."""

    name: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    keys: tuple[str, ...] = ()
    version: str = "1"

    @property
    def info(self) -> dict[str, object]:
        """What is kept beside the table about it."""
        return {
            "entity": self.name,
            "version": self.version,
            "partition_columns": list(self.partition_by),
        }

    @property
    def stored_schema(self) -> T.StructType:
        """The declared columns plus partition columns known only on disk."""
        schema = T.StructType(list(self.schema.fields))
        for name in self.partition_by:
            if name not in schema.names:
                schema.add(name, T.StringType())
        return schema


RAW_PARTITIONS = ("start_date", LOAD_ID, "route_id")
PROCESSED_PARTITIONS = ("start_date", "route_id")

_VEHICLE_POSITIONS = _struct(
    "ts: poll_time feed_timestamp",
    "str: vehicle_id label license_plate trip_id route_id",
    "int: direction_id schedule_relationship",
    "str: start_date start_time",
    "double: latitude longitude",
    "float: bearing speed",
    "double: odometer",
    "int: occupancy_status",
    "bool: entity_is_deleted",
)
_TRIP_UPDATES = _struct(
    "ts: poll_time feed_timestamp",
    "str: trip_id route_id",
    "int: direction_id schedule_relationship",
    "str: start_date start_time vehicle_id label license_plate",
    "bool: entity_is_deleted",
)
_STOP_TIMES_OBSERVED = _struct(
    "ts: poll_time feed_timestamp",
    "str: trip_id start_date route_id",
    "int: stop_sequence",
    "str: stop_id",
    "int: stop_schedule_relationship arrival_delay",
    "ts: arrival_time",
    "int: arrival_uncertainty departure_delay",
    "ts: departure_time",
    "int: departure_uncertainty",
)

VEHICLE_KEYS = ("vehicle_id", "feed_timestamp")
TRIP_KEYS = ("trip_id", "start_date")
STOP_KEYS = ("trip_id", "start_date", "stop_sequence", "stop_id")

RAW: dict[str, TableSpec] = {
    s.name: s
    for s in (
        TableSpec(
            "vehicle_positions", _VEHICLE_POSITIONS, RAW_PARTITIONS, VEHICLE_KEYS
        ),
        TableSpec("trip_updates", _TRIP_UPDATES, RAW_PARTITIONS, TRIP_KEYS),
        TableSpec("stop_time_updates", _STOP_TIMES_OBSERVED, RAW_PARTITIONS),
    )
}

PROCESSED: dict[str, TableSpec] = {
    s.name: s
    for s in (
        TableSpec(
            "vehicle_positions",
            _VEHICLE_POSITIONS,
            PROCESSED_PARTITIONS,
            VEHICLE_KEYS,
        ),
        TableSpec("trip_updates", _TRIP_UPDATES, PROCESSED_PARTITIONS, TRIP_KEYS),
        TableSpec(
            "stop_time_events",
            _STOP_TIMES_OBSERVED,
            PROCESSED_PARTITIONS,
            STOP_KEYS,
        ),
    )
}


# Columns in which the tables of a layer are shown together, as SQL types.
SHOWN = {
    "poll_time": "timestamp",
    "feed_timestamp": "timestamp",
    "trip_id": "string",
    "route_id": "string",
    "start_date": "string",
    "vehicle_id": "string",
    "label": "string",
    "direction_id": "int",
    "schedule_relationship": "int",
    "start_time": "string",
    "latitude": "double",
    "odometer": "double",
    "stop_sequence": "int",
    "stop_id": "string",
    "arrival_delay": "int",
    "arrival_time": "timestamp",
    "arrival_uncertainty": "int",
    "departure_delay": "int",
    "departure_time": "timestamp",
    "departure_uncertainty": "int",
}


def _unchanged(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class StaticSpec(TableSpec):
    """A table loaded from one member of a static archive.

    ``data_schema`` is what the file holds; ``schema`` adds the version
    columns. ``transform`` runs on the stamped rows before the strict cast.
    """

    data_schema: T.StructType = T.StructType()
    stamp_download: bool = False
    transform: Callable[[DataFrame], DataFrame] = _unchanged

    @property
    def member(self) -> str:
        return f"{self.name}.txt"


VERSION_COLUMNS = ("valid_from", "valid_to")


def static_spec(
    name: str,
    *lines: str,
    stamp_download: bool = False,
    transform: Callable[[DataFrame], DataFrame] = _unchanged,
) -> StaticSpec:
    """A static table: its file's columns, then the version columns."""
    version = ["str: " + " ".join(VERSION_COLUMNS)]
    if stamp_download:
        version.append("ts: downloaded_at")
    return StaticSpec(
        name=name,
        schema=_struct(*lines, *version),
        partition_by=VERSION_COLUMNS,
        data_schema=_struct(*lines),
        stamp_download=stamp_download,
        transform=transform,
    )


STATIC: dict[str, StaticSpec] = {
    s.name: s
    for s in (
        static_spec(
            "agency",
            "str: agency_id agency_name agency_url agency_timezone agency_lang",
            "str: agency_phone agency_fare_url agency_email",
        ),
        static_spec(
            "stops",
            "str: stop_id stop_code stop_name stop_desc",
            "double: stop_lat stop_lon",
            "str: zone_id stop_url",
            "int: location_type",
            "str: parent_station stop_timezone platform_code",
            "int: wheelchair_boarding",
            "str: start_date end_date",
        ),
        static_spec(
            "routes",
            "str: route_id agency_id route_short_name route_long_name route_desc",
            "int: route_type",
            "str: route_url route_color route_text_color",
            "int: route_sort_order",
            "str: contract_id",
        ),
        static_spec(
            "trips",
            "str: route_id service_id trip_id trip_headsign trip_short_name",
            "int: direction_id",
            "str: block_id shape_id",
            "int: wheelchair_accessible bikes_allowed",
        ),
        static_spec(
            "stop_times",
            "str: trip_id arrival_time departure_time stop_id",
            "int: stop_sequence",
            "str: stop_headsign",
            "int: pickup_type drop_off_type",
            "double: shape_dist_traveled",
            "int: timepoint",
        ),
        static_spec(
            "calendar",
            "str: service_id monday tuesday wednesday thursday friday saturday",
            "str: sunday start_date end_date",
        ),
        static_spec(
            "calendar_dates", "str: service_id date", "int: exception_type"
        ),
        static_spec(
            "shapes",
            "str: shape_id",
            "double: shape_pt_lat shape_pt_lon",
            "int: shape_pt_sequence",
            "double: shape_dist_traveled",
        ),
        static_spec(
            "fare_attributes",
            "str: fare_id",
            "double: price",
            "str: currency_type",
            "int: payment_method transfers",
            "str: agency_id",
            "int: transfer_duration",
        ),
        static_spec(
            "fare_rules",
            "str: fare_id route_id origin_id destination_id contains_id",
        ),
        static_spec(
            "frequencies",
            "str: trip_id start_time end_time",
            "int: headway_secs exact_times",
        ),
        static_spec(
            "transfers",
            "str: from_stop_id to_stop_id",
            "int: transfer_type min_transfer_time",
        ),
        static_spec(
            "feed_info",
            "str: feed_publisher_name feed_publisher_url feed_lang",
            "str: feed_start_date feed_end_date feed_version",
            stamp_download=True,
        ),
    )
}

# Instants in the realtime tables, clock times past midnight in the static ones.
MAY_DIFFER = frozenset({"arrival_time", "departure_time"})


def column_types(specs: Iterable[TableSpec]) -> dict[str, T.DataType]:
    """Every column of a group of tables with its one type.

    ValueError if two tables of the group disagree about a column.
    """
    found: dict[str, T.DataType] = {}
    for spec in specs:
        for field in spec.schema.fields:
            if found.setdefault(field.name, field.dataType) != field.dataType:
                raise ValueError(
                    f"{spec.name}.{field.name} is {field.dataType}, elsewhere "
                    f"{found[field.name]}"
                )
    return found


def check_shared_types(
    realtime: dict[str, T.DataType],
    static: dict[str, T.DataType],
    may_differ: Iterable[str] = MAY_DIFFER,
) -> None:
    """ValueError if a shared column differs in type without leave to."""
    shared = realtime.keys() & static.keys()
    clash = sorted(
        n
        for n in shared - set(may_differ)
        if realtime[n] != static[n]
    )
    if clash:
        raise ValueError(f"realtime and static types differ for {clash}")


REALTIME_TYPES = column_types([*RAW.values(), *PROCESSED.values()])
STATIC_TYPES = column_types(STATIC.values())
check_shared_types(REALTIME_TYPES, STATIC_TYPES)


def build_schema(
    names: Iterable[str], types: dict[str, T.DataType]
) -> T.StructType:
    """An ordered schema from column names; KeyError for an unknown one."""
    return T.StructType([T.StructField(n, types[n]) for n in names])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order, in the declared types."""
    return df.select(
        *[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]
    )
