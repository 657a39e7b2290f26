"""The parts of the public GTFS-Realtime message that the tables use.

Field numbers and types are those of the published gtfs-realtime.proto
(version 2.0). Enums are read as int32, which is the same on the wire.
"""

from __future__ import annotations

from functools import cache

# Message -> "number type name", * for a repeated field.
_MESSAGES = {
    "FeedMessage": "2 FeedEntity* entity",
    "FeedEntity": """
        1 string id
        2 bool is_deleted
        3 TripUpdate trip_update
        4 VehiclePosition vehicle
    """,
    "TripUpdate": """
        1 TripDescriptor trip
        2 StopTimeUpdate* stop_time_update
        3 VehicleDescriptor vehicle
        4 uint64 timestamp
    """,
    "StopTimeUpdate": """
        1 uint32 stop_sequence
        2 StopTimeEvent arrival
        3 StopTimeEvent departure
        4 string stop_id
        5 int32 schedule_relationship
    """,
    "StopTimeEvent": """
        1 int32 delay
        2 int64 time
        3 int32 uncertainty
    """,
    "VehiclePosition": """
        1 TripDescriptor trip
        2 Position position
        5 uint64 timestamp
        8 VehicleDescriptor vehicle
        9 int32 occupancy_status
    """,
    "TripDescriptor": """
        1 string trip_id
        2 string start_time
        3 string start_date
        4 int32 schedule_relationship
        5 string route_id
        6 uint32 direction_id
    """,
    "VehicleDescriptor": """
        1 string id
        2 string label
        3 string license_plate
    """,
    "Position": """
        1 float latitude
        2 float longitude
        3 float bearing
        4 double odometer
        5 float speed
    """,
}
_PACKAGE = "transit_realtime"


@cache
def feed_message_class():
    """The FeedMessage class, built once per Python process."""
    try:
        from google.protobuf import (
            descriptor_pb2,
            descriptor_pool,
            message_factory,
        )
    except ImportError as missing:  # pragma: no cover
        raise ImportError(
            "decoding feeds needs the 'protobuf' package on the executors"
        ) from missing

    field_type = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(
        name="headway/feed.proto", package=_PACKAGE, syntax="proto2"
    )
    for message, fields in _MESSAGES.items():
        described = file.message_type.add(name=message)
        for line in filter(None, map(str.strip, fields.splitlines())):
            number, kind, name = line.split()
            many = kind.endswith("*")
            kind = kind.rstrip("*")
            field = described.field.add(
                name=name,
                number=int(number),
                label=(
                    field_type.LABEL_REPEATED
                    if many
                    else field_type.LABEL_OPTIONAL
                ),
            )
            if kind in _MESSAGES:
                field.type = field_type.TYPE_MESSAGE
                field.type_name = f".{_PACKAGE}.{kind}"
            else:
                field.type = getattr(field_type, f"TYPE_{kind.upper()}")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(
        pool.FindMessageTypeByName(f"{_PACKAGE}.FeedMessage")
    )
