import pytest
from pyspark.sql import types as T

from headway.schemas import (
    PROCESSED,
    RAW,
    REALTIME_TYPES,
    STATIC,
    STATIC_TYPES,
    TableSpec,
    build_schema,
    check_shared_types,
    column_types,
)


def test_table_sizes():
    assert {n: len(s.schema) for n, s in RAW.items()} == {
        "vehicle_positions": 18,
        "trip_updates": 12,
        "stop_time_updates": 14,
    }
    assert len(PROCESSED["stop_time_events"].schema) == 14
    assert {n: len(s.schema) for n, s in STATIC.items()} == {
        "agency": 10,
        "stops": 17,
        "routes": 13,
        "trips": 12,
        "stop_times": 12,
        "calendar": 12,
        "calendar_dates": 5,
        "shapes": 7,
        "fare_attributes": 9,
        "fare_rules": 7,
        "frequencies": 7,
        "transfers": 6,
        "feed_info": 9,
    }


def test_types_that_matter():
    assert REALTIME_TYPES["arrival_time"] == T.TimestampType()
    assert STATIC_TYPES["arrival_time"] == T.StringType()
    assert REALTIME_TYPES["start_date"] == T.StringType()
    assert REALTIME_TYPES["bearing"] == T.FloatType()
    assert REALTIME_TYPES["latitude"] == T.DoubleType()


def test_build_schema():
    schema = build_schema(["stop_id", "poll_time"], REALTIME_TYPES)
    assert schema.names == ["stop_id", "poll_time"]
    with pytest.raises(KeyError):
        build_schema(["no_such_column"], REALTIME_TYPES)


def test_shared_columns_must_agree():
    check_shared_types(REALTIME_TYPES, STATIC_TYPES)
    with pytest.raises(ValueError, match="arrival_time"):
        check_shared_types(REALTIME_TYPES, STATIC_TYPES, may_differ=())


def test_tables_of_a_group_must_agree():
    text = T.StructType([T.StructField("x", T.StringType())])
    number = T.StructType([T.StructField("x", T.IntegerType())])
    with pytest.raises(ValueError, match="b.x"):
        column_types([TableSpec("a", text, ()), TableSpec("b", number, ())])
