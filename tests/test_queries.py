"""Registered queries against their SQL, on the smallest test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from headway.queries import registered
from headway.query_sql import ORACLES

SF = Path("/root/testdata/sf0.001")
# The others write tables and have tests of their own.
READ_ONLY = [
    "merge_stop_events",
    "dedupe_positions",
    "latest_trip_state",
    "dedupe_lineitem",
    "stale_filter",
    "consecutive_skip",
    "normalise_defaults",
    "flatten_vehicles",
    "flatten_trips",
    "explode_nested",
    "entity_counts",
    "target_date",
    "content_hash",
    "json_state",
    "csv_static_load",
    "feed_decode",
    "version_as_of",
    "events_with_trip",
]
needs_data = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(
            f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'"
        )
    return connection


def canonical(table):
    names = sorted(table.column_names)
    rows = zip(*[table.column(n).to_pylist() for n in names])
    return names, sorted(map(repr, rows))


def test_every_query_has_sql():
    assert registered().keys() == ORACLES.keys()
    assert driver.queries().keys() >= registered().keys()
    assert driver.oracle_sql().items() >= ORACLES.items()


@needs_data
@pytest.mark.parametrize("name", READ_ONLY)
def test_query_equals_sql(spark, duck, name):
    got = driver.queries()[name](spark, str(SF)).toArrow()
    want = duck.execute(driver.oracle_sql()[name]).to_arrow_table()
    assert canonical(got) == canonical(want)
    assert got.num_rows > 0


@needs_data
def test_entry(spark):
    assert driver.entry(spark).columns[:3] == [
        "poll_time",
        "feed_timestamp",
        "trip_id",
    ]
