"""ANSI SQL with the same results as the registered queries."""

from __future__ import annotations

from dataclasses import replace

from headway.adapters import (
    STATIC_FROM,
    STATIC_KEYS,
    STATIC_SPOILED,
    static_expressions,
    static_line,
    year_of,
)
from headway.schemas import PROCESSED, RAW, SHOWN, STATIC, TableSpec

# The adapter views as common table expressions, down to the column order.
_EVENTS = """
e AS (
    SELECT event_id, event_type, value, user_id,
        date_trunc('second', ts) AS sec,
        CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hr,
        strftime(ts, '%Y%m%d') AS start_date,
        strftime(ts, '%H:%M:%S') AS start_time,
        CAST(user_id AS VARCHAR) AS usr,
        CAST(CASE WHEN event_type = 'error' THEN 3 ELSE 0 END AS INTEGER) AS rel,
        CAST(user_id % 2 AS INTEGER) AS dir
    FROM events
)"""
_POSITIONS = f"""{_EVENTS},
vp AS (
    SELECT sec AS poll_time, hr AS feed_timestamp, usr AS vehicle_id,
        CAST(event_id AS VARCHAR) AS label,
        CAST(NULL AS VARCHAR) AS license_plate, usr AS trip_id,
        event_type AS route_id, dir AS direction_id,
        rel AS schedule_relationship, start_date, start_time,
        value AS latitude, -value AS longitude,
        CAST(0 AS FLOAT) AS bearing, CAST(0 AS FLOAT) AS speed,
        value AS odometer, CAST(0 AS INTEGER) AS occupancy_status,
        FALSE AS entity_is_deleted
    FROM e
)"""
_TRIPS = f"""{_EVENTS},
tu AS (
    SELECT sec AS poll_time, sec AS feed_timestamp, usr AS trip_id,
        event_type AS route_id, dir AS direction_id,
        rel AS schedule_relationship, start_date, start_time,
        usr AS vehicle_id, CAST(event_id AS VARCHAR) AS label,
        CAST(NULL AS VARCHAR) AS license_plate, FALSE AS entity_is_deleted
    FROM e
)"""
_STOPS = """
stu AS (
    SELECT l_shipdate AS poll_time, l_shipdate AS feed_timestamp,
        CAST(l_orderkey AS VARCHAR) AS trip_id,
        strftime(l_shipdate, '%Y') || '0101' AS start_date,
        'R' || CAST(l_suppkey % 20 AS VARCHAR) AS route_id,
        l_linenumber AS stop_sequence,
        'S' || CAST(l_linenumber AS VARCHAR) AS stop_id,
        CAST(0 AS INTEGER) AS stop_schedule_relationship,
        CAST(l_quantity AS INTEGER) AS arrival_delay,
        CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS arrival_time,
        CASE WHEN l_returnflag = 'N' THEN 120 ELSE 0 END
            AS arrival_uncertainty,
        CAST(l_quantity AS INTEGER) - 25 AS departure_delay,
        l_shipdate + INTERVAL 1 MINUTE AS departure_time,
        CASE WHEN l_linestatus = 'O' THEN 120 ELSE 0 END
            AS departure_uncertainty
    FROM lineitem
)"""

_SEEN = "arrival_time IS NOT NULL AND arrival_uncertainty = 0"
_LEFT = "departure_time IS NOT NULL AND departure_uncertainty = 0"
_MERGED = f"""
    SELECT max(poll_time) AS poll_time, max(feed_timestamp) AS feed_timestamp,
        trip_id, start_date, max(route_id) AS route_id, stop_sequence, stop_id,
        max(stop_schedule_relationship) AS stop_schedule_relationship,
        max(arrival_delay) FILTER (WHERE {_SEEN}) AS arrival_delay,
        max(arrival_time) FILTER (WHERE {_SEEN}) AS arrival_time,
        max(arrival_uncertainty) FILTER (WHERE {_SEEN}) AS arrival_uncertainty,
        max(departure_delay) FILTER (WHERE {_LEFT}) AS departure_delay,
        max(departure_time) FILTER (WHERE {_LEFT}) AS departure_time,
        max(departure_uncertainty) FILTER (WHERE {_LEFT})
            AS departure_uncertainty
    FROM stu GROUP BY trip_id, start_date, stop_sequence, stop_id"""

_LATEST_TRIPS = """
    SELECT * FROM tu QUALIFY row_number() OVER (
        PARTITION BY trip_id, start_date
        ORDER BY feed_timestamp DESC, poll_time DESC, route_id DESC,
            direction_id DESC, schedule_relationship DESC, start_time DESC,
            vehicle_id DESC, label DESC) = 1"""


def _deduped(keys: str) -> str:
    return f"""
    SELECT * FROM vp QUALIFY row_number() OVER (
        PARTITION BY {keys} ORDER BY poll_time DESC, label DESC) = 1"""


_SKIP = """
    SELECT user_id, ts, event_id, event_type FROM (
        SELECT *, lag(event_type) OVER (
            PARTITION BY user_id ORDER BY ts, event_id) AS before_it
        FROM events)
    WHERE before_it IS NULL OR before_it <> event_type"""

# Entities as the adapter leaves them, before the flattening rules.
_ENTITIES = f"""{_EVENTS},
fresh AS (
    SELECT *,
        CASE WHEN dir = 1 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS lbl,
        CASE WHEN event_type = 'signup' THEN 'UNKNOWN' ELSE start_date END AS d,
        CASE WHEN event_type = 'view' THEN 'NA' ELSE event_type END AS route
    FROM e WHERE abs(epoch(sec) - epoch(hr)) <= 900
)"""

# What the payload adapter's vehicles, trips and stops come out as.
_FRESH = f"""{_EVENTS},
fresh AS (SELECT * FROM e WHERE abs(epoch(sec) - epoch(hr)) <= 900)"""


def _polled(poll: str) -> str:
    """Events that are fresh when a payload is polled, and 30 minutes later."""
    return f"""{_EVENTS},
polled AS (
    SELECT *, {poll} + m * INTERVAL 1 MINUTE AS poll
    FROM e CROSS JOIN (VALUES (0), (30)) AS t(m)
),
fresh AS (SELECT * FROM polled WHERE abs(epoch(sec) - epoch(poll)) <= 900)"""


_KINDS = """(VALUES
    ('vehicle_positions', NULL), ('trip_updates', NULL),
    ('stop_time_updates', 'first'), ('stop_time_updates', 'second')
) AS k(table_name, stop_id)"""
_INGESTED = f"""
WITH {_polled("hr")}
SELECT k.table_name, poll AS poll_time, sec AS feed_timestamp, usr AS trip_id,
    event_type AS route_id, start_date,
    CASE WHEN k.stop_id IS NULL THEN CAST(event_id AS VARCHAR) END AS label,
    k.stop_id,
    CASE WHEN k.stop_id = 'first' THEN sec END AS arrival_time
FROM fresh CROSS JOIN {_KINDS}"""
_COUNTED = f"""
WITH {_polled("date_trunc('day', hr) + INTERVAL 12 HOUR")},
kinds AS (SELECT * FROM {_KINDS})
SELECT table_name, (SELECT count(*) FROM fresh) * count(*) AS n_rows
FROM kinds GROUP BY table_name"""

_SQL_TYPES = {
    "timestamp": "TIMESTAMP",
    "string": "VARCHAR",
    "int": "INTEGER",
    "double": "DOUBLE",
}


def _shown(*tables: tuple[TableSpec, str]) -> str:
    """Rows of several tables under the columns that any of them has."""
    parts = []
    for spec, source in tables:
        columns = ", ".join(
            n if n in spec.schema.names else f"CAST(NULL AS {_SQL_TYPES[kind]}) AS {n}"
            for n, kind in SHOWN.items()
        )
        parts.append(f"SELECT '{spec.name}' AS table_name, {columns} FROM {source}")
    return " UNION ALL ".join(parts)


def _static() -> str:
    """The static tables as they stand, and the ledger."""
    parts = []
    for name, (source, _) in STATIC_FROM.items():
        types = {f.name: f.dataType.simpleString() for f in STATIC[name].data_schema}
        rows = f"(SELECT *, {year_of(source)} AS year FROM {source})"
        if source == "region":
            rows = "(SELECT r.*, y.year FROM region r, archive_years y)"
        for mark, start, end in (("B", "0101", "0630"), ("D", "0701", "1231")):
            if (name, mark) == ("routes", "D"):
                continue  # its header is bad
            valid_from, valid_to = (
                f"concat(CAST(year AS STRING), '{day}')" for day in (start, end)
            )
            given = static_expressions(name, mark, valid_from, valid_to)
            cells = ", ".join(
                f"coalesce(CAST(CAST({e} AS {types[n]}) AS VARCHAR), '')"
                for n, e in given.items()
            )
            parts.append(
                f"SELECT '{name}' AS table_name, {valid_from} AS valid_from, "
                f"{valid_to} AS valid_to, concat_ws('|', {cells}) AS contents "
                f"FROM {rows}"
            )
    # The newest archive is the one before only where there is one a year.
    parts.append(
        """
        SELECT 'load_ledger' AS table_name,
            CASE WHEN one AND mark = 'c' THEN NULL ELSE year || '0101' END AS valid_from,
            CASE WHEN one AND mark = 'c' THEN NULL ELSE year || '0630' END AS valid_to,
            mark || '-' || year || '.zip|' || CASE WHEN one AND mark = 'c' THEN 'unchanged'
                ELSE version || '|loaded' END AS contents
        FROM archive_years, (SELECT count(*) = 1 AS one FROM archive_years),
            (VALUES ('a', 'A'), ('b', 'B'), ('c', 'B')) t(mark, version)
        UNION ALL
        SELECT 'downloaded_at', year || span[1], year || span[2], 'true'
        FROM archive_years, (VALUES (['0101', '0630']), (['0701', '1231'])) t(span)
        """
    )
    keys = " UNION ALL ".join(
        f"SELECT {year_of(source)} AS year FROM {source}" for source in STATIC_KEYS
    )
    return f"""
        WITH archive_years AS (
            SELECT unnest(range(2024, 1 + CAST(max(year) AS BIGINT))) AS year FROM ({keys})
        )
        {" UNION ALL ".join(parts)}"""


def _static_rejects() -> str:
    """Spoiled cells that do not parse, at their places in the sorted files."""
    parts = []
    for (name, column), cell in STATIC_SPOILED.items():
        source, _ = STATIC_FROM[name]
        given = static_expressions(name, "Q", "''", "''")
        given |= {c: e for (n, c), e in STATIC_SPOILED.items() if n == name}
        kind = STATIC[name].data_schema[column].dataType.simpleString()
        number = "TRY_CAST(cell AS DOUBLE)"
        bad = f"{number} IS NULL"
        if kind == "int":
            bad = f"({bad} OR floor({number}) <> {number})"
        parts.append(f"""
            SELECT 'q-' || CAST(year AS VARCHAR) || '.zip' AS archive,
                '{name}.txt' AS member, line_no, '{column}' AS column_name,
                cell AS text, 'cannot read as {kind}' AS reason
            FROM (
                SELECT *, row_number() OVER (PARTITION BY year ORDER BY line) AS line_no
                FROM (
                    SELECT {year_of(source)} AS year, {cell} AS cell,
                        {static_line(given)} AS line
                    FROM {source}
                )
            )
            WHERE cell <> '' AND cell <> 'n/a' AND {bad}""")
    return " UNION ALL ".join(parts)


def _after(view: str) -> str:
    """What retention leaves, seven days before 2024-01-16."""
    return f"(SELECT * FROM {view} WHERE start_date >= '20240109')"


# Order lines as stop updates of January 2024.
_JANUARY = """
january AS (
    SELECT * REPLACE ('202401' || strftime(poll_time, '%d') AS start_date,
        strptime('202401' || strftime(poll_time, '%d'), '%Y%m%d') + to_seconds(
            (CAST(trip_id AS BIGINT) * 7919 + stop_sequence * 613) % 86400)
            AS poll_time,
        'J' || CAST(stop_sequence % 2 AS VARCHAR) AS route_id)
    FROM stu
)"""
# The raw tables as they land in four parts by poll time, a tenth of the rows one
# part late; a date closes four hours after its end, by the polls landed before.
_LANDED = f"""{_POSITIONS}, {_TRIPS.removeprefix(_EVENTS + ",")}, {_STOPS}, {_JANUARY},
span AS (
    SELECT epoch_us(min(poll_time)) AS low,
        epoch_us(max(poll_time)) - epoch_us(min(poll_time)) + 1 AS width
    FROM vp
),
{{landed}}
polls AS (
    SELECT landing, poll_time FROM vp_landed
    UNION ALL SELECT landing, poll_time FROM tu_landed
    UNION ALL SELECT landing, poll_time FROM stu_landed
),
clock AS (
    SELECT k AS landing, (SELECT max(poll_time) FROM polls p WHERE p.landing <= k) AS newest
    FROM range(4) t(k)
)"""
_LANDED = _LANDED.format(
    landed="".join(
        f"""{name}_landed AS (
    SELECT v.*, least(3, greatest(0, CAST(floor(
            CAST((epoch_us(poll_time) - low) * 4 AS DOUBLE) / width) AS INTEGER))
        + CASE WHEN CAST({number} AS BIGINT) % 10 = 0 THEN 1 ELSE 0 END) AS landing
    FROM {view} v, span
),
"""
        for name, view, number in (
            ("vp", "vp", "label"),
            ("tu", "tu", "label"),
            ("stu", "january", "trip_id"),
        )
    )
)
_CLOSES = "strptime(start_date, '%Y%m%d') + INTERVAL 28 HOUR"


def _closed(name: str) -> str:
    """Rows of dates that have closed in the end."""
    at = "(SELECT newest FROM clock WHERE landing = 3)"
    return f"SELECT * EXCLUDE (landing) FROM {name}_landed WHERE {_CLOSES} <= {at}"


def _late(name: str) -> str:
    """Rows whose date had closed before they landed."""
    before = f"(SELECT newest FROM clock c WHERE c.landing = {name}_landed.landing - 1)"
    return f"(SELECT * FROM {name}_landed WHERE {_CLOSES} <= {before})"


def _layer() -> str:
    """The processed tables of closed dates, and the late rows."""
    late = [replace(RAW[t], name=f"late_{t}") for t in RAW]
    names = ("vp", "tu", "stu")
    return f"""
        WITH {_LANDED},
        vp1 AS (SELECT * FROM ({_closed("vp")}) QUALIFY row_number() OVER (
            PARTITION BY vehicle_id, feed_timestamp, start_date
            ORDER BY poll_time DESC, label DESC) = 1),
        tu1 AS ({_LATEST_TRIPS.replace("FROM tu ", f"FROM ({_closed('tu')}) ")}),
        stu1 AS ({_MERGED.replace("FROM stu ", f"FROM ({_closed('stu')}) ")})
        {_shown(
            (PROCESSED["vehicle_positions"], "vp1"),
            (PROCESSED["trip_updates"], "tu1"),
            (PROCESSED["stop_time_events"], "stu1"),
            *[(spec, _late(n)) for spec, n in zip(late, names)],
        )}"""


def _landing_counts() -> str:
    parts = [
        f"SELECT landing AS batch_id, '{table}' AS table_name, poll_time FROM {n}_landed"
        for table, n in zip(RAW, ("vp", "tu", "stu"))
    ]
    return f"""
        WITH {_LANDED}
        SELECT CAST(batch_id AS BIGINT) AS batch_id, table_name, count(*) AS n_rows,
            min(poll_time) AS first_poll, max(poll_time) AS last_poll
        FROM ({" UNION ALL ".join(parts)}) GROUP BY batch_id, table_name"""


_AGENCY = """
SELECT CAST(c_custkey AS VARCHAR) AS agency_id, {name} AS agency_name,
    CAST(NULL AS VARCHAR) AS agency_url, CAST(NULL AS VARCHAR) AS agency_timezone,
    c_mktsegment AS agency_lang, CAST(NULL AS VARCHAR) AS agency_phone,
    CAST(NULL AS VARCHAR) AS agency_fare_url, CAST(NULL AS VARCHAR) AS agency_email,
    '20240101' AS valid_from, '{end}' AS valid_to
FROM customer {where}"""

ORACLES: dict[str, str] = {
    "merge_stop_events": f"WITH {_STOPS} {_MERGED}",
    "dedupe_positions": (
        f"WITH {_POSITIONS} {_deduped('vehicle_id, feed_timestamp')}"
    ),
    "latest_trip_state": f"WITH {_TRIPS} {_LATEST_TRIPS}",
    "dedupe_lineitem": """
        SELECT * FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
                l_quantity DESC, l_extendedprice DESC, l_discount DESC,
                l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
    "stale_filter": """
        SELECT event_id, ts FROM events
        WHERE abs(epoch(date_trunc('second', ts))
            - epoch(date_trunc('hour', ts))) <= 900""",
    "consecutive_skip": _SKIP,
    "stream_skip": f"SELECT user_id, event_id FROM ({_SKIP})",
    "normalise_defaults": """
        SELECT event_id, nullif(event_type, 'error') AS label,
            CASE WHEN event_type = 'error' THEN 'UNKNOWN' ELSE event_type END
                AS start_date,
            CASE WHEN event_type = 'error' THEN 'NA' ELSE event_type END
                AS route_id,
            CAST(nullif(event_id % 3, 0) AS INTEGER) AS event_time,
            CAST(event_id % 3 AS INTEGER) AS delay
        FROM events""",
    "flatten_vehicles": f"""
        WITH {_ENTITIES}
        SELECT hr AS poll_time, sec AS feed_timestamp, usr AS vehicle_id,
            lbl AS label, CAST(NULL AS VARCHAR) AS license_plate,
            usr AS trip_id, route AS route_id, dir AS direction_id,
            rel AS schedule_relationship, d AS start_date,
            CAST(NULL AS VARCHAR) AS start_time,
            CAST(CAST(value AS FLOAT) AS DOUBLE) AS latitude,
            CAST(CAST(value AS FLOAT) AS DOUBLE) AS longitude,
            CAST(0 AS FLOAT) AS bearing, CAST(0 AS FLOAT) AS speed,
            value AS odometer, CAST(0 AS INTEGER) AS occupancy_status,
            FALSE AS entity_is_deleted
        FROM fresh WHERE event_type <> 'error'""",
    "flatten_trips": f"""
        WITH {_ENTITIES}
        SELECT hr AS poll_time, sec AS feed_timestamp, usr AS trip_id,
            route AS route_id, dir AS direction_id,
            rel AS schedule_relationship, d AS start_date,
            CAST(NULL AS VARCHAR) AS start_time, usr AS vehicle_id,
            lbl AS label, CAST(NULL AS VARCHAR) AS license_plate,
            FALSE AS entity_is_deleted
        FROM fresh WHERE event_type = 'error'""",
    "explode_nested": """
        WITH stops AS (
            SELECT vec_id, label, unnest(embedding) AS x,
                generate_subscripts(embedding, 1) - 1 AS i
            FROM embeddings)
        SELECT make_timestamp(1700000000000000) AS poll_time,
            make_timestamp(1700000000000000) AS feed_timestamp,
            CAST(vec_id AS VARCHAR) AS trip_id, '20231114' AS start_date,
            'R' || CAST(label AS VARCHAR) AS route_id,
            CAST(i + 1 AS INTEGER) AS stop_sequence,
            'S' || CAST(i AS VARCHAR) AS stop_id,
            CAST(0 AS INTEGER) AS stop_schedule_relationship,
            CAST(round(x * CAST(1000 AS FLOAT)) AS INTEGER) AS arrival_delay,
            CASE WHEN x > 0 THEN make_timestamp((1700000000 + i) * 1000000) END
                AS arrival_time,
            CAST(0 AS INTEGER) AS arrival_uncertainty,
            CAST(0 AS INTEGER) AS departure_delay,
            CAST(NULL AS TIMESTAMP) AS departure_time,
            CAST(0 AS INTEGER) AS departure_uncertainty
        FROM stops""",
    "entity_counts": """
        SELECT CASE WHEN event_type = 'error' THEN 'trip_update'
            ELSE 'vehicle' END AS kind, count(*) AS entities
        FROM events GROUP BY 1""",
    "target_date": """
        SELECT event_id,
            strftime(CAST((ts AT TIME ZONE 'UTC')
                AT TIME ZONE 'Pacific/Auckland' AS TIMESTAMP)
                - INTERVAL 1 DAY, '%Y%m%d') AS target_date,
            strftime(ts - INTERVAL 7 DAY, '%Y%m%d') AS cutoff
        FROM events""",
    "content_hash": """
        SELECT md5(text) AS content_hash, min(doc_id) AS doc_id
        FROM documents GROUP BY 1""",
    "json_state": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
            '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR)
                || ',"user_id":' || CAST(user_id AS VARCHAR) || '}' AS state
        FROM events""",
    "partition_scan": f"""
        WITH {_POSITIONS}
        SELECT vehicle_id, latitude FROM vp WHERE route_id = 'error'""",
    "replace_date": f"""
        WITH {_POSITIONS}
        SELECT * FROM vp
        WHERE start_date = '20240101' OR route_id = 'purchase'""",
    "replace_version": " UNION ALL ".join(
        [
            _AGENCY.format(name="c_name", end="20241231", where=""),
            _AGENCY.format(
                name="upper(c_name)",
                end="20240630",
                where="WHERE c_mktsegment <> 'BUILDING'",
            ),
        ]
    ),
    "retention": f"WITH {_POSITIONS} SELECT * FROM {_after('vp')}",
    "compaction": f"WITH {_POSITIONS} SELECT * FROM vp",
    "maintenance_job": f"""
        WITH {_POSITIONS}, {_TRIPS.removeprefix(_EVENTS + ",")}, {_STOPS},
        moved AS (SELECT * REPLACE (
            '202401' || strftime(poll_time, '%d') AS start_date) FROM stu)
        {_shown(
            (RAW["vehicle_positions"], _after("vp")),
            (RAW["trip_updates"], _after("tu")),
            (RAW["stop_time_updates"], _after("moved")),
        )}""",
    "daily_job": f"""
        WITH {_POSITIONS}, {_TRIPS.removeprefix(_EVENTS + ",")}, {_STOPS},
        vp1 AS ({_deduped("vehicle_id, feed_timestamp, start_date")}),
        tu1 AS ({_LATEST_TRIPS}), stu1 AS ({_MERGED})
        {_shown(
            (PROCESSED["vehicle_positions"], "vp1"),
            (PROCESSED["trip_updates"], "tu1"),
            (PROCESSED["stop_time_events"], "stu1"),
        )}""",
    "csv_static_load": """
        SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS trip_id,
            CAST(20 + l_linenumber AS VARCHAR) || ':10:00' AS arrival_time,
            CAST(20 + l_linenumber AS VARCHAR) || ':11:00' AS departure_time,
            CAST(l_partkey AS VARCHAR) AS stop_id,
            l_linenumber AS stop_sequence,
            l_returnflag || ', "' || l_linestatus || '"' AS stop_headsign,
            CASE WHEN CAST(l_quantity AS INTEGER) > 25
                THEN CAST(l_quantity AS INTEGER) END AS pickup_type,
            CAST(0 AS INTEGER) AS drop_off_type,
            l_discount AS shape_dist_traveled, CAST(1 AS INTEGER) AS timepoint,
            '20240101' AS valid_from, '20240630' AS valid_to
        FROM lineitem""",
    "static_job": _static(),
    "static_rejects": _static_rejects(),
    "feed_decode": f"""
        WITH {_FRESH}
        SELECT hr AS poll_time, sec AS feed_timestamp, usr AS vehicle_id,
            CAST(event_id AS VARCHAR) AS label,
            CAST(NULL AS VARCHAR) AS license_plate, event_type AS route_id,
            dir AS direction_id, rel AS schedule_relationship, start_date,
            CAST(NULL AS VARCHAR) AS start_time,
            CAST(CAST(value AS FLOAT) AS DOUBLE) AS latitude,
            CAST(CAST(-value AS FLOAT) AS DOUBLE) AS longitude,
            CAST(0 AS FLOAT) AS bearing, FALSE AS entity_is_deleted
        FROM fresh""",
    "stream_ingest": _INGESTED,
    "batch_ingest": _INGESTED,
    "ingest_counts": _COUNTED,
    "continuous_layer": _layer(),
    "incremental_merge": (
        f"WITH {_STOPS}, {_JANUARY} {_MERGED.replace('FROM stu ', 'FROM january ')}"
    ),
    "observed_counts": _landing_counts(),
    "version_as_of": """
        WITH v(valid_from, valid_to) AS (VALUES
            ('19950101', '19971231'), ('19970701', '20001231')),
        facts AS (
            SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS agency_id,
                strftime(o_orderdate, '%Y%m%d') AS start_date
            FROM orders),
        dated AS (
            SELECT f.*, v.valid_from, v.valid_to FROM facts f LEFT JOIN v
                ON f.start_date BETWEEN v.valid_from AND v.valid_to
            QUALIFY row_number() OVER (
                PARTITION BY o_orderkey ORDER BY v.valid_from DESC) = 1)
        SELECT d.agency_id, d.valid_from, d.valid_to, d.start_date,
            d.o_orderkey, c_name || '/' || d.valid_from AS agency_name
        FROM dated d LEFT JOIN customer
            ON CAST(c_custkey AS VARCHAR) = d.agency_id
            AND d.valid_from IS NOT NULL""",
    "events_with_trip": f"""
        WITH {_STOPS}, merged AS ({_MERGED}),
        trips AS (
            SELECT CAST(o_orderkey AS VARCHAR) AS trip_id,
                strftime(o_orderdate, '%Y') || '0101' AS start_date,
                CAST(CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 0 END AS INTEGER)
                    AS rel,
                CAST(o_custkey AS VARCHAR) AS veh, o_orderdate AS placed
            FROM orders
            QUALIFY row_number() OVER (
                PARTITION BY trip_id, start_date
                ORDER BY placed DESC, rel DESC, veh DESC) = 1)
        SELECT m.*, t.rel AS trip_schedule_relationship,
            t.veh AS trip_vehicle_id, t.placed AS trip_feed_timestamp
        FROM merged m LEFT JOIN trips t USING (trip_id, start_date)""",
}
