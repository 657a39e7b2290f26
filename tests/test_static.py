import logging
import os
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway import adapters
from headway.plans.static import Landed, run_static, settle
from headway.schemas import STATIC, static_spec
from headway.sources.archive import FeedInfo, csv_records, plain_cells
from headway.sources.checked import read_rejects
from headway.sources.ledger import Ledger
from headway.store import Store
from headway.tables import read_table

SMALL = ("routes", "stop_times", "feed_info")

ROUTES = '''route_id,agency_id,route_short_name,route_long_name,route_desc,\
route_type,route_url,route_color,route_text_color,route_sort_order,contract_id
0123,A1,1,"City, ""Link""",,3,,,,,
'''
STOP_TIMES = """trip_id,arrival_time,departure_time,stop_id,stop_sequence,\
stop_headsign,pickup_type,drop_off_type,shape_dist_traveled,timepoint
t1,25:10:00,25:11:00,0007,1,"two
lines",0,0,1.5,1

t1,25:20:00,25:21:00,8,2,,NA,,,1
"""


def info(start="20260101", end="20260630", version="v1"):
    return (
        "feed_publisher_name,feed_publisher_url,feed_lang,feed_start_date,"
        f"feed_end_date,feed_version\nP,http://p,en,{start},{end},{version}\n"
    )


def archive(landing, name, hour=0, **members):
    """A zip file landed at an hour; a member given as None is left out."""
    os.makedirs(landing, exist_ok=True)
    files = {"routes": ROUTES, "stop_times": STOP_TIMES, "feed_info": info()}
    path = f"{landing}/{name}.zip"
    with zipfile.ZipFile(path, "w") as zipped:
        for member, text in {**files, **members}.items():
            if text is not None:
                zipped.writestr(
                    zipfile.ZipInfo(f"{member}.txt"), text
                )
    os.utime(path, (1_767_225_600 + hour * 3600,) * 2)
    return path


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "static")


def run(spark, landing, root, **options):
    done = run_static(spark, landing, root, SMALL, **options)
    return {os.path.basename(k): v for k, v in done.items()}


def table(spark, root, name):
    return read_table(spark, root, STATIC[name])


def statuses(spark, root):
    ledger = Ledger(spark, root).read().orderBy("recorded_at")
    return [(os.path.basename(r.archive), r.status) for r in ledger.collect()]


def test_load(spark, landing, root):
    archive(landing, "a")
    assert run(spark, landing, root) == {
        "a.zip": {"routes.txt": 1, "stop_times.txt": 2, "feed_info.txt": 1}
    }
    (route,) = table(spark, root, "routes").collect()
    assert route.route_id == "0123"
    assert route.route_long_name == 'City, "Link"'
    assert (route.route_type, route.route_sort_order) == (3, None)
    assert (route.valid_from, route.valid_to) == ("20260101", "20260630")
    assert route.route_desc is None
    first, second = (
        table(spark, root, "stop_times").orderBy("stop_sequence").collect()
    )
    assert (first.arrival_time, first.stop_id) == ("25:10:00", "0007")
    assert first.stop_headsign == "two\nlines"
    assert (second.pickup_type, second.shape_dist_traveled) == (None, None)
    (about,) = (
        table(spark, root, "feed_info")
        .select("feed_version", F.unix_seconds("downloaded_at").alias("s"))
        .collect()
    )
    assert (about.feed_version, about.s) == ("v1", 1_767_225_600)
    assert Store(spark, root).child_dirs(f"{root}/_staging") == []


def test_known_and_unchanged_archives(spark, landing, root):
    archive(landing, "a")
    run(spark, landing, root)
    assert run(spark, landing, root) == {}
    archive(landing, "b", hour=1)
    assert run(spark, landing, root) == {}
    assert statuses(spark, root) == [("a.zip", "loaded"), ("b.zip", "unchanged")]
    # Only the archive before counts: c differs, d is a again.
    archive(landing, "c", hour=2, routes=ROUTES.replace("0123", "0456"))
    archive(landing, "d", hour=3)
    assert list(run(spark, landing, root)) == ["c.zip", "d.zip"]
    assert [r.route_id for r in table(spark, root, "routes").collect()] == ["0123"]


def test_versions_and_corrections(spark, landing, root):
    archive(landing, "a")
    archive(landing, "b", hour=1, feed_info=info(end="20261231"))
    archive(landing, "c", hour=2, routes=ROUTES.replace("0123", "0456"))
    run(spark, landing, root)
    rows = table(spark, root, "routes").collect()
    assert sorted((r.valid_to, r.route_id) for r in rows) == [
        ("20260630", "0456"),
        ("20261231", "0123"),
    ]


@pytest.mark.parametrize(
    "routes, reason",
    [
        (None, "missing"),
        ("", "empty"),
        (ROUTES.replace("route_id,agency_id", "agency_id,route_id"), "not"),
        (ROUTES.replace("route_sort_order,", ""), "not"),
        (ROUTES.replace("contract_id", "contract_id,extra"), "not"),
        (ROUTES.replace(",3,", ",bus,"), "cannot read as int"),
        (ROUTES + "0456,too,few\n", "MALFORMED"),
        (b"\xff\xfe\xfa", "utf-8"),
    ],
)
def test_a_bad_table_keeps_the_archive_open(
    spark, landing, root, caplog, routes, reason
):
    archive(landing, "a", routes=routes)
    with caplog.at_level(logging.ERROR):
        done = run(spark, landing, root)["a.zip"]
    assert done == {"stop_times.txt": 2, "feed_info.txt": 1}
    assert reason in caplog.text
    assert statuses(spark, root) == []
    # The next run takes the repaired archive, and loads nothing twice.
    archive(landing, "a", hour=1)
    assert len(run(spark, landing, root)["a.zip"]) == 3
    assert table(spark, root, "stop_times").count() == 2


def test_a_retried_archive_never_replaces_a_later_one(spark, landing, root):
    archive(landing, "a", stop_times="wrong\n", routes=ROUTES.replace("0123", "OLD"))
    archive(landing, "b", hour=1, routes=ROUTES.replace("0123", "NEW"))
    for _ in range(3):
        run(spark, landing, root)
        rows = table(spark, root, "routes").collect()
        assert [r.route_id for r in rows] == ["NEW"]
    assert sorted(statuses(spark, root)) == [("a.zip", "superseded"), ("b.zip", "loaded")]
    # Another validity is another version: the old archive may still fill it.
    archive(landing, "c", hour=0, feed_info=info(end="20261231"))
    assert list(run(spark, landing, root)) == ["c.zip"]


@pytest.mark.parametrize(
    "text", [None, "", info().splitlines()[0] + "\n", info(start="")]
)
def test_no_validity_no_load(spark, landing, root, text):
    archive(landing, "a", feed_info=text)
    assert run(spark, landing, root) == {}
    assert statuses(spark, root) == []


def test_not_a_zip_does_not_stop_others(spark, landing, root):
    archive(landing, "a")
    path = f"{landing}/b.zip"
    with open(path, "wb") as file:
        file.write(b"not a zip")
    assert list(run(spark, landing, root)) == ["a.zip"]
    assert statuses(spark, root) == [("a.zip", "loaded")]


def test_header_only_version_is_empty(spark, landing, root):
    archive(landing, "a")
    run(spark, landing, root)
    header = ROUTES.splitlines()[0] + "\n"
    archive(landing, "b", hour=1, routes=header)
    assert run(spark, landing, root)["b.zip"]["routes.txt"] == 0
    assert table(spark, root, "routes").count() == 0


def test_byte_order_mark_and_line_ends(spark, landing, root):
    archive(landing, "a", routes="﻿" + ROUTES.replace("\n", "\r\n"))
    assert run(spark, landing, root)["a.zip"]["routes.txt"] == 1


def test_transform_hook(spark, landing, root):
    spec = static_spec(
        "calendar_dates",
        "str: service_id date",
        "int: exception_type",
        transform=lambda df: df.withColumn("date", F.lit("20260101")),
    )
    text = "service_id,date,exception_type\ns1,20250101,1\n"
    archive(landing, "a", calendar_dates=text)
    run_static(
        spark, landing, root, ["calendar_dates"], {"calendar_dates": spec}
    )
    (row,) = table(spark, root, "calendar_dates").collect()
    assert (row.date, row.exception_type) == ("20260101", 1)


def test_records_join_quoted_lines():
    lines = ["a,b\r\n", "\n", '"x\n', 'y",""\n', "last"]
    assert list(csv_records(lines)) == ["a,b", '"x\ny",""', "last"]


def rejects(spark, root):
    rows = read_rejects(spark, root).orderBy("archive", "line_no", "column_name")
    return [
        (os.path.basename(r.archive), r.line_no, r.column_name, r.text, r.reason)
        for r in rows.collect()
    ]


def test_rejected_cells_are_stored_and_the_last_sound_file_stays(
    spark, landing, root
):
    bad = (
        ROUTES
        + "7,A1,1,L,,bus,,,,x1,\n"
        + "8,too,few\n"
        + "9,A1,1,L,,2.5,,,,NULL,\n"
        + "10,A1,1,L,,4.0,,,,,\n"
    )
    archive(landing, "a", routes=ROUTES.replace("0123", "OLD"))
    archive(landing, "b", hour=1, routes=bad, feed_info=info(version="v2"))
    for _ in range(2):  # the second try replaces what the first stored
        assert run(spark, landing, root)["b.zip"] == {
            "stop_times.txt": 2,
            "feed_info.txt": 1,
        }
        assert rejects(spark, root) == [
            ("b.zip", 2, "route_sort_order", "x1", "cannot read as int"),
            ("b.zip", 2, "route_type", "bus", "cannot read as int"),
            ("b.zip", 3, None, "8,too,few", "MALFORMED record"),
            ("b.zip", 4, "route_type", "2.5", "cannot read as int"),
        ]
        assert [r.route_id for r in table(spark, root, "routes").collect()] == ["OLD"]
        versions = table(spark, root, "feed_info").collect()
        assert [r.feed_version for r in versions] == ["v2"]
        assert statuses(spark, root) == [("a.zip", "loaded")]
    archive(landing, "b", hour=2, feed_info=info(version="v2"))
    assert len(run(spark, landing, root)["b.zip"]) == 3
    assert [r.route_id for r in table(spark, root, "routes").collect()] == ["0123"]
    assert len(rejects(spark, root)) == 4


def test_a_repeated_faulty_archive_is_tried_and_wins(spark, landing, root):
    """Equal to the one before, which is not recorded, so it is not unchanged."""
    bad = ROUTES.replace(",3,", ",bus,")
    archive(landing, "a", routes=bad)
    archive(landing, "b", hour=1, routes=bad)
    assert list(run(spark, landing, root)) == ["a.zip", "b.zip"]
    (about,) = table(spark, root, "feed_info").select(
        F.unix_seconds("downloaded_at").alias("s")
    ).collect()
    assert about.s == 1_767_225_600 + 3600
    assert statuses(spark, root) == []


def test_settle_takes_archives_one_after_the_other():
    first, second = FeedInfo("1", "2", ""), FeedInfo("1", "3", "")
    landed = [
        Landed("a", 10, "x", first),
        Landed("b", 20, "x", first),
        Landed("c", 30, "y", None),
        Landed("d", 40, "x", first),
        Landed("e", 50, "z", second),
        Landed("f", 60, "x", first),
    ]

    def got(newest=None, loaded=(), faulty=()):
        return [s for _, s in settle(landed, newest, dict(loaded), faulty)]

    assert got() == ["loaded", "unchanged", "undated", "unchanged", "loaded", "loaded"]
    assert got(faulty={"x"}) == ["failed", "failed", "undated", "failed", "loaded", "failed"]
    assert got(newest=(5, "x"))[:2] == ["unchanged", "unchanged"]
    assert got(newest=(45, "w"), loaded={("1", "2"): 45}) == [
        "superseded", "superseded", "undated", "superseded", "loaded", "loaded"
    ]


def test_jobs_do_not_grow_with_archives(spark, landing, root, tmp_path):
    scheduler = spark._jsc.sc().dagScheduler()

    def jobs(folder, static):
        before = scheduler.numTotalJobs()
        run(spark, folder, static)
        return scheduler.numTotalJobs() - before

    archive(landing, "a")
    many = str(tmp_path / "many")
    for n in range(1, 9):
        archive(many, f"m{n}", hour=n, feed_info=info(end=f"2026070{n}"))
    assert jobs(many, root) == jobs(landing, str(tmp_path / "other"))
    assert table(spark, root, "routes").count() == 8


def test_archives_of_key_ranges(spark, tmp_path, monkeypatch):
    """Rows are spread by key; each archive has all files and its own year."""
    import zipfile
    from pathlib import Path

    import pytest

    from headway import adapters

    sf = Path("/root/testdata/sf0.001")
    if not sf.exists():
        pytest.skip("no test tables")
    monkeypatch.setattr(adapters, "ARCHIVE_KEYS", 600)
    landing = str(tmp_path / "landing")
    for name in ("a", "b"):
        adapters.land_static_archives(spark, str(sf), landing, name, "A", "0101", "0630")
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey").collect()
    years = sorted({2024 + key // 600 for (key,) in orders})
    assert len(years) > 2
    files = sorted(Path(landing).glob("*.zip"))
    assert [f.name for f in files] == [f"{n}-{y}.zip" for n in "ab" for y in years]
    trips = 0
    for year in years:
        archive = Path(landing) / f"a-{year}.zip"
        assert archive.read_bytes() == (Path(landing) / f"b-{year}.zip").read_bytes()
        with zipfile.ZipFile(archive) as opened:
            names = opened.namelist()
            assert sorted(names) == sorted(s.member for s in STATIC.values())
            lines = opened.read("trips.txt").decode().splitlines()
            assert lines[0] == ",".join(STATIC["trips"].data_schema.names)
            trips += len(lines) - 1
            assert f'"{year}0101","{year}0630"' in opened.read("feed_info.txt").decode()
    assert trips == len(orders)


def test_records_do_not_depend_on_blocks():
    """Quoted line breaks, blank lines and all line ends, cut anywhere."""
    import io

    from headway.sources.archive import csv_blocks

    text = 'h,i\n"a","b"\n\n"x\ny",""\r\n1,2\r3,"p""q\n\nr"\n\r\n"é",z\n"open\nend'
    want = list(csv_records(io.StringIO(text, newline="")))
    assert len(want) == 7
    for size in range(1, len(text) + 2):
        blocks = csv_blocks(io.StringIO(text, newline=""), size)
        assert [line for block in blocks for line in block.to_pylist()] == want


def test_lines_of_an_archive_are_sorted_by_many_tasks(spark, tmp_path, monkeypatch):
    """No task of the sort has all lines, and texts are put together in order."""
    import zipfile
    from pathlib import Path

    import pytest

    from headway import adapters
    from headway.session import conf

    sf = Path("/root/testdata/sf0.001")
    if not sf.exists():
        pytest.skip("no test tables")
    monkeypatch.setattr(adapters, "_TEXT_LINES", 7)
    plain = adapters._joined_lines

    def counted(batches):
        from pyspark import TaskContext

        for batch in plain(batches):
            Path(f"{tmp_path}/task-{TaskContext.get().partitionId()}").touch()
            yield batch

    monkeypatch.setattr(adapters, "_joined_lines", counted)
    landing = str(tmp_path / "landing")
    # Adaptive execution would give lines as few as these to one task.
    with conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        adapters.land_static_archives(spark, str(sf), landing, "a", "A", "0101", "0630")
    assert len(list(tmp_path.glob("task-*"))) > 1
    with zipfile.ZipFile(f"{landing}/a-2024.zip") as opened:
        for member in opened.namelist():
            texts = opened.read(member).decode().splitlines()[1:]
            assert texts == sorted(texts)
        lines = opened.read("stop_times.txt").decode().splitlines()
    assert len(lines) - 1 == spark.read.parquet(f"{sf}/lineitem.parquet").count()


def test_each_archive_is_written_by_its_own_task(spark):
    rows = spark.range(40).select((F.col("id") + 2024).cast("int").alias("year"))
    dealt = adapters._dealt(rows, 2063).select("year", F.spark_partition_id().alias("task"))
    assert len({r.task for r in dealt.collect()}) == 40
    assert adapters._dealt(rows.where("year = 0"), None).count() == 0


def test_plain_records_are_split_as_the_csv_reader_does(spark):
    """Cells that are plain to see need no parser; the others are left to it."""
    plain = ['"a","b"', "a,b", ",", '"",""', '"",b', '"é, x","b"', " a, b ", "a\\,b", "'a',#"]
    odd = ['"a""x","b"', '"a","b","c"', "a", '"', '","', '"a\nx","b"', "a\tb,c", '"a" ,b', ""]
    lines = pa.array(plain + odd)
    found, left = {}, []
    for rows, cells in plain_cells(lines, 2):
        mine = (lines if rows is None else lines.filter(rows)).to_pylist()
        if cells:
            found |= dict(zip(mine, zip(*(c.to_pylist() for c in cells))))
        else:
            left += mine
    assert sorted(found) == sorted(set(plain) - {'"",b'})
    assert sorted(left) == sorted([*odd, '"",b'])
    options = {"columnNameOfCorruptRecord": "bad", "multiLine": "true", "escape": '"'}
    frame = spark.createDataFrame([(line,) for line in found], "line string")
    parsed = F.from_csv("line", "x string, y string, bad string", options)
    for row in frame.select("line", parsed.alias("r")).collect():
        assert (row.r.bad, (row.r.x, row.r.y)) == (None, found[row.line])
    (whole,) = plain_cells(pa.array(["1,2", "3,"]), 2)
    assert whole[0] is None and [c.to_pylist() for c in whole[1]] == [["1", "3"], ["2", None]]
    assert all(not cells for _, cells in plain_cells(pa.array(["a", '"a"', " "]), 1))


def test_plain_and_odd_records_of_a_file_load_alike(spark, landing, root):
    records = ['t,1:00:00,,s,1,"x ""y""",,,,', "t,2:00:00,,s,2,,,,0.5,", '"t","3:00:00"' + ',""' * 8]
    head = STOP_TIMES.partition("\n")[0]
    archive(landing, "a", stop_times="\n".join([head, *records * 2]) + "\n")
    assert run(spark, landing, root)["a.zip"]["stop_times.txt"] == 6
    rows = table(spark, root, "stop_times").collect()
    got = [(r.arrival_time, r.stop_sequence, r.stop_headsign, r.shape_dist_traveled) for r in rows]
    assert sorted(got, key=str) == sorted(
        [("1:00:00", 1, 'x "y"', None), ("2:00:00", 2, None, 0.5), ("3:00:00", None, None, None)] * 2,
        key=str,
    )


def test_files_of_all_years_have_codes_in_their_order(spark):
    """Codes are as long as another and sort as (year, place) do."""
    files = len(adapters.STATIC_FROM)
    rows = spark.range(700 * files).selectExpr(
        f"CAST(2024 + id DIV {files} AS INT) AS year", f"CAST(id % {files} AS INT) AS n", "id"
    )
    codes = rows.select("id", adapters._file_code("n", 2723).alias("code")).orderBy("id")
    texts = [r.code.encode() for r in codes.collect()]
    assert texts == sorted(set(texts)) and {len(t) for t in texts} == {3}
