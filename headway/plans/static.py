"""Static job: landed archives to the thirteen versioned tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Container, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.times import utc_now
from headway.schemas import STATIC, StaticSpec
from headway.session import conf, local_rows, ship_package
from headway.sources.archive import (
    HEADER_LINE,
    FeedInfo,
    cells_schema,
    extract_cells,
    first_lines,
    header_problem,
    parse_lines,
    read_archives,
    read_feed_info,
    stamp,
    typed,
)
from headway.sources.checked import checked_rows, rejected_cells, store_rejects
from headway.sources.ledger import LOADED, SUPERSEDED, UNCHANGED, Entry, Ledger
from headway.store import Store
from headway.swap import STAGING
from headway.tables import Staged, drop_staged, place_versions, stage_versions

log = logging.getLogger("headway.static")

# Tables that are written side by side.
_AT_ONCE = 4
# Extracted lines go to a file a member, which are open side by side so that the
# lines need not be sorted; their row groups are small, to be read by many tasks.
_EXTRACT_CONF = {"spark.sql.maxConcurrentOutputFileWriters": "64"}
_ROW_GROUP = 8 << 20
# The lines a task reads are of few versions, so rows need not be sorted by them.
_STAGE_CONF = {"spark.sql.maxConcurrentOutputFileWriters": "4"}


def prepare(
    lines: DataFrame, spec: StaticSpec, info: FeedInfo, landed_at: int
) -> DataFrame:
    """One archive's lines as rows of one table, ready to be stored."""
    rows = stamp(parse_lines(lines, spec), spec, info, landed_at)
    return typed(rows.transform(spec.transform), spec)


@dataclass(frozen=True)
class Landed:
    """An archive that the ledger lacks; ``modified`` in microseconds since 1970."""

    archive: str
    modified: int
    content_hash: str
    info: FeedInfo | None = None

    @property
    def validity(self) -> tuple[str, str]:
        return self.info.valid_from, self.info.valid_to


# Of an archive that is loaded in part, and of one without a validity; neither
# is recorded, so the next run takes them again.
FAILED, UNDATED = "failed", "undated"


def settle(
    landed: Sequence[Landed],
    newest: tuple[int, str] | None,
    loaded: Mapping[tuple[str, str], int],
    faulty: Container[str],
) -> list[tuple[Landed, str]]:
    """What becomes of archives that are taken one after the other.

    ``newest`` is (modified, hash) of the archive landed last among those
    recorded, ``loaded`` when the archive of each version landed, and
    ``faulty`` the hashes of contents of which some file cannot be loaded.
    """
    found, loaded = [], dict(loaded)
    for one in landed:
        if newest and one.content_hash == newest[1]:
            status = UNCHANGED
        elif one.info is None:
            status = UNDATED
        elif loaded.get(one.validity, one.modified) > one.modified:
            status = SUPERSEDED
        elif one.content_hash in faulty:
            status = FAILED
        else:
            status = LOADED
            loaded[one.validity] = one.modified
        if status in (UNCHANGED, LOADED) and (not newest or one.modified >= newest[0]):
            newest = (one.modified, one.content_hash)
        found.append((one, status))
    return found


class _Load:
    """One run over the archives that are new: a job a table, not an archive."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        lines: DataFrame,
        specs: Mapping[str, StaticSpec],
        landed: Sequence[Landed],
        problems: dict[tuple[str, str], str],
        numbers: Mapping[str, str],
    ) -> None:
        self.spark, self.root, self.lines, self.specs = spark, root, lines, specs
        self.landed, self.numbers = landed, numbers
        # By (content hash, member): equal contents have equal faults.
        self.problems = problems
        ledger = Ledger(spark, root)
        self._newest = ledger.newest()
        self._loaded = ledger.last_loaded(l.validity for l in landed if l.info)

    def settled(self) -> list[tuple[Landed, str]]:
        faulty = {content for content, _ in self.problems}
        return settle(self.landed, self._newest, self._loaded, faulty)

    def tried(self) -> list[Landed]:
        return [one for one, status in self.settled() if status in (LOADED, FAILED)]

    def sound(self, spec: StaticSpec) -> list[Landed]:
        """Archives to load whose file is not known to be faulty."""
        return [
            one
            for one in self.tried()
            if (one.content_hash, spec.member) not in self.problems
        ]

    def last(self, spec: StaticSpec) -> dict[tuple[str, str], Landed]:
        """The archive each version is taken from: the last that is sound."""
        return {one.validity: one for one in self.sound(spec)}

    def checked(self, spec: StaticSpec) -> DataFrame:
        """Rows of a table from all sound archives, told which are stored."""
        last = set(self.last(spec).values())
        rows = [
            (self.numbers[one.archive], one.archive, *one.validity, one.modified, one in last)
            for one in self.sound(spec)
        ]
        names = ["archive", "path", "valid_from", "valid_to", "landed_at", "stored"]
        return checked_rows(self.lines, spec, local_rows(self.spark, names, rows))

    def stage(self, specs: Iterable[StaticSpec]) -> dict[str, Staged]:
        """Write tables without showing them, some side by side.

        One that cannot be written has a problem in all its archives.
        """

        def run(spec: StaticSpec) -> Staged | Exception:
            try:
                return stage_versions(
                    self.checked(spec),
                    self.root,
                    spec,
                    self.last(spec),
                    F.size("_rejected") > 0,
                    F.col("_stored"),
                )
            except Exception as error:
                log.exception("Failed to write %s", spec.name)
                return error

        todo = [spec for spec in specs if self.sound(spec)]
        with conf(self.spark, _STAGE_CONF), ThreadPoolExecutor(_AT_ONCE) as pool:
            results = dict(zip((s.name for s in todo), pool.map(run, todo)))
        for spec in todo:
            if isinstance(results[spec.name], Exception):
                failed = results.pop(spec.name)
                for one in self.sound(spec):
                    self.problems[one.content_hash, spec.member] = f"{failed}"
        return results

    def quarantine(self, specs: Sequence[StaticSpec]) -> None:
        """Store the rejected cells of some tables; their files are faulty."""
        cells = reduce(
            DataFrame.unionAll, [rejected_cells(self.checked(s), s) for s in specs]
        )
        names = ["archive", "modified", "content_hash"]
        rows = [(l.archive, l.modified, l.content_hash) for l in self.tried()]
        found = store_rejects(cells, local_rows(self.spark, names, rows), self.root)
        hashes = {l.archive: l.content_hash for l in self.landed}
        for (archive, member), problem in found.items():
            self.problems[hashes[archive], member] = problem

    def run(self) -> None:
        specs = list(self.specs.values())
        source = {s.name: self.last(s) for s in specs}
        staged = self.stage(specs)
        flagged = [s for s in specs if s.name in staged and staged[s.name].flagged]
        if flagged:
            self.quarantine(flagged)
        # What is wrong can change which archive a version is taken from, also
        # in other tables: one that repeats a faulty archive is not unchanged.
        again = [s for s in specs if s.name in staged and self.last(s) != source[s.name]]
        for spec in again:
            drop_staged(self.spark, staged.pop(spec.name))
        staged |= self.stage(again)
        for spec in specs:
            if spec.name not in staged:
                continue
            try:
                place_versions(self.spark, staged[spec.name], spec)
            except Exception as error:
                log.exception("Failed to put %s in place", spec.name)
                for one in self.sound(spec):
                    self.problems[one.content_hash, spec.member] = f"{error}"


def run_static(
    spark: SparkSession,
    landing: str | list[str],
    static_root: str,
    tables: Iterable[str] = STATIC,
    specs: dict[str, StaticSpec] | None = None,
) -> dict[str, dict[str, int]]:
    """Load every landed archive that is new; records per archive and file.

    Archives count in the order they were landed. One already in the ledger is
    skipped by name and time, one equal to the archive landed last of those
    recorded by its hash. A file with a wrong header, or with cells that its
    columns cannot hold, is not loaded; all such cells are stored (see
    ``headway.sources.checked.read_rejects``). It leaves the other files in
    place and the archive out of the ledger, so the next run takes it again;
    but not once an archive landed later has been loaded for the same validity,
    as old contents never replace new ones. Where several archives of a run
    have one validity, each table is taken from the last of them that is sound
    in it, and that is the only one that is written.
    """
    ship_package(spark)
    specs = {name: (specs or STATIC)[name] for name in tables}
    ledger = Ledger(spark, static_root)
    seen = ledger.read().select("archive", "modified")
    # Names and hashes only: the folder listing Spark holds anyway.
    new = (
        read_archives(spark, landing)
        .join(seen, ["archive", "modified"], "left_anti")
        .select(
            "archive",
            F.unix_micros("modified").alias("modified"),
            F.md5("content").alias("content_hash"),
        )
        .orderBy("modified", "archive")
        .collect()
    )
    if not new:
        log.info("No new static archive")
        return {}

    staged = f"{static_root.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}"
    store = Store(spark, static_root)
    archives = read_archives(spark, [r["archive"] for r in new])
    numbers = {r["archive"]: str(n) for n, r in enumerate(new)}
    validity = STATIC["feed_info"]
    files = [validity, *specs.values()]
    with conf(spark, _EXTRACT_CONF):
        extracted = extract_cells(archives, files, numbers).write.partitionBy("member")
        extracted.option("parquet.block.size", _ROW_GROUP).parquet(staged)
    try:
        lines = spark.read.schema(cells_schema(files)).parquet(staged)
        first = first_lines(lines)
        landed, problems = [], {}
        for row in new:
            one = Landed(row["archive"], row["modified"], row["content_hash"])
            number = numbers[one.archive]
            try:
                info = read_feed_info(first.get((number, validity.member), {}), validity)
                one = replace(one, info=info)
            except (KeyError, ValueError) as error:
                log.error("%s has no validity, skipped: %s", one.archive, error)
            landed.append(one)
            for spec in specs.values():
                problem = header_problem(first.get((number, spec.member), {}), spec)
                if problem:
                    problems[one.content_hash, spec.member] = problem
        load = _Load(spark, static_root, lines, specs, landed, problems, numbers)
        load.run()
        paths = {number: path for path, number in numbers.items()}
        counts = {
            (paths.get(r["archive"]), r["member"]): r["n"]
            for r in lines.where(F.col("line_no") > HEADER_LINE)
            .groupBy("archive", "member")
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        }
    finally:
        store.delete(staged)
    return _recorded(ledger, load, counts)


def _recorded(
    ledger: Ledger, load: _Load, counts: Mapping[tuple[str, str], int]
) -> dict[str, dict[str, int]]:
    """Write the ledger and the log; records per archive and file loaded."""
    done: dict[str, dict[str, int]] = {}
    entries = []
    for one, status in load.settled():
        name = one.archive
        if status in (LOADED, FAILED):
            done[name] = {}
            for spec in load.specs.values():
                problem = load.problems.get((one.content_hash, spec.member))
                if problem:
                    log.error("%s: %s is not loaded: %s", name, spec.member, problem)
                else:
                    done[name][spec.member] = counts.get((name, spec.member), 0)
            log.info(
                "%s: %d files, %d records", name, len(done[name]), sum(done[name].values())
            )
        if status == FAILED:
            log.warning("%s had errors and is left for the next run", name)
        elif status != UNDATED:
            log.info("%s: %s", name, status)
            about = (one.modified, one.content_hash)
            if status != UNCHANGED:
                about += (*one.validity, one.info.version)
            entries.append(Entry(name, *about, status=status))
    ledger.record(entries, utc_now())
    return done
