"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from headway.store import Store

# Settings the jobs rely on. Sizes and core counts belong to the cluster.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(
    app: str = "headway", master: str | None = None, **extra: str
) -> SparkSession:
    """A session with the settings above; ``extra`` uses Spark's own keys."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    The decoding and state functions run there. Not needed where the package
    is installed on the executors or passed as ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    held = tempfile.mkdtemp(prefix="headway-code-")
    atexit.register(shutil.rmtree, held, ignore_errors=True)
    archive = shutil.make_archive(
        f"{held}/{package.name}", "zip", package.parent, package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


@contextmanager
def conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set SQL settings for a block."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def local_rows(
    spark: SparkSession, names: Sequence[str], rows: Sequence[tuple]
) -> DataFrame:
    """Rows the driver holds as a table whose size Spark knows.

    A list becomes a scan of unknown size, which a join would shuffle for.
    """
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, columns)))))


# While a table is written; see ``headway.tables.write_clustered``.
WRITE_CONF = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}


def side_by_side(
    spark: SparkSession, jobs: Sequence[Callable[[], Any]]
) -> list[Any]:
    """Run independent jobs at once, so one's tail does not idle the cluster.

    The settings a job makes for its writes are made here first, as settings
    belong to the session and not to a thread. The first failure is raised
    after all have ended.
    """
    with conf(spark, WRITE_CONF), ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(job) for job in jobs]
    return [r.result() for r in running]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, removed when Spark ends.

    Every executor must reach it, so on a cluster the setting is required; a
    machine-local folder is used only by a local master.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder all executors share"
            )
        base = tempfile.mkdtemp(prefix="headway-")
    path = f"{base.rstrip('/')}/headway-{label}-{uuid.uuid4().hex}"
    store = Store(spark, path)
    store.make_dir(path)
    store.delete_at_end(path)
    return path
