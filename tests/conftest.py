import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from headway.schemas import RAW  # noqa: E402
from headway.session import build_session  # noqa: E402
from headway.tables import append  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "headway-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def raw(tmp_path):
    return str(tmp_path / "raw")


@pytest.fixture
def processed(tmp_path):
    return str(tmp_path / "processed")


def at(text: str) -> datetime:
    """A UTC time from 'YYYY-MM-DD HH:MM[:SS]'."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def frame(spark, schema, rows):
    """Rows given as dicts; columns left out are NULL."""
    tuples = [tuple(r.get(n) for n in schema.names) for r in rows]
    return spark.createDataFrame(tuples, schema)


def land(spark, root, table, rows, writes=2):
    """Append rows to a raw table in several writes."""
    spec = RAW[table]
    for n in range(writes):
        part = rows[n::writes]
        if part:
            append(frame(spark, spec.schema, part), root, spec)
