"""Shared pieces: scratch tables, and vectorised words of text batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import scratch_dir

# Bytes of text handled at once in a Python worker. A longer single document
# is handled alone. Working arrays take some sixty times as much.
SLICE_BYTES = 1 << 18

# Rows of whole texts that pass to a Python worker at once. Spark's own 10,000
# are tens of megabytes of text in the JVM and again in each worker. Batches end
# earlier where their rows have so many bytes; one longer row is a batch.
BATCH_ROWS, BATCH_BYTES = 1_000, 2 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Let the session pass texts to Python in batches of bounded size."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def keep(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame to the shared scratch folder and read it back.

    Cuts the lineage, so a lost executor costs no more than the tasks that
    ran on it; later steps also see the real size of the table.
    """
    path = scratch_dir(spark, f"llm-{label}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def neutral(columns: Sequence[str]) -> dict[str, str]:
    """A name for each column that no working column of an operator has."""
    return {name: f"c{i}" for i, name in enumerate(columns)}


def select_as(rows: DataFrame, names: dict[str, str], *more: str) -> DataFrame:
    """The columns ``names`` under their neutral names, then others."""
    own = [F.col(f"`{name}`").alias(plain) for name, plain in names.items()]
    return rows.select(*own, *more)


def select_back(rows: DataFrame, names: dict[str, str], *more: str) -> DataFrame:
    """The columns under their own names again, then others."""
    own = [F.col(plain).alias(name) for name, plain in names.items()]
    return rows.select(*own, *more)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
# A random 64-bit value for each byte; A to Z count as a to z.
BYTE_VALUES = mix(
    (_CODES + 32 * _UPPER + 1).astype(np.uint64) * np.uint64(_MULTIPLIER)
)
# Bytes of words between white space: space and 0x09 to 0x0D separate.
WORD_BYTES = ~((_CODES == 32) | ((_CODES >= 9) & (_CODES <= 13)))
# Bytes of letters and digits; all bytes of non-ASCII characters count.
LETTER_BYTES = (
    _UPPER
    | ((_CODES >= 97) & (_CODES <= 122))
    | ((_CODES >= 48) & (_CODES <= 57))
    | (_CODES >= 128)
)

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, "u8"), np.ones(1, "u8"))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES)
        tables = []
        for base in (_MULTIPLIER, _INVERSE):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            tables.append(np.cumprod(factors, dtype=np.uint64))
        if size > SLICE_BYTES:
            return tables[0], tables[1]
        _powers = (tables[0], tables[1])
    return _powers


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column (null: empty) and its row offsets."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held, offsets


def slices(
    data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows within a limit."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        fits = np.searchsorted(offsets, offsets[low] + limit, "right") - 1
        high = int(min(max(fits, low + 1), rows))
        yield (
            low,
            high,
            data[offsets[low] : offsets[high]],
            offsets[low : high + 1] - offsets[low],
        )
        low = high


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, solid: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some rows, and where each row's words start.

    A word is a run of bytes marked in ``solid``. Its hash is a polynomial
    over the bytes, taken from running sums, so no word is touched alone.
    """
    n = len(data)
    inside = solid[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | border[1:n]
    closes[:-1] &= ~inside[1:] | border[1:n]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    power, inverse = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * power[:n], out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * inverse[begin])
    return hashes, np.searchsorted(begin, offsets)


def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the end of each row."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
