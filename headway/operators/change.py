"""Drop a payload equal to the one just before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def consecutive_skip(
    df: DataFrame,
    source: str,
    order: Sequence[str],
    value: str,
    chunk: Column,
) -> DataFrame:
    """Rows whose ``value`` differs from the previous row of their source.

    A, A, B, A keeps three rows. ``order`` is a total order within a source.
    ``chunk`` must not decrease along ``order``: the hour or the minute of its
    first column, say, the finer the busier a source may be.

    A source is spread over its chunks. Rows are compared within (source,
    chunk); the first row of each chunk is then compared with the last value
    of the chunk before. That second step sees one row per chunk, which the
    calendar bounds, not the data. Both steps read the same exchange.
    """
    by_chunk = Window.partitionBy(source, "_chunk").orderBy(*order)
    whole = by_chunk.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    ranked = df.withColumn("_chunk", chunk).select(
        "*",
        F.lag(value).over(by_chunk).alias("_before"),
        F.row_number().over(by_chunk).alias("_place"),
        F.last(value).over(whole).alias("_tail"),
    )
    inner = _changed(ranked.where("_place > 1"), value)
    chunks = Window.partitionBy(source).orderBy("_chunk")
    heads = ranked.where("_place = 1").withColumns(
        {
            "_before": F.lag("_tail").over(chunks),
            "_place": F.row_number().over(chunks),
        }
    )
    return inner.select(*df.columns).unionAll(
        _changed(heads, value).select(*df.columns)
    )


def _changed(ranked: DataFrame, value: str) -> DataFrame:
    same = F.col("_before").eqNullSafe(F.col(value))
    return ranked.where((F.col("_place") == 1) | ~same)


def first_by_value(df: DataFrame, value: str, row_id: str) -> DataFrame:
    """Distinct values with the smallest id that carries each."""
    return df.groupBy(value).agg(F.min(row_id).alias(row_id))
