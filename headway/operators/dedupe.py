"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_by_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str]
) -> DataFrame:
    """Keep per key the row with the largest ``newest`` columns, in order.

    Every other column breaks the remaining ties, so the survivor does not
    depend on how the rows are spread over tasks.

    Catalyst plans the rank filter as a ``WindowGroupLimit`` on both sides of
    the exchange: a task sends at most one row per key, so a key holding a
    third of all rows costs the receiving task one row per sender.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    order = [F.col(c).desc_nulls_last() for c in [*newest, *rest]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedupe(
    df: DataFrame, keys: Sequence[str], observed: str = "poll_time"
) -> DataFrame:
    """Repeated observations of a key: keep the latest observed."""
    return first_by_key(df, keys, [observed])


def latest_state(
    df: DataFrame,
    keys: Sequence[str],
    stamped: str = "feed_timestamp",
    observed: str = "poll_time",
) -> DataFrame:
    """Successive states of a key: keep the one stamped last."""
    return first_by_key(df, keys, [stamped, observed])
