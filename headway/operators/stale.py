"""Drop entities whose own clock is far from the poll."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: minutes.
STALE_MINUTES = 15


def is_fresh(
    poll_time: Column, stamp: Column, minutes: int = STALE_MINUTES
) -> Column:
    """|poll - stamp| within the limit, the limit included.

    ``stamp`` is in epoch seconds; an unset stamp (0) is never fresh. The rule
    needs no state, so it is the same on batches and streams.
    """
    return F.abs(F.unix_seconds(poll_time) - stamp) <= minutes * 60
