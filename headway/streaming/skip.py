"""Consecutive-payload skip with checkpointed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

KEPT = (
    "feed_id string, poll_time timestamp, payload_id string, "
    "source_file string"
)
KEPT_NAMES = [column.split()[0] for column in KEPT.split(", ")]


# Feeds are dealt to so many groups: a call of Python for each feed would cost
# more than its few polls of a micro-batch.
FEED_GROUPS = 1_024
# The newest poll of each feed of a group; its time in microseconds since 1970.
_STATE = "feeds array<string>, md5s array<string>, newest array<bigint>"
# What NULL times become, which are never late.
_NO_TIME = -(2**63)


def _keep_changed(
    key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    held = {}
    if state.exists:
        held = {feed: (md5, at) for feed, md5, at in zip(*state.get)}
    polls = pd.concat(list(frames), ignore_index=True)
    polls = polls.sort_values(["feed_id", "poll_time", "payload_id"], ignore_index=True)
    wanted = []
    micros = polls["poll_time"].to_numpy().astype("datetime64[us]").astype("int64")
    before, timely = None, False
    for feed, md5, at in zip(polls["feed_id"], polls["md5"], micros.tolist()):
        if not wanted or feed != before:
            before = feed
            last, newest = held.get(feed, (None, None))
        late = newest is not None and _NO_TIME < at < newest
        wanted.append(late or md5 != last)
        if not late:
            # Rows come in order, so those that follow are not late either.
            last, timely = md5, True
            held[feed] = (md5, at)
    if timely:
        state.update(
            (list(held), [md5 for md5, _ in held.values()], [at for _, at in held.values()])
        )
    yield polls.loc[wanted, KEPT_NAMES]


def changed_payloads(stream: DataFrame) -> DataFrame:
    """Payloads that differ from the previous one of their feed.

    Returns their names, not their bytes: payloads are hashed where they are
    read, and only (feed, poll time, name, hash) is shuffled to the state. The
    work per feed is in sequence by nature; a micro-batch bounds it, and the
    state is the hash and the time of a feed's newest poll, kept for a group of
    feeds together. Order within a
    micro-batch is by poll time. A poll older than the newest of an earlier
    micro-batch is late: its neighbours are gone, so it is kept and changes no
    state. What comes in time gives what a batch over everything gives.
    """
    hashed = stream.select(
        "feed_id",
        "poll_time",
        "payload_id",
        "source_file",
        F.md5("content").alias("md5"),
    )
    group = F.pmod(F.xxhash64("feed_id"), F.lit(FEED_GROUPS))
    grouped = hashed.withColumn("feed_group", group).groupBy("feed_group")
    return grouped.applyInPandasWithState(
        _keep_changed,
        outputStructType=KEPT,
        stateStructType=_STATE,
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout,
    )
