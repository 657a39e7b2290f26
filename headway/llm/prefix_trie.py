"""Conversation prefix trie, rolled up by centroid decomposition.

A node is a distinct sequence of the first d turns of conversations. It is named
by the smallest conversation that begins with it, and d: of two nodes of one
depth each conversation has at most one, so the name is unique. ``steps`` has the
node of every conversation at every depth, for one conversation of each distinct
sequence, and so the way from any node to the root.

Turns are put in order and their prefixes told apart without a group for each
conversation: rows are dealt out by ranges of (conversation, turn), and what a
range holds is added up along the few ranges of a conversation. A prefix is known
by sums over its turns of SHA-256 of place and turn, which can be added so.

Subtree sums (``rollup``) take rounds over components of the forest, at first one.
In each a node is chosen that cuts the component into pieces of at most half its
weight, rounded up to a power of two; what the component holds in that node's
subtree is summed and added to all nodes from the chosen one up to the
component's top. The chosen node goes, and the pieces are the next components.
The weight of a node's subtree, in steps, is known when the trie is made, and is
kept by the same paths. So a trie of n steps takes log2(n) rounds whatever its
depth, and a chain of turns is halved like any other shape.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import keep

# Pieces of a SHA-256 that are summed, of 32 bits each: the sums of a
# conversation of up to 2**31 turns fit a long.
PIECES = 4
_SUMS = [f"s{i}" for i in range(PIECES)]

# Ids of a node that are hashed from one row.
CHUNK_IDS = 1 << 14

WORD = r"[^\x20\x09-\x0D]+"


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, content, words): texts become hashes.

    Turns without a conversation are none of a conversation, and go.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The length tells where the role ends.
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    words = F.size(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        role.alias("role"),
        F.unhex(F.sha2(content, 256)).alias("content"),
        words.cast("long").alias("words"),
    )


def numbered(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv_id, part, i, content, words): i counts the turns of each from 0.

    Order is by turn, null first; ties by role, then hash of the text.
    ``part`` is the range a row lies in; ranges follow one another.
    """
    salted = turns.withColumn("salt", F.monotonically_increasing_id() % 1024)
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "content", "salt"]
    dealt = salted.repartitionByRange(*order).sortWithinPartitions(*order)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, n = None, 0
        for batch in batches:
            places = []
            for conv in batch.column(0).to_pylist():
                n = n + 1 if conv == last else 0
                last = conv
                places.append(n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([part] * len(places), pa.int32()),
                    pa.array(places, pa.int64()),
                    batch.column(1),
                    batch.column(2),
                ],
                ["conv_id", "part", "i", "content", "words"],
            )

    local = keep(
        spark,
        dealt.select("conv_id", "content", "words").mapInArrow(
            count, "conv_id long, part int, i long, content binary, words long"
        ),
        "turns",
    )
    # Only the first conversation of a range can have turns in one before, so
    # there are fewer such rows than ranges.
    earlier = _before(
        local.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")), ["n"]
    ).where("n > 0")
    return local.join(F.broadcast(earlier), ["conv_id", "part"], "left").select(
        "conv_id",
        "part",
        (F.col("i") + F.coalesce("n", F.lit(0))).alias("i"),
        "content",
        "words",
    )


def _before(parts: DataFrame, columns: list[str]) -> DataFrame:
    """For each (conv_id, part) the sums over the earlier parts."""
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy("part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return parts.select(
        "conv_id",
        "part",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in columns],
    )


def shared_starts(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """The turns of the query: conversations that begin with another's turns.

    Conversation c has the first h turns of conversation c - c % 20 (all if
    fewer, none if absent), then its own after its first h; h is the unsigned
    CRC-32 of c's decimal digits modulo 4. A row with a null i stands for each
    conversation as such, which may be left without a turn.
    """
    turns = keep(spark, turns, "numbered")
    convs = turns.where("i = 0").select(
        "conv_id",
        (F.crc32(F.col("conv_id").cast("string")) % 4).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % 20).alias("base"),
    )
    firsts = turns.where("i < 3").select(
        F.col("conv_id").alias("base"), "i", "content", "words"
    )
    # A conversation lends its turns to the few whose number leads to it.
    lent = convs.join(firsts, "base").where("i < h")
    lengths = convs.join(
        lent.groupBy("conv_id").agg(F.count(F.lit(1)).alias("lent")), "conv_id", "left"
    ).select("conv_id", "h", F.coalesce("lent", F.lit(0)).alias("lent"))
    # Written, as adaptive execution splits a join's hot keys only where both
    # sides come straight from a shuffle. So are the tables of ``rollup``.
    lengths = keep(spark, lengths, "lengths")
    own = (
        turns.join(lengths, "conv_id")
        .where("i >= h")
        .select(
            "conv_id",
            "part",
            (F.col("i") - F.col("h") + F.col("lent")).alias("i"),
            "content",
            "words",
        )
    )
    starts = lent.select("conv_id", F.lit(-1).alias("part"), "i", "content", "words")
    return own.unionByName(starts).unionByName(_empty(convs))


def _empty(convs: DataFrame) -> DataFrame:
    """The empty prefix of each conversation, before all its turns."""
    nothing = F.lit(None)
    return convs.select(
        "conv_id",
        F.lit(-2).alias("part"),
        nothing.cast("long").alias("i"),
        nothing.cast("binary").alias("content"),
        F.lit(0).cast("long").alias("words"),
    )


def with_empty(turns: DataFrame) -> DataFrame:
    """Numbered turns, and a row without a turn for each conversation."""
    return turns.unionByName(_empty(turns.where("i = 0")))


def prefixes(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv_id, depth, key, words), a row for each prefix.

    ``key`` names the first ``depth`` turns. ``turns`` has conv_id, part, i, content, words; parts of a conversation
    follow one another, and so do the i of its turns, from 0. A row with a
    null i is the conversation's empty prefix.
    """
    tagged = F.sha2(F.concat(F.col("i").cast("string").cast("binary"), "content"), 256)
    pieces = [
        F.coalesce(
            F.conv(F.substring("tag", 1 + 8 * k, 8), 16, 10).cast("long"), F.lit(0)
        ).alias(s)
        for k, s in enumerate(_SUMS)
    ]
    depth = F.coalesce(F.col("i") + 1, F.lit(0))
    terms = keep(
        spark,
        turns.withColumn("tag", tagged).select(
            "conv_id", "part", depth.alias("depth"), "words", *pieces
        ),
        "terms",
    )
    so_far = (
        Window.partitionBy("conv_id", "part")
        .orderBy("depth")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = terms.groupBy("conv_id", "part").agg(*[F.sum(s).alias(s) for s in _SUMS])
    earlier = _before(totals, _SUMS)
    within = terms.select(
        "conv_id",
        "part",
        "depth",
        "words",
        *[F.sum(s).over(so_far).alias(s) for s in _SUMS],
    ).join(
        earlier.select("conv_id", "part", *[F.col(s).alias(f"b{s}") for s in _SUMS]),
        ["conv_id", "part"],
    )
    sums = [F.col(s) + F.col(f"b{s}") for s in _SUMS]
    key = F.md5(F.concat_ws(",", "depth", *sums).cast("binary"))
    return within.select("conv_id", "depth", F.unhex(key).alias("key"), "words")


def trie(spark: SparkSession, reached: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, steps, ends) of the prefixes of conversations.

    ``nodes``: conv_id, depth, parent_conv_id, n_convs, words, leaf, weight.
    ``steps``: conv, depth, node (its conv_id), above (the parent's), one row
    for each prefix of one conversation of each distinct sequence.
    ``ends``: conv_id, depth, member, for each conversation its last node.
    """
    reached = keep(spark, reached, "prefixes")
    last = reached.groupBy("conv_id").agg(
        F.max(F.struct("depth", "key")).alias("end")
    ).select("conv_id", "end.depth", "end.key")
    last = keep(spark, last, "ends")
    # Equal conversations count as one, with their number.
    whole = last.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("copies"),
        F.min("depth").alias("length"),
    )
    steps = keep(spark, reached.join(whole.drop("key"), "conv_id"), "steps")
    weight = F.col("copies") * (F.col("length") - F.col("depth") + 1)
    nodes = keep(
        spark,
        steps.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"),
            F.min("depth").alias("depth"),
            F.sum("copies").alias("n_convs"),
            F.min("words").alias("words"),
            (F.max("length") == F.min("depth")).alias("leaf"),
            F.sum(weight).alias("weight"),
        ),
        "nodes",
    )
    named = nodes.select("key", F.col("conv_id").alias("node"))
    placed = keep(
        spark,
        steps.select(F.col("conv_id").alias("conv"), "depth", "key")
        .join(named, "key")
        .drop("key"),
        "steps",
    )
    before = placed.select(
        "conv", (F.col("depth") + 1).alias("depth"), F.col("node").alias("above")
    )
    placed = keep(spark, placed.join(before, ["conv", "depth"], "left"), "steps")
    parents = placed.select(
        F.col("conv").alias("conv_id"), "depth", F.col("above").alias("parent_conv_id")
    )
    ends = last.select(F.col("conv_id").alias("member"), "key").join(
        nodes.select("key", "conv_id", "depth"), "key"
    )
    whole_nodes = nodes.drop("key").join(parents, ["conv_id", "depth"])
    return keep(spark, whole_nodes, "nodes"), placed, ends.drop("key")


def rollup(
    spark: SparkSession, nodes: DataFrame, steps: DataFrame, columns: list[str]
) -> DataFrame:
    """(conv_id, depth, and for each of ``columns`` its sum over the subtree).

    ``nodes`` has conv_id, depth, weight and the columns, null for nothing;
    ``weight`` is the number of steps in a node's subtree, each counted as often
    as it is taken. ``steps`` are those of ``trie``.
    """
    root = nodes.groupBy().agg(F.min("conv_id")).first()[0]
    if root is None:
        return nodes.select("conv_id", "depth", *columns)
    live = nodes.select(
        "conv_id",
        "depth",
        "weight",
        F.lit(root).cast("long").alias("top"),
        F.lit(0).cast("long").alias("top_depth"),
        *columns,
    )
    ways = steps.select(
        F.col("conv").alias("at"),
        F.col("depth").alias("at_depth"),
        F.col("node").alias("found"),
        F.col("above").alias("found_above"),
    )
    cuts = None
    place = ["round", "top", "top_depth"]
    for round_ in itertools.count():
        chosen = keep(spark, _chosen(live), "chosen")
        cut = keep(spark, _cut(live, chosen, ways), "cut")
        mine = cut.withColumn("round", F.lit(round_))
        cuts = mine if cuts is None else cuts.unionAll(mine)
        live = cut.where("NOT chosen").select(
            "conv_id",
            "depth",
            F.when(F.col("on_path"), F.col("weight") - F.col("cut_weight"))
            .otherwise(F.col("weight"))
            .alias("weight"),
            F.when(F.col("below"), F.col("branch")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("below"), F.col("cut_depth") + 1)
            .otherwise(F.col("top_depth"))
            .alias("top_depth"),
            *columns,
        )
        if live.isEmpty():
            break
    sums = [F.sum(c).alias(c) for c in columns]
    totals = keep(spark, cuts.where("below").groupBy(*place).agg(*sums), "totals")
    added = cuts.where("on_path").select("conv_id", "depth", *place).join(totals, place)
    return added.groupBy("conv_id", "depth").agg(*sums)


def _chosen(live: DataFrame) -> DataFrame:
    """The node to cut at of each component.

    The lightest node of the heaviest power of two: two subtrees of that power
    would weigh the next one, so its holders are one path, and all that the
    last of them cuts off weighs less.
    """
    power = F.length(F.bin("weight"))
    lightest = F.struct(power, (-F.col("weight")).alias("minus"), "conv_id", "depth")
    return (
        live.groupBy("top", "top_depth")
        .agg(F.max(lightest).alias("c"))
        .select(
            "top",
            "top_depth",
            F.col("c.conv_id").alias("cut"),
            F.col("c.depth").alias("cut_depth"),
            (-F.col("c.minus")).alias("cut_weight"),
        )
    )


def _cut(live: DataFrame, chosen: DataFrame, ways: DataFrame) -> DataFrame:
    """The rows of all components, and where they lie to the chosen node.

    ``on_path``: from the chosen node up to the top; ``below``: in its subtree,
    itself included; ``branch``: the child of the chosen node above the row.
    """
    own, cut = F.col("conv_id"), F.col("cut")
    deeper = F.col("depth") > F.col("cut_depth")
    # A node's members are among its parent's, so the smallest never gets
    # smaller on the way down: most rows need no look at the steps.
    above = (~deeper) & (own < cut) & (F.col("depth") > 0)
    beneath = deeper & (own > cut)
    looked = (
        live.join(chosen, ["top", "top_depth"])
        .withColumn("at", F.when(above, cut).otherwise(own))
        .withColumn(
            "at_depth",
            F.when(beneath, F.col("cut_depth") + 1).otherwise(F.col("depth")),
        )
        .join(ways, ["at", "at_depth"])
    )
    on_path = (~deeper) & (
        (own == cut) | (F.col("depth") == 0) | ((own < cut) & (F.col("found") == own))
    )
    in_branch = deeper & (
        (own == cut) | ((own > cut) & (F.col("found_above") == cut))
    )
    is_cut = (own == cut) & (F.col("depth") == F.col("cut_depth"))
    return looked.select(
        *live.columns,
        "cut_weight",
        "cut_depth",
        is_cut.alias("chosen"),
        on_path.alias("on_path"),
        (in_branch | is_cut).alias("below"),
        F.when(in_branch, F.when(own == cut, cut).otherwise(F.col("found"))).alias("branch"),
    )


def id_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the members that end at a node.

    The digest is of decimal ids in ascending order, joined by commas. Members
    are put in order over all tasks and joined to runs of ids; a node's runs are
    then hashed one after the other, as SHA-256 is one chain, in one task that
    holds a run at a time.
    """
    order = ["conv_id", "depth", "member"]
    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            columns = [c.to_pylist() for c in batch.columns]
            for node, group in itertools.groupby(zip(*columns), lambda row: row[:2]):
                ids = [str(row[2]) for row in group]
                for low in range(0, len(ids), CHUNK_IDS):
                    text = ",".join(ids[low : low + CHUNK_IDS])
                    rows.append((*node, part, seq, text))
                    seq += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
            names = ["conv_id", "depth", "part", "seq", "ids"]
            arrays = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, k) for a, k in zip(arrays, kinds)], names
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "depth", "ends_sha256"]
        kinds = [pa.int64(), pa.int64(), pa.string()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            arrays = list(zip(*rows)) or [()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(a, k) for a, k in zip(arrays, kinds)], names
            )

        node, state = None, None
        for batch in batches:
            rows = []
            columns = [batch.column(k).to_pylist() for k in (0, 1, 4)]
            for conv_id, depth, ids in zip(*columns):
                if (conv_id, depth) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    rows.append((*node, state.hexdigest()))
                node, state = (conv_id, depth), hashlib.sha256(ids.encode())
            yield batch_of(rows)
        if node is not None:
            yield batch_of([(*node, state.hexdigest())])

    runs = dealt.mapInArrow(
        chunks, "conv_id long, depth long, part int, seq long, ids string"
    )
    return (
        runs.repartition("conv_id", "depth")
        .sortWithinPartitions("conv_id", "depth", "part", "seq")
        .mapInArrow(digest, "conv_id long, depth long, ends_sha256 string")
    )


def node_table(spark: SparkSession, reached: DataFrame) -> DataFrame:
    """One row a node, with its subtree sums and the digest of who ends there.

    ``reached`` is that of ``prefixes``. The root, without a turn, is there if
    there is a conversation; without any the table is empty.
    """
    nodes, steps, ends = trie(spark, reached)
    valued = nodes.withColumns(
        {
            "n_leaves": F.col("leaf").cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    summed = rollup(spark, valued, steps, ["n_leaves", "saved_tokens"])
    children = (
        nodes.where("depth > 0")
        .groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    name = ["conv_id", "depth"]
    return (
        nodes.select(*name, "parent_conv_id", "n_convs")
        .join(summed, name)
        .join(children, name, "left")
        .join(id_digests(ends), name, "left")
        .select(
            *name,
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias(
                "ends_sha256"
            ),
        )
    )


def conversation_nodes(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are.

    Null roles and texts are empty. Turns of one number are ordered by role,
    then hash of the text; repeated rows are turns like others. Rows without a
    conversation are left out. Other columns are ignored.
    """
    turns = keep(spark, numbered(spark, hashed_turns(conversations)), "numbered")
    return node_table(spark, prefixes(spark, with_empty(turns)))


def rebuilt_nodes(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The trie of the query, of conversations that share their starts."""
    turns = numbered(spark, hashed_turns(conversations))
    return node_table(spark, prefixes(spark, shared_starts(spark, turns)))
