import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from headway.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """Turns of each conversation, ties by role, then hash of role and text."""

    def place(row):
        _, turn, role, text = row
        role, text = role or "", text or ""
        content = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        return (turn is not None, turn or 0, role, content)

    convs = {}
    for row in sorted((r for r in rows if r[0] is not None), key=place):
        convs.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    return convs


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    nodes = []
    for seq, held in members.items():
        below = {s: m for s, m in members.items() if s[: len(seq)] == seq}
        children = [s for s in below if len(s) == len(seq) + 1]
        leaves = [s for s in below if not any(t[: len(s)] == s and len(t) > len(s) for t in below)]
        saved = sum(
            (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1]))
            for s, m in below.items() if s
        )
        ends = ",".join(str(c) for c in sorted(c for c in held if len(convs[c]) == len(seq)))
        nodes.append((
            min(held), len(seq), min(members[seq[:-1]]) if seq else None, len(held),
            len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(map(repr, nodes))


def shown(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_nodes_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for c in [*range(45), -3, -25, 10**12, 10**12 + 1]:
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice("ua"), " ".join(rng.choice("xyz") for _ in range(rng.randint(1, 2)))))
    rows += [(50, None, None, None), (50, None, "u", ""), (50, 0, "u", "b"), (50, 0, "a", "b")]
    rows += [(51, 1, "u", "same")] * 3 + [(None, 0, "u", "x")]
    rows += [(52, 0, "1:u", "a"), (53, 0, "u", "a bé c")]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("part", F.lit("p"))
    convs = ordered(rows)
    assert shown(pt.rebuilt_nodes(spark, table)) == brute(rebuilt(convs))
    assert shown(pt.conversation_nodes(spark, table)) == brute(convs)


def test_long_chain_that_lies_in_many_ranges(spark):
    """One conversation holds most rows; another leaves it half way."""
    rows = [(7, t, "u", f"t{t % 5} x") for t in range(600)]
    rows += [(9, t, "u", f"t{t % 5} x" if t < 300 else f"y{t}") for t in range(400)]
    rows += [(c, 0, "u", "t0 x") for c in range(20, 60)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = pt.numbered(spark, pt.hashed_turns(table)).toPandas()
        got = {tuple(r) for r in pt.conversation_nodes(spark, table).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    long = turns[turns.conv_id == 7]
    assert long.part.nunique() > 2
    assert sorted(long.i) == list(range(600))
    assert len(got) == 1 + 600 + 100
    by_name = {(r[0], r[1]): r for r in got}
    assert by_name[7, 600][2:7] == (7, 1, 0, 1, 0)
    # Shared: 300 turns of two conversations, the first by 42.
    assert by_name[7, 0][3:7] == (42, 1, 2, 2 * 41 + 299 * 2)
    assert by_name[7, 2][5:7] == (2, 299 * 2)
    assert by_name[9, 301][2] == 7


@pytest.mark.parametrize("shape", ["path", "star", "comb", "random"])
def test_subtree_sums_of_any_shape(spark, shape):
    rng = random.Random(shape)
    if shape == "path":
        sequences = [list(range(70))]
    elif shape == "star":
        sequences = [[i] for i in range(70)]
    elif shape == "comb":
        sequences = [[0] * i + [1, 2] for i in range(25)] + [[0] * 25]
    else:
        sequences = [[rng.randrange(2) for _ in range(rng.randint(0, 8))] for _ in range(60)]
    rows = [
        (c, d, "u", " ".join(["w"] * (1 + s % 3)) + str(s))
        for c, seq in enumerate(sequences)
        for d, s in enumerate(seq)
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    assert shown(pt.conversation_nodes(spark, table)) == brute(ordered(rows))


def test_many_ids_of_one_node_are_hashed_in_runs(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK_IDS", 7)
    ids = [*range(-30, 100), 10**12]
    ends = spark.createDataFrame([(-30, 2, c) for c in ids] + [(5, 1, 5)], "conv_id long, depth long, member long")
    got = {r.depth: r.ends_sha256 for r in pt.id_digests(ends.repartition(5)).collect()}
    want = ",".join(str(c) for c in sorted(ids))
    assert got == {
        2: hashlib.sha256(want.encode()).hexdigest(),
        1: hashlib.sha256(b"5").hexdigest(),
    }


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert pt.rebuilt_nodes(spark, none).count() == 0
    only_null = spark.createDataFrame([(None, 0, "u", "x")], SCHEMA)
    assert pt.rebuilt_nodes(spark, only_null).count() == 0


def test_a_text_of_a_million_characters(spark):
    rows = [(c, 0, "u", "word " * 200_000) for c in (20, 21, 22)]
    got = pt.conversation_nodes(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.depth, r.saved_tokens) for r in got) == [(0, 400_000), (1, 400_000)]
