"""MinHash near-duplicates: bands find candidates, odd sketches thin them."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.bloom import block_count, blocked_bloom, probed
from headway.llm.common import (
    WORD_BYTES,
    keep,
    lists,
    mix,
    neutral,
    select_as,
    select_back,
    slices,
    text_buffers,
    word_hashes,
)
from headway.llm.components import components, relabel

# A pair at similarity 0.8 shares none of the bands with probability
# (1 - 0.8**6)**48, below one in two million.
BANDS, ROWS = 48, 6
SAMPLES = BANDS * ROWS
# Bits of an odd sketch, as 64-bit words.
SKETCH_WORDS = 8
SKETCH_BITS = 64 * SKETCH_WORDS
# Two sets at similarity s differ in SAMPLES * (1 - s) samples on average, so
# 2 * that many bits are flipped in one sketch and not in the other. At 0.8
# the expected count is 92 and its standard deviation about 9; at or above
# this limit, seven of them away, the similarity is below 0.6.
MAX_ODD_BITS = 156

_seeds = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64))
_FACTORS = (_seeds[:SAMPLES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (_seeds[SAMPLES:] >> np.uint64(32)).astype(np.uint32)
_SAMPLE_KEYS = mix(np.arange(10**6, 10**6 + SAMPLES, dtype=np.uint64))
_CHAIN = np.uint64(0xD6E8FEB86659FD93)

SIGNATURE = (
    "doc_id long, text_key binary, n_shingles long, digest binary, "
    "sketch array<long>, bands array<long>"
)


def text_key(text: Column) -> Column:
    """Names a text, null like the empty one."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text its sorted set of hashed word shingles.

    Words are runs between white space with A to Z in lower case. A text of
    fewer than ``size`` words has its whole sequence as one shingle; one
    without words (or null) has none.
    """
    for _, _, sets in sliced_sets(column, size):
        yield from sets


def sliced_sets(
    column: pa.Array, size: int
) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, end row, sets) of runs of texts of bounded size."""
    for start, end, data, offsets in slices(*text_buffers(column)):
        words, first = word_hashes(data, offsets, WORD_BYTES)
        whole = max(0, len(words) - size + 1)
        chains = words[:whole].copy()
        for j in range(1, size):
            chains = chains * _CHAIN + words[j : whole + j]
        chains = mix(chains)
        sets = []
        for low, high in zip(first[:-1], first[1:]):
            if high - low >= size:
                sets.append(np.unique(chains[low : high - size + 1]))
            elif high > low:
                value = words[low : low + 1]
                for j in range(low + 1, high):
                    value = value * _CHAIN + words[j : j + 1]
                sets.append(mix(value + np.uint64(high - low)))
            else:
                sets.append(chains[:0])
        yield start, end, sets


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a set."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for low in range(0, len(short), 2048):
        part = short[low : low + 2048]
        values = _FACTORS[:, None] * part[None, :]
        values += _SHIFTS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity of the number of samples that fall on each bit."""
    keys = mix(samples.astype(np.uint64) ^ _SAMPLE_KEYS)
    bits = np.bincount(
        (keys % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS
    )
    return np.packbits((bits & 1).astype(np.uint8)).view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One key for each band, with the band's number mixed in."""
    rows = samples.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        keys = mix(keys * _CHAIN + rows[:, j])
    return keys.view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Set size, set digest, odd sketch and band keys of every text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, sets in sliced_sets(batch.column(2), size):
                yield signed(batch.slice(low, high - low), sets)

    def signed(rows: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        digests, sketches, bands, ends = [], [], [], []
        for shingles in sets:
            if len(shingles):
                digests.append(
                    hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                )
                samples = min_hashes(shingles)
                sketches.append(odd_sketch(samples))
                bands.append(band_keys(samples))
            else:
                digests.append(None)
            ends.append(len(bands))
        ends = np.array(ends, np.int64)
        none = np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                rows.column(0),
                rows.column(1),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests, pa.binary()),
                lists(
                    np.concatenate([none, *sketches]), ends * SKETCH_WORDS, pa.int64()
                ),
                lists(np.concatenate([none, *bands]), ends * BANDS, pa.int64()),
            ],
            ["doc_id", "text_key", "n_shingles", "digest", "sketch", "bands"],
        )

    return docs.select(
        F.col("doc_id").cast("long"),
        text_key(F.col("text")).alias("text_key"),
        F.col("text").cast("string"),
    ).mapInArrow(sign, SIGNATURE)


def hashed_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, shingles) with the full hashed set of every text."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, sets in sliced_sets(batch.column(1), size):
                ends = np.cumsum([len(s) for s in sets], dtype=np.int64)
                flat = np.concatenate([np.zeros(0, np.uint64), *sets])
                ids = batch.column(0).slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [ids, lists(flat.view(np.int64), ends, pa.int64())],
                    ["doc_id", "shingles"],
                )

    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    ).mapInArrow(spell, "doc_id long, shingles array<long>")


def near_groups(
    spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Rows are linked when their sets of ``size``-word shingles have a Jaccard
    similarity of at least ``percent`` / 100; ``component_id`` is the
    smallest id reachable over links and ``kept`` marks the row that has it.
    Equal sets are folded into one representative first.
    In each band's bucket all representatives are compared with the bucket's
    smallest, and the confirmed links joined into components; a bucket whose
    members are then in one component needs no more. The members of the other
    buckets are compared with one another by their rarest shingles, see
    ``prefix_pairs``, so no link is lost and no bucket's pairs are all made.
    Pairs pass the odd sketches before their full sets are compared.

    Rows without words are alone in their component. Rows without an id have
    no component and are kept. Repeated rows get equal results; rows of one id
    with other texts are texts like others, whose links are their own. An empty
    table gives none. Other columns are ignored. Banding is made for ``percent``
    of 80 or more. Texts are read whole, in time in proportion to their length.
    """
    return grouped(spark, docs, size, percent).drop("text_key", "label")


def grouped(
    spark: SparkSession, docs: DataFrame, size: int, percent: int
) -> DataFrame:
    """``near_groups`` with the key of each row's text and its group's label.

    Groups that have the same smallest id are still told apart by their label;
    rows without words or id have none.
    """
    signed = keep(spark, signatures(docs, size), "signatures")
    # One row for each distinct set, under a number of its own, as an id may
    # come with several texts. Numbers follow the ids, so the centre of a star
    # is the oldest text, of which the others are likelier copies than of one
    # another.
    folded = keep(
        spark,
        signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("head"))
        .select("digest", "head.doc_id", "head.text_key")
        .orderBy("doc_id", "text_key", "digest")
        .withColumn("rep", F.monotonically_increasing_id()),
        "folded",
    )
    heads = keep(
        spark,
        signed.join(folded, ["digest", "doc_id", "text_key"])
        .select("rep", "n_shingles", "sketch", "bands")
        .dropDuplicates(["rep"]),
        "heads",
    )
    sketches = heads.select("rep", "n_shingles", "sketch")
    spread = heads.select("rep", F.explode("bands").alias("bucket"))
    shared = (
        spread.groupBy("bucket")
        .agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
        .where("low < high")
        .select("bucket")
    )
    crowded = keep(spark, spread.join(shared, "bucket"), "crowded")
    wanted = folded.join(crowded.select("rep").distinct(), "rep", "left_semi")
    sets = _sets_of(spark, docs, wanted.drop("digest"), size)

    stars = crowded.join(
        crowded.groupBy("bucket").agg(F.min("rep").alias("least")), "bucket"
    )
    pairs = stars.where("least < rep").select(
        F.col("least").alias("a"), F.col("rep").alias("b")
    )
    links = keep(spark, _similar(spark, pairs, sketches, sets, percent), "stars")
    labels = components(spark, links)

    placed = crowded.join(
        labels.withColumnRenamed("node", "rep"), "rep", "left"
    ).withColumn("label", F.coalesce("label", "rep"))
    still_open = (
        placed.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
        .select("bucket")
    )
    members = keep(
        spark,
        placed.join(still_open, "bucket").select("rep", "label").distinct(),
        "members",
    )
    linked = folded.select("digest", "doc_id", F.col("rep").alias("label"))
    linked = relabel(linked, "label", labels)
    if not members.isEmpty():
        rest = prefix_pairs(sets.join(members, "rep"), percent)
        found = keep(spark, _similar(spark, rest, sketches, sets, percent), "rest")
        if not found.isEmpty():
            # What the stars have joined stays joined: only labels are linked.
            between = relabel(relabel(found, "a", labels), "b", labels)
            linked = relabel(linked, "label", components(spark, between))
    linked = keep(spark, linked, "linked")
    smallest = linked.groupBy("label").agg(F.min("doc_id").alias("component"))
    named = linked.join(keep(spark, smallest, "smallest"), "label").select(
        "digest", "label", "component"
    )
    placed = signed.select("doc_id", "text_key", "n_shingles", "digest").join(
        named, "digest", "left"
    )
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")
    )
    return placed.select(
        "doc_id",
        "text_key",
        "label",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _sets_of(
    spark: SparkSession, docs: DataFrame, wanted: DataFrame, size: int
) -> DataFrame:
    """(rep, shingles) of the wanted (doc_id, text_key, rep).

    A Bloom filter of bounded size keeps most other texts from the shuffle.
    """
    entry = F.xxhash64("doc_id", "text_key")
    wanted = keep(spark, wanted.withColumn("entry", entry), "wanted")
    blocks = block_count(wanted.count())
    bloom = keep(spark, blocked_bloom(wanted, "entry", blocks), "bloom")
    texts = docs.select(
        F.col("doc_id").cast("long"),
        text_key(F.col("text")).alias("text_key"),
        F.col("text").cast("string"),
    )
    likely = probed(texts, entry, bloom, blocks).where("_possible")
    named = likely.join(wanted.drop("entry"), ["doc_id", "text_key"])
    sets = hashed_sets(named.select(F.col("rep").alias("doc_id"), "text"), size)
    return keep(
        spark, sets.withColumnRenamed("doc_id", "rep").dropDuplicates(["rep"]), "sets"
    )


def prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of different labels that may be similar enough.

    ``sets`` has ``rep``, ``label`` and ``shingles``. Two sets of n and m
    shingles at the wanted similarity share at least
    k = percent * (n + m) / (100 + percent) of them. Where each has its
    shingles in the same order, the rarest first, they share one among the
    first n - k + 1 and m - k + 1. The smaller m, the longer that prefix; a
    set is listed once, under its prefix for the smallest m that can be
    similar, and a pair's own sizes and the places of the shingle where they
    meet decide in the join. Size classes whose ratio is that of the sizes
    which can be similar keep others apart: partners are in one class or in
    neighbours. A shingle whose holders all have one label is left out before
    anything is paired, so variants of one text meet only in shingles that few
    of them have.
    """
    each = sets.select("rep", "label", F.size("shingles").alias("n"), "shingles")
    spread = each.select("rep", "label", "n", F.explode("shingles").alias("shingle"))
    uses = spread.groupBy("shingle").agg(F.count(F.lit(1)).alias("uses"))
    ordered = (
        spread.join(uses, "shingle")
        .groupBy("rep", "label", "n")
        .agg(F.array_sort(F.collect_list(F.struct("uses", "shingle"))).alias("order"))
    )
    # With m at its least, n * percent / 100, k is that too.
    prefix = F.col("n") - F.ceil(F.col("n") * (percent / 100) - 1e-6) + 1
    # Neighbouring classes overlap a little, so that rounding loses none.
    ratio = math.log(100 / percent) + 1e-9
    listed = ordered.select(
        "rep",
        "label",
        "n",
        F.floor(F.log("n") / ratio).cast("int").alias("sizes"),
        F.posexplode(F.slice("order", F.lit(1), prefix.cast("int"))["shingle"]).alias(
            "at", "shingle"
        ),
    )
    listed = keep(sets.sparkSession, listed, "prefixes")
    open_ = (
        listed.groupBy("shingle")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .where("least < most")
        .select("shingle")
    )
    held = listed.join(open_, "shingle")
    others = held.select(
        "shingle",
        *[F.col(c).alias(f"other_{c}") for c in ("rep", "label", "n", "sizes", "at")],
    )
    # Behind the first shingle that two sets share, the shorter rest bounds
    # what else they can.
    bound = F.least(F.col("n") - F.col("at"), F.col("other_n") - F.col("other_at"))
    enough = (100 + percent) * bound >= percent * (F.col("n") + F.col("other_n"))
    near = F.explode(F.array(F.col("sizes") - 1, F.col("sizes"), F.col("sizes") + 1))
    return (
        held.withColumn("other_sizes", near)
        .join(others, ["shingle", "other_sizes"])
        .where((F.col("label") < F.col("other_label")) & enough)
        .select(
            F.least("rep", "other_rep").alias("a"),
            F.greatest("rep", "other_rep").alias("b"),
        )
    )


def odd_bits(left: str, right: str) -> Column:
    """Number of bits in which two sketches differ."""
    return sum(
        F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i]))
        for i in range(SKETCH_WORDS)
    )


def _side(rows: DataFrame, key: str, prefix: str) -> DataFrame:
    return rows.select(
        F.col(rows.columns[0]).alias(key),
        *[F.col(c).alias(f"{prefix}_{c}") for c in rows.columns[1:]],
    )


def _similar(
    spark: SparkSession,
    pairs: DataFrame,
    sketches: DataFrame,
    sets: DataFrame,
    percent: int,
) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    small = F.least("a_n_shingles", "b_n_shingles")
    large = F.greatest("a_n_shingles", "b_n_shingles")
    likely = keep(
        spark,
        pairs.distinct()
        .join(_side(sketches, "a", "a"), "a")
        .join(_side(sketches, "b", "b"), "b")
        .where(100 * small >= percent * large)
        .where(odd_bits("a_sketch", "b_sketch") < MAX_ODD_BITS)
        .select("a", "b")
        .distinct(),
        "likely",
    )
    common = F.size(F.array_intersect("a_shingles", "b_shingles"))
    union = F.size("a_shingles") + F.size("b_shingles") - common
    return (
        likely.join(_side(sets, "a", "a"), "a")
        .join(_side(sets, "b", "b"), "b")
        .where(100 * common >= percent * union)
        .select("a", "b")
        .distinct()
    )


def near_dedup(
    spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` of which each group keeps the smallest id.

    Texts decide, not ids: of rows with one id and unlike texts, each is judged
    by its own group. Of rows with one id in one group (repeated rows, or texts
    that are near one another) the one with the least text stays, and of equal
    rows without words one. Rows without an id stay. An empty table stays empty;
    other columns are kept, whatever their names.
    """
    verdicts = grouped(spark, docs, size, percent).where("doc_id IS NOT NULL")
    verdicts = verdicts.select("doc_id", "text_key", "label", "kept")
    # Wordless texts are in no group but that of their equals.
    place = ["doc_id", "label", F.when(F.col("label").isNull(), F.col("text_key"))]
    again = F.count(F.lit(1)).over(Window.partitionBy(*place)) > 1
    doubtful = keep(
        spark,
        verdicts.withColumn("again", F.col("kept") & again)
        .where("again OR NOT kept")
        .distinct()
        .withColumn("entry", F.xxhash64("doc_id", "text_key")),
        "verdicts",
    )
    # Nearly all other texts are kept from the shuffle by a filter.
    blocks = block_count(doubtful.count())
    bloom = keep(spark, blocked_bloom(doubtful, "entry", blocks), "bloom")
    names = neutral(docs.columns)
    own = select_as(docs, names)
    doc_id, text = F.col(names["doc_id"]).cast("long"), F.col(names["text"])
    own = own.withColumn("doc_id", doc_id).withColumn("text_key", text_key(text))
    entry = F.xxhash64("doc_id", "text_key")
    judged = probed(own, entry, bloom, blocks)
    likely = judged.where("_possible AND doc_id IS NOT NULL")
    clear = judged.where("NOT _possible OR doc_id IS NULL").select(*names.values())
    met = likely.join(doubtful.drop("entry"), ["doc_id", "text_key"], "left")
    order = Window.partitionBy(*place).orderBy(
        names["text"], *[n for n in names.values() if n != names["text"]]
    )
    once = met.where("again").withColumn("nth", F.row_number().over(order))
    rest = met.where("kept IS NULL").select(*names.values())
    staying = clear.unionAll(rest).unionAll(
        once.where("nth = 1").select(*names.values())
    )
    return select_back(staying, names)
