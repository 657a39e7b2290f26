"""SpotSigs fingerprints: chains of content words after common words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from headway.llm.common import keep

# Frequent function words of English, French, German and
# Spanish, at which signatures are anchored.
ANCHORS = (
    "a an and are as at be by for from has he in is it of on or that the this "
    "to was were will with "
    "au aux avec ce dans de des du elle en est et il la le les ne pas par pour "
    "qui que se sur un une "
    "als am auf aus das dem den der die ein eine er es für ich im ist mit nicht "
    "sich sie so und von war zu "
    "al como con del el era ha los las lo más no para por si su sus una y"
).split()
# Content words in a chain.
CHAIN = 2
# Ranges of document ids between which the order is stitched; a fixed number,
# a power of two, so their first rows are few at any size.
RANGES = 4096


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def signatures(text: Column) -> Column:
    """The sorted distinct signature hashes of a text, never empty.

    Words are runs of letters and digits in lower case. Each word is an
    anchor or a content word, so the content words before the j-th anchor, at
    place p, are p - j: its chain is found without a search. A text without
    a full chain has the pairs of its words instead, and one without these
    its whole self, so that such texts are alike only if they are equal.
    """
    body = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(
        F.split(F.lower(body), r"[^\p{L}\p{N}]+"), lambda w: w != ""
    )

    def chains(held: Column) -> Column:
        content = F.filter(held, lambda w: ~w.isin(ANCHORS))
        anchors = F.filter(
            F.transform(
                held, lambda w, i: F.when(w.isin(ANCHORS), i).otherwise(-1)
            ),
            lambda p: p >= 0,
        )
        return _let(
            F.struct(held.alias("w"), content.alias("c"), anchors.alias("a")),
            lambda s: F.transform(
                F.filter(
                    s["a"], lambda p, j: p - j + CHAIN <= F.size(s["c"])
                ),
                lambda p, j: F.xxhash64(
                    F.get(s["w"], p),
                    *[F.get(s["c"], p - j + k) for k in range(CHAIN)],
                ),
            ),
        )

    def pairs(held: Column) -> Column:
        return F.transform(
            F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get(held, i + 1)),
        )

    def known(held: Column) -> Column:
        return _let(
            chains(held),
            lambda c: F.when(F.size(c) > 0, c).when(
                F.size(held) > 1, pairs(held)
            ).otherwise(F.array(F.xxhash64(body))),
        )

    # 32 bits are enough to tell the signatures of two texts apart.
    short = F.transform(
        _let(words, known), lambda h: F.shiftrightunsigned(h, 32)
    )
    return F.array_sort(F.array_distinct(short))


def fingerprint(signs: Column) -> Column:
    """A signature set as text: eight hexadecimal digits for each."""
    return F.array_join(
        F.transform(signs, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), ""
    )


def likeness(left: Column, right: Column, threshold: float = 0.0) -> Column:
    """Jaccard similarity of two sets, 0 if it is under ``threshold``.

    It is at most the ratio of the set sizes; a pair that cannot reach the
    threshold is settled by its sizes.
    """
    small = F.least(F.size(left), F.size(right))
    large = F.greatest(F.size(left), F.size(right))
    exact = _let(
        F.size(F.array_intersect(left, right)),
        lambda n: n / (F.size(left) + F.size(right) - n),
    )
    full = (
        F.when(large == 0, 1.0)
        .when(small < threshold * large, 0.0)
        .when(left == right, 1.0)
        .otherwise(exact)
    )
    return F.when(full >= threshold, full).otherwise(0.0)


def length_partition(size: Column, threshold: float) -> Column:
    """The partition of a set size: sizes within ``threshold`` of one another
    are in the same or in neighbouring partitions."""
    width = 1 / threshold
    return F.floor(F.log(F.greatest(size, F.lit(1))) / F.log(F.lit(width))).cast(
        "int"
    )


def similar_pairs(
    spark: SparkSession, prints: DataFrame, threshold: float = 0.8
) -> DataFrame:
    """(a, b, likeness) for ``prints(id, signs)`` with likeness of at least
    ``threshold``, between the smallest ids of equal sets.

    Sets are partitioned by their length, and a set is compared within its
    partition and with the next one. Two sets so alike share one of their
    rarest signatures: those beyond the first (1 - threshold) of a set, in
    order of frequency, cannot hold all that they share. Only sets that meet
    in such a signature are compared. Ids that are null are left out; a
    threshold must be over 0.
    """
    heads = keep(
        spark,
        prints.where("id IS NOT NULL")
        .groupBy("signs")
        .agg(F.min("id").alias("id"))
        .withColumn("part", length_partition(F.size("signs"), threshold)),
        "spots",
    )
    spread = heads.select("id", "part", F.size("signs").alias("n"), F.explode("signs").alias("sign"))
    counts = spread.groupBy("sign").agg(F.count(F.lit(1)).alias("uses"))
    ranked = spread.join(counts, "sign").groupBy("id", "part", "n").agg(
        F.array_sort(F.collect_list(F.struct("uses", "sign"))).alias("order")
    )
    reach = F.col("n") - F.ceil(F.col("n") * threshold) + 1
    rare = keep(
        spark,
        ranked.select(
            "id",
            "part",
            F.explode(F.slice("order", F.lit(1), reach.cast("int"))["sign"]).alias("sign"),
        ),
        "rare",
    )
    near = rare.select(
        F.col("id").alias("other"),
        F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"),
        F.col("part").alias("other_part"),
        "sign",
    )
    met = (
        rare.join(near, ["part", "sign"])
        .where((F.col("other_part") > F.col("part")) | (F.col("other") > F.col("id")))
        .where(F.col("other") != F.col("id"))
        .select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
        .distinct()
    )
    left = heads.select(F.col("id").alias("a"), F.col("signs").alias("a_signs"))
    right = heads.select(F.col("id").alias("b"), F.col("signs").alias("b_signs"))
    return (
        met.join(left, "a")
        .join(right, "b")
        .select("a", "b", likeness(F.col("a_signs"), F.col("b_signs"), threshold).alias("likeness"))
        .where(F.col("likeness") > 0)
    )


def descending_range(docs: DataFrame) -> Column:
    """The range of a row's ``doc_id``, counting down as the ids do.

    Bounds are approximate quantiles of the ids, a fixed number of them, so
    that ranges hold about equally many rows wherever the ids lie; a row's
    range is found by bisection. Rows without an id come last.
    """
    shares = ",".join(f"{i / RANGES!r}D" for i in range(1, RANGES))
    bounds = docs.agg(
        F.expr(f"percentile_approx(doc_id, array({shares}), {16 * RANGES})")
    ).first()[0]
    below = F.lit(0)
    if bounds:
        held = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
        halves = F.array(*[F.lit(1 << k) for k in reversed(range(RANGES.bit_length() - 1))])
        below = F.aggregate(
            halves,
            F.lit(0),
            lambda n, step: n
            + F.when(F.get(held, n + step - 1) <= F.col("doc_id"), step).otherwise(0),
        )
    return F.when(F.col("doc_id").isNull(), RANGES).otherwise(RANGES - 1 - below)


def with_next(
    spark: SparkSession, docs: DataFrame, text: str, **derived: Column
) -> DataFrame:
    """``docs`` with the ``derived`` columns and ``next``, a struct of ``text``
    and these of the next document.

    The order is descending ``doc_id``, null last, then the text; after the
    last comes the first. Ids are cut into ranges; windows order each range
    by itself, and the first row of the range that follows, one of a fixed
    number, is added to its end. Columns are derived after that, once a row.
    """
    placed = docs.withColumn("_range", descending_range(docs))
    # Ids first, so that texts are read only for the first row of each range.
    tops = keep(
        spark,
        placed.groupBy("_range").agg(F.max("doc_id").alias("top")),
        "tops",
    ).select("top")
    firsts = keep(
        spark,
        placed.join(
            F.broadcast(tops), F.col("doc_id").eqNullSafe(F.col("top")), "left_semi"
        )
        .groupBy("_range")
        .agg(F.min(text).alias("_head")),
        "heads",
    )
    # At most RANGES + 1 rows: the one window over all of them is small.
    around = Window.orderBy("_range")
    first = F.first("_head").over(
        around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    closing = firsts.select(
        F.coalesce(F.lead("_head").over(around), first).alias(text),
        "_range",
        F.lit(1).alias("_closing"),
    )
    inside = Window.partitionBy("_range").orderBy(
        "_closing", F.desc_nulls_last("doc_id"), F.col(text).asc_nulls_first()
    )
    return (
        placed.withColumn("_closing", F.lit(0))
        .unionByName(closing, allowMissingColumns=True)
        .withColumns(derived)
        .withColumn("next", F.lead(F.struct(text, *derived)).over(inside))
        .where("_closing = 0")
        .drop("_range", "_closing")
    )


def edited_text(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many (or
    all) of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - half),
        F.substring(following, F.lit(1), half),
    )


def compare_edited(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts.

    ``near_edited`` and ``near_next`` are the likeness of a document's
    fingerprint to its edited text's and to the next document's. Null texts
    are empty; repeated rows follow each other in the order of their texts; a
    single document follows itself, and an empty table stays empty. Texts are
    taken whole, in linear time. Other columns of ``docs`` are left out.
    """
    plain = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    followed = with_next(spark, plain, "text", signs=signatures(F.col("text")))
    edited = followed.select(
        "doc_id",
        "text",
        "signs",
        F.col("next.signs").alias("next_signs"),
        edited_text(F.col("text"), F.col("next.text")).alias("edited"),
    ).withColumn("edited_signs", signatures(F.col("edited")))
    return edited.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("signs")).alias("fingerprint"),
        fingerprint(F.col("edited_signs")).alias("edited_fingerprint"),
        likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"),
        likeness(F.col("signs"), F.col("next_signs")).alias("near_next"),
    )
