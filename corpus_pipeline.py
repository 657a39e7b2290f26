"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last
give the columns of ``documents``. Null texts are empty, empty tables stay
empty, and rows without an id pass through the near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, mixing, near_dedup, quality, secret_scan
from headway.llm.common import bounded_batches, keep, table
from headway.session import ship_package

# The share of tokens that each domain should have.
TARGETS = mixing.TARGETS


def _ready(spark: SparkSession) -> None:
    """What the stages' Python steps need of a session."""
    ship_package(spark)
    bounded_batches(spark)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, with its site's evidence, keeps."""
    _ready(spark)
    scored = quality.score(spark, docs, table(spark, sf_dir, "labels"))
    return scored.where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group alike in at least 0.8 of its five-word
    shingles: the one with the smallest id."""
    _ready(spark)
    return near_dedup.near_dedup(spark, docs, size=5, percent=80)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    _ready(spark)
    return secret_scan.redact(docs)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say: repeated or left out.

    Copies have the rates as their means, so that the shares are kept, and
    clean documents have rates of one or more, so that all of them stay.
    """
    _ready(spark)
    mixed = mixing.mix(spark, docs, table(spark, sf_dir, "labels"), TARGETS)
    copies = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return (
        mixed.where("copies > 0")
        .select(*docs.columns, F.explode(copies).alias("_copy"))
        .drop("_copy")
    )


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and whether these decode to them."""
    _ready(spark)
    coded = bpe.encode(spark, docs, decoded="decoded")
    return coded.withColumn(
        "round_trip",
        F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary"),
    ).drop("text", "decoded")


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing_to_targets),
    ("byte-level BPE encoding and decoding", byte_level_bpe),
]

# The classifier, the mixing rates and the merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(spark, stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
