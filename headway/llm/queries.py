"""One query for each operator, over the whole of its intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import (
    bpe,
    cascade,
    license_scan,
    mixing,
    near_dedup,
    periodic_runs,
    prefix_trie,
    quality,
    secret_scan,
    spotsigs,
    token_counts,
    url_filter,
    warc,
)
from headway.llm.common import bounded_batches, table
from headway.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the URL query as (verdict, host, path).
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.counted(table(spark, sf, "documents"))


def fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return spotsigs.compare_edited(spark, table(spark, sf, "documents"))


def quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score(
        spark,
        table(spark, sf, "documents").select("doc_id", "text", "lang", "source"),
        table(spark, sf, "labels"),
    ).drop("text")


def token_ids(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(spark, table(spark, sf, "documents"))


def near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_groups(spark, table(spark, sf, "documents"), size=2)


def listed_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs of pages that were reached over a tracking link."""
    tracked = pages.where(F.col("url").rlike(r"[?&]utm_"))
    return tracked.select(
        url_filter.canonical(*url_filter.url_parts(F.col("url"))).alias("canonical")
    )


def url_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filter.judge_urls(spark, pages, listed_urls(pages), URL_RULES).drop(
        "url"
    )


def edited_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Three edits of every document: its first words put in the middle, ten
    characters taken out at a quarter, and a sentence added."""
    state = token_counts.build_state(table(spark, sf, "documents"))
    n = F.length("text").cast("long")

    def edit(start, end, insert):
        return F.struct(
            start.cast("long").alias("start"),
            end.cast("long").alias("end"),
            insert.alias("insert"),
        )

    middle, quarter = F.floor(n / 2), F.floor(n / 4)
    edits = F.array(
        edit(middle, middle, F.substring("text", 1, 40)),
        edit(quarter, quarter + 10, F.lit("")),
        edit(n + 100, n + 100, F.lit(" It's the end.")),
    )
    changed = token_counts.apply_edits(state.withColumn("edits", edits))
    return changed.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "n_before",
        "n_after",
        "n_encoded",
    )


def mixing_rates(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(
        spark,
        table(spark, sf, "documents").select("doc_id", "text"),
        table(spark, sf, "labels"),
    ).drop("text")


def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return cascade.judge(
        spark, table(spark, sf, "documents").select("doc_id", "text")
    ).drop("text")


def warc_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_round_trip(spark, table(spark, sf, "pages"))


def conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.rebuilt_nodes(spark, table(spark, sf, "conversations"))


def licenses(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.license_labels(spark, table(spark, sf, "documents"))


def word_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf, "documents"))


_QUERIES: dict[str, Query] = {
    "op1_secret_scan": secrets,
    "op2_spot_signatures": fingerprints,
    "op3_quality_classifier": quality_scores,
    "op4_byte_bpe": token_ids,
    "op5_near_duplicates": near_duplicates,
    "op6_url_filter": url_verdicts,
    "op7_edited_token_counts": edited_token_counts,
    "op8_mixing_rates": mixing_rates,
    "op9_quality_rules": quality_rules,
    "op10_warc_round_trip": warc_round_trip,
    "op11_prefix_trie": conversation_trie,
    "op12_license_scan": licenses,
    "op13_periodic_runs": word_runs,
}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        bounded_batches(spark)
        return query(spark, sf_dir)

    return run


def registered() -> dict[str, Query]:
    return {name: _shipped(query) for name, query in _QUERIES.items()}
