"""URL filters: host and path rules, then a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.bloom import block_count, blocked_bloom, probed
from headway.llm.common import keep, neutral, select_as, select_back

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

Rule = tuple[str, str, str]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): both empty for null or a URL without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return (
        lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)),
        F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1),
    )


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` and path without closing slashes."""
    return F.concat(
        F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", "")
    )


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null.

    A rule (verdict, host, path) fits its host and all subdomains if the path
    starts with the rule's. Of equally long rules the first counts.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    longest_first = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    for verdict, at, start in reversed(longest_first):
        fits = (
            (host == at) | host.endswith(f".{at}")
        ) & path.startswith(start)
        found = F.when(
            fits,
            F.struct(
                F.lit(at + start).alias("rule"), F.lit(verdict).alias("verdict")
            ),
        ).otherwise(found)
    return found


def judge_urls(
    spark: SparkSession,
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A page that a rule fits gets the rule's verdict. Of the others, those
    whose canonical URL is in ``listed(canonical)`` are blocked: a blocked
    Bloom filter, bounded in size and therefore broadcast,
    passes possible hits, and only these are joined with the list itself.
    Null or malformed URLs have empty parts and are never listed. Every row
    stays, repeated ones too; existing columns of the new names are replaced.
    An empty list blocks nothing.
    """
    made = ["host", "path", "rule", "verdict"]
    names = neutral([c for c in pages.columns if c not in made])
    host, path = url_parts(F.col(f"`{url}`"))
    parts = select_as(pages, names, host.alias("host"), path.alias("path"))
    ruled = parts.select(
        "*",
        matching_rule(F.col("host"), F.col("path"), rules).alias("found"),
        canonical(F.col("host"), F.col("path")).alias("canonical"),
    )
    listed = keep(
        spark,
        listed.select("canonical")
        .where("canonical IS NOT NULL AND canonical <> ''")
        .distinct(),
        "listed",
    )
    blocks = block_count(listed.count())
    filter_ = keep(spark, blocked_bloom(listed, "canonical", blocks), "bloom")
    seen = probed(ruled, F.col("canonical"), filter_, blocks)
    # Without a key a page joins nothing: only possible hits are shuffled.
    possible = F.col("_possible") & F.col("found").isNull()
    seen = seen.withColumn("key", F.when(possible, F.col("canonical")))
    exact = listed.select(F.col("canonical").alias("key"), F.lit(True).alias("hit"))
    passed = seen.where("key IS NOT NULL").join(exact, "key", "left")
    clear = seen.where("key IS NULL").withColumn(
        "hit", F.lit(None).cast("boolean")
    )
    judged = passed.unionByName(clear).select(
        *names.values(),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(
            F.col("found.verdict"),
            F.when(F.col("hit"), "block").otherwise("allow"),
        ).alias("verdict"),
    )
    return select_back(judged, names, *made)
