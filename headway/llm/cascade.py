"""Quality rules as a short-circuit cascade of cheap and selective rules."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import keep, neutral, select_as, select_back

# Rows on which the cost and the selectivity of each rule are measured. Only
# the order of the rules depends on them, never a verdict.
SAMPLE_ROWS = 400
# How often a rule is applied to every row of the sample in one measurement,
# and how many measurements are made, of which the shortest counts.
REPEATS, TRIES = 20, 3
# The share of a document's words that may be in repeated windows, the number
# of words it needs, and the length of a window: fixed by the base rules.
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20

_SPACE = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A named rule; a document for which ``fails`` is true is rejected."""

    name: str
    fails: Column


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among the given ones."""
    rest = F.translate(text, characters, "")
    return (F.length(text) - F.length(rest)).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(
        F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    )
    return F.transform(
        F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))
    )[0].cast("long")


def repeated_words(words: Column) -> Column:
    """Words in windows that are found at least twice in the text.

    Windows are hashed. Where all hashes differ, as in most texts, nothing
    more is done. Else they are sorted with their places, the places of
    repeated ones sorted again, and each covers the words up to the next.
    """
    def hashes(held: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(held) - WINDOW),
            lambda i: F.xxhash64(*[F.get(held, i + j) for j in range(WINDOW)]),
        )

    def cover(windows: Column) -> Column:
        placed = F.array_sort(
            F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def places(rows: Column) -> Column:
            twice = F.filter(
                rows,
                lambda r, k: (r["h"] == F.get(rows, k + 1)["h"])
                | F.coalesce(r["h"] == F.get(rows, k - 1)["h"], F.lit(False)),
            )
            return F.array_sort(F.transform(twice, lambda r: r["i"]))

        def spans(at: Column) -> Column:
            return F.aggregate(
                F.transform(
                    at,
                    lambda p, k: F.least(
                        F.lit(WINDOW),
                        F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)),
                    ),
                ),
                F.lit(0),
                lambda total, n: total + n,
            )

        return _let(_let(placed, places), spans)

    # The words are bound first: where a filter is pushed below the column
    # that holds them, they would be split anew for every window.
    return _let(
        words,
        lambda held: F.when(F.size(held) < WINDOW, 0).otherwise(
            _let(
                hashes(held),
                lambda w: F.when(
                    F.size(F.array_distinct(w)) == F.size(w), 0
                ).otherwise(cover(w)),
            )
        ),
    ).cast("long")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words`` and ``base_failed``.

    A null text counts as empty. Existing columns of these names are
    replaced; all rows stay.
    """
    names = [
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
    ]
    own = neutral([c for c in docs.columns if c not in names])
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    split = select_as(docs, own, body.alias("body"), words_of(body).alias("words"))
    counted = split.select(
        *own.values(),
        F.size("words").cast("long").alias("n_words"),
        (F.length("body") - count_of(F.col("body"), _SPACES)).alias("word_chars"),
        count_of(F.col("body"), _SYMBOLS).alias("n_symbols"),
        repeated_lines(F.col("body")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    failed = (F.col("n_words") < MIN_WORDS) | repeats
    judged = counted.withColumn("base_failed", failed)
    return select_back(judged, own, *names)


def default_rules(text: str = "text") -> list[Rule]:
    """Rules on the measures, cheap, and on the text itself, dearer."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    n_words, chars = F.col("n_words"), F.col("word_chars")
    letters = F.length(F.regexp_replace(body, r"[^\p{L}]+", ""))
    return [
        Rule("short_words", chars < 2 * n_words),
        Rule("long_words", chars > 20 * n_words),
        Rule("symbols", 20 * F.col("n_symbols") > chars),
        Rule("lines", 2 * F.col("n_dup_lines") > F.size(F.split(body, "\n", -1))),
        Rule("letters", 2 * letters < chars),
    ]


def hashed_sample(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """The ``rows`` rows whose texts have the smallest hashes.

    Wherever a row is stored, it is as likely to be in the sample as any
    other; each task passes on no more than ``rows`` rows.
    """
    names = neutral(docs.columns)
    place = F.xxhash64(names[text], F.lit(SAMPLE_ROWS))
    least = select_as(docs, names).orderBy(place).limit(rows)
    return select_back(least, names)


def ordered(
    spark: SparkSession, sample: DataFrame, rules: Sequence[Rule]
) -> list[Rule]:
    """The rules by rejection per cost on a written sample, the best first.

    The cost of a rule is the time that a row takes: each row is judged
    ``REPEATS`` times within the same tasks, the shortest of ``TRIES`` runs
    counts, and as many repeats without a rule are taken off, so that neither
    starting a job nor compiling it counts. Ties keep the given order.
    """
    total = sample.count()
    again = sample.withColumn(
        "_again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS)))
    )

    def seconds(verdict: Column) -> tuple[float, int]:
        # The repeat is part of the sum, so that none can be left out.
        asked = again.agg(
            F.sum(F.when(verdict, F.col("_again")).otherwise(F.lit(0))),
            F.count_if(verdict & (F.col("_again") == 1)),
        )
        times = []
        for _ in range(TRIES):
            start = time.perf_counter()
            rejected = asked.first()[1]
            times.append(time.perf_counter() - start)
        return min(times), rejected

    least, _ = seconds(F.col("_again") < 0)
    worth = []
    for place, rule in enumerate(rules):
        taken, rejected = seconds(rule.fails)
        cost = max(taken - least, 1e-4) / (REPEATS * max(total, 1))
        worth.append((-rejected / max(total, 1) / cost, place, rule))
    return [rule for _, _, rule in sorted(worth, key=lambda w: w[:2])]


def passes(rules: Sequence[Rule]) -> Column:
    """Whether no rule rejects; a rule runs only if all before it passed."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.fails, F.lit(False)), False).otherwise(
            verdict
        )
    return verdict


def judge(
    spark: SparkSession,
    docs: DataFrame,
    rules: Sequence[Rule] | None = None,
    text: str = "text",
) -> DataFrame:
    """``docs`` with its measures and ``kept``.

    The base rules come first and are final. The others run in the order of
    rejection per cost, each only on documents that all before it passed. The
    order has no effect on ``kept``. Null texts are empty and repeated rows
    stay. An empty table gives an empty result.

    The base measures are asked for on every row and are no part of the
    cascade; only the sample is measured for the order, not the table.
    """
    rules = default_rules(text) if rules is None else rules
    measured = measures(docs, text)
    sample = keep(
        spark,
        measures(hashed_sample(docs, text), text).where("NOT base_failed"),
        "sample",
    )
    order = ordered(spark, sample, rules)
    return measured.withColumn(
        "kept", F.when(F.col("base_failed"), False).otherwise(passes(order))
    )
