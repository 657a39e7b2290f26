"""Mixing to target weights by soft membership of documents in domains."""

from __future__ import annotations

import logging
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import classifier
from headway.llm.common import keep, neutral, select_as, select_back

# Domains that the labelled table defines.
DOMAINS = ("clean", "low", "toxic")
# Share of all tokens that each domain should have.
TARGETS = {"clean": 0.99, "low": 0.006, "toxic": 0.004}
# Steps of the descent at most, the gap in shares of all tokens at which it
# ends, and what keeps rates near one where the targets leave a choice.
STEPS = 40
CLOSE = 1e-4
RIDGE = 0.002
# Added to the curvature, which has no inverse where all posteriors are alike.
DAMPING = 1e-4
# The fit of a corpus also ends where a step moves no gap by so much: targets
# that no rates meet, as each document holds a little of every domain.
SETTLED = CLOSE / 4
# Documents of which at least CLEAN is of the first domain are to stay. Their
# rates go down to KEPT of what that domain needs on average (or of one), and
# all rates are scaled so that none of these is below one.
CLEAN, KEPT = 0.5, 0.8

_log = logging.getLogger(__name__)


def domain_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, target): 2 toxic, 1 low quality, 0 clean."""
    return labels.where("quality IS NOT NULL").select(
        "doc_id",
        F.when(F.col("toxic") == 1, 2)
        .when(F.col("quality") == 1, 0)
        .otherwise(1)
        .alias("target"),
    )


def memberships(docs: DataFrame, text: str, model: classifier.Model) -> DataFrame:
    """``docs`` with ``n_tokens``, its words, and ``p_<domain>`` posteriors."""
    found = classifier.predict(docs, text, model)
    return found.select(
        *docs.columns,
        F.col("n_words").alias("n_tokens"),
        *[F.col("posteriors")[k].alias(f"p_{d}") for k, d in enumerate(DOMAINS)],
    )


def rate_after(
    history: list[list[float]],
    posteriors: list[Column],
    least: Column | None = None,
) -> Column:
    """A document's rate after the steps taken so far.

    Each step moves the rate along the posteriors and back towards one, and
    projects it to ``least`` (zero) or more. A step is a handful of numbers,
    so the rate is computed from the steps and never stored.
    """
    least = F.lit(0.0) if least is None else least
    rate = F.lit(1.0)
    if not history:
        return rate
    steps = F.array(*[F.array(*[F.lit(g) for g in step]) for step in history])
    return F.aggregate(
        steps,
        rate,
        lambda r, g: F.greatest(
            least,
            r * (1 - RIDGE)
            + RIDGE
            + sum(
                (g[k] * p for k, p in enumerate(posteriors)), F.lit(0.0)
            ),
        ),
    )


def fit_rates(
    members: DataFrame,
    targets: Mapping[str, float],
    steps: int = STEPS,
    least: Column | None = None,
    settled: float = 0.0,
) -> list[list[float]]:
    """The steps of a projected-gradient least-squares fit.

    ``members`` has ``n_tokens`` and ``p_<domain>``. Rates start at one. The
    error is the squared gap between each domain's expected tokens, over all
    documents, and its target, as shares of all tokens, and a small ridge
    towards one. The gradient of a rate needs only the gaps, which one
    grouped sum a step gives; nothing of a document reaches the driver. The
    gradient is scaled by the inverse curvature among the domains, a matrix as
    small as their number, so that a few steps are enough. Rates stay at
    ``least`` or above, and the fit also ends with a step that moves all gaps
    by less than ``settled``.
    """
    names = list(targets)
    columns = [F.col(f"p_{d}") for d in names]
    tokens = F.col("n_tokens").cast("double")
    size = members.agg(
        F.sum(tokens),
        *[F.sum(tokens * a * b) for a in columns for b in columns],
    ).first()
    total = size[0] or 0.0
    if total <= 0:
        return []
    k = len(names)
    # Curvature: outer products of posteriors, weighed by tokens.
    gram = np.array([[size[1 + i * k + j] / total for j in range(k)] for i in range(k)])
    scale = np.linalg.inv(gram + DAMPING * np.eye(k))
    wanted = [targets[d] / sum(targets.values()) for d in names]
    history: list[list[float]] = []
    before = [np.inf] * k
    for _ in range(steps):
        rate = rate_after(history, columns, least)
        # The rates mix with the posteriors, so one scan gives all domains.
        shares = members.agg(
            *[F.sum(tokens * rate * p) / total for p in columns]
        ).first()
        gaps = [wanted[i] - shares[i] for i in range(k)]
        moved = max(abs(a - b) for a, b in zip(gaps, before))
        if max(map(abs, gaps)) < CLOSE or moved < settled:
            break
        before = gaps
        history.append([float(x) for x in scale @ np.array(gaps)])
    return history


def residuals(
    rated: DataFrame, targets: Mapping[str, float], used: str = "rate"
) -> dict[str, float]:
    """How far each domain's share of the tokens is from its target.

    Tokens count as often as the column ``used`` of ``rated`` says: ``rate``,
    or ``copies`` for what is written.
    """
    tokens = F.col("n_tokens") * F.col(used)
    size = rated.agg(F.sum(tokens), *[F.sum(tokens * F.col(f"p_{d}")) for d in targets])
    total, *held = size.first()
    if not total:
        return {}
    wanted = sum(targets.values())
    return {d: x / total - targets[d] / wanted for d, x in zip(targets, held)}


def mix(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] | None = None,
    rows: int = classifier.SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` with ``n_tokens``, posteriors, ``rate`` and ``copies``.

    ``rate`` is how often a document should be used, so that the domains'
    shares of the expected tokens come as close to ``targets`` as rates can
    that leave no clean document out; ``copies`` is a whole number of that
    mean, by a hash of the id, or of the text where there is none. Clean
    documents, those with ``CLEAN`` of the first domain, have rates and copies
    of one or more: all rates are scaled by one factor for it, which leaves
    the shares. What is left of the gaps is logged, see ``residuals``. All
    rows stay, and repeated rows get the same rate. A document without words
    keeps the rate that its posteriors give. Existing columns of the new names
    are replaced.
    """
    targets = TARGETS if targets is None else targets
    made = ["n_tokens", *[f"p_{d}" for d in DOMAINS], "rate", "copies"]
    model = classifier.fit(
        classifier.labelled_sample(docs, domain_labels(labels), rows),
        len(DOMAINS),
        rows,
    )
    names = neutral([c for c in docs.columns if c not in made])
    members = memberships(select_as(docs, names), names["text"], model)
    held = keep(
        spark, members.select("n_tokens", *[f"p_{d}" for d in targets]), "members"
    )
    posteriors = [F.col(f"p_{d}") for d in targets]
    clean = F.col(f"p_{DOMAINS[0]}") >= CLEAN
    least = F.lit(0.0)
    present = residuals(held.withColumn("rate", F.lit(1.0)), targets)
    wanted = targets.get(DOMAINS[0], 0.0) / sum(targets.values())
    if present and wanted > 0:
        share = wanted + present[DOMAINS[0]]
        floor = KEPT * min(1.0, wanted / share)
        least = F.when(clean, floor).otherwise(0.0)
    history = fit_rates(held, targets, STEPS, least, SETTLED)
    rate, factor = rate_after(history, posteriors, least), 1.0
    if present and wanted > 0:
        lowest = held.where(clean).agg(F.min(rate)).first()[0]
        factor = max(1.0, 1 / (lowest or 1.0))
        rate = F.greatest(rate * factor, F.when(clean, 1.0).otherwise(0.0))
    left = residuals(held.withColumn("rate", rate), targets)
    _log.info("mixing: shares less targets %s, rates times %.4f", left, factor)
    doc_id, body = F.col(names["doc_id"]), F.col(names["text"])
    hashed = F.xxhash64(doc_id, F.when(doc_id.isNull(), body), F.lit("copies"))
    chance = F.pmod(hashed, F.lit(1 << 20)) / (1 << 20)
    whole = F.floor("rate")
    more = F.when(chance < F.col("rate") - whole, 1).otherwise(0)
    rated = members.withColumn("rate", rate).withColumn(
        "copies", (whole + more).cast("long")
    )
    return select_back(rated, names, *made)
