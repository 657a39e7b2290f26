"""Quality classifier: document evidence with host and path posteriors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import classifier
from headway.llm.common import keep, neutral, select_as, select_back

# A document is kept if its combined probability of being good reaches this.
THRESHOLD = 0.5
# Bounds of how many documents a prior counts for.
LEAST_PRIOR, MOST_PRIOR = 1.0, 10_000.0
_EDGE = 1e-6


def _logit(p: Column) -> Column:
    held = F.greatest(F.least(p, F.lit(1 - _EDGE)), F.lit(_EDGE))
    return F.log(held / (1 - held))


def _prior(mean: float, between: float | None, noise: float | None) -> float:
    """Documents that a prior counts for, by the method of moments.

    The variance between group means is that of the true means and the noise
    within groups; a Beta prior of this variance has the strength returned.
    """
    real = max((between or 0.0) - (noise or 0.0), 1e-9)
    strength = mean * (1 - mean) / real - 1
    return min(max(strength, LEAST_PRIOR), MOST_PRIOR)


def _moments(groups: DataFrame, around: Column, n: str, total: str) -> tuple:
    """(variance between means, noise of the means), weighted by size."""
    mean = F.col(total) / F.col(n)
    row = groups.agg(
        F.sum(F.col(n) * (mean - around) ** 2) / F.sum(n),
        F.sum(around * (1 - around)) / F.sum(n),
    ).first()
    return row[0], row[1]


def _site_sums(spark: SparkSession, scored: DataFrame) -> tuple[DataFrame, tuple]:
    """((host, path, n, total, host_n, host_total), (global mean, strength of
    the prior of hosts, strength of that of paths)) of ``scored``.

    The table is written, so it is broadcast where it is small and else
    joined by its keys. Without rows the mean is one half.
    """
    paths = keep(
        spark,
        scored.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("n"), F.sum("p").alias("total")
        ),
        "paths",
    )
    hosts = paths.groupBy("host").agg(
        F.sum("n").alias("host_n"), F.sum("total").alias("host_total")
    )
    known = keep(spark, paths.join(hosts, "host"), "sites")
    sums = paths.agg(F.sum("n"), F.sum("total")).first()
    if not sums[0]:
        return known, (0.5, LEAST_PRIOR, LEAST_PRIOR)
    mean = min(max(sums[1] / sums[0], _EDGE), 1 - _EDGE)
    outer = _prior(mean, *_moments(hosts, F.lit(mean), "host_n", "host_total"))
    host_p = _shrunk(F.lit(mean), outer, F.col("host_n"), F.col("host_total"))
    placed = known.withColumn("host_p", host_p)
    inner = _prior(mean, *_moments(placed, F.col("host_p"), "n", "total"))
    return known, (mean, outer, inner)


def _shrunk(prior: Column, strength: float, n: Column, total: Column) -> Column:
    """The mean of ``n`` values of sum ``total``, shrunk towards ``prior``."""
    return (strength * prior + total) / (strength + n)


def _site_p(priors: tuple, n: int = 0, p: Column | None = None) -> Column:
    """A site's posterior, without ``n`` of its documents with evidence ``p``."""
    mean, outer, inner = priors
    out = F.lit(0.0) if p is None else p
    host_p = _shrunk(
        F.lit(mean), outer, F.col("host_n") - n, F.col("host_total") - out
    )
    return _shrunk(host_p, inner, F.col("n") - n, F.col("total") - out)


def site_posteriors(spark: SparkSession, scored: DataFrame) -> tuple[DataFrame, float]:
    """((host, path, site_p), global mean) of ``scored(host, path, p)``.

    Grouped sums give each path and each host its mean evidence. A host is
    shrunk towards the global mean and a path towards its host's posterior,
    each as far as its prior's strength demands, so that sparse sites follow
    the prior and large ones their own documents.
    """
    known, priors = _site_sums(spark, scored)
    return known.select("host", "path", _site_p(priors).alias("site_p")), priors[0]


def good_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, target): 1 for rows of good quality that are not toxic."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return labels.where("quality IS NOT NULL").select(
        "doc_id", good.cast("int").alias("target")
    )


def score(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    path: str = "lang",
    rows: int = classifier.SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` with ``evidence``, ``site_p``, ``p_good`` and ``kept``.

    ``evidence`` is the classifier's probability for the text alone, and
    ``site_p`` the posterior of the document's host and path, made from the
    evidence of all other documents; only the global mean and the strengths of
    the priors are of all. So no text counts twice, and the only document of
    its host has the global mean. ``p_good`` adds to the evidence what the site
    says beyond the global mean, in log odds. The classifier is fitted on at
    most ``rows`` labelled rows; without labels of both kinds it knows only
    their share, and without any everything is kept. A ``p_good`` of exactly
    ``THRESHOLD`` is kept.

    Null hosts and paths count as empty ones, which are sites like others, and
    null texts as empty. All rows stay; existing columns of the new names are
    replaced. An empty table gives an empty result.
    """
    made = ["evidence", "site_p", "p_good", "kept"]
    model = classifier.fit(
        classifier.labelled_sample(docs, good_labels(labels), rows), 2, rows
    )
    names = neutral([c for c in docs.columns if c not in made])
    found = classifier.predict(select_as(docs, names), names["text"], model)

    def site(column: str) -> Column:
        return F.coalesce(F.col(names[column]).cast("string"), F.lit(""))

    found = found.select(
        *names.values(),
        F.col("posteriors")[1].alias("evidence"),
        site(host).alias("host"),
        site(path).alias("path"),
    )
    sites, priors = _site_sums(
        spark, found.select("host", "path", F.col("evidence").alias("p"))
    )
    log_odds = (
        _logit(F.col("evidence")) + _logit(F.col("site_p")) - _logit(F.lit(priors[0]))
    )
    judged = (
        found.join(sites, ["host", "path"])
        .withColumn("site_p", _site_p(priors, 1, F.col("evidence")))
        .withColumn("p_good", 1 / (1 + F.exp(-log_odds)))
        .withColumn("kept", F.col("p_good") >= THRESHOLD)
    )
    return select_back(judged, names, *made)
