"""The fitted operators, on held-out rows and against brute force."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm import classifier, mixing, quality

from .conftest import prose

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, documents, n=240):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        text, good, toxic = prose(i, 60), i % 4 != 0, i % 10 == 1
        if not good:
            text = " | ".join(text.split()) if i % 8 else "".join(
                w + rng.choice(["###", "***", "$$$"]) + " " for w in text.split()
            )
        if toxic:
            text += " you stupid idiot"
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    return documents(rows), spark.createDataFrame(labels, LABELS)


def test_quality_on_held_out_rows(spark, documents):
    docs, labels = corpus(spark, documents)
    docs = docs.withColumn("kept", F.lit("x")).withColumn("_host", F.lit(1))
    seen = labels.where("doc_id < 160")
    got = quality.score(spark, docs, seen).where("doc_id >= 160").collect()
    right = [r.kept == (r.doc_id % 4 != 0 and r.doc_id % 10 != 1) for r in got]
    assert len(got) == 80 and sum(right) >= 76


def test_sparse_sites_are_shrunk_to_their_priors(spark):
    rows = [("big", "a", 0.1)] * 500 + [("big", "b", 0.1)] * 500
    rows += [("good", "a", 0.9)] * 1000 + [("tiny", "a", 0.1)] + [("big", "c", 0.9)]
    scored = spark.createDataFrame(rows, "host string, path string, p double")
    sites, mean = quality.site_posteriors(spark, scored)
    p = {(r.host, r.path): r.site_p for r in sites.collect()}
    assert abs(mean - sum(r[2] for r in rows) / len(rows)) < 1e-9
    assert abs(p["big", "a"] - 0.1) < 0.02 and abs(p["good", "a"] - 0.9) < 0.02
    # A single document moves its site only a part of the way from its prior.
    assert 0.1 < p["tiny", "a"] < mean
    assert 0.1 < p["big", "c"] < 0.9


def brute_posteriors(rows):
    """p_good of (host, path, evidence) rows, one document at a time."""
    def prior(mean, groups):
        size = sum(n for n, _, _ in groups)
        between = sum(n * (total / n - m) ** 2 for n, total, m in groups) / size
        noise = sum(m * (1 - m) for _, _, m in groups) / size
        real = max(between - noise, 1e-9)
        return min(max(mean * (1 - mean) / real - 1, 1.0), 10_000.0)

    def held(p):
        p = min(max(p, 1e-6), 1 - 1e-6)
        return np.log(p / (1 - p))

    hosts, paths = {}, {}
    for host, path, p in rows:
        hosts.setdefault(host, []).append(p)
        paths.setdefault((host, path), []).append(p)
    mean = sum(r[2] for r in rows) / len(rows)
    outer = prior(mean, [(len(h), sum(h), mean) for h in hosts.values()])

    def shrunk(m, strength, values):
        return (strength * m + sum(values)) / (strength + len(values))

    whole = {h: shrunk(mean, outer, v) for h, v in hosts.items()}
    inner = prior(mean, [(len(v), sum(v), whole[k[0]]) for k, v in paths.items()])
    found = []
    for i, (host, path, p) in enumerate(rows):
        others = [r for j, r in enumerate(rows) if j != i and r[0] == host]
        host_p = shrunk(mean, outer, [r[2] for r in others])
        site_p = shrunk(host_p, inner, [r[2] for r in others if r[1] == path])
        odds = held(p) + held(site_p) - held(mean)
        found.append((site_p, 1 / (1 + np.exp(-odds))))
    return found


def test_posteriors_equal_brute_force_without_the_document_itself(spark, documents):
    docs, labels = corpus(spark, documents)
    docs = docs.withColumn(
        "source", F.when(F.col("doc_id") % 11 == 0, None).when(
            F.col("doc_id") == 5, "alone").otherwise(F.col("source"))
    ).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "fr").otherwise(F.col("lang")))
    got = quality.score(spark, docs, labels.where("doc_id < 160")).collect()
    want = brute_posteriors([(r.source or "", r.lang or "", r.evidence) for r in got])
    mean = sum(r.evidence for r in got) / len(got)
    for r, (site_p, p_good) in zip(got, want):
        assert abs(r.site_p - site_p) < 1e-9 and abs(r.p_good - p_good) < 1e-9
        assert r.kept == (r.p_good >= quality.THRESHOLD)
        # The only document of its host says nothing of the host.
        assert r.doc_id != 5 or abs(r.site_p - mean) < 1e-9


def test_quality_without_labels_rows_or_columns_filled(spark, documents):
    docs = documents(["the red house", None, ""])
    docs = docs.withColumn("source", F.lit(None).cast("string"))
    none = spark.createDataFrame([], LABELS)
    assert all(r.kept for r in quality.score(spark, docs, none).collect())
    assert quality.score(spark, documents([]), none).count() == 0
    one = spark.createDataFrame([(0, 1, None), (0, 1, 0), (None, 0, 0), (1, None, 1)], LABELS)
    assert quality.score(spark, docs, one).count() == 3


def test_the_sample_is_bounded(spark, documents):
    docs, labels = corpus(spark, documents, 50)
    sample = classifier.labelled_sample(docs, quality.good_labels(labels), 20)
    assert sample.count() == 20


def test_rates_meet_the_targets(spark, documents):
    docs, labels = corpus(spark, documents)
    mixed = mixing.mix(spark, docs, labels, {"clean": 0.9, "low": 0.08, "toxic": 0.02})
    rows = mixed.collect()
    assert len(rows) == 240 and min(r.rate for r in rows) >= 0
    total = sum(r.n_tokens for r in rows)
    for domain, share in (("clean", 0.9), ("low", 0.08), ("toxic", 0.02)):
        got = sum(r.n_tokens * r.rate * r[f"p_{domain}"] for r in rows) / total
        assert abs(got - share) < 0.03
    assert abs(sum(r.copies for r in rows) - sum(r.rate for r in rows)) < 30


def test_rates_equal_a_plain_descent(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(40):
        p = [rng.random() for _ in mixing.DOMAINS]
        rows.append((rng.randint(1, 50), *[x / sum(p) for x in p]))
    columns = "n_tokens long, " + ", ".join(f"p_{d} double" for d in mixing.DOMAINS)
    members = spark.createDataFrame(rows, columns)
    history = mixing.fit_rates(members, mixing.TARGETS)
    found = members.withColumn(
        "rate", mixing.rate_after(history, [F.col(f"p_{d}") for d in mixing.DOMAINS])
    ).collect()
    rates, total = [1.0] * len(rows), sum(r[0] for r in rows)
    want = list(mixing.TARGETS.values())
    gram = np.array(
        [
            [sum(r[0] * r[1 + i] * r[1 + j] for r in rows) / total for j in range(3)]
            for i in range(3)
        ]
    )
    scale = np.linalg.inv(gram + mixing.DAMPING * np.eye(3))
    for _ in range(mixing.STEPS):
        gaps = [
            want[k] / sum(want) - sum(r[0] * x * r[1 + k] for r, x in zip(rows, rates)) / total
            for k in range(3)
        ]
        if max(map(abs, gaps)) < mixing.CLOSE:
            break
        steps = scale @ np.array(gaps)
        rates = [
            max(
                0.0,
                x * (1 - mixing.RIDGE)
                + mixing.RIDGE
                + sum(g * p for g, p in zip(steps, r[1:])),
            )
            for r, x in zip(rows, rates)
        ]
    assert max(abs(a.rate - b) for a, b in zip(found, rates)) < 1e-6


def test_copies_keep_the_shares_and_the_clean_documents(spark, documents, tmp_path):
    docs, labels = corpus(spark, documents, 600)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = mixing.mix(spark, docs, labels, corpus_pipeline.TARGETS).collect()
    assert all(
        r.rate >= 1 and r.copies >= 1 for r in rows if r.p_clean >= mixing.CLEAN
    )
    written = corpus_pipeline.mixing_to_targets(spark, docs, str(tmp_path))
    times = Counter(r.doc_id for r in written.collect())
    assert times == {r.doc_id: r.copies for r in rows if r.copies}
    for d in mixing.DOMAINS:
        by_rate, by_copies = (
            sum(r.n_tokens * n(r) * r[f"p_{d}"] for r in rows)
            / sum(r.n_tokens * n(r) for r in rows)
            for n in (lambda r: r.rate, lambda r: times[r.doc_id])
        )
        assert abs(by_rate - by_copies) < 0.015
    # Rates between one and two are not all rounded to one copy.
    assert len({n for n in times.values()}) > 1


def test_rates_of_a_mostly_clean_corpus_meet_the_targets(spark):
    """Clean, low and toxic as 98, 1 and 1 of 100: clean rates fall below one
    in the fit, and the factor lifts them without a change of the shares."""
    rows = [(100, 0.99998, 0.00001, 0.00001)] * 98
    rows += [(100, 0.0, 1.0, 0.0), (100, 0.0, 0.0, 1.0)]
    members = spark.createDataFrame(
        rows, "n_tokens long, p_clean double, p_low double, p_toxic double"
    )
    columns = [F.col(f"p_{d}") for d in mixing.DOMAINS]
    least = F.when(F.col("p_clean") >= mixing.CLEAN, mixing.KEPT).otherwise(0.0)
    for targets in (mixing.TARGETS, {"clean": 0.9, "low": 0.05, "toxic": 0.05}):
        history = mixing.fit_rates(
            members, targets, mixing.STEPS, least, mixing.SETTLED
        )
        rated = members.withColumn("rate", mixing.rate_after(history, columns, least))
        left = mixing.residuals(rated, targets)
        assert max(map(abs, left.values())) < 0.01


def test_mixing_of_empty_tables(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert mixing.mix(spark, documents([]), none).count() == 0
    rows = mixing.mix(spark, documents([None, "a b", "a b"]), none).collect()
    assert len(rows) == 3 and all(r.copies >= 0 for r in rows)
