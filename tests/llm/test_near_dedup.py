import importlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway.llm import near_dedup
from headway.llm.components import components

from .conftest import prose


def brute_sets(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_groups(rows, size):
    """(doc_id, n, smallest id) of each row, links over single rows."""
    sets = [brute_sets(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            union = len(sets[i] | sets[j])
            if union and 100 * both >= 80 * union:
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i)]
        out.append((doc_id, len(sets[i]), min(ids)))
    return sorted(out)


def edited(text, seed, n):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randint(0, 9999)}"
    return " ".join(words)


@pytest.mark.parametrize("size", [2, 5])
def test_groups_equal_brute_force(spark, documents, size):
    base, other = prose(1, 150), prose(2, 60)
    texts = [prose(100 + i, 40) for i in range(15)]
    texts += [base] * 4 + [base.upper()] + [edited(base, i, i % 9) for i in range(25)]
    texts += [edited(other, i, i % 6) for i in range(12)]
    texts += ["", None, "   \n\t", "one", "ONE", "one two", "ÉÉ éé", "éé éé", "a " * 3000]
    rows = list(enumerate(texts))
    random.Random(5).shuffle(rows)
    docs = documents(rows).withColumn("label", F.lit("x")).withColumn("rep", F.lit(1))
    got = near_dedup.near_groups(spark, docs, size).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == (
        brute_groups(rows, size)
    )
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_links_that_no_star_finds_are_kept(spark, documents):
    """A chain: each text is near the next one only."""
    text, rows = prose(7, 100), []
    for i in range(12):
        rows.append((i, text))
        words = text.split()
        words[i * 8 : i * 8 + 6] = [f"c{i}x{j}" for j in range(6)]
        text = " ".join(words)
    random.Random(3).shuffle(rows)
    got = near_dedup.near_groups(spark, documents(rows), 2).collect()
    want = brute_groups(rows, 2)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert len({c for _, _, c in want}) < 12


def test_one_group_of_many_copies(spark, documents):
    base = prose(9, 80)
    rows = [(i, edited(base, i, 1)) for i in range(300)] + [
        (300 + i, base) for i in range(300)
    ]
    got = near_dedup.near_groups(spark, documents(rows), 2).collect()
    assert {r.component_id for r in got} == {0}
    assert [r.doc_id for r in got if r.kept] == [0]


def test_dedup_keeps_one_of_each_group(spark, documents):
    base = prose(4, 60)
    rows = [(5, base), (2, base), (9, prose(6, 60)), (9, prose(6, 60)), (None, base), (7, "")]
    kept = near_dedup.near_dedup(spark, documents(rows))
    assert kept.columns == documents([]).columns
    assert sorted(kept.select("doc_id").toPandas()["doc_id"].fillna(-1)) == [-1, 2, 7, 9]


def brute_dedup(rows):
    """Rows by position: one a group and id, by its least text."""
    sets = [brute_sets(t, 5) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    withid = [i for i, (doc_id, _) in enumerate(rows) if doc_id is not None]
    for i in withid:
        for j in withid:
            both, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            equal = not union and (rows[i][1] or "") == (rows[j][1] or "") and rows[i][0] == rows[j][0]
            if equal or (union and 100 * both >= 80 * union):
                parent[root(i)] = root(j)
    groups = {}
    for i in withid:
        groups.setdefault(root(i), []).append(rows[i])
    out = [rows[i] for i in range(len(rows)) if rows[i][0] is None]
    for members in groups.values():
        least = min(doc_id for doc_id, _ in members)
        out.append(min(
            (r for r in members if r[0] == least), key=lambda r: (r[1] is not None, r[1] or "")
        ))
    return sorted(map(repr, out))


def test_texts_decide_and_not_ids(spark, documents):
    a, b = prose(41, 70), prose(42, 70)
    rows = [(1, a), (5, a), (5, b), (5, b), (5, b + " more")]
    rows += [(8, ""), (8, None), (8, ""), (9, "x"), (9, "X"), (9, "y"), (None, a), (None, a)]
    rows += [(i % 7, edited(prose(50 + i % 4, 60), i, i % 3)) for i in range(40)]
    random.Random(6).shuffle(rows)
    docs = documents(rows).drop("lang", "source", "n_chars")
    docs = docs.select("*", F.lit(1).alias("group"), F.lit(2).alias("kept"), F.lit(3).alias("again"))
    kept = near_dedup.near_dedup(spark, docs)
    assert kept.columns == docs.columns
    got = sorted(repr((r.doc_id, r.text)) for r in kept.collect())
    assert got == brute_dedup(rows)
    assert repr((5, b)) in got and repr((1, a)) in got


def test_pairs_of_very_unlike_sizes_and_at_the_threshold(spark):
    """Every pair at the threshold is among the prefix pairs."""
    rng = random.Random(12)
    sets = []
    for n in (1, 2, 4, 5, 9, 10, 40, 45, 50, 100, 125):
        for _ in range(4):
            base = [rng.randrange(10**6) for _ in range(n)]
            sets.append(base)
            sets.append(base[: n - n // 10] + [rng.randrange(10**6) for _ in range(n // 10)])
            sets.append(base[: -(-n * 8 // 10)])
    rows = [(i, i, sorted(set(s))) for i, s in enumerate(sets)]
    table = spark.createDataFrame(rows, "rep long, label long, shingles array<long>")
    got = {tuple(r) for r in near_dedup.prefix_pairs(table, 80).collect()}
    for i, _, x in rows:
        for j, _, y in rows[:i]:
            both = len(set(x) & set(y))
            if 100 * both >= 80 * (len(x) + len(y) - both):
                assert (j, i) in got


def test_texts_of_a_million_characters(spark, documents):
    texts = ["x" * 10**6, prose(3, 150_000), prose(3, 150_000) + " end", "y " * 500_000]
    got = near_dedup.near_groups(spark, documents(texts), 2).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(0, 0), (1, 1), (2, 1), (3, 3)]


def test_empty_table(spark, documents):
    assert near_dedup.near_groups(spark, documents([]), 2).count() == 0
    assert near_dedup.near_dedup(spark, documents([])).count() == 0


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(1)
    for share in (1.0, 0.9, 0.8, 0.3):
        both = rng.integers(0, 2**63, int(1000 * share)).astype(np.uint64)
        rest = int((1000 - len(both)) / 2)
        sets = [
            np.concatenate([both, rng.integers(0, 2**63, rest).astype(np.uint64)])
            for _ in range(2)
        ]
        left, right = (
            near_dedup.odd_sketch(near_dedup.min_hashes(s)).view(np.uint64) for s in sets
        )
        odd = sum(int(x).bit_count() for x in left ^ right)
        size = near_dedup.SKETCH_BITS
        apart = -size / 4 * np.log(1 - 2 * min(odd, size // 2 - 1) / size)
        if share >= 0.8:
            assert odd < near_dedup.MAX_ODD_BITS
            assert abs(1 - apart / near_dedup.SAMPLES - share) < 0.12
        else:
            assert odd >= near_dedup.MAX_ODD_BITS


def test_shingles_count_distinct_windows():
    texts = ["a b a b", "A\x0bB", "", None, "x"]
    sets = list(near_dedup.shingle_sets(pa.array(texts, pa.string()), 2))
    assert [len(s) for s in sets] == [len(brute_sets(t, 2)) for t in texts]
    assert sets[1][0] in sets[0]


def test_components_of_a_path_a_star_and_a_ring(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    ring = [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)]
    links = spark.createDataFrame(path + star + ring + path[:3], "a long, b long")
    got = dict(components(spark, links).collect())
    assert {got[i] for i in range(41)} == {0}
    assert {v for k, v in got.items() if 1000 <= k < 2000} == {1000}
    assert {v for k, v in got.items() if k >= 2000} == {2000}
    assert len(got) == 41 + 50 + 9
    none = spark.createDataFrame([], "a long, b long")
    assert components(spark, none).count() == 0


def written(monkeypatch, module):
    """The labels of the tables that a module's steps keep from here on."""
    labels, own = [], module.keep
    monkeypatch.setattr(
        module, "keep", lambda s, df, label: labels.append(label) or own(s, df, label)
    )
    return labels


def test_components_of_stars_take_three_tables(spark, monkeypatch):
    """The driver holds what each table's jobs need, however few the rows."""
    links = [(10 * i, 10 * i + j) for i in range(5) for j in range(1, 6)] + [(77, 77)]
    links = spark.createDataFrame(links, "a long, b long")
    labels = written(monkeypatch, importlib.import_module("headway.llm.components"))
    got = dict(components(spark, links).collect())
    assert got == {77: 77} | {10 * i + j: 10 * i for i in range(5) for j in range(6)}
    assert labels == ["hooks", "hooks", "links"]


def test_prefixes_are_listed_once(spark, monkeypatch):
    rows = [(1, 1, [1, 2, 3, 4, 5]), (2, 2, [1, 2, 3, 4, 5]), (3, 3, [6])]
    sets = spark.createDataFrame(rows, "rep long, label long, shingles array<long>")
    labels = written(monkeypatch, near_dedup)
    pairs = near_dedup.prefix_pairs(sets, 80)
    assert {tuple(r) for r in pairs.collect()} == {(1, 2)}
    assert labels == ["prefixes"]
    assert "shingles" not in pairs._jdf.queryExecution().toString()


def test_groups_of_stars_that_prefixes_link(spark, documents):
    """Labels of stars joined later equal those of all links at once."""
    rng = random.Random(5)
    texts = []
    for seed in range(12):
        words = prose(seed, 60).split()
        for _ in range(9):
            texts.append(" ".join(words))
            words[rng.randrange(60)] = f"new{rng.random()}"
    rng.shuffle(texts)
    got = near_dedup.near_groups(spark, documents(texts), 2).collect()
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got)
    assert found == sorted(brute_groups(list(enumerate(texts)), 2))
