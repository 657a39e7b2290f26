import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from headway.llm import periodic_runs as pr


def brute_runs(words, least_words=24, least_times=3):
    """Every start and period, by comparing words."""
    n, best = len(words), {}
    for q in range(1, n // least_times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least_words, least_times * q):
                best.setdefault((i, length), q)
            i = j
    return sorted((s, n_, q) for (s, n_), q in best.items())


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    check = zlib.crc32(str(doc_id).encode())
    g = check // 10
    if doc_id is not None and check % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    lines = "".join(f"{s},{n_},{q}\n" for s, n_, q in sorted(runs, key=lambda r: (r[0], r[2])))
    gone = {i for s, n_, q in runs for i in range(s + q, s + n_)}
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    shown = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (
        doc_id,
        len(runs),
        *shown,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(left).hexdigest(),
    )


def ids(words):
    return pr.word_ids([str(w).encode() for w in words])


@pytest.mark.parametrize("least", [(24, 3), (6, 3), (4, 2), (9, 4)])
def test_runs_equal_brute_force(least):
    rng = random.Random(11)
    for trial in range(150):
        words = []
        while len(words) < rng.randint(1, 160):
            part = [rng.randrange(3) for _ in range(rng.randint(1, 12))]
            words += part * rng.randint(1, 5) + part[: rng.randint(0, len(part))]
        assert [tuple(r) for r in pr.runs_of(ids(words), *least)] == sorted(
            brute_runs(words, *least), key=lambda r: (r[0], r[2])
        )


def test_one_word_only_and_periods_that_are_not_least():
    assert pr.runs_of(ids("a" * 500)) == [(0, 500, 1)]
    assert pr.runs_of(ids("ab" * 100)) == [(0, 200, 2)]
    assert pr.runs_of(ids("a" * 23)) == []
    assert pr.runs_of(ids("a" * 24)) == [(0, 24, 1)]
    assert pr.runs_of(ids("abcdefghi" * 3)) == [(0, 27, 9)]
    assert pr.runs_of(ids("abcdefghi" * 3)[:26]) == []


def test_suffixes_and_common_words():
    rng = random.Random(5)
    for _ in range(50):
        words = [rng.randrange(3) for _ in range(rng.randint(1, 60))]
        order, shared = pr.suffix_order(np.array(words))
        want = sorted(range(len(words)), key=lambda i: words[i:])
        assert order.tolist() == want
        for k in range(1, len(words)):
            a, b = words[want[k - 1] :], words[want[k] :]
            common = 0
            while common < min(len(a), len(b)) and a[common] == b[common]:
                common += 1
            assert shared[k] == common


@pytest.mark.parametrize("size", [1, 2, 5, 16, 19])
def test_repeats_are_seen(size):
    rng = random.Random(size)
    for _ in range(60):
        words = [rng.randrange(4) for _ in range(rng.randint(1, 50))]
        seen = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        assert pr.repeats_within(np.array(words), size) == (len(set(seen)) < len(seen))


def test_query_equals_brute_force(spark, documents):
    rng = random.Random(3)
    line = " ".join(f"w{i}" for i in range(9))
    texts = [" ".join(f"x{rng.randrange(50)}" for _ in range(rng.randint(0, 120))) for _ in range(150)]
    texts += [f"start\n{(line + chr(10)) * 4}end", "é è " * 40, "", None, " \t ", "one"]
    rows = list(enumerate(texts)) + [(None, line * 3), (-7, "b " * 90), (3, texts[3])]
    docs = documents(rows)
    docs = docs.withColumnRenamed("source", "runs").withColumnRenamed("lang", "collapsed")
    got = pr.run_digests(docs).collect()
    want = [brute_row(i, t) for i, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sum(r.n_runs > 0 for r in got) >= 5


def test_spans_and_collapsed_text(spark, documents):
    text = "start " + "a b c d e f g h i " * 4 + "end"
    row = pr.find_runs(documents([text])).collect()[0]
    assert [tuple(r) for r in row.runs] == [(1, 36, 9)]
    assert row.collapsed == "start a b c d e f g h i end"
    assert row.n_words == 38


def test_empty_table(spark, documents):
    assert pr.run_digests(documents([])).count() == 0


def test_texts_of_a_million_characters(spark, documents):
    rng = random.Random(8)
    line = " ".join(f"w{i}" for i in range(20))
    noisy = " ".join(f"{line} {rng.randrange(10**6)}" for _ in range(12000))
    texts = ["a " * 500_000, line.join([" "] * 15000), noisy, "x" * 10**6]
    rows = {r.doc_id: r for r in pr.find_runs(documents(texts)).collect()}
    assert [tuple(r) for r in rows[0].runs] == [(0, 500_000, 1)]
    assert [tuple(r) for r in rows[1].runs] == [(0, 14999 * 20, 20)]
    assert rows[1].collapsed == line
    assert rows[2].runs == [] and rows[2].n_words == 12000 * 21
    assert rows[3].runs == []
