import random
import re

import numpy as np
import pytest

from headway.llm import license_scan as ls
from headway.llm.license_scan import Template

SPELLED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return SPELLED.findall(lower)


def brute(text, templates, phrases, percent):
    ws = words(text)
    places = [
        (i, label)
        for phrase, label in phrases
        for i in range(len(ws))
        if ws[i : i + len(phrase.split())] == phrase.split()
    ]
    found = []
    for k, t in enumerate(templates):
        own, width = set(words(t.text)), 1
        while width < len(words(t.text)):
            width *= 2
        for start in range(0, len(ws), width):
            shared = len(own & set(ws[start : start + 2 * width]))
            if 100 * shared >= percent * len(own):
                found.append((start, width, k, t.label, shared, len(own)))
    starts = [i for i, _ in places]
    return (
        len(ws),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        sorted({label for _, label in places}),
        sorted(found),
    )


def check(spark, docs, rows, templates, phrases, percent):
    got = ls.scan_licenses(spark, docs, templates, phrases, percent).collect()
    shown = sorted(
        repr((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels,
              [tuple(x) for x in r.found]))
        for r in got
    )
    assert shown == sorted(
        repr((i, *brute(t, templates, phrases, percent))) for i, t in rows
    )
    return got


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_every_block_equals_brute_force(spark, documents, percent):
    rng = random.Random(percent)
    vocabulary = [f"w{i}" for i in range(14)] + ["the", "of", "a", "été"]
    templates = [
        Template(f"t{k}", " ".join(rng.choice(vocabulary) for _ in range(n)))
        for k, n in enumerate([1, 3, 4, 5, 7, 9, 9, 15, 17, 30])
    ]
    phrases = (("the w1", "p"), ("w1 w1", "q"), ("of", "p"))
    texts = []
    for _ in range(120):
        pool = rng.sample(vocabulary, rng.randint(1, len(vocabulary)))
        body = [rng.choice(pool).capitalize() for _ in range(rng.randint(0, 90))]
        texts.append(rng.choice([" ", "-", ".\n"]).join(body))
    texts += ["", None, " .,", "w1", "W1 w1 W1", templates[-1].text, "w1" * 40]
    rows = list(enumerate(texts)) + [(3, texts[3]), (3, texts[4]), (None, texts[5])]
    docs = documents(rows).withColumnRenamed("source", "row").withColumnRenamed("lang", "found")
    got = check(spark, docs, rows, templates, phrases, percent)
    assert sum(len(r.found) for r in got) > 50


def test_notices_are_found_and_prose_is_not(spark, documents):
    mit = ls.TEMPLATES[[t.label for t in ls.TEMPLATES].index("mit")].text
    long = max((t for t in ls.TEMPLATES if t.label == "mit"), key=lambda t: len(t.text)).text
    lead = "Some words stand before it in this text and go on. " * 7
    texts = [
        lead + "Licensed under CC BY-NC 4.0.",
        lead + "This work is licensed under the GNU General Public License, version 3.",
        lead + "Licensed under the Apache License, Version 2.0. " + lead,
        f"{lead}{mit}.",
        lead + long.replace(" ", "\n * ") + lead,
        lead + long.replace("distribute, ", "").upper(),
        lead * 30,
        "The license of the house is under the table.",
    ]
    rows = sorted(ls.license_labels(spark, documents(texts)).collect())
    assert [r.labels for r in rows] == [
        "cc-by-nc", "gpl", "apache", "mit", "mit", "mit", "", ""
    ]
    assert [r.base_labels for r in rows] == ["", "gpl", "apache", "mit", "", "", "", ""]
    assert rows[0].score == 1.0 and 0.9 <= rows[5].score < 1 and rows[6].score == 0
    assert rows[1].first_word == 77 + 7 and rows[1].n_base == 1


def test_words_of_more_bytes_than_a_key():
    vocabulary = ls.Vocabulary(["abcdefghijklmnop abcdefgh abcdefghz a ab b"])
    text = b"A abcdefghijklmnop abcdefghijklmnopq ab ABCDEFGH abcdefghz abcdefghy b aa"
    data = np.frombuffer(text, np.uint8)
    begin, end, _ = ls._word_places(data, np.array([0, len(data)]))
    at, word = vocabulary.find(data, begin, end)
    assert at.tolist() == [0, 1, 3, 4, 5, 7]
    assert [vocabulary.words[w] for w in word] == [
        b"a", b"abcdefghijklmnop", b"ab", b"abcdefgh", b"abcdefghz", b"b"
    ]
    with pytest.raises(ValueError):
        ls.Vocabulary(["a" * 17])


def test_empty_table(spark, documents):
    assert ls.license_labels(spark, documents([])).count() == 0


def test_texts_of_a_million_characters(spark, documents):
    notice = "Licensed under CC BY-NC 4.0."
    texts = ["x" * 10**6, "the license " * 90_000 + notice, "mit license " * 90_000]
    rows = sorted(ls.license_labels(spark, documents(texts)).collect())
    assert [(r.n_words, r.n_base, r.labels) for r in rows] == [
        (1, 0, ""), (180_007, 0, "cc-by-nc"), (180_000, 90_000, "mit")
    ]
    assert rows[2].last_word == 179_998
