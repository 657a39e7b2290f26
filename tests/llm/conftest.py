import random

import pytest

WORDS = "red house tree river stone cloud light night paper table green".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture
def documents(spark):
    """Make ``documents`` from texts; ids count from 0 unless pairs are given."""

    def make(texts, **extra):
        rows = []
        for i, item in enumerate(texts):
            doc_id, text = item if isinstance(item, tuple) else (i, item)
            source = "hot" if i % 3 == 0 else f"src{i % 7}"
            rows.append((doc_id, text, "en", source, len(text or "")))
        return spark.createDataFrame(rows, DOCS)

    return make
