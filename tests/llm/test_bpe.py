import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from headway.llm import bpe

from .conftest import prose

TEXTS = [
    None,
    "",
    "a   b  c\x1c\x85 d'll I'LL ᠎ ​﻿",
    "x" * 1500,
    "日本語テキスト🙂👩‍👩‍👧  \n\n  \t end   ",
    "Q9z" * 300 + "ÿþ\x00\x01",
    "It's the  end\n",
    prose(1, 400),
]


@pytest.fixture(scope="module")
def coder():
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(),
        special_tokens={},
    )


def test_ids_equal_tiktoken(spark, documents, coder):
    docs = documents(TEXTS + TEXTS[-1:])
    docs = docs.withColumn("c0", F.array(F.lit(1))).withColumn("_words", F.lit("x"))
    got = bpe.encode(spark, docs).collect()
    assert len(got) == len(TEXTS) + 1
    for row in got:
        assert row.token_ids == coder.encode_ordinary(row.text or "")
        assert row.c0 == [1] and row["_words"] == "x"


def test_fold_equals_tiktoken_on_random_words(spark, coder):
    rng = random.Random(2)
    letters = "aabcdeeert hé1\n'日"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    frame = spark.createDataFrame([(words,)], "words array<string>")
    ranks = bpe.read_ranks()
    got = (
        frame.withColumn("_ranks", bpe.rank_map(spark, ranks))
        .select(
            F.transform(
                "words", lambda w: bpe.encode_word(w.cast("binary"), F.col("_ranks"))
            ).alias("ids")
        )
        .first()
        .ids
    )
    assert got == [coder._encode_single_piece(w.encode()) for w in words]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnopqrstuvwxyz", "é日x"])
def test_long_words_equal_tiktoken(spark, documents, coder, alphabet):
    rng = random.Random(len(alphabet))
    words = [
        "".join(rng.choice(alphabet) for _ in range(n))
        for n in (1, bpe.LONG_WORD - 1, bpe.LONG_WORD, bpe.LONG_WORD + 1, 3, 5000, 700)
    ]
    texts = [*words, " ".join(words), "a" * 3000, "", words[-1] + "\n" + words[-2]]
    got = {r.doc_id: r.token_ids for r in bpe.encode(spark, documents(texts)).collect()}
    for i, text in enumerate(texts):
        assert got[i] == coder.encode_ordinary(text)


def test_a_word_of_a_million_letters_takes_no_square_of_its_length(coder):
    rng = random.Random(4)
    pairs = bpe.Pairs(bpe.read_ranks())

    def seconds(n):
        word = "".join(rng.choice("etaoinshrdlu") for _ in range(n)).encode()
        start = time.perf_counter()
        ids = bpe.fold_long(np.frombuffer(word, np.uint8), pairs)
        taken = time.perf_counter() - start
        if n <= 100_000:
            assert ids.tolist() == coder._encode_single_piece(word)
        return taken

    assert seconds(1_000_000) < 40 * max(seconds(100_000), 0.2)


def test_decoding_is_a_round_trip(spark, documents):
    coded = bpe.encode(spark, documents(TEXTS))
    for row in bpe.decode(coded).collect():
        assert bytes(row.decoded) == (row.text or "").encode()
    docs = documents(TEXTS).withColumn("back", F.lit(1)).withColumn("c0", F.lit(2))
    for native in (False, True):
        texts = docs.where("doc_id < 3") if native else docs
        both = bpe.encode(spark, texts, native=native, decoded="back")
        assert both.columns[-2:] == ["token_ids", "back"] and "c0" in both.columns
        want = {r.doc_id: (r.token_ids, bytes(r.decoded)) for r in bpe.decode(coded).collect()}
        for row in both.collect():
            assert (row.token_ids, bytes(row.back)) == want[row.doc_id]


def test_null_ids_decode_to_null(spark):
    tokens = spark.createDataFrame([(None,), ([],), ([10, 11],)], "token_ids array<int>")
    ranks = {bytes([i]): i for i in range(256)}
    assert [r.decoded for r in bpe.decode(tokens, ranks).collect()] == [
        None,
        b"",
        b"\n\x0b",
    ]


def test_empty_table(spark, documents):
    assert bpe.digests(spark, documents([])).count() == 0
