import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from headway.llm import bloom, cascade, token_counts, url_filter, warc
from headway.llm.bpe import read_ranks
from headway.llm.queries import URL_RULES

from .conftest import prose


# Token counts


@pytest.fixture(scope="module")
def coder():
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=read_ranks(),
        special_tokens={},
    )


def test_edits_keep_counts_exact(coder):
    rng = random.Random(4)
    counter = token_counts.Counter(read_ranks())
    parts = ["a", "b", " ", "  ", "\n", "'s", "22", "é", "...", "I'll", "日本", " the"]
    for round_ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 400)))
        tree = token_counts.Tree.build(text, counter)
        for _ in range(4):
            start = rng.randint(0, len(text) + 2)
            end = start + rng.choice([0, 1, 5, 40, 400])
            insert = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 9, 300])))
            cut = min(start, len(text))
            want = text[:cut] + insert + text[min(max(end, cut), len(text)) :]
            text, tree, _ = token_counts.apply_edit(text, tree, start, end, insert, counter)
            assert text == want
            assert tree.n_tokens == len(coder.encode_ordinary(text))
            assert tree.chars[1] == len(text)


@pytest.mark.parametrize("run", ["  ", "   ", "\n\n", " \n", "\t ", "'r", "'l"])
def test_edits_behind_white_space_at_every_leaf_border(coder, run):
    """Right behind white space (or a short form's start), wherever it is."""
    counter = token_counts.Counter(read_ranks())
    for words in range(2, 36):
        front = " ".join(["a"] * words) + run
        text = front + "b " + " ".join(["c"] * 20)
        for back in range(len(run) + 1):
            start = len(front) - back
            for end in {start, len(front), len(front) + 1, len(front) + 2}:
                for insert in ("", " ", "\n", "e", "l", "e "):
                    if end < start:
                        continue
                    tree = token_counts.Tree.build(text, counter)
                    got, tree, _ = token_counts.apply_edit(
                        text, tree, start, end, insert, counter
                    )
                    assert got == text[:start] + insert + text[end:]
                    full = token_counts.Tree.build(got, counter).n_tokens
                    assert tree.n_tokens == full == len(coder.encode_ordinary(got))


def test_edits_encode_only_their_surroundings(spark, documents, coder):
    docs = documents([prose(1, 3000), None, "", "short"])
    state = token_counts.build_state(docs)
    edits = spark.createDataFrame(
        [
            (0, [(500, 510, "new words"), (9_000, 9_000, "x")]),
            (1, [(0, 5, "text"), None]),
            (3, None),
        ],
        "doc_id long, edits array<struct<start:long,end:long,insert:string>>",
    )
    changed = token_counts.with_edits(state, edits)
    got = {r.doc_id: r for r in token_counts.apply_edits(changed).collect()}
    for row in got.values():
        assert row.n_after == len(coder.encode_ordinary(row.text))
    assert 0 < got[0].n_encoded < 200
    assert got[1].text == "text" and got[1].n_before == 0
    assert got[3].n_encoded == 0
    assert token_counts.build_state(documents([])).count() == 0


# Quality rules


def brute_measures(text):
    text = text or ""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\f\r"):
            dups += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        dups,
        len(covered),
    )


def test_measures_equal_brute_force(spark, documents):
    line = prose(1, 12)
    texts = [
        line,
        "\n".join([line] * 3 + ["", "  ", ""]),
        "a b c d e f a b c d e g " * 2,
        "x " * 50,
        "é|* b \x0b\x1c c",
        "one two three four",
        "",
        None,
        prose(2, 2000) + " " + prose(2, 7),
    ]
    docs = documents(texts).withColumn("kept", F.lit(5)).withColumn("n_words", F.lit(5))
    got = {r.doc_id: r for r in cascade.judge(spark, docs).collect()}
    for i, text in enumerate(texts):
        r, want = got[i], brute_measures(text)
        assert (
            r.n_words,
            r.word_chars,
            r.n_symbols,
            r.n_dup_lines,
            r.n_repeat_words,
        ) == want
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r.base_failed == failed
        assert not (failed and r.kept)
    assert got[0].kept and got[8].kept
    assert cascade.judge(spark, documents([])).count() == 0


def test_order_follows_rejection_per_cost_and_changes_nothing(spark, documents):
    docs = documents([prose(i, 20) for i in range(30)])
    rules = [
        cascade.Rule("never", F.lit(False)),
        cascade.Rule("often", F.col("doc_id") < 20),
        cascade.Rule("null", F.lit(None).cast("boolean")),
    ]
    order = cascade.ordered(spark, docs, rules)
    assert order[0].name == "often"
    for rules in (order, rules, rules[::-1]):
        kept = docs.where(cascade.passes(rules)).count()
        assert kept == 10


def test_cost_orders_rules_that_reject_alike(spark, documents):
    docs = documents([prose(i, 300) for i in range(40)])
    dear = F.size(F.array_distinct(F.split("text", "[0-9 ]+"))) < 0
    rules = [
        cascade.Rule("dear", dear | (F.col("doc_id") < 10)),
        cascade.Rule("cheap", F.col("doc_id") < 10),
    ]
    order = [r.name for r in cascade.ordered(spark, docs.repartition(1), rules)]
    assert order == ["cheap", "dear"]


def test_the_sample_does_not_depend_on_where_rows_are(spark, documents):
    docs = documents([prose(i, 20) for i in range(90)] + ["", None])
    docs = docs.withColumn("c0", F.lit(1)).withColumn("_again", F.lit("x"))
    ids = [
        {r.doc_id for r in cascade.hashed_sample(d, rows=30).collect()}
        for d in (docs, docs.repartition(7, "text"), docs.orderBy(F.desc("doc_id")))
    ]
    assert ids[0] == ids[1] == ids[2] and len(ids[0]) == 30
    assert max(ids[0]) > 60 > 30 > min(ids[0])
    assert cascade.judge(spark, docs).count() == 92


# URL filter


def brute_verdict(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
        path = rest[:cut]
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in URL_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    key = host.removeprefix("www.") + path.rstrip("/")
    return host, path, None, "block" if key in listed else "allow"


def test_verdicts_equal_brute_force(spark):
    urls = [
        "https://A.Example.ORG/es/x?q=1",
        "http://example.org/en/12#a",
        "http://notexample.org/en/1",
        "http://x.org",
        "http://org/",
        "https://shop.com/fr/",
        "https://shop.com/de/a",
        "http://www.a.net/p/",
        "http://a.net/p",
        "http://b.net/p",
        "http://b.net?x=http://a.net/p",
        "ftp://[::1]/a\nb",
        "no scheme",
        "://",
        "",
        None,
        "http://a.net/p",
    ]
    pages = spark.createDataFrame(
        [(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, verdict string"
    )
    keys = ["a.net/p", "a.net/p", "shop.com/fr", None, ""]
    listed = spark.createDataFrame([(k,) for k in keys], "canonical string")
    rows = url_filter.judge_urls(spark, pages, listed, URL_RULES).collect()
    assert len(rows) == len(urls)
    for r in rows:
        want = brute_verdict(r.url, {"a.net/p", "shop.com/fr"})
        assert (r.host, r.path, r.rule, r.verdict) == want


def test_bloom_filter_has_no_false_negatives_and_few_positives(spark):
    listed = spark.range(2000).select(F.concat(F.lit("a.net/"), "id").alias("key"))
    blocks = bloom.block_count(2000)
    made = bloom.blocked_bloom(listed, "key", blocks)
    probes = spark.range(20_000).select("id", F.concat(F.lit("a.net/"), "id").alias("key"))
    passed = bloom.probed(probes, F.col("key"), made, blocks).where("_possible")
    assert passed.where("id < 2000").count() == 2000
    assert passed.where("id >= 2000").count() < 400
    assert bloom.block_count(10**12) == bloom.MAX_BLOCKS


def test_empty_urls(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    listed = spark.createDataFrame([], "canonical string")
    assert url_filter.judge_urls(spark, pages, listed, URL_RULES).count() == 0


# WARC


def test_archives_give_back_all_pages(spark):
    copy = "z" * 200
    rows = [
        (900, None, None),
        (901, "http://x\r\ny z", ""),
        (5, "u", copy),
        (902, "u", copy),
        (902, "u", copy),
        (None, "u", copy),
        (904, "u", "é" * 50),
        (905, "u", "é" * 50),
        (906, "u", "é" * 49 + "a"),
        (907, "u", "é" * 49 + "a"),
        (908, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
        (909, "u", prose(1, 20_000)),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
        for r in warc.archive_round_trip(spark, pages).collect()
    )
    ids = defaultdict(list)
    for page_id, _, html in rows:
        if page_id is not None:
            ids[html or ""].append(page_id)
    want = Counter()
    for page_id, _, html in rows:
        body = (html or "").encode()
        first = min(ids[html or ""])
        again = len(body) >= 100 and page_id != first
        want[
            (
                page_id,
                len(body),
                hashlib.sha256(body).hexdigest(),
                "revisit" if again else "response",
                first if again else None,
            )
        ] += 1
    assert got == want
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_round_trip(spark, none).count() == 0


def test_each_record_is_a_member_at_its_offset(spark, tmp_path):
    pages = spark.createDataFrame(
        [(i, f"http://a/{i}", f"page {i} " * 50) for i in range(20)],
        "page_id long, url string, html string",
    )
    records = warc.with_revisits(pages, F.col("page_id"), F.col("url"), F.col("html"))
    whole, single = tmp_path / "whole", tmp_path / "single"
    whole.mkdir()
    single.mkdir()
    manifest = warc.write_monolithic(records.coalesce(2), str(whole)).persist()
    assert sum(r.records for r in manifest.collect()) == 20
    index = warc.normalise(manifest, str(whole), str(single)).persist().collect()
    seen = set()
    for row in index:
        data = (single / row.archive).read_bytes()[row.offset : row.offset + row.length]
        unpacker = zlib.decompressobj(31)
        record = unpacker.decompress(data)
        assert unpacker.eof and not unpacker.unused_data
        assert len(record) == row.raw_bytes
        seen.add(warc.parse_record(record)["uri"])
    assert seen == {f"http://a/{i}" for i in range(20)}


def test_inflating_takes_streams_of_many_members_and_refuses_torn_ones():
    record = warc.record_bytes(1, "u", "response", None, "d", b"payload")
    packed = b"".join(
        (p := zlib.compressobj(wbits=31)).compress(record) + p.flush() for _ in range(3)
    )

    def reader(data):
        parts = iter([data[i : i + 7] for i in range(0, len(data), 7)])
        return lambda _: next(parts, b"")

    assert [raw for _, raw in warc.Inflated(reader(packed))] == [record] * 3
    with pytest.raises(ValueError):
        list(warc.Inflated(reader(packed[:-40])))
