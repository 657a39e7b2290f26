"""License scans: an exact set-similarity join of text blocks with templates.

A template is the set of words of a license notice. A block is a window of
consecutive words, made for the templates of one width: windows of twice the
width begin at every multiple of the width, so each stretch of so many words
lies whole in one of them. The join finds every block that holds a given share
of a template's words.

It is a prefix join. Words have one global order, the rarest of the corpus
first, by the number of documents that hold them. A block with enough of a
template's words shares one of the template's rarest words with it, among the
rarest of its own; the places of that word in both, and the lengths of both,
bound what else they can share. What is left is compared in full. Words that no
template holds can be shared with none; they come before all others in the
order, which is the same as leaving them out of the blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import LETTER_BYTES, keep, lists, slices, text_buffers

# Share of a template's distinct words that a block must hold. Of a notice of
# six words it takes all, so the word that names the license is among them.
PERCENT = 90

# Phrases whose places are counted, with their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)


class Template(NamedTuple):
    label: str
    text: str


# Wordings of public licenses, as their notices give them.
TEMPLATES = (
    Template("mit", "Released under the MIT License"),
    Template("apache", "Licensed under the Apache License, Version 2.0"),
    Template(
        "gpl",
        "This work is licensed under the GNU General Public License, version 3",
    ),
    Template("cc-by", "Licensed under CC BY 4.0"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    Template(
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0"
        " International License",
    ),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a"
        " copy of this software and associated documentation files, to deal in the"
        " Software without restriction, including without limitation the rights to"
        " use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software, and to permit persons to whom the Software is"
        " furnished to do so",
    ),
    Template(
        "apache",
        "You may not use this file except in compliance with the License. You may"
        " obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
        " Unless required by applicable law or agreed to in writing, software"
        " distributed under the License is distributed on an AS IS BASIS, WITHOUT"
        " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it"
        " under the terms of the GNU General Public License as published by the Free"
        " Software Foundation, either version 3 of the License, or (at your option)"
        " any later version",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without"
        " modification, are permitted provided that the following conditions are met:"
        " Redistributions of source code must retain the above copyright notice, this"
        " list of conditions and the following disclaimer",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any"
        " purpose with or without fee is hereby granted, provided that the above"
        " copyright notice and this permission notice appear in all copies",
    ),
)

_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
# Words of templates and phrases are told apart by their first so many bytes
# and their length; a longer word in them is refused.
WORD_BYTES = 16

SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "phrases array<int>, blocks array<struct<width: int, start: long, words: array<int>>>"
)


def words_of(text: str) -> list[bytes]:
    """Words of a text: letters and digits, with A to Z in lower case."""
    return _WORD.findall(text.encode().lower())


def least_shared(n: int, percent: int) -> int:
    return max(1, -(-n * percent // 100))


class Vocabulary:
    """The words of some templates and phrases, numbered, and how to find them."""

    def __init__(self, wordings: Sequence[str]) -> None:
        found = sorted({w for wording in wordings for w in words_of(wording)})
        if any(len(w) > WORD_BYTES for w in found):
            raise ValueError(f"a word of more than {WORD_BYTES} bytes")
        self.words = found
        self.number = {w: i for i, w in enumerate(found)}
        keys = np.array([self._key(w) for w in found], np.uint64).reshape(-1, 2)
        self._order = np.lexsort((keys[:, 1], keys[:, 0]))
        # Words of one first half stand together; few share it.
        self._first, self._second = keys[self._order].T
        self._most = max(
            np.unique(self._first, return_counts=True)[1], default=0
        )
        # Length and first two bytes, the second of a one-byte word as zero.
        self._heads = np.zeros((WORD_BYTES + 1, 1 << 16), bool)
        for w in found:
            self._heads[len(w), w[0] << 8 | (w[1] if len(w) > 1 else 0)] = True

    @staticmethod
    def _key(word: bytes) -> tuple[int, int]:
        padded = word.ljust(WORD_BYTES, b"\0")
        return int.from_bytes(padded[:8], "big"), int.from_bytes(padded[8:], "big")

    def find(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """(index of the word, its number) of all known words among some."""
        if not len(begin) or not self.words:
            none = np.zeros(0, np.int64)
            return none, none
        size = np.minimum(end - begin, WORD_BYTES + 1)
        held = np.concatenate([data, np.zeros(WORD_BYTES, np.uint8)])
        held += ((held >= 65) & (held <= 90)).astype(np.uint8) * np.uint8(32)
        second = np.where(size > 1, held[begin + 1], 0)
        head = held[begin].astype(np.int64) << 8 | second
        fits = size <= WORD_BYTES
        fits[fits] = self._heads[size[fits], head[fits]]
        at = np.flatnonzero(fits)
        keys = np.zeros((len(at), 2), np.uint64)
        for k in range(WORD_BYTES):
            byte = np.where(k < size[at], held[begin[at] + k], 0).astype(np.uint64)
            half = keys[:, k // 8]
            half <<= np.uint64(8)
            half |= byte
        low = np.searchsorted(self._first, keys[:, 0])
        found = np.full(len(at), -1, np.int64)
        for k in range(self._most):
            k = np.minimum(low + k, len(self._order) - 1)
            same = (self._first[k] == keys[:, 0]) & (self._second[k] == keys[:, 1])
            found[same] = self._order[k[same]]
        return at[found >= 0], found[found >= 0]


def _word_places(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of all words of some rows, and where each row's start."""
    n = len(data)
    inside = LETTER_BYTES[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | border[1:n]
    closes[:-1] &= ~inside[1:] | border[1:n]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return begin, end, np.searchsorted(begin, offsets)


def width_of(template: Template) -> int:
    """The power of two that holds the words of a template."""
    return 1 << max(0, len(words_of(template.text)) - 1).bit_length()


def document_counts(docs: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Number of rows that hold each word of the vocabulary.

    One row of counts leaves each batch, and one row each task's sums; what
    comes to the driver is as long as the vocabulary.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary.words), np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(*text_buffers(batch.column(0))):
                begin, end, first = _word_places(data, offsets)
                at, word = vocabulary.find(data, begin, end)
                row = np.searchsorted(first, at, "right") - 1
                pairs = np.unique(row * len(total) + word)
                total += np.bincount(pairs % len(total), minlength=len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total)), pa.int32()), pa.array(total)],
            ["word", "rows"],
        )

    counted = docs.select(F.col("text").cast("string")).mapInArrow(
        count, "word int, rows long"
    )
    total = np.zeros(len(vocabulary.words), np.int64)
    for word, rows in counted.groupBy("word").agg(F.sum("rows")).collect():
        total[word] = rows
    return total


def scan(
    docs: DataFrame,
    vocabulary: Vocabulary,
    phrases: Sequence[tuple[str, str]],
    wanted: Sequence[tuple[int, Sequence[int], int]],
) -> DataFrame:
    """Words, phrase places and blocks of every row.

    ``wanted`` has (width, word numbers, least shared) for each width; a block
    is given out with the numbers of its words among them, if it has enough.
    """
    spelled = [[vocabulary.number[w] for w in words_of(p)] for p, _ in phrases]
    tables = []
    for width, numbers, least in wanted:
        member = np.zeros(len(vocabulary.words), bool)
        member[list(numbers)] = True
        tables.append((width, member, least))

    def places(begin, end, first, data):
        """(row, start, phrase) of all places, and (row, width, start, words)."""
        at, word = vocabulary.find(data, begin, end)
        row = np.searchsorted(first, at, "right") - 1
        start = at - first[row]
        sequence = np.full(len(begin) + 1, -1, np.int64)
        sequence[at] = word
        found = []
        for k, numbers in enumerate(spelled):
            here = at[word == numbers[0]]
            here = here[here + len(numbers) <= first[np.searchsorted(first, here, "right")]]
            for j, number in enumerate(numbers[1:], 1):
                here = here[sequence[here + j] == number]
            rows = np.searchsorted(first, here, "right") - 1
            found.append(np.stack([rows, here - first[rows], np.full(len(here), k)]))
        blocks = []
        for width, member, least in tables:
            mine = member[word]
            of_row, of_word, block = row[mine], word[mine], start[mine] // width
            # A word lies in the window that begins with its multiple of the
            # width, and in the one before.
            windows = int(block.max(initial=0)) + 1
            place = of_row * windows + block
            before = block > 0
            place = np.concatenate([place, place[before] - 1])
            kinds = len(vocabulary.words)
            held = np.unique(place * kinds + np.concatenate([of_word, of_word[before]]))
            window, words = held // kinds, held % kinds
            edges = np.flatnonzero(np.diff(window, prepend=-1, append=-1))
            for k in np.flatnonzero(np.diff(edges) >= least):
                row_of, index = divmod(int(window[edges[k]]), windows)
                own = words[edges[k] : edges[k + 1]].tolist()
                blocks.append((row_of, width, index * width, own))
        return np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1), blocks

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([
            ("width", pa.int32()),
            ("start", pa.int64()),
            ("words", pa.list_(pa.int32())),
        ])
        for batch in batches:
            for low, high, data, offsets in slices(*text_buffers(batch.column(1))):
                n = high - low
                begin, end, first = _word_places(data, offsets)
                found, blocks = places(begin, end, first, data)
                count = np.bincount(found[0], minlength=n)
                least = np.full(n, np.iinfo(np.int64).max)
                most = np.full(n, -1)
                np.minimum.at(least, found[0], found[1])
                np.maximum.at(most, found[0], found[1])
                seen = np.unique(found[[0, 2]], axis=1)
                seen_ends = np.cumsum(np.bincount(seen[0], minlength=n))
                of_row = [[] for _ in range(n)]
                for row, width, start, words in blocks:
                    of_row[row].append({"width": width, "start": start, "words": words})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, n),
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.array(count.astype(np.int64)),
                        pa.array(least, mask=count == 0),
                        pa.array(most, mask=count == 0),
                        lists(seen[1].astype(np.int32), seen_ends, pa.int32()),
                        pa.array(of_row, pa.list_(kind)),
                    ],
                    [
                        "doc_id",
                        "n_words",
                        "n_base",
                        "first_word",
                        "last_word",
                        "phrases",
                        "blocks",
                    ],
                )

    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    ).mapInArrow(read, SCANNED)


def scan_licenses(
    spark: SparkSession,
    docs: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    percent: int = PERCENT,
) -> DataFrame:
    """One row for every row of ``docs``, with its phrases and template blocks.

    Columns: ``doc_id``; ``n_words``; ``n_base``, places where the words of a
    phrase stand consecutively; ``first_word`` and ``last_word``, the smallest
    and largest start of such a place (else null); ``base_labels``, sorted
    labels of the phrases found; ``found``, the blocks that hold at least
    ``percent`` / 100 of a template's distinct words, as (start, width,
    template number, label, shared words, its words), in this order; ``score``,
    1 where a phrase was found, else the greatest share found, else 0.

    A null or empty text has no words. Repeated rows get equal results, rows
    without an id theirs; an empty table gives none. Other columns are ignored.
    No block that meets the threshold is left out; texts are read whole.
    """
    vocabulary = Vocabulary([t.text for t in templates] + [p for p, _ in phrases])
    rows = document_counts(docs, vocabulary)
    # Place of each word in the global order: rarest first, then by spelling.
    place = np.empty(len(rows), np.int64)
    place[np.lexsort((np.arange(len(rows)), rows))] = np.arange(len(rows))

    sets, widths = [], {}
    for template in templates:
        numbers = sorted({vocabulary.number[w] for w in words_of(template.text)})
        sets.append(sorted(int(place[n]) for n in numbers))
        width, least = width_of(template), least_shared(len(numbers), percent)
        members, smallest = widths.get(width, (set(), least))
        widths[width] = (members | set(numbers), min(smallest, least))
    wanted = [(w, sorted(m), least) for w, (m, least) in sorted(widths.items())]
    scanned = keep(
        spark,
        scan(docs, vocabulary, phrases, wanted).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "licenses",
    )

    ordered = F.array_sort(
        F.transform("words", lambda w: F.lit(place.tolist())[w])
    ).alias("words")
    blocks = (
        scanned.select("row", F.explode("blocks").alias("block"))
        .select("row", "block.width", "block.start", "block.words")
        .select("row", "width", "start", ordered)
    )
    # One row for each word of a template's prefix: as many as the templates
    # have words, whatever the corpus.
    prefixes = spark.createDataFrame(
        [
            (k, width_of(t), len(own), least, own, at, word)
            for k, (t, own) in enumerate(zip(templates, sets))
            for least in [least_shared(len(own), percent)]
            for at, word in enumerate(own[: len(own) - least + 1])
        ],
        "template int, t_width int, t_size int, least int, t_words array<long>, "
        "t_at int, t_word long",
    )
    fewest = spark.createDataFrame(
        [(width, least) for width, _, least in wanted], "width int, fewest int"
    )
    return _labelled(scanned, _joined(blocks, fewest, prefixes), templates, phrases)


def _joined(
    blocks: DataFrame, fewest: DataFrame, prefixes: DataFrame
) -> DataFrame:
    """(row, template, width, start, shared, size) of all blocks that hold enough."""
    # A block's prefix is that for the least which a template of its width asks.
    prefix = F.greatest(F.size("words") - F.col("fewest") + 1, F.lit(0))
    spread = blocks.join(F.broadcast(fewest), "width").select(
        "row",
        "width",
        "start",
        "words",
        F.posexplode(F.slice("words", F.lit(1), prefix)).alias("at", "word"),
    )
    n = F.size("words")
    # What two sets share lies in what is left of each from the first shared
    # word on.
    enough = F.least(n - F.col("at"), F.col("t_size") - F.col("t_at")) >= F.col("least")
    same = (F.col("word") == F.col("t_word")) & (F.col("width") == F.col("t_width"))
    candidates = spread.join(F.broadcast(prefixes), same).where(enough)
    shared = F.size(F.array_intersect("words", "t_words"))
    return (
        candidates.dropDuplicates(["row", "width", "start", "template"])
        .withColumn("shared", shared)
        .where("shared >= least")
        .select("row", "template", "width", "start", "shared", F.col("t_size").alias("size"))
    )


def _labelled(
    scanned: DataFrame,
    links: DataFrame,
    templates: Sequence[Template],
    phrases: Sequence[tuple[str, str]],
) -> DataFrame:
    names = F.lit([t.label for t in templates])
    link = F.struct(
        "start",
        "width",
        "template",
        F.get(names, F.col("template")).alias("label"),
        "shared",
        "size",
    )
    found = links.groupBy("row").agg(F.array_sort(F.collect_list(link)).alias("found"))
    spoken = F.lit([label for _, label in phrases])
    empty = F.array().cast(found.schema["found"].dataType)
    share = F.array_max(F.transform("found", lambda x: x["shared"] / x["size"]))
    return (
        scanned.drop("blocks")
        .join(found, "row", "left")
        .withColumn("found", F.coalesce("found", empty))
        .select(
            "doc_id",
            "n_words",
            "n_base",
            "first_word",
            "last_word",
            F.array_sort(
                F.array_distinct(F.transform("phrases", lambda p: F.get(spoken, p)))
            ).alias("base_labels"),
            "found",
            F.when(F.col("n_base") > 0, F.lit(1.0))
            .otherwise(F.coalesce(share, F.lit(0.0)))
            .alias("score"),
        )
    )


def license_labels(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of the query, and how many (block, template) links there are.

    A block takes the labels of the templates that share the most words with
    it: a notice of one license may hold all words of a shorter one.
    """
    scanned = scan_licenses(spark, docs)

    def closest(link: Column) -> Column:
        """Whether no template shares more words with the same block."""
        return ~F.exists(
            "found",
            lambda other: (other["start"] == link["start"])
            & (other["width"] == link["width"])
            & (other["shared"] > link["shared"]),
        )

    named = F.transform(F.filter("found", closest), lambda link: link["label"])
    every = F.array_union("base_labels", named)
    return scanned.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        "score",
        F.size("found").cast("long").alias("n_blocks"),
    )
