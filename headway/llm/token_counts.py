"""Token counts that follow edits, by a segment tree for each document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from public_tokenizers import PATTERN

from headway.llm.bpe import VOCABULARY, read_ranks

# Pre-tokens in a leaf when a tree is built.
LEAF = 16
# A leaf with more than so many times its pre-tokens has the tree rebuilt.
OVERFULL = 8
# Distinct pre-tokens whose counts a worker remembers.
REMEMBERED = 1 << 17

STATE = "doc_id long, text string, chars array<int>, tokens array<int>"
EDIT = "array<struct<start:long,end:long,insert:string>>"


class Counter:
    """Token counts of pre-tokens, each encoded by itself."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self._split = regex.compile(PATTERN)
        self._coder = tiktoken.Encoding(
            "counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self._known.get(piece)
        if n is None:
            n = len(self._coder.encode_ordinary(piece))
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[piece] = n
        return n

    def pieces(self, text: str, start: int = 0) -> Iterator[str]:
        for match in self._split.finditer(text, start):
            yield match.group()


class Tree:
    """Characters and tokens of a document's runs of pre-tokens.

    Two arrays hold the sums of a full binary tree: entry 1 is the root and
    the second half the leaves. A leaf begins where a pre-token does.
    """

    def __init__(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.chars, self.tokens = chars, tokens

    @classmethod
    def build(cls, text: str, counter: Counter) -> Tree:
        pieces = list(counter.pieces(text))
        return cls.of_leaves(pieces, max(1, -(-len(pieces) // LEAF)), counter)

    @classmethod
    def of_leaves(cls, pieces: list[str], leaves: int, counter: Counter) -> Tree:
        width = 1 << (leaves - 1).bit_length()
        arrays = []
        for measure in (len, counter.count):
            sums = np.zeros(2 * width, np.int32)
            sums[width : width + leaves] = _leaf_sums(pieces, leaves, measure)
            low = width
            while low > 1:
                sums[low // 2 : low] = (
                    sums[low : 2 * low : 2] + sums[low + 1 : 2 * low : 2]
                )
                low //= 2
            arrays.append(sums)
        return cls(*arrays)

    @property
    def width(self) -> int:
        return len(self.chars) // 2

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    def find(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds a character."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.width, start

    def replace(self, low: int, high: int, pieces: list[str], counter: Counter):
        """Spread ``pieces`` over the leaves from low to high and update the
        sums above them."""
        for sums, measure in ((self.chars, len), (self.tokens, counter.count)):
            sums[self.width + low : self.width + high] = _leaf_sums(
                pieces, high - low, measure
            )
            first, last = self.width + low, self.width + high - 1
            while first > 1:
                first, last = first // 2, last // 2
                sums[first : last + 1] = (
                    sums[2 * first : 2 * last + 1 : 2]
                    + sums[2 * first + 1 : 2 * last + 2 : 2]
                )


def _leaf_sums(pieces: list[str], leaves: int, measure) -> np.ndarray:
    each = -(-len(pieces) // leaves) if pieces else 1
    sizes = np.array([measure(p) for p in pieces], np.int64)
    sums = np.zeros(leaves, np.int64)
    if len(sizes):
        full = np.add.reduceat(sizes, np.arange(0, len(sizes), each))
        sums[: len(full)] = full
    return sums


def apply_edit(
    text: str, tree: Tree, start: int, end: int, insert: str, counter: Counter
) -> tuple[str, Tree, int]:
    """(new text, tree, pre-tokens encoded) after replacing [start, end).

    A pre-token depends on the text from its start to two characters beyond
    its end: a run of white space leaves its last character to what follows,
    and an apostrophe looks for a short form of two letters. So all that end
    two characters before the edit stay, and white space that reaches the edit
    is never among them; encoding starts with the leaf of the second character
    in front of the edit and stops at the first boundary of pre-tokens that is
    an old leaf's start behind the edit, as from there on the text is the same.
    """
    length = len(text)
    start = min(max(start, 0), length)
    end = min(max(end, start), length)
    fresh = text[:start] + insert + text[end:]
    grown = len(insert) - (end - start)
    if not length:
        built = Tree.build(fresh, counter)
        return fresh, built, sum(1 for _ in counter.pieces(fresh))
    low, at = tree.find(max(start - 2, 0))
    first_char = at
    # Old leaf starts at or behind the edit's end, one after the other.
    high, behind = (
        (low, at) if end <= at else tree.find(min(end, length) - 1)
    )
    if behind < end:
        behind += int(tree.chars[tree.width + high])
        high += 1
    pieces: list[str] = []
    for piece in counter.pieces(fresh, first_char):
        while behind < length and behind + grown < at:
            behind += int(tree.chars[tree.width + high])
            high += 1
        if at == behind + grown and at >= start + len(insert) and high > low:
            break
        pieces.append(piece)
        at += len(piece)
    else:
        high = tree.width
    if len(pieces) > OVERFULL * LEAF * (high - low):
        return fresh, Tree.build(fresh, counter), len(pieces)
    tree.replace(low, high, pieces, counter)
    return fresh, tree, len(pieces)


def _column(values, kind) -> pa.Array:
    return pa.array(values, kind)


_SUMS = pa.list_(pa.int32())


def build_state(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text, chars, tokens): the segment tree of every text.

    ``tokens[1]`` is a document's token count. A null text is empty. All rows
    stay; nothing is shuffled. Other columns are not carried.
    """
    ranks = read_ranks(vocabulary)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            trees = [Tree.build(t, counter) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    _column(texts, pa.string()),
                    _column([t.chars for t in trees], _SUMS),
                    _column([t.tokens for t in trees], _SUMS),
                ],
                ["doc_id", "text", "chars", "tokens"],
            )

    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    ).mapInArrow(build, STATE)


def apply_edits(
    state: DataFrame, edits: str = "edits", vocabulary: str = VOCABULARY
) -> DataFrame:
    """The state after the edits in its column ``edits``, with counts.

    Edits of a row are applied in order, each to the text as the one before
    left it: the code points [start, end) become ``insert``. Places beyond
    the text are moved to its end, null fields count as 0 or empty, and null
    or no edits change nothing. ``n_before`` and ``n_after`` are token
    counts, ``n_encoded`` the pre-tokens encoded again.
    """
    ranks = read_ranks(vocabulary)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks)
        for batch in batches:
            rows = []
            ids, texts, changed = (batch.column(i).to_pylist() for i in (0, 1, 4))
            for doc_id, text, chars, tokens, changes in zip(
                ids, texts, batch.column(2), batch.column(3), changed
            ):
                tree = Tree(
                    chars.values.to_numpy().copy(), tokens.values.to_numpy().copy()
                )
                before, encoded = tree.n_tokens, 0
                for change in changes or []:
                    if change is None:
                        continue
                    text, tree, n = apply_edit(
                        text,
                        tree,
                        change["start"] or 0,
                        change["end"] or 0,
                        change["insert"] or "",
                        counter,
                    )
                    encoded += n
                rows.append(
                    (
                        doc_id,
                        text,
                        tree.chars,
                        tree.tokens,
                        before,
                        tree.n_tokens,
                        encoded,
                    )
                )
            kinds = [pa.int64(), pa.string(), _SUMS, _SUMS, *[pa.int64()] * 3]
            columns = zip(*rows) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [_column(list(c), k) for c, k in zip(columns, kinds)],
                ["doc_id", "text", "chars", "tokens", "n_before", "n_after", "n_encoded"],
            )

    return state.select(
        "doc_id", "text", "chars", "tokens", F.col(edits).cast(EDIT)
    ).mapInArrow(
        edit, f"{STATE}, n_before long, n_after long, n_encoded long"
    )


def with_edits(state: DataFrame, edits: DataFrame) -> DataFrame:
    """``state`` with the edits of ``edits(doc_id, edits)``, if there are."""
    return state.join(edits.select("doc_id", "edits"), "doc_id", "left")
