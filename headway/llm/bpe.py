"""Byte-level BPE: ranked merges folded over the bytes of distinct words.

``encode_word`` is the fold as Spark higher-order functions, ``fold_words`` the
same fold for all words of a group at once, in Arrow batches. The first is
made of column expressions only; the second takes a tenth of the time.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Bytes of text whose distinct words are encoded together. A longer document
# makes a group of its own. Working arrays take some thirty times as much.
GROUP_BYTES = 1 << 20
# Tokens that are decoded together.
GROUP_TOKENS = 1 << 18
# The rank map is split into this many small maps, found by checksum.
BUCKETS = 1 << 16
# Larger than any rank: a pair that cannot be merged.
NO_RANK = 2**31 - 1
PLACES = 2**31
# Words of more bytes are merged one by one from a heap: rounds over arrays
# would take time with the square of their length. Both give the same tokens.
LONG_WORD = 256


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """Rank of every piece, from a file of base64 pieces and ranks."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(piece): int(rank) for piece, rank in pairs}


def java_pattern(pattern: str = public_tokenizers.PATTERN) -> str:
    """The splitting pattern with white space as Unicode defines it."""
    return f"(?U){pattern}"


def split_words(text: Column, pattern: str = public_tokenizers.PATTERN) -> Column:
    """The matches of the splitting pattern, in order (null: none)."""
    return F.regexp_extract_all(
        F.coalesce(text.cast("string"), F.lit("")),
        F.lit(java_pattern(pattern)),
        F.lit(0),
    )


def rank_map(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The rank map as a literal: small maps at the checksum's place.

    A scalar subquery over one local row, so that plans name it instead of
    spelling out all pieces. Its size is that of the vocabulary.
    """
    held: list[list[tuple[bytes, int]]] = [[] for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        held[zlib.crc32(piece) % BUCKETS].append((piece, rank))
    kind = pa.list_(pa.map_(pa.binary(), pa.int32()))
    row = pa.table({"ranks": pa.array([held], kind)})
    return spark.createDataFrame(row).scalar()


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def encode_word(word: Column, ranks: Column) -> Column:
    """Token ids of one word, a binary column.

    The fold starts from single bytes and merges, as often as there are
    bytes, the leftmost pair of the lowest rank. It keeps the rank of every
    neighbouring pair, so that a merge looks up only the two pairs it makes.
    """

    def rank_of(piece: Column) -> Column:
        small = F.get(ranks, (F.crc32(piece) % BUCKETS).cast("int"))
        return F.coalesce(F.try_element_at(small, piece), F.lit(NO_RANK))

    def spell(parts: Column) -> Column:
        return F.transform(parts, rank_of)

    def fold(parts: Column) -> Column:
        pairs = F.transform(
            F.slice(parts, 1, F.size(parts) - 1),
            lambda p, i: rank_of(F.concat(p, F.get(parts, i + 1))),
        )
        start = F.struct(parts.alias("parts"), pairs.alias("pairs"))

        def step(state: Column, _: Column) -> Column:
            # Rank and place in one number: the least is the leftmost best.
            best = F.array_min(
                F.transform(
                    state["pairs"], lambda rank, i: rank * F.lit(PLACES) + i
                )
            )
            return _let(
                best,
                lambda key: F.when(
                    F.coalesce(key >= NO_RANK * PLACES, F.lit(True)), state
                ).otherwise(
                    _let(
                        (key % PLACES).cast("int"),
                        lambda at: merge(state["parts"], state["pairs"], at),
                    )
                ),
            )

        return spell(
            F.aggregate(F.sequence(F.lit(2), F.size(parts)), start, step)["parts"]
        )

    def merge(parts: Column, pairs: Column, at: Column) -> Column:
        """Join the parts at ``at`` and after it."""

        def joined(piece: Column) -> Column:
            left = F.concat(F.get(parts, at - 1), piece)
            right = F.concat(piece, F.get(parts, at + 2))
            return F.struct(
                F.transform(
                    F.filter(parts, lambda _, i: i != at + 1),
                    lambda p, i: F.when(i == at, piece).otherwise(p),
                ).alias("parts"),
                F.transform(
                    F.filter(pairs, lambda _, i: i != at),
                    lambda rank, i: F.when(i == at - 1, rank_of(left))
                    .when(i == at, rank_of(right))
                    .otherwise(rank),
                ).alias("pairs"),
            )

        return _let(F.concat(F.get(parts, at), F.get(parts, at + 1)), joined)

    bytes_ = F.transform(
        F.sequence(F.lit(1), F.octet_length(word)),
        lambda i: F.substring(word, i, F.lit(1)),
    )
    known = rank_of(word)
    return _let(
        known,
        lambda rank: F.when(rank < NO_RANK, F.array(rank)).otherwise(
            _let(bytes_, fold)
        ),
    )


class Pairs:
    """The rank that each pair of neighbouring tokens merges to."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        keys, merged = [], []
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        # One more that no pair equals, so that a search always ends inside.
        self._keys = np.append(np.array(keys, np.int64)[order], 2**63 - 1)
        self._merged = np.append(np.array(merged, np.int64)[order], NO_RANK)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.searchsorted(self._keys, keys)
        return np.where(self._keys[at] == keys, self._merged[at], NO_RANK)


def fold_long(data: np.ndarray, pairs: Pairs) -> np.ndarray:
    """Token ids of one long word, in n log n time.

    A heap holds (rank, place) of all pairs that can be merged, so that the
    leftmost of the lowest rank comes first. An entry whose pair has changed
    since is passed over: ``held`` has the present rank of each place.
    """
    coded = pairs.bytes[data]
    n = len(coded)
    first = pairs.rank(coded[:-1], coded[1:])
    places = np.flatnonzero(first < NO_RANK)
    # Sorted entries are a heap.
    heap = np.sort(first[places] << 32 | places).tolist()
    ids, held = coded.tolist(), [*first.tolist(), NO_RANK]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    known: dict[tuple[int, int], int] = {}

    def update(at: int) -> None:
        """The rank of the pair that begins at ``at``, as it is now."""
        right = after[at]
        if right >= n:
            held[at] = NO_RANK
            return
        pair = ids[at], ids[right]
        if pair not in known:
            known[pair] = int(pairs.rank(np.int64(pair[0]), np.int64(pair[1])))
        held[at] = known[pair]
        if held[at] < NO_RANK:
            heapq.heappush(heap, held[at] << 32 | at)

    while heap:
        entry = heapq.heappop(heap)
        rank, at = entry >> 32, entry & 0xFFFFFFFF
        if held[at] != rank:
            continue
        gone = after[at]
        ids[at], held[gone], after[at] = rank, NO_RANK, after[gone]
        if after[at] < n:
            before[after[at]] = at
        update(at)
        if before[at] >= 0:
            update(before[at])
    found, at = [], 0
    while at < n:
        found.append(ids[at])
        at = after[at]
    return np.array(found, np.int64)


def fold_words(
    data: np.ndarray, offsets: np.ndarray, pairs: Pairs
) -> tuple[np.ndarray, np.ndarray]:
    """(token ids of all words, number of each word's)."""
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes > LONG_WORD)
    if not len(long):
        return _fold_short(data, offsets, pairs)
    # The long words are left empty for the rounds, and filled in after.
    short = np.where(sizes > LONG_WORD, 0, sizes)
    ids, counts = _fold_short(
        data[np.repeat(sizes <= LONG_WORD, sizes)],
        np.concatenate([[0], np.cumsum(short)]),
        pairs,
    )
    merged = [fold_long(data[offsets[w] : offsets[w + 1]], pairs) for w in long]
    at = np.concatenate([[0], np.cumsum(counts)])[long]
    counts[long] = [len(m) for m in merged]
    parts = np.split(ids, at)
    mended = [parts[0]]
    for more, rest in zip(merged, parts[1:]):
        mended += [more, rest]
    return np.concatenate(mended), counts


def _fold_short(
    data: np.ndarray, offsets: np.ndarray, pairs: Pairs
) -> tuple[np.ndarray, np.ndarray]:
    """(token ids of all words, number of each word's).

    In every round each word that can merges its leftmost pair of the lowest
    rank; a word that cannot is done and leaves the arrays.
    """
    ids = pairs.bytes[data]
    words = len(offsets) - 1
    owner = np.repeat(np.arange(words), np.diff(offsets))

    def ranked(at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at these places."""
        found = np.full(len(at), NO_RANK)
        near = at + 1 < len(ids)
        near[near] = owner[at[near]] == owner[at[near] + 1]
        found[near] = pairs.rank(ids[at[near]], ids[at[near] + 1])
        return found

    ranks = ranked(np.arange(len(ids)))
    ended: list[tuple[np.ndarray, np.ndarray]] = []
    while len(ids):
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(starts, len(ids)))
        best = np.minimum.reduceat(ranks, starts)
        live = np.repeat(best < NO_RANK, sizes)
        if not live.all():
            ended.append((owner[~live], ids[~live]))
            ids, owner, ranks = ids[live], owner[live], ranks[live]
            best, sizes = best[best < NO_RANK], sizes[best < NO_RANK]
            if not len(ids):
                break
        at = np.flatnonzero(ranks == np.repeat(best, sizes))
        at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])]
        ids[at] = best
        stay = np.ones(len(ids), bool)
        stay[at + 1] = False
        ids, owner, ranks = ids[stay], owner[stay], ranks[stay]
        # Each word before a merge has lost one place.
        at = at - np.arange(len(at))
        ranks[at] = ranked(at)
        before = at[at > 0] - 1
        before = before[owner[before] == owner[before + 1]]
        ranks[before] = ranked(before)
    if not ended:
        return ids, np.zeros(words, np.int64)
    owners = np.concatenate([o for o, _ in ended])
    order = np.argsort(owners, kind="stable")
    found = np.concatenate([i for _, i in ended])[order]
    return found, np.bincount(owners, minlength=words)


def _encode_words(words: pa.Array, ranks: dict[bytes, int], pairs: Pairs) -> pa.Array:
    """Token ids of each word; a word that is a piece is one token."""
    raw = words.cast(pa.large_binary())
    known = np.array([ranks.get(w, -1) for w in raw.to_pylist()], np.int64)
    rest = raw.filter(pa.array(known < 0))
    offsets = np.frombuffer(rest.buffers()[1], np.int64)[: len(rest) + 1]
    body = rest.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    ids, counts = fold_words(data[offsets[0] : offsets[-1]], offsets - offsets[0], pairs)
    sizes = np.ones(len(known), np.int64)
    sizes[known < 0] = counts
    flat = np.repeat(known, sizes)
    flat[flat < 0] = ids
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _runs(ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows within a limit, from running sums; at least one row."""
    low, rows = 0, len(ends) - 1
    while low < rows:
        fits = np.searchsorted(ends, ends[low] + limit, "right")
        high = int(min(max(fits - 1, low + 1), rows))
        yield low, high
        low = high


def _groups(words: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of documents within ``GROUP_BYTES``, from their split texts."""
    ends = words.offsets.to_numpy()
    lengths = pc.binary_length(words.flatten()).to_numpy(False)
    sizes = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])[ends - ends[0]]
    return _runs(sizes, GROUP_BYTES)


def _vocabulary(ranks: dict[bytes, int]) -> list[bytes]:
    """The piece of every id."""
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def _join_pieces(coded: pa.ListArray, vocabulary: pa.Array) -> pa.Array:
    """The bytes of each row's ids: the pieces, taken from the vocabulary side
    by side, form one buffer of which each row has its part."""
    ends = coded.offsets.to_numpy()
    joined = vocabulary.take(coded.values.slice(ends[0], ends[-1] - ends[0]))
    starts = np.frombuffer(joined.buffers()[1], np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(coded),
        [
            None,
            pa.py_buffer(starts[ends - ends[0]] - starts[0]),
            joined.buffers()[2],
        ],
    ).cast(pa.binary())


def _in_batches(
    kept: list[str], names: list[str], ranks: dict[bytes, int], pieces: list[bytes]
):
    """Token ids of documents, a group at a time; with two ``names`` also the
    bytes that the ids decode to."""
    pairs = Pairs(ranks)

    def encode_batches(
        batches: Iterator[pa.RecordBatch],
    ) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(pieces, pa.large_binary())
        for batch in batches:
            split = batch.column(len(kept))
            for low, high in _groups(split):
                part = split.slice(low, high - low)
                coded = part.flatten().dictionary_encode()
                ids = _encode_words(coded.dictionary, ranks, pairs).take(coded.indices)
                ends = part.offsets.to_numpy()
                tokens = ids.offsets.to_numpy()[ends - ends[0]]
                made = [pa.ListArray.from_arrays(pa.array(tokens), ids.values)]
                if len(names) > 1:
                    made.append(_join_pieces(made[0], vocabulary))
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(low, high - low) for c in batch.columns[:-1]], *made],
                    [*kept, *names],
                )

    return encode_batches


def encode(
    spark: SparkSession,
    docs: DataFrame,
    ranks: dict[bytes, int] | None = None,
    pattern: str = public_tokenizers.PATTERN,
    text: str = "text",
    ids: str = "token_ids",
    native: bool = False,
    decoded: str | None = None,
) -> DataFrame:
    """``docs`` with the token ids of their texts in column ``ids``.

    With ``decoded``, a column of this name has the bytes that the ids decode
    to, as from ``decode``, but by the same worker as the ids: half as many
    workers hold a vocabulary, and the ids pass to Python only once.

    The pattern splits each text, and each word is encoded by itself. Nothing
    is shuffled: documents of one partition are handled in groups, and each
    distinct word of a group is encoded once; with ``native`` each word is
    encoded by column functions alone. A null or empty text has no tokens, and
    an empty table gives an empty result. Long words and texts take n log n
    time. All other columns, repeated rows included, stay as they are; existing
    columns of the new names are replaced. ``pattern`` must cover all text, and
    every single byte needs a rank.
    """
    ranks = read_ranks() if ranks is None else ranks
    rest = [f for f in docs.schema.fields if f.name not in (ids, decoded)]
    # Neutral names inside, so that columns may be called anything.
    kept = [f"c{i}" for i in range(len(rest))]
    named = docs.select(
        *[F.col(f"`{f.name}`").alias(c) for f, c in zip(rest, kept)],
        split_words(F.col(f"`{text}`")).alias("_split"),
    )
    plain = [T.StructField(c, f.dataType) for f, c in zip(rest, kept)]
    tokens = T.StructField(ids, T.ArrayType(T.IntegerType()))
    made = [tokens, *([T.StructField(decoded, T.BinaryType())] if decoded else [])]
    if native:
        each = F.transform(
            "_split", lambda w: encode_word(w.cast("binary"), F.col("_ranks"))
        )
        coded = named.withColumn("_ranks", rank_map(spark, ranks)).select(
            *kept, F.flatten(each).alias(ids)
        )
        if decoded:
            coded = decode(coded, ranks, ids, decoded)
    else:
        new = [f.name for f in made]
        coded = named.mapInArrow(
            _in_batches(kept, new, ranks, _vocabulary(ranks) if decoded else []),
            T.StructType([*plain, *made]),
        )
    return coded.select(
        *[F.col(c).alias(f.name) for f, c in zip(rest, kept)],
        *[F.col(f"`{f.name}`") for f in made],
    )


def decode(
    tokens: DataFrame,
    ranks: dict[bytes, int] | None = None,
    ids: str = "token_ids",
    text: str = "decoded",
) -> DataFrame:
    """``tokens`` with the decoded bytes in the binary column ``text``.

    The pieces of the ids are concatenated. Null ids give null, no ids empty
    bytes. An id outside the vocabulary is an error.
    """
    ranks = read_ranks() if ranks is None else ranks
    pieces = _vocabulary(ranks)
    rest = [f for f in tokens.schema.fields if f.name != text]
    kept = [f"c{i}" for i in range(len(rest))]
    at = [f.name for f in rest].index(ids)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(pieces, pa.large_binary())
        for whole in batches:
            for low, high in _runs(whole.column(at).offsets.to_numpy(), GROUP_TOKENS):
                batch = whole.slice(low, high - low)
                coded = batch.column(at)
                found = _join_pieces(coded, vocabulary)
                if coded.null_count:
                    found = pc.if_else(coded.is_valid(), found, None)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, found], [*kept, text]
                )

    plain = [T.StructField(c, f.dataType) for f, c in zip(rest, kept)]
    return (
        tokens.select(*[F.col(f"`{f.name}`").alias(c) for f, c in zip(rest, kept)])
        .mapInArrow(
            join, T.StructType([*plain, T.StructField(text, T.BinaryType())])
        )
        .select(
            *[F.col(c).alias(f.name) for f, c in zip(rest, kept)],
            F.col(f"`{text}`"),
        )
    )


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Token count, and digests of the ids and of the decoded bytes."""
    coded = encode(spark, docs.select("doc_id", "text"), decoded="decoded")
    spelled = F.concat_ws(" ", F.col("token_ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(spelled, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
