"""Secret scans: known forms, and strings that a vocabulary spells badly."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from public_tokenizers import PATTERN

from headway.llm.bpe import VOCABULARY, read_ranks
from headway.llm.common import neutral, select_as, select_back

# Kinds of spans in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "random")

# The token-efficiency test: a string of at least so many characters is
# random if the vocabulary needs a token for fewer than so many of them.
# Words take three and more, random letters and digits about 1.5.
MIN_LENGTH = 20
CHARS_PER_TOKEN = 2.2
# The same for strings with the form of an identifier, in lower case and
# without joints: long words of many languages take little more than two.
WORD_CHARS_PER_TOKEN = 2.0
# Longer strings are counted in runs, so that time stays linear.
COUNTED_CHARS = 256

# The forms of the base spans.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_VALUE, MIN_ACCESS = 8, 16

# What a secret can be made of. Base64 has slashes, and signed tokens dots, but
# so have paths and host names: a run is judged whole, and if it is spelled
# well, by its parts. A run of more and shorter parts is a list, date or path.
_CANDIDATE = re.compile(r"[A-Za-z0-9+_=/.-]{%d,}" % MIN_LENGTH)
_PART = re.compile(r"[^/.]+")
FEW_PARTS, PART_LENGTH = 6, 8
# Words at the ends of a random run that belong to a path or a host.
_END_WORD, END_CHARS_PER_TOKEN = re.compile(r"[A-Z]?[a-z]{4,}"), 3
# Known digests: hexadecimal of MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
_DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
_HEXADECIMAL = re.compile(r"[0-9A-Fa-f]+")
_UUID = re.compile(
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
)
# Identifiers: words or numbers, joined by these signs, with digits at the end
# of a word only, in lower, upper, title or camel case.
_JOINTS = re.compile(r"[_=+-]+")
_IDENTIFIER = re.compile(r"[A-Z]?[a-z]*(?:[A-Z][a-z]+)*[0-9]*|[A-Z]+[0-9]*")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

Span = tuple[int, str, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the known forms, ends exclusive."""
    spans: list[Span] = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(hint in low for hint in _ASSIGN_HINTS):
            spans += [
                (m.start(), "assign", m.end())
                for m in _ASSIGN.finditer(text)
                if len(m[2]) >= MIN_VALUE
            ]
    if "AKIA" in text:
        spans += [
            (m.start(), "access", m.end())
            for m in _ACCESS.finditer(text)
            if m.end() - m.start() >= MIN_ACCESS
        ]
    spans += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return spans


def digest(value: str) -> bool:
    """Whether a string is a digest or a UUID."""
    if _HEXADECIMAL.fullmatch(value) and len(value) in _DIGEST_LENGTHS:
        return True
    return bool(_UUID.fullmatch(value))


def known_form(value: str) -> bool:
    """Whether a string has the form of a digest, a UUID or an identifier."""
    return digest(value) or all(
        _IDENTIFIER.fullmatch(p) for p in _JOINTS.split(value)
    )


def _tokens(value: str, count_tokens) -> int:
    return sum(
        count_tokens(value[i : i + COUNTED_CHARS])
        for i in range(0, len(value), COUNTED_CHARS)
    )


def is_random(value: str, count_tokens) -> bool:
    """Whether the vocabulary spells a string without dots and slashes badly.

    An identifier is judged by its words, in lower case.
    """
    if digest(value):
        return False
    if known_form(value) and not value.isdigit():
        words = [w.lower() for w in _WORD.findall(value)]
        n = sum(_tokens(w, count_tokens) for w in words)
        return sum(map(len, words)) < WORD_CHARS_PER_TOKEN * n
    return len(value) < CHARS_PER_TOKEN * _tokens(value, count_tokens)


def _random_run(text: str, parts: list[tuple[int, int]], count_tokens) -> bool:
    """Whether parts, with the dots and slashes between, are one random string."""
    held = [text[a:b] for a, b in parts]
    size = sum(map(len, held))
    # Digests and UUIDs are known, numbers are parts of dates and versions.
    if any(map(digest, held)) or all(h.isdigit() for h in held):
        return False
    if len(held) > max(FEW_PARTS, size // PART_LENGTH):
        return False
    if all(map(known_form, held)):
        words = [w.lower() for h in held for w in _WORD.findall(h)]
        n = sum(_tokens(w, count_tokens) for w in words)
        return sum(map(len, words)) < WORD_CHARS_PER_TOKEN * n
    return size < CHARS_PER_TOKEN * sum(_tokens(h, count_tokens) for h in held)


def _end_word(value: str, count_tokens) -> bool:
    return bool(_END_WORD.fullmatch(value)) and (
        len(value) >= END_CHARS_PER_TOKEN * _tokens(value, count_tokens)
    )


def random_spans(text: str, count_tokens, taken: list[Span]) -> Iterator[Span]:
    """Strings with few characters a token, outside of all other spans."""
    # As stretches that do not overlap, candidates and spans are both in order,
    # and each is looked at once or twice.
    covered: list[list[int]] = []
    for s, _, e in sorted(taken):
        if covered and s <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    first = 0
    for m in _CANDIDATE.finditer(text):
        at, free = m.start(), []
        while first < len(covered) and covered[first][1] <= at:
            first += 1
        for k in range(first, len(covered)):
            s, e = covered[k]
            if s >= m.end():
                break
            free.append((at, s))
            at = max(at, e)
        for low, high in [*free, (at, m.end())]:
            # Dots at the ends belong to the sentence.
            while low < high and text[low] == ".":
                low += 1
            while low < high and text[high - 1] == ".":
                high -= 1
            if high - low >= MIN_LENGTH:
                yield from _random_within(text, low, high, count_tokens)


def _random_within(text: str, low: int, high: int, count_tokens) -> Iterator[Span]:
    parts = [p.span() for p in _PART.finditer(text, low, high)]
    if len(parts) > 1 and _random_run(text, parts, count_tokens):
        first, last = 0, len(parts)
        while first < last and _end_word(text[slice(*parts[first])], count_tokens):
            first += 1
        while first < last and _end_word(text[slice(*parts[last - 1])], count_tokens):
            last -= 1
        if first < last:
            yield (
                low if first == 0 else parts[first][0],
                "random",
                high if last == len(parts) else parts[last - 1][1],
            )
        return
    for a, b in parts:
        if len(parts) == 1:
            # A slash before or behind the only part is one of its characters.
            span = (low, high)
        else:
            span = (a, b)
        if span[1] - span[0] >= MIN_LENGTH and is_random(text[a:b], count_tokens):
            yield (span[0], "random", span[1])


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[1]), span[2]


def secret_spans(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text, spans) with ``spans`` an array of (kind, start, end).

    Places count code points, ends are exclusive. The spans of known forms
    are there in any case; ``random`` ones are strings of at least
    ``MIN_LENGTH`` characters with under ``CHARS_PER_TOKEN`` characters for a
    token of the vocabulary, or what other spans leave of such a string, which
    are no digests, UUIDs or identifiers of well-spelled words. All rows stay, in one pass without a shuffle. A null
    or empty text has no spans; other columns are not carried.
    """
    ranks = read_ranks(vocabulary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tiktoken.Encoding(
            "secrets", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

        def count_tokens(value: str) -> int:
            return len(coder.encode_ordinary(value))

        for batch in batches:
            found = []
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = base_spans(text)
                spans += list(random_spans(text, count_tokens, spans))
                found.append(
                    [
                        {"kind": kind, "start": start, "end": end}
                        for start, kind, end in sorted(spans, key=_order)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(
                        found,
                        pa.list_(
                            pa.struct(
                                [
                                    ("kind", pa.string()),
                                    ("start", pa.int64()),
                                    ("end", pa.int64()),
                                ]
                            )
                        ),
                    ),
                ],
                ["doc_id", "text", "spans"],
            )

    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    ).mapInArrow(
        scan,
        "doc_id long, text string, "
        "spans array<struct<kind:string,start:long,end:long>>",
    )


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        ),
        ",",
    )


def counted(docs: DataFrame) -> DataFrame:
    """Counts, digest and text of the spans of every document."""
    spans = F.col("spans")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    base = F.filter(spans, lambda s: s["kind"] != "random")
    return secret_spans(docs).select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(spelled(base), 256).alias("base_sha256"),
        spelled(spans).alias("spans"),
    )


def redact(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with all secrets in their texts replaced by ``[secret]``.

    No row is dropped and no other column changes, except for ``n_chars``,
    where there is one, in rows whose text changed.
    """
    ranks = read_ranks(vocabulary)
    names = neutral(docs.columns)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tiktoken.Encoding(
            "secrets", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

        def count_tokens(value: str) -> int:
            return len(coder.encode_ordinary(value))

        for batch in batches:
            at = batch.schema.get_field_index(names["text"])
            texts, lengths = [], []
            for value in batch.column(at):
                text = value.as_py()
                length = None
                if text:
                    spans = base_spans(text)
                    spans += list(random_spans(text, count_tokens, spans))
                    if spans:
                        text = replace_spans(text, sorted(spans, key=_order))
                        length = len(text)
                texts.append(text)
                lengths.append(length)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lengths, pa.int64())],
                [*batch.schema.names, "length"],
            )

    plain = [T.StructField(names[f.name], f.dataType) for f in docs.schema.fields]
    schema = T.StructType([*plain, T.StructField("length", T.LongType())])
    cleaned = select_as(docs, names).mapInArrow(clean, schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn(
            names["n_chars"],
            F.coalesce(F.col("length").cast(kind), names["n_chars"]),
        )
    return select_back(cleaned, names)


def replace_spans(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
