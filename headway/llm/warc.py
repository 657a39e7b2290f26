"""WARC archives: written whole, then one gzip member a record, with an index."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import keep
from headway.session import scratch_dir

# Smaller payloads are never revisits.
MIN_REVISIT = 100
# Uncompressed bytes after which a task begins another archive, so that
# archives can be normalised and read side by side.
ARCHIVE_BYTES = 32 << 20
_CHUNK = 1 << 20
_GZIP = 31  # zlib's window bits for gzip streams
_END = b"\r\n\r\n"

_MANIFEST = "archive string, records long, raw_bytes long"
_INDEX = "archive string, record_id string, offset long, length long, raw_bytes long"
_RECORDS = (
    "page_id long, uri string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


def _open(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder's address and the folder in it."""
    address = folder if "://" in folder else re.sub(r"^file:/*", "/", folder)
    return pa.fs.FileSystem.from_uri(address)


def _header_text(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record_bytes(
    page_id: int | None,
    uri: str,
    kind: str,
    refers_to: int | None,
    digest: str,
    payload: bytes,
) -> bytes:
    """One WARC record. A revisit keeps the HTTP header with the length of the
    payload that it repeats, and not the payload."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if kind == "revisit" else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Target-URI: {_header_text(uri)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
            "identical-payload-digest",
            f"WARC-Refers-To: {_urn(refers_to)}",
        ]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + _END + block + _END


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    pairs = (line.partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def with_revisits(
    pages: DataFrame, page_id: Column, uri: Column, payload: Column
) -> DataFrame:
    """(page_id, uri, record_type, refers_to, payload_digest, payload).

    Of pages with equal payloads of at least ``MIN_REVISIT`` bytes, the
    smallest id is the response and the others revisit it.
    """
    named = pages.select(
        page_id.cast("long").alias("page_id"),
        F.coalesce(uri.cast("string"), F.lit("")).alias("uri"),
        F.coalesce(payload.cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("payload_digest", F.sha2("payload", 256))
    first = (
        named.where(F.octet_length("payload") >= MIN_REVISIT)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    known = named.join(first, "payload_digest", "left")
    again = ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    return known.select(
        "page_id",
        "uri",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
        "payload_digest",
        "payload",
    )


def write_monolithic(records: DataFrame, folder: str) -> DataFrame:
    """Write records as gzip archives of a single member each.

    Gives (archive, records, raw_bytes) of each. An archive has a name of its
    own for every attempt of a task, and only those named by the result
    count: a task that runs again leaves an unused file, never a torn one.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        out = packer = name = None
        count = size = 0

        def close() -> pa.RecordBatch:
            out.write(packer.flush())
            out.close()
            return pa.RecordBatch.from_pylist(
                [{"archive": name, "records": count, "raw_bytes": size}]
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for i, (page_id, uri, kind, refers_to, digest) in enumerate(
                zip(*columns)
            ):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    packer = zlib.compressobj(wbits=_GZIP)
                    count = size = 0
                raw = record_bytes(
                    page_id, uri, kind, refers_to, digest, batch.column(5)[i].as_py()
                )
                out.write(packer.compress(raw))
                count, size = count + 1, size + len(raw)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return records.select(
        "page_id", "uri", "record_type", "refers_to", "payload_digest", "payload"
    ).mapInArrow(write, _MANIFEST)


class Inflated:
    """The records of a gzip stream, inflated once and in pieces."""

    def __init__(self, read: Callable[[int], bytes]) -> None:
        self._read, self._unpacker = read, zlib.decompressobj(_GZIP)
        self._held, self._ended = bytearray(), False

    def _more(self) -> bool:
        while True:
            raw = self._unpacker.unused_data or self._read(_CHUNK)
            if not raw:
                self._ended = True
                return False
            if self._unpacker.eof:
                self._unpacker = zlib.decompressobj(_GZIP)
            piece = self._unpacker.decompress(raw)
            if piece:
                self._held += piece
                return True

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """(headers, whole record) one after the other."""
        while True:
            seen = 0
            while (at := self._held.find(_END, seen)) < 0:
                seen = max(0, len(self._held) - 3)
                if not self._more():
                    if self._held:
                        raise ValueError("an archive ends within a record")
                    return
            headers = _headers(bytes(self._held[:at]))
            whole = at + 2 * len(_END) + int(headers["content-length"])
            while len(self._held) < whole:
                if not self._more():
                    raise ValueError("an archive ends within a record")
            yield headers, bytes(self._held[:whole])
            del self._held[:whole]


def normalise(manifest: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite every record of the archives as a gzip member of its own.

    Each archive is inflated once, as a stream. Gives the index (archive,
    record_id, offset, length, raw_bytes), one row for each record; the new
    archives have names of their own, as in ``write_monolithic``.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(source)
        out_fs, out_base = _open(target)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                name, rows, offset = f"{uuid.uuid4().hex}.warc.gz", [], 0
                with (
                    fs.open_input_stream(f"{base}/{archive}", compression=None) as stream,
                    out_fs.open_output_stream(
                        f"{out_base}/{name}", compression=None
                    ) as out,
                ):
                    for headers, raw in Inflated(stream.read):
                        packer = zlib.compressobj(wbits=_GZIP)
                        member = packer.compress(raw) + packer.flush()
                        out.write(member)
                        rows.append(
                            {
                                "archive": name,
                                "record_id": headers["warc-record-id"],
                                "offset": offset,
                                "length": len(member),
                                "raw_bytes": len(raw),
                            }
                        )
                        offset += len(member)
                if rows:
                    yield pa.RecordBatch.from_pylist(rows)

    return manifest.select("archive").mapInArrow(rewrite, _INDEX)


def parse_record(raw: bytes) -> dict[str, object]:
    """The fields of one record; a revisit's payload is null."""
    head, _, block = raw.partition(_END)
    headers = _headers(head)
    http, _, payload = block[: int(headers["content-length"])].partition(_END)
    kind = headers["warc-type"]
    repeated = kind == "revisit"
    return {
        "page_id": _page(headers["warc-record-id"]),
        "uri": headers["warc-target-uri"],
        "record_type": kind,
        "refers_to": _page(headers.get("warc-refers-to")),
        "payload_bytes": int(_headers(http)["content-length"])
        if repeated
        else len(payload),
        "payload_digest": headers["warc-payload-digest"].removeprefix("sha256:")
        if repeated
        else hashlib.sha256(payload).hexdigest(),
        "payload": None if repeated else payload,
    }


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The records that an index names, each read at its own offset.

    A response's digest and length are taken from its payload as read, a
    revisit's from its headers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        schema = pa.schema(
            [
                ("page_id", pa.int64()),
                ("uri", pa.string()),
                ("record_type", pa.string()),
                ("refers_to", pa.int64()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("payload", pa.binary()),
            ]
        )
        name = file = None
        for batch in batches:
            rows, held = [], 0
            for archive, offset, length in zip(
                *[c.to_pylist() for c in batch.columns]
            ):
                if archive != name:
                    if file is not None:
                        file.close()
                    name, file = archive, fs.open_input_file(f"{base}/{archive}")
                member = file.read_at(length, offset)
                rows.append(parse_record(zlib.decompress(member, _GZIP)))
                held += rows[-1]["payload_bytes"]
                if held >= 8 * _CHUNK:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
        if file is not None:
            file.close()

    return index.select("archive", "offset", "length").mapInArrow(read, _RECORDS)


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages through archives and back: one row for every row of ``pages``.

    (page_id, payload_bytes, payload_digest, record_type, refers_to). A null
    html is an empty payload, a null url an empty address; other columns are
    not archived. Rows that repeat the smallest id of their payload are
    responses as well. A page without an id revisits the smallest id of its
    payload and is never referred to. The archives stay in the scratch folder
    until Spark ends.
    """
    records = with_revisits(pages, F.col("page_id"), F.col("url"), F.col("html"))
    whole = scratch_dir(spark, "warc-whole")
    single = scratch_dir(spark, "warc-records")
    manifest = keep(spark, write_monolithic(records, whole), "manifest")
    # An archive is a task's whole work, so archives are dealt out evenly.
    dealt = manifest.repartition(manifest.count() or 1)
    index = keep(spark, normalise(dealt, whole, single), "index")
    return read_archives(index, single).drop("uri", "payload")
