"""WARC archives with an index first (op8).

Every page is one record, one gzip member of its own, in archive files under the checkpoint folder.
A page whose payload equals that of a page with a smaller id becomes a revisit record that names it.
An index pass then streams over the archives and writes file, offset, length, URL and digest of every
record; reading sorts the selected index rows by place, merges neighbours into byte ranges of bounded
size, and reads only those.

The archives are written by Spark's text sink, which puts a separator after every value. A gzip
member ends with the high byte of its length modulo 2^32, which is zero for records under 16 MB, so
the value is the member less that byte and the separator is the zero byte: the files are plain
concatenations of members. (A larger record is followed by an empty member, which ends so too.)

Defined results: a null html is the empty payload, a null url the empty URL. Repeated rows with the
smallest id are all responses; among equal payloads a null id is a revisit of the smallest id, or a
response if no row has an id. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.batches import map_arrow, map_texts
from tagloom.session import cut_lineage, scratch_table_path

MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 50_000
READ_BYTES = 4 << 20  # longest merged byte range (one longer record is a range of its own)
READ_GAP = 64 << 10  # unwanted bytes that are cheaper to read than to skip
BLOCK = 1 << 20

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:x-page:").rstrip(">")
    return int(number) if number else None


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit of page ``refers_to`` if that is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    # line ends inside a URL would end the header
    url = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in url or "\n" in url else url
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
            "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    """A gzip member that ends with a zero byte, less that byte."""
    packed = gzip.compress(raw, 6, mtime=0)
    return (packed if not packed[-1] else packed + gzip.compress(b"", mtime=0))[:-1]


def headers(raw: bytes) -> tuple[dict[str, str], int]:
    """Header fields (lower-case names) at the start of a record or HTTP block, and where they end."""
    end = raw.index(b"\r\n\r\n")
    fields = (line.partition(": ") for line in raw[:end].decode().split("\r\n")[1:])
    return {k.lower(): v for k, _, v in fields}, end + 4


def first_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """sha, size and smallest page id of every payload that several rows share."""
    return (pages.groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
            .where((F.col("n") > 1) & (F.col("size") >= min_bytes) & F.col("first").isNotNull()).select("sha", "size", "first"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write all pages(page_id, url, html) as records of gzipped WARC files under ``path``."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        html.alias("html"), F.sha1(html.cast("binary")).alias("sha"), F.octet_length(html).alias("size"))
    first = cut_lineage(first_pages(rows.select("page_id", "sha", "size"), min_bytes), "first_pages")
    marked = rows.join(first, ["sha", "size"], "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        columns = (piece.column("page_id").to_pylist(), piece.column("url").to_pylist(),
                   piece.column("html").cast(pa.binary()).to_pylist(), piece.column("refers_to").to_pylist())
        return pa.RecordBatch.from_arrays([pa.array([member(record(*r)) for r in zip(*columns)], pa.binary())], names=["value"])

    # a binary cast to a string keeps its bytes, and the text sink writes them as they are
    (map_texts(marked, fn, "value binary", text="html").select(F.col("value").cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", "\0").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def _open(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def scan(file) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, head) of every record of an archive, reading it once in blocks.

    ``head`` holds the decompressed start of the record up to the end of its headers.
    """
    at = start = 0  # of the next byte to read, and of the record
    data, head, size, need, inflate = b"", b"", 0, None, None
    while True:
        if not data:
            data = file.read(BLOCK)
            at += len(data)
            if not data:
                return
        if inflate is None:
            inflate = zlib.decompressobj(31)
        out = inflate.decompress(data, BLOCK)
        size += len(out)
        if need is None:
            head += out
            if b"\r\n\r\n" in head:
                fields, end = headers(head)
                need, head = end + int(fields["content-length"]) + 4, head[:end]
        if inflate.eof:
            data = inflate.unused_data
            inflate = None
            # a record over 16 MB has an empty member behind it
            if need is not None and size >= need:
                if need < 1 << 24:
                    yield start, at - len(data) - start, head
                    start, head, size, need = at - len(data), b"", 0, None
                elif need == size:
                    size += 1  # the empty member is still to come
                else:
                    yield start, at - len(data) - start, head
                    start, head, size, need = at - len(data), b"", 0, None
        else:
            data = inflate.unconsumed_tail


def index(spark, path: str) -> DataFrame:
    """file, offset, length, page_id, url, digest and record_type of every record under ``path``."""

    def run(batches):
        for batch in batches:
            for name in batch.column("path").to_pylist():
                rows = []
                with _open(name) as file:
                    for offset, length, head in scan(file):
                        h, _ = headers(head)
                        rows.append((name, offset, length, _page(h["warc-record-id"]), h["warc-target-uri"],
                                     h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"]))
                        if len(rows) == 10_000:
                            yield batch_of(rows)
                            rows = []
                yield batch_of(rows)

    names = ["file", "offset", "length", "page_id", "url", "digest", "record_type"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path")
    return cut_lineage(map_arrow(files, run, "file string, offset long, length long, page_id long, url string, "
                                             "digest string, record_type string"), "warc-index")


def ranges(places: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Sorted (offset, length) places in lots that are read together."""
    lot: list[tuple[int, int]] = []
    for offset, length in places:
        if lot and (offset - sum(lot[-1]) > READ_GAP or offset + length - lot[0][0] > READ_BYTES):
            yield lot
            lot = []
        lot.append((offset, length))
    if lot:
        yield lot


def unpack(raw: bytes) -> dict:
    """page_id, record type, payload, its size and digest, and the page referred to, of a compressed record."""
    raw = gzip.decompress(raw)
    h, end = headers(raw)
    block = raw[end : end + int(h["content-length"])]
    http, start = headers(block)
    out = {"page_id": _page(h["warc-record-id"]), "record_type": h["warc-type"], "url": h["warc-target-uri"]}
    if h["warc-type"] == "response":
        payload = block[start:]
        return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": payload_digest(payload), "refers_to": None}
    return out | {"payload": None, "payload_bytes": int(http["content-length"]),
                  "payload_digest": h["warc-payload-digest"].removeprefix("sha1:"), "refers_to": _page(h["warc-refers-to"])}


def read_records(selected: DataFrame, payloads: bool = False) -> DataFrame:
    """The records that index rows select, read from the archives by merged byte ranges."""

    def run(batches):
        # rows come sorted by file and offset, files whole
        file, name = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            at = 0
            while at < len(rows):
                end = at
                while end < len(rows) and rows[end][0] == rows[at][0]:
                    end += 1
                if rows[at][0] != name:
                    if file:
                        file.close()
                    name, file = rows[at][0], _open(rows[at][0])
                for lot in ranges([r[1:] for r in rows[at:end]]):
                    base = lot[0][0]
                    file.seek(base)
                    raw = file.read(sum(lot[-1]) - base)
                    got = [unpack(raw[o - base : o - base + n]) for o, n in lot]
                    yield pa.RecordBatch.from_arrays([pa.array([g[n] for g in got], k) for n, k in kinds.items()], names=list(kinds))
                at = end
        if file:
            file.close()

    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(),
             "refers_to": pa.int64()} | ({"url": pa.string(), "payload": pa.binary()} if payloads else {})
    places = selected.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    return map_arrow(places, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
                             + (", url string, payload binary" if payloads else ""))


def round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write all pages, index the archives, and read every record back."""
    path = scratch_table_path(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes)
    return read_records(index(pages.sparkSession, path))
