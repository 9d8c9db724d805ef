"""WARC archives in Zstandard with a shared dictionary.

An archive starts with a skippable frame that holds the dictionary; then comes one frame
for each record, so a reader can stop, skip or resume at any record. The writer's tasks
write archives of bounded size to a shared folder, under names of their own, and return a
manifest; what a lost or repeated task leaves behind is in no manifest and never read. The
reader's tasks take archives from the manifest, load the dictionary from the leading
frame, decode frame by frame, and check versions, headers, lengths and digests.

Records with equal payloads of at least REVISIT_BYTES become revisits of the one with the
least page id. The digests are grouped with partial aggregation; only digests that repeat
are joined back, and a join that is skewed by one digest can be split.

Defined results: null html = empty payload; a null page id is kept, and is never the least
of a group that has ids; rows that repeat the least page id with equal payloads are all
responses; control characters in a url are percent-encoded in the archive and decoded
again; a null url stays null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh_path, in_small_batches, payload, written

REVISIT_BYTES = 100
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
#: Dictionary size, and the bounded sample of pages that it is trained on.
DICTIONARY_BYTES = 65_536
SAMPLE_PAGES = 400
SAMPLE_CHARS = 16_384
#: An archive is closed once it is so large.
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
CHUNK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1.1\r\n"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
PAGE = "urn:x-page:"


def record(kind: str, name: str, fields: dict[str, str], block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{name}>", "WARC-Date": DATE, **fields, "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, body: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record, whose block has no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    fields = {"WARC-Payload-Digest": "sha256:" + hashlib.sha256(body).hexdigest()}
    if url is not None:
        fields["WARC-Target-URI"] = quote(url, safe="!#$&'()*+,/:;=?@[]~")
    name = PAGE + ("" if page_id is None else str(page_id))
    fields["Content-Type"] = "application/http; msgtype=response"
    if refers_to is None:
        return record("response", name, fields, http + body)
    fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{PAGE}{refers_to}>"}
    return record("revisit", name, fields, http)


def parse_headers(data: bytes, what: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in data.decode().split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"{what}: bad header line {line!r}")
        out[name.strip()] = value.strip()
    return out


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record, checked."""
    if not data.startswith(VERSION):
        raise ValueError(f"not a WARC record: {data[:20]!r}")
    head, blank, rest = data[len(VERSION) :].partition(b"\r\n\r\n")
    if not blank:
        raise ValueError("a record without end of headers")
    headers = parse_headers(head, "record")
    for name in NEEDED:
        if name not in headers:
            raise ValueError(f"a record without {name}")
    size = int(headers["Content-Length"])
    if size < 0 or len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{headers['WARC-Record-ID']}: Content-Length is {size}, the block has {len(rest) - 4}")
    return headers, rest[:size]


def page_of(name: str) -> int | None:
    text = name.strip("<>").removeprefix(PAGE)
    return int(text) if text else None


def parse_page(headers: dict[str, str], block: bytes) -> tuple:
    """(page_id, url, record_type, refers_to, payload_bytes, digest, payload) of a page record."""
    kind, name = headers["WARC-Type"], headers["WARC-Record-ID"]
    http, blank, body = block.partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not blank or not status.startswith(b"HTTP/"):
        raise ValueError(f"{name}: the block is not an HTTP response")
    size = int(parse_headers(lines, name)["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    refers_to = page_of(headers["WARC-Refers-To"]) if kind == "revisit" else None
    if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
        raise ValueError(f"{name}: the payload does not match its length and digest")
    if kind == "revisit" and body:
        raise ValueError(f"{name}: a revisit with a payload")
    url = headers.get("WARC-Target-URI")
    return page_of(name), None if url is None else unquote(url), kind, refers_to, size, digest, body


def train_dictionary(pages: DataFrame, html_col: str) -> bytes:
    """A dictionary trained on a bounded sample of pages (SAMPLE_PAGES by hash)."""
    import zstandard

    data = F.substring(F.col(f"`{html_col}`"), 1, SAMPLE_CHARS)
    sample = pages.select(data.alias("t")).where("length(t) > 0").withColumn("h", F.xxhash64("t"))
    # The least hashes first and their texts then: every task sends its own least ones.
    least = [r.h for r in sample.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).collect()]
    if not least:
        return b""
    texts = sorted(r.t.encode() for r in sample.where(F.col("h") <= max(least)).dropDuplicates(["h"]).collect())
    size = min(DICTIONARY_BYTES, sum(map(len, texts)) // 8)
    if len(texts) < 16 or size < 1024:
        return b""
    return zstandard.train_dictionary(size, texts).as_bytes()


def open_folder(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def references(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(page_id, url, _bytes, refers_to): whom a page's record refers to."""
    source = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        payload(html_col),
    ).withColumn("_digest", F.when(F.octet_length("_bytes") >= REVISIT_BYTES, F.sha2("_bytes", 256)))
    groups = source.where("_digest IS NOT NULL").groupBy("_digest")
    first = groups.agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return source.join(first, "_digest", "left").select("page_id", "url", "_bytes", refers_to.alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Write a record for each page into archives below ``folder`` (a URI that all executors
    can write to); returns the manifest: path, records, bytes."""
    import zstandard

    trained = pages.sparkSession.sparkContext.broadcast(train_dictionary(pages, html_col))
    system, base = open_folder(folder)
    system.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        dictionary = trained.value
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        path, sink, records = "", None, 0

        def closed() -> pa.RecordBatch:
            size = sink.tell()
            sink.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

        for rows in batches:
            columns = (rows.column(c).to_pylist() for c in ("page_id", "url", "_bytes", "refers_to"))
            for page_id, url, body, refers_to in zip(*columns, strict=True):
                if sink is None:
                    path, records = f"{root}/pages-{uuid.uuid4().hex}.warc.zst", 0
                    sink = files.open_output_stream(path, compression=None)
                    sink.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                    info = b"format: WARC File Format 1.1\r\n"
                    fields = {"Content-Type": "application/warc-fields"}
                    sink.write(press.compress(record("warcinfo", f"urn:uuid:{uuid.uuid4()}", fields, info)))
                sink.write(press.compress(page_record(page_id, url, body, refers_to)))
                records += 1
                if sink.tell() >= ARCHIVE_BYTES:
                    yield closed()
                    sink = None
        if sink is not None:
            yield closed()

    rows = references(pages, id_col, url_col, html_col)
    return written(in_small_batches(rows).mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def frames(stream: io.RawIOBase) -> Iterator[bytes]:
    """The decoded frames of an archive after its dictionary."""
    import zstandard

    head = stream.read(8)
    if len(head) != 8:
        raise ValueError("the archive ends in its first frame")
    magic, size = struct.unpack("<II", head)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not start with a dictionary frame")
    dictionary = stream.read(size)
    if len(dictionary) != size:
        raise ValueError("the archive ends in its dictionary")
    if dictionary.startswith(ZSTD_MAGIC):
        dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
    decode = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    data = stream.read(CHUNK)
    while data:
        frame, parts = decode.decompressobj(), []
        while not frame.eof:
            if not data and not (data := stream.read(CHUNK)):
                raise ValueError("the archive ends in a record")
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else b""
        yield b"".join(parts)
        data = data or stream.read(CHUNK)


def read_records(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row for each page record of the archives: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest and, if asked for, the payload (null for revisits)."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    schema = (
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
        "payload binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = open_folder(folder)

        def batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)

        for rows in batches:
            for path, expected in zip(rows.column("path").to_pylist(), rows.column("records").to_pylist(), strict=True):
                out, seen = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for data in frames(stream):
                        headers, block = parse_record(data)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        *fields, body = parse_page(headers, block)
                        out.append((*fields, body if payloads and fields[2] == "response" else None))
                        seen += 1
                        if len(out) == 256:
                            yield batch(out)
                            out = []
                if out:
                    yield batch(out)
                if seen != expected:
                    raise ValueError(f"{path}: {seen} records, the manifest says {expected}")

    # An archive is much work for a short row: rows are dealt evenly, one archive to a task.
    n = max(1, manifest.count())
    return manifest.repartitionByRange(n, "path").mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    folder = fresh_path(pages.sparkSession, "warc")
    read = read_records(write_archives(pages, folder), folder, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
