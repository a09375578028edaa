"""WARC archives in Zstandard: a dictionary in the leading skippable frame, one frame per record.

Writing: payloads are hashed; of equal payloads (of ``least`` bytes or more) the
one with the smallest page_id is a response, the others are revisits that refer to it. Each
task writes archives of about ARCHIVE_BYTES under names of its own attempt; the
manifest, written by Spark, names those that counted.

Reading: the dictionary is taken from the archive itself, every frame is decoded
alone, and versions, headers, lengths and digests are validated. A faulty
archive raises ValueError.

Edge cases: a null html is an empty payload; a null url is written as
``about:blank``; rows with a null page_id are responses unless another page has
their payload; equal rows are all written; no rows give no archive; other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.tables import written
from keepwell.session import scratch_folder

#: Fixed values of the format: magic of the dictionary's frame, of a dictionary and of a data frame.
SKIPPABLE, DICTIONARY, FRAME = 0x184D2A5D, 0xEC30A437, 0xFD2FB528
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = {"warc-type", "warc-record-id", "warc-date", "content-length"}
ARCHIVE_BYTES = 8 << 20
#: The dictionary is trained on at most so many pages and made at most so large.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 8000, 32 << 10
PIECE = 64 << 10
DATE = "1970-01-01T00:00:00Z"
PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64())])


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, response: bool) -> bytes:
    """A response with its payload, or a revisit that carries the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "response" if response else "revisit"),
               ("WARC-Record-ID", f"<urn:page:{'unknown' if page_id is None else page_id}>"), ("WARC-Date", DATE),
               ("WARC-Target-URI", quote(url or "about:blank", safe=":/?#[]@!$&'()*+,;=%-._~")),
               ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if not response:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{first}>")]
    return _record(headers, http + payload if response else http)


def frames(data, dictionary: zstandard.ZstdCompressionDict | None) -> Iterator[bytes]:
    """Contents of the frames of a stream, one at a time."""
    engine = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    rest = b""
    while True:
        rest = rest or data.read(PIECE)
        if not rest:
            return
        one, out = engine.decompressobj(), []
        while True:
            out.append(one.decompress(rest))
            if one.eof:
                rest = one.unused_data
                break
            rest = data.read(PIECE)
            if not rest:
                raise ValueError("the last frame is cut off")
        yield b"".join(out)


def _leading_dictionary(data) -> zstandard.ZstdCompressionDict | None:
    head = data.read(8)
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", head[4:])[0]
        content = data.read(size)
        if len(content) != size:
            raise ValueError("the dictionary is cut off")
        if content[:4] == struct.pack("<I", FRAME):  # the dictionary itself may be compressed
            content = b"".join(frames(io.BytesIO(content), None))
        if content[:4] != struct.pack("<I", DICTIONARY):
            raise ValueError("the leading frame holds no dictionary")
        return zstandard.ZstdCompressionDict(content)
    data.seek(0)
    return None


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record, validated."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        raise ValueError("not a record")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip() or name != name.strip():
            raise ValueError(f"not a header: {line[:80]}")
        headers[name.lower()] = value.strip()
    if lacking := NEEDED - headers.keys():
        raise ValueError(f"headers are lacking: {sorted(lacking)}")
    size = headers["content-length"]
    if not size.isdigit() or len(rest) != int(size) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"length {size} doesn't fit a block of {len(rest) - 4} bytes")
    return headers, rest[:-4]


def records(data) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an archive: dictionary first, then one frame each."""
    for content in frames(data, _leading_dictionary(data)):
        yield parsed(content)


def _page_of(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "unknown" else int(value)


def page_of(headers: dict[str, str], block: bytes) -> dict:
    """What a record says about its page; the digest of a payload that is there is checked."""
    http, mark, payload = block.partition(b"\r\n\r\n")
    sizes = [x.split(b":", 1)[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    kind = headers["warc-type"]
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if not mark or len(sizes) != 1 or kind not in ("response", "revisit"):
        raise ValueError("not a page's record")
    if kind == "response" and (len(payload) != int(sizes[0]) or base32_sha1(payload) != digest):
        raise ValueError("the payload isn't what its headers say")
    return {"page_id": _page_of(headers["warc-record-id"]), "payload_bytes": int(sizes[0]), "payload_digest": digest, "record_type": kind,
            "refers_to": _page_of(headers["warc-refers-to"]) if kind == "revisit" else None}


def dictionary(pages: DataFrame) -> bytes:
    """A dictionary trained on a bounded sample; empty if there is too little to learn from."""
    rows = pages.select(F.substring("html", 1, SAMPLE_CHARS).alias("h")).where("h is not null and h != ''").limit(SAMPLE_PAGES).collect()
    samples = [r["h"].encode() for r in rows]
    if len(samples) < 50:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 10), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _write(folder: str, trained: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        kept = zstandard.ZstdCompressionDict(trained) if trained else None
        engine = zstandard.ZstdCompressor(level=6, dict_data=kept, write_content_size=True)
        out, name, size, count = None, "", 0, 0

        def close() -> pa.RecordBatch:
            nonlocal out
            out.close()
            out = None
            return pa.RecordBatch.from_pydict({"path": [name], "records": [count]}, schema=pa.schema([("path", pa.string()), ("records", pa.int64())]))

        for batch in batches:
            for k in range(batch.num_rows):
                page, url, html, digest, first = (batch.column(c)[k].as_py() for c in ("page_id", "url", "html", "digest", "first"))
                if out is None:
                    name, size, count = f"{root}/pages-{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = store.open_output_stream(name, compression=None)  # the records are compressed here
                    if trained:
                        out.write(struct.pack("<II", SKIPPABLE, len(trained)) + trained)
                frame = engine.compress(page_record(page, url, (html or "").encode(), digest, first, first is None or page == first))
                out.write(frame)
                size, count = size + len(frame), count + 1
                if size >= ARCHIVE_BYTES:
                    yield close()
        if out is not None:
            yield close()
    return run


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                rows, count = [], 0
                with store.open_input_file(row["path"]) as f:
                    for headers, block in records(f):
                        rows.append(page_of(headers, block))
                        count += 1
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
                            rows = []
                if count != row["records"]:
                    raise ValueError(f"{row['path']}: {count} records of {row['records']}")
                yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digest = [base32_sha1(x or b"") for x in batch.column("html").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digest, pa.string())], names=[*batch.schema.names, "digest"])


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write a record per page; the manifest (path, records)."""
    p = pages.select("page_id", "url", "html")
    trained = dictionary(p)
    p = p.mapInArrow(_digested, "page_id long, url string, html string, digest string")
    size = F.octet_length(F.coalesce("html", F.lit("")))
    firsts = written(p.where(size >= least).select("page_id", "digest").groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "first-payloads")
    # a page's own record is named by the join; pages whose payload stands alone have no partner
    marked = p.join(firsts, "digest", "left").withColumn("first", F.when(size >= least, F.col("first")))
    return written(marked.select("page_id", "url", "html", "digest", "first").mapInArrow(_write(folder, trained), "path string, records long"), "archives")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives of a manifest."""
    partitions = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(partitions, "path").mapInArrow(_read(folder), PAGES)


def through_archives(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the pages to archives and read them back."""
    folder = scratch_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, least), folder)
