"""Token ids in files of directly addressable codes.

Ids are split into 8-bit chunks. Level 0 holds the lowest chunk of every id and a
bitmap that says which ids go on; level 1 holds the next chunk of those, and so
on. A rank directory counts the set bits before every 512th, so the place of an
id in the next level, and with it any id, is found without decoding its
neighbours.

Documents are range-partitioned by doc_id. Each task writes files of at most
FILE_IDS ids (a longer document is a file of its own) under names of its own attempt;
the manifest, written by Spark, names the files of the attempts that counted.

Edge cases: a null or empty text has only the end id; null ids sort first; rows
that share a doc_id are all written, ordered by their texts; no rows give no
file; other columns are not read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.tables import written
from keepwell.llm.textblocks import WIDE_SPACE, Lookup, column_bytes, slices
from keepwell.session import scratch_folder

MAGIC = b"KWDAC01\n"
RANK_STEP = 512
FILE_IDS = 2_000_000
BLOCK = 2 << 20
REMEMBERED = 1_000_000
END = 0
MANIFEST = "part int, seq int, path string, docs long, ids long"
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _packed(goes_on: np.ndarray) -> tuple[bytes, bytes]:
    """Bitmap, padded to whole rank steps, and its rank directory."""
    step = RANK_STEP // 8
    bits = np.packbits(goes_on, bitorder="little")
    bits = np.pad(bits, (0, -len(bits) % step))
    counts = _ONES[bits].reshape(-1, step).sum(axis=1, dtype=np.int64)
    return bits.tobytes(), (np.cumsum(counts) - counts).astype("<u8").tobytes()


def packed(doc_ids: list[int | None], bounds: np.ndarray, ids: np.ndarray) -> bytes:
    """A file: header, documents (id, known, start) and the levels."""
    n = len(doc_ids)
    levels, rest = [], ids.astype(np.uint32)
    while True:
        goes_on = rest > 255
        bits, ranks = _packed(goes_on)
        levels.append(struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes() + bits + ranks)
        rest = rest[goes_on] >> 8
        if not len(rest):
            break
    known = np.array([d is not None for d in doc_ids], np.uint8)
    head = MAGIC + struct.pack("<QQI", n, len(ids), len(levels))
    table = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + known.tobytes() + np.asarray(bounds, "<u8").tobytes()
    return head + table + struct.pack(f"<{len(levels)}Q", *(len(x) for x in levels)) + b"".join(levels)


class Reader:
    """Random access to the ids of a file."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        n, self.size, depth = struct.unpack_from("<QQI", data, 8)
        at = 28
        self._doc = np.frombuffer(data, "<i8", n, at)
        self._known = np.frombuffer(data, np.uint8, n, at + 8 * n)
        self.bounds = np.frombuffer(data, "<u8", n + 1, at + 9 * n).astype(np.int64)
        at += 17 * n + 8
        sizes = struct.unpack_from(f"<{depth}Q", data, at)
        at += 8 * depth
        if at + sum(sizes) != len(data) or self.bounds[-1] != self.size:
            raise ValueError("lengths don't add up")
        self.levels = []
        for size in sizes:
            (m,) = struct.unpack_from("<Q", data, at)
            step = -(-m // RANK_STEP)
            self.levels.append((np.frombuffer(data, np.uint8, m, at + 8), np.frombuffer(data, np.uint8, step * RANK_STEP // 8, at + 8 + m),
                                np.frombuffer(data, "<u8", step, at + 8 + m + step * RANK_STEP // 8).astype(np.int64)))
            at += size

    def doc_ids(self) -> list[int | None]:
        return [d if k else None for d, k in zip(self._doc.tolist(), self._known.tolist())]

    def _rank(self, level: int, at: int) -> int:
        """Set bits of a level before a place."""
        _, bits, ranks = self.levels[level]
        block = at // RANK_STEP
        whole = int(_ONES[bits[block * RANK_STEP // 8 : at // 8]].sum())
        tail = int(_ONES[bits[at // 8] & ((1 << at % 8) - 1)]) if at % 8 else 0
        return int(ranks[block]) + whole + tail

    def id(self, at: int) -> int:
        """One id, from one chunk a level."""
        if not 0 <= at < self.size:
            raise IndexError(at)
        out = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            out |= int(chunks[at]) << (8 * level)
            if not bits[at // 8] >> (at % 8) & 1:
                break
            at = self._rank(level, at)
        return out

    def span(self, a: int, b: int) -> np.ndarray:
        """Ids a..b-1; one rank a level finds where the span goes on."""
        out, where, shift = np.zeros(b - a, np.uint32), np.arange(b - a), 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            if a >= b:
                break
            out[where] |= chunks[a:b].astype(np.uint32) << np.uint32(shift)
            on = np.unpackbits(bits[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)
            a = self._rank(level, a) if on.any() else 0
            where = where[on]
            b, shift = a + len(where), shift + 8
        return out


class LibraryEncoder:
    """Blocks of texts to ids by the tokenizers library, which gets every different unit once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [t for t in added if t]
        self.lookup = Lookup(lambda units: self._whole([u.decode() for u in units]), REMEMBERED)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of texts, one behind the other."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in ids], np.int64)
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, offsets = column_bytes(column)
        data = raw.tobytes()
        plain = not WIDE_SPACE.search(data) and not any(t in data for t in self.added)
        found = self.lookup.ids(raw, offsets) if plain else None
        if found is None:
            ids, sizes = self._whole([t or "" for t in column.to_pylist()])
            return ids, np.r_[0, np.cumsum(sizes)]
        return found


@lru_cache(maxsize=2)
def encoder_of(path: str) -> LibraryEncoder:
    """One encoder a worker process; what it remembers serves later tasks."""
    return LibraryEncoder(path)


def _with_end(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put the end id behind every document."""
    n = len(offsets) - 1
    return np.insert(ids, offsets[1:], END), offsets + np.arange(n + 1)


def _write(path: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part, seq = TaskContext.get().partitionId(), 0
        docs, parts, sizes, total = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, parts, sizes, total, seq
            name = f"{root}/ids-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.dac"
            with store.open_output_stream(name) as f:
                f.write(packed(docs, np.r_[0, np.cumsum(sizes)], np.concatenate(parts)))
            row = pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "path": name, "docs": len(docs), "ids": total}],
                                             schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))
            docs, parts, sizes, total, seq = [], [], [], 0, seq + 1
            return row

        for whole in batches:
            for batch in slices(whole, "text", BLOCK):
                ids, bounds = _with_end(*encoder.encode(batch.column("text")))
                for k, d in enumerate(batch.column("doc_id").to_pylist()):
                    size = int(bounds[k + 1] - bounds[k])
                    if docs and total + size > FILE_IDS:
                        yield flush()
                    docs.append(d)
                    parts.append(ids[bounds[k] : bounds[k + 1]])
                    sizes.append(size)
                    total += size
        if docs:
            yield flush()
    return run


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["path"]) as f:
                    r = Reader(f.read())
                b = r.bounds
                if len(b) - 1 != row["docs"] or r.size != row["ids"]:
                    raise ValueError(f"{row['path']} isn't what the manifest says")
                crc = [zlib.crc32(r.span(int(x), int(y)).astype("<u4").tobytes()) for x, y in zip(b[:-1], b[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r.doc_ids(), pa.int64()), pa.array(row["base"] + b[:-1]), pa.array(np.diff(b)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def write_ids(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Write the ids of all texts in order of doc_id; the manifest: path, docs, ids, base (ids of all files before)."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
               .repartitionByRange(partitions, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text"))
    manifest = written(ordered.select("doc_id", "text").mapInArrow(_write(tokenizer, folder), MANIFEST), "manifest")
    # one row a shuffle partition
    before, bases = 0, []
    for r in manifest.groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").collect():
        bases.append((r["part"], before))
        before += r["ids"]
    base = spark.createDataFrame(bases, "part int, part_base long")
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (manifest.withColumn("inside", F.coalesce(F.sum("ids").over(inside), F.lit(0))).join(F.broadcast(base), "part")
            .select("path", "docs", "ids", (F.col("part_base") + F.col("inside")).alias("base")))


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    partitions = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(partitions, "path").mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def through_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids of the documents and read them back."""
    folder = scratch_folder(docs.sparkSession, "token-ids")
    return read_ids(written(write_ids(docs, tokenizer, folder), "files"), folder)
