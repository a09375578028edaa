"""Exact removal of repeated passages by super-k-mer partitioning.

A window is WINDOW consecutive words. Its minimiser is the smallest hash of the
MINIMISER-word grams in it; consecutive windows with one minimiser travel as one
packed string to the bucket of that minimiser, where equal windows meet and are
sorted by hash, compared word by word and counted. A first pass sends the minimisers alone; only
super-k-mers whose minimiser has another one then travel with their words. All but the first occurrence (smallest doc_id, then
start) are removed. Before that, each block of documents sends only the first
occurrence that it holds itself, so a passage that stands in a third of all
documents arrives once a block.

A minimiser that is frequent with many surroundings would fill one bucket. A
sample, which decides about routes only and never about results, names such
minimisers, and their windows are dealt by their own hash instead.

Edge cases: a null text has no words; rows that share a doc_id are one document
(none of them precedes another at the same start; runs keep to their own text); a null doc_id precedes every
other id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.tables import written
from keepwell.llm.textblocks import Words, column_bytes, mixed, ngram_hashes, slices

WINDOW = 20
MINIMISER = 5
#: Documents in the route sample for each shuffle partition.
SAMPLE_A_PARTITION = 16
NO_ID = -(1 << 63)

#: Bytes of packed words judged together, and of texts cut together.
HELD_BYTES = 1 << 20
BLOCK = 1 << 20
ROUTES = "route long, doc long, text_key long, first long, last long"
PACKED = "route long, doc long, text_key long, start long, n long, words binary"
RUNS = "doc long, text_key long, first long, last long"


def _minimisers(hashes: np.ndarray) -> np.ndarray:
    """Smallest gram hash of each window of the word sequence."""
    g = ngram_hashes(hashes, MINIMISER)
    width, have = WINDOW - MINIMISER + 1, 1
    while have < width:
        step = min(have, width - have)
        g = np.minimum(g[:-step], g[step:])
        have += step
    return g


def _windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, text, hash) of all windows of a block."""
    counts = np.maximum(np.diff(words.bounds) - (WINDOW - 1), 0)
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + words.bounds[:-1][text]
    return first, text, ngram_hashes(words.hashes, WINDOW)[first] if len(first) else np.zeros(0, np.uint64)


def _earlier(doc: np.ndarray, start: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each window, the index of the first window with its hash by (doc, start)."""
    order = np.argsort(hashes)
    h = hashes[order]
    same = h[1:] == h[:-1]
    at = order[np.r_[False, same] | np.r_[same, False]] if len(h) else order
    at = at[np.lexsort((start[at], doc[at], hashes[at]))]
    out = np.arange(len(h))
    if len(at):
        new = np.r_[True, hashes[at][1:] != hashes[at][:-1]]
        out[at] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
    return out


def _repeated(words: Words, doc: np.ndarray, start: np.ndarray, first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which windows occur earlier in the block, each confirmed by its words."""
    source = _earlier(doc, start, hashes)
    later = (doc != doc[source]) | (start != start[source])
    at = np.flatnonzero(later)
    # neighbours whose sources are neighbours too are compared as one stretch
    a, b = first[at], first[source[at]]
    lo, hi = _stretches(_breaks((np.diff(a) != 1) | (np.diff(b) != 1) | (np.diff(start[at]) != 1) | (np.diff(start[source[at]]) != 1), len(at)))
    met = {h for i, j, x, y in zip(lo.tolist(), hi.tolist(), words.texts(a[lo], a[hi] + WINDOW - 1), words.texts(b[lo], b[hi] + WINDOW - 1))
           if x != y for h in hashes[at[i : j + 1]].tolist()}
    for h in met:  # different windows may share this hash: tell them by their words
        seen: dict[bytes, tuple[int, int]] = {}
        own = np.flatnonzero(hashes == np.uint64(h))
        for k in own[np.lexsort((start[own], doc[own]))].tolist():
            place = (int(doc[k]), int(start[k]))
            later[k] = seen.setdefault(words.text(first[k], first[k] + WINDOW), place) != place
    return later


def _breaks(between: np.ndarray, n: int) -> np.ndarray:
    """True where a stretch begins: at the first of n elements and behind each break."""
    return np.r_[True, between] if n else np.zeros(0, bool)


def _stretches(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) index of the stretches that begin where ``breaks`` is true."""
    at = np.flatnonzero(breaks)
    return at, (np.r_[at[1:], len(breaks)] - 1)[: len(at)]


def _runs(doc: np.ndarray, key: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """Removed windows as runs of words (doc, text key, first, last), inclusive."""
    order = np.lexsort((start, key, doc))
    doc, key, start = doc[order], key[order], start[order]
    lo, hi = _stretches(_breaks((doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (start[1:] - start[:-1] > 1), len(doc)))
    return [doc[lo], key[lo], start[lo], start[hi] + WINDOW - 1]


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False) for c in ("doc_id", "text_key"))


def _block(batch: pa.RecordBatch) -> tuple:
    words = Words(*column_bytes(batch.column("text")))
    first, text, hashes = _windows(words)
    return words, first, text, hashes, _minimisers(words.hashes)[first] if len(first) else hashes


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(minimiser, windows) of the route sample."""
    for whole in batches:
        for batch in slices(whole, "text"):
            low, n = np.unique(_block(batch)[4], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(low.astype(np.int64)), pa.array(n.astype(np.int64))], names=["low", "n"])


class _Block:
    """Super-k-mers of a block of texts, and the windows that occur earlier in the block itself."""

    def __init__(self, batch: pa.RecordBatch, hot: np.ndarray):
        self.words, first, text, hashes, low = _block(batch)
        ids, keys = _ids(batch)
        doc, key, start = ids[text], keys[text], first - self.words.bounds[:-1][text]
        gone = _repeated(self.words, doc, start, first, hashes)
        self.runs = _runs(doc[gone], key[gone], start[gone])
        doc, key, start, first, text, hashes, low = (x[~gone] for x in (doc, key, start, first, text, hashes, low))
        rare = ~np.isin(low, hot)
        lo, hi = _stretches(_breaks((np.diff(first) != 1) | (np.diff(start) != 1) | (low[1:] != low[:-1]) | ~rare[1:], len(first)))
        self.route = np.where(rare[lo], low[lo], hashes[lo])
        self.doc, self.key, self.start, self.text, self.first = doc[lo], key[lo], start[lo], text[lo], first[lo]
        self.last = first[hi] + WINDOW - 1


def _routes(hot: np.ndarray):
    """(route, doc, text key) of every super-k-mer; runs already known to repeat ride along with first and last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BLOCK):
                b = _Block(batch, hot)
                n, m = len(b.route), len(b.runs[0])
                none = np.r_[np.ones(n, bool), np.zeros(m, bool)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[b.route.astype(np.int64), b.runs[0] ^ b.runs[2]]), pa.array(np.r_[b.doc, b.runs[0]]), pa.array(np.r_[b.key, b.runs[1]]),
                     pa.array(np.r_[b.start, b.runs[2]], mask=none), pa.array(np.r_[b.start, b.runs[3]], mask=none)],
                    names=["route", "doc", "text_key", "first", "last"])
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by route, those whose route has another row, and all runs."""
    before, left = None, None
    for batch in batches:
        rows = batch if left is None else pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
        if not rows.num_rows:
            continue
        route = rows.column("route").to_numpy()
        same = route[1:] == route[:-1]
        keep = np.r_[same, False] | np.r_[route[0] == before, same]
        keep |= rows.column("first").is_valid().to_numpy(zero_copy_only=False)
        # whether the last row has a partner shows with the next batch
        before = route[-2] if len(route) > 1 else before
        yield rows.slice(0, rows.num_rows - 1).filter(pa.array(keep[:-1]))
        left = rows.slice(rows.num_rows - 1)
    if left is not None:
        keep = left.column("route")[0].as_py() == before or left.column("first")[0].is_valid
        yield left.filter(pa.array([bool(keep)]))


def _pack(hot: np.ndarray):
    """Documents with their shared routes to packed strings; runs ride along with null words."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BLOCK):
                b = _Block(batch, hot)
                routes = batch.column("routes")
                row = np.repeat(np.arange(batch.num_rows), routes.value_lengths().to_numpy())
                pair = lambda text, route: mixed(route ^ mixed(text.astype(np.uint64) + np.uint64(1)))
                wanted = np.isin(pair(b.text, b.route), pair(row, routes.flatten().to_numpy().astype(np.uint64)))
                r, n = b.runs, len(b.runs[0])
                columns = [np.r_[b.route[wanted].astype(np.int64), r[0] ^ r[2]], np.r_[b.doc[wanted], r[0]], np.r_[b.key[wanted], r[1]],
                           np.r_[b.start[wanted], r[2]], np.r_[b.last[wanted] - b.first[wanted], r[3]]]
                packed = b.words.texts(b.first[wanted], b.last[wanted]) + [None] * n
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(packed, pa.binary())],
                                                 names=["route", "doc", "text_key", "start", "n", "words"])
    return pack


def _judged(rows: pa.Table) -> pa.RecordBatch:
    """Runs of removed words from packed rows that hold whole routes."""
    known = rows.filter(rows["words"].is_null())
    out = [[known[c].to_numpy() for c in ("doc", "text_key", "start", "n")]]
    rows = rows.filter(rows["words"].is_valid())
    if rows.num_rows:
        words = Words(*column_bytes(pa.concat_arrays(rows["words"].chunks)))
        first, row, hashes = _windows(words)
        doc, key = (rows[c].to_numpy()[row] for c in ("doc", "text_key"))
        start = rows["start"].to_numpy()[row] + first - words.bounds[:-1][row]
        gone = _repeated(words, doc, start, first, hashes)
        out.append(_runs(doc[gone], key[gone], start[gone]))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out])) for k in range(4)], names=["doc", "text_key", "first", "last"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by route to runs; rows of a route are held until the next route begins."""
    held, size, enough = [], 0, HELD_BYTES
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < enough:
            continue
        rows = pa.Table.from_batches(held)
        route = rows["route"].to_numpy()
        changes = np.flatnonzero(route[1:] != route[:-1])
        if len(changes):
            cut = int(changes[-1]) + 1
            yield _judged(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks().to_batches()
            size = sum(b.nbytes for b in held)
        enough = max(HELD_BYTES, 2 * size)
    if held:
        yield _judged(pa.Table.from_batches(held))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the words of the runs from each text."""
    for whole in batches:
        for batch in slices(whole, "text"):
            n_words, n_removed, kept = [], [], []
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                words = (text.as_py() or "").encode().split()
                stays = np.ones(len(words), bool)
                for run in runs.as_py() or ():
                    stays[run["first"] : run["last"] + 1] = False
                n_words.append(len(words))
                n_removed.append(len(words) - int(stays.sum()))
                kept.append(b" ".join(w for w, s in zip(words, stays.tolist()) if s) if n_removed[-1] else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])


def frequent_minimisers(docs: DataFrame) -> np.ndarray:
    """Minimisers that hold over a quarter of a partition's share of the windows of the route sample."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = max(1, docs.count() // (SAMPLE_A_PARTITION * partitions))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    found = written(sample.mapInArrow(_sampled, "low long, n long").groupBy("low").agg(F.sum("n").alias("n")), "minimisers")
    total = found.agg(F.sum("n")).first()[0] or 0
    # at most 4 * partitions values can pass
    hot = found.where(F.col("n") * 4 * partitions > total).select("low").collect()
    return np.array([r["low"] for r in hot], np.int64).astype(np.uint64)


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(doc, text_key, runs): the runs of words to remove from each text that loses any."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    hot = np.sort(frequent_minimisers(docs))
    # a window can only repeat if another super-k-mer takes its route: most never do, and their words stay where they are
    routes = docs.mapInArrow(_routes(hot), ROUTES).repartition("route").sortWithinPartitions("route").mapInArrow(_shared, ROUTES)
    routes = written(routes, "routes")
    known = routes.where("first is not null").select("doc", "text_key", "first", "last")
    wanted = routes.where("first is null").groupBy("doc", F.col("text_key").alias("own_key")).agg(F.collect_set("route").alias("routes"))
    docs = docs.withColumn("own", F.coalesce("doc_id", F.lit(NO_ID)))
    some = docs.join(wanted, (docs["own"] == wanted["doc"]) & (docs["text_key"] == wanted["own_key"])).select("doc_id", "text", "text_key", "routes")
    packed = some.mapInArrow(_pack(hot), PACKED)
    runs = packed.repartition("route").sortWithinPartitions("route").mapInArrow(_count, RUNS)
    return runs.unionAll(known).groupBy("doc", "text_key").agg(F.collect_set(F.struct("first", "last")).alias("runs"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept_text."""
    runs = written(repeated_runs(docs), "repeated-runs")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("own", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("key", F.xxhash64("text"))
    return (docs.join(runs, (docs["own"] == runs["doc"]) & (docs["key"] == runs["text_key"]), "left").select("doc_id", "text", "runs")
            .mapInArrow(_without, "doc_id long, n_words long, n_removed long, kept_text string"))
