"""Near-duplicate components by b-bit MinHash.

Every document gets K minima over its set of word shingles. The minima form
BANDS bands of ROWS values; documents that agree in a band are candidates. Of each
minimum only BITS low bits are kept, as bit planes: XOR, OR and a bit count
give the share of agreeing minima, from which the chance agreement 2**-BITS is
taken out to estimate the similarity. Pairs whose estimate is near or above the
threshold are confirmed on the full shingle sets. A pair at the threshold misses
all bands with probability (1 - 0.8**4)**32 < 1e-7.

Documents with equal sets are one node. Every bucket has a hub, the member that
stands in the fullest buckets; all members are compared with it on full sets,
which joins most of a group of copies. Spokes of a hub that are still in different
components are compared inside a join, by size, by estimate and by their
differences from the hub's set, so that only near-certain links come out of it.

Edge cases: a document without words (or null) has the empty set, n_shingles 0
and its own component; rows without doc_id are returned with a null component and
kept, linked with nothing; rows sharing a doc_id are one document whose links
are those of all its texts; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.tables import measured, small, written
from keepwell.llm.textblocks import Words, column_bytes, give_back, mixed, slices

BANDS, ROWS, BITS = 32, 4, 4
K = BANDS * ROWS
PERCENT = 80
SHINGLE = 2
#: The estimate's standard deviation at the threshold is 0.037; over five of them lie between these.
LEAST_ESTIMATE = 0.6
#: A spoke with at least this similarity to its hub is known by the difference of their sets.
DIFFERENCE_PERCENT = 45
_A = mixed(np.arange(1, K + 1, dtype=np.uint64)) | np.uint64(1)
_B = mixed(np.arange(K + 1, 2 * K + 1, dtype=np.uint64))

#: Bit planes of the signature, 64 minima a column.
PLANES = [f"p{b}_{h}" for b in range(BITS) for h in range(K // 64)]
SIGNATURE = "doc_id long, n_shingles long, set_key binary, bands array<long>, " + ", ".join(f"{c} long" for c in PLANES)


def shingle_hashes(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of n consecutive words; a shorter text is one shingle, an empty one none."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = mixed(out + words[k : len(words) - n + 1 + k])
    return np.unique(out)


def minima(shingles: np.ndarray) -> np.ndarray:
    """K minima of the set, each over its own order of the hashes."""
    best = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048]
        np.minimum(best, (part[None, :] * _A[:, None] + _B[:, None]).min(axis=1), out=best)
    return mixed(best)


def planes(minimum: np.ndarray) -> list[np.ndarray]:
    """Low bits of the minima as BITS planes of K // 64 signed 64-bit values."""
    bits = (minimum[..., None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    packed = np.packbits(np.moveaxis(bits, -1, 0).astype(np.uint8), axis=-1)
    return list(np.ascontiguousarray(packed).view(">i8").astype(np.int64))


def _signatures(shingle: int):
    return lambda batches: _signed(batches, shingle)


def _signed(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            raw, offsets = column_bytes(batch.column("text"))
            words = Words(raw, offsets, lower=True)
            sets = [shingle_hashes(words.hashes[a:b], shingle) for a, b in zip(words.bounds[:-1], words.bounds[1:])]
            m = np.stack([minima(s) for s in sets])
            rows = m.reshape(len(sets), BANDS, ROWS)
            band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sets), BANDS))
            for r in range(ROWS):
                band = mixed(band * np.uint64(31) + rows[:, :, r])
            bands = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * BANDS, band.astype(np.int64).ravel())
            low = planes(m)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()), bands,
                 *(low[b][:, h] for b in range(BITS) for h in range(K // 64))],
                names=["doc_id", "n_shingles", "set_key", "bands", *PLANES])
    give_back()


def full_set(text: str | None, shingle: int) -> set:
    """The shingles themselves; bytes.lower and bytes.split are the ASCII rules of the operator."""
    w = (text or "").encode().lower().split()
    return {tuple(w)} - {()} if len(w) < shingle else set(zip(*(w[k:] for k in range(shingle))))


def _confirm(shingle: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i in range(batch.num_rows):
                x, y = (full_set(batch.column(c)[i].as_py(), shingle) for c in ("text_a", "text_b"))
                both = len(x & y)
                if 100 * both >= PERCENT * (len(x) + len(y) - both):
                    good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))
        give_back()
    return confirm


def estimate(x: str, y: str) -> F.Column:
    """Similarity from the bit planes of two signatures, corrected for chance agreement."""
    differ = F.lit(0)
    for h in range(K // 64):
        word = None
        for b in range(BITS):
            d = F.col(f"{x}.p{b}_{h}").bitwiseXOR(F.col(f"{y}.p{b}_{h}"))
            word = d if word is None else word.bitwiseOR(d)
        differ = differ + F.bit_count(word)
    chance = 2.0 ** -BITS
    return (1 - differ / K - chance) / (1 - chance)


def _near() -> F.Column:
    """What spokes x and y of a hub must fulfil to be worth confirming.

    Sizes and estimate first. Where both are known as differences from the hub's
    set, their common shingles are counted too: those of the hub that neither lacks
    and those that both add. Two are allowed for added shingles that fold to one number.
    """
    n, m = F.col("x.n"), F.col("y.n")
    common = F.col("x.hub_n") - F.size(F.array_union("x.lacks", "y.lacks")) + F.size(F.array_intersect("x.adds", "y.adds")) + 2
    return ((100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (estimate("x.s", "y.s") >= LEAST_ESTIMATE)
            & (F.col("x.lacks").isNull() | F.col("y.lacks").isNull() | (100 * common >= PERCENT * (n + m - common))))


def _compared(shingle: int):
    """Spokes and their hub with both texts: whether they are linked, and the difference where they share enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text_a"):
                rows = []
                a, b = (Words(*column_bytes(batch.column(c)), lower=True) for c in ("text_a", "text_b"))
                for i, (rep, hub) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                    x, y = (shingle_hashes(w.hashes[w.bounds[i] : w.bounds[i + 1]], shingle) for w in (a, b))
                    shared = np.isin(y, x, assume_unique=True)
                    both = int(shared.sum())
                    union = len(x) + len(y) - both
                    close = 100 * both >= DIFFERENCE_PERCENT * union
                    rows.append({"a": rep, "b": hub, "link": 100 * both >= PERCENT * union,
                                 "lacks": np.flatnonzero(~shared).tolist() if close else None,
                                 "adds": (np.setdiff1d(x, y, assume_unique=True) >> np.uint64(33)).tolist() if close else None})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("a", pa.int64()), ("b", pa.int64()), ("link", pa.bool_()), ("lacks", pa.list_(pa.int32())), ("adds", pa.list_(pa.int32()))]))
        give_back()
    return run


def _with_texts(pairs: DataFrame, rows: int, docs: DataFrame, name: str) -> DataFrame:
    """Pairs (a, b) with the texts of both."""
    wanted = small(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), 48 * rows)
    texts, size = measured(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(wanted, "doc_id", "left_semi"), f"{name}-texts", bytes=F.sum(32 + F.octet_length("text")))
    texts = small(texts, size["bytes"] or 0)
    # rows of 16 bytes, each of them work for two sets: spread them before their texts come
    pairs = pairs.select("a", "b").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"))


def _confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, name: str) -> tuple[DataFrame, int]:
    """Candidate pairs (a, b) that hold on the full sets, and their number."""
    pairs, seen = measured(pairs.distinct(), f"{name}-pairs")
    both = _with_texts(pairs, seen["rows"], docs, name)
    links, seen = measured(both.mapInArrow(_confirm(shingle), "a long, b long"), f"{name}-links")
    return links, seen["rows"]


def components(links: DataFrame, most: int, name: str = "components") -> DataFrame:
    """(id, comp): smallest id reachable over links (a, b), of which there are ``most`` at most, for every id with a link.

    Each round takes the smallest label of the neighbours and then the label of
    that label, so the number of rounds grows with the logarithm of a path.
    """
    edges = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = written(edges, f"{name}-edges", 2 * most)
    label = written(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("comp")).select("id", F.least("id", "comp").alias("comp")), f"{name}-0", 2 * most)
    step = 0
    while True:
        step += 1
        far = small(label, 64 * most)
        told = edges.join(far.select(F.col("id").alias("b"), "comp"), "b").select(F.col("a").alias("id"), "comp", F.lit(None).cast("long").alias("old"))
        new = told.unionAll(label.select("id", "comp", F.col("comp").alias("old"))).groupBy("id").agg(F.min("comp").alias("comp"), F.max("old").alias("old"))
        new = new.join(far.select(F.col("id").alias("over"), F.col("comp").alias("far")), F.col("comp") == F.col("over"), "left").select(
            "id", F.least("comp", F.coalesce("far", "comp")).alias("comp"), "old")
        new, seen = measured(new, f"{name}-{step}", 2 * most, changed=F.count_if(F.col("comp") != F.col("old")))
        label = new.select("id", "comp")
        if not seen["changed"]:
            return label


def _same_document(every: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the nodes of a doc_id that stands in the input with several texts."""
    several = every.where("doc_id is not null and set_key is not null").groupBy("doc_id").agg(F.collect_set("set_key").alias("k")).where("size(k) > 1")
    reps = several.select("doc_id", F.explode("k").alias("set_key")).join(nodes.select("set_key", "rep"), "set_key")
    return reps.groupBy("doc_id").agg(F.collect_set("rep").alias("r"), F.min("rep").alias("b")).select(
        F.explode("r").alias("a"), "b").where("a != b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept."""
    docs = docs.select("doc_id", "text")
    every = written(docs.mapInArrow(_signatures(shingle), SIGNATURE), "signatures")
    nodes, seen = measured(every.where("doc_id is not null and set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), *(F.first(c).alias(c) for c in PLANES)), "sets")
    documents = seen["rows"]
    banded = nodes.select("rep", F.explode("bands").alias("bucket"))
    full, seen = measured(banded.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1"), "buckets", n=F.sum("c"))
    most = seen["n"] or 0
    members = written(banded.join(small(full, 32 * seen["rows"]), "bucket"), "members", most)
    # the member that stands in the fullest buckets is most like the others: the hub of its buckets
    central = members.groupBy("rep").agg(F.sum("c").alias("weight"))
    hubs = members.join(central, "rep").groupBy("bucket").agg(F.max_by("rep", F.struct("weight", "rep")).alias("hub"))
    spokes, seen = measured(members.join(hubs, "bucket").select("rep", "hub").distinct(), "spokes", most)
    pairs = spokes.where("rep != hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    compared = _with_texts(pairs, seen["rows"], docs, "spokes").mapInArrow(_compared(shingle), "a long, b long, link boolean, lacks array<int>, adds array<int>")
    compared = written(compared, "compared")
    links, seen = measured(compared.where("link").select("a", "b").unionAll(_same_document(every, nodes)).distinct(), "links")
    n_links = seen["rows"]
    label = components(links, n_links) if n_links else None
    # spokes of a hub that are still in different components are compared with each other
    own = nodes.select("rep", "n", F.struct(*PLANES).alias("s"))
    known = (spokes.join(compared, (F.col("rep") == F.col("a")) & (F.col("hub") == F.col("b")), "left")
             .select("rep", "hub", *(F.when(F.col("rep") == F.col("hub"), F.array().cast("array<int>")).otherwise(F.col(c)).alias(c) for c in ("lacks", "adds"))))
    if label is None:
        known = known.withColumn("comp", F.col("rep"))
    else:
        known = known.join(small(label, 64 * n_links), F.col("rep") == F.col("id"), "left").withColumn("comp", F.coalesce("comp", "rep")).drop("id")
    split = known.groupBy("hub", "comp").agg(F.count("*").alias("c")).groupBy("hub").agg(F.max_by("comp", F.struct("c", "comp")).alias("big"), F.count("*").alias("comps")).where("comps > 1")
    known = (known.join(split, "hub").join(own, "rep").join(nodes.select(F.col("rep").alias("hub"), F.col("n").alias("hub_n")), "hub"))
    known, seen = measured(known.select("rep", "hub", "comp", (F.col("comp") == F.col("big")).alias("of_big"), "n", "s", "hub_n", "lacks", "adds"), "open-spokes", most)
    if seen["rows"]:
        # the largest component around a hub is only compared with the others
        x, y = known.where("not of_big").alias("x"), known.alias("y")
        pairs = x.join(y, (F.col("x.hub") == F.col("y.hub")) & (F.col("x.comp") != F.col("y.comp")) & (F.col("y.of_big") | (F.col("x.rep") < F.col("y.rep"))) & _near())
        found, n = _confirmed(pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")), docs, shingle, "more")
        if n:
            label = components(links.unionAll(found), n_links + n, "components-all")
            n_links += n
    comps = nodes.select("set_key", F.col("rep").alias("comp"))
    if label is not None:
        comps = nodes.select("set_key", "rep").join(small(label, 64 * n_links), F.col("rep") == F.col("id"), "left").select("set_key", F.coalesce("comp", "rep").alias("comp"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return every.select("doc_id", "n_shingles", "set_key").join(comps, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The document with the smallest id of every component; repeated rows of it count once."""
    gone = near_duplicates(docs, shingle).where("not kept").select(F.col("doc_id").alias("_id")).distinct()
    once = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).unionAll(docs.where("doc_id is null"))
    return once.join(gone, once["doc_id"] == gone["_id"], "left_anti").select(*(once[c] for c in docs.columns))
