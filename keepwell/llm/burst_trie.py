"""Prefix trie of conversations, built as a burst trie.

A container holds the rest of conversations that share a prefix. All start in the
container under the root. A container with more than ``limit`` turns bursts: the
turns that all its members share become a chain of trie heads, each member goes
on to the container of its next turn id, and members that end at the chain's last
head are recorded there. What rests is small: the containers are dealt by key,
sorted, and swept into nodes by comparing neighbours. Sums over subtrees then
climb from the containers through the heads, a level at a time.

Copies of one conversation, however many, are counted by bursting and never meet in
one task. Their ids, where one digest must cover them in order, are sorted by
range, joined in chunks in parallel, and only the chunks pass through the digest.

A turn id is the first 16 bytes of the SHA-256 of role and text; container keys
are chained digests of as many bytes. One conversation is one row: a task holds
the turns of the longest one.

Edge cases: null turns come first; turns of equal number are ordered by turn id
and kept; rows with a null conv_id are left out; null role or text is empty; a
conversation without a turn left is a member of the root; no conversations give
no rows. ``c - c % 20`` has the sign of c. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.tables import measured, small, written

#: Turns that a container may hold before it bursts.
LIMIT = 8192
#: Conversations that share an opening, and the longest opening.
FAMILY, OPENING = 20, 4
CHUNK = 4096
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NOTHING = hashlib.sha256(b"").hexdigest()
_ROOT = b""


def turns_of(conversations: DataFrame) -> DataFrame:
    """(family, conv_id, turns) with turns in order, each a turn id and its words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        "turn", F.unhex(F.substring(F.sha2(marked.cast("binary"), 256), 1, 32)).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    rows = conversations.where("conv_id is not null").select((F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"), "conv_id", turn.alias("t"))
    # one exchange serves the grouping here and the window over the family
    return rows.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "family", "conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, rest): the opening of the family's first conversation, then the own turns behind as many."""
    opening = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(OPENING)).cast("int")
    first = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, OPENING - 1))).over(Window.partitionBy("family"))
    empty = F.expr("cast(array() as array<struct<id:binary,words:bigint>>)")
    own = F.slice("turns", opening + 1, F.greatest(F.size("turns") - opening, F.lit(0)))
    return turns_of(conversations).withColumn("first", F.coalesce(first, empty)).select(
        "conv_id", F.concat(F.slice("first", F.lit(1), opening), own).alias("rest"))


def _shared(low: Column, high: Column) -> Column:
    """Turns at the start of both."""
    same = F.zip_with(low, high, lambda a, b: a["id"].eqNullSafe(b["id"]))
    at = F.array_position(same, F.lit(False))
    return F.when(at > 0, at - 1).otherwise(F.size(low).cast("long")).cast("int")


def _burst(rows: DataFrame, over: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Heads made of oversized containers, and the rows of these containers one turn id further.

    A row that ends at the head has a null key afterwards.
    """
    held = rows.join(over, "key")
    heads = held.groupBy("key").agg(
        F.first("head").alias("head"), F.first("base").alias("base"), F.first("parent").alias("parent"), F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("least"), F.min("rest").alias("low"), F.max("rest").alias("high"))
    shared = _shared(F.col("low"), F.col("high"))
    root = F.when(F.col("base") < 0, F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    heads, seen = measured(heads.select(
        "key", "head", "base", "parent", "n", "least", shared.alias("shared"),
        F.concat(root, F.transform(F.slice("low", F.lit(1), shared), lambda t: t["words"])).alias("chain")), f"{name}-heads", size=F.sum(F.size("chain") * 8 + 80))
    step = small(heads.select("key", (F.col("base") + F.size("chain")).alias("base"), F.col("least").alias("parent"), "shared"), seen["size"] or 0)
    on = rows.drop("base", "parent", "head").join(step, "key")
    left = F.size("rest") - F.col("shared")
    rest = F.slice("rest", F.col("shared") + 1, F.greatest(left, F.lit(0)))
    key = F.when(left > 0, F.unhex(F.md5(F.concat("key", F.element_at("rest", F.least(F.col("shared") + 1, F.size("rest")))["id"]))))
    moved = on.select(key.alias("key"), F.col("key").alias("head"), "base", "parent", "conv_id", rest.alias("rest"))
    return heads, written(moved, f"{name}-rows")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of sorted containers; one container is held at a time."""
    for key, rows in groupby(_rows(batches), key=itemgetter(0)):
        yield _nodes(rows)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "head", "base", "parent", "conv_id")]
        rest = batch.column("rest")
        bounds = rest.offsets.to_pylist()
        ids, words = (rest.values.field(c).to_pylist() for c in ("id", "words"))
        for k, head in enumerate(zip(*columns)):
            yield *head, ids[bounds[k] : bounds[k + 1]], words[bounds[k] : bounds[k + 1]]


def _nodes(rows: Iterator[tuple]) -> pa.RecordBatch:
    depth, above, least, members, own, ends = [], [], [], [], [], []
    path, before = [], []
    for _, head, base, parent, conv, ids, words in rows:
        same = 0
        for a, b in zip(before, ids):
            if a != b:
                break
            same += 1
        del path[same:]
        for at in range(same, len(ids)):
            above.append(path[-1] if path else -1)
            path.append(len(depth))
            depth.append(base + 1 + at)
            least.append(conv)
            members.append(0)
            own.append(words[at])
            ends.append([])
        for i in path:
            members[i] += 1
            if conv < least[i]:
                least[i] = conv
        ends[path[-1]].append(conv)
        before = ids
    n = len(depth)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        leaves[i] = leaves[i] or 1
        saved[i] += (members[i] - 1) * own[i]
        if above[i] >= 0:
            children[above[i]] += 1
            leaves[above[i]] += leaves[i]
            saved[above[i]] += saved[i]
    digests = [hashlib.sha256(",".join(map(str, e)).encode()).hexdigest() if e else NOTHING for e in ends]
    parents = [least[a] if a >= 0 else parent for a in above]
    longs = [pa.array(x, pa.int64()) for x in (least, depth, parents, members, children, leaves, saved)]
    return pa.RecordBatch.from_arrays(
        [*longs, pa.array(digests), pa.array([head] + [None] * (n - 1), pa.binary())],
        names=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "head"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of sorted (head, conv_id) rows, joined in chunks of one head."""
    def pairs():
        for b in batches:
            yield from zip(b.column("head").to_pylist(), b.column("conv_id").to_pylist())

    for head, rows in groupby(pairs(), key=itemgetter(0)):
        part: list[int] = []
        for _, c in rows:
            part.append(c)
            if len(part) == CHUNK:
                yield _chunk(head, part)
                part = []
        if part:
            yield _chunk(head, part)


def _chunk(head: bytes, ids: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"head": head, "first": ids[0], "ids": ",".join(map(str, ids))}],
                                      schema=pa.schema([("head", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the chunks of each head, one chunk at a time."""
    def pairs():
        for b in batches:
            yield from zip(b.column("head").to_pylist(), b.column("ids").to_pylist())

    for head, rows in groupby(pairs(), key=itemgetter(0)):
        digest, comma = hashlib.sha256(), b""
        for _, ids in rows:
            digest.update(comma + ids.encode())
            comma = b","
        yield pa.RecordBatch.from_pylist([{"head": head, "ends_sha256": digest.hexdigest()}], schema=pa.schema([("head", pa.binary()), ("ends_sha256", pa.string())]))


def _ends(ended: DataFrame) -> DataFrame:
    """(head, ends_sha256) of conversations that end at a head."""
    n = int(ended.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = ended.repartitionByRange(n, "head", "conv_id").sortWithinPartitions("head", "conv_id").mapInArrow(_chunks, "head binary, first long, ids string")
    return chunks.repartition("head").sortWithinPartitions("head", "first").mapInArrow(_digests, "head binary, ends_sha256 string")


def _climbed(heads: DataFrame, tops: DataFrame, name: str) -> DataFrame:
    """Heads of a level with the number, leaves and savings of what hangs under them."""
    under = tops.groupBy("head").agg(F.count(F.lit(1)).alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    joined = heads.withColumnRenamed("head", "over").join(under, heads["key"] == under["head"], "left")
    return written(joined.select("key", "over", "base", "parent", "n", "least", "chain", zero(F.col("kids")).alias("kids"),
                                 F.greatest(zero(F.col("leaves")), F.lit(1)).alias("leaves"), zero(F.col("saved")).alias("below")), name)


def _chain_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of each head's chain; only the last has other children and ends."""
    for batch in batches:
        for r in batch.to_pylist():
            k, n, least = len(r["chain"]), r["n"], r["least"]
            saved = r["below"] + (n - 1) * np.cumsum(np.array(r["chain"][::-1], np.int64))[::-1]
            yield pa.RecordBatch.from_arrays([
                pa.array([least] * k, pa.int64()), pa.array(np.arange(k) + r["base"] + 1, pa.int64()), pa.array([r["parent"]] + [least] * (k - 1), pa.int64()),
                pa.array([n] * k, pa.int64()), pa.array([1] * (k - 1) + [r["kids"]], pa.int64()), pa.array([r["leaves"]] * k, pa.int64()),
                pa.array(saved, pa.int64()), pa.array([NOTHING] * (k - 1) + [r["ends_sha256"] or NOTHING])],
                names=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"])


def trie(conversations: DataFrame, limit: int = LIMIT, rebuild: Callable[[DataFrame], DataFrame] = rebuilt) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, see NODE.

    ``rebuild`` gives (conv_id, rest) of one row per conversation; rest is an
    array of (id, words).
    """
    spark = conversations.sparkSession
    rows, seen = measured(rebuild(conversations).select(
        F.lit(_ROOT).alias("key"), F.lit(None).cast("binary").alias("head"), F.lit(-1).alias("base"), F.lit(None).cast("long").alias("parent"), "conv_id", "rest"), "conversations")
    if not seen["rows"]:
        return spark.createDataFrame([], NODE)
    over, levels, resting, ended = spark.createDataFrame([(_ROOT,)], "key binary"), [], [], []
    while True:
        heads, rows = _burst(rows, over, f"burst-{len(levels)}")
        levels.append(heads)
        ended.append(rows.where("key is null").select("head", "conv_id"))
        rows = rows.where("key is not null")
        full, seen = measured(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("rest")).alias("turns"))
                              .where(f"n > 1 and turns > {limit}").select("key"), f"full-{len(levels)}")
        over = small(full, 40 * seen["rows"])
        resting.append(rows.join(over, "key", "left_anti") if seen["rows"] else rows)
        if not seen["rows"]:
            break
    containers = reduce(DataFrame.unionAll, resting).repartition("key").sortWithinPartitions("key", "rest", "conv_id")
    swept = written(containers.mapInArrow(_sweep, f"{NODE}, head binary"), "nodes")
    tops = swept.where("head is not null").select("head", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    climbed, above = [], None
    for level in range(len(levels) - 1, -1, -1):
        above = _climbed(levels[level], tops if above is None else tops.unionAll(above), f"level-{level}")
        climbed.append(above)
        total = F.aggregate("chain", F.lit(0).cast("long"), lambda a, w: a + w)
        above = above.select(F.col("over").alias("head"), "leaves", (F.col("below") + (F.col("n") - 1) * total).alias("saved"))
    every = reduce(DataFrame.unionAll, climbed)
    ends = _ends(reduce(DataFrame.unionAll, ended)).withColumnRenamed("head", "at")
    heads = every.join(ends, every["key"] == ends["at"], "left").mapInArrow(_chain_nodes, NODE)
    return swept.drop("head").unionAll(heads)
