"""Resharding by minimum-cost flow: the fewest bytes move from old shards to new capacities.

The old layout is a table of blocks: each old shard is dealt into as many blocks
by a hash of its rows, and a block is a file. Block sizes are summed from the files.
A flow from old shard sizes to new capacities, a byte that stays costing nothing,
says how many bytes go from which shard to which. Per transfer whole blocks
are taken, the largest that fit, and one block is cut between its documents,
small ones first; a transfer is off by half a document at most. Only files of
blocks that move or are cut are written again; the rest of the new layout is the
old files.

Block sizes and the flow are the only things on the driver: at most MOST_BLOCKS rows
per old shard.

Edge cases: a null or empty text has the size of its end mark; null ids and
repeated rows are rows like others; no rows give empty shards; documents are kept
as they are, with all columns, in one nested column, so no name can clash. Equal
rows of one block that differ in nothing get their slots in any order.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.tables import sized, small, written
from keepwell.session import scratch_folder

#: Bytes of text in a block, and the least and most blocks of an old shard.
BLOCK_BYTES, LEAST_BLOCKS, MOST_BLOCKS = 64 << 20, 16, 4096


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost: Sequence[Sequence[int]]) -> list[list[int]]:
    """Flow of all supplies into the capacities at the least total cost: successive shortest paths with potentials.

    Costs are not negative. Raises ValueError if the capacities don't suffice.
    """
    if sum(capacity) < sum(supply):
        raise ValueError("the capacities are below the supplies")
    rows, columns = len(supply), len(capacity)
    flow = [[0] * columns for _ in supply]
    left, free = list(supply), list(capacity)
    potential = [0] * (rows + columns)
    while any(left):
        start = [0 if left[i] else None for i in range(rows)] + [None] * columns
        came: list[int | None] = [None] * (rows + columns)
        queue = [(0, i) for i in range(rows) if left[i]]
        done: set[int] = set()
        while queue:
            d, u = heapq.heappop(queue)
            if u in done:
                continue
            done.add(u)
            if u < rows:
                steps = [(rows + j, cost[u][j]) for j in range(columns)]
            else:
                steps = [(i, -cost[i][u - rows]) for i in range(rows) if flow[i][u - rows]]
            for v, c in steps:
                far = d + c + potential[u] - potential[v]
                if v not in done and (start[v] is None or far < start[v]):
                    start[v], came[v] = far, u
                    heapq.heappush(queue, (far, v))
        end = min((start[rows + j] + potential[rows + j], j) for j in range(columns) if free[j] and start[rows + j] is not None)[1]
        path, v = [], rows + end
        while came[v] is not None:
            path.append((came[v], v))
            v = came[v]
        amount = min([left[v], free[end], *(flow[b][a - rows] for a, b in path if a >= rows)])
        for a, b in path:
            if a < rows:
                flow[a][b - rows] += amount
            else:
                flow[b][a - rows] -= amount
        left[v] -= amount
        free[end] -= amount
        far = max(d for d in start if d is not None)
        potential = [p + (far if d is None else d) for p, d in zip(potential, start)]
    return flow


@dataclass
class Transfers:
    """What becomes of blocks that don't stay whole: a new shard each, or cuts (bytes, new shard) and the shard of the rest."""

    whole: dict[int, int]
    cuts: dict[int, tuple[list[tuple[int, int]], int]]


def transfers(flow: list[list[int]], blocks: dict[int, dict[int, tuple[int, int]]]) -> Transfers:
    """Blocks that realise a flow. ``blocks``: of each old shard, block to (bytes, documents)."""
    out = Transfers({}, {})
    for old, row in enumerate(flow):
        rest = dict(blocks.get(old, {}))
        arcs = sorted(((f, new) for new, f in enumerate(row) if f and new != old), reverse=True)
        if not arcs:
            continue
        stays = old if old < len(row) else arcs[0][1]
        need = {new: f for f, new in arcs if new != stays}
        for new in need:
            for block, (size, _) in sorted(rest.items(), key=lambda b: (-b[1][0], b[0])):
                if size <= need[new]:
                    out.whole[block] = new
                    need[new] -= size
                    del rest[block]
        marks: list[tuple[int, int]] = []
        cut, used = None, 0
        for new, amount in need.items():
            if not amount:
                continue
            if cut is None or rest[cut][0] - used < amount:
                if cut is not None:
                    out.cuts[cut] = (marks, stays)
                    del rest[cut]
                fitting = {b: s for b, s in rest.items() if s[0] >= amount}
                if not fitting:
                    cut = None
                    continue  # less than any document that could go
                cut, used, marks = min(fitting, key=lambda b: (fitting[b][0] / fitting[b][1], b)), 0, []
            used += amount
            marks.append((used, new))
        if cut is not None:
            out.cuts[cut] = (marks, stays)
            del rest[cut]
        if stays != old:
            out.whole.update(dict.fromkeys(rest, stays))
    return out


def document_size() -> Column:
    """UTF-8 bytes of the text and its end mark."""
    return F.coalesce(F.octet_length(F.col("doc.text")), F.lit(0)).cast("long") + 1


def write_layout(docs: DataFrame, old: Column, shards: int) -> tuple[DataFrame, int]:
    """The old layout as files, and the blocks of a shard. Columns: doc, size, block (shard x blocks + number)."""
    spark = docs.sparkSession
    laid = docs.select(F.struct("*").alias("doc"), old.cast("int").alias("old")).withColumn("size", document_size())
    largest = laid.groupBy("old").agg(F.sum("size").alias("size")).agg(F.max("size")).first()[0] or 0
    blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, -(-largest // BLOCK_BYTES)))
    number = F.pmod(F.xxhash64("doc.doc_id", "doc.text"), F.lit(blocks)).cast("int")
    laid = laid.select("doc", "size", (F.col("old") * blocks + number).alias("block"))
    folder, kind = scratch_folder(spark, "old-layout"), laid.schema
    laid.repartition("block").write.partitionBy("block").parquet(folder)
    return spark.read.schema(kind).parquet(folder), blocks


def _rewritten(layout: DataFrame, plan: Transfers, blocks: int) -> DataFrame:
    """Rows of the files that are written again: (doc, size, block, shard)."""
    spark = layout.sparkSession
    whole = spark.createDataFrame([*plan.whole.items()], "block int, shard int")
    moved = layout.where(F.col("block").isin(list(plan.whole))).join(small(whole, 16 * len(plan.whole)), "block").select("doc", "size", "block", "shard")
    if not plan.cuts:
        return moved
    cuts = spark.createDataFrame([(b, [*marks], stays) for b, (marks, stays) in plan.cuts.items()], "block int, marks array<struct<upto:bigint,shard:int>>, stays int")
    by_size = Window.partitionBy("block").orderBy("size", "doc.doc_id", "doc.text")
    upto = F.sum("size").over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    middle = 2 * F.col("upto") - F.col("size")
    chosen = F.filter("marks", lambda m: middle <= 2 * m["upto"])
    part = layout.where(F.col("block").isin(list(plan.cuts))).withColumn("upto", upto).join(F.broadcast(cuts), "block")
    return moved.unionAll(part.select("doc", "size", "block", F.coalesce(F.get(chosen, F.lit(0))["shard"], "stays").alias("shard")))


def reshard(docs: DataFrame, old: Column, old_shards: int, new_shards: int, weights: Sequence[int] | None = None) -> DataFrame:
    """The new layout: doc (all columns), size, block, old_shard, shard.

    ``old`` numbers the old shard of a row. ``weights`` are the shares of the new
    shards; equal without them.
    """
    layout, blocks = write_layout(docs, old, old_shards)
    found: dict[int, dict[int, tuple[int, int]]] = {}
    # at most old_shards x MOST_BLOCKS rows
    for r in layout.groupBy("block").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")).collect():
        found.setdefault(r["block"] // blocks, {})[r["block"]] = (r["size"], r["docs"])
    supply = [sum(s for s, _ in found.get(i, {}).values()) for i in range(old_shards)]
    flow = min_cost_flow(supply, capacities(sum(supply), weights or [1] * new_shards), [[int(i != j) for j in range(new_shards)] for i in range(old_shards)])
    plan = transfers(flow, found)
    touched = [*plan.whole, *plan.cuts]
    old_shard = F.expr(f"block div {blocks}").cast("int").alias("old_shard")
    kept = layout.where(~F.col("block").isin(touched)) if touched else layout
    out = kept.select("doc", "size", "block", old_shard, F.expr(f"block div {blocks}").cast("int").alias("shard"))
    if touched:
        again = _rewritten(layout, plan, blocks)
        folder, kind = scratch_folder(docs.sparkSession, "new-files"), again.schema
        again.write.partitionBy("shard").parquet(folder)
        out = out.unionAll(docs.sparkSession.read.schema(kind).parquet(folder).select("doc", "size", "block", old_shard, "shard"))
    return out


def capacities(total: int, weights: Sequence[int]) -> list[int]:
    """Whole capacities in proportion to the weights; what is left goes to the first shards."""
    each = [total * w // sum(weights) for w in weights]
    for i in range(total - sum(each)):
        each[i] += 1
    return each


def slots(layout: DataFrame) -> DataFrame:
    """One row per document of a layout: doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard.

    Slots run through the blocks of a shard in order, and within a block by
    doc_id, checksum and size.
    """
    crc = F.coalesce(F.crc32(F.col("doc.text").cast("binary")), F.lit(0).cast("long"))
    rows = written(layout.select(F.col("doc.doc_id").alias("doc_id"), document_size().alias("size"), crc.alias("text_crc32"), "shard", "old_shard", "block"), "slots")
    counts = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "starts")
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("inside", F.row_number().over(inside)).join(sized(starts, 16), ["shard", "block"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("inside") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "old_shard"))


def resharded(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Documents that lie in shards by source, moved to shards of equal bytes."""
    old = F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")), F.lit(shards))
    return slots(reshard(docs, old, shards, shards))
