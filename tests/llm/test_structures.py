"""Clustering, resharding and the prefix trie against brute force on awkward rows."""
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.llm import burst_trie, resharding, simplex
from tests.llm.fixtures import awkward, frame, sentence  # noqa: F401

EXTRA = "cluster int, x int, apex int, near int, c int, k int, d int, distance int"


def vectors_frame(spark, rows):
    n = len(EXTRA.split(","))
    return spark.createDataFrame([(i, v, *[7] * n) for i, v in rows], f"vec_id long, embedding array<double>, {EXTRA}")


def lloyd(rows, clusters, rounds, size, scale=1024):
    """Plain integer k-means; rows of (vec_id, vector)."""
    kept = []
    for i, v in rows:
        if v is None or len(v) != size or any(x is None or not np.isfinite(x * scale) for x in v):
            continue
        kept.append((i, [int(np.floor(scale * x)) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)].append(v)
        centroids = [[sum(col) // len(groups[c]) for col in zip(*groups[c])] if c in groups else old for c, old in enumerate(centroids)]
    label = [(i, nearest(v), v) for i, v in kept]
    fits = lambda d: d if d < 1 << 63 else None
    inertia = Counter()
    for _, c, v in label:
        inertia[c] += far(v, centroids[c])
    known = all(far(v, centroids[c]) < 1 << 63 for _, c, v in label)
    own = {c: all(far(v, centroids[c]) < 1 << 63 for _, k, v in label if k == c) for c in inertia}
    return sorted(repr((i, c, fits(far(v, centroids[c])), fits(inertia[c]) if own[c] else None, fits(sum(inertia.values())) if known else None,
                        hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())) for i, c, v in label)


def clusters_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_clusters_equal_brute_force(spark):
    r = random.Random(1)
    centers = [[r.uniform(-0.4, 0.4) for _ in range(6)] for _ in range(4)]
    rows = [(i, [x + r.gauss(0, 0.05) for x in centers[i % 4]]) for i in range(150)]
    same = rows[3][1]
    rows += [(1000 + i, same) for i in range(80)] + [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (None, rows[8][1])]
    rows += [(2000, None), (2001, []), (2002, same[:5]), (2003, same + [0.0]), (2004, [None] * 6), (2005, [float("nan")] * 6), (2006, [float("inf")] * 6), (2007, [1e306] * 6)]
    df = vectors_frame(spark, rows).repartition(5)
    assert clusters_of(simplex.clustered(df, 5, 4, 6, pivots=3)) == lloyd(rows, 5, 4, 6)
    assert clusters_of(simplex.clustered(df, 5, 0, 6, pivots=3)) == lloyd(rows, 5, 0, 6)


def test_clusters_of_large_equal_and_few_vectors(spark):
    huge = [(i, [s * 10.0 ** e for s in (1, -1, 3)]) for i, e in enumerate((0, 3, 6, 9, 12, 30, 30, 31, 38))]
    assert clusters_of(simplex.clustered(vectors_frame(spark, huge), 3, 4, 3)) == lloyd(huge, 3, 4, 3)
    equal = [(i, [0.1, -0.2, 0.3]) for i in range(20)]
    assert clusters_of(simplex.clustered(vectors_frame(spark, equal), 4, 3, 3)) == lloyd(equal, 4, 3, 3)
    few = equal[:1] + [(50, [0.5, 0.5, 0.5])]
    assert clusters_of(simplex.clustered(vectors_frame(spark, few), 8, 3, 3)) == lloyd(few, 8, 3, 3)
    none = simplex.clustered(vectors_frame(spark, [(1, None)]))
    assert none.collect() == [] and none.columns[0] == "vec_id"


def test_bounds_hold_and_settle_rows():
    r = np.random.default_rng(3)
    centers = np.floor(r.normal(0, 400, (8, 64)))
    x = np.floor(centers[r.integers(0, 8, 3000)] + r.normal(0, 60, (3000, 64)))
    shape = simplex.Simplex.of(simplex.whole(x[:64]))
    model = simplex.Model(shape, [[int(v) for v in c] for c in centers])
    vectors = simplex.whole(x)
    apex, near = shape.apex(vectors)
    exact = simplex.squared(vectors, model.vectors)
    left = model.candidates(apex, near)
    assert left[np.arange(len(x)), exact.argmin(axis=1)].all()
    assert (model.nearest(vectors, apex, near) == exact.argmin(axis=1)).all() and model.settled > 2900


# --- resharding

def test_flow_is_the_cheapest():
    r = random.Random(4)
    for _ in range(60):
        rows, columns = r.randint(1, 3), r.randint(1, 3)
        supply = [r.randint(0, 4) for _ in range(rows)]
        capacity = [r.randint(0, 4) for _ in range(columns)]
        if sum(capacity) < sum(supply):
            with pytest.raises(ValueError):
                resharding.min_cost_flow(supply, capacity, [[1] * columns] * rows)
            continue
        cost = [[r.randint(0, 5) for _ in range(columns)] for _ in range(rows)]
        flow = resharding.min_cost_flow(supply, capacity, cost)
        assert [sum(x) for x in flow] == supply and all(sum(c) <= m for c, m in zip(zip(*flow), capacity))
        ways = [[w for w in itertools.product(range(s + 1), repeat=columns) if sum(w) == s] for s in supply]
        least = min(sum(f * c for w, k in zip(way, cost) for f, c in zip(w, k)) for way in itertools.product(*ways)
                    if all(sum(c) <= m for c, m in zip(zip(*way), capacity)))
        assert sum(f * c for w, k in zip(flow, cost) for f, c in zip(w, k)) == least


def test_transfers_realise_a_flow():
    r = random.Random(5)
    blocks = {i: {i * 16 + b: (r.randint(50, 400), 10) for b in range(16)} for i in range(4)}
    supply = [sum(s for s, _ in b.values()) for b in blocks.values()]
    flow = resharding.min_cost_flow(supply, resharding.capacities(sum(supply), [3, 1, 1]), [[int(i != j) for j in range(3)] for i in range(4)])
    plan = resharding.transfers(flow, blocks)
    assert {b for b in blocks[3]} == {b for b in [*plan.whole, *plan.cuts] if b >= 48}  # a shard that ends keeps nothing
    got = Counter()
    for i, own in blocks.items():
        for b, (size, _) in own.items():
            if b in plan.cuts:
                marks, stays = plan.cuts[b]
                done = 0
                for upto, new in marks:
                    got[i, new] += upto - done
                    done = upto
                assert done <= size
                got[i, stays] += size - done
            else:
                got[i, plan.whole.get(b, i)] += size
    assert all(got[i, j] == f for i, row in enumerate(flow) for j, f in enumerate(row))


def layout_rows(df):
    return [(r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) for r in df.collect()]


def test_resharding_of_awkward_rows(spark, awkward):
    rows = layout_rows(resharding.resharded(awkward))
    want = sorted(repr((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))) for r in awkward.collect())
    assert sorted(repr(x[:3]) for x in rows) == want and {x[3] for x in rows} == {"bytes"} and {x[6] for x in rows} == {None}
    by = defaultdict(list)
    for x in rows:
        by[x[4]].append(x[5])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    empty = resharding.resharded(awkward.limit(0))
    assert empty.collect() == []


def test_shards_are_near_equal_and_few_bytes_move(spark):
    rows = [(i, sentence(i, 5 + i % 40), "hot" if i % 3 else f"s{i % 7}") for i in range(600)]
    df = frame(spark, rows)
    out = resharding.resharded(df).collect()
    size, old = Counter(), Counter()
    for r in out:
        size[r.shard] += r.size
        old[r.old_shard] += r.size
    total = sum(size.values())
    largest = max(r.size for r in out)
    # half a document per transfer at most
    assert set(size) == set(range(8)) and all(abs(b - total / 8) <= 2 * largest for b in size.values())
    moved = sum(r.size for r in out if r.shard != r.old_shard)
    assert abs(moved - sum(max(0, b - total / 8) for b in old.values())) <= 8 * largest
    again = resharding.resharded(df.repartition(7))
    assert sorted(map(repr, layout_rows(again))) == sorted(repr((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.slot, r.grown_shard)) for r in out)


def test_layout_keeps_columns_and_untouched_blocks(spark):
    df = frame(spark, [(i, sentence(i, 20), str(i % 2)) for i in range(200)])
    out = resharding.reshard(df, F.col("source").cast("int"), 2, 3)
    assert sorted(map(repr, out.select("doc.*").collect())) == sorted(map(repr, df.collect()))
    files = out.select("shard", "old_shard", F.input_file_name().alias("f")).distinct().collect()
    assert all(r.shard == r.old_shard for r in files if "old-layout" in r.f) and any("old-layout" in r.f for r in files) and any("new-files" in r.f for r in files)
    fewer = resharding.reshard(df, F.col("source").cast("int"), 2, 1)
    assert {r.shard for r in fewer.select("shard").distinct().collect()} == {0} and fewer.count() == 200


# --- prefix trie

def brute_trie(rows):
    """rows of (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[c].append(((turn is not None, turn or 0), tie, (role, text)))
    turns = {c: [t for *_, t in sorted(x)] for c, x in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(turns.get(c - c % 20, [])[:h] + mine[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        cost = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += cost
    return sorted(repr((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                        hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())) for p, m in members.items())


def conversations_frame(spark, rows):
    names = "key int, head int, base int, parent int, rest int, family int, n int, least int, id int"
    return spark.createDataFrame([(*r, *[7] * 9) for r in rows], f"conv_id long, turn long, role string, text string, {names}")


@pytest.fixture(scope="module")
def talks():
    r = random.Random(6)
    rows = []
    for c in range(120):
        rows += [(c, t, r.choice(["user", "assistant"]), f"say {r.randint(0, 2)} \n\tmore") for t in range(r.randint(1, 6))]
    rows += [(c, t, "user", f"copy {t}") for c in range(1000, 1100) for t in range(5)]
    rows += [(2000 + k, t, "user", f"deep {t}" if t < 60 + k else f"tail {k}") for k in range(6) for t in range(70)]
    rows += [(3001, None, "a", "first"), (3001, 0, None, None), (3001, None, None, "other"), (3002, 1, "a", "x"), (3002, 1, "a", "x"), (3002, 1, "b", "x"),
             (None, 0, "user", "lost"), (4007, 3, "", ""), (5000, 0, "u", "w " * 30000), (5001, 0, "u", "w " * 30000), (6019, 0, "user", "say 0"), (6011, 0, "ab", "c"), (6012, 0, "a", "bc")]
    return rows


@pytest.mark.parametrize("limit", [1, 60, 10 ** 6])
def test_trie_equals_brute_force(spark, talks, limit):
    got = burst_trie.trie(conversations_frame(spark, talks).repartition(3), limit)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_trie(talks)


def test_trie_of_nothing(spark, talks):
    empty = burst_trie.trie(conversations_frame(spark, talks[:1]).limit(0))
    assert empty.collect() == [] and empty.columns[0] == "conv_id"
    assert burst_trie.trie(conversations_frame(spark, [(None, 0, "a", "b")])).collect() == []


def test_ends_of_many_copies_pass_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(burst_trie, "CHUNK", 7)
    rows = [(c, 0, "u", "same") for c in range(200)]
    got = burst_trie.trie(conversations_frame(spark, rows), 10)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_trie(rows)
