"""Byte-level BPE by corpus merge replay.

The different words of a block of texts are laid out as one array of tokens. An
inverted index leads from each rank to the places where two neighbours
join to that token; the lowest rank present is applied at all its places at once,
and only the pairs beside a join are looked up again and enter the index. Words
don't influence each other, so the result doesn't depend on how texts are cut
into blocks, and blocks of bounded size keep memory bounded.

Edge cases: a null or empty text has no tokens; other columns are not read; rows
with null or repeated ids are encoded one by one.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from keepwell.llm.textblocks import WIDE_SPACE, Lookup, column_bytes, gathered, give_back, slices

#: Texts of about this many bytes are replayed together.
BLOCK = 2 << 20
#: Different words of about this many bytes are replayed together.
REPLAYED = 1 << 19
#: Pairs that are looked up together.
PAIRS = 1 << 16
#: Different units whose ids a worker remembers from block to block.
REMEMBERED = 400_000
ENCODED = "doc_id long, ids array<int>"


class Ranks:
    """A rank file: tokens, and for every pair that joins to a token its rank."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for t, r in self.rank.items():
            self.token[r] = t
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        keys, joined = [], []
        for t, r in self.rank.items():
            for cut in range(1, len(t)):
                a, b = self.rank.get(t[:cut]), self.rank.get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    joined.append(r)
        order = np.argsort(keys)
        self._keys, self._joined = np.array(keys, np.int64)[order], np.array(joined, np.int64)[order]
        # a token that is part of one with a lower rank: its joins can't be made all at once
        parts = np.r_[self._keys >> 32, self._keys & 0xFFFFFFFF]
        self.early = set(parts[parts > np.r_[self._joined, self._joined]].tolist())
        sizes = np.array([len(t) for t in self.token])
        self._sizes, self._starts = sizes, np.cumsum(sizes) - sizes
        self._bytes = np.frombuffer(b"".join(self.token), np.uint8)

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, -1 where they don't join."""
        if len(a) > PAIRS:
            return np.concatenate([self.joined(a[i : i + PAIRS], b[i : i + PAIRS]) for i in range(0, len(a), PAIRS)])
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._joined[at], -1)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids."""
        return gathered(self._bytes, self._starts[ids], self._sizes[ids]).tobytes()


@lru_cache(maxsize=4)
def ranks(path: str) -> Ranks:
    return Ranks(path)


def _apart(at: np.ndarray, after: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Of the places to join, in order, those that don't begin inside the join before."""
    mark[at] = True
    overlap = mark[after[at]].any()
    mark[at] = False
    if not overlap:
        return at
    taken, out = -1, []
    for p in at.tolist():
        if p != taken:
            out.append(p)
            taken = int(after[p])
    return np.array(out, np.int64)


def replay(words: list[bytes], r: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes) of every word, one behind the other: all merges in rank order over all words at once."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    token = r.byte[np.frombuffer(b"".join(words), np.uint8)]
    n = len(token)
    word = np.repeat(np.arange(len(words)), sizes)
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    after[ends[sizes > 0] - 1] = n
    before[(ends - sizes)[sizes > 0]] = -1
    live, mark = np.ones(n, bool), np.zeros(n + 1, bool)
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(left: np.ndarray) -> None:
        """Index the pairs that begin at the places ``left``."""
        rank = r.joined(token[left], token[after[left]])
        left, rank = left[rank >= 0], rank[rank >= 0]
        if not len(left):
            return
        order = np.argsort(rank, kind="stable")
        left, rank = left[order], rank[order]
        cut = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
        for k, lo, hi in zip(rank[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(rank)]):
            if k not in index:
                index[k] = []
                heapq.heappush(queue, k)
            index[k].append(left[lo:hi])

    enter(np.flatnonzero(after < n))
    while queue:
        k = heapq.heappop(queue)
        found = index.pop(k)
        at = np.sort(found[0] if len(found) == 1 else np.concatenate(found))
        at = at[live[at] & (after[at] < n)]
        at = at[r.joined(token[at], token[after[at]]) == k]
        at = at[np.r_[True, at[1:] != at[:-1]]] if len(found) > 1 and len(at) else at
        if not len(at):
            continue
        if k in r.early:
            # the first place of each word only; the others come again after pairs of lower rank
            first = np.r_[True, word[at][1:] != word[at][:-1]]
            if not first.all():
                index[k] = [at[~first]]
                heapq.heappush(queue, k)
            at = at[first]
        else:
            at = _apart(at, after, mark)
        gone = after[at]
        token[at] = k
        live[gone] = False
        follow = after[gone]
        after[at] = follow
        inner = follow < n
        before[follow[inner]] = at[inner]
        lead = before[at]
        mark[at] = True
        lead = lead[(lead >= 0) & ~mark[lead]]
        mark[at] = False
        enter(np.concatenate([at[inner], lead]))
    return token[live].astype(np.int32), np.bincount(word[live], minlength=len(words))


class Encoder:
    """Blocks of texts to ids; remembers the units that it has met."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.split = ranks(path), regex.compile(pattern)
        self.lookup = Lookup(self._units, REMEMBERED)

    def _words(self, fresh: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of different words: a word that is a token, else its replay."""
        whole = np.array([self.ranks.rank.get(w, -1) for w in fresh], np.int32)
        rest = np.flatnonzero(whole < 0)
        ends = np.cumsum([len(fresh[i]) for i in rest.tolist()])
        cuts = [0, *np.searchsorted(ends, np.arange(REPLAYED, ends[-1], REPLAYED)).tolist(), len(rest)] if len(rest) else []
        made = [replay([fresh[i] for i in rest[a:b].tolist()], self.ranks) for a, b in zip(cuts, cuts[1:])]
        sizes = np.ones(len(fresh), np.int64)
        sizes[rest] = np.concatenate([size for _, size in made]) if made else 0
        ids = np.repeat(whole, sizes)
        ids[np.repeat(whole < 0, sizes)] = np.concatenate([x for x, _ in made]) if made else 0
        return ids, sizes

    def _units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of units; Python objects are made of the different words only."""
        number: dict[str, int] = {}
        code, ends = array("q"), array("q")
        for u in units:
            code.extend([number.setdefault(w, len(number)) for w in self.split.findall(u.decode())])
            ends.append(len(code))
        ids, sizes = self._words([w.encode() for w in number])
        code, starts = np.array(code, np.int64), np.cumsum(sizes) - sizes
        bounds = np.r_[0, np.cumsum(sizes[code])][np.r_[0, np.array(ends, np.int64)]]
        return gathered(ids, starts[code], sizes[code]), np.diff(bounds)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of a column of texts."""
        raw, offsets = column_bytes(column)
        found = None if WIDE_SPACE.search(raw.tobytes()) else self.lookup.ids(raw, offsets)
        if found is None:
            ids, sizes = self._units([t or b"" for t in column.cast(pa.binary()).to_pylist()])
            return ids, np.r_[0, np.cumsum(sizes)]
        return found


@lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str) -> Encoder:
    """One encoder a worker process; what it remembers serves later tasks."""
    return Encoder(path, pattern)


def _encoded(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, pattern)
        for whole in batches:
            for batch in slices(whole, "text", BLOCK):
                ids, offsets = encoder.encode(batch.column("text"))
                lists = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "ids"])
        give_back()
    return run


def _digests(path: str):
    """Decimal and decoded digests of id sequences, from the ids alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = ranks(path)
        decimal = [str(i) for i in range(len(r.token))]
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for x in batch.column("ids"):
                ids = x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.zeros(0, np.int32)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join([decimal[i] for i in ids.tolist()]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(r.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the token ids of every text. ``path`` is a rank file that every worker can read."""
    return docs.select("doc_id", "text").mapInArrow(_encoded(path, pattern), ENCODED)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode every text and decode its ids, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _digests(path)(_encoded(path, pattern)(batches))
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text bytes) of encoded documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = ranks(path)
        for batch in batches:
            out = [r.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "bytes"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")
