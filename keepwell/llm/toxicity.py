"""Toxicity by the nearest labelled examples.

A text's terms are its lower-cased words. Examples and texts are TF-IDF vectors over
the words of the examples, with idf over all documents. The idf of a word that goes
with the label among the examples is multiplied (``PLAIN_Z``): with plain idf the
nearest neighbours share a subject, not an insult. The cosines are exact over these
vectors.

The lists of rare words are walked. For frequent words, which hold most of the
postings, the index keeps the largest weight of every block of examples: what an
example got from the rare words, and the products of the frequent ones with the maxima
of its block (or the product of the lengths, if it is less), bound its cosine. The examples of the largest bounds are settled first;
of the others only blocks with an example whose bound reaches the k-th cosine found are
read, each once for all texts of a batch that need it. Similar examples
lie in one block, so that the bounds are tight. Where a batch had to read more than WHOLE
of the examples, the next ones multiply the frequent words of all examples without bounds
and the rare lists are walked as before. Bounds are single precision with room
for its rounding; the cosines that remain are added up again in double precision.
The nearest vote with the square of their
cosine against a prior; the votes are calibrated by isotonic regression on all
examples, each left out of its own vote.

Bound: the model is fitted on at most MAX_EXAMPLES labelled rows (those with the
smallest hash of doc_id). Everything else covers all rows and words: every text is
searched and scored whole.

Edge cases: a null text, or one without a word of the examples, gets the calibrated rate of such
examples; no labels at all give every text the score 0; of several labels of a doc_id the largest
counts; a null doc_id is not held out; equal texts among the examples count once, different texts
of one doc_id each; other columns are not read. ``terms`` lists the words of a text that go clearly with
the label (at least MIN_DOCS examples, z at least MIN_Z); they are no condition of the search.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.tables import written

MAX_EXAMPLES, MIN_DOCS, MIN_Z = 12_000, 5, 5.0
#: A term of this z weighs its idf; each unit above adds one idf.
PLAIN_Z = 2.0
K, BLOCK, PRIOR_WEIGHT, THRESHOLD = 25, 16, 0.5, 0.3
#: Words in more than this share of the examples are frequent; examples settled first, as a multiple of k; texts searched and texts counted at a time.
FREQUENT, FIRST, TEXTS, COUNTED = 1 / 20, 4, 256, 1024
#: Examples read, as a share, above which bounds cost more than they save; batches until they are tried again.
WHOLE, RETRIED = 0.25, 16
REMEMBERED = 400_000
_UNSEEN = -2
SCORED = "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,toxic:int>>, terms array<string>"
_WORD = re.compile(r"[^\W\d_]+")
#: Of bytes: ASCII characters but a-z become spaces.
_GAPS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[str]:
    """The lower-cased words of a text, all matches of ``_WORD``; only pieces with other characters than letters are matched."""
    lower = (text or "").lower()
    pieces = lower.encode("utf-8", "surrogatepass").translate(_GAPS).decode("utf-8", "surrogatepass").split()
    if lower.isascii() or "".join(pieces).isalpha():
        return pieces
    return [w for p in pieces for w in ((p,) if p.isalpha() else _WORD.findall(p))]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def examples(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES) -> DataFrame:
    """(k, doc_id, toxic, text) of the labelled rows to learn from; k names the text."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy(F.md5("text").alias("k")).agg(F.min(F.struct("doc_id", "toxic", "text")).alias("e")).select("k", "e.*")


def keys_of(terms: list[str]) -> np.ndarray:
    """64-bit keys, the same in every process."""
    return pd.util.hash_array(np.array(terms, object), categorize=False).view(np.int64) if terms else np.zeros(0, np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term key, docs, toxic docs) of a batch of examples."""
    for batch in batches:
        every, toxic = Counter(), Counter()
        for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            found = set(words_of(text))
            every.update(found)
            if y > 0:
                toxic.update(found)
        yield pa.RecordBatch.from_arrays([pa.array(keys_of(list(every))), pa.array(list(every.values()), pa.int64()),
                                          pa.array([toxic[t] for t in every], pa.int64())], names=["term", "n", "n_toxic"])


class Terms:
    """All words of the examples, by sorted keys, with their weights; turns texts into unit vectors."""

    def __init__(self, keys: np.ndarray, marked: np.ndarray, weight: np.ndarray | None = None):
        self.keys, self.marked, self.weight = keys, marked, weight
        self._known: dict[str, int] = {}
        self._names: dict[int, set[str]] = {}        # of marked terms

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}, "_names": {}}

    def learn(self, new: list[str]) -> np.ndarray:
        """Remember the numbers of words, -1 of one that no example has, and give them."""
        if len(self._known) > REMEMBERED:
            self._known.clear()
        keys = keys_of(new)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        found = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        numbers = np.where(found, at, -1)
        self._known.update(zip(new, numbers.tolist()))
        for i in np.flatnonzero(found & self.marked[at]).tolist() if len(self.keys) else ():
            self._names.setdefault(int(at[i]), set()).add(new[i])
        return numbers

    def numbers_of(self, words: dict[str, int]) -> np.ndarray:
        """The numbers of different words, -1 of one that no example has."""
        numbers = np.fromiter(map(self._known.get, words, repeat(_UNSEEN)), np.int64, len(words))
        unseen = numbers == _UNSEEN
        numbers[unseen] = self.learn(list(compress(words, unseen.tolist())))
        return numbers

    def counts_of(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(term, times) of every text, by ascending term."""
        # words are numbered among these texts first, so that each is looked up once
        own: dict[str, int] = defaultdict()
        own.default_factory = own.__len__
        counts = [Counter(words_of(t)) for t in texts]
        places = [np.fromiter(map(own.__getitem__, c), np.int64, len(c)) for c in counts]
        numbers, out = self.numbers_of(own), []
        for c, place in zip(counts, places):
            at, times = numbers[place], np.fromiter(c.values(), np.int64, len(c))
            order = np.argsort(at)
            order = order[np.searchsorted(at[order], 0):]
            out.append((at[order], times[order]))
        return out

    def marked_words(self, text: str | None, at: np.ndarray) -> list[str]:
        """The words of a text, with the terms ``at``, that go with the label."""
        names = [self._names[i] for i in at[self.marked[at]].tolist()]
        if any(len(n) > 1 for n in names):           # words of equal keys
            own = set(words_of(text))
            names = [n & own for n in names]
        return sorted(set().union(*names))

    def unit(self, at: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = (1 + np.log(times)) * self.weight[at]
        return at, raw / (np.sqrt((raw * raw).sum()) or 1.0)


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of several ranges, one range after another."""
    at = np.repeat(begin - np.cumsum(length) + length, length)
    at += np.arange(len(at))
    return at


class BlockMaxIndex:
    """Inverted lists of rare terms over examples, and block maxima of the frequent ones.

    ``vectors`` holds (ascending terms, positive weights) of every example; ``settled`` counts the examples
    whose frequent words were read, over all vectors searched for; ``whole`` the batches still to be searched without bounds.
    """

    def __init__(self, vectors: list, size: int = BLOCK, frequent: float = FREQUENT):
        self.n, self.settled, self.whole = len(vectors), 0, 0
        lengths = np.array([len(v[0]) for v in vectors], np.int64)
        row, begin = np.repeat(np.arange(self.n), lengths), np.cumsum(lengths) - lengths
        at = np.concatenate([np.asarray(v[0], np.int64) for v in vectors] or [np.zeros(0, np.int64)])
        own = np.concatenate([np.asarray(v[1], float) for v in vectors] or [np.zeros(0)])
        self.width = int(at.max()) + 1 if len(at) else 0
        df = np.bincount(at, minlength=self.width)
        # examples of the same strongest shared term lie together
        strongest = np.full(self.n, -1)
        if len(at):
            shared = np.where(df[at] > 1, own, 0.0)
            largest = np.zeros(self.n)
            largest[lengths > 0] = np.maximum.reduceat(shared, begin[lengths > 0])
            last = np.flatnonzero(shared == largest[row])
            last = last[np.r_[row[last][1:] != row[last][:-1], True]]
            strongest[row[last]] = at[last]
        self.example = np.argsort(strongest, kind="stable")
        self.place = np.empty(self.n, np.int64)
        self.place[self.example] = np.arange(self.n)
        self.starts = np.arange(0, self.n, size)
        self.spans = np.diff(self.starts, append=self.n)
        order = _ranges(begin[self.example], lengths[self.example])
        row, at, own = self.place[row][order], at[order], own[order]
        often = np.flatnonzero(df > max(size, self.n * frequent))
        self.column = np.full(self.width, -1, np.int32)
        self.column[often] = np.arange(len(often))
        column = self.column[at]
        often_in = column >= 0
        self.begin = np.searchsorted(row[often_in], np.arange(self.n + 1))
        self.columns, self.own = column[often_in], own[often_in]
        self.matrix = np.zeros((self.n, len(often)), np.float32)
        self.matrix[row[often_in], self.columns] = self.own
        self.most = np.maximum.reduceat(self.matrix, self.starts, axis=0) if self.n else self.matrix
        self.norm = np.sqrt((self.matrix ** 2).sum(axis=1))
        rare = np.flatnonzero(~often_in)
        rare = rare[np.argsort(at[rare], kind="stable")]
        self.rows, self.weights = row[rare].astype(np.int32), own[rare]
        self.length = np.where(self.column < 0, df, 0)
        self.first = np.cumsum(self.length) - self.length
        # no rounding of a sum of products, which is at most 1, is larger
        self.slack = 2.0 ** -22 * (len(often) + 64)

    def nearest(self, at: list[int], weights: list[float], k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k examples of largest cosine above 0, exactly: (cosine, example), ties by example."""
        return self.nearest_of([(at, weights)], k, [without])[0]

    def nearest_of(self, vectors: list, k: int, without: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """``nearest`` of several vectors; TEXTS of them share the reading of a block."""
        if len(vectors) > TEXTS:
            parts = [(vectors[i : i + TEXTS], without and without[i : i + TEXTS]) for i in range(0, len(vectors), TEXTS)]
            return [near for v, own in parts for near in self.nearest_of(v, k, own)]
        texts = []
        for at, w in vectors:
            at, w = np.asarray(at, np.int64), np.asarray(w, float)
            texts.append((at[at < self.width], w[at < self.width]))
        if not self.n:
            return [[] for _ in texts]
        part = np.zeros((len(texts), self.matrix.shape[1]), np.float32)
        for t, (at, w) in enumerate(texts):
            column = self.column[at]
            part[t, column[column >= 0]] = w[column >= 0]
        own = [self.place[i] if i >= 0 else -1 for i in without or [-1] * len(texts)]
        if self.whole:
            self.whole -= 1
            self.settled += len(texts) * self.n
            return [self._best(rough, self._rare(*text), *text, i, k) for rough, text, i in zip(part @ self.matrix.T, texts, own)]
        return self._bounded(texts, part, own, k)

    def _rare(self, at: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What every example gets from the rare words, term by term."""
        some = np.flatnonzero(self.length[at])
        if not len(some):
            return np.zeros(self.n)
        length = self.length[at[some]]
        inside = _ranges(self.first[at[some]], length)
        weights = self.weights.take(inside)
        weights *= np.repeat(w[some], length)
        return np.bincount(self.rows.take(inside), weights, self.n)

    def _best(self, rough: np.ndarray, rare: np.ndarray, at: np.ndarray, w: np.ndarray, own: int, k: int) -> list[tuple[float, int]]:
        """The k best of all examples, of which ``rough`` holds the products of the frequent words."""
        rough += rare
        if own >= 0:
            rough[own] = 0.0
        least = np.finfo(np.float32).tiny
        if self.n > k:
            least = max(least, np.partition(rough, self.n - k)[self.n - k] - 2 * self.slack)
        return self._exact(found := np.flatnonzero(rough >= least), rough[found], rare[found], at, w, k)

    def _bounded(self, texts: list, part: np.ndarray, own: list[int], k: int) -> list[list[tuple[float, int]]]:
        """The k best of every text; blocks whose bounds stay below its k-th cosine are left out."""
        rare = np.array([self._rare(at, w) for at, w in texts])
        rough = rare.astype(np.float32)
        # the rare words are in; the frequent ones add this at most
        more = np.repeat(part @ self.most.T, self.spans, axis=1)
        np.minimum(more, np.sqrt((part * part).sum(axis=1))[:, None] * self.norm, out=more)
        more += rough
        for t, i in enumerate(own):
            if i >= 0:
                more[t, i] = 0.0
        floor = np.zeros(len(texts), np.float32)
        if self.n > FIRST * k:
            for t, best in enumerate(np.argpartition(more, self.n - FIRST * k, axis=1)[:, self.n - FIRST * k:]):
                sums = rough[t, best] + self.matrix[best] @ part[t]
                sums[more[t, best] <= 0] = 0.0
                floor[t] = np.partition(sums, len(sums) - k)[len(sums) - k]
        least = np.maximum(floor - 2 * self.slack, np.finfo(np.float32).tiny)[:, None]
        possible = more >= least
        needed = np.logical_or.reduceat(possible, self.starts, axis=1)
        for j, (lo, n) in enumerate(zip(self.starts.tolist(), self.spans.tolist())):
            who = np.flatnonzero(needed[:, j])
            if len(who):
                rough[who, lo : lo + n] += part[who] @ self.matrix[lo : lo + n].T
        read = int((needed * self.spans).sum())
        self.settled += read
        if len(texts) >= BLOCK and read > WHOLE * len(texts) * self.n:
            self.whole = RETRIED - 1
        possible &= rough >= least
        return [self._exact(f := np.flatnonzero(possible[t]), rough[t, f], rare[t, f], *texts[t], k) for t in range(len(texts))]

    def _exact(self, found: np.ndarray, rough: np.ndarray, rare: np.ndarray, at: np.ndarray, w: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k best of the examples ``found``, of which the single-precision sums and what rare words add are known."""
        if len(found) > k:
            kept = rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - 2 * self.slack
            found, rare = found[kept], rare[kept]
        # added up term by term in one order
        query, column = np.zeros(self.matrix.shape[1]), self.column[at]
        query[column[column >= 0]] = w[column >= 0]
        length = self.begin[found + 1] - self.begin[found]
        inside = _ranges(self.begin[found], length)
        exact = rare + np.bincount(np.repeat(np.arange(len(found)), length), self.own[inside] * query[self.columns[inside]], len(found))
        names = self.example[found]
        order = np.lexsort((names, -exact))[:k]
        return [(float(exact[o]), int(names[o])) for o in order]


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (lowest x, value) of the non-decreasing fit to y over x."""
    steps: list[list[float]] = []
    at, group = np.unique(x, return_inverse=True)
    for v, s, n in zip(at.tolist(), np.bincount(group, y).tolist(), np.bincount(group).tolist()):
        steps.append([v, s, n])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            _, s, n = steps.pop()
            steps[-1][1] += s
            steps[-1][2] += n
    return np.array([s[0] for s in steps]), np.array([s[1] / s[2] for s in steps])


class Model:
    """Words, examples and votes; packed small enough to go to every worker."""

    def __init__(self, terms: Terms, names: list[str], doc: np.ndarray, y: np.ndarray, counts: list):
        """Examples by ascending doc_id and name, with (term, times) of each."""
        self.terms = terms
        with_terms = np.array([len(c[0]) > 0 for c in counts], bool)
        self.doc, self.y = doc[with_terms], y[with_terms]
        self.number = {k: i for i, k in enumerate(k for k, w in zip(names, with_terms) if w)}
        self.prior = float(y.sum()) / max(1, len(y))
        bare = y[~with_terms]
        self.bare = (float(bare.sum()) + self.prior) / (len(bare) + 1) if len(y) else 0.0
        # sent packed: differences of the ascending numbers, and times instead of weights
        kept = [c for c, w in zip(counts, with_terms) if w]
        self.sizes = [len(c[0]) for c in kept]
        self.packed = tuple(zlib.compress(np.concatenate(x).astype(np.int32), 1) for x in (
            [np.diff(c[0], prepend=0) for c in kept], [c[1] for c in kept])) if kept else ()
        self._index: BlockMaxIndex | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_index": None}

    @property
    def index(self) -> BlockMaxIndex:
        if self._index is None:
            cuts = np.cumsum(self.sizes)[:-1]
            at, times = (np.split(np.frombuffer(zlib.decompress(x), np.int32), cuts) for x in self.packed)
            self._index = BlockMaxIndex([self.terms.unit(np.cumsum(a), t) for a, t in zip(at, times)])
        return self._index

    def _vote(self, near: list[tuple[float, int]]) -> float:
        pull = [c * c for c, _ in near]
        return (sum(p * int(self.y[i]) for p, (_, i) in zip(pull, near)) + PRIOR_WEIGHT * self.prior) / (sum(pull) + PRIOR_WEIGHT)

    def votes(self, names: list[str], texts: list[str]) -> list[float]:
        """The votes on examples with terms, each left out of its own."""
        units = [self.terms.unit(*c) for c in self.terms.counts_of(texts)]
        return [self._vote(near) for near in self.index.nearest_of(units, K, [self.number[k] for k in names])]

    def scores(self, texts: list[str | None], steps: tuple[np.ndarray, np.ndarray] | None) -> list[tuple[float, list[dict], list[str]]]:
        """Calibrated score, the nearest examples and the words that go with the label, of every text."""
        if steps is None:
            return [(float(self.bare), [], []) for _ in texts]
        begins, values = steps
        counts, out = self.terms.counts_of(texts), []
        for text, c, near in zip(texts, counts, self.index.nearest_of([self.terms.unit(*c) for c in counts], K)):
            if not near:
                out.append((float(self.bare), [], []))
                continue
            value = float(values[max(0, int(np.searchsorted(begins, self._vote(near), "right")) - 1)])
            out.append((min(1.0, max(0.0, value)), [{"doc_id": int(self.doc[i]), "cosine": min(1.0, c), "toxic": int(self.y[i])} for c, i in near[:3]],
                        self.terms.marked_words(text, c[0])))
        return out


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts that bound the words held at a time."""
    for i in range(0, batch.num_rows, COUNTED):
        yield batch.slice(i, COUNTED)


def _document_counts(docs: DataFrame, terms: Terms) -> tuple[int, np.ndarray]:
    """Number of documents with a text, and of those with each term."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = sent.value, 0
        seen = np.zeros(len(known.keys), np.int64)
        for batch in (p for b in batches for p in _parts(b)):
            texts = batch.column("text").drop_null().to_pylist()
            total += len(texts)
            found = Counter()
            for text in texts:
                found.update(set(words_of(text)))
            at = known.numbers_of(found)
            seen[at[at >= 0]] += np.fromiter(found.values(), np.int64, len(found))[at >= 0]
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[total, seen[at]])], names=["term", "n"])

    got = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    sent.destroy()
    at, n = got["term"].to_numpy(), got["n"].to_numpy()
    counts = np.zeros(len(terms.keys), np.int64)
    counts[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), counts


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Broadcast, tuple[np.ndarray, np.ndarray] | None]:
    """Weigh the terms, send the examples to the workers and calibrate on all of them: (model, steps)."""
    rows = written(examples(docs, labels), "examples")
    total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") > 0).cast("int")), F.lit(0))).first()
    if not total:
        none = np.zeros(0, np.int64)
        return rows.sparkSession.sparkContext.broadcast(Model(Terms(none, none), [], none, none, [])), None
    counts = (rows.select("text", "toxic").mapInArrow(_counted, "term long, n long, n_toxic long")
              .groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic")).toArrow())
    keys, n, n_toxic = (counts[c].to_numpy() for c in ("term", "n", "n_toxic"))
    order = np.argsort(keys)
    keys, n, n_toxic = keys[order], n[order], n_toxic[order]
    share = toxic / total
    z = (n_toxic - n * share) / np.sqrt(n * share * (1 - share) + 1e-9)
    terms = Terms(keys, (n >= MIN_DOCS) & (z >= MIN_Z))
    documents, frequency = _document_counts(docs, terms)
    terms.weight = (np.log((1 + documents) / (1 + frequency)) + 1) * (1 + np.maximum(0, z - PLAIN_Z))
    sent = rows.sparkSession.sparkContext.broadcast(terms)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in _parts(b)):
            got = sent.value.counts_of(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("doc_id"), pa.array([int(t.as_py() > 0) for t in batch.column("toxic")], pa.int32()),
                 pa.array([g[0].astype(np.int32) for g in got], pa.list_(pa.int32())), pa.array([g[1].astype(np.int32) for g in got], pa.list_(pa.int32()))],
                names=["k", "doc_id", "toxic", "at", "times"])

    fitted = rows.mapInArrow(counted, "k string, doc_id long, toxic int, at array<int>, times array<int>").toArrow()
    sent.destroy()
    names, doc, y = fitted["k"].to_pylist(), fitted["doc_id"].to_numpy(), fitted["toxic"].to_numpy().astype(np.int64)
    found = [pair for at, times in zip(fitted["at"].chunks, fitted["times"].chunks) for pair in zip(_split(at), _split(times))]
    order = np.lexsort((np.array(names), doc))
    sent = rows.sparkSession.sparkContext.broadcast(Model(terms, [names[i] for i in order], doc[order], y[order], [found[i] for i in order]))
    return sent, _steps(sent, rows)


def _split(chunk: pa.ListArray) -> list[np.ndarray]:
    """The rows of a list column without Python values."""
    return np.split(chunk.flatten().to_numpy(zero_copy_only=False), np.cumsum(chunk.value_lengths().to_numpy(zero_copy_only=False))[:-1]) if len(chunk) else []


def _steps(sent: Broadcast, rows: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Isotonic steps over the votes on all examples that have terms, cast in the tasks."""

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in _parts(b)):
            got = [(k, t, int(y > 0)) for k, t, y in zip(*(batch.column(c).to_pylist() for c in ("k", "text", "toxic"))) if k in sent.value.number]
            yield pa.RecordBatch.from_arrays([pa.array(sent.value.votes([g[0] for g in got], [g[1] for g in got]), pa.float64()),
                                              pa.array([g[2] for g in got], pa.int32())], names=["vote", "toxic"])

    votes = rows.select("k", "text", "toxic").mapInArrow(cast, "vote double, toxic int").toArrow()
    return isotonic(votes["vote"].to_numpy(), votes["toxic"].to_numpy().astype(float)) if votes.num_rows else None


def _scored(sent: Broadcast, steps):
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in _parts(b)):
            got = sent.value.scores(batch.column("text").to_pylist(), steps)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], kind), pa.array([g[2] for g in got], pa.list_(pa.string()))],
                names=["doc_id", "score", "evidence", "terms"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (nearest examples) and terms of every document."""
    scored = docs.select("doc_id", "text").mapInArrow(_scored(*fit(docs, labels)), SCORED)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence", "terms")
