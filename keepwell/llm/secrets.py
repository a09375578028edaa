"""Secret scan: marked secrets by pattern, unmarked ones by two character Markov models.

Patterns label what is surely a secret. Their values are the examples of random
strings; the other identifiers of the documents are the examples of ordinary ones. Each
set trains a first-order Markov model over 65 character classes. A run of 16 or
more identifier characters is a secret of kind ``random`` if its log-likelihood
ratio, random over ordinary, summed over its pieces between separators, is at least
LEAST_RATIO in all and LEAST_MEAN a letter or digit. Runs without a letter are
numbers or rules, not identifiers. Of a random run that a marked span touches, the
parts outside it are kept if they have LEAST_MEAN a character themselves.

The models are trained on all documents; they hold 2 x 66 x 65 counts, summed in the
tasks. Every text is scanned whole.

Edge cases: a null text is empty; without examples of
random strings their model is uniform, and patterns work as ever; rows with null or repeated ids
are scanned one by one; other columns are not read. Positions are code points, ends
exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.textblocks import give_back, slices

#: The patterns of marked secrets and the least lengths of their values.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "random")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Longer runs of characters are no identifiers, and would outweigh all others.
_IDENTIFIER = re.compile(r"\b[A-Za-z][A-Za-z0-9_]{5,39}\b", re.ASCII)
_BREAK = re.compile(r"[^A-Za-z0-9]")
_HINT = re.compile(r"[:=]")
CLASSES = 65
LEAST_RATIO, LEAST_MEAN, LEAST_SEGMENT = 20.0, 1.0, 14
#: Weight, in transitions, of the character frequencies in a state.
BACKOFF = 8.0
MASK = "[secret]"

SPACE = CLASSES + 1
_CLASS = np.full(128, CLASSES - 1, np.int64)
_CLASS[32] = SPACE
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-"):
    _CLASS[ord(_c)] = _i


def marked(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the pattern matches, by start and then kind."""
    found = []
    if _HINT.search(text):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def _values(text: str, spans: list[tuple[int, str, int]]) -> list[str]:
    """The secret part of every span."""
    return [ASSIGN.match(text, a)[2] if kind == "assign" else text[a:b] for a, kind, b in spans]


def steps(word: str) -> tuple[np.ndarray, np.ndarray]:
    """(class before, class) of every character; the state before the first is CLASSES."""
    c = _CLASS[np.frombuffer(word.encode("ascii"), np.uint8)]
    return np.r_[CLASSES, c[:-1]], c


class Ratio:
    """Log-likelihood ratio of two first-order models, smoothed by their character frequencies."""

    def __init__(self, random: np.ndarray, ordinary: np.ndarray):
        self.table = self._log(random) - self._log(ordinary)

    @staticmethod
    def _log(counts: np.ndarray) -> np.ndarray:
        """Log-probabilities; what a state has seen little of follows the frequency of the characters."""
        single = counts.sum(axis=0) + 1.0
        mixed = counts + BACKOFF * single / single.sum()
        return np.log(mixed / mixed.sum(axis=1, keepdims=True))

    def of(self, word: str) -> float:
        return float(self.table[steps(word)].sum())

    def secret(self, word: str) -> bool:
        return any(c.isalpha() for c in word) and self.summed(word) >= max(LEAST_RATIO, LEAST_MEAN * sum(map(len, _BREAK.split(word))))

    def summed(self, word: str) -> float:
        """The ratio over the pieces between separators."""
        return sum(self.of(piece) for piece in _BREAK.split(word) if piece)

    def leftover(self, part: str) -> bool:
        """Whether what a marked span leaves of a random run looks random as well."""
        n = sum(map(len, _BREAK.split(part)))
        return n > 0 and self.summed(part) >= LEAST_MEAN * n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Transition counts of a task: model, before, after, n."""
    counts = np.zeros((2, CLASSES + 1, CLASSES), np.int64)
    for batch in batches:
        for text in (x.as_py() for x in batch.column("text")):
            spans = marked(text or "")
            ordinary, at = [], 0
            for a, b in [*((s[0], s[2]) for s in spans), (len(text or ""), 0)]:
                if a > at:
                    # what could be a random secret itself is no example of an ordinary identifier
                    ordinary += [w for w in _IDENTIFIER.findall(text, at, a) if len(w) < LEAST_SEGMENT or w.isalpha()]
                at = max(at, b)
            for model, words in enumerate((_values(text, spans) if spans else [], ordinary)):
                if words:
                    before, after = steps(" ".join(words))
                    # a space ends one word and begins the next
                    before[before == SPACE] = CLASSES
                    real = after != SPACE
                    counts[model] += np.bincount(before[real] * CLASSES + after[real], minlength=counts[model].size).reshape(counts[model].shape)
    give_back()
    m, x, y = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(x), pa.array(y), pa.array(counts[m, x, y])], names=["m", "x", "y", "n"])


def train(docs: DataFrame) -> Ratio:
    """Both models from all documents; at most 2 x 66 x 65 counts reach the driver."""
    texts = docs.select("text").where("text is not null")
    counts = np.zeros((2, CLASSES + 1, CLASSES))
    for r in texts.mapInArrow(_counted, "m long, x long, y long, n long").groupBy("m", "x", "y").agg(F.sum("n").alias("n")).collect():
        counts[r["m"], r["x"], r["y"]] = r["n"]
    return Ratio(*counts)


def spans_of(text: str | None, ratio: Ratio) -> list[tuple[int, str, int]]:
    """All spans of a text: the marked ones, and random runs outside them."""
    if not text:
        return []
    base = marked(text)
    more = []
    for m in _RUN.finditer(text):
        touched = [(a, b) for a, _, b in base if a < m.end() and m.start() < b]
        parts, at = [], m.start()
        for a, b in touched:
            parts += [(at, a)] if a > at else []
            at = max(at, b)
        parts += [(at, m.end())] if at < m.end() else []
        if parts and ratio.secret(m[0]):
            more += [(a, "random", b) for a, b in parts if not touched or ratio.leftover(text[a:b])]
    return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[1])))


def masked(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with every span (overlapping ones as one) replaced by a mark."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join(out) + text[at:]


def _found(ratio: Ratio):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                got = [[{"kind": k, "start": a, "end": b} for a, k, b in spans_of(t.as_py(), ratio)] for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got, kind)], names=["doc_id", "found"])
        give_back()
    return run


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, found): the spans of every document, by start and then kind; no shuffle of texts."""
    return docs.select("doc_id", "text").mapInArrow(_found(train(docs)), "doc_id long, found array<struct<kind:string,start:int,end:int>>")


def _masked(ratio: Ratio):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t if t is None else masked(t, spans_of(t, ratio)) for t in (x.as_py() for x in batch.column("text"))]
                new = {"text": pa.array(texts, batch.schema.field("text").type)}
                if "n_chars" in batch.schema.names:
                    new["n_chars"] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(batch.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)
        give_back()
    return run


def mask_secrets(docs: DataFrame) -> DataFrame:
    """The documents with every secret replaced by a mark; the columns of the input."""
    return docs.mapInArrow(_masked(train(docs)), docs.schema)
