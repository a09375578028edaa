"""Word boundaries and hashes of many texts at once, on the byte array of an Arrow column.

A hash is a polynomial over random byte values modulo 2**64, divided by the
power of its first position: prefix sums give the hash of any span at once.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator
from contextlib import suppress
from functools import cached_property

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
#: Elements that are gathered together.
PIECE = CHUNK >> 2
SPACES = b" \t\n\x0b\x0c\r"
BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(BASE, -1, 1 << 64)
#: White space outside ASCII; it can join the white space of the next unit.
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole word."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_power: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if base not in _power or len(_power[base]) < n:
        size = max(n, CHUNK + (CHUNK >> 2))
        p = np.full(size, base & _MASK, np.uint64)
        p[0] = 1
        made = np.cumprod(p, dtype=np.uint64)
        if size > 4 * CHUNK:
            return made[:n]
        _power[base] = made
    return _power[base][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-free hash of values[s:e] for every span; values are 64-bit."""
    n = len(values)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(BASE, n), out=prefix[1:], dtype=np.uint64)
    return (prefix[ends] - prefix[starts]) * powers(_INVERSE, n + 1)[starts]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offs, data = column.buffers()
    if len(column) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each, one row at least."""
    _, offsets = column_bytes(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def give_back() -> None:
    """Return what this worker has freed to the machine; workers outlive their tasks and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


class Words:
    """Words (runs without white space) of a block of texts.

    ``starts``/``ends`` are byte positions in ``raw``; words of text i are
    ``bounds[i]:bounds[i + 1]``; ``hashes`` holds one 64-bit value per word.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.raw = _LOWER[raw] if lower else raw
        raw = self.raw
        solid = ~_SPACE[raw]
        begin, end = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1]
        end[:-1] &= ~solid[1:]
        inner = offsets[(offsets > 0) & (offsets < len(raw))]
        begin[inner] = solid[inner]
        end[inner - 1] = solid[inner - 1]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.hashes = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Word hashes, computed over pieces of about CHUNK bytes cut between words."""
        out, n, w = np.empty(len(self.starts), np.uint64), len(self.starts), 0
        while w < n:
            low = self.starts[w]
            last = max(w + 1, int(np.searchsorted(self.ends, low + CHUNK, "right")))
            piece = self.raw[low : self.ends[last - 1]]
            out[w:last] = span_hashes(_BYTE[piece], self.starts[w:last] - low, self.ends[w:last] - low)
            w = last
        return mixed(out)

    @cached_property
    def _joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words with one space between them, and where each begins and ends there."""
        solid = ~_SPACE[self.raw]
        keep = solid.copy()
        after = self.ends[self.ends < len(self.raw)]
        keep[after] = True  # the space behind a word, or the next text's first byte
        place = np.cumsum(keep)
        joined = np.where(solid, self.raw, np.uint8(32))[keep].tobytes()
        return joined, place[self.starts] - 1, place[self.ends - 1]

    def text(self, i: int, j: int) -> bytes:
        """Words i..j-1 of one text joined by one space."""
        joined, starts, ends = self._joined
        return joined[starts[i] : ends[j - 1]]

    def texts(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """Words first..last (inclusive) of each pair, joined by one space."""
        joined, starts, ends = self._joined
        return [joined[a:b] for a, b in zip(starts[first].tolist(), ends[last].tolist())]


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive word hashes (length len - n + 1, or empty)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * np.uint64(BASE) + hashes[k : k + m]
    return mixed(out)


class Units:
    """A block of texts cut before every run of white space that follows a word.

    A unit is white space (if any) and the word behind it, so splitters whose
    tokens never reach over a word's end treat each unit on its own. ``code``
    numbers the different units, ``sample`` holds where each stands.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw = raw
        space = _SPACE[raw]
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[offsets[:-1][offsets[:-1] < len(raw)]] = True
        self.starts = np.flatnonzero(begin)
        self.ends = np.r_[self.starts[1:], len(raw)][: len(self.starts)]
        self.bounds = np.searchsorted(self.starts, offsets)
        self.hashes = np.empty(len(self.starts), np.uint64)
        w = 0
        while w < len(self.starts):
            low = self.starts[w]
            last = max(w + 1, int(np.searchsorted(self.ends, low + PIECE, "right")))
            piece = _BYTE[raw[low : self.ends[last - 1]]]
            self.hashes[w:last] = span_hashes(piece, self.starts[w:last] - low, self.ends[w:last] - low)
            w = last
        _, self.sample, self.code = np.unique(self.hashes, return_index=True, return_inverse=True)

    def exact(self) -> bool:
        """Whether every unit has the bytes of its sample: no two hashes met."""
        size = self.ends - self.starts
        same = self.sample[self.code]
        if not np.array_equal(size, size[same]):
            return False
        w = 0
        while w < len(size):  # in pieces, as a place takes eight times its byte
            last = max(w + 1, int(np.searchsorted(self.ends, self.starts[w] + PIECE, "right")))
            if not np.array_equal(self.raw[self.starts[w] : self.ends[last - 1]], gathered(self.raw, self.starts[same[w:last]], size[w:last])):
                return False
            w = last
        return True

    def bytes(self, which: np.ndarray) -> list[bytes]:
        """The units at the given places."""
        raw = self.raw.tobytes()
        return [raw[a:b] for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist())]


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[s : s + n] of every pair, one behind the other."""
    ends = np.cumsum(sizes)
    out = np.empty(ends[-1] if len(ends) else 0, flat.dtype)
    w = 0
    while w < len(ends):  # in pieces, as a place takes eight bytes
        low = ends[w] - sizes[w]
        last = max(w + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        begin = starts[w:last] - (ends[w:last] - sizes[w:last])
        out[low : ends[last - 1]] = flat[np.repeat(begin, sizes[w:last]) + np.arange(low, ends[last - 1])]
        w = last
    return out


class Lookup:
    """Ids of units met so far, found by hash and confirmed by their bytes.

    ``encode`` gets a list of new units and returns their ids, one behind the
    other, and how many each has. When more than ``limit`` are held, those met in
    one block only are forgotten.
    """

    def __init__(self, encode, limit: int):
        self.encode, self.limit = encode, limit
        self._forget()

    def _forget(self) -> None:
        self.keys, self.flat, self.raw = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.uint8)
        self.starts, self.sizes, self.places, self.lengths, self.met = (np.zeros(0, np.int64) for _ in range(5))

    def _shrink(self) -> None:
        keep = self.met > 1
        if 2 * keep.sum() > self.limit:
            return self._forget()
        flat, raw = gathered(self.flat, self.starts[keep], self.sizes[keep]), gathered(self.raw, self.places[keep], self.lengths[keep])
        self.keys, self.sizes, self.lengths, self.flat, self.raw = self.keys[keep], self.sizes[keep], self.lengths[keep], flat, raw
        self.starts, self.places = np.cumsum(self.sizes) - self.sizes, np.cumsum(self.lengths) - self.lengths
        self.met = np.zeros(len(self.keys), np.int64)

    def _row(self, keys: np.ndarray) -> np.ndarray:
        """Row of each known key, -1 for others."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def ids(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, offsets) of all texts of a block; None if two hashes met."""
        if len(self.keys) > self.limit:
            self._shrink()
        units = Units(raw, offsets)
        if not units.exact():
            return None
        keys, begin = units.hashes[units.sample], units.starts[units.sample]
        length = units.ends[units.sample] - begin
        row = self._row(keys)
        old, new = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
        k = row[old]
        if not np.array_equal(self.lengths[k], length[old]) or not np.array_equal(
                gathered(self.raw, self.places[k], self.lengths[k]), gathered(raw, begin[old], length[old])):
            return None
        if len(new):
            made, size = self.encode(units.bytes(units.sample[new]))
            order = np.argsort(np.concatenate([self.keys, keys[new]]))
            join = lambda x, y: np.concatenate([x, y])[order]
            self.starts = join(self.starts, len(self.flat) + np.cumsum(size) - size)
            self.places = join(self.places, len(self.raw) + np.cumsum(length[new]) - length[new])
            self.raw = np.concatenate([self.raw, gathered(raw, begin[new], length[new])])
            self.flat = np.concatenate([self.flat, made])
            self.keys, self.sizes = join(self.keys, keys[new]), join(self.sizes, size)
            self.lengths, self.met = join(self.lengths, length[new]), join(self.met, np.zeros(len(new), np.int64))
            row = self._row(keys)
        self.met[row] += 1
        row = row[units.code]
        size = self.sizes[row]
        return gathered(self.flat, self.starts[row], size), np.r_[0, np.cumsum(size)][units.bounds]
