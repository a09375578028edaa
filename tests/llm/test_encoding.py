"""Byte-pair encoding, id files and archives against the libraries and exact round trips."""
import base64
import hashlib
import io
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from keepwell.llm import bpe, dac, textblocks, warc
from tests.llm.fixtures import awkward, frame  # noqa: F401

RANKS, LIBRARY = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
PARTS = [" ", "a", "ing", "é", "ß", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "　", "1", "23", "½", "字", "😀", "'", "'s", "'LL", "...", "İ", "́", "\r\n",
         "\x00", "aaaaaaa", "==", "  ", "the", " \n ", "मस्ते", "ไทย", "<|endoftext|>"]


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n, parts=PARTS):
    r = random.Random(5)
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("parts", [PARTS, [p for p in PARTS if p not in ("\x85", "\xa0", " ", "　")]])
def test_replay_equals_tiktoken(parts):
    own, ref, t = bpe.Encoder(RANKS, P.PATTERN), reference(), [*texts(400, parts), "a" * 3000, "ab" * 700, "=" * 333, ""]
    ids, at = own.encode(pa.array(t))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ref.encode_ordinary(x) for x in t]
    assert [own.ranks.decode(ids[a:b]) for a, b in zip(at[:-1], at[1:])] == [x.encode() for x in t]


def test_memory_of_units_is_bounded():
    own, ref = bpe.Encoder(RANKS, P.PATTERN), reference()
    own.lookup.limit = 50
    for t in texts(60, ["alpha", " beta", " gamma", " d", "e"]):
        assert own.encode(pa.array([t]))[0].tolist() == ref.encode_ordinary(t)
    assert len(own.lookup.keys) < 200


def test_words_are_replayed_in_pieces(monkeypatch):
    ref, t = reference(), [*texts(200), "ab" * 700, ""]
    monkeypatch.setattr(bpe, "REPLAYED", 40)
    monkeypatch.setattr(bpe, "PAIRS", 3)
    monkeypatch.setattr(textblocks, "PIECE", 16)
    ids, at = bpe.Encoder(RANKS, P.PATTERN).encode(pa.array(t))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ref.encode_ordinary(x) for x in t]


def test_memory_of_a_block_is_bounded():
    """One Arrow batch of 4 MB, nearly all words different: what numpy and Python hold at once."""
    bpe.ranks(RANKS)
    r = random.Random(7)
    rows = [" ".join("".join(r.choices("abcdefghijklmnop", k=r.randint(3, 9))) for _ in range(1_500)) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows)], names=["doc_id", "text"])
    run = bpe._digests(RANKS)(bpe._encoded(RANKS, P.PATTERN)(iter([batch])))
    bpe.encoder_of.cache_clear()
    tracemalloc.start()
    try:
        got = [x for b in run for x in b.column("decoded_sha256").to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == [hashlib.sha256(t.encode()).hexdigest() for t in rows]
    assert peak < 200 << 20, f"{peak >> 20} MB"


def test_round_trip_of_awkward_rows(spark, awkward):
    ref = reference()
    got = bpe.round_trip(awkward, RANKS, P.PATTERN).collect()
    rows = [(r.doc_id, r.text or "") for r in awkward.collect()]
    digest = lambda i, t: (i, len(x := ref.encode_ordinary(t)), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(digest(*r)) for r in rows)
    assert {bytes(r.bytes) for r in bpe.decode(bpe.encode(awkward, RANKS, P.PATTERN), RANKS).collect()} == {t.encode() for _, t in rows}
    assert bpe.round_trip(awkward.limit(0), RANKS, P.PATTERN).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 4000])
def test_any_id_and_any_span(n):
    r = np.random.RandomState(n)
    ids = r.randint(0, 100_000, n)
    ids[::3] %= 256
    f = dac.Reader(dac.packed([5, None], np.array([0, n // 2, n]), ids))
    assert f.doc_ids() == [5, None] and [f.id(i) for i in range(n)] == ids.tolist()
    for _ in range(20):
        a, b = sorted(r.randint(0, n + 1, 2))
        assert f.span(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(ValueError):
        dac.Reader(b"x" * 40)


def test_id_files(spark, awkward):
    t = Tokenizer.from_file(LIBRARY)
    got = dac.through_files(awkward, LIBRARY).orderBy("start").collect()
    rows = awkward.select("doc_id", "text").collect()
    ids = {(r.doc_id, r.text): t.encode(r.text or "", add_special_tokens=False).ids + [0] for r in rows}
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert sorted(repr((g.doc_id, g.n_tokens, g.ids_crc32)) for g in got) == sorted(repr((r.doc_id, len(ids[r.doc_id, r.text]), crc(ids[r.doc_id, r.text]))) for r in rows)
    order = [-1 if g.doc_id is None else g.doc_id for g in got]
    assert order == sorted(order) and [g.start for g in got] == np.cumsum([0, *(g.n_tokens for g in got)])[:-1].tolist()
    assert dac.through_files(awkward.limit(0), LIBRARY).count() == 0


def test_library_encoder_equals_the_library():
    t, own = Tokenizer.from_file(LIBRARY), dac.LibraryEncoder(LIBRARY)
    for x in texts(200):
        assert own.encode(pa.array([x]))[0].tolist() == t.encode(x, add_special_tokens=False).ids


def test_archives(spark):
    pages = [(1, "<p>a</p>"), (2, None), (3, ""), (4, "<p>a</p>"), (None, "<p>a</p>"), (None, "lone"), (4, "<p>a</p>"), (5, "é" * 200_000)] + [(i, f"<p>page {i}</p>" * 30) for i in range(10, 90)]
    got = warc.through_archives(frame(spark, pages, page=True)).collect()
    want = []
    for i, h in pages:
        same = [k for k, x in pages if (x or "") == (h or "") and k is not None]
        first = min(same) if same else None
        response = len([1 for _, x in pages if (x or "") == (h or "")]) == 1 or first is None or i == first
        want.append((i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), "response" if response else "revisit", None if response else first))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert warc.through_archives(frame(spark, [(1, "x")], page=True).limit(0)).count() == 0
    assert {r.record_type for r in warc.through_archives(frame(spark, [(1, "abc"), (2, "abc")], page=True), least=4).collect()} == {"response"}


def test_faulty_archives_are_refused():
    import zstandard

    good = warc.page_record(1, "http://x", b"abc", warc.base32_sha1(b"abc"), None, True)
    pack = zstandard.ZstdCompressor().compress
    assert [warc.page_of(*r)["page_id"] for r in warc.records(io.BytesIO(pack(good) * 3))] == [1, 1, 1]
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARD/1.1"), good.replace(b"WARC-Date", b"X-Date"), good + b"x", good.replace(b"WARC-Type: ", b"WARC-Type ")):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(pack(bad))))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(pack(good)[:-5])))
    with pytest.raises(ValueError):
        [warc.page_of(*r) for r in warc.records(io.BytesIO(pack(good.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"))))]
