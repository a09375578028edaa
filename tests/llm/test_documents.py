"""Document operators against brute force on awkward rows."""
import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from keepwell.llm import decontaminate, html_text, minhash, quality, secrets, substrings, toxicity
from tests.llm.fixtures import awkward, frame, sentence  # noqa: F401


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows_of(df, *columns):
    return sorted(repr(tuple(r)) for r in df.select(*columns).collect())


# --- quality rules

def test_base_counts(awkward):
    want = []
    for r in awkward.collect():
        t, w = r.text or "", words(r.text)
        grams = Counter(zip(w, w[1:], w[2:]))
        hit = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if words(x)]
        want.append((r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 2 * len(hit) > len(w)))
    got = rows_of(quality.base_counts(awkward), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted(map(repr, want))


def test_repeats_in_a_text(spark):
    t = "a b c a b c a b c " + sentence(7, 60)
    row = quality.base_counts(frame(spark, [(1, t, "h")])).first()
    assert row.n_repeat_words == 9 and not row.base_failed


def test_lines_above_the_limits(spark):
    line = "This line  stands\tin many documents"
    rows = [(i, f"{sentence(i, 60)}\n{line if i % 2 else line.upper()}\n{sentence(900 + i, 20)}", "h") for i in range(30)]
    rows += [(100, "\n".join([line] * 20) + "\n" + sentence(100, 55), "h"), (101, sentence(50, 70), None), (102, f"{sentence(51, 60)}\n{line}", "other")]
    rows += [(200 + i, sentence(60, 80), "h") for i in range(40)]  # copies are one text
    df = frame(spark, rows)
    got = {r.doc_id: r for r in quality.quality(df).collect()}
    assert got[0].n_lost_words == 0 and all(got[i].n_lost_words == 6 and got[i].kept for i in range(1, 30))
    assert got[100].n_lost_words == 120 and not got[100].kept and got[101].kept and got[102].n_lost_words == 0
    assert all(got[200 + i].kept for i in range(40))
    out = {r.doc_id: r for r in quality.apply_quality(df).collect()}
    assert out[1].text == f"{sentence(1, 60)}\n{sentence(901, 20)}" and out[1].n_chars == len(out[1].text) and out[0].text == rows[0][1]
    assert 100 not in out and len(out) == len(rows) - 1 and quality.apply_quality(df).columns == df.columns


def test_quality_of_awkward_rows(awkward):
    assert quality.quality(awkward).count() == awkward.count()
    kept = quality.apply_quality(awkward)
    assert kept.columns == awkward.columns
    assert rows_of(kept, "doc_id", "text") == sorted(repr((r.doc_id, r.text)) for r in awkward.collect() if len(words(r.text)) >= 50)
    assert quality.quality(awkward.limit(0)).count() == 0


# --- decontamination

def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def contained(docs, items):
    wins = {}
    for item, text in items:
        w = item_words(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            wins.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = []
    for d, text in docs:
        w, hit, found = item_words(text), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if (x := wins.get(tuple(w[i:i + k]))) is not None:
                    hit.update(range(i, i + k))
                    found |= x - {None}
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    return out


def test_contained_windows(spark, awkward):
    a, b = sentence(71, 25), sentence(72, 12)
    items = [(1, a), (2, b), (3, "Two Words"), (4, None), (5, "..."), (None, b), (2, b), (6, "ÄÉ ß one"), (7, "É ÀB"), (10, b)]
    bench = spark.createDataFrame([(*x, 1, 2) for x in items], "item_id long, text string, w int, win int")
    docs = [(20, f"{sentence(73, 5)} {a.upper()} x {b}"), (21, " ".join(a.split()[3:14])), (22, " ".join(a.split()[3:12])), (23, "say TWO, words two-words"), (24, "äé ß one ÄÉ ß ONE"), (25, " ".join([b] * 3))]
    df = frame(spark, [(i, t, "s") for i, t in docs]).unionAll(awkward)
    want = contained([(r.doc_id, r.text) for r in df.collect()], items)
    got = decontaminate.contained(df, bench)
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(map(repr, want))
    clean = decontaminate.drop_contaminated(df, bench)
    assert clean.columns == df.columns and clean.count() == sum(not w[-1] for w in want)
    assert decontaminate.contained(df, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contained(df.limit(0), bench).count() == 0


# --- near duplicates

def components(rows, n=2):
    def full(t):
        w = "".join(c.lower() if c.isascii() else c for c in t or "")
        w = words(w)
        return set() if not w else {tuple(w)} if len(w) < n else set(zip(*(w[k:] for k in range(n))))
    sets = [(i, full(t)) for i, t in rows]
    comp = {i: i for i, _ in sets if i is not None}
    changed = True
    while changed:
        changed = False
        for i, x in sets:
            for j, y in sets:
                if i is not None and j is not None and x and y and (i == j or 100 * len(x & y) >= 80 * len(x | y)) and comp[j] < comp[i]:
                    comp[i], changed = comp[j], True
    return [(i, len(x), comp.get(i), i is None or comp[i] == i) for i, x in sets]


@pytest.mark.parametrize("n, no_differences", [(2, False), (2, True), (5, False)])
def test_near_duplicates(spark, awkward, n, no_differences, monkeypatch):
    if no_differences:
        monkeypatch.setattr(minhash, "DIFFERENCE_PERCENT", 101)
    base = sentence(81, 100).split()
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    # a chain whose ends aren't similar, and many near copies of one text
    rows += [(1000 - i, " ".join(f"w{j}" for j in range(8 * i, 8 * i + 100))) for i in range(12)]
    rows += [(2000 + i, " ".join(base[:i] + ["new%d" % i] + base[i + 1:])) for i in range(0, 100, 3)]
    df = frame(spark, [(i, t, "s") for i, t in rows])
    want = components(rows, n)
    if n == 2:
        assert rows_of(minhash.near_duplicates(df, n), "doc_id", "n_shingles", "component_id", "kept") == sorted(map(repr, want))
    else:
        kept = minhash.keep_one(df, n)
        assert kept.columns == df.columns
        assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(i) for i in [*{i for i, _, c, _ in want if i is not None and i == c}, *(i for i, *_ in want if i is None)])


def test_no_documents(spark, awkward):
    assert minhash.near_duplicates(awkward.limit(0)).count() == 0


def test_estimate_follows_similarity(spark):
    r = np.random.RandomState(3)
    for share in (0.3, 0.6, 0.8, 0.95):
        both, own = int(4000 * share), int(4000 * (1 - share) / 2)
        x = r.randint(1, 1 << 62, both + 2 * own).astype(np.uint64)
        a, b = (minhash.planes(minhash.minima(s)[None]) for s in (x[: both + own], np.r_[x[:both], x[both + own:]]))
        row = lambda p: tuple(int(p[i][0, h]) for i in range(minhash.BITS) for h in range(minhash.K // 64))
        schema = ", ".join(f"{c} long" for c in minhash.PLANES)
        df = spark.createDataFrame([(row(a), row(b))], f"x struct<{schema.replace(' long', ': long')}>, y struct<{schema.replace(' long', ': long')}>")
        assert abs(df.select(minhash.estimate("x", "y").alias("e")).first().e - share) < 0.15


# --- repeated passages

def repeats(rows):
    first, out = {}, []
    rows = [(d, words(t)) for d, t in rows]
    order = lambda d, s: (-(1 << 63) if d is None else d, s)
    for d, w in rows:
        for s in range(len(w) - 19):
            k = tuple(w[s:s + 20])
            first[k] = min(first.get(k, order(d, s)), order(d, s))
    for d, w in rows:
        gone = {j for s in range(len(w) - 19) if first[tuple(w[s:s + 20])] != order(d, s) for j in range(s, s + 20)}
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_passages(spark, awkward, hot, monkeypatch):
    passage, line = sentence(91, 60), sentence(92, 10)
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    rows += [(300 + i, f"{sentence(300 + i, 15)} {passage}\n{sentence(400 + i, 25)} {line} {sentence(500 + i, 30)}") for i in range(25)]
    rows += [(400, " ".join(["again and"] * 40)), (401, " ".join(passage.split()[:19])), (402, passage.replace(" ", " \t\n")), (403, f"{passage} {passage}")]
    df = frame(spark, [(i, t, "s") for i, t in rows]).repartition(5)
    if hot:  # every minimiser is dealt by its windows
        monkeypatch.setattr(substrings, "frequent_minimisers", lambda docs: np.unique(np.concatenate([substrings._minimisers(substrings.Words(*substrings.column_bytes(pa.array([t or ""]))).hashes) for _, t in rows])))
    got = substrings.without_repeats(df)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_text") == sorted(map(repr, repeats(rows)))
    assert substrings.without_repeats(df.limit(0)).count() == 0


# --- secrets

def marked(text):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, k, b) for a, _, k, b in sorted(found)]


def test_a_large_batch_is_scanned_in_parts():
    ratio = secrets.Ratio(*np.ones((2, secrets.CLASSES + 1, secrets.CLASSES)))
    texts = [None, "", *[f"password=abcdef{i} " + "word " * 100_000 for i in range(6)], None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array([0] * len(texts))], names=["doc_id", "text", "n_chars"])
    for made in (secrets._found(ratio), secrets._masked(ratio)):
        parts = list(made(iter([batch])))
        assert max(p.num_rows for p in parts) < 6
        assert [i for p in parts for i in p.column("doc_id").to_pylist()] == list(range(len(texts)))
    want = [t and secrets.masked(t, secrets.spans_of(t, ratio)) for t in texts]
    assert [t for p in parts for t in p.column("text").to_pylist()] == want and "abcdef" not in want[2]
    assert [n for p in parts for n in p.column("n_chars").to_pylist()] == [None if t is None else len(t) for t in want]


def test_marked_secrets():
    import random

    r = random.Random(3)
    parts = ["token", "=", ":", " ", '"', "'", "api_key", "secret", "ſecret", "AKIA", "ABCDEF0123456789", "deadbeef", "0123456789abcdef", "x", "PassWord", ".", "é"]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert secrets.marked(t) == marked(t), t


def test_random_strings_are_told_from_identifiers(spark, awkward):
    import random

    r, letters = random.Random(4), "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    random_string = lambda n: "".join(r.choice(letters) for _ in range(n))
    plain = "the session counter returns configuration parameters identifier connection response handler document0 version2"
    rows = [(i, f"{plain} password={random_string(24)} token: '{random_string(32)}' {sentence(i, 40)}", "s") for i in range(80)]
    ratio = secrets.train(frame(spark, rows))
    assert sum(ratio.secret(random_string(28)) for _ in range(50)) >= 48
    assert not any(ratio.secret(w) for w in ("sessioncounterparameters2", "configuration_parameters_1", "responsehandlerconnection12", "documentidentifier2version"))
    df = frame(spark, [*rows, (500, f"see {'Zk9' + random_string(30)} there AKIA{'B' * 16}", "s")]).unionAll(awkward)
    got = {(x.doc_id, x.text): f for x, f in zip(df.collect(), secrets.scan(df).collect())}
    for (d, t), f in got.items():
        assert f.doc_id == d and [(s.start, s.kind, s.end) for s in f.found if s.kind != "random"] == marked(t or "")
        assert all(s.kind != "random" or not any(a < s.end and s.start < b for a, _, b in marked(t)) for s in f.found)
    assert any(s.kind == "random" for f in got.values() for s in f.found if f.doc_id == 500)
    out = secrets.mask_secrets(df)
    assert out.columns == df.columns
    assert all(x.text is None or (not marked(x.text) and x.n_chars == len(x.text)) for x in out.collect())
    assert secrets.scan(df.limit(0)).count() == 0


# --- extraction

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=/>home</a></nav>
<div class="cookie-notice">We use cookies, ok</div><div id=main><div class=post><h1>Real title of it</h1><p>One &lt;first&gt; paragraph, with commas,
and text&nbsp;that is long enough.<p>Another <b>bold <a href=x>link</a><br>here, with a few more words.<ul><li>an item<li>two items</ul><table><tr><td>cell a<td>cell b</table>
<form><input><p>subscribe, to our, newsletter please now</p></form><script>if (a < b) { document.write("<p>no</p>") }</script><!-- <p>none</p> -->
<blockquote>Quote &#8217;of&#8217; someone.</blockquote></div><div class="comments"><p>nice article, i like it, a lot, so much, yes</p></div><aside>side</aside></div><div class="sidebar"><p>more, more, more, more, more of this</p></div><footer>foot"""


def test_main_text():
    assert html_text.main_text(PAGE) == ("Real title of it One <first> paragraph, with commas, and text that is long enough. Another bold link here, with a few more words. "
                                         "an item two items cell a cell b Quote ’of’ someone.")
    assert html_text.main_text("<p>a</p>b<p>c") == "a b c" and html_text.main_text(None) == html_text.main_text("<!-- x") == html_text.main_text("<script>1<2</script>") == ""
    assert html_text.main_text("x < y & z &am") == "x < y & z &am"
    assert html_text.main_text("<div>" * 5000 + "deep text" + "</div>" * 9) == "deep text"


def test_extracted_pages(spark):
    rows = [(1, PAGE), (2, None), (3, ""), (None, "<p>é"), (1, PAGE), (4, "<p>" + "long, text " * 50_000)]
    got = html_text.extract(frame(spark, rows, page=True)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, f"http://x/{i}", t := html_text.main_text(h), len(t))) for i, h in rows)


def test_random_runs_of_every_form():
    import random
    import string

    g = random.Random(5)
    letters, rest = string.ascii_letters, string.digits
    random_words = ["".join(g.choice(letters + rest) for _ in range(40)) for _ in range(500)]
    counts = np.zeros((2, secrets.CLASSES + 1, secrets.CLASSES))
    for model, words in enumerate((random_words, [w for i in range(500) for w in sentence(i, 20).split() if w.isascii() and w.isalpha()])):
        for w in words:
            np.add.at(counts[model], secrets.steps(w), 1)
    ratio = secrets.Ratio(*counts)
    key = "-".join("".join(g.choice(letters + rest) for _ in range(6)) for _ in range(6))
    bare = "".join(g.choice(letters) for _ in range(40))
    for word in (key, bare, "3f2b8c1e-9d47-4a6b-b1c5-7e0f9a2d6c38"):
        assert secrets.spans_of(f"see {word} here", ratio) == [(4, "random", 4 + len(word))]
    # a marked span inside a random run leaves its rest a secret
    text = f"x {bare}/AKIA{'Q7' * 10}"
    assert secrets.masked(text, secrets.spans_of(text, ratio)).count(bare) == 0
    assert secrets.spans_of("1234567890123456 " + "-" * 20, ratio) == []


def test_models_count_all_documents(spark):
    docs = spark.range(40_000).selectExpr("id as doc_id", "'plainword' as text")
    seen = []

    class Kept(secrets.Ratio):
        def __init__(self, random, ordinary):
            seen.append(ordinary.sum())
            super().__init__(random, ordinary)

    own, secrets.Ratio = secrets.Ratio, Kept
    try:
        secrets.train(docs)
    finally:
        secrets.Ratio = own
    assert seen == [40_000 * len("plainword")]


# --- toxicity

def test_index_finds_the_nearest():
    r = np.random.RandomState(1)
    vectors = []
    for _ in range(500):
        at = sorted(r.choice(40, r.randint(1, 8), replace=False).tolist())
        w = r.rand(len(at))
        vectors.append((at, (w / np.sqrt((w * w).sum())).tolist()))
    index = toxicity.BlockMaxIndex(vectors, size=16)
    dense = np.zeros((500, 40))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    for i in range(60):
        cosine = dense @ dense[i]
        want = sorted((-round(c, 9), k) for k, c in enumerate(cosine) if c > 0 and k != i)[:10]
        assert [(-round(c, 9), k) for c, k in index.nearest(*vectors[i], 10, i)] == want or sorted(round(-c, 9) for c, _ in want) == sorted(round(c, 9) for c, _ in index.nearest(*vectors[i], 10, i))


def test_isotonic_steps():
    begins, values = toxicity.isotonic(np.array([1, 2, 3, 4, 4]), np.array([0, 1, 0, 1, 1.0]))
    assert begins.tolist() == [1, 2, 4] and values.tolist() == [0, 0.5, 1]


def test_held_out_accuracy(spark, awkward):
    import zlib

    rows = [(i, sentence(i, 60) + (" zonker muppetish" if i % 5 == 0 else ""), "s") for i in range(600)]
    labels = spark.createDataFrame([*((i, 1, int(i % 5 == 0), 3) for i in range(600)), (0, 1, 1, 3), (None, 1, 1, 3), (9999, 1, None, 3)], "doc_id long, quality int, toxic int, text int")
    df = frame(spark, rows).unionAll(awkward.selectExpr("doc_id + 5000 as doc_id", *awkward.columns[1:]))
    got = toxicity.toxicity(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    test = [r for r in got if r.held_out and r.doc_id < 600]
    assert len(test) > 100 and sum(r.predicted == (r.doc_id % 5 == 0) for r in test) >= 0.98 * len(test)
    assert all(r.evidence[0].toxic == 1 for r in test if r.predicted)
    assert {r.score for r in toxicity.toxicity(df, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(df.limit(0), labels).count() == 0


def test_texts_without_label_terms_are_searched(spark):
    # no term reaches MIN_DOCS examples: every toxic pair has a word of its own
    rows = [(i, sentence(i, 40) + (f" grumblor{chr(97 + i // 40)}x" if i % 20 < 2 else ""), "s") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 20 < 2)) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.toxicity(frame(spark, rows), labels).collect()
    assert all(len(r.evidence) == 3 and 0 < r.evidence[0].cosine <= 1 for r in got)
    assert len({r.score for r in got}) > 1
    assert [(r.doc_id, r.score, r.evidence) for r in sorted(got)] == [
        (r.doc_id, r.score, r.evidence) for r in sorted(toxicity.toxicity(frame(spark, rows).repartition(7), labels).collect())]


def test_blocks_below_the_threshold_are_left_out():
    r = np.random.RandomState(3)
    vectors = []
    for i in range(1200):
        at = np.unique(np.r_[i % 40, 40 + r.choice(400, 12)])
        w = np.where(at < 40, 6.0, 1.0)
        vectors.append((at, w / np.sqrt((w * w).sum())))
    index = toxicity.BlockMaxIndex(vectors, size=16)
    dense = np.zeros((1200, 440))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    for i in range(0, 1200, 30):
        cosine = np.round(dense @ dense[i], 12)
        cosine[i] = 0
        got = index.nearest(*vectors[i], 10, i)
        assert [round(c, 12) for c, _ in got] == sorted(cosine, reverse=True)[:10]
        assert all(cosine[k] == round(c, 12) for c, k in got)
    assert index.settled < 0.4 * 40 * 1200


def test_bounds_that_exclude_nothing_are_given_up():
    r = np.random.RandomState(5)
    vectors = []
    for _ in range(600):
        at = np.sort(r.choice(120, 40, replace=False))
        w = r.rand(40) + 0.5
        vectors.append((np.r_[at, 120 + r.randint(200)], np.r_[w, 2.0] / np.sqrt((w * w).sum() + 4)))
    index = toxicity.BlockMaxIndex(vectors)
    dense = np.zeros((600, 320))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    for turn in range(toxicity.RETRIED + 1):
        own = range(turn * 30, turn * 30 + 30)
        got = index.nearest_of([vectors[i] for i in own], 10, list(own))
        # bounds once, then whole products; then bounds are tried again
        assert index.whole == (toxicity.RETRIED - 1 - turn) % toxicity.RETRIED
        for i, near in zip(own, got):
            cosine = np.round(dense @ dense[i], 12)
            cosine[i] = 0
            assert [round(c, 12) for c, _ in near] == sorted(cosine, reverse=True)[:10]
            assert all(cosine[k] == round(c, 12) for c, k in near)


def test_words_are_the_letters_between_others():
    for text in ["", None, "One two_three 4x", "\u00c4rger \u00bd\u00b2x a\u0301b na\u00efve caf\u00e9s!", "\u039f\u0394\u039f\u03a3 \u4e2d\u6587x\u0663y \ud800z\u2003w\x85v", "I\u0130i"]:
        assert toxicity.words_of(text) == re.findall(r"[^\W\d_]+", (text or "").lower())


def test_scores_equal_a_plain_search(spark):
    rows = [(i, sentence(i % 170, 30 + i % 9) + (" zonker muppetish" if i % 5 == 0 else ""), "s") for i in range(240)]
    rows += [(7, "Another text of the seventh " + sentence(900, 20), "s"), (8, None, "s"), (9000, "1 2 3", "s"), (9001, "", "s")]
    label = {i: int(i % 5 == 0) for i in range(200)}
    docs = frame(spark, rows)
    got = toxicity.toxicity(docs, spark.createDataFrame(list(label.items()), "doc_id long, toxic int")).collect()

    def counted(t):
        return Counter(re.findall(r"[^\W\d_]+", (t or "").lower()))

    import zlib
    first = {}
    for i, t, _ in sorted((r for r in rows if r[1] is not None and r[0] in label and zlib.crc32(str(r[0]).encode()) % 4 != 2), key=lambda r: (r[0], label[r[0]], r[1])):
        first.setdefault(t, i)
    learned = sorted(((i, t) for t, i in first.items()), key=lambda e: (e[0], hashlib.md5(e[1].encode()).hexdigest()))
    bags, y = [counted(t) for _, t in learned], [label[i] for i, _ in learned]
    n, n_toxic = Counter(w for b in bags for w in b), Counter(w for b, v in zip(bags, y) if v for w in b)
    whole = [r[1] for r in rows if r[1] is not None]
    df = Counter(w for t in whole for w in counted(t))
    share = sum(y) / len(y)
    weight = {w: (np.log((1 + len(whole)) / (1 + df[w])) + 1) * (1 + max(0.0, (n_toxic[w] - c * share) / np.sqrt(c * share * (1 - share) + 1e-9) - toxicity.PLAIN_Z)) for w, c in n.items()}

    def vector(b):
        v = {w: (1 + np.log(c)) * weight[w] for w, c in b.items() if w in weight}
        size = np.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / size for w, x in v.items()}

    made = [vector(b) for b in bags]

    def vote(v, without=-1):
        cosine = [(sum(x * m.get(w, 0.0) for w, x in v.items()), k) for k, m in enumerate(made) if k != without]
        near = sorted(((-c, k) for c, k in cosine if c > 0))[:toxicity.K]
        return (sum(c * c * y[k] for c, k in near) + toxicity.PRIOR_WEIGHT * share) / (sum(c * c for c, _ in near) + toxicity.PRIOR_WEIGHT)

    votes = sorted((vote(v, k), y[k]) for k, v in enumerate(made))

    def calibrated(x):
        """Isotonic regression at x by its min-max form: the largest over beginnings of the smallest mean over ends."""
        at = [i for i, (v, _) in enumerate(votes) if v <= x + 1e-9]
        last = max(len(at) - 1, 0)
        sums = np.r_[0, np.cumsum([t for _, t in votes])]
        return max(min((sums[e] - sums[b]) / (e - b) for e in range(last + 1, len(votes) + 1)) for b in range(last + 1))

    texts = Counter((r[0], r[1]) for r in rows)
    assert len(got) == len(rows) and sum(texts.values()) == len(got)
    want = Counter((i, round(calibrated(vote(vector(counted(t)))), 6)) for i, t, _ in rows if counted(t))
    assert Counter((r.doc_id, round(r.score, 6)) for r in got if r.evidence) == want
    assert {r.doc_id for r in got if not r.evidence} == {8, 9000, 9001}
    assert all(set(r.terms) <= {"zonker", "muppetish"} for r in got) and any(r.terms for r in got)
