"""The pipeline against a brute-force version of its five stages."""
import base64
import hashlib

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from keepwell.llm.tables import read, written
from tests.llm.fixtures import frame, sentence
from tests.llm.test_documents import components, contained, marked, words


def passes_quality(rows):
    """(id, text left) of the documents that stay; the fixtures hold no repeated three-word windows."""
    norm = lambda line: " ".join(words(line)).lower()
    lines, hosts = {}, {}
    for i, t, h in rows:
        hosts.setdefault(h, set()).add(t or "")
        for line in (t or "").split("\n"):
            if words(line):
                n, first = lines.setdefault((h, norm(line)), (set(), []))
                n.add(t)
                first.append(i)
    out = []
    for i, t, h in rows:
        keep = []
        for line in (t or "").split("\n"):
            n, first = lines.get((h, norm(line)), ((), []))
            ids = [x for x in first if x is not None]
            if not (words(line) and len(n) >= 20 and 100 * len(n) > 5 * len(hosts[h]) and (not ids or i != min(ids))):
                keep.append(line)
        left = len(words("\n".join(keep)))
        if len(words(t)) >= 50 and left >= 50 and 2 * left > len(words(t)):
            out.append((i, "\n".join(keep)))
    return out


def test_pipeline_equals_brute_force(spark, tmp_path, monkeypatch):
    item, line = sentence(700, 14), "a line that many documents of the host share"
    rows = [(i, f"{sentence(i, 70)}\n{line}\n{sentence(800 + i, 10)}", "h") for i in range(25)]
    rows += [(100 + i, " ".join(sentence(99, 200).split()[:200 - i]), "g") for i in range(4)] + [(120, sentence(99, 200), None)]
    rows += [(200, f"{sentence(200, 60)} {item}", "g"), (201, f"{sentence(201, 60)} password = 'hunter22abc' and {'0123456789abcdef' * 2} end", "g"),
             (202, None, None), (203, "", "g"), (204, sentence(204, 20), "g"), (None, sentence(205, 90), "h"), (5, f"{sentence(5, 70)}\n{line}\n{sentence(805, 10)}", "h")]
    folder = str(tmp_path)
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    left = passes_quality(rows)
    first = {(i, c) for i, _, c, _ in components(left, 5)}
    once = list(dict.fromkeys((i, t) for i, t in left if i is None or (i, i) in first))
    clean = [(i, t) for (i, t), c in zip(once, contained(once, [(1, item), (2, None)])) if not c[-1]]

    def mask(t):
        for a, _, b in reversed([s for s in marked(t)]):
            t = t[:a] + "[secret]" + t[b:]
        return t

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [(i, len(x := enc.encode_ordinary(mask(t))), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(mask(t).encode()).hexdigest()) for i, t in clean]

    seen = []
    monkeypatch.setattr(corpus_pipeline, "written", lambda df, name: (seen.append(df.columns), written(df, name))[1])
    assert sorted(map(repr, map(tuple, corpus_pipeline.run(spark, folder).collect()))) == sorted(map(repr, want))
    assert seen == [read(spark, folder, "documents").columns] * 4
    assert len(want) >= 20 and [n for n, _ in corpus_pipeline.STAGES][1] == "near duplicates"
