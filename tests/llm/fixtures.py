import random

import pytest

FOLDER = "/root/testdata/sf0.001"
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, words int, _id int, _key int, lines int, lost int, rep int, comp int, start int, doc int, runs int, own int, key int, t int, w int, c int, h int, tie int, digest int, first int, bucket int"


def frame(spark, rows, page=False):
    """Documents (or pages) with many columns whose names the operators use inside."""
    extra = [x.strip() for x in CLASHING.split(",")][5:]
    if page:
        schema = "page_id long, url string, html string, " + ", ".join(extra)
        return spark.createDataFrame([(i, f"http://x/{i}", h, *[7] * len(extra)) for i, h in rows], schema)
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *[7] * len(extra)) for i, t, s in rows], CLASHING)


def sentence(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklm") for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty, blank and long texts, repeated rows and ids, and clashing columns."""
    long_text = sentence(1, 30_000)
    rows = [(1, sentence(2, 120), "a"), (1, sentence(2, 120), "a"), (2, None, "a"), (3, "", None), (4, " \n\t ", None), (None, sentence(3, 80), "b"),
            (5, long_text, None), (6, "x" * 300_000, "b"), (7, sentence(2, 120), "a"), (8, sentence(4, 30) + "\n" + sentence(2, 120), "b"),
            (None, None, None), (9, "one", "a"), (10, "É ÀB ﬁ 　 ß\x00\x1c", "a"), (1, sentence(5, 70), "a"), (11, sentence(2, 119) + " tail", None)]
    return frame(spark, rows).cache()
