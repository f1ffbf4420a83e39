import re
from collections import Counter, defaultdict

import pytest

from lectern.llm import quality
from lectern.llm.queries import LINE_LIMIT, LEAST_KEPT, QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(hit)


def lowered(line):
    return " ".join(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), line)))


def brute(rows, limit, least):
    docs = defaultdict(int)
    for _, host, text in rows:
        for line in {lowered(x) for x in (text or "").split("\n")} - {""}:
            docs[host, line] += 1
    out = {}
    for key, host, text in rows:
        n = n_gone = 0
        for line in (text or "").split("\n"):
            k = len(WORD.findall(line))
            n += k
            n_gone += k * (docs[host, lowered(line)] > limit)
        out[key] = n - n_gone < least * n
    return out


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    depleted = brute([(d.doc_id, d.source, d.text) for d in docs], LINE_LIMIT, LEAST_KEPT)
    got = {r.doc_id: r for r in QUERIES["op7_quality"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r, want = got[d.doc_id], plain(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and r.kept == (not failed and not depleted[d.doc_id])


ROWS = [
    (1, "a", "Home  Page\nthis line is only here one\n x"), (2, "a", "home page\nanother text of its own"),
    (3, "a", "HOME\tPAGE\nhome page"), (4, "b", "home page"), (5, None, "home page\n\n"), (6, "a", None), (7, "a", " \n\t"),
    (8, None, "été # <b> ##|\nété # <b> ##|"), (9, "a", "a b c a b c a"),
]


@pytest.mark.parametrize("limit", [1, 2])
def test_limits_and_odd_rows(spark, limit):
    df = spark.createDataFrame(ROWS, "doc_id long, source string, text string").withColumn("line", df_lit())
    rows = quality.with_identity(quality.measured(df, "doc_id", "text", "source")).cache()
    assert {r.key: tuple(r[2:7]) for r in rows.collect()} == {k: plain(t) for k, _, t in ROWS}
    frequent = quality.frequent_lines(rows, limit)
    got = {r.key: r.depleted for r in quality.verdicts(rows, frequent, 0.5).collect()}
    want = brute(ROWS, limit, 0.5)
    assert all(got.get(k, False) == v for k, v in want.items())
    texts = {r.doc_id: r.clean for r in quality.without_lines(df, rows, frequent, "doc_id", "text", "clean").collect()}
    assert texts[1] == "this line is only here one\n x" and texts[3] == "" and texts[4] == "home page" and texts[6] is None


def df_lit():
    from pyspark.sql import functions as F

    return F.lit(1)


def test_repeated_rows_are_one_document_and_keyless_rows_are_apart(spark):
    """Five rows of one document do not make a line frequent; a row without a key does not decide for another."""
    data = [(1, "a", "same line\nown words of the first")] * 5 + [(2, "a", "same line\nother text")]
    data += [(None, "b", "menu")] * 2 + [(None, "b", "menu\na long line of its own with many words"), (3, "b", None)]
    df = spark.createDataFrame(data, "doc_id long, source string, text string")
    rows = quality.with_identity(quality.measured(df, "doc_id", "text", "source")).cache()
    frequent = quality.frequent_lines(rows, 2)
    assert {(r.host) for r in frequent.collect()} == {"b"} and frequent.count() == 1
    got = sorted((str(r.key), r.lines_removed, r.words_removed, r.depleted) for r in quality.verdicts(rows, frequent, 0.5).collect())
    assert got == [("1", 0, 0, False), ("2", 0, 0, False), ("None", 1, 1, False), ("None", 1, 1, True)]


def test_text_longer_than_a_run(spark):
    text = "one two three four\n" * 80_000 + "the end"
    rows = [tuple(r[2:7]) for r in quality.measured(spark.createDataFrame([(1, text, "a")], "k int, t string, h string"), "k", "t", "h").collect()]
    assert rows == [(320_002, 320_000 // 4 * 15 + 6, 0, 79_999, 320_000)]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    rows = quality.with_identity(quality.measured(df, "doc_id", "text", "source"))
    assert quality.verdicts(rows, quality.frequent_lines(rows, 1), 0.5).count() == 0
