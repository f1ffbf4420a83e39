import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lectern.llm import periodic
from lectern.llm.periodic import Catcher
from lectern.llm.queries import QUERIES
from lectern.llm.text import mix

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """Every maximal stretch of each period; the smallest period of a stretch stays."""
    n, least = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                least.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, length, q) for (s, length), q in least.items())


def caught(words, pieces=(None,)):
    catcher, at = Catcher(), 0
    words = mix(np.array(words, np.uint64))
    while at < len(words):
        size = pieces[at % len(pieces)] or len(words)
        catcher.append(words[at : at + size])
        at += size
    return [tuple(map(int, r)) for r in catcher.runs()]


def sequences():
    rng = np.random.default_rng(3)
    yield from ([], [1], [1] * 5, [1] * 6, [1] * 7, [1, 2] * 4, [1, 2] * 3 + [1], [1, 2, 3] * 4, [3, *[1, 1, 2] * 5, 4])
    for _ in range(400):
        yield rng.integers(0, rng.integers(1, 4), rng.integers(0, 80)).tolist()
    for _ in range(150):
        words = rng.integers(0, 3, 40).tolist()
        for _ in range(rng.integers(1, 4)):
            root = words[: rng.integers(1, 30)] if rng.random() < 0.5 else rng.integers(0, 2, rng.integers(1, 25)).tolist()
            words += root * int(rng.integers(2, 9)) + root[: rng.integers(0, len(root) + 1)]
        yield words
    # A root that begins and ends alike, so that blocks meet more than one copy.
    for size in (5, 9, 13, 17):
        root = [0, *range(1, size - 1), 0]
        yield (root + root[:-1]) * 5
        yield (root * 3 + [7]) * 5


def test_against_brute_force():
    for words in sequences():
        assert caught(words) == brute(words), words


def test_pieces_do_not_matter():
    for words in list(sequences())[::5]:
        assert caught(words, (1,)) == caught(words, (3, 1, 7)) == caught(words)


def test_new_runs_are_reported_when_they_are_caught():
    catcher = Catcher()
    news = [catcher.append(mix(np.array([w], np.uint64))).tolist() for w in [5, 1, 2, 1, 2, 1, 2, 1, 2, 1, 9]]
    assert sum(news, []) == [[1, 2]] and [1, 2] in sum(news[:8], [])
    assert catcher.runs().tolist() == [[1, 9, 2]]


def test_long_sequence_of_one_word_and_equal_sums(monkeypatch):
    n = 300_000
    assert caught([1] * n) == [(0, n, 1)]
    assert caught(list(range(1000)) * 300) == [(0, n, 1000)]
    # Sums that say "equal" for unequal words do not make a run longer.
    plain = Catcher._same
    monkeypatch.setattr(Catcher, "_same", lambda self, a, b, most, way: np.minimum(plain(self, a, b, most, way) + 2, most))
    words = [8, 9, *[1, 2, 3] * 6, 7, 6]
    assert caught(words) == brute(words)


def text_of(words, drop):
    return " ".join(w for k, w in enumerate(words) if k not in drop)


def expected(text):
    words = WORD.findall(text or "")
    found = brute(words)
    drop = {k for s, length, q in found for k in range(s + q, s + length)}
    return found, text_of(words, drop)


ODD = [None, "", " \n\t", "a", "a a a a a a", "x " * 5, "é é é é é é é", "a  b\ta\nb a b a b c", "a a a a a a b b b b b b", "\u2003 \u2003 a a a a a a", "q " * 200_000]


def test_texts(spark):
    rows = [(k, t, "n") for k, t in enumerate(ODD)] + [(4, ODD[4], "n")]
    df = spark.createDataFrame(rows, "id int, text string, runs string")
    got = df.repartition(2).select("id", "runs", periodic.periodic("text").alias("f")).collect()
    assert len(got) == len(rows)
    for r in got:
        found, collapsed = expected(ODD[r.id]) if r.id < len(ODD) - 1 else ([(0, 200_000, 1)], "q")
        assert [tuple(x) for x in r.f.runs] == found and r.f.collapsed == collapsed
    assert df.limit(0).select(periodic.periodic("text")).count() == 0


def test_batches_do_not_matter(monkeypatch):
    texts = pa.array(["a b " * k + "c" for k in range(40)] + ODD[:-1])
    whole = periodic._found(texts).to_pylist()
    monkeypatch.setattr("lectern.llm.text.runs.__defaults__", (64,), raising=False)
    assert [periodic._found(texts[k : k + 1]).to_pylist()[0] for k in range(len(texts))] == whole


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


@pytest.mark.parametrize("most", [700])
def test_query(spark, most):
    """Every document against brute force; longer ones than ``most`` words by a check of the runs themselves."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op12_periodic"](spark, FOLDER).collect()
    assert len(rows) == len(texts) and sum(r.n_runs > 0 for r in rows) > 5
    for r in rows:
        words = planted(r.doc_id, texts[r.doc_id])
        found = brute(words) if len(words) <= most else caught([zlib.crc32(w.encode()) for w in words])
        assert r.n_runs == len(found)
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        got = (r.start, r.length, r.period, r.exponent_milli)
        assert got == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        drop = {k for s, n, q in found for k in range(s + q, s + n)}
        assert r.collapsed_sha256 == hashlib.sha256(text_of(words, drop).encode()).hexdigest()
