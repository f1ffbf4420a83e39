import collections
import random
import re
import zlib

import numpy as np
import pytest

from lectern.llm import spelling
from lectern.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def one_off(a, b):
    """Exactly one insertion, deletion or replacement."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k:] == b[k + 1 :] or (len(a) == len(b) and a[k + 1 :] == b[k + 1 :])


def brute_near(words):
    """Near words by the texts that one deletion leaves, checked one by one."""
    left = collections.defaultdict(set)
    for w in words:
        for k in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            left[k].add(w)
    near = collections.defaultdict(set)
    for group in left.values():
        for a in group:
            near[a] |= {b for b in group if one_off(a, b)}
    return near


def brute(counts):
    near = brute_near(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] is not None else None)
    return out


def vocabulary(n=600, seed=5):
    rng, counts = random.Random(seed), {}
    for alphabet in ("ab", "abcdé", "xyz漢😀"):
        for _ in range(n):
            w = "".join(rng.choices(alphabet, k=rng.randint(1, 9)))
            counts[w] = rng.choice([1, 1, 2, 3, 4, 9, 50])
    base = "internationalisation"
    for k in range(len(base)):
        counts[base[:k] + base[k + 1 :]] = k + 1
        counts[base[:k] + "é" + base[k:]] = 3
    counts["z" * 3000] = 5
    counts["z" * 1400 + "y" + "z" * 1600] = 20
    return counts


def check(spark, counts, **conf):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: tuple(r)[1:] for r in spelling.forms(df).collect()}
    assert got == brute(counts)


def test_against_brute_force(spark):
    check(spark, vocabulary())


def test_many_shards_and_parts(spark, monkeypatch):
    """Small shards: halves that many words share lie in several, and a shard answers in several parts."""
    monkeypatch.setattr(spelling, "SHARD", 2500)
    monkeypatch.setattr(spelling, "QUERIES", 100)
    monkeypatch.setattr(spelling, "BLOCK", 37)  # also the states kept before equal ones are merged
    monkeypatch.setattr(spelling, "BOUND", 3)
    check(spark, vocabulary())


def test_index_ranks():
    words = ["banana", "ananas", "nab", "b"]
    index = spelling.Index(*spelling._codes(words))
    text = "$" + "$".join(words) + "$"
    order = [len(text), *sorted(range(len(text)), key=lambda k: text[k:].replace("$", "\x01"))]
    assert index.suffixes.tolist() == order
    for part in ("an", "nan", "$b", "x", "a$"):
        low, high = np.array([0]), np.array([len(text) + 1])
        for c in reversed(part):
            code = np.array([1]) if c == "$" else index.encode(np.array([ord(c)]))
            low, high = index.extend(code, low, high)
        assert high[0] - low[0] == sum(text.startswith(part, k) for k in range(len(text))), part


def test_exact_half_limits_the_search():
    """No interval is opened for words that share neither half: work follows the near words."""
    words = [f"{a}{b}{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    index = spelling.Index(*spelling._codes(words))
    opened = []
    plain = index.branches
    index.branches = lambda low, high: opened.append(len(low)) or plain(low, high)
    of, near = spelling.one_edit(index, *spelling._codes(words), np.full(len(words), 2))
    assert len(of) == 0 and sum(opened) <= 3 * len(words)


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [("abcde", 3, 1), ("abcde", 4, 1), ("", 9, 1), (None, 9, 1), ("abcd", 99, 1), ("xbcde", 14, 1)], "word string, n int, root int"
    )
    got = {r.word: tuple(r)[1:] for r in spelling.forms(df).collect()}
    assert got == {"abcde": ("abcd", "abcd", 7, 2, 99), "abcd": (None, "abcd", 99, 1, None), "xbcde": (None, "xbcde", 14, 1, None)}
    assert spelling.forms(df.limit(0)).count() == 0


def test_chains_and_ties(spark):
    counts = {"aaaa" + "b" * k: 2**k for k in range(12)} | {"mmmmm": 1, "mmmmz": 2, "mmmma": 2, "qqqqq": 5, "qqqqr": 9}
    check(spark, counts)


def damaged(doc_id, text):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        if h % 97 == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1 :]
        yield run


@pytest.mark.parametrize("folder", [FOLDER])
def test_query(spark, folder):
    counts = collections.Counter()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        counts.update(damaged(r.doc_id, r.text))
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    got = {r.word: tuple(r)[1:] for r in QUERIES["op13_spelling"](spark, folder).collect()}
    assert len(got) > 100 and any(r[0] for r in got.values())
    assert got == brute(counts)
