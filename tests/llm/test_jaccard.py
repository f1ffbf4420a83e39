import random
import re
from collections import defaultdict

import pytest

from lectern.llm import jaccard
from lectern.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width, percent):
    sets = []
    for _, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if len(words) < width:
            sets.append({tuple(words)} if words else set())
        else:
            sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)})
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    near = defaultdict(int)
    for own in holders.values():
        for i in range(len(own)):
            for j in range(i):
                near[own[i], own[j]] += 1
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)

    for (i, j), common in near.items():
        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            if rows[i][0] is not None and rows[j][0] is not None:
                join(rows[i][0], rows[j][0])
    return sorted(((k, len(s), None if k is None else find(k)) for (k, _), s in zip(rows, sets)), key=str)


def run(spark, rows, width, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in jaccard.jaccard_components(df, "doc_id", "text", width, percent).collect()), key=str)


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_query(spark):
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op6_ngram_jaccard"](spark, FOLDER).collect()), key=str)
    assert got == brute(rows, 4, 85)


@pytest.mark.parametrize("seed", [1, 2])
def test_large_groups(spark, monkeypatch, seed):
    """Many near copies of few texts around the threshold: long lists, several rounds of pivots."""
    monkeypatch.setattr(jaccard, "SMALL", 3)
    rng = random.Random(seed)
    texts = []
    for _ in range(4):
        base = [f"b{rng.randrange(400)}" for _ in range(rng.choice([60, 150]))]
        texts += [edited(rng, base, rng.randrange(0, 5)) for _ in range(40)]
        # A chain: each text differs from the one before.
        chain = base
        for _ in range(6):
            chain = edited(rng, chain, 1).split(" ")
            texts.append(" ".join(chain))
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 6))) for _ in range(30)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert run(spark, rows, 4, 85) == brute(rows, 4, 85)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (None, "one two"),
            (7, "a b c d e"), (7, "x y z"), (8, "X y\nz"), (9, "a b c d e"), (10, "a a a a a a a"), (11, "a a a a a")]
    assert run(spark, rows, 4, 85) == brute(rows, 4, 85)
    assert run(spark, rows[:1], 4, 85) == [(1, 0, 1)]
    df = spark.createDataFrame([], "doc_id long, text string, cls string, n string")
    assert jaccard.jaccard_components(df, "doc_id", "text", 5, 80).count() == 0
