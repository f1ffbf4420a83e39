import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from lectern.llm import toxicity as tox
from lectern.llm.queries import QUERIES
from lectern.llm.text import runs

FOLDER = "/root/testdata/sf0.1"


def test_held_out(spark):
    """Of all held-out rows labelled toxic nine in ten are found, in each language; texts labelled clean are left alone."""
    docs = {d.doc_id: d for d in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = QUERIES["op3_toxicity"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    wrong, hit, toxic = 0, Counter(), Counter()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.held_out and label.get(r.doc_id) == 0:
            wrong += r.predicted
        if r.held_out and label.get(r.doc_id) == 1:
            toxic[docs[r.doc_id].lang] += 1
            hit[docs[r.doc_id].lang] += r.predicted
    clean = sum(1 for r in rows if r.held_out and label.get(r.doc_id) == 0)
    assert wrong <= 0.01 * clean and sum(toxic.values()) > 100
    assert all(hit[lang] >= 0.9 * n for lang, n in toxic.items() if n >= 10) and sum(hit.values()) >= 0.9 * sum(toxic.values())
    by_text = {}
    for r in rows:
        assert by_text.setdefault(docs[r.doc_id].text or "", r.score) == r.score


def test_one_insult_counts():
    """Also where the labelled texts hold dozens, and next to typographic quotes; unless clean texts hold it as well."""
    rng = np.random.default_rng(4)
    texts, labels = made(rng, 600)
    texts = [" ".join([*tox.LEXICON[:12], t]) if y else t + (" clown" if k % 3 else "") for k, (t, y) in enumerate(zip(texts, labels))]
    model = tox.learn(pa.array(texts), np.array(labels), 0.1)
    run = next(runs(pa.array(["an idiot here", "an “idiot” here", "«vermin»—here", "a clown here", "nobody here"])))
    score = model.score(run)
    assert (score[:3] >= 0.3).all() and (score[3:] < 0.3).all()


def test_two_words_with_one_beginning():
    rng = np.random.default_rng(5)
    word = lambda stem: stem + "".join(rng.choice(list("abcdefgh"), 5))
    # Every text has one word with the beginning, the toxic ones have two.
    texts = [" ".join([word("qu"), *[word("zorbl") for _ in range(1 + y)], word("qu")]) for y in [0, 0, 0, 1] * 100]
    model = tox.learn(pa.array(texts), np.array([0, 0, 0, 1] * 100), 0.25)
    score = model.score(next(runs(pa.array(["zorblixa quapp zorblonu", "zorblixa quapp zorblixa", "zorblixa quapp"]))))
    assert score[0] > 0.5 and (score[1:] < 0.3).all()


def test_long_text_equals_its_parts_and_repeated_rows(spark):
    texts, labels = made(np.random.default_rng(1), 600)
    df = spark.createDataFrame([(k % 590, t, y, "x") for k, (t, y) in enumerate(zip(texts, labels))], "doc_id long, text string, toxic int, score string")
    model = tox.fit(df, "doc_id", "text", "toxic")
    long_text = "plain words and more " * 70_000  # longer than a run
    more = spark.createDataFrame([(1, long_text + "grumplixy"), (2, long_text), (2, long_text), (3, "plain words and more")], "doc_id long, text string")
    got = {(r.doc_id, r.s) for r in more.select("doc_id", tox.toxicity(model, more["text"]).alias("s")).collect()}
    score = dict(got)
    assert len(got) == 3 and score[1] > 0.3 > score[2] == score[3]


def test_fit_on_more_rows_than_a_slice(spark, monkeypatch):
    """A label whose rows are selected slice by slice gives the model that one slice gives."""
    texts, labels = made(np.random.default_rng(6), 600)
    df = spark.createDataFrame([(k, t, y) for k, (t, y) in enumerate(zip(texts, labels))], "doc_id long, text string, toxic int")
    whole = tox.fit(df, "doc_id", "text", "toxic", per_class=150)
    cuts, plain = [], tox.first_n_per_key
    monkeypatch.setattr(tox, "first_n_per_key", lambda *given: cuts.append(1) or plain(*given, slice_rows=40))
    sliced = tox.fit(df, "doc_id", "text", "toxic", per_class=150)
    assert cuts and len(whole.features) and (sliced.features == whole.features).all()
    assert (sliced.weights == whole.weights).all() and sliced.bias == whole.bias


def made(rng, n):
    texts, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(500)}x" for _ in range(30)]
        if i % 3 == 0:
            words[int(rng.integers(30))] = ["grumplex", "grumplon", "grumplar", "zorkish"][int(rng.integers(4))]
        texts.append(" ".join(w.replace("0", "a").replace("1", "b").replace("2", "c").replace("3", "d").replace("4", "e")
                              .replace("5", "f").replace("6", "g").replace("7", "h").replace("8", "i").replace("9", "j") for w in words))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_beginnings_are_learned_and_unseen_endings_found():
    texts, labels = made(np.random.default_rng(1), 600)
    model = tox.learn(pa.array(texts), np.array(labels), 1 / 3)
    run = next(runs(pa.array(["a grumplixy here", "a Zorkish one", "a plain text", "", None, "you idiot"])))
    score = model.score(run)
    assert (score[:2] > 0.5).all() and (score[2:5] < 0.3).all()


def test_label_model_sees_correlated_votes_once():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.3
    one, two = [np.where(rng.random(4000) < 0.8, truth, rng.random(4000) < 0.3) for _ in range(2)]
    copies = np.stack([one, one, one, two], axis=1).astype(np.float32)
    given = np.full(4000, np.nan)
    given[:400] = truth[:400]
    p = tox.label_model(copies, given, 0.3)
    apart = tox.label_model(np.stack([one, two], axis=1).astype(np.float32), given, 0.3)
    assert np.abs(p - apart).mean() < 0.05
    assert ((p > 0.5) == truth)[400:].mean() > 0.85


def test_odd_tables(spark):
    df = spark.createDataFrame(
        [(1, "you idiot", 1), (2, None, 0), (None, "x", 1), (3, "y", None)], "doc_id long, text string, toxic int"
    )
    for rows in (df, df.limit(0)):
        model = tox.fit(rows, "doc_id", "text", "toxic")
        got = {r.doc_id: r.s for r in df.select("doc_id", tox.toxicity(model, df["text"]).alias("s")).collect()}
        assert got[1] > got[2] == got[3]
