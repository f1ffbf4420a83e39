import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lectern.llm import language as lang
from lectern.llm import text
from lectern.llm.queries import QUERIES
from lectern.llm.text import runs

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {d.doc_id: d for d in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op2_language"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    right = []
    for r in rows:
        assert 0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.held_out:
            right.append(r.lang_pred == docs[r.doc_id].lang)
    assert len(right) > 150 and np.mean(right) > 0.95


@pytest.fixture(scope="module")
def model():
    return lang.learn(["der hund ist gross und klein"] * 6 + ["the dog is big and small"] * 6, ["de"] * 6 + ["en"] * 6)


def test_forward_backward_is_the_sum_over_all_labellings(model):
    rng = np.random.default_rng(1)
    scores, bounds = rng.normal(size=(7, 2)), np.array([0, 3, 3, 7])
    model.moves = rng.normal(size=(2, 2))
    p, moves = model.marginals(scores, bounds)
    want_moves = np.zeros((2, 2))
    for a, b in zip(bounds[:-1], bounds[1:]):
        if a == b:
            continue
        total, want, pairs = 0.0, np.zeros((b - a, 2)), np.zeros((2, 2))
        for path in itertools.product(range(2), repeat=b - a):
            w = np.exp(sum(scores[a + i, k] for i, k in enumerate(path)) + sum(model.moves[x, y] for x, y in zip(path, path[1:])))
            total += w
            for i, k in enumerate(path):
                want[i, k] += w
            for x, y in zip(path, path[1:]):
                pairs[x, y] += w
        assert np.allclose(p[a:b], want / total)
        want_moves += pairs / total
    assert np.allclose(moves, want_moves)


def test_code_switching_and_odd_texts():
    model = lang.learn(["der hund ist gross und klein"] * 6 + ["the dog is big and small"] * 6, ["de"] * 6 + ["en"] * 6)
    texts = [None, "", "12 %% \n", "der hund, ist gross und the dog is big and small and big", "the", "x" * 100_000]
    got = lang.predict(model, pa.array(texts), True).to_pylist()
    assert [g["lang"] for g in got[:3]] == ["und"] * 3 and [g["score"] for g in got[:3]] == [0.0] * 3
    spans = [(texts[3][s["first_byte"] : s["end_byte"]], s["lang"]) for s in got[3]["spans"]]
    assert spans == [("der hund, ist gross und", "de"), ("the dog is big and small and big", "en")]
    assert got[4]["lang"] == "en" and 0 < got[5]["score"] <= 1
    assert lang.predict(None, pa.array(texts), True).to_pylist()[3] == {"lang": "und", "score": 0.0, "spans": []}


def test_signs_beyond_ascii_are_no_words(model):
    texts = ["20 € – 30", "★★★", "😀 👨‍👩‍👧", "⚠️", "—", "…", "“”", "٣٤", "\u0301", "der “Hund” – ist…", "naïve Größe été", "हिन्दी ❤️the"]
    got = lang.predict(model, pa.array(texts), False).to_pylist()
    assert [(g["lang"], g["score"]) for g in got[:9]] == [("und", 0.0)] * 9
    assert all(g["lang"] != "und" and g["score"] > 0 for g in got[9:])
    run = next(runs(pa.array(texts)))
    starts, ends = run.words()
    found = [run.piece(a, b).decode() for a, b in zip(starts, ends)]
    assert found == ["der", "Hund", "ist", "naïve", "Größe", "été", "हिन्दी", "the"]
    assert run.per_text(starts).tolist() == [0] * 10 + [3, 6, 8]
    assert lang.learn(["★ – 20 €"], ["de"]) is None


def test_broken_bytes_are_no_letters():
    for raw, want in ((b"a\xc3", 1), (b"\xe2\x82", 0), (b"\xc3(b", 1), (b"\xf7\xbf\xbf\xbf", 0), (b"\x80\x81", 0)):
        data = np.frombuffer(raw, np.uint8)
        assert int((text.characters(data) == text.UNICODE_LETTER).sum()) == want


def test_lower_case_and_place_do_not_matter(model):
    run = next(runs(pa.array(["The dog THE cat the"])))
    words = lang.Words.of(run)
    assert len(words.hashes) == 3 and words.back[[0, 2, 4]].tolist() == [words.back[0]] * 3


def test_empty_and_unlabelled_tables(spark):
    df = spark.createDataFrame([(1, "the dog", None), (None, "der hund", "de")], "doc_id long, text string, lang string")
    assert lang.fit(df, "doc_id", "text", "lang") is None
    assert lang.fit(df.limit(0), "doc_id", "text", "lang") is None
    got = df.select(lang.language(None, df["text"]).alias("lang")).collect()
    assert [r.lang.lang for r in got] == ["und", "und"]


def test_every_language_is_learned(spark):
    rows = [(70 * k + i, f"w{chr(97 + i // 10)}{chr(107 + i % 10)} " * 3, f"l{i:02}") for i in range(70) for k in range(2 if i else 3)]
    rows += [(1000 + k, "zyx zyxa " * 20, "long") for k in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang.fit(df, "doc_id", "text", "lang", fit_chars=100)
    assert model.languages == sorted({r[2] for r in rows})
    got = lang.predict(model, pa.array([r[1] for r in rows]), False).to_pylist()
    assert np.mean([g["lang"] == r[2] for g, r in zip(got, rows)]) > 0.95


def test_runs_of_many_languages_give_the_same(monkeypatch):
    names = [f"l{i:02}" for i in range(20)]
    model = lang.learn([f"w{chr(97 + i)}x is" for i in range(20)], names, rounds=3)
    texts = pa.array([f"w{chr(97 + i)}x is" for i in range(20)] + [None, "–"])
    want = lang.predict(model, texts, True).to_pylist()
    monkeypatch.setattr(lang, "RUN", 10)
    got = lang.predict(model, texts, True).to_pylist()
    assert [(g["lang"], g["spans"]) for g in got] == [(w["lang"], w["spans"]) for w in want]
    assert np.allclose([g["score"] for g in got], [w["score"] for w in want])
