import math
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from lectern.llm import pieces
from lectern.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table():
    return pieces.Lattices(PATH, 1.0)


def brute(table, text):
    """Probability of every segmentation, as a tuple of ids."""
    text = "▁" + text.replace(" ", "▁")

    def paths(i):
        if i == len(text):
            yield (), 0.0
            return
        for j in range(i + 1, len(text) + 1):
            w = table.weight.get(text[i:j])
            ids = (table.number[text[i:j]],) if w is not None else ()
            if w is None and j == i + 1:
                raw = text[i].encode()
                w, ids = table.fallback * len(raw), tuple(table.byte[b] for b in raw)
            if w is not None:
                for rest, x in paths(j):
                    yield ids + rest, w + x

    scores = Counter()
    for ids, w in paths(0):
        scores[ids] += math.exp(w)
    total = sum(scores.values())
    return {k: v / total for k, v in scores.items()}


def draw(table, text, n, k):
    keys = np.arange(n, dtype=np.uint64)
    out = [[] for _ in range(n)]
    for row, number, ids, logp, value, inclusion in pieces.sample(table, pa.array([text] * n), keys, k):
        assert number == len(out[row])
        out[row].append((tuple(ids.tolist()), logp, value, inclusion))
    return out


@pytest.mark.parametrize("text", ["an it", "the 漢\n"])
def test_sampling_without_replacement(table, text):
    want = brute(table, text)
    got = draw(table, text, 20_000, 2)
    first, pair = Counter(r[0][0] for r in got), Counter((r[0][0], r[1][0]) for r in got)
    for ids, p in want.items():
        assert abs(first[ids] / len(got) - p) < 0.015
        for other, q in want.items():
            if other != ids:
                assert abs(pair[ids, other] / len(got) - p * q / (1 - p)) < 0.015
    for r in got[:500]:
        assert r[0][0] != r[1][0] and r[0][2] > r[1][2]
        assert all(math.isclose(logp, math.log(want[ids]), abs_tol=1e-9) for ids, logp, _, _ in r)
    # Weighting by inclusion scores makes sums over the sample unbiased: here, the sum of all probabilities.
    total = np.mean([sum(math.exp(x[1] - x[3]) for x in r) for r in got])
    assert abs(total - 1) < 0.03


def test_all_segmentations_come_out_once(table):
    want = brute(table, "ab c")
    for r in draw(table, "ab c", 50, 1000):
        assert {x[0] for x in r} == set(want) and len(r) == len(want)
        assert all(x[3] == 0 for x in r)


def test_batches_do_not_matter(table):
    texts = ["some longer text, with words", "", None, "other words", "x" * 3000, "the end of it"]
    keys = np.arange(6, dtype=np.uint64)
    whole = [(*r[:2], r[2].tolist(), *r[3:]) for r in pieces.sample(table, pa.array(texts), keys, 3)]
    single = [(i, r[1], r[2].tolist(), *r[3:]) for i in range(6) for r in pieces.sample(pieces.Lattices(PATH, 1.0), pa.array(texts[i : i + 1], pa.string()), keys[i : i + 1], 3)]
    assert whole == single
    assert [r[:3] for r in whole if r[0] in (1, 2)] == [(1, 0, []), (2, 0, [])]


def test_full_tables_start_anew(table, monkeypatch):
    """Small tables and runs, and a run that needs more than the tables hold, give the same samples."""
    texts = pa.array(["some longer text, with words", "other words", "x" * 3000, None, "the end of it " * 40, "漢字 some longer", "x" * 3000])
    keys = np.arange(7, dtype=np.uint64)
    whole = [(*r[:2], r[2].tolist()) for r in pieces.sample(table, texts, keys, 3)]
    monkeypatch.setattr(pieces, "MOST_EDGES", 300)
    monkeypatch.setattr(pieces, "RUN_BYTES", 64)
    small = pieces.Lattices(PATH, 1.0)
    assert [(*r[:2], r[2].tolist()) for r in pieces.sample(small, texts, keys, 3)] == whole
    assert small.n_edges > 300 and len(small.cum) == small.n_edges  # the last text needs more by itself
    list(pieces.sample(small, pa.array(["a b", "c d"]), keys[:2], 3))
    list(pieces.sample(small, pa.array(["other words, still more of them, and so on"] * 3), keys[:3], 3))
    assert len(small.cum) == 300


def test_query(spark):
    rows = QUERIES["op5_pieces"](spark, FOLDER).collect()
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    by_doc = {}
    for r in rows:
        assert r.decoded and r.log_prob <= 0 and r.n_pieces > 0
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(docs)
    assert all(len({r.ids_crc32 for r in rs}) == len(rs) == 2 for rs in by_doc.values())


def test_decode_matches_library(spark):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PATH)
    d = pieces.Decoder(PATH)
    for text in ["", "a  b\n", "漢é😀 <s> x", " lead"]:
        ids = np.array(model.encode(text), "<u4")
        assert d.text(ids) == model.decode(ids.tolist()) == text or text == " lead" and d.text(ids) == text
    df = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "é漢▁a")], "doc_id long, text string")
    got = pieces.sampled(df, "doc_id", "text", PATH, 2)
    texts = got.select("doc_id", pieces.decode(got["ids"], PATH).alias("t")).collect()
    assert sorted({(str(r.doc_id), r.t) for r in texts}) == [("1", ""), ("2", "é漢 a"), ("None", "")]
    both = pieces.sampled(df, "doc_id", "text", PATH, 2, decoded="own").collect()
    assert sorted({(str(r.doc_id), r.own) for r in both}) == [("1", ""), ("2", "é漢 a"), ("None", "")]
    assert pieces.sampled(df.limit(0), "doc_id", "text", PATH, 2).count() == 0
