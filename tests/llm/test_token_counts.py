import random

import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from lectern.llm import token_counts
from lectern.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def test_odd_texts(library):
    rng = random.Random(1)
    alphabet = ["a", "b", "the", " ", "  ", "\n", "\t", "▁", "é", "漢", "😀", "<s>", "</s>", "<0x0A>", "\x00", "er", "1", "."]
    texts = ["", None, " ", "\n", "   ", "▁", "a" * 5000, " " * 1000, "x y " * 3000]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(3000)]
    got = token_counts.merges(PATH).counts(pa.array(texts))
    assert got.tolist() == [len(library.encode(t or "")) for t in texts]


def test_cache_is_bounded(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 3)
    model = token_counts.PieceMerges(PATH)
    texts = pa.array(["one two three", "four five six", "one two seven"])
    assert [model.counts(texts[i : i + 1])[0] for i in range(3)] == [len(library.encode(t)) for t in texts.to_pylist()]


def test_query_matches_library(spark, library):
    rows = QUERIES["op4_token_counts"](spark, FOLDER).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_tokens int")
    assert df.withColumn("n_tokens", token_counts.token_count(df["text"], PATH)).count() == 0
