import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipe
from lectern.llm.language import NONE
from tests.llm.test_jaccard import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in pipe.STAGES] == ["language", "toxicity", "near_duplicates", "packing"]
    before = docs.collect()
    for name, function in pipe.STAGES[:3]:
        after = function(spark, docs, FOLDER)
        assert after.columns == docs.columns
        rows = after.collect()
        assert set(rows) <= set(before) and len(rows) >= 0.8 * len(before)
        if name == "near_duplicates":
            groups = brute([(r.doc_id, r.text) for r in before], 5, 80)
            assert {r.doc_id for r in rows} == {c for _, _, c in groups}
        docs, before = spark.createDataFrame(rows, docs.schema), rows
    pieces = pipe.STAGES[3][1](spark, docs, FOLDER).collect()
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {}
    for p in sorted(pieces, key=lambda p: p.start):
        got.setdefault(p.doc_id, b"")
        got[p.doc_id] += bytes(p.ids)
    for r in before:
        ids = model.encode(r.text, add_special_tokens=False).ids + [1]
        assert got[r.doc_id] == b"".join(i.to_bytes(4, "little") for i in ids)
    assert len(got) == len(before)


def test_odd_rows(spark):
    text = " ".join(f"word{chr(97 + i % 26)}x the" for i in range(40))
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text, "en", "b", 1), (None, text, None, None, None),
            (3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, "12 34", None, "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipe.by_language(spark, docs, FOLDER)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "2", "None"]
    once = pipe.without_near_duplicates(spark, kept, FOLDER)
    assert sorted(str(r.doc_id) for r in once.collect()) == ["1", "None"]
    empty = pipe.by_language(spark, docs.limit(0), FOLDER)
    assert empty.count() == 0 and pipe.packed(spark, pipe.by_toxicity(spark, empty, FOLDER), FOLDER).count() == 0
    assert NONE == "und"
