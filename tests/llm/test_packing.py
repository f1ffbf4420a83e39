import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from lectern.llm import packing
from lectern.llm.queries import QUERIES
from lectern.llm.text import runs

PATH = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"


def library(texts):
    model = Tokenizer.from_file(PATH)
    return [x.ids for x in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_are_the_librarys():
    rng = random.Random(2)
    alphabet = ["a", "The", "É", "ñ", "ÿ", "ç", "Ü", " ", "  ", "\n", "'s", "'LL", "é", "é", "́", "Σ", "漢", "😀", "<|endoftext|>", "<|EndOfText|>",
                "»", ".", "...", ",", "1", "23", " ", "\x00", "-", "|", "İ", "ß"]
    texts = ["", None, " ", "x" * 3000, "it's, isn't. it"] + ["".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(4000)]
    words, got = packing.WordIds(PATH), []
    for run in runs(pa.array(texts), 500):
        ids, bounds = words.ids(run)
        got += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert got == library(texts)


def check_packed(rows, want, tokens=2048, segments=256):
    """Every id once, offsets gapless, limits kept, no padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(want)
    for doc, parts in by_doc.items():
        parts.sort(key=lambda r: r.start)
        ids, at = want[doc], 0
        for r in parts:
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        at = 0
        for r in parts:
            assert r.offset == at
            at += r.length
        assert at <= tokens and len(parts) <= segments
        assert at == tokens or at & (at - 1) == 0


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = {d.doc_id: ids + [1] for d, ids in zip(docs, library([d.text for d in docs]))}
    check_packed(QUERIES["op8_packing"](spark, FOLDER).collect(), want)


def test_windows_and_limits(spark, monkeypatch):
    rng = np.random.default_rng(3)
    packer = packing.Packer(64, 4, 40)
    sizes = rng.integers(1, 200, 300)
    prompts = rng.integers(0, 30, 300)
    for k, (size, prompt) in enumerate(zip(sizes, prompts)):
        packer.add(k, 0, int(size), int(prompt))
    seen = defaultdict(int)
    while packer.waiting:
        pieces = packer.sequence()
        total = sum(p[2] for p in pieces)
        assert total == 64 or total & (total - 1) == 0
        assert len(pieces) <= 4 and sum(max(0, s + n - max(s, q)) for _, s, n, q in pieces) <= 40
        for k, _, n, _ in pieces:
            seen[k] += n
    assert [seen[k] for k in range(300)] == sizes.tolist()


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (None, "a b", 5), (4, "a b", 5), (4, "a b", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int").coalesce(1)
    got = packing.pack(df, "doc_id", "text", PATH, 1).collect()
    assert sorted(r.doc_tokens for r in got if r.start == 0) == [1, 1, 3, 3, 3]
    assert sum(r.length for r in got) == 11
    assert packing.pack(df.limit(0), "doc_id", "text", PATH, 1).count() == 0
