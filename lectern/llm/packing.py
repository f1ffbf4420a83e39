"""Packing of tokenised texts into training sequences, as vector bin packing.

A sequence has three limits: ids, pieces (segments) and loss-bearing ids.  Every
partition fills its own sequences.  For an open sequence each text that fits is
scored by the dot product of its demand and what is left, both relative to the
limits; the best goes in.  When none fits, the longest one is cut to fill the
rest.  A sequence that cannot be filled, as it has no segments left or the texts
have ended, is cut back to a power of two, which needs no padding; what is cut off
goes into a later one.  So no sequence has padding.

Texts are read in windows of about ``WINDOW_IDS`` ids; ``RESERVE`` sequences' worth
stays behind as a choice for the next window.  Memory is bounded by these two and
the longest text.

Null and empty texts are their end id alone.  Rows with equal or null keys are
packed each for itself.  Columns other than the three named ones are not read.
A retried task reads the same split in the same order and gives the same pieces.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.text import LOWER, SPACE, Run, hash_ranges, runs

WINDOW_IDS = 2_000_000
RESERVE = 64
CACHE = 600_000
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")  # composed letters whose lower case is one letter


class WordIds:
    """Ids of a tokenizer file that drops white space and folds case, made once per distinct word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        letters = [*range(0x41, 0x5B), *range(0x61, 0x7B)]
        marks = list(b'!"#$%&()*+,-./:;=?@[]^_`{}~')  # not those of contractions and special tokens
        cut = np.zeros((256, 256), bool)
        cut[np.ix_(letters, marks)] = cut[np.ix_(marks, letters)] = True
        cut |= SPACE[:, None] ^ SPACE[None, :]
        self.cut = cut
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self._clear()

    def _clear(self):
        self.index: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = 0

    def ids(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a run of texts, and the bounds of each text in them."""
        if not len(run.data):
            return np.zeros(0, np.uint32), np.zeros(run.n + 1, np.int64)
        cut = np.zeros(len(run.data) + 1, bool)
        cut[1:-1] = self.cut[run.data[:-1], run.data[1:]]
        cut[run.bounds] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        word = ~SPACE[run.data[starts]]
        starts, ends = starts[word], ends[word]
        special = ((run.data[:-1] == 0x3C) & (run.data[1:] == 0x7C)).any()  # <|name|> counts by its case
        hashes = hash_ranges(run.data, starts, ends, None if special else LOWER)
        if special:
            hashes ^= np.uint64(0xA5A5A5A5A5A5A5A5)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        entry = self._entries(run, starts[first], ends[first], distinct)[back]
        sizes, begin = self.size[entry], self.start[entry]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(begin - total[:-1], sizes) + np.arange(total[-1])]
        return ids, total[run.per_text(starts)]

    def _entries(self, run: Run, starts, ends, hashes) -> np.ndarray:
        if len(self.index) > CACHE:
            self._clear()
        got = list(map(self.index.get, hashes.tolist()))
        new = [k for k, v in enumerate(got) if v is None]
        if new:
            raw = run.data.tobytes()
            where = zip(starts[new].tolist(), ends[new].tolist())
            lists = self._encode([raw[a:b].decode() for a, b in where])
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum()))
            at = len(self.index)
            self.flat = _grown(self.flat, self.used + len(flat))
            self.start, self.size = _grown(self.start, at + len(new)), _grown(self.size, at + len(new))
            self.flat[self.used : self.used + len(flat)] = flat
            self.start[at : at + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.size[at : at + len(new)] = sizes
            self.used += len(flat)
            self.index.update(zip(hashes[new].tolist(), range(at, at + len(new))))
            for n, k in enumerate(new, at):
                got[k] = n
        return np.array(got, np.int64)

    def _encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; one of plain Latin letters is a single pre-token and goes straight to the merges."""
        split, letters, tokenize = PLAIN.fullmatch, self.letters, self.model.model.tokenize
        lists = [
            [t.id for t in tokenize(w.lower().translate(letters))] if split(w) else None for w in words
        ]
        other = [n for n, x in enumerate(lists) if x is None]
        made = self.model.encode_batch_fast([words[n] for n in other], add_special_tokens=False)
        for n, x in zip(other, made):
            lists[n] = x.ids
        return lists


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    return a if len(a) >= n else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class Packer:
    """Open pool of texts and the sequences filled from it.

    An item is (text, first id, ids left, ids of the text's start without loss).
    """

    def __init__(self, tokens: int, segments: int, loss: int):
        if min(tokens, segments, loss) < 1:
            raise ValueError("limits must be positive")
        self.limit = np.array([tokens, segments, loss], float)
        self.pool: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
        self.kinds = np.zeros((0, 2), np.int64)
        self.alive = np.zeros(0, bool)
        self.place: dict[tuple[int, int], int] = {}
        self.waiting = 0

    def add(self, text: int, start: int, size: int, prompt: int) -> None:
        kind = (size, max(0, start + size - max(start, prompt)))
        self.pool.setdefault(kind, []).append((text, start, size, prompt))
        self.waiting += size
        k = self.place.get(kind)
        if k is None:
            k = self.place[kind] = len(self.place)
            if k >= len(self.kinds):
                self.kinds = np.concatenate([self.kinds, np.zeros((max(256, k), 2), np.int64)])
                self.alive = np.concatenate([self.alive, np.zeros(max(256, k), bool)])
            self.kinds[k] = kind
        self.alive[k] = True

    def _take(self, k: int) -> tuple[int, int, int, int]:
        kind = (int(self.kinds[k, 0]), int(self.kinds[k, 1]))
        items = self.pool[kind]
        item = items.pop()
        self.waiting -= item[2]
        if not items:
            self.alive[k] = False
        return item

    def sequence(self) -> list[tuple[int, int, int, int]]:
        """Fill one sequence from the pool."""
        left, pieces, total = self.limit.copy(), [], 0
        n = len(self.place)
        while self.waiting and left.min() > 0:
            size, loss = self.kinds[:n, 0], self.kinds[:n, 1]
            share = left / self.limit**2
            score = share[0] * size + share[1] + share[2] * loss
            fits = self.alive[:n] & (size <= left[0]) & (loss <= left[2])
            score = np.where(fits, score, -1.0)
            k = int(score.argmax())
            if score[k] >= 0:
                item = self._take(k)
            else:
                text, start, size, prompt = self._take(int(np.where(self.alive[:n], size, -1).argmax()))
                free = max(0, prompt - start)  # ids that bear no loss
                most = min(int(left[0]), size, free + int(left[2]))
                item = (text, start, most, prompt)
                if most < size:
                    self.add(text, start + most, size - most, prompt)
                    n = len(self.place)
            pieces.append(item)
            total += item[2]
            left -= (item[2], 1, max(0, item[1] + item[2] - max(item[1], item[3])))
        if total < self.limit[0]:
            self._cut_back(pieces, total - (1 << (total.bit_length() - 1)))
        return pieces

    def _cut_back(self, pieces: list, excess: int) -> None:
        while excess:
            text, start, size, prompt = pieces.pop()
            off = min(size, excess)
            self.add(text, start + size - off, off, prompt)
            if off < size:
                pieces.append((text, start, size - off, prompt))
            excess -= off


def pack(
    df: DataFrame, key: str, text: str, tokenizer: str, end_id: int, tokens: int = 2048, segments: int = 256,
    loss: int | None = None, prompt: str | None = None,
) -> DataFrame:
    """Pieces of all texts: (key, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` are little-endian unsigned 32-bit values; each text's ids end with ``end_id``.
    ``prompt`` names a column with the number of first ids that bear no loss (null: none).
    """
    loss = tokens if loss is None else loss
    columns = [F.col(key).alias("key"), F.col(text).alias("text")]
    columns.append((F.coalesce(F.col(prompt), F.lit(0)) if prompt else F.lit(0)).cast("long").alias("prompt"))
    kind = df.schema[key].dataType
    schema = T.StructType().add(key, kind).add("start", "long").add("length", "long").add("ids", "binary")
    schema = schema.add("doc_tokens", "long").add("sequence_id", "long").add("offset", "long")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        packer = Packer(tokens, segments, loss)
        first_id = TaskContext.get().partitionId() << 40
        texts: dict[int, tuple[object, np.ndarray]] = {}
        serial = fresh = done = 0
        for batch in batches:
            keys, prompts = batch.column("key"), pc.fill_null(batch.column("prompt"), 0).to_numpy()
            for run in runs(batch.column("text")):
                ids, bounds = words.ids(run)
                for i in range(run.n):
                    own = np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id))
                    texts[serial] = (keys[run.first + i], own)
                    packer.add(serial, 0, len(own), max(0, int(prompts[run.first + i])))
                    serial += 1
                    fresh += len(own)
                if fresh >= WINDOW_IDS:
                    filled = []
                    while packer.waiting > RESERVE * tokens:
                        filled.append(packer.sequence())
                    yield from _rows(filled, texts, first_id + done, keys.type, schema)
                    done += len(filled)
                    fresh = 0
                    kept = {item[0] for items in packer.pool.values() for item in items}
                    texts = {k: texts[k] for k in kept}
        filled = []
        while packer.waiting:
            filled.append(packer.sequence())
        yield from _rows(filled, texts, first_id + done, None, schema)

    return df.select(*columns).mapInArrow(packed, schema)


def _rows(filled, texts, sequence_id, kind, schema) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    for low in range(0, len(filled), 512):
        part = filled[low : low + 512]
        rows = [(sequence_id + low + n, *piece) for n, pieces in enumerate(part) for piece in pieces]
        if not rows:
            continue
        sizes = np.array([r[3] for r in rows], np.int64)
        ends = np.cumsum(sizes)
        opens = np.array([0, *np.cumsum([sum(p[2] for p in pieces) for pieces in part])[:-1]], np.int64)
        own = np.repeat(np.arange(len(part)), [len(p) for p in part])
        data = np.concatenate([texts[r[1]][1][r[2] : r[2] + r[3]] for r in rows]).astype("<u4")
        where = np.concatenate([[0], 4 * ends]).astype(np.int32)
        ids = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(where), pa.py_buffer(data)])
        values = [
            pa.array([texts[r[1]][0].as_py() for r in rows], arrow.field(0).type),
            pa.array([r[2] for r in rows], pa.int64()), pa.array(sizes), ids,
            pa.array([len(texts[r[1]][1]) for r in rows], pa.int64()),
            pa.array([r[0] for r in rows], pa.int64()), pa.array(ends - sizes - opens[own]),
        ]
        yield pa.RecordBatch.from_arrays(values, schema=arrow)
