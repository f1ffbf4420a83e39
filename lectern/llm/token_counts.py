"""Token counts of a byte-fallback BPE piece model, without making any identifiers.

A text is a space mark plus the text with spaces as marks.  Two characters that
stand side by side in no piece can never come to be in one symbol, so a text is cut
between them (always before the mark that ends a word) and each distinct part is
merged once per worker: a heap yields the lowest-ranked adjacent pair (leftmost
on ties) of a doubly linked list of symbols until no pair is a piece.  The count is
the number of initial symbols (a character without a piece counts its bytes)
minus the number of merges.

Null and empty texts have no tokens.  Parts are recognised by a 64-bit hash and
their length.  The cache is emptied at ``CACHE`` parts, so memory is bounded.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.llm.text import hash_ranges, runs, sums

MARK = "▁"
CACHE = 1_500_000
_EMPTY, _SPACE = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())


class PieceMerges:
    """Ranks of the pieces of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.rank = {model.id_to_piece(i): int(-model.get_score(i)) for i in plain}
        self.initial = {piece: 1 for piece in self.rank if len(piece) == 1}
        self.cut = self._cuts()
        self.cache: dict[int, int] = {}

    def _cuts(self) -> np.ndarray:
        """[previous byte, byte]: may a text be cut between the two, as no piece has them side by side?"""
        beside = {piece[i : i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        cut = np.zeros((256, 256), bool)
        plain = [(chr(b) if b != 0x20 else MARK) for b in range(128)]
        for a in range(128):
            cut[a, :128] = [plain[a] + b not in beside for b in plain]
        for b in (0x20, 0x0A):  # other pairs with a longer character are left joined
            cut[128:, b] = not any(x[1] == plain[b] and ord(x[0]) > 127 and x[0] != MARK for x in beside)
        return cut

    def count(self, part: str) -> int:
        """Tokens of one part, spaces written as marks."""
        rank, initial = self.rank, self.initial
        symbols = list(part)
        n = len(symbols)
        total = sum([initial.get(c) or len(c.encode()) for c in symbols])
        if n == 1:
            return total
        following = list(range(1, n + 1))
        preceding = list(range(-1, n - 1))
        get = rank.get
        heap = []  # rank * n + position: the lowest rank first, then the leftmost
        for i in range(n - 1):
            r = get(symbols[i] + symbols[i + 1])
            if r is not None:
                heap.append(r * n + i)
        heapify(heap)
        while heap:
            r, i = divmod(heappop(heap), n)
            left, j = symbols[i], following[i]
            if not left or j == n:
                continue
            pair = left + symbols[j]
            if get(pair) != r:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = pair, ""
            total -= 1
            following[i] = after = following[j]
            if after < n:
                preceding[after] = i
                r = get(pair + symbols[after])
                if r is not None:
                    heappush(heap, r * n + i)
            before = preceding[i]
            if before >= 0:
                r = get(symbols[before] + pair)
                if r is not None:
                    heappush(heap, r * n + before)
        return total

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of an Arrow string array."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pc.replace_substring(texts, MARK, " ")
        texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(_EMPTY, texts, _SPACE))
        out = np.zeros(len(texts), np.int64)
        for run in runs(texts):
            if not len(run.data):
                continue
            cut = np.zeros(len(run.data) + 1, bool)
            cut[1:-1] = self.cut[run.data[:-1], run.data[1:]]
            cut[run.bounds] = True
            edges = np.flatnonzero(cut)
            starts, ends = edges[:-1], edges[1:]
            hashes = hash_ranges(run.data, starts, ends)
            distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
            out[run.first : run.first + run.n] = sums(
                self._known(run, starts[first], ends[first], distinct)[back], run.per_text(starts)
            )
        return out

    def _known(self, run, starts, ends, hashes) -> np.ndarray:
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        got = list(map(cache.get, hashes.tolist()))
        raw = run.data.tobytes()
        for k, value in enumerate(got):
            if value is None:
                part = raw[starts[k] : ends[k]].decode().replace(" ", MARK)
                got[k] = cache[int(hashes[k])] = self.count(part)
        return np.array(got, np.int64)


@lru_cache(maxsize=2)
def merges(path: str) -> PieceMerges:
    return PieceMerges(path)


def token_count(text: Column, path: str) -> Column:
    """Column with the number of tokens of ``text`` under the model file at ``path`` (0 for null)."""

    def counted(texts: pa.Array) -> pa.Array:
        return pa.array(merges(path).counts(texts))

    return F.arrow_udf(counted, "long")(text)
