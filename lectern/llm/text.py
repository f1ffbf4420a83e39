"""Vectorised passes over the bytes of Arrow string columns.

A batch is cut into runs of whole texts of about ``RUN_BYTES``; a longer text is a
run of its own, so the working memory is about forty times the larger of
``RUN_BYTES`` and the longest text.  Words and lines are byte ranges found by a
table lookup per byte; their 64-bit hashes come from one running sum.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

# Bytes that end a word: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
# Bytes of letters: ASCII letters and every byte of a longer UTF-8 sequence.
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
OTHER, MARK, UNICODE_LETTER = 0, 1, 2
# A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Run:
    """Texts ``first .. first + n`` of a batch: their bytes and the n + 1 bounds in them."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    def ranges(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every maximal range of bytes marked in the table ``inside``, within one text."""
        mark = inside[self.data]
        return spans(mark, self.bounds)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every maximal range of Unicode letters with their marks, which begins with a letter."""
        kind = characters(self.data)
        starts, ends = spans(kind != OTHER, self.bounds)
        odd = kind[starts] == MARK
        if odd.any():
            letters = np.append(np.flatnonzero(kind == UNICODE_LETTER), len(self.data))
            starts[odd] = letters[np.searchsorted(letters, starts[odd])]
            starts, ends = starts[starts < ends], ends[starts < ends]
        return starts, ends

    def per_text(self, starts: np.ndarray) -> np.ndarray:
        """Bounds (n + 1) of each text's entries among ascending start positions."""
        return np.searchsorted(starts, self.bounds)

    def piece(self, start: int, end: int) -> bytes:
        return self.data[start:end].tobytes()


@cache
def _kinds() -> np.ndarray:
    """Kind of each code point.  Joiners (U+200C, U+200D) go on with a word as marks do."""
    kind = {"L": UNICODE_LETTER, "M": MARK}
    out = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
    out[[0x200C, 0x200D]] = MARK
    return out


def characters(data: np.ndarray) -> np.ndarray:
    """Kind of the character that each byte of UTF-8 belongs to; broken sequences are no letters."""
    kind = np.where(LETTER & (np.arange(256) < 0x80), UNICODE_LETTER, OTHER).astype(np.uint8)[data]
    at = np.flatnonzero(data >= 0xC0)
    if not len(at):
        return kind
    lead = data[at]
    more = 1 + (lead >= 0xE0).astype(np.uint8) + (lead >= 0xF0)
    code = (lead & (0x3F >> more)).astype(np.int32)
    whole = at + more < len(data)
    for k in (1, 2, 3):
        use = more >= k
        byte = data[np.minimum(at + k, len(data) - 1)]
        whole &= ~use | (byte & 0xC0 == 0x80)
        code = np.where(use, code << 6 | byte & 0x3F, code)
    at, more = at[whole], more[whole]
    found = _kinds()[np.minimum(code[whole], sys.maxunicode)]
    kind[at] = found
    for k in (1, 2, 3):
        kind[at[more >= k] + k] = found[more >= k]
    return kind


def spans(mark: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(mark):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(mark) + 1, bool)
    cut[bounds] = True
    begin = mark.copy()
    begin[1:] &= ~mark[:-1] | cut[1:-1]
    end = mark.copy()
    end[:-1] &= ~mark[1:] | cut[1:-1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def runs(texts: pa.Array, size: int = RUN_BYTES) -> Iterator[Run]:
    """Cut a string array into runs of whole texts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, where, raw = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, first + 65536, len(texts))
        low, high = offsets[first], offsets[last]
        yield Run(first, data[low:high], offsets[first : last + 1] - low)
        first = last


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        size = max(n, 2 * len(have), RUN_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _powers[kind] = have = np.cumprod(steps)
    return have


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base of ``hash_sequences`` and of its inverse."""
    return _power("up", _BASE, n), _power("down", _INVERSE, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte range, equal for equal bytes (after ``table``) wherever they stand."""
    return hash_sequences((data if table is None else table[data]).astype(np.uint64), starts, ends)


def hash_sequences(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each range of 64-bit values."""
    n = len(values)
    terms = (values + np.uint64(1)) * _power("up", _BASE, n + 1)[:n]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(terms, out=total[1:])
    h = total[ends] - total[starts]
    h *= _power("down", _INVERSE, n + 1)[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def shingles(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words and the bounds of each text; a shorter text gives its whole sequence."""
    counts = np.diff(bounds)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(out_bounds[-1], np.uint64)
    if not len(out):
        return out, out_bounds
    text = np.repeat(np.arange(len(counts)), made)
    at = np.arange(len(out)) - out_bounds[text] + bounds[text]
    full = counts[text] >= width
    h = np.full(len(out), width, np.uint64)
    for k in range(width):
        use = full | (k < counts[text])
        word = words[np.minimum(at + k, len(words) - 1)]
        h = np.where(use, mix(h * np.uint64(0x9FB21C651E98DF25) + word), h)
    h[~full] ^= np.uint64(0x5851F42D4C957F2D)
    return h, out_bounds


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each range of ``values``; empty ranges give zero."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]
