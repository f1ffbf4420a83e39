"""Periodic runs of words, found by catching squares over dyadic blocks as the words arrive.

``Catcher`` reads a sequence of words piece by piece.  For every power of two L it holds
one catcher for each completed block of 2L words that begins at a multiple of L.  Each
new word ends a suffix of 2L words, which is compared with the one block that begins
between L and 2L words before the suffix.  If they are equal, at distance p, the words from
the begin of the block to the end of the suffix have period p, and a square of p words is caught.
It is extended to the left and then either belongs to a run known already or opens
a new one; open runs grow as long as the words repeat.

A run of smallest period p and at least 4p words holds a caught block: with L <= p < 2L
its first 3p words hold an aligned block of 2L, whose copy follows p later.  If two suffixes equal
one block, both distances are multiples of a smaller period, which a lower level catches;
so one square a block is enough, and n words give about 2n squares over all levels.

Words are compared as 64-bit hashes, long stretches by sums of a polynomial over them; every run
that is reported has been compared word by word.  A null or empty text has no words and no runs.
Each text is judged by itself, so repeated rows get equal results.  The working memory is that
of ``text.runs``: some hundred bytes for each word of the longer of 1 MB and the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.llm.text import NOT_SPACE, Run, hash_ranges, mix, powers, runs

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
FOUND = "runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string"
NONE = np.zeros((0, 2), np.int64)


class Catcher:
    """Squares and runs of one growing sequence of 64-bit words."""

    def __init__(self) -> None:
        self.n = 0
        self._words = np.zeros(0, np.uint64)
        self._total = np.zeros(1, np.uint64)
        # Start and period of each run, ascending, and its end; the end of an open run is ``n``.
        self._known, self._ends = NONE, np.zeros(0, np.int64)

    def append(self, words: np.ndarray) -> np.ndarray:
        """Take in more words; returns (start, period) of the runs that they open."""
        before = self.n
        self._take(words)
        self._grow(self._ends == before)
        size, caught = 1, []
        while LEAST_EXPONENT * size <= self.n:
            begin, period = self._catch(size, before)
            start = begin - self._same(begin, begin + period, begin, -1)
            caught.append(np.stack([start, period, begin + period + 2 * size], axis=1))
            size *= 2
        if not caught:
            return NONE
        caught = np.concatenate(caught)
        both, first, where = np.unique(
            np.concatenate([self._known, caught[:, :2]]), axis=0, return_index=True, return_inverse=True
        )
        new = first >= len(self._known)
        ends = np.zeros(len(both), np.int64)
        np.maximum.at(ends, where, np.concatenate([self._ends, caught[:, 2]]))
        self._known, self._ends = both, ends
        self._grow(new)
        return both[new]

    def _take(self, words: np.ndarray) -> None:
        n, after = self.n, self.n + len(words)
        if after > len(self._words):
            self._words = np.concatenate([self._words[:n], np.zeros(max(after, 2 * n) - n, np.uint64)])
            self._total = np.concatenate([self._total[: n + 1], np.zeros(len(self._words) - n, np.uint64)])
        self._words[n:after] = words
        up, _ = powers(after + 1)
        self._total[n + 1 : after + 1] = self._total[n] + np.cumsum((words + np.uint64(1)) * up[n:after])
        self.n = after

    def _sums(self, at, size: int) -> np.ndarray:
        """Sums of the ``size`` words from each place (or slice of places), equal for equal words."""
        _, down = powers(self.n + 1)
        if isinstance(at, slice):
            return (self._total[at.start + size : at.stop + size] - self._total[at]) * down[at]
        return (self._total[at + size] - self._total[at]) * down[at]

    def _same(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        """How many words, up to ``most``, are equal from a and b on (way 1) or before them (way -1)."""
        done = np.zeros(len(a), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step := step >> 1:
            fits = np.flatnonzero(done + step <= most)
            shift = done[fits] if way > 0 else -done[fits] - step
            equal = self._sums(a[fits] + shift, step) == self._sums(b[fits] + shift, step)
            done[fits[equal]] += step
        return done

    def _grow(self, which: np.ndarray) -> None:
        """Move the ends of these runs on while the words repeat."""
        end = self._ends[which]
        self._ends[which] += self._same(end, end - self._known[which, 1], self.n - end, 1)

    def _catch(self, size: int, before: int) -> tuple[np.ndarray, np.ndarray]:
        """Begin and period of the squares that blocks of 2 ``size`` words catch by suffixes ending in the new words."""
        first, last = max(size, before - 2 * size + 1), self.n - 2 * size + 1
        if first >= last:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low = (first // size - 1) * size
        sums = self._sums(slice(low, last), 2 * size)
        # Row r holds the suffixes that begin in the r-th stretch of ``size`` words; they meet the block of the row before.
        rows = np.zeros(-(-len(sums) // size) * size, np.uint64)
        rows[: len(sums)] = sums
        rows = rows.reshape(-1, size)
        at = np.flatnonzero((rows[1:] == rows[:-1, :1]).ravel()[: len(sums) - size]) + low + size
        at = at[at >= first]
        begin = (at // size - 1) * size
        once = np.append(True, begin[1:] != begin[:-1])[: len(begin)]
        return begin[once], (at - begin)[once]

    def runs(self) -> np.ndarray:
        """(start, length, period) of the runs so far, by start and period, with their smallest periods."""
        start, period = self._known.T
        found = np.stack([start, self._ends - start, period], axis=1)
        checked = [found[:0]]
        for begin, length, p in found[_long(found)]:
            words = self._words[begin : begin + length]
            same = words[p:] == words[:-p]
            if same.all():
                checked.append(np.array([[begin, length, p]]))
                continue
            # Unequal words with equal sums: the run ends there.
            edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
            checked.append(np.stack([begin + edge[::2], edge[1::2] - edge[::2] + p, np.full(len(edge) // 2, p)], axis=1))
        found = np.concatenate(checked)
        found = found[_long(found)]
        # The multiples of a period have the same run.
        found = found[np.lexsort([found[:, 2], found[:, 1], found[:, 0]])]
        _, once = np.unique(found[:, :2], axis=0, return_index=True)
        found = found[once]
        return found[np.lexsort([found[:, 2], found[:, 0]])]


def _long(found: np.ndarray) -> np.ndarray:
    return found[:, 1] >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * found[:, 2])


def _of_run(run: Run) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The runs of all texts, the text of each, and the collapsed texts."""
    starts, ends = run.ranges(NOT_SPACE)
    bounds = run.per_text(starts)
    # Between two texts stands a word that no other equals, so nothing repeats across it.
    text_of = np.repeat(np.arange(run.n), np.diff(bounds))
    breaks = bounds[1:] + np.arange(run.n)
    words = np.zeros(len(starts) + run.n, np.uint64)
    words[np.arange(len(starts)) + text_of] = hash_ranges(run.data, starts, ends)
    words[breaks] = mix(np.arange(1, run.n + 1, dtype=np.uint64) << np.uint64(32))
    catcher = Catcher()
    catcher.append(words)
    found = catcher.runs()
    owner = np.searchsorted(breaks, found[:, 0])
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(change)[:-1] == 0
    found[:, 0] -= bounds[owner] + owner
    repeats = np.zeros(run.n, bool)
    repeats[owner] = True
    texts = []
    for k in range(run.n):
        own = run.piece(run.bounds[k], run.bounds[k + 1]).split()
        if repeats[k]:
            first = bounds[k] + k
            own = [own[i] for i in np.flatnonzero(kept[first : first + len(own)])]
        texts.append(b" ".join(own))
    return found, owner, texts


def _found(texts: pa.Array) -> pa.Array:
    made, counts, collapsed = [np.zeros((0, 3), np.int64)], [np.zeros(1, np.int64)], []
    for run in runs(texts):
        found, owner, own = _of_run(run)
        made.append(found)
        counts.append(np.bincount(owner, minlength=run.n))
        collapsed += own
    start, length, period = np.concatenate(made).T
    entries = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
    where = pa.array(np.cumsum(np.concatenate(counts)).astype(np.int32))
    texts = pa.array(collapsed, pa.binary()).view(pa.string())
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(where, entries), texts], ["runs", "collapsed"])


def periodic(text: str | Column) -> Column:
    """Struct of a text's ``runs`` (start and length in words, smallest period; by start and period) and the text
    ``collapsed``: its words joined by one space, without those that lie in a run after its first period."""
    return F.arrow_udf(_found, f"struct<{FOUND}>")(text)


def longest_exponent(found: str | Column) -> Column:
    """Of runs in order, the one with the greatest length / period, compared exactly; the first of equal ones."""
    found = F.col(found) if isinstance(found, str) else found
    better = lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)
    return F.reduce(found, F.get(found, F.lit(0)), better)
