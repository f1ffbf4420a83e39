"""Spelling variants: words that differ by one inserted, deleted or replaced code point, found by FM-index search.

A word has two halves, and one edit leaves one of them whole.  So two searches find all near words of a
word: match the first half exactly and extend to the right across the second with one edit, or match the
second half exactly and extend to the left across the first.  Both run on intervals of suffix ranks
of a text in which every word stands between delimiters; extending to the left takes the index
of the text, extending to the right that of the reversed text, the two directions of a bidirectional
index.  Neither search ever turns round, so each needs the ranks of one direction only.

The vocabulary is cut into shards of about ``SHARD`` code points, in word order for the search to the right
and in order of the reversed words for the one to the left.  The words that share a word's exact half are then
neighbours, and a word is sent only to the shards whose first and last words enclose such a
half: one, or a few more for very common halves.  Each shard builds its index once for every
``QUERIES`` words that are sent to it.  No word meets words that do not hold one of its halves,
and near words are reported once: the search to the left leaves out those that hold the first half.
If far more words than a shard holds share both a half and nothing else of one length, as codes with a
common first half do, each of them visits all shards of that half.

``near_words`` gives the pairs (both ways), ``forms`` the table of words: ``form`` is the near word of greatest count
(ties: smallest in code-point order) if that is at least ``ratio`` times the word's own, ``root`` the end of the
chain of forms, which always grows in count.  Null and empty words are left out, repeated rows of a word are
added up, and other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import stage

SHARD = 400_000  # code points of an index
QUERIES = 50_000  # words that one index answers
BLOCK = 8_192  # words searched at a time
BOUND = 24  # code points of a shard's first and last word that are kept to find it
DELIMITER = 1
HIT = "word string, near string, n bigint, near_n bigint"


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in a row, and the bounds of each word."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])


class Index:
    """Suffix ranks of ``| w0 | w1 | ... |`` for distinct words given as code points.

    Symbols: 0 ends the text, 1 is the delimiter, 2.. are the code points of the words.
    """

    def __init__(self, flat: np.ndarray, bounds: np.ndarray) -> None:
        self.alphabet = np.unique(flat)
        n_words = len(bounds) - 1
        text = np.full(len(flat) + n_words + 2, DELIMITER)
        text[-1] = 0
        owner = np.repeat(np.arange(n_words), np.diff(bounds))
        text[np.arange(len(flat)) + owner + 1] = self.encode(flat)
        self.starts = bounds[:-1] + np.arange(n_words)
        self.n = len(text)
        self.suffixes = _suffix_array(text)
        self.before = text[self.suffixes - 1]
        # All (symbol before, rank), sorted: the place of (c, i) among them is the rank that c in front leads to.
        order = np.argsort(self.before, kind="stable")
        self.steps = self.before[order] * (self.n + 1) + order

    def encode(self, points: np.ndarray) -> np.ndarray:
        """The symbols of code points; one more than all of them for those in no word."""
        at = np.searchsorted(self.alphabet, points)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points if len(self.alphabet) else np.zeros(len(points), bool)
        return np.where(known, at, len(self.alphabet)) + 2

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals after putting a symbol in front."""
        base = symbol * (self.n + 1)
        return np.searchsorted(self.steps, base + low), np.searchsorted(self.steps, base + high)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Every (interval number, code point's symbol, low, high) that goes on from the intervals."""
        both, back = np.unique(low * (self.n + 1) + high, return_inverse=True)
        own_low, own_high = both // (self.n + 1), both % (self.n + 1)
        size = own_high - own_low
        rank = np.arange(size.sum()) + np.repeat(own_low - np.cumsum(size) + size, size)
        found = np.unique(np.repeat(np.arange(len(both)), size) * (len(self.alphabet) + 3) + self.before[rank])
        of, symbol = found // (len(self.alphabet) + 3), found % (len(self.alphabet) + 3)
        of, symbol = of[symbol > DELIMITER], symbol[symbol > DELIMITER]
        low, high = self.extend(symbol, own_low[of], own_high[of])
        # Back from the distinct intervals to those asked for.
        first = np.searchsorted(of, np.arange(len(both) + 1))
        count = np.diff(first)[back]
        take = np.arange(count.sum()) + np.repeat(first[:-1][back] - np.cumsum(count) + count, count)
        return np.repeat(np.arange(len(back)), count), symbol[take], low[take], high[take]

    def words(self, low: np.ndarray) -> np.ndarray:
        """The word between delimiters whose interval begins at ``low``."""
        return np.searchsorted(self.starts, self.suffixes[low])


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the compared length until all ranks differ."""
    rank, n, size = text, len(text), 1
    rank = np.unique(rank, return_inverse=True)[1]
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - size)] = rank[size:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        changed = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = changed
        if changed[-1] == n - 1:
            return order
        size *= 2


def one_edit(index: Index, flat: np.ndarray, bounds: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) for words one edit from a query whose last ``exact`` code points they end with.

    The edit lies in front of the exact part; an insertion right before it counts.
    """
    codes, ends = index.encode(flat), bounds[1:]
    q = np.arange(len(ends))
    start = np.full(len(q), DELIMITER)
    low, high = index.extend(start, np.zeros(len(q), np.int64), np.full(len(q), index.n))
    for k in range(int(exact.max(initial=0))):
        go = exact[q] > k
        low[go], high[go] = index.extend(codes[ends[q[go]] - 1 - k], low[go], high[go])
        q, low, high = (x[low < high] for x in (q, low, high))
    left = np.diff(bounds)[q] - exact[q]  # code points still to be matched
    done = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    edited, most = [np.zeros(0, np.int64)] * 4, BLOCK
    while len(q) or len(edited[0]):
        # Without an edit so far: one edit here, or one more code point as it is.
        at, symbol, to_low, to_high = index.branches(low, high)
        inserted = (q[at], left[at], to_low, to_high)
        more = left > 0
        own = np.zeros(len(q), np.int64)
        own[more] = codes[bounds[q[more]] + left[more] - 1]
        replace = more[at] & (symbol != own[at])
        replaced = (q[at][replace], left[at][replace] - 1, to_low[replace], to_high[replace])
        deleted = (q[more], left[more] - 1, low[more], high[more])
        # With the edit: one more code point, or the delimiter at the end.
        e_q, e_left, e_low, e_high = edited
        go = e_left > 0
        step = np.full(len(e_q), DELIMITER)
        step[go] = codes[bounds[e_q[go]] + e_left[go] - 1]
        e_low, e_high = index.extend(step, e_low, e_high)
        live = e_low < e_high
        end = live & ~go
        done.append((e_q[end], index.words(e_low[end])))
        go &= live
        edited = [np.concatenate(x) for x in zip(inserted, replaced, deleted, (e_q[go], e_left[go] - 1, e_low[go], e_high[go]))]
        if len(edited[0]) > most:  # in a stretch of equal letters, an edit at any place gives one state
            edited = list(np.unique(np.stack(edited), axis=1))
            most = max(BLOCK, 2 * len(edited[0]))
        low, high = index.extend(own[more], low[more], high[more])
        q, left = q[more], left[more] - 1
        q, left, low, high = (x[low < high] for x in (q, left, low, high))
    found = np.unique(np.concatenate([a * (len(index.starts) + 1) + b for a, b in done]))
    return found // (len(index.starts) + 1), found % (len(index.starts) + 1)


def _search(words: pa.Table, asked: pa.Table, to_left: bool) -> pa.Table:
    """Near words of ``asked`` in one shard.  The index is that of the words to the left, of the reversed ones to the right."""
    turn = (lambda w: w) if to_left else (lambda w: w[::-1])
    own, counts = words["own"].to_pylist(), words["own_n"].to_numpy()
    queries, query_n = asked["word"].to_pylist(), asked["n"].to_numpy()
    index = Index(*_codes([turn(w) for w in own]))
    made = []
    for k in range(0, len(queries), BLOCK):
        block = queries[k : k + BLOCK]
        exact = np.array([len(w) - len(w) // 2 if to_left else len(w) // 2 for w in block])
        of, near = one_edit(index, *_codes([turn(w) for w in block]), exact)
        pairs = [(block[a], own[b], query_n[k + a], counts[b]) for a, b in zip(of.tolist(), near.tolist())]
        if to_left:
            pairs = [p for p in pairs if not p[1].startswith(p[0][: len(p[0]) // 2])]
        made += pairs
    columns = list(zip(*made)) or [[]] * 4
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["word", "near", "n", "near_n"])


def _route(bounds: list[tuple[int, str, str]], to_left: bool):
    """A function from words to the shards that may hold their exact half; bounds: (shard, first, last), cut."""
    shards = np.array([b[0] for b in bounds])
    first, last = np.array([b[1] for b in bounds], object), np.array([b[2] for b in bounds], object)

    def route(words: pa.Array) -> pa.Array:
        out = []
        for w in words.to_pylist():
            half = (w[len(w) // 2 :][::-1] if to_left else w[: len(w) // 2])[:BOUND]
            # Shards whose last word is not before the half, and whose first is not after all words with it.
            a = np.searchsorted(last, half)
            b = np.searchsorted(first, half + "\U0010ffff", "right")
            out.append(shards[a:b].tolist())
        return pa.array(out, pa.list_(pa.int32()))

    return F.arrow_udf(route, "array<int>")


def _directed(words: DataFrame, shards: int, to_left: bool) -> DataFrame:
    key = F.reverse("word") if to_left else F.col("word")
    placed = words.withColumn("key", key).repartitionByRange(shards, "key").withColumn("shard", F.spark_partition_id())
    placed = stage(placed, "shards")
    cut = placed.groupBy("shard").agg(F.min("key").alias("a"), F.max("key").alias("b"))
    cut = cut.select("shard", F.substring("a", 1, BOUND).alias("a"), F.substring("b", 1, BOUND).alias("b"))
    # Two short strings for each SHARD code points of the vocabulary.
    bounds = sorted((tuple(r) for r in cut.collect()), key=lambda r: (r[1], r[2]))
    asked = placed.select("word", "n", F.explode(_route(bounds, to_left)("word")).alias("shard"))
    parts = asked.groupBy("shard").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
    asked = asked.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("word"), "parts").cast("int"))
    # New names, as both sides come from one table.
    held = placed.select(F.col("word").alias("own"), F.col("n").alias("own_n"), "shard").join(parts, "shard")
    held = held.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search(left, right, to_left)

    by = ["shard", "part"]
    held, asked = held.select("own", "own_n", *by), asked.select("word", "n", *by)
    return held.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(search, HIT)


def near_words(words: DataFrame, word: str = "word", n: str = "n") -> DataFrame:
    """(word, near, n, near_n) of all pairs of distinct words with exactly one edit between them, both ways."""
    counted = _counted(words, word, n)
    size = counted.agg(F.coalesce(F.sum(F.length("word") + 1), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD))
    return _directed(counted, shards, False).unionByName(_directed(counted, shards, True))


def _counted(words: DataFrame, word: str, n: str) -> DataFrame:
    rows = words.select(words[word].alias("word"), words[n].cast("long").alias("n")).filter("word <> ''")
    return stage(rows.groupBy("word").agg(F.sum("n").alias("n")), "words")


def forms(words: DataFrame, word: str = "word", n: str = "n", ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each distinct word."""
    counted = _counted(words, word, n)
    near = near_words(counted).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), F.col("near").alias("form"))).alias("best")
    )
    best_n = -F.col("best.col1")
    chosen = counted.join(near, "word", "left").withColumn("chosen", best_n >= ratio * F.col("n"))
    chosen = stage(chosen.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("chosen"), F.col("best.form")).alias("form"), F.when(F.col("chosen"), best_n).alias("form_n"),
    ), "forms")
    roots = _roots(chosen.filter("form is not null").select("word", F.col("form").alias("root")))
    return chosen.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each chain; every round doubles the length followed."""
    links = stage(links, "roots")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = links.join(on, "root", "left")
        longer = stage(longer.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        links = longer.select("word", "root")
        if not longer.filter("moved").head(1):
            return links
