"""Quality rules: measures of one text, and lines that too many documents of a host share.

``measured`` makes one pass over the texts and gives, for each row, its measures and
its normalised lines (A-Z lowered, white space collapsed; as 64-bit hashes with their
words and repeats).  ``frequent_lines`` counts the documents of each (host, line) and
keeps the lines above the limit; ``verdicts`` subtracts them and rejects documents of
which less than ``least_kept`` of the words remain.  ``without_lines`` gives the texts
that remain.

Null texts count as empty, a null host is a host of its own.  Rows with equal keys are one
document and are judged together, a row with a null key is a document of its own.  A document without
words is not depleted (other rules reject it).  Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.text import LOWER, NOT_SPACE, Run, hash_ranges, hash_sequences, mix, runs, shingles, spans, sums
from lectern.operators.skew import null_safe_join

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
KIND = ", ".join(f"{m}: bigint" for m in MEASURES)
LINES = "array<struct<line: bigint, words: bigint>>"
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


def _lines(run: Run):
    """Lines with a word: byte ranges, bounds of each text's lines, and each line's range of words."""
    word_at, word_end = run.ranges(NOT_SPACE)
    starts, ends = spans(run.data != 0x0A, run.bounds)
    first, last = np.searchsorted(word_at, starts), np.searchsorted(word_at, ends)
    has = last > first
    return starts[has], ends[has], first[has], last[has], word_at, word_end


def _measure(run: Run) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    data = run.data
    starts, ends, first, last, word_at, word_end = _lines(run)
    bounds = run.per_text(word_at)
    n_words = np.diff(bounds)
    begins = NOT_SPACE[data] & ((data & 0xC0) != 0x80)
    char_count = sums(begins, run.bounds)
    symbols = sums(SYMBOL[data], run.bounds)

    text_of = np.repeat(np.arange(run.n), np.diff(np.searchsorted(starts, run.bounds)))
    salt = mix(np.arange(1, run.n + 1, dtype=np.uint64))
    keys = hash_ranges(data, starts, ends) ^ salt[text_of]
    _, once = np.unique(keys, return_index=True)
    dup_lines = np.bincount(text_of, minlength=run.n) - np.bincount(text_of[once], minlength=run.n)

    words = hash_ranges(data, word_at, word_end)
    windows, at = shingles(words, bounds, 3)
    owner = np.repeat(np.arange(run.n), np.diff(at))
    full = n_words[owner] >= 3
    place = (np.arange(len(windows)) - at[owner] + bounds[owner])[full]
    _, back, counts = np.unique((windows ^ salt[owner])[full], return_inverse=True, return_counts=True)
    again = place[counts[back] > 1]
    covered = np.zeros(len(words) + 1, bool)
    for k in range(3):
        covered[again + k] = True
    repeat_words = sums(covered[:-1], bounds)

    lowered = hash_ranges(data, word_at, word_end, LOWER)
    lines = hash_sequences(lowered, first, last)
    # One entry per text and distinct line: its words in all its repeats.
    _, once, back = np.unique(lines ^ salt[text_of], return_index=True, return_inverse=True)
    words_in = np.bincount(back, weights=last - first, minlength=len(once)).astype(np.int64)
    order = np.argsort(once)
    once, words_in = once[order], words_in[order]
    line_bounds = np.searchsorted(text_of[once], np.arange(run.n + 1))
    return [n_words, char_count, symbols, dup_lines, repeat_words], lines[once].view(np.int64), words_in, line_bounds


def _measured(texts: pa.Array) -> pa.Array:
    columns, lines, words, sizes = [[] for _ in MEASURES], [], [], [np.zeros(1, np.int64)]
    for run in runs(texts):
        values, own_lines, own_words, bounds = _measure(run)
        for column, v in zip(columns, values):
            column.append(v)
        lines.append(own_lines)
        words.append(own_words)
        sizes.append(np.diff(bounds))
    if not columns[0]:
        columns = [[np.zeros(0, np.int64)] for _ in MEASURES]
        lines = words = [np.zeros(0, np.int64)]
    entries = pa.StructArray.from_arrays(
        [pa.array(np.concatenate(lines)), pa.array(np.concatenate(words))], ["line", "words"]
    )
    where = pa.array(np.cumsum(np.concatenate(sizes)).astype(np.int32))
    made = [pa.array(np.concatenate(c).astype(np.int64)) for c in columns]
    return pa.StructArray.from_arrays([*made, pa.ListArray.from_arrays(where, entries)], [*MEASURES, "lines"])


def measured(df: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """(key, host, measures, lines) of each row."""
    udf = F.arrow_udf(_measured, f"struct<{KIND}, lines: {LINES}>")
    return df.select(F.col(key).alias("key"), F.col(host).alias("host"), udf(text).alias("m")).select(
        "key", "host", *[f"m.{m}" for m in MEASURES], "m.lines"
    )


def frequent_lines(rows: DataFrame, limit: int) -> DataFrame:
    """(host, line) found in more than ``limit`` documents of the host; equal keys are one document, null keys one each."""
    lines = rows.select("host", "key", F.explode("lines.line").alias("line"))
    # (host, line, key) is combined first, so no task sees all documents of a line.
    docs = F.count_distinct("key") + F.count(F.when(F.col("key").isNull(), 1))
    return lines.groupBy("host", "line").agg(docs.alias("docs")).filter(F.col("docs") > limit).drop("docs")


def with_identity(rows: DataFrame) -> DataFrame:
    """``rows`` with ``own``, which tells rows without a key apart by their lines; null for all others."""
    return rows.withColumn("own", F.when(F.col("key").isNull(), F.xxhash64("host", "lines")))


def verdicts(rows: DataFrame, frequent: DataFrame, least_kept: float) -> DataFrame:
    """(key, own, lines_removed, words_removed, depleted) of each document that has a line; ``rows`` have an identity."""
    keyless = rows.filter("key is null").dropDuplicates(["own"])  # rows with the same lines get the same verdict
    rows = rows.filter("key is not null").unionByName(keyless)
    lines = rows.select("own", "key", "host", F.explode("lines").alias("l")).select("own", "key", "host", "l.line", "l.words")
    marked = null_safe_join(lines, frequent.withColumn("over", F.lit(1)), ["host", "line"], "left")
    removed = F.coalesce(F.sum(F.when(F.col("over") == 1, F.col("words"))), F.lit(0))
    return marked.groupBy("key", "own").agg(
        F.count("over").alias("lines_removed"),
        removed.alias("words_removed"),
        (F.sum("words") - removed < least_kept * F.sum("words")).alias("depleted"),
    )


def without_lines(df: DataFrame, rows: DataFrame, frequent: DataFrame, key: str, text: str, out: str) -> DataFrame:
    """``df`` with the column ``out``: the text without the frequent lines of its host; null stays null."""
    lines = rows.select("key", "host", F.explode("lines.line").alias("line"))
    gone = null_safe_join(lines, frequent, ["host", "line"]).groupBy("key").agg(F.collect_set("line").alias("_gone"))
    joined = null_safe_join(df.withColumn("_key", F.col(key)), gone.withColumnRenamed("key", "_key"), ["_key"], "left")
    return joined.withColumn(out, _cut(text, "_gone")).drop("_key", "_gone")


def _cut(text: str, gone: str) -> Column:
    def cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
        made = []
        for value, lines in zip(texts, gone):
            value, lines = value.as_py(), set(lines.as_py() or ())
            if value and lines:
                kept = []
                for line in value.split("\n"):
                    run = next(runs(pa.array([line])))
                    starts, ends = run.ranges(NOT_SPACE)
                    h = hash_sequences(hash_ranges(run.data, starts, ends, LOWER), np.array([0]), np.array([len(starts)]))
                    if not len(starts) or int(h.view(np.int64)[0]) not in lines:
                        kept.append(line)
                value = "\n".join(kept)
            made.append(value)
        return pa.array(made, pa.string())

    return F.arrow_udf(cut, "string")(text, gone)
