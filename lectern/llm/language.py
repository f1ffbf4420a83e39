"""Language of the words of a text, by a linear-chain conditional random field.

A word is a run of Unicode letters and their marks.  Its features are prefixes and suffixes of one to three
bytes, inner pairs and triples of bytes, and the lexicon it belongs to (words that
the sample has almost only in one language), hashed into ``SLOTS`` weights per
language.  Weights and transitions between languages are learned together by
gradient ascent on the likelihood of the sample, whose words carry the language of
their text.  Forward-backward then gives every word of a whole text its
probabilities; the text's language has the largest share of them, and that share is
the score.  ``spans`` are the stretches of words of one most probable language.

The model is fitted on a bounded sample of every language: ``per_language`` texts of
each, of ``fit_chars`` characters at most.  Longer texts are left out of the fit, unless
the language has no others: then their first ``fit_chars`` are taken.  With over
``FULL_LANGUAGES`` languages each has fewer texts, so that texts times languages stay
the same, but one at least.  Prediction covers every text whole.

Null texts, texts without letters, and all texts when nothing was learned, are
``und`` with score 0.  Ties go to the first language in alphabetical order.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.text import LOWER, Run, hash_ranges, mix, runs

SLOTS = 1 << 16
FULL_LANGUAGES = 64
RUN = 1 << 21  # bytes, with up to 16 languages; fewer with more, as the memory grows with both
NONE = "und"


@dataclass
class Words:
    """Distinct words of a run of texts, and each occurrence's number among them."""

    run: Run
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    first: np.ndarray
    back: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, run: Run) -> Words:
        starts, ends = run.words()
        hashes = hash_ranges(run.data, starts, ends, LOWER)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        return cls(run, starts, ends, run.per_text(starts), first, back, distinct)


def _slots(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of the distinct words: (word, slot) pairs ordered by word."""
    data = LOWER[words.run.data]
    starts, ends = words.starts[words.first], words.ends[words.first]
    n = len(starts)
    word, slot = [], []
    for k in (1, 2, 3):
        for salt, a, b in ((k, starts, np.minimum(starts + k, ends)), (8 + k, np.maximum(ends - k, starts), ends)):
            word.append(np.arange(n))
            slot.append(_slot(_bytes(data, a, b), salt))
    for k in (2, 3):
        count = np.maximum(ends - starts - k + 1, 0)
        owner = np.repeat(np.arange(n), count)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + starts[owner]
        word.append(owner)
        slot.append(_slot(_bytes(data, at, at + k), 16 + k))
    word, slot = np.concatenate(word), np.concatenate(slot)
    order = np.argsort(word, kind="stable")
    return word[order], slot[order]


def _bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Up to three bytes as one number."""
    code = np.ones(len(starts), np.uint64)
    for k in range(3):
        use = starts + k < ends
        code = np.where(use, code * np.uint64(256) + data[np.minimum(starts + k, len(data) - 1)], code)
    return code


def _slot(code: np.ndarray, salt: int) -> np.ndarray:
    return (mix(code + np.uint64(salt << 40)) >> np.uint64(48)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # slot x language
    lexicon: np.ndarray  # ascending word hashes
    belongs: np.ndarray  # language of each, by number
    bonus: np.ndarray  # language of the lexicon x language
    moves: np.ndarray  # language x next language
    start: np.ndarray

    def emissions(self, words: Words, slots=None) -> np.ndarray:
        """Score of each distinct word and language."""
        n, width = len(words.first), len(self.languages)
        word, slot = slots or _slots(words)
        out = np.stack([np.bincount(word, self.weights[slot, k], n) for k in range(width)], axis=1)
        member = self.members(words)
        hit = member >= 0
        out[hit] += self.bonus[member[hit]]
        return out

    def members(self, words: Words) -> np.ndarray:
        """Language whose lexicon has the word, or -1."""
        if not len(self.lexicon):
            return np.full(len(words.hashes), -1)
        at = np.minimum(np.searchsorted(self.lexicon, words.hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == words.hashes, self.belongs[at], -1)

    def marginals(self, scores: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each word's language, and the expected number of moves between languages.

        All chains advance together, one word a step, the longest first.
        """
        width = len(self.languages)
        e = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
        moves = np.exp(self.moves - self.moves.max())
        size = np.diff(bounds)
        order = np.argsort(-size, kind="stable")
        begin, size = bounds[:-1][order], size[order]
        longest = int(size[0]) if len(size) else 0
        active = np.searchsorted(-size, -np.arange(longest), side="left")  # chains longer than t
        alpha = np.empty((len(e), width))
        a = None
        for t, n in enumerate(active):
            at = begin[:n] + t
            a = (np.exp(self.start - self.start.max()) if t == 0 else a[:n] @ moves) * e[at]
            a /= a.sum(axis=1, keepdims=True)
            alpha[at] = a
        beta = np.empty((len(e), width))
        expected = np.zeros((width, width))
        b = np.zeros((0, width))
        for t in range(longest - 1, -1, -1):
            n = active[t]
            at = begin[:n] + t
            if len(b):
                after = e[at[: len(b)] + 1] * b
                back = after @ moves.T
                joint = alpha[at[: len(b)]].T @ (after / (alpha[at[: len(b)]] * back).sum(axis=1, keepdims=True))
                expected += joint * moves
                b = back / back.sum(axis=1, keepdims=True)
            b = np.concatenate([b, np.full((n - len(b), width), 1 / width)])
            beta[at] = b
        p = alpha * beta
        return p / p.sum(axis=1, keepdims=True) if len(p) else p, expected


def learn(texts: list[str], labels: list[str], rounds: int = 25, penalty: float = 1e-4) -> Model | None:
    """Fit the field on whole texts, each with one language; None without any letters."""
    languages = sorted(set(labels))
    all_runs = list(runs(pa.array(texts, pa.large_string()), 1 << 62))
    if not languages or not all_runs:
        return None
    words = Words.of(all_runs[0])
    if not len(words.back):
        return None
    width, n_words = len(languages), len(words.back)
    text_label = np.array([languages.index(x) for x in labels])
    gold = np.repeat(text_label, np.diff(words.bounds))
    lexicon, belongs = _lexicon(words, gold, text_label, width)
    model = Model(languages, np.zeros((SLOTS, width)), lexicon, belongs, np.zeros((width, width)),
                  np.log(np.full((width, width), 0.05) + np.eye(width)), np.zeros(width))
    slots = _slots(words)
    member = model.members(words)
    occurrences = np.zeros((len(words.first), width))
    np.add.at(occurrences, (words.back, gold), 1.0)
    inner = np.ones(n_words, bool)
    inner[words.bounds[:-1][np.diff(words.bounds) > 0]] = False
    seen_moves = np.zeros((width, width))
    np.add.at(seen_moves, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1.0)
    parts = {"weights": model.weights, "bonus": model.bonus, "moves": model.moves}
    m = {k: np.zeros_like(v) for k, v in parts.items()}
    v = {k: np.zeros_like(x) for k, x in parts.items()}
    for step in range(1, rounds + 1):
        scores = model.emissions(words, slots)[words.back]
        p, expected = model.marginals(scores, words.bounds)
        guess = np.stack([np.bincount(words.back, p[:, k], len(words.first)) for k in range(width)], axis=1)
        off = (occurrences - guess) / n_words
        grad = {
            "weights": np.stack([np.bincount(slots[1], off[slots[0], k], SLOTS) for k in range(width)], axis=1),
            "bonus": np.stack([off[member == k].sum(axis=0) for k in range(width)]),
            "moves": (seen_moves - expected) / n_words,
        }
        for k, part in parts.items():
            g = grad[k] - penalty * part
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.98 * v[k] + 0.02 * g * g
            part += 0.15 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.98**step)) + 1e-8)
    model.weights = model.weights.astype(np.float32)
    return model


def _lexicon(words: Words, gold, text_label, width, least: int = 5, share: float = 0.95):
    """Words in at least ``least`` texts, nearly all of one language."""
    owner = np.repeat(np.arange(words.run.n), np.diff(words.bounds))
    pair = np.unique(words.back.astype(np.int64) * words.run.n + owner)
    word, text = pair // words.run.n, pair % words.run.n
    count = np.zeros((len(words.first), width))
    np.add.at(count, (word, text_label[text]), 1.0)
    total = count.sum(axis=1)
    good = (total >= least) & (count.max(axis=1) >= share * total)
    return words.hashes[good], count[good].argmax(axis=1)


def predict(model: Model | None, texts: pa.Array, with_spans: bool) -> pa.Array:
    names, scores, stretches, sizes = [], [], [], [np.zeros(1, np.int64)]
    size = RUN * 16 // max(16, len(model.languages)) if model else RUN
    for run in runs(texts, size):
        n = run.n
        words = None if model is None else Words.of(run)
        if words is None or not len(words.back):
            names += [NONE] * n
            scores.append(np.zeros(n))
            sizes.append(np.zeros(n, np.int64))
            continue
        p, _ = model.marginals(model.emissions(words)[words.back], words.bounds)
        total = np.zeros((len(p) + 1, p.shape[1]))
        np.cumsum(p, axis=0, out=total[1:])
        count = np.diff(words.bounds)
        share = (total[words.bounds[1:]] - total[words.bounds[:-1]]) / np.maximum(count, 1)[:, None]
        best = share.argmax(axis=1)
        names += [model.languages[k] if c else NONE for k, c in zip(best.tolist(), count.tolist())]
        scores.append(np.where(count > 0, np.minimum(share[np.arange(n), best], 1.0), 0.0))
        if with_spans:
            label = p.argmax(axis=1)
            owner = np.repeat(np.arange(n), count)
            cut = np.ones(len(label), bool)
            cut[1:] = (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])
            at = np.flatnonzero(cut)
            last = np.append(at[1:], len(label)) - 1
            base = run.bounds[owner[at]]
            stretches.append((words.starts[at] - base, words.ends[last] - base, label[at]))
            sizes.append(np.bincount(owner[at], minlength=n))
        else:
            sizes.append(np.zeros(n, np.int64))
    stretches.append([np.zeros(0, np.int64)] * 3)
    start, end, label = (np.concatenate(x) for x in zip(*stretches))
    entries = pa.StructArray.from_arrays(
        [pa.array(start, pa.int64()), pa.array(end, pa.int64()),
         pa.array([model.languages[k] for k in label.tolist()] if model else [], pa.string())],
        ["first_byte", "end_byte", "lang"],
    )
    where = pa.array(np.cumsum(np.concatenate(sizes)).astype(np.int32))
    return pa.StructArray.from_arrays(
        [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0)),
         pa.ListArray.from_arrays(where, entries)],
        ["lang", "score", "spans"],
    )


def fit(
    df: DataFrame, key: str, text: str, label: str, per_language: int = 250, fit_chars: int = 20_000
) -> Model | None:
    """Learn from a sample of the rows with text and label, chosen by a hash of the key."""
    usable = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    usable = usable.filter("label is not null and key is not null and length(text) > 0")
    long = F.length("text") > fit_chars
    named = usable.groupBy("label").agg(F.min(long).alias("long"))
    every = named.agg(F.count("*").alias("n"), F.collect_list(F.when(F.col("long"), F.col("label"))).alias("long")).first()
    usable = usable.filter(~long | F.col("label").isin(every.long)) if every.long else usable.filter(~long)
    usable = usable.withColumn("text", F.substring("text", 1, fit_chars))
    each = max(1, min(per_language, per_language * FULL_LANGUAGES**2 // max(every.n, 1) ** 2))
    order = Window.partitionBy("label").orderBy(F.xxhash64("key"), "key")
    ids = usable.select("key", "label")
    ids = ids.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= each).select("key").distinct()
    # At most each * n keys: the bound of what is broadcast, and of the one task that learns.
    sample = usable.join(F.broadcast(ids), "key", "left_semi").orderBy("key", "label", "text")
    sample = sample.limit(max(per_language * FULL_LANGUAGES, each * every.n))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(text, name) for b in batches for text, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(learn([r[0] for r in rows], [r[1] for r in rows]))]})

    made = sample.select("text", "label").coalesce(1).mapInArrow(train, "model binary").first()
    return pickle.loads(made.model) if made else None


def language(model: Model | None, text: Column, with_spans: bool = False) -> Column:
    """struct(lang, score, spans) of a text; spans stay empty unless asked for."""

    def made(texts: pa.Array) -> pa.Array:
        return predict(model, texts, with_spans)

    kind = "struct<lang: string, score: double, spans: array<struct<first_byte: bigint, end_byte: bigint, lang: string>>>"
    return F.arrow_udf(made, kind)(text)

