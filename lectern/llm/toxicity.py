"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters look at the words (runs of Unicode letters, A-Z lowered) of a whole text: one votes if
the text has a given whole word, a word with a given beginning, or two different words
with it.  The fixed lexicon
gives some; the labelled sample gives the others, taken greedily as long as each
explains labelled texts that no earlier voter does.  Pattern voters look at the shape of the
text (masked words, shouting, exclamation marks).

The label model takes each row's unknown true label and the given label as noisy.  By
expectation-maximisation it estimates how often each voter votes on toxic and on
clean texts, and from the correlation of voters given the label how far their votes repeat each
other; correlated voters share their weight.  Its posterior labels train a logistic
regression on the same features, whose probability is the score.  There a voter of the lexicon keeps at least the weight
that it has by itself: how much likelier its vote is in toxic texts, where one that the sample does not hold is taken
to be right.  So one insult counts although those of the sample come in dozens.

The fit uses a bounded sample: up to ``per_class`` rows of each label of at most
``fit_chars`` characters (longer ones are left out, never cut), chosen by a hash of
the key; the share of toxic rows comes from all labelled rows.  A labelled row that repeats counts as
often as it is there, rows of one key are taken together.  Scoring covers every text whole, a long one by itself; equal
texts get equal scores, and ties need no order.  Null and empty texts get the score of a text without any
vote.  Without labelled rows of both kinds there is only the fixed lexicon, with a
fixed weight.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.text import LETTER, LOWER, Run, hash_ranges, mix, runs
from lectern.operators.skew import first_n_per_key
from lectern.session import stage

# Common English insults.
LEXICON = ["idiot", "moron", "stupid", "dumb", "scum", "trash", "garbage", "worthless", "pathetic", "disgusting", "loser",
           "clown", "fool", "imbecile", "filth", "vermin", "bastard", "bitch", "fuck", "shit", "asshole", "cunt", "whore"]
BEGINNINGS = (3, 4, 5, 6, 7, 8)
PATTERNS = ["masked", "shouting", "exclaiming"]
LEAST_BIAS = math.log(0.005 / 0.995)  # labels are noisy: no text without votes is cleaner than that
PARTS = 8  # a power of two
TWICE = np.uint64(0x100)  # marks a beginning of two words
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
MARK = np.zeros(256, bool)
MARK[list(b"*#@$%")] = True


def _features(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of all beginnings and whole words of the distinct words of each text; equal pairs may repeat.

    A beginning that two different words of a text share is one more feature.
    """
    starts, ends = run.words()
    owner = np.repeat(np.arange(run.n), np.diff(run.per_text(starts)))
    salt = mix(np.arange(1, run.n + 1, dtype=np.uint64))
    whole = hash_ranges(run.data, starts, ends, LOWER)
    _, once = np.unique(whole ^ salt[owner], return_index=True)
    starts, ends, owner = starts[once], ends[once], owner[once]
    texts, features = [owner], [whole[once]]
    for k in BEGINNINGS:
        longer = ends - starts > k
        own = owner[longer]
        # A beginning is marked so that it differs from the same letters as a whole word.
        feature = hash_ranges(run.data, starts[longer], starts[longer] + k, LOWER) ^ np.uint64(k)
        named = feature ^ salt[own]
        order = np.argsort(named)
        again = order[1:][named[order[1:]] == named[order[:-1]]]
        texts += [own, own[again]]
        features += [feature, feature[again] ^ TWICE]
    return np.concatenate(texts), np.concatenate(features)


def _patterns(run: Run) -> np.ndarray:
    """text x pattern votes."""
    data, out = run.data, np.zeros((run.n, len(PATTERNS)), bool)
    size = np.maximum(np.diff(run.bounds), 1)
    count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[run.bounds])
    inner = np.zeros(len(data), bool)
    if len(data) > 2:
        inner[1:-1] = MARK[data[1:-1]] & LETTER[data[:-2]] & LETTER[data[2:]]
    out[:, 0] = count(inner) > 0
    letters = count(LETTER[data])
    out[:, 1] = (letters > 20) & (count(UPPER[data]) > 0.6 * letters)
    out[:, 2] = count(data == 0x21) > 0.02 * size
    return out


@dataclass
class Model:
    features: np.ndarray  # ascending hashes of the voters' words and beginnings
    weights: np.ndarray
    pattern_weights: np.ndarray
    bias: float

    def score(self, run: Run) -> np.ndarray:
        text, k = votes(run, self.features)
        x = np.bincount(text, self.weights[k], run.n) + _patterns(run) @ self.pattern_weights + self.bias
        return 1 / (1 + np.exp(-x))


def votes(run: Run, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, number of a known feature) pairs."""
    text, feature = _features(run)
    # One bit per value of the low bits first: nearly all words belong to no voter.
    mask = np.zeros(1 << 18, bool)
    low = np.uint64((1 << 18) - 1)
    mask[(known & low).astype(np.int64)] = True
    maybe = mask[(feature & low).astype(np.int64)]
    text, feature = text[maybe], feature[maybe]
    if not len(known) or not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, feature), len(known) - 1)
    hit = known[at] == feature
    pair = np.unique(text[hit].astype(np.int64) * len(known) + at[hit])
    return pair // len(known), pair % len(known)


def lexicon_features() -> np.ndarray:
    run = next(runs(pa.array(LEXICON)))
    starts, ends = run.bounds[:-1], run.bounds[1:]
    whole = hash_ranges(run.data, starts, ends)
    k = (ends - starts).astype(np.uint64)
    begin = np.isin(k, BEGINNINGS) & (k >= 5)  # "idiots" counts, but a short stem may begin another word
    return np.unique(np.concatenate([whole, whole[begin] ^ k[begin]]))


def _find_voters(texts: pa.Array, toxic: np.ndarray, precision: float = 0.9) -> np.ndarray:
    """Features nearly only in toxic texts, each explaining some that no earlier one does; the widest first.

    The least support is such that chance would give a hundredth of a feature.
    """
    # How many toxic texts have a feature of each bucket; a feature of a rare bucket is rare itself.
    bucket = np.zeros(1 << 22, np.int64)
    bad = texts.filter(pa.array(toxic))
    for _, feature in _distinct_pairs(bad):
        bucket += np.bincount((feature >> np.uint64(42)).astype(np.int64), minlength=len(bucket))
    least = max(4, math.ceil(math.log(100 * max(np.count_nonzero(bucket), 1)) / -math.log(toxic.mean())))
    names, support, clean, backs, owners = [], [], [], [], []
    for part in range(PARTS):  # of the features, by their hash, so that a part of all pairs is held at a time
        some = _of_part(bad, bucket >= least, part)
        own, back, n = np.unique(some[1], return_inverse=True, return_counts=True)
        in_clean = np.zeros(len(own) + 1, np.int64)
        for _, feature in _distinct_pairs(texts.filter(pa.array(~toxic))):
            at = np.minimum(np.searchsorted(own, feature), max(len(own) - 1, 0))
            if len(own):
                in_clean += np.bincount(at[own[at] == feature], minlength=len(own) + 1)
        in_clean = in_clean[:-1]
        good = (n >= least) & (n >= precision * (n + in_clean))
        number = np.cumsum(good) - 1 + sum(map(len, names))
        keep = good[back]
        backs.append(number[back[keep]])
        owners.append(some[0][keep])
        names.append(own[good])
        support.append(n[good])
        clean.append(in_clean[good])
    names, support, clean, back, holders = (np.concatenate(x) for x in (names, support, clean, backs, owners))
    order = np.argsort(back, kind="stable")
    back, holders = back[order], holders[order]
    edges = np.searchsorted(back, np.arange(len(names) + 1))
    explained = np.zeros(len(bad), np.int64)
    chosen = []
    # Wide support first; of equal support the one with fewer clean texts.
    for k in sorted(range(len(names)), key=lambda k: (-support[k], clean[k], int(names[k]))):
        own = holders[edges[k] : edges[k + 1]]
        if (explained[own] == 0).sum() >= max(4, least // 4):
            chosen.append(names[k])
            explained[own] += 1
    return np.array(chosen, np.uint64)


def _of_part(texts: pa.Array, often: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs of one part of the features, without those of rare buckets."""
    kept = [(np.zeros(0, np.int32), np.zeros(0, np.uint64))]
    for text, feature in _distinct_pairs(texts):
        use = (feature & np.uint64(PARTS - 1)) == part
        use &= often[(feature >> np.uint64(42)).astype(np.int64)]
        kept.append((text[use].astype(np.int32), feature[use]))
    return tuple(np.concatenate(x) for x in zip(*kept))


def _distinct_pairs(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, feature) without repeats, a run of texts at a time."""
    for run in runs(texts, 1 << 18):
        text, feature = _features(run)
        order = np.lexsort((feature, text))
        text, feature = text[order], feature[order]
        fresh = np.ones(len(text), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])
        yield text[fresh] + run.first, feature[fresh]


def label_model(voted: np.ndarray, given: np.ndarray, prior: float, rounds: int = 15, trust: float = 0.95) -> np.ndarray:
    """Probability that each row is toxic, from votes (row x voter) and noisy given labels (nan: none)."""
    n, m = voted.shape
    v = voted.astype(float)
    evidence = np.where(np.isnan(given), 0.0, np.where(given > 0.5, 1.0, -1.0)) * np.log(trust / (1 - trust))
    base = np.log(prior / (1 - prior))
    p = 1 / (1 + np.exp(-(base + evidence)))
    for _ in range(rounds):
        toxic, clean = max(p.sum(), 1e-9), max((1 - p).sum(), 1e-9)
        rate = ((p @ v + 0.5) / (toxic + 1), ((1 - p) @ v + 0.1) / (clean + 1))
        # Correlation of voters given the label: mean product of residuals within each label.
        share = np.zeros((m, m))
        for weight, mean in ((p, rate[0]), (1 - p, rate[1])):
            r = (v - mean) * np.sqrt(weight)[:, None]
            c = r.T @ r
            d = np.sqrt(np.maximum(np.diag(c), 1e-9))
            share = np.maximum(share, c / d[:, None] / d[None, :])
        np.fill_diagonal(share, 1.0)
        discount = 1 / np.where(share > 0.2, share, 0.0).sum(axis=1)
        yes = np.log(rate[0] / rate[1]) * discount
        no = np.log((1 - rate[0]) / (1 - rate[1])) * discount
        p = 1 / (1 + np.exp(-np.clip(base + evidence + v @ yes + (1 - v) @ no, -30, 30)))
    return p


def prior_weights(voted: np.ndarray, toxic: np.ndarray, most: float = 5.0) -> np.ndarray:
    """Log of how much likelier each vote is in toxic texts; a voter without votes is taken to be right."""
    bad, clean = voted[toxic].sum(axis=0), voted[~toxic].sum(axis=0)
    ratio = np.log((bad + 1) / (toxic.sum() + 20)) - np.log((clean + 0.01) / ((~toxic).sum() + 20))
    return np.clip(ratio, 0.0, most)


def _logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, least: np.ndarray, rounds: int = 1500, penalty: float = 1e-6
):
    """Weights, none below ``least``, and bias of a logistic regression on soft labels (accelerated, projected gradient steps)."""
    w, b = np.maximum(least, 0.0), math.log(max((weight * y).sum(), 1e-9) / max((weight * (1 - y)).sum(), 1e-9))
    mw, vw = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    weight = weight / weight.sum()
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        off = weight * (p - y)
        g = np.append(x.T @ off + penalty * w, off.sum())
        mw = 0.9 * mw + 0.1 * g
        vw = 0.99 * vw + 0.01 * g * g
        step = 0.1 * (mw / (1 - 0.9**t)) / (np.sqrt(vw / (1 - 0.99**t)) + 1e-9)
        w, b = np.maximum(w - step[:-1], least), max(b - step[-1], LEAST_BIAS)
    return w, b


def learn(texts: pa.Array, labels: np.ndarray, prior: float) -> Model:
    """Fit on whole texts with labels 0 and 1; ``prior`` is the share of 1 among all labelled rows."""
    fixed = lexicon_features()
    toxic = np.asarray(labels) == 1
    if not toxic.any() or toxic.all():
        return Model(fixed, np.full(len(fixed), 3.0), np.zeros(len(PATTERNS)), -3.0)
    known = np.unique(np.concatenate([fixed, _find_voters(texts, toxic)]))
    voted = np.zeros((len(texts), len(known) + len(PATTERNS)), np.float32)
    for run in runs(texts):
        text, k = votes(run, known)
        voted[run.first + text, k] = 1
        voted[run.first : run.first + run.n, len(known) :] = _patterns(run)
    p = label_model(voted, toxic.astype(float), toxic.mean())
    # The sample holds more toxic rows than the table; weights undo that.
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    weight = np.where(toxic, prior / toxic.mean(), (1 - prior) / (1 - toxic.mean()))
    is_fixed = np.append(np.isin(known, fixed), [False] * len(PATTERNS))
    least = np.where(is_fixed, prior_weights(voted, toxic), -np.inf)
    w, b = _logistic(voted.astype(float), p, weight, least)
    return Model(known, w[: len(known)], w[len(known) :], float(b))


def fit(
    df: DataFrame, key: str, text: str, label: str, per_class: int = 4000, fit_chars: int = 20_000
) -> Model:
    """Learn from a sample of the rows with a text and a label of 0 or 1."""
    usable = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    usable = usable.filter(F.col("label").isin(0, 1) & F.col("key").isNotNull())
    usable = usable.filter(F.length("text").between(1, fit_chars))
    counts = {r.label: r.n for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = counts.get(1, 0) / max(sum(counts.values()), 1)
    # The first of each label by a hash of the key, selected slice by slice: no task gets all rows of a label.
    keys = stage(usable.select("label", F.xxhash64("key").alias("h"), "key", F.lit(per_class).alias("most")), "labelled")
    ids = first_n_per_key(keys, "label", ["h", "key"], "most").select("key").distinct()
    # At most 2 * per_class keys: the bound of what is broadcast, and of the one task that learns.
    rows = usable.join(F.broadcast(ids), "key", "left_semi").orderBy("key", "label", "text").limit(2 * per_class)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("text", pa.string()), ("label", pa.int32())])
        table = pa.Table.from_batches([b.cast(kinds) for b in batches], kinds)
        model = learn(table["text"].combine_chunks(), table["label"].to_numpy(), prior)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})

    made = rows.select("text", "label").coalesce(1).mapInArrow(train, "model binary").first()
    return pickle.loads(made.model) if made else learn(pa.array([], pa.string()), np.zeros(0), prior)


def toxicity(model: Model, text: Column) -> Column:
    """Probability that a text is toxic."""

    def scored(texts: pa.Array) -> pa.Array:
        parts = [model.score(run) for run in runs(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return F.arrow_udf(scored, "double")(text)
