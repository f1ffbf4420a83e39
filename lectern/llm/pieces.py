"""Sampled segmentations of a text into model pieces, without replacement, and decoding.

The lattice of a text has an edge for every piece that starts at a character (and one
for the bytes of a character that is no piece).  A piece of rank r weighs
(r + 1) ** -alpha, and a segmentation has the normalised product of its pieces' weights
as its probability.  As no piece crosses the cuts of ``token_counts``, the
lattice is a chain of those of the parts between them, each computed once per worker.

The search is A* on Gumbel-perturbed log-probabilities.  A region is a prefix of a path with
some next edges excluded; its perturbed value, the exact maximum over all
its paths, is drawn top-down: the root from a Gumbel, the regions that a path leaves behind from Gumbels of their
mass, cut off at the path's value.  Popping the best region, drawing its
best path and splitting the rest gives distinct segmentations in descending
perturbed value, which is sampling without replacement.  With the value kappa of the next
region, a segmentation of log-probability p has the inclusion score 1 - exp(-exp(p - kappa)),
1 if there is no other; long texts have so many segmentations that only its logarithm is
above zero.

Every random number is a hash of the row's key, the sample's number and the place in the
text, so results do not depend on batches or tasks, and equal rows give equal results.  A
null or empty text has one segmentation without pieces.  Texts are sampled
whole.  ``decode`` gives the text back, with U+2581 read as a space as the model does.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.text import Run, hash_ranges, hash_sequences, mix, runs
from lectern.llm.token_counts import MARK, PieceMerges

# Edges that a worker keeps (25 bytes each); bytes of text that are sampled together; ids held before they are passed on.
MOST_EDGES, RUN_BYTES, MOST_HELD = 12_000_000, 1 << 20, 250_000
_FIRST, _SPACE = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())


def _uniform(seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1), one for each seed and place."""
    h = mix(seed ^ (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Lattices:
    """Nodes and edges of the lattices of the parts seen lately, in tables of a fixed size.

    When new parts do not fit, the tables start anew with the parts of the present run.  Only
    a run that needs more than ``MOST_EDGES`` by itself gets larger tables, until the next start.
    """

    def __init__(self, path: str, alpha: float):
        from sentencepiece import SentencePieceProcessor

        merges = PieceMerges(path)
        model = SentencePieceProcessor(model_file=path)
        self.cut = merges.cut
        n = model.get_piece_size()
        self.weight = {p: -alpha * math.log(min(r, n) + 1) for p, r in merges.rank.items()}
        self.number = {p: model.piece_to_id(p) for p in merges.rank}
        self.longest = max(map(len, self.weight))
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = -alpha * math.log(n + 1)
        # The pieces by the hash of their characters.
        code, starts, ends = _characters(list(self.weight))
        hashes = hash_sequences(code, starts, ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.weights = np.array(list(self.weight.values()))[order]
        self.numbers = np.array(list(self.number.values()), np.int32)[order]
        # Characters without a piece are numbered from first_extra on, with the ids of their bytes.
        self.first_extra = n
        self.extra: dict[int, int] = {}
        self.extra_at, self.extra_ids = np.zeros(1, np.int64), np.zeros(0, "<u4")
        self._clear()

    def _clear(self, room: int = 0):
        self.entry: dict[int, int] = {}
        self.n_edges = self.n_nodes = 0
        room = max(room, MOST_EDGES)
        if not hasattr(self, "cum") or len(self.cum) != room:
            self.cum = self.logp = self.piece = self.step = self.end = self.edges_at = None  # not beside the new ones
            self.cum, self.logp, self.piece, self.step, self.end = (np.empty(room, t) for t in "f8 f8 i4 i4 ?".split())
            self.edges_at = np.zeros(room + 1, np.int64)  # a node has an edge at least

    def _extras(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and weights of characters that are no piece."""
        for c in np.unique(codes).tolist():
            if c not in self.extra:
                ids = [self.byte[b] for b in chr(c).encode()]
                self.extra[c] = self.first_extra + len(self.extra)
                self.extra_ids = np.append(self.extra_ids, np.array(ids, "<u4"))
                self.extra_at = np.append(self.extra_at, len(self.extra_ids))
        number = np.array([self.extra[c] for c in codes.tolist()], np.int64)
        size = np.diff(self.extra_at)[number - self.first_extra]
        return number, self.fallback * size

    def entries(self, run: Run, starts, ends) -> np.ndarray:
        """First node of each part of a run."""
        hashes = hash_ranges(run.data, starts, ends)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        names = distinct.tolist()
        new = [k for k, h in enumerate(names) if h not in self.entry]
        if new and not self._add(run, names, starts[first], ends[first], new):
            self._clear()
            self._add(run, names, starts[first], ends[first], range(len(names)), True)
        return np.fromiter(map(self.entry.__getitem__, names), np.int64, len(names))[back]

    def _add(self, run: Run, names: list, starts, ends, which, grow: bool = False) -> bool:
        """Add the lattices of some parts of a run; False if they do not fit."""
        raw = run.data
        parts = [raw[starts[k] : ends[k]].tobytes().decode().replace(" ", MARK) for k in which]
        return self._append([names[k] for k in which], parts, grow)

    def _append(self, names: list, parts: list[str], grow: bool) -> bool:
        """Add the lattices of new parts: a node for each character, its edges in order of length."""
        code, starts, ends = _characters(parts)
        n = len(code)
        left = np.repeat(ends, ends - starts) - np.arange(n)  # characters to the part's end
        node, length, piece, weight = [], [], [], []
        for k in range(1, self.longest + 1):
            at = np.flatnonzero(left >= k)
            if not len(at):
                break
            h = hash_sequences(code, at, at + k)
            found = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[found] == h
            node.append(at[hit])
            piece.append(self.numbers[found[hit]])
            weight.append(self.weights[found[hit]])
            if k == 1 and not hit.all():
                number, penalty = self._extras(code[at[~hit]])
                node.append(at[~hit])
                piece.append(number)
                weight.append(penalty)
            length += [np.full(len(x), k) for x in node[len(length) :]]
        node, length, piece, weight = (np.concatenate(x) for x in (node, length, piece, weight))
        if self.n_edges + len(node) > len(self.cum):
            if not grow:
                return False
            self._clear(len(node))
        # Sums of weights to the end, nodes nearest to an end first.
        order = np.lexsort((length, node, left[node]))
        node, length, piece, weight = node[order], length[order], piece[order], weight[order]
        beta, value = np.zeros(n), np.empty(len(node))
        edges = np.searchsorted(left[node], np.arange(1, int(left.max()) + 2))
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if low == high:
                continue
            own = node[low:high]
            v = weight[low:high] + np.where(length[low:high] < left[own], beta[np.minimum(own + length[low:high], n - 1)], 0.0)
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            top = np.maximum.reduceat(v, first)
            size = np.diff(np.append(first, high - low))
            beta[own[first]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, size)), first))
            value[low:high] = v
        logp = value - beta[node]
        order = np.lexsort((length, node))
        node, length, piece, logp = node[order], length[order], piece[order], logp[order]
        edges_at = np.searchsorted(node, np.arange(n + 1))
        share = np.exp(logp)
        running = np.cumsum(share)
        running -= (running - share)[edges_at[:-1]][node]
        base = self.n_nodes
        cum = base + node + np.minimum(running, 1.0)
        cum[edges_at[1:] - 1] = base + np.arange(n) + 1.0
        self.entry.update(zip(names, (base + starts).tolist()))
        self.edges_at[base : base + n + 1] = self.n_edges + edges_at
        put = slice(self.n_edges, self.n_edges + len(node))
        self.cum[put], self.logp[put], self.piece[put], self.step[put], self.end[put] = cum, logp, piece, length, length == left[node]
        self.n_edges, self.n_nodes = put.stop, base + n
        return True

    def walk(self, node: np.ndarray, seed: np.ndarray, place: np.ndarray):
        """Draw a path from each node to its part's end: (walker, edge, place) of all steps, by walker."""
        walker = np.arange(len(node))
        taken = [(np.zeros(0, np.int64),) * 3]
        while len(walker):
            value = np.minimum(node + _uniform(seed, place), node + (1 - 1e-9))
            edge = self.edges_at[node]  # then on to the first edge above the value: few edges leave a node
            on = np.flatnonzero(self.cum[edge] <= value)
            while len(on):
                edge[on] += 1
                on = on[self.cum[edge[on]] <= value[on]]
            taken.append((walker, edge, place))
            on = ~self.end[edge]
            step = self.step[edge][on]
            walker, node, seed, place = walker[on], node[on] + step, seed[on], place[on] + step
        walker, edge, place = (np.concatenate(x) for x in zip(*taken))
        order = np.argsort(walker, kind="stable")
        return walker[order], edge[order], place[order]

    def nodes_of(self, edge: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges_at[: self.n_nodes + 1], edge, "right") - 1

    def ids(self, edge: np.ndarray) -> np.ndarray:
        """Model ids of the pieces of edges; a character without a piece gives those of its bytes."""
        piece = self.piece[edge]
        other = np.flatnonzero(piece >= self.first_extra)
        if not len(other):
            return piece.astype("<u4")
        number = piece[other] - self.first_extra
        size = np.ones(len(piece), np.int64)
        size[other] = np.diff(self.extra_at)[number]
        last = np.cumsum(size)
        out = np.empty(last[-1], "<u4")
        out[last - size] = np.minimum(piece, self.first_extra)
        spread = np.arange(size[other].sum()) - np.repeat(np.cumsum(size[other]) - size[other], size[other])
        out[np.repeat((last - size)[other], size[other]) + spread] = self.extra_ids[
            np.repeat(self.extra_at[number], size[other]) + spread
        ]
        return out


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and each one's start and end."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(size)
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64), ends - size, ends


def _left_behind(lattices: Lattices, edge, place, seed, start: float, bound: float):
    """Perturbed values of the regions that a path leaves at each of its steps; ``start`` is the prefix's log-probability."""
    logp = lattices.logp[edge]
    before = start + np.cumsum(logp) - logp
    with np.errstate(divide="ignore"):
        mass = before + np.log(-np.expm1(np.minimum(logp, 0.0)))
    return _cut_gumbel(mass, bound, _uniform(np.full(len(edge), seed ^ np.uint64(0xC2B2AE3D27D4EB4F)), place))


def _cut_gumbel(mass, bound: float, u):
    """Gumbel of location ``mass`` given that it is at most ``bound``."""
    return -np.logaddexp(-bound, np.log(-np.log(u)) - mass)


def sample(lattices: Lattices, texts: pa.Array, keys: np.ndarray, k: int) -> Iterator[tuple]:
    """(row, number, ids, log probability, perturbed value, log inclusion score) of up to k segmentations of each text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    size = pc.binary_length(texts).to_numpy()
    group = (np.cumsum(size) - size) // RUN_BYTES
    bounds = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for low, high in zip(bounds[:-1], bounds[1:]):  # the copies below are those of a few texts
        some = pc.replace_substring(texts[low:high], MARK, " ")
        some = pc.if_else(pc.equal(some, ""), some, pc.binary_join_element_wise(_FIRST, some, _SPACE))
        for run in runs(some, RUN_BYTES):
            run.first += low
            yield from _sample(lattices, run, keys, k)


def _sample(lattices: Lattices, run: Run, keys: np.ndarray, k: int) -> Iterator[tuple]:
    cut = np.zeros(len(run.data) + 1, bool)
    if len(run.data):
        cut[1:-1] = lattices.cut[run.data[:-1], run.data[1:]]
    cut[run.bounds] = True
    edges = np.flatnonzero(cut) if len(run.data) else np.zeros(1, np.int64)
    starts, ends = edges[:-1], edges[1:]
    nodes = lattices.entries(run, starts, ends) if len(starts) else np.zeros(0, np.int64)
    bounds = run.per_text(starts)
    owner = np.repeat(np.arange(run.n), np.diff(bounds))
    place = starts - run.bounds[owner]
    seeds = mix(keys[run.first : run.first + run.n])
    yield from _sample_run(lattices, run, nodes, place, owner, bounds, seeds, k)


def _sample_run(lattices, run, nodes, place, owner, bounds, seeds, k):
    n = run.n
    first = [np.uint64(0x2545F4914F6CDD1D * (s + 1) % (1 << 64)) for s in range(k + 1)]
    with np.errstate(over="ignore"):
        salted = [mix(seeds ^ f) for f in first]
    part, edge, at = lattices.walk(nodes, salted[0][owner], place)
    split = np.searchsorted(owner[part], np.arange(n + 1))
    roots = -np.log(-np.log(_uniform(seeds, np.full(n, 1 << 40))))
    paths = [[None] * k for _ in range(n)]  # (edges, places, parts) of each sample
    heaps: list[list] = [[] for _ in range(n)]
    found: list[list] = [[] for _ in range(n)]

    def settle(d, number, path, start, values, value, prefix):
        """Record a path and the regions left behind from its step ``start`` on; only the best can ever be popped."""
        paths[d][number] = path
        found[d].append((path[0], prefix, value))
        most = k - number
        if len(values) > most:
            best = np.argpartition(-values, most)[:most]
        else:
            best = np.arange(len(values))
        for i in best.tolist():
            if values[i] > -math.inf:
                heapq.heappush(heaps[d], (-values[i], number, start + i, ()))

    logp = lattices.logp[edge]
    with np.errstate(over="ignore"):
        for d in range(n):
            own = slice(split[d], split[d + 1])
            values = _left_behind(lattices, edge[own], at[own], salted[0][d], 0.0, roots[d])
            settle(d, 0, (edge[own], at[own], part[own]), 0, values, roots[d], float(logp[own].sum()))
    for number in range(1, k):
        chosen = [_branch(lattices, heaps[d], paths[d], salted[number][d]) if heaps[d] else None for d in range(n)]
        open_ = [d for d in range(n) if chosen[d] is not None]
        # Walkers: what is left of the part where the path leaves, and all later parts of the text.
        walk_nodes, walk_place, walk_part = [], [], []
        for d in open_:
            _, path, t, edge_new, _ = chosen[d]
            p = path[2][t]
            if not lattices.end[edge_new]:
                step = int(lattices.step[edge_new])
                walk_nodes.append([lattices.nodes_of(edge_new) + step])
                walk_place.append([path[1][t] + step])
                walk_part.append([p])
            walk_nodes.append(nodes[p + 1 : bounds[d + 1]])
            walk_place.append(place[p + 1 : bounds[d + 1]])
            walk_part.append(np.arange(p + 1, bounds[d + 1]))
        if not open_:
            break
        walk_nodes, walk_place, walk_part = (np.concatenate(x).astype(np.int64) for x in (walk_nodes, walk_place, walk_part))
        walker, edge, at = lattices.walk(walk_nodes, salted[number][owner[walk_part]], walk_place)
        part = walk_part[walker]
        split = np.searchsorted(owner[part], np.arange(n + 1))
        with np.errstate(over="ignore"):
            for d in open_:
                value, path, t, edge_new, rest = chosen[d]
                own = slice(split[d], split[d + 1])
                whole = tuple(
                    np.concatenate([old[:t], [here], new[own]])
                    for old, here, new in zip(path, (edge_new, path[1][t], path[2][t]), (edge, at, part))
                )
                logp = lattices.logp[whole[0]]
                to_new = float(logp[: t + 1].sum())
                values = _left_behind(lattices, edge[own], at[own], salted[number][d], to_new, value)
                settle(d, number, whole, t + 1, values, value, float(logp.sum()))
                if rest is not None:
                    mass, excluded = rest
                    u = _uniform(salted[number][d : d + 1] ^ np.uint64(0x165667B19E3779F9), path[1][t : t + 1])
                    left = float(_cut_gumbel(mass, value, u)[0])
                    heapq.heappush(heaps[d], (-left, number, t, excluded))
    for d in range(n):
        kappa = -heaps[d][0][0] if heaps[d] and len(found[d]) == k else -math.inf
        for number, (edges, logp, value) in enumerate(found[d]):
            yield run.first + d, number, lattices.ids(edges), logp, float(value), _log_inclusion(logp - kappa)
        found[d] = paths[d] = heaps[d] = None


def _log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x)))"""
    if x > 3:
        return math.log1p(-math.exp(-math.exp(min(x, 50.0))))
    return math.log(-math.expm1(-math.exp(x))) if x > -700 else x


def _branch(lattices: Lattices, heap: list, paths: list, seed):
    """Pop the best region and draw its next edge: (value, path, step, edge, what is left at that node)."""
    value, number, t, excluded = heapq.heappop(heap)
    path = paths[number]
    old = int(path[0][t])
    node = int(lattices.nodes_of(old))
    barred = (*excluded, old)
    options = [e for e in range(lattices.edges_at[node], lattices.edges_at[node + 1]) if e not in barred]
    share = np.exp(lattices.logp[options])
    u = float(_uniform(np.array([seed ^ np.uint64(0x27D4EB2F165667C5)]), path[1][t : t + 1])[0])
    pick = min(int(np.searchsorted(np.cumsum(share), u * share.sum(), "right")), len(options) - 1)
    rest = None
    if len(options) > 1:
        before = float(lattices.logp[path[0][:t]].sum())
        rest = before + math.log(share.sum() - share[pick]), barred
    return -value, path, t, options[pick], rest


@lru_cache(maxsize=2)
def lattices(path: str, alpha: float) -> Lattices:
    return Lattices(path, alpha)


def sampled(
    df: DataFrame, key: str, text: str, path: str, k: int, alpha: float = 1.0, keep: Sequence[str] = (),
    decoded: str | None = None,
) -> DataFrame:
    """(key, columns to keep, sample, ids, log_prob, perturbed, log_inclusion): up to k distinct segmentations of each text.

    ``decoded`` names one more column, the text that the ids give: for less memory than ``decode`` behind it, which
    takes a worker of its own.
    """
    kept = [key, *keep]
    rows = df.select(
        *[F.col(c).alias(f"keep{n}") for n, c in enumerate(kept)], F.xxhash64(key).alias("seed"), F.col(text).alias("text")
    )
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in kept]).add("sample", "long").add("ids", "binary")
    schema = schema.add("log_prob", "double").add("perturbed", "double").add("log_inclusion", "double")
    if decoded:
        schema = schema.add(decoded, "string")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, table = to_arrow_schema(schema), lattices(path, alpha)

        def packed(batch, held):
            row, number, ids, *scores = zip(*held)
            texts = [pa.array(map(decoder(path).text, ids), pa.string())] if decoded else []
            return pa.RecordBatch.from_arrays([
                *[batch.column(n).take(pa.array(row)) for n in range(len(kept))], pa.array(number, pa.int64()),
                pa.array([x.tobytes() for x in ids], pa.binary()), *[pa.array(s, pa.float64()) for s in scores], *texts,
            ], schema=arrow)

        for batch in batches:
            held, size = [], 0
            for got in sample(table, batch.column("text"), batch.column("seed").to_numpy().view(np.uint64), k):
                held.append(got)
                size += len(got[2])
                if size > MOST_HELD:
                    yield packed(batch, held)
                    held, size = [], 0
            if held:
                yield packed(batch, held)

    return rows.mapInArrow(make, schema)


class Decoder:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        raw = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(names)
        ]
        self.size = np.array([len(x) for x in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(raw), np.uint8)

    def text(self, ids: np.ndarray) -> str:
        size = self.size[ids]
        total = np.cumsum(size)
        at = np.repeat(self.start[ids] - total + size, size) + np.arange(total[-1] if len(total) else 0)
        return self.flat[at].tobytes().decode(errors="replace").removeprefix(" ")


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def decode(ids: Column, path: str) -> Column:
    """Text of a binary column of little-endian 32-bit ids; null stays null."""

    def decoded(values: pa.Array) -> pa.Array:
        d = decoder(path)
        texts = [None if not v.is_valid else d.text(np.frombuffer(v.as_buffer(), "<u4")) for v in values]
        return pa.array(texts, pa.string())

    return F.arrow_udf(decoded, "string")(ids)
