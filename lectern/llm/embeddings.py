"""Near-duplicate vectors within a label, found by an inverted multi-index.

Two codebooks, one for each half of the unit vectors, are fitted by k-means on a
bounded sample (``SAMPLE`` vectors by hash order).  Their pairs form a grid of
``CODES`` x ``CODES`` cells, and every vector is indexed in the cell of its two
nearest codes.  A query visits cells in ascending distance (multi-sequence: a heap
over the two sorted code lists) up to a limit.  The limit is calibrated so that
of pairs made at exactly the threshold, the hardest that must be found, ``RECALL`` are
found from either side.  Each candidate is then verified by its cosine in double
precision, so no link is wrong, and few are missed.

Equal vectors of a label form one class, compared once.  A label's cells are cut
into blocks of about ``MEMBERS`` vectors; a cell or block with more is dealt out by hash,
and so are the queries of a block beyond ``QUERIES``: no task holds more than that of a
label.  Each task gives counts of links and a spanning forest of them, not all
pairs.

A vector that is null, empty or zero, or has a null or non-finite component, and one
without a label link with nothing.  Vectors of different lengths never link.  Rows with
equal keys are one vertex of the graph, and each of them gets the links of its own
vector.  A null key has a null component.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.graph import stars
from lectern.session import stage

CODES = 32
SAMPLE = 8_000
RECALL = 0.998
MEMBERS, QUERIES = 4096, 16384
PAIR_VALUES = 1 << 22  # components of the vectors of the pairs that are verified together


@dataclass
class Grid:
    """Two codebooks and the limit of a query's distance to a cell."""

    size: int
    codes: tuple[np.ndarray, np.ndarray]
    limit: float

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Halves of unit vectors; others than the sample's length are padded or cut for the index only."""
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        u = x / np.where(norm > 0, norm, 1.0)
        if u.shape[1] < self.size:
            u = np.pad(u, ((0, 0), (0, self.size - u.shape[1])))
        half = self.size // 2
        return np.ascontiguousarray(u[:, :half]), np.ascontiguousarray(u[:, half : self.size])

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance of each half to each code."""
        return tuple(np.round(_squares(h[:, None, :] - c[None]), 9) for h, c in zip(self.halves(x), self.codes))

    def cell(self, d: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return d[0].argmin(axis=1) * CODES + d[1].argmin(axis=1)

    def reaches(self, x: np.ndarray, own: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Does the query x[k], whose cell is own[k], visit cell[k]?  Its own cell it visits at any distance."""
        h = self.halves(x)
        i, j = cell // CODES, cell % CODES
        far = np.round(_squares(h[0] - self.codes[0][i]), 9) + np.round(_squares(h[1] - self.codes[1][j]), 9)
        return (far <= self.limit) | (cell == own)


def _squares(d: np.ndarray) -> np.ndarray:
    return (d * d).sum(axis=-1)


def multi_sequence(first: np.ndarray, second: np.ndarray, limit: float) -> list[int]:
    """Cells in ascending sum of the two distances, up to the limit."""
    order = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    a, b = [first[k] for k in order[0]], [second[k] for k in order[1]]
    heap, cells = [(a[0] + b[0], 0, 0)], []
    while heap and heap[0][0] <= limit:
        _, i, j = heapq.heappop(heap)
        cells.append(order[0][i] * CODES + order[1][j])
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):  # each cell is entered once: along its row, rows along the first column
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return cells


def _codebook(x: np.ndarray, rounds: int = 10) -> np.ndarray:
    """k-means from the first distinct rows; short samples repeat their last row."""
    start = x[np.sort(np.unique(x, axis=0, return_index=True)[1])[:CODES]]
    codes = np.concatenate([start, np.repeat(start[-1:], CODES - len(start), axis=0)])
    for _ in range(rounds):
        near = (_squares(codes)[None] - 2 * x @ codes.T).argmin(axis=1)
        count = np.bincount(near, minlength=CODES)
        total = np.zeros_like(codes)
        np.add.at(total, near, x)
        codes = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], codes)
    return codes


def fit(sample: np.ndarray, least: float) -> Grid:
    """Codebooks of the sample, and the limit for the similarity ``least``."""
    if sample.shape[1] == 1:
        sample = np.pad(sample, ((0, 0), (0, 1)))
    grid = Grid(sample.shape[1], (np.zeros((CODES, 0)),) * 2, 0.0)
    grid.codes = tuple(_codebook(h) for h in grid.halves(sample))
    rng = np.random.default_rng(0)
    x = np.repeat(sample, max(1, 4000 // len(sample)), axis=0)[:8000]
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
    y = least * x + np.sqrt(1 - least**2) * side
    dx, dy = grid.distances(x), grid.distances(y)
    k = np.arange(len(x))

    def reach(d, cell):
        return d[0][k, cell // CODES] + d[1][k, cell % CODES]

    either = np.minimum(reach(dx, grid.cell(dy)), reach(dy, grid.cell(dx)))
    grid.limit = float(np.quantile(either, RECALL)) + 1e-6
    return grid


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def _placed(classes: DataFrame, grid: Grid) -> DataFrame:
    """Adds each vector's cell and the cells that it visits (its own first)."""
    table = classes.sparkSession.sparkContext.broadcast(grid)
    schema = "cls bigint, cell int, visits array<int>"

    def place(batches):
        grid = table.value
        for batch in batches:
            size = batch.column("dim").to_numpy()
            for dim in np.unique(size):
                part = batch.filter(pa.array(size == dim))
                d = grid.distances(_matrix(part.column("vec")))
                cell = grid.cell(d)
                visits = [list(dict.fromkeys([int(c), *multi_sequence(a, b, grid.limit)])) for c, a, b in zip(cell, *d)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("cls"), pa.array(cell, pa.int32()), pa.array(visits, pa.list_(pa.int32()))],
                    names=["cls", "cell", "visits"],
                )

    return classes.select("cls", "dim", "vec").mapInArrow(place, schema)


def _blocks(placed: DataFrame) -> DataFrame:
    """(label, dim, cell, block, subs): consecutive cells of about MEMBERS vectors, and over how many tasks to deal them.

    A window sees at most one row per cell of the grid.
    """
    cells = placed.groupBy("label", "dim", "cell").agg(F.count("*").alias("n"))
    order = Window.partitionBy("label", "dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("block", F.floor(F.coalesce(F.sum("n").over(order), F.lit(0)) / MEMBERS))
    sizes = cells.groupBy("label", "dim", "block").agg(F.ceil(F.sum("n") / MEMBERS).cast("int").alias("subs"))
    return cells.select("label", "dim", "cell", "block").join(sizes, ["label", "dim", "block"])


def _linked(left: pa.Table, right: pa.Table, grid: Grid, least: float) -> pa.Table:
    """Counts and forest of the links between a block's members (left) and its queries (right)."""
    out = pa.schema([("cls", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])
    if not len(left) or not len(right):
        return out.empty_table()
    members, queries = _matrix(left["vec"]), _matrix(right["vec"])
    norm = np.linalg.norm(members, axis=1), np.linalg.norm(queries, axis=1)
    name, asks = left["cls"].to_numpy(), right["cls"].to_numpy()
    weight, own_weight = left["w"].to_numpy(), right["w"].to_numpy()
    cell, own_cell = left["cell"].to_numpy(), right["cell"].to_numpy()
    order = np.argsort(cell, kind="stable")
    edges = np.searchsorted(cell[order], np.arange(CODES * CODES + 1))
    visits = right["visits"].combine_chunks()
    visited = visits.flatten().to_numpy()
    who = np.repeat(np.arange(len(asks)), np.diff(visits.offsets.to_numpy()))
    count = edges[visited + 1] - edges[visited]
    total = np.concatenate([[0], np.cumsum(count)])
    # Links are counted and joined up block by block; the pairs themselves are not kept.
    nodes = np.unique(np.concatenate([asks, name]))
    node_q, node_m = np.searchsorted(nodes, asks), np.searchsorted(nodes, name)
    links, root = np.zeros(len(nodes)), np.arange(len(nodes))
    pairs, low = max(1, PAIR_VALUES // members.shape[1]), 0
    while low < len(visited):
        high = max(low + 1, int(np.searchsorted(total, total[low] + pairs, "right")) - 1)
        c = count[low:high]
        q = np.repeat(who[low:high], c)
        m = order[np.arange(len(q)) - np.repeat(total[low:high] - total[low], c) + np.repeat(edges[visited[low:high]], c)]
        near = np.einsum("ij,ij->i", queries[q], members[m]) >= least * norm[1][q] * norm[0][m]
        near &= asks[q] != name[m]
        q, m = q[near], m[near]
        if len(q):
            back = grid.reaches(members[m], cell[m], own_cell[q])  # then the member's own query counts the link for itself
            links += np.bincount(node_q[q], weight[m], len(nodes))
            links += np.bincount(node_m[m[~back]], own_weight[q[~back]], len(nodes))
            root = _joined(root, node_q[q], node_m[m])
        low = high
    linked, tied = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(nodes)))
    return pa.table({
        "cls": np.concatenate([nodes[linked], nodes[tied]]),
        "other": pa.array(
            np.concatenate([nodes[linked], nodes[root[tied]]]), mask=np.arange(len(linked) + len(tied)) < len(linked)),
        "links": np.concatenate([links[linked].astype(np.int64), np.zeros(len(tied), np.int64)]),
    }).cast(out)


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of each component after adding the links (a, b)."""
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return root
        low = np.minimum(ra, rb)
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while (root != root[root]).any():
            root = root[root]


def near_duplicates(df: DataFrame, key: str, vector: str, label: str, least: float) -> DataFrame:
    """(key, n_links, component) of each row: other rows linked directly, and the least key reachable by links."""
    spark = df.sparkSession
    v = F.col("vec")
    rows = df.select(
        F.col(key).alias("key"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vec")
    )
    # NaN compares as greater than any number, so infinite and undefined components fail alike.
    finite = F.forall(v, lambda e: e.isNotNull() & (F.abs(e) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & finite & F.exists(v, lambda e: e != 0)
    rows = rows.withColumn("cls", F.when(usable, F.xxhash64("label", F.size(v), v)))
    rows = stage(rows, "vectors")
    good = rows.filter("cls is not null")
    classes = good.groupBy("cls").agg(
        F.any_value("label").alias("label"), F.any_value("vec").alias("vec"), F.count("*").alias("w"),
        F.min("key").alias("least"),
    ).withColumn("dim", F.size("vec"))
    classes = stage(classes, "classes")
    common = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not common:
        return rows.select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component"))
    sample = classes.filter(F.col("dim") == common[0].dim).orderBy("cls").limit(SAMPLE).select("vec").toArrow()
    grid = fit(_matrix(sample["vec"]), least)

    placed = stage(_placed(classes, grid).join(classes, "cls"), "placed")
    blocks = stage(_blocks(placed), "blocks")
    spot = ["label", "dim", "block"]
    members = placed.join(blocks, ["label", "dim", "cell"]).select(
        *spot, F.pmod(F.xxhash64("cls"), F.col("subs")).cast("int").alias("sub"), "cls", "vec", "w", "cell"
    )
    visits = placed.select("cls", "label", "dim", F.explode("visits").alias("cell")).join(blocks, ["label", "dim", "cell"])
    asked = visits.groupBy("cls", *spot, "subs").agg(F.collect_list("cell").alias("visits"))
    asked = stage(asked, "visits")
    parts = asked.groupBy(*spot).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
    asked = asked.join(parts, spot).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
    queries = asked.withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")).join(
        placed.select("cls", "vec", "w", "cell"), "cls"
    )
    members = members.join(parts, spot).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    group = [*spot, "sub", "part"]
    table = spark.sparkContext.broadcast(grid)
    held, wanted = [*group, "cls", "vec", "w", "cell"], [*group, "cls", "vec", "w", "cell", "visits"]
    members, queries = members.select(*held).toDF(*held), queries.select(*wanted).toDF(*wanted)
    found = (
        members.groupBy(*group).cogroup(queries.groupBy(*group))
        .applyInArrow(lambda a, b: _linked(a, b, table.value, least), "cls bigint, other bigint, links bigint")
    )
    found = stage(found, "links")

    direct = found.filter("other is null").groupBy("cls").agg(F.sum("links").alias("links"))
    counts = classes.select("cls", "w", "least").join(direct, "cls", "left")
    counts = counts.withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("w") - 1)
    names = classes.select("cls", "least")
    edges = found.filter("other is not null").select("cls", "other")
    edges = edges.join(names.withColumnRenamed("least", "a"), "cls").join(
        names.select(F.col("cls").alias("other"), F.col("least").alias("b")), "other"
    ).select("a", "b")
    copies = good.join(names, "cls").select(F.col("key").alias("a"), F.col("least").alias("b"))
    star = stars(edges.unionByName(copies).filter("a is not null and b is not null"))
    joined = rows.select("key", "cls").join(counts.select("cls", "n_links"), "cls", "left")
    joined = joined.join(star.withColumnsRenamed({"a": "key", "b": "least"}), "key", "left")
    return joined.select(
        "key", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("least", "key").alias("component")
    )
