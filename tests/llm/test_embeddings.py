from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from lectern.llm import embeddings as emb
from lectern.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def brute(rows, least):
    """Links of each row, and least key of each component."""
    groups = defaultdict(list)
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            groups[label, len(v)].append(i)
    links, up = defaultdict(set), {r[0]: r[0] for r in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for own in groups.values():
        x = np.array([rows[i][1] for i in own], float)
        norm = np.linalg.norm(x, axis=1)
        for a, b in np.argwhere(x @ x.T >= least * norm[:, None] * norm[None]):
            if a != b:
                links[own[a]].add(own[b])
                p, q = find(rows[own[a]][0]), find(rows[own[b]][0])
                up[max(p, q)] = min(p, q)
    return {r[0]: (len(links[i]), find(r[0])) for i, r in enumerate(rows)}


def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    want = brute(rows, 0.93)
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op9_embeddings"](spark, FOLDER).collect()}
    assert set(got) == set(want)
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert all(got[k][0] <= want[k][0] for k in want)
    assert np.mean([got[k] == want[k] for k in want]) > 0.99


def test_hot_cells_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(emb, "MEMBERS", 30)
    monkeypatch.setattr(emb, "QUERIES", 25)
    rng = np.random.default_rng(1)
    center = rng.normal(size=(4, 16))
    rows = [(i, [float(x) for x in center[i % 4] + 0.15 * rng.normal(size=16)], 1 if i % 3 else 2) for i in range(300)]
    rows += [(300 + i, rows[5][1], 1) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = brute([(r.vec_id, r.embedding, r.label) for r in df.collect()], 0.93)
    got = {r.key: (r.n_links, r.component) for r in emb.near_duplicates(df, "vec_id", "embedding", "label", 0.93).collect()}
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert all(got[k][0] <= want[k][0] for k in want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.1], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
            (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [1.0, 0.0, 0.0], 1),
            (12, [1.0, 0.0], 1), (13, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for table in (df, df.filter("vec_id = 5"), df.limit(0)):
        got = {r.key: (r.n_links, r.component) for r in emb.near_duplicates(table, "vec_id", "embedding", "label", 0.93).collect()}
        assert got == {k: v for k, v in brute(rows, 0.93).items() if k in got} or len(got) == 1
        assert len(got) == table.count()


def test_cells_come_in_ascending_distance():
    rng = np.random.default_rng(2)
    a, b = rng.random(emb.CODES), rng.random(emb.CODES)
    cells = emb.multi_sequence(a, b, 0.8)
    cost = [a[c // emb.CODES] + b[c % emb.CODES] for c in cells]
    assert cost == sorted(cost) and len(set(cells)) == len(cells) == int((a[:, None] + b[None] <= 0.8).sum())


def test_links_in_a_cell_beyond_the_limit_count_once():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6, 16))[np.arange(120) % 6] + 0.05 * rng.normal(size=(120, 16))
    grid = emb.fit(x[:30], 0.93)
    d = grid.distances(x)
    cell = grid.cell(d)
    own = d[0].min(axis=1) + d[1].min(axis=1)
    cos = x @ x.T / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)[None]
    for limit in (-1.0, float(np.median(own))):  # all, and half, of the vectors are farther from their own cell
        grid.limit = limit
        visits = [list(dict.fromkeys([int(c), *emb.multi_sequence(a, b, limit)])) for c, a, b in zip(cell, *d)]
        table = pa.table({
            "cls": np.arange(120), "vec": x.tolist(), "w": np.ones(120, np.int64), "cell": pa.array(cell, pa.int32()),
            "visits": pa.array(visits, pa.list_(pa.int32())),
        })
        meets = np.array([[c in v for c in cell] for v in visits])
        want = ((cos >= 0.93) & (meets | meets.T) & ~np.eye(120, dtype=bool)).sum(axis=1)
        found = emb._linked(table, table, grid, 0.93).filter(pa.compute.field("other").is_null())
        got = dict(zip(found["cls"].to_pylist(), found["links"].to_pylist()))
        assert sum(got.values()) > 0 and [got.get(k, 0) for k in range(120)] == want.tolist()


@pytest.mark.parametrize("n", [1, 2, 50])
def test_small_samples_fit(n):
    assert emb.fit(np.random.default_rng(3).normal(size=(n, 7)), 0.93).limit > 0
