"""Similarity join of shingle sets by exact Jaccard similarity, with skipping by set relations.

1. One pass over the texts gives each set's size and two 64-bit sums of its hashes.
   Equal sets form one class; only classes are compared.  The same pass counts in how
   many documents each of ``BUCKETS`` hash buckets occurs.
2. The counts, cut to four grades (once, under 8, under 64, more), order all shingles:
   rare grades first.  Similar sets share a shingle in their first n - ceil(t n) + 1.
   Shingles of a bucket seen once have no partner and are left out of the index, so
   sets without near relatives mostly leave no rows at all.
3. The list of a shingle is cut into blocks of like set sizes; pairs whose sizes or
   positions rule a link out are skipped.  Lists of up to ``SMALL`` sets give all
   their pairs.  In a longer one, a pivot (the entry nearest to what the list has in
   common) is compared with all others, then the next ``PIVOTS``, then all that are left.  A set's
   answers follow from those of a pivot: with distances d(x), d(y) to it, x and y cannot
   link if the two differ by more than 1 - t, and need no test if both are in one
   component already.  A list ends when all its sets are in one component.
4. Every remaining pair is verified on its whole sets; components come from ``graph``.

Nothing is capped: a list goes on until every pair is linked through others, ruled out
or verified.  The bucket grades, broadcast to the tasks, have the fixed size
``BUCKETS`` / 4 bytes; with far more shingles than buckets they discriminate less and
the index grows, but results stay the same.  Sets and shingles are identified by
64-bit hashes.

A text without words has an empty set and links with nothing; with fewer words than a
shingle it has its whole sequence as one.  Null texts count as empty.  Rows with equal
keys are one vertex; a null key links with nothing and is its own (null) component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.graph import stars
from lectern.llm.text import LOWER, NOT_SPACE, Run, hash_ranges, mix, runs, shingles
from lectern.session import stage

BUCKET_BITS, RANGE_BITS = 27, 21
BUCKETS = 1 << BUCKET_BITS
SMALL = 16
PIVOTS = (16, None)  # pivots of a list in the rounds after the first; None: every entry left
FLUSH = 4_000_000
SEEN = 500_000


def _sets(run: Run, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending; their bounds; the sum that identifies each set."""
    starts, ends = run.ranges(NOT_SPACE)
    words = hash_ranges(run.data, starts, ends, LOWER)
    hashes, bounds = shingles(words, run.per_text(starts), width)
    owner = np.repeat(np.arange(run.n), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    bounds = np.searchsorted(owner, np.arange(run.n + 1))
    return hashes, bounds, _set_sums(mix(hashes), bounds)


def _set_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return mix(total[bounds[1:]] - total[bounds[:-1]])


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _gaps(sorted_buckets: np.ndarray) -> bytes:
    """Ascending bucket numbers as 16-bit steps; 65535 is a step without a bucket."""
    steps = np.diff(sorted_buckets, prepend=0)
    skips = steps // 65535
    out = np.full(len(steps) + int(skips.sum()), 65535, np.uint16)
    out[np.arange(len(steps)) + np.cumsum(skips)] = steps % 65535
    return out.tobytes()


def _from_gaps(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint16)
    return np.cumsum(steps, dtype=np.int64)[steps != 65535]


def _first_pass(df: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Rows (key, n, cls, cls2) of each text, and rows (part, blob) with the buckets that occurred."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, n bigint, cls bigint, cls2 bigint, part int, blob binary"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for run in runs(batch.column("text")):
                hashes, bounds, cls = _sets(run, width)
                second = _set_sums(hashes * np.uint64(0x9E3779B97F4A7C15) ^ (hashes >> np.uint64(29)), bounds)
                keys = batch.column("key").slice(run.first, run.n)
                nothing = pa.nulls(run.n)
                yield _batch(schema_of(keys.type), [
                    keys, pa.array(np.diff(bounds)), pa.array(cls.view(np.int64)), pa.array(second.view(np.int64)),
                    nothing.cast(pa.int32()), nothing.cast(pa.binary()),
                ])
                held.append(_bucket(hashes).astype(np.uint32))
                if sum(map(len, held)) > FLUSH:
                    yield from blobs(held, keys.type)
                    held = []
            last = batch.column("key").type
        if held:
            yield from blobs(held, last)

    def schema_of(kind):
        return pa.schema([
            ("key", kind), ("n", pa.int64()), ("cls", pa.int64()), ("cls2", pa.int64()), ("part", pa.int32()),
            ("blob", pa.binary()),
        ])

    def blobs(held, kind):
        every = np.sort(np.concatenate(held)).astype(np.int64)
        edges = np.searchsorted(every, np.arange(0, BUCKETS + 1, 1 << RANGE_BITS))
        parts = [p for p in range(len(edges) - 1) if edges[p + 1] > edges[p]]
        raw = [_gaps(every[edges[p] : edges[p + 1]] - (p << RANGE_BITS)) for p in parts]
        none = pa.nulls(len(parts))
        yield _batch(schema_of(kind), [
            none.cast(kind), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int64()),
            pa.array(parts, pa.int32()), pa.array(raw, pa.binary()),
        ])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(make, schema)


def _batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=schema)


def _grades(blobs: DataFrame) -> np.ndarray:
    """Two bits a bucket: seen at most once, under 8 times, under 64 times, more.  ``BUCKETS`` / 4 bytes in all."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                buckets, times = np.unique(_from_gaps(raw.as_py()), return_counts=True)
                have = counts.setdefault(part, np.zeros(1 << RANGE_BITS, np.uint8))
                have[buckets] = np.minimum(have[buckets].astype(np.int64) + times, 255)
        for part, have in counts.items():
            grade = (have > 1).astype(np.uint8) + (have >= 8) + (have >= 64)
            packed = grade[0::4] | grade[1::4] << 2 | grade[2::4] << 4 | grade[3::4] << 6
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "packed": [packed.tobytes()]})

    parts = blobs.select("part", "blob").repartition(1 << (BUCKET_BITS - RANGE_BITS), "part")
    table = np.zeros(BUCKETS // 4, np.uint8)
    size = (1 << RANGE_BITS) // 4
    for row in parts.mapInArrow(add, "part int, packed binary").collect():
        table[row.part * size : (row.part + 1) * size] = np.frombuffer(row.packed, np.uint8)
    return table


def _index(df: DataFrame, text: str, width: int, percent: int, grades: np.ndarray) -> DataFrame:
    """Rows (shingle, cls, n, pos) of the index, and one (cls, set) for each set that has some."""
    table = df.sparkSession.sparkContext.broadcast(grades)
    arrow = pa.schema([
        ("shingle", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("pos", pa.int64()),
        ("members", pa.list_(pa.int64())),
    ])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grade_of, seen = table.value, set()
        for batch in batches:
            for run in runs(batch.column(0)):
                hashes, bounds, cls = _sets(run, width)
                owner = np.repeat(np.arange(run.n), np.diff(bounds))
                bucket = _bucket(hashes)
                grade = (grade_of[bucket >> 2] >> (2 * (bucket & 3)).astype(np.uint8)) & 3
                order = np.lexsort((hashes, grade, owner))
                n = np.diff(bounds)
                first = n - (percent * n + 99) // 100 + 1
                pos = np.arange(len(hashes)) - bounds[owner]
                keep = (grade[order] > 0) & (pos < first[owner])
                if len(seen) > SEEN:
                    seen.clear()
                new = np.zeros(run.n, bool)
                for i in np.unique(owner[keep]).tolist():
                    if cls[i] not in seen:
                        seen.add(cls[i])
                        new[i] = True
                keep &= new[owner]
                at, names = owner[keep], cls.view(np.int64)
                if not len(at):
                    continue
                yield _batch(arrow, [
                    pa.array(hashes[order][keep].view(np.int64)), pa.array(names[at]), pa.array(n[at]),
                    pa.array(pos[keep]), pa.nulls(len(at), arrow.field(4).type),
                ])
                own = np.flatnonzero(new)
                where = np.concatenate([[0], np.cumsum(n[own])]).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(where), pa.array(hashes[new[owner]].view(np.int64)))
                none = pa.nulls(len(own), pa.int64())
                yield _batch(arrow, [none, pa.array(names[own]), pa.array(n[own]), none, sets])

    return df.select(F.col(text).alias("text")).mapInArrow(
        make, "shingle bigint, cls bigint, n bigint, pos bigint, members array<bigint>"
    )


def _may_link(percent: int, left: str, right: str):
    """By size and position, can the sets of two list entries link?"""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    need = F.ceil((n + m) * percent / (100.0 + percent) - 1e-6)
    rest = F.least(n - F.col(f"{left}.pos"), m - F.col(f"{right}.pos"))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (rest >= need)


def _pair(left: str, right: str) -> list:
    a, b = F.col(f"{left}.cls"), F.col(f"{right}.cls")
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, common, either) of each pair, from the whole sets."""
    left = sets.select(F.col("cls").alias("a"), F.col("members").alias("set_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("members").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.select("a", "b", F.size("set_a").alias("na"), F.size("set_b").alias("nb"),
                       F.size(F.array_intersect("set_a", "set_b")).alias("common"))
    both = both.withColumn("either", F.col("na") + F.col("nb") - F.col("common"))
    return both.withColumn("linked", 100 * F.col("common") >= percent * F.col("either")).drop("na", "nb")


def _class_links(index: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes that give the components of all links."""
    block = F.floor(F.log("n") / (math.log(100 / percent) * 1.0001))
    # The entry with the fewest rarer shingles comes first: the text nearest to what all have in common.
    entry = F.struct("pos", "cls", "n")
    unit = ["shingle", "block"]
    units = index.withColumn("block", F.explode(F.array(block, block - 1)))
    lists = units.groupBy(*unit).agg(F.count("*").alias("m"), F.min(entry).alias("pivot")).filter("m > 1")
    units = stage(units.join(lists, unit), "units")

    small = units.filter(F.col("m") <= SMALL).drop("pivot")
    small = small.alias("x").join(small.alias("y"), unit).filter(F.col("x.cls") < F.col("y.cls"))
    small = small.filter(_may_link(percent, "x", "y")).select(*_pair("x", "y"))
    large = units.filter(F.col("m") > SMALL).withColumn("x", entry)
    first = large.filter("cls <> pivot.cls").filter(_may_link(percent, "x", "pivot")).select(*_pair("x", "pivot"))
    answers = stage(_verified(small.union(first).distinct(), sets, percent), "answers")
    links = answers.filter("linked").select("a", "b")

    # Distance of each entry of a long list to the list's first pivot, where it is known.
    distance = (1 - F.col("common") / F.col("either")).alias("d")
    live = large.filter("cls <> pivot.cls").select(*unit, "cls", "n", "pos", *_pair("x", "pivot"))
    live = live.join(answers.select("a", "b", distance), ["a", "b"], "left").drop("a", "b")
    slack = 1 - percent / 100 + 1e-9
    labels = None
    for pivots_now in PIVOTS:
        if labels is None:
            star = stage(stars(links), "labels")
            least = star.select(F.col("b").alias("cls"), F.col("b").alias("comp")).distinct()
            labels = star.select(F.col("a").alias("cls"), F.col("b").alias("comp")).unionByName(least)
        live = live.drop("comp").join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        live = stage(live, "live")
        open_units = live.groupBy(*unit).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
        live = stage(live.join(open_units.select(*unit), unit), "live")
        if live.isEmpty():
            break
        if pivots_now is None:
            pivots = live
        else:
            order = Window.partitionBy(*unit).orderBy("pos", "cls")
            pivots = live.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= pivots_now)
            pivots = stage(pivots.drop("place"), "pivots")
        met = live.alias("x").join(pivots.alias("y"), unit).filter("x.comp <> y.comp")
        met = met.filter(_may_link(percent, "x", "y"))
        met = met.filter(F.coalesce(F.abs(F.col("x.d") - F.col("y.d")) <= slack, F.lit(True)))
        if pivots_now is None:
            met = met.filter("x.cls < y.cls")
        pairs = met.select(*_pair("x", "y")).distinct().join(answers.select("a", "b"), ["a", "b"], "left_anti")
        found = stage(_verified(pairs, sets, percent), "answers")
        answers = answers.unionByName(found)
        fresh = found.filter("linked").select("a", "b")
        if not fresh.isEmpty():
            links, labels = links.unionByName(fresh), None
        if pivots_now is not None:
            live = live.join(pivots.select(*unit, "cls"), [*unit, "cls"], "left_anti")
    return links


def jaccard_components(df: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """(key, n, component) of each row: its set's size and the least key reachable by links of ``percent`` or more."""
    spark = df.sparkSession
    first = stage(_first_pass(df, key, text, width), "sets")
    rows = first.filter("blob is null").select("key", "n", "cls", "cls2")
    grades = _grades(first.filter("blob is not null"))
    made = stage(_index(df, text, width, percent, grades), "index")
    index = made.filter("shingle is not null").select("shingle", "cls", "n", "pos").distinct()
    sets = made.filter("shingle is null").select("cls", "members").dropDuplicates(["cls"])
    sets = stage(sets, "members")
    links = _class_links(index, sets, percent)

    usable = rows.filter("n > 0 and key is not null")
    classes = usable.groupBy("n", "cls", "cls2").agg(F.min("key").alias("least"))
    names = stage(classes.select("cls", "least"), "classes")
    copies = usable.join(names, "cls").filter("key <> least").select(F.col("key").alias("a"), F.col("least").alias("b"))
    between = links.join(names.select(F.col("cls").alias("a"), F.col("least").alias("la")), "a").join(
        names.select(F.col("cls").alias("b"), F.col("least").alias("lb")), "b"
    )
    edges = copies.unionByName(between.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    star = stars(edges).select(F.col("a").alias("key"), F.col("b").alias("least"))
    joined = rows.join(star, "key", "left")
    return joined.select("key", "n", F.coalesce("least", "key").alias("component"))
