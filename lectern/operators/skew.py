"""Positions within ordered groups that stay safe when one group holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.joins import shuffled
from lectern.session import stage

# Bounds of slices: their number, and the rows that are sampled to cut a table into them.
MOST_SLICES, SAMPLED = 1 << 16, 400_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL keys meet each other; the right key columns are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def spread_position(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """``row_number`` over (keys; order) computed on range partitions.

    The rows are range-partitioned on (keys, order), so a big group spans many
    tasks.  Each row's place inside its partition plus the rows of its group in
    earlier partitions is its position.  ``order`` must be a total order.  The
    sorted rows are written once: both uses must see the same ranges.
    """
    by = [F.col(k) for k in keys] + list(order)
    placed = stage(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_idx", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "sorted",
    )
    runs = placed.groupBy("_part", *keys).agg(F.count("*").alias("_n"), F.min("_idx").alias("_first"))
    # One row per (partition, group): the window sees at most one row per partition.
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_part", *keys, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    position = F.col("_before") + F.col("_idx") - F.col("_first") + 1
    joined = null_safe_join(placed, runs, ["_part", *keys])
    return joined.select(*df.columns, position.cast("long").alias(out))


def surrogate_key(
    df: DataFrame, natural: str, out: str, existing: DataFrame | None = None
) -> DataFrame:
    """Dense keys 1..n in natural-key order, without one task seeing the whole table.

    ``existing`` (natural, out) holds every key ever given: known rows keep theirs,
    also if they had gone meanwhile, and new ones continue after the highest, so no
    key is given twice.
    """
    if existing is None:
        return spread_position(df, [], [F.col(natural)], out)
    known = existing.select(natural, out)
    old = df.join(shuffled(known), natural)
    fresh = spread_position(df.join(shuffled(known), natural, "left_anti"), [], [F.col(natural)], out)
    top = known.agg(F.coalesce(F.max(out), F.lit(0)).alias("top"))
    fresh = fresh.withColumn(out, F.col(out) + top.select("top").scalar())
    return old.select(*df.columns, F.col(out).cast("long").alias(out)).unionByName(fresh)


def numbered(order: Sequence[str]) -> list[Column]:
    """Columns under names by their number, so that one called ``key`` is not taken for the key of a place."""
    return [F.col(c).alias(f"by{n}") for n, c in enumerate(order)]


def slice_cuts(rows: DataFrame, place: Column, slice_rows: int) -> DataFrame | None:
    """One row with ``cuts``, places that cut large keys into slices of about ``slice_rows``; None if no key is large.

    They come from a sample, so slices differ in size; no result depends on them.  Both the
    sample and the cuts are bounded, by ``SAMPLED`` and ``MOST_SLICES``.  Rows are dealt out by slice and key,
    so only keys that several cuts fall into need them; the single cuts of other keys are dropped, and
    a table without large keys is not cut at all.
    """
    n = rows.count()
    slices = min(-(-n // slice_rows), MOST_SLICES)
    if slices < 2:
        return None
    share = min(1.0, min(100 * slices, SAMPLED) / n)
    sampled = rows.sample(share, seed=0).agg(F.sort_array(F.collect_list(place)).alias("all"))
    every = F.sequence(F.lit(1), F.lit(slices - 1))
    taken = F.transform(every, lambda k: F.get("all", F.floor(k * F.size("all") / slices).cast("int")))
    cuts = sampled.select(F.array_compact(taken).alias("cuts"))
    same = lambda cut, at: cut["key"].eqNullSafe(F.get("cuts", at)["key"])
    large = F.filter("cuts", lambda cut, at: same(cut, at - 1) | same(cut, at + 1))
    cuts = stage(cuts.select(large.alias("cuts")), "cuts")
    return cuts if _number(cuts) else None


def _number(cuts: DataFrame) -> int:
    return cuts.select(F.size("cuts")).first()[0]


def slice_number(place: Column, cuts: Column, most: int) -> Column:
    """How many of the ascending ``cuts`` (fewer than ``most``) are not after the place, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
    fits = lambda at, step: F.get(cuts, at + step - 1) <= place  # noqa: E731  null beyond the last cut
    return F.reduce(steps, F.lit(0), lambda at, step: F.when(fits(at, step), at + step).otherwise(at))


def sliced(rows: DataFrame, place: Column, cuts: DataFrame | None) -> DataFrame:
    """``rows`` with ``_slice``, the number of the slice that the place lies in."""
    if cuts is None:
        return rows.withColumn("_slice", F.lit(0))
    rows = rows.withColumn("_cuts", cuts.scalar())
    return rows.withColumn("_slice", slice_number(place, F.col("_cuts"), _number(cuts) + 1)).drop("_cuts")


def first_n_per_key(
    df: DataFrame, key: str, order: Sequence[str], allowance: str, slice_rows: int = 500_000
) -> DataFrame:
    """The first ``allowance`` rows of each key, where the allowance is a column of the row.

    Selection by thresholds.  The rows are cut, in the order (key, ``order``), into slices of about ``slice_rows``,
    and the rows of each key are counted by slice.  A slice that begins beyond the allowance goes unread; in
    the others a row's place is its place in the slice plus the rows of the key before it, so no task
    ranks more than one slice.  ``df`` is read three times: pass a written table.
    """
    place = F.struct(F.col(key).alias("key"), *numbered(order))
    cuts = slice_cuts(df, place, slice_rows)
    rows = sliced(df, place, cuts).withColumn("_before", F.lit(0))
    if cuts is not None:
        cut_keys = cuts.select(F.explode("cuts.key").alias(key)).distinct()
        counts = null_safe_join(rows.select("_slice", key), cut_keys, [key], "left_semi")
        counts = counts.groupBy("_slice", key).agg(F.count("*").alias("n"))
        earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        before = counts.select("_slice", key, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_rows"))
        # At most two rows a slice, so the broadcast is bounded by MOST_SLICES.
        rows = null_safe_join(rows, F.broadcast(before), ["_slice", key], "left")
        rows = rows.withColumn("_before", F.coalesce("_rows", F.lit(0))).filter(F.col("_before") < F.col(allowance))
    local = F.row_number().over(Window.partitionBy("_slice", key).orderBy(*order))
    rows = rows.withColumn("_place", F.col("_before") + local)
    return rows.filter(F.col("_place") <= F.col(allowance)).select(*df.columns)
