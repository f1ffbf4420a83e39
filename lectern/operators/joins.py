"""Join patterns.

No side is force-broadcast: the optimizer broadcasts a side when its estimated
or measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise shuffles, splitting skewed partitions.  Per-key lookups are
aggregated before they are joined, so the right side holds one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chain(base: DataFrame, steps: Sequence[tuple[DataFrame, str | list[str]]], how: str = "inner") -> DataFrame:
    """Join ``base`` with each (table, key columns) in turn."""
    for table, keys in steps:
        base = base.join(table, keys, how)
    return base


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast.

    Sizes are estimated from packed files, which may hold many times as much: a side that grows with the data can
    be hundreds of MB on the driver while its estimate is below the threshold.
    """
    return df.hint("merge")


def with_key(fact: DataFrame, dim: DataFrame, natural: str, key: str, how: str = "inner") -> DataFrame:
    """Natural key to surrogate key of the current version."""
    current = dim.filter("IsCurrent") if "IsCurrent" in dim.columns else dim
    return fact.join(current.select(natural, key), natural, how)


def latest_per_key(
    left: DataFrame, right: DataFrame, key: str, order: Sequence[str], cols: Sequence[str], how: str = "left"
) -> DataFrame:
    """Columns of the right row that is last by ``order``; NULLs where the key has none.

    A maximum over a struct combines on the map side: one row per key and map
    task is shuffled, however large a group is.
    """
    pick = F.max(F.struct(*order, *[c for c in cols if c not in order])).alias("_last")
    best = right.groupBy(key).agg(pick).select(key, *[F.col(f"_last.{c}").alias(c) for c in cols])
    return left.join(best, key, how)


def most_frequent(right: DataFrame, key: str, cat: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Most frequent category per key; ties go to the lowest ``tie`` columns."""
    counts = right.groupBy(key, *cat).agg(F.count("*").alias("_n"))
    rest = [c for c in cat if c not in tie]
    pick = F.min(F.struct((-F.col("_n")).alias("_neg"), *tie, *rest)).alias("_top")
    return counts.groupBy(key).agg(pick).select(key, *[F.col(f"_top.{c}").alias(c) for c in cat])


def mode_per_key(left: DataFrame, right: DataFrame, key: str, cat: Sequence[str], tie: Sequence[str]) -> DataFrame:
    return left.join(most_frequent(right, key, cat, tie), key, "left")


def agg_per_key(
    left: DataFrame, right: DataFrame, key: str, counts: dict[str, Column], aggs: dict[str, Column]
) -> DataFrame:
    """Left rows with aggregates of their right rows: counts become 0 without rows, other aggregates NULL."""
    measures = {**counts, **aggs}
    per_key = right.groupBy(key).agg(*[c.alias(name) for name, c in measures.items()])
    out = left.join(per_key, key, "left")
    return out.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in counts})


def missing(df: DataFrame, ref: DataFrame, keys: str | list[str]) -> DataFrame:
    return df.join(ref, keys, "left_anti")


def having_key(df: DataFrame, ref: DataFrame, keys: str | list[str]) -> DataFrame:
    return df.join(ref, keys, "left_semi")


def before_after(after: DataFrame, before: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Rows (key, after struct, before struct); before is NULL for new rows."""
    new = after.select(key, F.struct(*after.columns).alias("after"))
    old = before.select(key, F.struct(*before.columns).alias("before"))
    return new.join(old, key, how)


def attach_lookup(df: DataFrame, lookup: DataFrame, predicate: Column, cols: Sequence[str]) -> DataFrame:
    """Add columns of the one lookup row that meets ``predicate``; no rows when there is none.

    A scalar subquery: it fails rather than multiplies when the lookup row is not unique.
    """
    row = lookup.filter(predicate).select(F.struct(*cols).alias("_row")).scalar()
    out = df.withColumn("_row", row).filter(F.col("_row").isNotNull())
    return out.select(*df.columns, *[F.col(f"_row.{c}").alias(c) for c in cols])


def exceeds(df: DataFrame, limits: DataFrame, key: str, col: str, limit: str) -> DataFrame:
    """Rows whose value is above the limit of their key."""
    bounds = limits.select(key, F.col(limit).alias("_limit"))
    hit = df.join(bounds, key).filter(F.col(col) > F.col("_limit"))
    return hit.withColumnRenamed("_limit", limit)


def update_from(
    target: DataFrame, derived: DataFrame, keys: str | list[str], assignments: dict[str, Column], where: Column | None = None
) -> DataFrame:
    """Target with assigned columns where a derived row matches and ``where`` holds; ``derived`` has one row per key.

    Expressions may use columns of both sides.
    """
    joined = target.join(derived.withColumn("_hit", F.lit(True)), keys, "left")
    hit = F.col("_hit").isNotNull() if where is None else F.col("_hit").isNotNull() & where
    cols = [
        F.when(hit, assignments[c]).otherwise(target[c]).cast(target.schema[c].dataType).alias(c)
        if c in assignments
        else (F.col(c) if c in ([keys] if isinstance(keys, str) else keys) else target[c])
        for c in target.columns
    ]
    return joined.select(*cols)
