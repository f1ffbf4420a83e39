"""Set operations, date series and top-k reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, by column name; joined pairwise, so that no plan is analysed once per frame."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return union_all(*frames[:half]).unionByName(union_all(*frames[half:]))


def distinct_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def _days(d0: Column, d1: Column) -> Column:
    """One row per day; a range that ends before it starts still has its first day."""
    return F.explode(F.sequence(d0, F.greatest(d0, d1)))


def date_series(spark: SparkSession, d0: dt.date, d1: dt.date, out: str = "DataRef") -> DataFrame:
    return spark.range(1).select(_days(F.lit(d0), F.lit(d1)).alias(out))


def date_series_of(bounds: DataFrame, d0: str, d1: str, out: str = "DataRef") -> DataFrame:
    """Series between the two dates of a one-row table, so the bounds may come from data."""
    return bounds.select(_days(F.col(d0), F.col(d1)).alias(out))


def topk(df: DataFrame, orders: Sequence[Column], k: int = 20) -> DataFrame:
    """First k rows by a total order; each task keeps only its own k."""
    return df.orderBy(*orders).limit(k)
