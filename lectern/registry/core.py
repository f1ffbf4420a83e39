"""Registry of runnable queries and the plain SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.session import configure
from lectern.sources.sales_model import SalesCampus, plain_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the campus tables; ``sql`` may use model view names directly."""

    def register(fn: Callable[[SalesCampus], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(SalesCampus(configure(spark), folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = plain_sql(sql)
        return fn

    return register


def json_sql(x: str) -> str:
    """SQL for "one whole JSON object or array"; the engine's own check also takes scalars and NaN."""
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN NOT json_valid({x}) OR contains({x}, 'NaN') THEN false"
            f" ELSE json_type({x}) IN ('OBJECT', 'ARRAY') END")


def half_up(num: str, den: str, digits: int) -> str:
    """SQL for num/den rounded half up to ``digits`` decimals, on non-negative integers only.

    Yields a whole number of 10^-digits units; NULL for a zero denominator.
    """
    scale = 10**digits
    return f"((2 * CAST({num} AS HUGEINT) * {scale} + {den}) // nullif(2 * CAST({den} AS HUGEINT), 0))"


def units(expr: str, digits: int, kind: str) -> str:
    """Whole 10^-digits units back to a decimal."""
    return f"CAST(CAST({expr} AS DOUBLE) / {10**digits} AS {kind})"


def mean2(num: str, den: str, kind: str, value_digits: int, inner: int = 6) -> str:
    """Mean of decimals given as integer units, rounded to ``inner`` and then to two decimals."""
    first = half_up(num, den, inner - value_digits)
    second = f"((2 * {first} + {10 ** (inner - 2)}) // {2 * 10 ** (inner - 2)})"
    return units(second, 2, kind)
