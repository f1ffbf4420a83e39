"""Typed scans and column defaults."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.schema.model import NOW, TABLES, TODAY, UUID


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Scan a model table with its declared schema; nothing is inferred."""
    return spark.read.schema(TABLES[table].struct).parquet(f"{folder}/{table}")


def load_all(spark: SparkSession, folder: str, tables: list[str]) -> dict[str, DataFrame]:
    return {name: load(spark, folder, name) for name in tables}


def fill_defaults(df: DataFrame, defaults: dict, as_of: dt.datetime, types: dict[str, str] | None = None) -> DataFrame:
    """Fill NULLs of (and add missing) columns with constants, the load time or fresh identifiers."""
    types = types or {}
    filled = {}
    for col, default in defaults.items():
        if default == UUID:
            value = F.uuid()
        elif default == NOW:
            value = F.lit(as_of).cast("timestamp_ntz")
        elif default == TODAY:
            value = F.to_date(F.lit(as_of))
        else:
            value = F.lit(default)
        kind = df.schema[col].dataType if col in df.columns else types.get(col)
        value = value.cast(kind) if kind is not None else value
        filled[col] = F.coalesce(F.col(col), value) if col in df.columns else value
    return df.withColumns(filled)


def with_defaults(df: DataFrame, table: str, as_of: dt.datetime) -> DataFrame:
    """Declared columns of ``table`` with its defaults applied."""
    spec = TABLES[table]
    types = {f.name: f.dataType for f in spec.struct.fields}
    return fill_defaults(df, spec.defaults, as_of, types)
