"""Row-change capture from before and after tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.joins import before_after

AUDIT_COLUMNS = ("OrigemSchema", "OrigemObjeto", "ChaveRegistro", "Operacao", "DadosAntes", "DadosDepois")


def text_image(row: str | None, fields: dict[str, str], null_text: str | None = "NULL") -> Column:
    """``label=value; label=value`` of a struct column (or of the row itself).

    ``null_text`` None writes NULL values as the empty string.
    """
    prefix = f"{row}." if row else ""
    parts = [
        F.concat(
            F.lit(f"{label}="),
            F.coalesce(F.col(prefix + col).cast("string"), F.lit("" if null_text is None else null_text)),
        )
        for label, col in fields.items()
    ]
    return F.concat_ws("; ", *parts)


def _rows(df: DataFrame, schema: str, table: str, key: Column, op: Column, old: Column, new: Column) -> DataFrame:
    values = (F.lit(schema), F.lit(table), key.cast("string"), op, old.cast("string"), new)
    return df.select(*[v.alias(n) for v, n in zip(values, AUDIT_COLUMNS)])


def audit_update_diff(
    before: DataFrame, after: DataFrame, key: str, tracked: dict[str, str], schema: str, table: str
) -> DataFrame:
    """One UPDATE row per key whose tracked columns differ, NULLs compared as values."""
    cols = [key, *tracked.values()]
    pairs = before_after(after.select(*cols), before.select(*cols), key, "inner")
    changed = reduce(
        lambda a, b: a | b,
        [~F.col(f"after.{c}").eqNullSafe(F.col(f"before.{c}")) for c in tracked.values()],
    )
    return _rows(
        pairs.filter(changed), schema, table, F.col(key), F.lit("UPDATE"),
        text_image("before", tracked), text_image("after", tracked),
    )


def audit_upsert(
    before: DataFrame, after: DataFrame, key: str, image: dict[str, str], schema: str, table: str
) -> DataFrame:
    """INSERT or UPDATE rows for every row of ``after``."""
    cols = [key, *[c for c in image.values() if c != key]]
    pairs = before_after(after.select(*cols), before.select(*cols), key, "left")
    is_new = F.col("before").isNull()
    return _rows(
        pairs, schema, table, F.col(key),
        F.when(is_new, "INSERT").otherwise("UPDATE"),
        F.when(~is_new, text_image("before", image, None)),
        text_image("after", image, None),
    )


def audit_insert(rows: DataFrame, key: str, image: dict[str, str], schema: str, table: str) -> DataFrame:
    return _rows(
        rows, schema, table, F.col(key), F.lit("INSERT"), F.lit(None), text_image(None, image, None)
    )
