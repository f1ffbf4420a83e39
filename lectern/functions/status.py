"""Derivations over single rows: status machines, bands, balances, window predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# State names and pass marks of the model.
PENDING = ("ABERTA", "ATRASADA", "NEGOCIADA")
CONCLUDED = ("APROVADA", "REPROVADA")
SEAT_TAKEN = ("ATIVA", "APROVADA", "REPROVADA")
BLOCKED = ("CANCELADA", "TRANCADA")
MIN_ATTENDANCE = 75
MIN_GRADE = 6
SCHOLARSHIP_EDGES = (0, 50, 100)
SCHOLARSHIP_LABELS = ("SEM_BOLSA", "PARCIAL", "ALTA", "INTEGRAL")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def net_amount(gross="ValorOriginal", discount="ValorDesconto", penalty="ValorMulta") -> Column:
    return (_c(gross) - _c(discount) + _c(penalty)).cast("decimal(12,2)")


def with_net_amount(df: DataFrame, out: str = "ValorLiquido") -> DataFrame:
    return df.withColumn(out, net_amount())


def grade_status(grade, freq) -> Column:
    """Two-way outcome; an unknown grade or attendance fails."""
    passed = (_c(freq) >= MIN_ATTENDANCE) & (_c(grade) >= MIN_GRADE)
    return F.when(passed, "APROVADA").otherwise("REPROVADA")


def grade_status_derived(grade, freq, old) -> Column:
    """Three-way outcome; where neither side can be decided the old status stays."""
    g, f = _c(grade), _c(freq)
    return (
        F.when((f >= MIN_ATTENDANCE) & (g >= MIN_GRADE), "APROVADA")
        .when((f < MIN_ATTENDANCE) | (g < MIN_GRADE), "REPROVADA")
        .otherwise(_c(old))
    )


def payment_status(paid, net, due, as_of: dt.date) -> Column:
    return (
        F.when(_c(paid) >= _c(net), "PAGA")
        .when(_c(due) < F.lit(as_of), "ATRASADA")
        .otherwise("ABERTA")
    )


def bucket(col, edges, labels) -> Column:
    """First label for an exact hit on the first edge, then one label per upper bound."""
    c = _c(col)
    out = F.when(c == edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(c < edge, label)
    return out.otherwise(labels[-1])


def scholarship_band(percent="PercentualBolsa") -> Column:
    return bucket(percent, SCHOLARSHIP_EDGES, SCHOLARSHIP_LABELS)


def approved_flag(status="StatusMatricula") -> Column:
    s = _c(status)
    return F.when(s == "APROVADA", True).when(s == "REPROVADA", False)


def is_pending(status="StatusParcela") -> Column:
    return _c(status).isin(*PENDING)


def open_balance(net="ValorLiquido", paid="ValorPago") -> Column:
    return (_c(net) - F.coalesce(_c(paid), F.lit(0))).cast("decimal(12,2)")


def days_overdue(status, due, as_of: dt.date) -> Column:
    late = is_pending(status) & (_c(due) < F.lit(as_of))
    return F.when(late, F.datediff(F.lit(as_of), _c(due))).otherwise(0)


def in_window(df: DataFrame, ts: str, d0: dt.date, d1: dt.date) -> DataFrame:
    """Closed date range over a date or timestamp column.

    Written as a half-open range on the raw column, so the bounds reach the
    file scan and partition pruning works.
    """
    kind = df.schema[ts].dataType.typeName()
    if kind == "date":
        return df.filter(F.col(ts).between(F.lit(d0), F.lit(d1)))
    low = F.lit(d0).cast(kind)
    high = F.lit(d1 + dt.timedelta(days=1)).cast(kind)
    return df.filter((F.col(ts) >= low) & (F.col(ts) < high))


def trailing(df: DataFrame, ts: str, days: int, as_of: dt.date | dt.datetime) -> DataFrame:
    """Rows of the last ``days`` days; no upper bound."""
    kind = df.schema[ts].dataType.typeName()
    return df.filter(F.col(ts) >= F.lit(as_of - dt.timedelta(days=days)).cast(kind))
