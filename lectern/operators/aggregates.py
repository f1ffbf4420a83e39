"""Grouped measures.  Every aggregate here combines on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.scalar import minute_floor
from lectern.functions.status import PENDING, SEAT_TAKEN, _c, in_window


def count_if(predicate: Column) -> Column:
    """Conditional count that is NULL, not 0, when there are no rows to look at."""
    return F.sum(F.when(predicate, 1).otherwise(0))


def weighted_mean(
    df: DataFrame,
    key: str,
    value: str,
    weight: str,
    out: str,
    precision: int = 5,
    scale: int = 2,
    spine: DataFrame | None = None,
    default=None,
    missing_value=None,
) -> DataFrame:
    """Per key Σ(value·weight)/Σweight, rounded half up.

    ``missing_value`` stands in for NULL values; with a ``spine`` every key of it
    appears and keys without a mean get ``default``.
    """
    v = _c(value) if missing_value is None else F.coalesce(_c(value), F.lit(missing_value))
    w = _c(weight)
    mean = F.sum(v * w) / F.nullif(F.sum(w), F.lit(0))
    out_type = f"decimal({precision},{scale})"
    per_key = df.groupBy(key).agg(F.round(mean, scale).cast(out_type).alias(out))
    if spine is not None:
        per_key = spine.select(key).join(per_key, key, "left")
    if default is not None:
        per_key = per_key.withColumn(out, F.coalesce(F.col(out), F.lit(default).cast(out_type)))
    return per_key


def balance_measures() -> dict[str, Column]:
    pending = F.col("StatusParcela").isin(*PENDING)
    paid = F.coalesce(F.col("ValorPago"), F.lit(0))
    open_part = F.when(pending, F.col("ValorLiquido") - paid).otherwise(0)
    return {
        "ParcelasTotal": F.count("*"),
        "ParcelasPendentes": count_if(pending),
        "ValorEmAberto": F.sum(open_part).cast("decimal(38,2)"),
        "ValorPago": F.sum(paid).cast("decimal(38,2)"),
    }


def balance_summary(instalments: DataFrame, key: str = "AlunoID") -> DataFrame:
    """Per key: instalments, pending ones, open amount, paid amount."""
    return instalments.groupBy(key).agg(*[c.alias(n) for n, c in balance_measures().items()])


def payments_rollup(
    payments: DataFrame, key: str = "ParcelaID", value: str = "ValorPagamento", ts: str = "DataPagamento",
    gateway_status: Sequence[str] | None = None,
) -> DataFrame:
    """Per instalment the total paid and the time of the last payment.

    All gateway states count unless a list is given.
    """
    if gateway_status is not None:
        payments = payments.filter(F.col("GatewayStatus").isin(*gateway_status))
    return payments.groupBy(key).agg(F.sum(value).alias("TotalPago"), F.max(ts).alias("UltimoPagamento"))


def conditional_counts(df: DataFrame, key: str, predicates: dict[str, Column], total: str = "Total") -> DataFrame:
    sums = [count_if(p).alias(name) for name, p in predicates.items()]
    return df.groupBy(key).agg(F.count("*").alias(total), *sums)


def distinct_counts(df: DataFrame, keys: str | Sequence[str], cols: dict[str, str]) -> DataFrame:
    """Exact distinct counts of several columns.

    Each column is first reduced to its distinct (key, value) pairs, which are
    spread over the cluster by pair; only counts reach the group key.
    """
    by = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*by).agg(*[F.count_distinct(c).alias(name) for name, c in cols.items()])


def safe_ratio_pct(num: Column, den: Column) -> Column:
    """100·num/den as decimal(18,4); NULL where the denominator is 0."""
    wide = "decimal(20,0)"
    return (F.lit(100) * num.cast(wide) / F.nullif(den.cast(wide), F.lit(0).cast(wide))).cast("decimal(18,4)")


def decimal_avg(col, inner: str = "decimal(18,2)", outer: str = "decimal(18,2)") -> Column:
    return F.avg(_c(col).cast(inner)).cast(outer)


def event_health(events: DataFrame, types: DataFrame) -> DataFrame:
    """Per event code and source: count, mean duration, last event, errors.

    Events are reduced by type id first, so the catalogue joins a few rows.
    """
    per_type = events.groupBy("EventTypeID", "SourceSystem").agg(
        F.count("*").alias("Eventos"),
        decimal_avg("DurationMs").alias("AvgDurationMs"),
        F.max("OccurredAt").alias("UltimoEvento"),
        count_if(F.col("ProcessingStatus") == "E").alias("EventosComErro"),
    )
    named = per_type.join(types.select("EventTypeID", "EventCode"), "EventTypeID")
    return named.select(
        "EventCode", "SourceSystem", "Eventos", "AvgDurationMs", "UltimoEvento", "EventosComErro"
    )


def telemetry_daily(events: DataFrame, key_cols: Sequence[str], d0=None, d1=None) -> DataFrame:
    """Per day and key columns: events, mean duration, sum of values.  NULL keys form groups."""
    if d0 is not None:
        events = in_window(events, "OccurredAt", d0, d1)
    return events.groupBy(F.to_date("OccurredAt").alias("DataRef"), *key_cols).agg(
        F.count("*").alias("Eventos"),
        decimal_avg("DurationMs").alias("DuracaoMediaMs"),
        F.sum(F.coalesce(F.col("NumericValue"), F.lit(0))).cast("decimal(18,4)").alias("ValorNumericoSoma"),
    )


def minute_counts(events: DataFrame, types: DataFrame, t0=None, t1=None, metric: str = "EVENT_COUNT") -> DataFrame:
    """Events per minute, code and source as a long metric; bounds are closed and optional."""
    kind = events.schema["OccurredAt"].dataType.typeName()
    if t0 is not None:
        events = events.filter(F.col("OccurredAt") >= F.lit(t0).cast(kind))
    if t1 is not None:
        events = events.filter(F.col("OccurredAt") <= F.lit(t1).cast(kind))
    per_minute = events.groupBy(
        minute_floor("OccurredAt").alias("MetricMinute"), "EventTypeID", "SourceSystem"
    ).agg(F.count("*").alias("_n"))
    return per_minute.join(types.select("EventTypeID", "EventCode"), "EventTypeID").select(
        F.lit(metric).alias("MetricName"),
        "MetricMinute",
        F.col("EventCode").alias("Dimension1"),
        F.col("SourceSystem").alias("Dimension2"),
        F.col("_n").cast("decimal(18,4)").alias("MetricValue"),
    )


def min_date(df: DataFrame, ts: str, default, out: str = "DataInicial") -> DataFrame:
    """One row: the first day in the table, or the default for an empty one."""
    return df.agg(F.coalesce(F.to_date(F.min(ts)), F.lit(default)).alias(out))


def seat_occupancy(enrolments: DataFrame, key: str = "TurmaID") -> DataFrame:
    taken = enrolments.filter(F.col("StatusMatricula").isin(*SEAT_TAKEN))
    return taken.groupBy(key).agg(F.count("*").alias("Ocupadas"))
