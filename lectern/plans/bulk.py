"""Bulk jobs: many enrolment, grade, payment, session and event requests at once.

Each job takes requests and the current tables and returns accepted rows,
rejected rows with the code of the first failing check, and the telemetry events
the accepted rows cause.  Where these results need joins, the checked requests are
written once to the shared folder and all results read them from there.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.scalar import is_json, json_obj
from lectern.functions.status import BLOCKED, grade_status, payment_status, with_net_amount
from lectern.operators.aggregates import payments_rollup, seat_occupancy
from lectern.operators.joins import attach_lookup, having_key, update_from
from lectern.operators.skew import first_n_per_key
from lectern.schema.constraints import METHODS, ORIGINS, PLATFORMS
from lectern.session import stage
from lectern.sources.scan import fill_defaults

# Rejection codes.
BAD_ORIGIN, BAD_STUDENT, BAD_CLASS, ALREADY_ENROLLED, NO_SEATS = 51000, 51001, 51002, 51003, 51004
BAD_GRADE, BAD_ATTENDANCE, NO_ENROLMENT, ENROLMENT_BLOCKED = 51010, 51011, 51012, 51013
BAD_AMOUNT, BAD_METHOD, NO_INSTALMENT, INSTALMENT_CANCELLED = 51020, 51021, 51022, 51023
BAD_PLATFORM, UNKNOWN_EVENT, BAD_PAYLOAD = 51040, 51041, 51042


@dataclass
class Outcome:
    accepted: DataFrame
    rejected: DataFrame
    events: DataFrame | None = None
    updated: DataFrame | None = None


class GradeOutcome:
    """An outcome whose checked requests are written when one of their results is first read; ``updated`` needs none of them."""

    def __init__(self, checked: Callable[[], tuple[DataFrame, DataFrame, DataFrame | None]], updated: DataFrame):
        self._checked, self.updated = checked, updated

    @cached_property
    def _results(self) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        return self._checked()

    accepted = property(lambda self: self._results[0])
    rejected = property(lambda self: self._results[1])
    events = property(lambda self: self._results[2])


def first_code(checks: list[tuple[Column, int]]) -> Column:
    """Code of the first failing check, NULL when all pass; unknown conditions do not fail."""
    code = F.when(checks[0][0], checks[0][1])
    for failed, number in checks[1:]:
        code = code.when(failed, number)
    return code.cast("int")


def _split(coded: DataFrame) -> tuple[DataFrame, DataFrame]:
    return coded.filter(F.col("Codigo").isNull()).drop("Codigo"), coded.filter(F.col("Codigo").isNotNull())


def _known(table: DataFrame, key: str, flag: str, *cols: str) -> DataFrame:
    return table.select(key, *cols, F.lit(True).alias(flag))


def derived_events(
    rows: DataFrame, code: str, types: DataFrame, source: str, key: Column,
    payload: dict[str, Column | str], numeric: Column | None = None, session: str | None = None,
) -> DataFrame:
    """One telemetry event per row; no events at all when the code is not catalogued."""
    typed = attach_lookup(rows, types, F.col("EventCode") == code, ["EventTypeID"])
    none = F.lit(None)
    return typed.select(
        "EventTypeID",
        (F.col(session) if session else none).cast("long").alias("SessionID"),
        "AlunoID",
        F.lit(source).alias("SourceSystem"),
        key.alias("EventKey"),
        (none if numeric is None else numeric).cast("decimal(18,4)").alias("NumericValue"),
        json_obj(payload).alias("PayloadJson"),
    )


def bulk_enrol(
    requests: DataFrame, students: DataFrame, classes: DataFrame, enrolments: DataFrame, as_of: dt.datetime,
    types: DataFrame | None = None,
) -> Outcome:
    """Requests (RequestID, RequestedAt, AlunoID, TurmaID, OrigemMatricula) in time order.

    Everything but the origin depends on the (student, class) pair alone, so the
    checks and the seat race run on pairs: a repeated request costs nothing but
    its final lookup.  Seats go to the earliest pairs of a class, which are selected slice by
    slice: a class wanted by very many is spread over as many tasks as it needs.
    """
    pair = ["AlunoID", "TurmaID"]
    bad_origin = ~F.col("OrigemMatricula").isin(*ORIGINS)
    pairs = (
        requests.filter(~F.coalesce(bad_origin, F.lit(False)))
        .groupBy(*pair)
        .agg(F.min(F.struct("RequestedAt", "RequestID")).alias("_first"))
        .select(*pair, F.col("_first.RequestedAt").alias("_at"), F.col("_first.RequestID").alias("_id"))
    )
    seats = (
        classes.filter(~F.col("Encerrada"))
        .select("TurmaID", "Vagas")
        .join(seat_occupancy(enrolments), "TurmaID", "left")
        .select("TurmaID", (F.col("Vagas") - F.coalesce("Ocupadas", F.lit(0))).alias("_free"))
    )
    checked = (
        # Pairs lie by pair after their grouping, so the enrolments come first: the widest rows cross one exchange less.
        pairs.join(enrolments.select(*pair).distinct().withColumn("_there", F.lit(True)), pair, "left")
        .join(_known(students.filter(F.col("StatusAcademico") == "ATIVO"), "AlunoID", "_student"), "AlunoID", "left")
        .join(seats, "TurmaID", "left")
        .withColumn(
            "_code",
            first_code(
                [
                    (F.col("_student").isNull(), BAD_STUDENT),
                    (F.col("_free").isNull(), BAD_CLASS),
                    (F.col("_there").isNotNull(), ALREADY_ENROLLED),
                    (F.col("_free") <= 0, NO_SEATS),
                ]
            ),
        )
        .select(*pair, "_at", "_id", "_free", "_code")
    )
    checked = stage(checked, "pairs")
    seated = first_n_per_key(checked.filter(F.col("_code").isNull()), "TurmaID", ["_at", "_id"], "_free")
    refused = checked.filter(F.col("_code").isNotNull()).select(*pair, "_code")
    winners = seated.select(*pair, F.col("_id").alias("_winner"))
    verdicts = refused.withColumn("_winner", F.lit(None).cast(winners.schema["_winner"].dataType)).unionByName(
        winners.withColumn("_code", F.lit(None).cast("int"))
    )
    # A pair without verdict passed every check but found no seat.
    coded = requests.join(verdicts, pair, "left").withColumn(
        "Codigo",
        F.when(bad_origin, BAD_ORIGIN)
        .when(F.col("AlunoID").isNull(), BAD_STUDENT)
        .when(F.col("TurmaID").isNull(), BAD_CLASS)
        .when(F.col("_code").isNotNull(), F.col("_code"))
        .when(F.col("_winner").isNull(), NO_SEATS)
        .when(F.col("_winner") != F.col("RequestID"), ALREADY_ENROLLED),
    ).select(*requests.columns, "Codigo")
    accepted, rejected = _split(stage(coded, "enrol"))
    accepted = accepted.select(
        F.col("RequestID").alias("MatriculaID"), *pair, "OrigemMatricula",
        F.lit(as_of).cast("timestamp_ntz").alias("DataMatricula"),
        F.lit("ATIVA").alias("StatusMatricula"),
        F.lit(0).cast("decimal(5,2)").alias("FrequenciaPercentual"),
        F.lit(None).cast("decimal(5,2)").alias("NotaFinal"),
    )
    events = None
    if types is not None:
        events = derived_events(
            accepted, "MATRICULA_CREATED", types, "CORE.BULK_ENROL",
            F.concat(F.lit("matricula-"), F.col("MatriculaID").cast("string")),
            {"matriculaId": "MatriculaID", "turmaId": "TurmaID"},
        )
    return Outcome(accepted, rejected, events)


def bulk_post_grade(
    requests: DataFrame, enrolments: DataFrame, as_of: dt.datetime, types: DataFrame | None = None
) -> GradeOutcome:
    """Requests (RequestID, RequestedAt, MatriculaID, NotaFinal, FrequenciaPercentual); the last per enrolment holds.

    What the enrolment decides (is it there, is it open) is the same for all its requests.  So the
    updated enrolments come from the last request with valid values of each, and enrolments and requests meet once.
    """
    grade, freq = F.col("NotaFinal"), F.col("FrequenciaPercentual")
    bad_values = [((grade < 0) | (grade > 10), BAD_GRADE), ((freq < 0) | (freq > 100), BAD_ATTENDANCE)]
    last = requests.filter(first_code(bad_values).isNull()).groupBy("MatriculaID").agg(
        F.max(F.struct("RequestedAt", "RequestID", grade.alias("g"), freq.alias("f"))).alias("_v")
    ).select("MatriculaID", F.col("_v.g").alias("_grade"), F.col("_v.f").alias("_freq"))
    updated = update_from(enrolments, last, "MatriculaID", {
        "NotaFinal": F.col("_grade"),
        "FrequenciaPercentual": F.col("_freq"),
        "StatusMatricula": grade_status("_grade", "_freq"),
        "UltimaAtualizacao": F.lit(as_of),
    }, where=~enrolments["StatusMatricula"].isin(*BLOCKED))

    def checked() -> tuple[DataFrame, DataFrame, DataFrame | None]:
        known = enrolments.select("MatriculaID", "AlunoID", F.col("StatusMatricula").alias("_status"))
        unfit = [(F.col("_status").isNull(), NO_ENROLMENT), (F.col("_status").isin(*BLOCKED), ENROLMENT_BLOCKED)]
        coded = requests.join(known, "MatriculaID", "left").withColumn("Codigo", first_code(bad_values + unfit))
        accepted, rejected = _split(stage(coded.drop("_status"), "grade"))
        events = None
        if types is not None:
            events = derived_events(
                accepted, "NOTE_UPDATED", types, "CORE.BULK_POST_GRADE",
                F.concat(F.lit("matricula-"), F.col("MatriculaID").cast("string")),
                {"matriculaId": "MatriculaID", "frequencia": "FrequenciaPercentual"}, numeric=grade,
            )
        return accepted, rejected.drop("AlunoID"), events

    return GradeOutcome(checked, updated)


def bulk_pay(
    requests: DataFrame, instalments: DataFrame, payments: DataFrame, as_of: dt.date, types: DataFrame | None = None
) -> Outcome:
    """Requests (RequestID, ParcelaID, DataPagamento, ValorPagamento, MeioPagamento)."""
    known = instalments.select("ParcelaID", "AlunoID", F.col("StatusParcela").alias("_status"))
    coded = requests.join(known, "ParcelaID", "left").withColumn(
        "Codigo",
        first_code(
            [
                (F.col("ValorPagamento") <= 0, BAD_AMOUNT),
                (~F.col("MeioPagamento").isin(*METHODS), BAD_METHOD),
                (F.col("_status").isNull(), NO_INSTALMENT),
                (F.col("_status") == "CANCELADA", INSTALMENT_CANCELLED),
            ]
        ),
    ).drop("_status")
    accepted, rejected = _split(stage(coded, "pay"))
    new = accepted.select(
        "RequestID", "ParcelaID", "DataPagamento", "ValorPagamento", "MeioPagamento", F.lit("CONFIRMED").alias("GatewayStatus")
    )
    # Only touched instalments are recomputed, from partial sums of old and new payments.
    fresh = payments_rollup(new)
    past = payments_rollup(having_key(payments, fresh, "ParcelaID"))
    totals = fresh.unionByName(past).groupBy("ParcelaID").agg(
        F.sum("TotalPago").alias("TotalPago"), F.max("UltimoPagamento").alias("UltimoPagamento")
    )
    updated = apply_payments(instalments, totals, as_of)
    events = None
    if types is not None:
        events = derived_events(
            accepted, "PAYMENT_SUCCESS", types, "CORE.BULK_PAY",
            F.concat(F.lit("parcela-"), F.col("ParcelaID").cast("string")),
            {"parcelaId": "ParcelaID", "meio": "MeioPagamento"}, numeric=F.col("ValorPagamento"),
        )
    return Outcome(new, rejected.drop("AlunoID"), events, updated)


def apply_payments(instalments: DataFrame, totals: DataFrame, as_of: dt.date) -> DataFrame:
    """Instalments with paid amount, payment day and status taken from their payment totals."""
    if "ValorLiquido" not in instalments.columns:
        instalments = with_net_amount(instalments)
    return update_from(instalments, totals, "ParcelaID", {
        "ValorPago": F.col("TotalPago"),
        "DataPagamento": F.to_date("UltimoPagamento"),
        "StatusParcela": payment_status("TotalPago", "ValorLiquido", "DataVencimento", as_of),
    })


def bulk_start_session(requests: DataFrame, types: DataFrame, as_of: dt.datetime) -> Outcome:
    """Requests (SessionID, ClientID, Platform, AlunoID, …)."""
    coded = requests.withColumn(
        "Codigo", first_code([(~F.col("Platform").isin(*PLATFORMS), BAD_PLATFORM)])
    )
    accepted, rejected = _split(coded)
    accepted = fill_defaults(accepted, {"StartedAt": "@now", "IsAuthenticated": False}, as_of)
    events = derived_events(
        accepted, "SESSION_START", types, "SESSION_SERVICE",
        F.concat(F.lit("start-"), F.col("SessionID").cast("string")),
        {"clientId": "ClientID", "platform": "Platform"}, session="SessionID",
    )
    return Outcome(accepted, rejected, events)


def code_events(requests: DataFrame, types: DataFrame) -> DataFrame:
    """Requests with EventTypeID and Codigo (NULL when they may be stored)."""
    active = types.filter("Ativo").select("EventCode", "EventTypeID")
    bad_json = F.col("PayloadJson").isNotNull() & ~is_json("PayloadJson")
    return requests.join(active, "EventCode", "left").withColumn(
        "Codigo", first_code([(F.col("EventTypeID").isNull(), UNKNOWN_EVENT), (bad_json, BAD_PAYLOAD)])
    )


def bulk_ingest_event(requests: DataFrame, types: DataFrame, as_of: dt.datetime) -> Outcome:
    """Requests (EventCode, SourceSystem, OccurredAt, PayloadJson, …) with defaults filled for time and correlation."""
    accepted, rejected = _split(code_events(requests, types))
    defaults = {"OccurredAt": "@now", "IngestedAt": "@now", "CorrelationID": "@uuid", "ProcessingStatus": "N"}
    return Outcome(fill_defaults(accepted, defaults, as_of), rejected.drop("EventTypeID"))
