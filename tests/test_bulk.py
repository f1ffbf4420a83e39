"""Bulk jobs on the seed campus: codes in order, seat race, repeats, NULLs."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from lectern.plans import bulk as b
from tests.seed import AS_OF

NOW = dt.datetime(2026, 3, 20, 12)


def at(minute):
    return dt.datetime(2026, 3, 20, 10, minute)


def codes(out, key="RequestID"):
    return {r[key]: r["Codigo"] for r in out.rejected.collect()}


def test_enrol(spark, campus):
    classes = campus["Turma"].withColumn(
        "Vagas", F.when(F.col("TurmaID") == 3, 2).otherwise(F.col("Vagas")).cast("short")
    ).withColumn("Encerrada", F.col("TurmaID") == 4)
    students = campus["Aluno"].withColumn(
        "StatusAcademico", F.when(F.col("AlunoID") == 5, "TRANCADO").otherwise(F.col("StatusAcademico"))
    )
    req = spark.createDataFrame(
        [
            (1, at(9), 1, 3, "PORTAL"),     # later than 2: no seat left
            (2, at(1), 2, 3, "PORTAL"),     # takes the one free seat of class 3
            (3, at(2), 2, 3, "PORTAL"),     # repeat of an accepted request
            (4, at(9), 1, 3, "PORTAL"),     # repeat of a request without seat
            (5, at(0), 1, 2, "FAX"),        # bad origin wins over already enrolled
            (6, at(0), 5, 2, "API"),        # inactive student
            (7, at(0), 99, 2, "API"),       # unknown student
            (8, at(0), 2, 4, "API"),        # closed class
            (9, at(0), 1, 1, "API"),        # enrolled before
            (10, at(0), 4, 2, None),        # unknown origin passes the list check
            (11, at(0), None, 2, "API"),
            (12, at(0), 2, None, "API"),
        ],
        "RequestID long, RequestedAt timestamp, AlunoID int, TurmaID int, OrigemMatricula string",
    )
    out = b.bulk_enrol(req, students, classes, campus["Matricula"], NOW, campus["EventType"])
    assert codes(out) == {
        1: 51004, 3: 51003, 4: 51004, 5: 51000, 6: 51001, 7: 51001, 8: 51002, 9: 51003, 11: 51001, 12: 51002,
    }
    rows = {r["MatriculaID"]: r for r in out.accepted.collect()}
    assert set(rows) == {2, 10} and rows[2]["StatusMatricula"] == "ATIVA" and rows[2]["NotaFinal"] is None
    events = {r["EventKey"]: r["PayloadJson"] for r in out.events.collect()}
    assert events["matricula-2"] == '{"matriculaId":2,"turmaId":3}' and len(events) == 2


def test_seats_go_to_the_earliest(spark, campus):
    classes = campus["Turma"].withColumn("Vagas", F.lit(30).cast("short"))
    students = spark.range(100, 400).select(F.col("id").cast("int").alias("AlunoID"), F.lit("ATIVO").alias("StatusAcademico"))
    req = students.select(
        F.col("AlunoID").cast("long").alias("RequestID"), "AlunoID", F.lit(2).alias("TurmaID"),
        F.lit("API").alias("OrigemMatricula"),
        F.expr("timestamp'2026-03-20 10:00:00' + make_dt_interval(0, 0, 0, (AlunoID * 37) % 300)").alias("RequestedAt"),
    )
    out = b.bulk_enrol(req, students, classes, campus["Matricula"], NOW)
    want = {r["RequestID"] for r in req.orderBy("RequestedAt", "RequestID").limit(29).collect()}
    assert {r["MatriculaID"] for r in out.accepted.collect()} == want
    assert out.rejected.count() == 271 and set(codes(out).values()) == {51004}


def test_post_grade(spark, campus):
    held = campus["Matricula"].withColumn(
        "StatusMatricula", F.when(F.col("MatriculaID") == 6, "TRANCADA").otherwise(F.col("StatusMatricula"))
    )
    req = spark.createDataFrame(
        [
            (1, at(1), 4, D("9.00"), D("90.00")),
            (2, at(2), 4, D("5.00"), D("90.00")),    # later: holds
            (3, at(1), 5, None, D("90.00")),         # unknown grade fails the student
            (4, at(1), 1, D("10.01"), D("90.00")),
            (5, at(1), 1, D("9.00"), D("100.01")),
            (6, at(1), 77, D("9.00"), D("90.00")),
            (7, at(1), 6, D("9.00"), D("90.00")),
        ],
        "RequestID long, RequestedAt timestamp, MatriculaID long, NotaFinal decimal(5,2), FrequenciaPercentual decimal(5,2)",
    )
    out = b.bulk_post_grade(req, held, NOW, campus["EventType"])
    assert codes(out) == {4: 51010, 5: 51011, 6: 51012, 7: 51013}
    rows = {r["MatriculaID"]: r for r in out.updated.collect()}
    assert (rows[4]["NotaFinal"], rows[4]["StatusMatricula"]) == (D("5.00"), "REPROVADA")
    assert (rows[5]["NotaFinal"], rows[5]["StatusMatricula"]) == (None, "REPROVADA")
    assert rows[6]["StatusMatricula"] == "TRANCADA" and rows[1]["NotaFinal"] == D("8.70") and len(rows) == 6
    assert out.events.count() == 3


def test_pay(spark, campus):
    inst = campus["ParcelaFinanceira"].withColumn(
        "StatusParcela", F.when(F.col("ParcelaID") == 2, "CANCELADA").otherwise(F.col("StatusParcela"))
    )
    req = spark.createDataFrame(
        [
            (1, 3, at(1), D("1000.00"), "PIX"), (2, 3, at(2), D("370.00"), "BOLETO"),  # together the whole amount
            (3, 6, at(1), D("100.00"), "PIX"),                                         # part, already due
            (4, 1, at(1), D("1.00"), "PIX"),                                           # on top of an older payment
            (5, 1, at(1), D("0.00"), "PIX"), (6, 1, at(1), D("1.00"), "CHEQUE"), (7, 99, at(1), D("1.00"), "PIX"),
            (8, 2, at(1), D("1.00"), "PIX"),
        ],
        "RequestID long, ParcelaID long, DataPagamento timestamp_ntz, ValorPagamento decimal(10,2), MeioPagamento string",
    )
    out = b.bulk_pay(req, inst, campus["Pagamento"], AS_OF, campus["EventType"])
    assert codes(out) == {5: 51020, 6: 51021, 7: 51022, 8: 51023}
    rows = {r["ParcelaID"]: r for r in out.updated.collect()}
    assert (rows[3]["ValorPago"], rows[3]["StatusParcela"], rows[3]["DataPagamento"]) == (D("1370.00"), "PAGA", AS_OF)
    assert (rows[6]["ValorPago"], rows[6]["StatusParcela"]) == (D("100.00"), "ATRASADA")
    assert (rows[1]["ValorPago"], rows[2]["StatusParcela"]) == (D("811.00"), "CANCELADA")
    assert {r["NumericValue"] for r in out.events.collect()} == {D("1000"), D("370"), D("100"), D("1")}


def test_sessions_and_events(spark, campus):
    req = spark.createDataFrame(
        [(7, 'c"7', "WEB", 1), (8, "c8", "FRIDGE", 1)], "SessionID long, ClientID string, Platform string, AlunoID int"
    )
    out = b.bulk_start_session(req, campus["EventType"], NOW)
    assert codes(out, "SessionID") == {8: 51040}
    event = out.events.first()
    assert event["EventKey"] == "start-7" and event["PayloadJson"] == '{"clientId":"c\\"7","platform":"WEB"}'

    types = campus["EventType"].withColumn("Ativo", F.col("EventCode") != "PAGE_VIEW")
    req = spark.createDataFrame(
        [
            (1, "API_CALL", None, None, None), (2, "PAGE_VIEW", None, None, None), (3, "NOPE", None, "5", None),
            (4, "API_CALL", at(1), "5", "corr"), (5, "API_CALL", at(1), '{"a":1} x', None),
            (6, "API_CALL", at(1), '{"a":1,"a":2}', "corr"), (7, "API_CALL", at(1), "[1]", "corr"),
        ],
        "EventID long, EventCode string, OccurredAt timestamp_ntz, PayloadJson string, CorrelationID string",
    )
    out = b.bulk_ingest_event(req, types, NOW)
    assert codes(out, "EventID") == {2: 51041, 3: 51041, 4: 51042, 5: 51042}
    rows = {r["EventID"]: r for r in out.accepted.collect()}
    assert rows[1]["OccurredAt"] == NOW and len(rows[1]["CorrelationID"]) == 36
    assert rows[6]["CorrelationID"] == "corr" and rows[7]["ProcessingStatus"] == "N"


def test_no_event_without_catalogue_entry(campus):
    none = b.derived_events(
        campus["Matricula"], "NOT_CATALOGUED", campus["EventType"], "X", F.lit("k"), {"id": "MatriculaID"}
    )
    assert none.count() == 0
