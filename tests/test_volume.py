"""What the jobs read, shuffle and write: derived inputs once, checked requests only where they are wanted."""

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from lectern.plans import bulk as b
from lectern.plans import reports as rep
from lectern.plans import warehouse as w
from lectern.registry import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_warehouse_jobs_derive_the_enrolments_once(spark, monkeypatch):
    """Rebuild and refresh get enrolments that are already written, the same ones, not the join of all order lines."""
    seen = []

    def spy(name):
        plain = getattr(w, name)
        monkeypatch.setattr(w, name, lambda spark, src, *rest: seen.append(src["Matricula"]) or plain(spark, src, *rest))

    spy("rebuild_warehouse"), spy("refresh_window")
    QUERIES["refresh_window"](spark, FOLDER)
    files = [sorted(df.inputFiles()) for df in seen]
    assert len(files) == 2 and files[0] == files[1]
    assert not [f for f in files[0] if f.endswith(("lineitem.parquet", "orders.parquet"))]


def test_warehouse_jobs_broadcast_no_side_that_grows(spark, monkeypatch):
    """Classes, subjects, students and people go by exchange, however small the files look that they lie in."""
    plans, plain = [], w.observed_write
    spy = lambda df, *rest: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, *rest)
    monkeypatch.setattr(w, "observed_write", spy)
    QUERIES["refresh_window"](spark, FOLDER)
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin) \[(?:cast\()?(\w+)#", "\n".join(plans))
    broadcast = {key for kind, key in joins if kind == "BroadcastHashJoin"}
    merged = {key for kind, key in joins if kind == "SortMergeJoin"}
    assert "CursoID" in broadcast and not broadcast & {"AlunoID", "TurmaID", "DisciplinaID", "PessoaID"}
    assert {"AlunoID", "TurmaID", "DisciplinaID", "PessoaID"} <= merged


def test_updated_grades_do_not_wait_for_the_checked_requests(spark, campus, monkeypatch):
    """One meeting of enrolments and requests gives the updated rows; the checked requests are written when they are read."""
    written = []
    plain = b.stage
    monkeypatch.setattr(b, "stage", lambda df, name: written.append(name) or plain(df, name))
    held = campus["Matricula"].withColumn(
        "StatusMatricula",
        F.when(F.col("MatriculaID") == 6, "TRANCADA").when(F.col("MatriculaID") != 5, F.col("StatusMatricula")),
    )
    rows = [
        (1, 1, 4, 9, 90), (2, 2, 4, 5, 90), (3, 3, 4, 11, 90), (4, 4, 4, 9, 101),  # the last valid one holds
        (5, 1, 5, 9, 90), (6, 1, 6, 9, 90), (7, 1, 77, 9, 90), (8, 1, None, 9, 90),  # no status, blocked, unknown, none
    ]
    req = spark.createDataFrame(rows, "RequestID long, RequestedAt int, MatriculaID long, NotaFinal int, FrequenciaPercentual int")
    out = b.bulk_post_grade(req, held, dt.datetime(2026, 3, 20))
    after = {r["MatriculaID"]: (r["NotaFinal"], r["StatusMatricula"]) for r in out.updated.collect()}
    before = {r["MatriculaID"]: (r["NotaFinal"], r["StatusMatricula"]) for r in held.collect()}
    assert after == before | {4: (5, "REPROVADA")} and not written
    assert {r["RequestID"]: r["Codigo"] for r in out.rejected.collect()} == {
        3: 51010, 4: 51011, 5: 51012, 6: 51013, 7: 51012, 8: 51012,
    }
    assert {r["RequestID"] for r in out.accepted.collect()} == {1, 2} and written == ["grade"]


def test_enrolments_meet_pairs_where_they_lie(spark, campus, monkeypatch):
    """With sides too large to broadcast, pairs and enrolments cross one exchange by pair each, and no third follows."""
    plans, plain = {}, b.stage

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, name)

    monkeypatch.setattr(b, "stage", spy)
    req = campus["Matricula"].select(
        F.col("MatriculaID").alias("RequestID"), F.lit(1).alias("RequestedAt"), "AlunoID", "TurmaID",
        F.lit("API").alias("OrigemMatricula"),
    )
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        b.bulk_enrol(req, campus["Aluno"], campus["Turma"], campus["Matricula"], dt.datetime(2026, 3, 20))
    finally:
        spark.conf.set(name, before)
    assert len(re.findall(r"Exchange hashpartitioning\(AlunoID#\d+L?, TurmaID#", plans["pairs"])) == 2


def test_enrolment_job_gets_written_requests_and_enrolments(spark, monkeypatch):
    seen, plain = [], b.bulk_enrol
    monkeypatch.setattr(b, "bulk_enrol", lambda *given: seen.extend([given[0], given[3]]) or plain(*given))
    QUERIES["bulk_enrol"](spark, FOLDER)
    assert len(seen) == 2 and not [f for df in seen for f in df.inputFiles() if f.endswith("lineitem.parquet")]


def test_report_looks_up_the_class_code_at_the_end(spark, campus):
    """The code of a class does not travel through the groupings of the enrolments."""
    plan = rep.student_360(campus, dt.date(2026, 3, 20))._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate" in line]
    assert grouped and not [line for line in grouped if "CodigoTurma" in line]
