"""The reporting views and functions by name, for SQL users."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from lectern.functions.sql import register_balance, register_date_key
from lectern.operators.aggregates import event_health
from lectern.operators.ranking import class_ranking
from lectern.plans import reports as rep
from lectern.plans.warehouse import Tables


def reporting_views(t: Tables, as_of: dt.date) -> dict[str, DataFrame]:
    views = {
        "vw_RankingTurma": class_ranking(t["Matricula"], t["Turma"], t["Aluno"], t["Pessoa"]),
        "vw_VisaoUnica": rep.student_360(t, as_of),
        "vw_PainelExecutivo": rep.course_panel(t),
        "vw_EventHealth": event_health(t["EventStream"], t["EventType"]),
    }
    if "ChangeAudit" in t:
        views["vw_AuditoriaRecente"] = rep.recent_audit(t["ChangeAudit"], as_of)
    return views


def register_views(spark: SparkSession, t: Tables, as_of: dt.date) -> list[str]:
    """Temporary views and functions; they read the tables anew on every use.

    vw_RankingTurma is the exception: its rows are written when it is registered, so a class of any size
    is ranked in as many tasks as it needs.  Register the views again after the tables are loaded.
    """
    views = reporting_views(t, as_of)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    register_date_key(spark, "fn_TempoKey")
    register_balance(t["ParcelaFinanceira"], "fn_SaldoAluno")
    rep.gpa(t["Matricula"], t["Turma"], t["Disciplina"], t["Aluno"]).createOrReplaceTempView("vw_CRA")
    return [*views, "vw_CRA"]
