"""Hand-derived values of the seed campus."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from lectern.functions.status import is_pending
from lectern.operators import aggregates as a
from lectern.operators.aggregates import count_if
from lectern.operators.joins import chain
from lectern.operators.ranking import class_ranking
from lectern.plans import reports as rep
from lectern.plans import warehouse as w
from lectern.schema.constraints import rules_for
from lectern.schema.model import TABLES
from lectern.session import work_path
from lectern.operators.integrity import validate
from lectern.sources import manifest
from lectern.sources.sinks import current
from lectern.streaming.jobs import final_grades
from tests.seed import AS_OF, ROWS


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_student_360(campus):
    got = {r["RA"]: r for r in rep.student_360(campus, AS_OF).collect()}
    want = {
        "20260001": ("8.70", 1, "810.00", "810.00", 2, 1, 0),
        "20260002": ("7.90", 1, "1370.00", "0.00", 1, 1, 0),
        "20260003": ("0.00", 0, "0.00", "480.00", 1, 0, 0),
        "20260004": ("5.20", 0, "0.00", "1350.00", 1, 0, 1),
        "20260005": ("0.00", 1, "1280.00", "0.00", 1, 0, 0),
    }
    assert set(got) == set(want)
    for ra, (cra, pend, open_, paid, n, ok, nok) in want.items():
        r = got[ra]
        assert (r["CRA"], r["ParcelasPendentes"], r["ValorEmAberto"], r["ValorPago"]) == (D(cra), pend, D(open_), D(paid))
        assert (r["TotalMatriculas"], r["Aprovacoes"], r["Reprovacoes"]) == (n, ok, nok)
    assert got["20260001"]["Eventos30Dias"] == 5 and got["20260005"]["Eventos30Dias"] == 0
    assert got["20260005"]["UltimoEventoEm"] is None
    assert got["20260001"]["UltimaTurma"] == "BSI-WEB-2026A"
    assert len(rep.student_360(campus, AS_OF).columns) == 19


def test_student_without_rows_has_zero_counts_and_null_sums(spark, campus):
    one = spark.createDataFrame([(9, 8, "20269999")], "AlunoID int, PessoaID int, RA string")
    tables = dict(campus, Aluno=campus["Aluno"].unionByName(one, allowMissingColumns=True))
    r = rep.student_360(tables, AS_OF).filter("AlunoID = 9").first()
    assert (r["TotalMatriculas"], r["Eventos30Dias"], r["CRA"]) == (0, 0, D("0.00"))
    assert r["Aprovacoes"] is None and r["ValorEmAberto"] is None and r["CursoCodigo"] is None


def test_gpa_equals_report(campus):
    gpa = rep.gpa(campus["Matricula"], campus["Turma"], campus["Disciplina"], campus["Aluno"])
    assert rows(gpa, "AlunoID", "CRA") == rows(rep.student_360(campus, AS_OF), "AlunoID", "CRA")


def course_panel_joined(t):
    """The definition spelled out as an outer join chain; its output grows with the product."""
    fan = chain(
        t["Curso"].select("CursoID", F.col("Codigo").alias("CursoCodigo"), F.col("Nome").alias("CursoNome")),
        [
            (t["Disciplina"].select("CursoID", "DisciplinaID"), "CursoID"),
            (t["Turma"].select("DisciplinaID", "TurmaID"), "DisciplinaID"),
            (t["Matricula"].select("TurmaID", "AlunoID", "NotaFinal", "StatusMatricula"), "TurmaID"),
            (t["ParcelaFinanceira"].select("AlunoID", "ValorLiquido", "ValorPago", "StatusParcela"), "AlunoID"),
        ],
        "left",
    )
    paid = F.coalesce(F.col("ValorPago"), F.lit(0))
    open_part = F.when(is_pending(), F.col("ValorLiquido") - paid).otherwise(0)
    return fan.groupBy("CursoCodigo", "CursoNome").agg(
        F.count_distinct("AlunoID").alias("Alunos"),
        F.count_distinct("TurmaID").alias("Turmas"),
        F.avg(F.col("NotaFinal").cast("decimal(10,4)")).cast("decimal(10,2)").alias("MediaNotas"),
        F.sum(open_part).cast("decimal(38,2)").alias("Inadimplencia"),
        F.sum(paid).cast("decimal(38,2)").alias("ReceitaRealizada"),
        count_if(F.col("StatusMatricula") == "APROVADA").cast("decimal(38,2)").alias("MatriculasAprovadas"),
    )


def test_course_panel_sums_outgrow_fourteen_digits(campus):
    rich = dict(campus)
    rich["ParcelaFinanceira"] = campus["ParcelaFinanceira"].withColumns(
        {c: F.lit(9_999_999_999).cast("decimal(12,2)") for c in ("ValorLiquido", "ValorPago")}
    ).crossJoin(campus["ParcelaFinanceira"].sparkSession.range(500).select(F.col("id").alias("_n"))).drop("_n")
    paid = rep.course_panel(rich).agg(F.max("ReceitaRealizada")).first()[0]
    assert paid > 10**12 and paid % 9_999_999_999 == 0


def test_course_panel(campus):
    cols = ["CursoCodigo", "Alunos", "Turmas", "MediaNotas", "Inadimplencia", "ReceitaRealizada", "MatriculasAprovadas"]
    want = [
        ("ADM", 1, 1, None, D("0.00"), D("480.00"), D("0.00")),
        ("BSI", 3, 2, D("7.63"), D("2990.00"), D("2970.00"), D("3.00")),
        ("DPD", 1, 1, None, D("1280.00"), D("0.00"), D("0.00")),
    ]
    assert rows(rep.course_panel(campus), *cols) == want
    assert rows(course_panel_joined(campus), *cols) == want
    exact = {r["CursoCodigo"]: r for r in rep.course_panel_exact(campus).collect()}["BSI"]
    assert (exact["Inadimplencia"], exact["ReceitaRealizada"]) == (D("2180.00"), D("2160.00"))
    assert (exact["MatriculasAprovadas"], exact["MediaNotas"]) == (D("2.00"), D("7.27"))


def test_class_ranking(campus):
    out = class_ranking(campus["Matricula"], campus["Turma"], campus["Aluno"], campus["Pessoa"])
    got = rows(out, "RA", "RowNumberTurma", "RankTurma", "DenseRankTurma", "Quartil", "NotaAnterior", "NotaSeguinte")
    assert got == [
        ("20260001", 1, 1, 1, 1, None, D("7.90")),
        ("20260002", 2, 2, 2, 2, D("8.70"), D("5.20")),
        ("20260004", 3, 3, 3, 3, D("7.90"), None),
    ]


def test_weighted_grades(campus):
    assert rows(final_grades(campus["Nota"], campus["Avaliacao"]), "MatriculaID", "_final") == [
        (1, D("8.74")), (2, D("7.90")), (3, D("5.18")),
    ]


def test_event_health_and_minutes(campus):
    health = a.event_health(campus["EventStream"], campus["EventType"]).collect()
    assert len(health) == 7 and all(r["Eventos"] == 1 and r["EventosComErro"] == 0 for r in health)
    minutes = a.minute_counts(campus["EventStream"], campus["EventType"]).collect()
    assert len(minutes) == 7 and {r["MetricValue"] for r in minutes} == {D("1.0000")}


def test_warehouse(spark, campus):
    out = work_path(spark, "test-warehouse")
    counts = {r["table"]: r["rows"] for r in w.rebuild_warehouse(spark, campus, out, "a", AS_OF).collect()}
    assert counts == {
        "DimTempo": 20, "DimCurso": 3, "DimAluno": 5, "DimTurma": 4, "FatoAcademico": 6, "FatoFinanceiro": 5,
        "FatoTelemetria": 7, "KPI_Diario": 80,
    }
    kpi = {(r["DataRef"], r["KPIName"]): r["KPIValue"] for r in current(spark, out, "KPI_Diario").collect()}
    enrolment_day = dt.date(2026, 3, 1)
    assert kpi[enrolment_day, "ALUNOS_ATIVOS"] == D("5")
    assert kpi[enrolment_day, "TAXA_APROVACAO"] == D("66.6667")
    assert kpi[dt.date(2026, 3, 2), "TAXA_APROVACAO"] is None
    assert kpi[dt.date(2026, 3, 9), "EVENTOS_TOTAL"] == D("7")
    assert kpi[dt.date(2026, 3, 10), "INADIMPLENCIA_VALOR"] == D("2650.0000")
    late = {r["ParcelaID"]: r["AtrasoDias"] for r in current(spark, out, "FatoFinanceiro").collect()}
    assert late == {1: 0, 3: 10, 4: 0, 5: 0, 6: 10}
    bands = dict(rows(current(spark, out, "DimAluno"), "RA", "FaixaBolsa"))
    assert bands["20260001"] == "PARCIAL" and bands["20260003"] == "ALTA" and bands["20260002"] == "SEM_BOLSA"


def test_refresh_window_keeps_keys_and_other_days(spark, campus):
    out = work_path(spark, "test-refresh")
    w.rebuild_warehouse(spark, campus, out, "a", AS_OF)
    keys = dict(rows(current(spark, out, "DimAluno"), "AlunoID", "AlunoKey"))
    before = rows(current(spark, out, "FatoFinanceiro").filter("TempoKey < 20260305"), "ParcelaID")
    # A student with a smaller id joins, and the instalments of 10 March disappear.
    extra = campus["Aluno"].filter("AlunoID = 1").withColumn("AlunoID", F.lit(0))
    src = dict(
        campus,
        Aluno=campus["Aluno"].unionByName(extra),
        ParcelaFinanceira=campus["ParcelaFinanceira"].filter("DataVencimento <> DATE '2026-03-10'"),
    )
    out_rows = w.refresh_window(spark, src, out, "b", AS_OF, dt.date(2026, 3, 5), dt.date(2026, 3, 15))
    assert dict(rows(out_rows, "table", "rows"))["DimAluno"] == 6
    manifests = {"a": manifest.load(spark, out, 1), "b": manifest.load(spark, out)}
    assert (manifests["b"].version, manifests["b"].run) == (2, "b")
    for run, tables in (("a", ["DimTempo", "DimCurso", "DimAluno", "DimTurma", *w.FACTS, "KPI_Diario"]), ("b", w.FACTS)):
        for name in tables:
            stored = current(spark, out, name, manifests[run])
            assert stored.count() == stored.dropna(subset=[f.name for f in TABLES[name].struct.fields if not f.nullable]).count()
    now = dict(rows(current(spark, out, "DimAluno"), "AlunoID", "AlunoKey"))
    assert now.pop(0) == 6 and now == keys
    assert rows(current(spark, out, "FatoFinanceiro"), "ParcelaID") == before
    assert current(spark, out, "FatoAcademico").count() == 6
    kpi = current(spark, out, "KPI_Diario")
    assert kpi.count() == 80
    assert kpi.filter("DataRef = DATE '2026-03-10' AND KPIName = 'INADIMPLENCIA_VALOR'").first()["KPIValue"] == 0


def test_keys_are_never_given_twice(spark, campus):
    out = work_path(spark, "test-keys")
    day = dt.date(2026, 3, 1)
    w.rebuild_warehouse(spark, campus, out, "a", AS_OF)
    last = max(r["AlunoID"] for r in campus["Aluno"].collect())
    fewer = campus["Aluno"].filter(F.col("AlunoID") != last)
    w.refresh_window(spark, dict(campus, Aluno=fewer), out, "b", AS_OF, day, day)
    new = campus["Aluno"].filter("AlunoID = 1").withColumn("AlunoID", F.lit(99).cast("int"))
    later = AS_OF + dt.timedelta(days=9)
    w.refresh_window(spark, dict(campus, Aluno=fewer.unionByName(new)), out, "c", later, day, day)
    dim = {r["AlunoID"]: r for r in current(spark, out, "DimAluno").collect()}
    assert len({r["AlunoKey"] for r in dim.values()}) == len(dim) == 6
    assert not dim[last]["IsCurrent"] and dim[last]["EffectiveEndDate"] == AS_OF
    assert dim[1]["EffectiveStartDate"] == AS_OF and dim[99]["EffectiveStartDate"] == later


def test_seed_meets_all_rules(campus):
    for table in ROWS:
        keys = {"DimTempo": "TempoKey"}
        key = campus[table].columns[0] if table not in keys else keys[table]
        good, bad = validate(campus[table], rules_for(table), key, campus)
        assert bad.count() == 0, (table, bad.collect())
        assert good.count() == campus[table].count()


def test_balance_of_unknown_student(spark, campus):
    from lectern.functions.sql import register_balance

    name = register_balance(campus["ParcelaFinanceira"], "seed_balance")
    r = spark.sql(f"SELECT b.* FROM VALUES (77) AS s(id) LEFT JOIN LATERAL {name}(s.id) b").first()
    assert r["ParcelasTotal"] == 0 and r["ValorEmAberto"] is None


def test_named_views(spark, campus):
    from lectern.plans.views import register_views

    assert len(register_views(spark, campus, AS_OF)) == 5
    top = spark.sql(
        "SELECT NomeExibicao, fn_TempoKey(DATE '2026-03-20') AS k FROM vw_VisaoUnica"
        " ORDER BY ValorEmAberto DESC, CRA DESC, NomeExibicao LIMIT 1"
    ).first()
    assert (top["NomeExibicao"], top["k"]) == ("Aluno Seed 20260002", 20260320)
    open_ = spark.sql(
        "SELECT a.CRA, s.ValorEmAberto FROM vw_CRA a LEFT JOIN LATERAL fn_SaldoAluno(a.AlunoID) s WHERE a.AlunoID = 1"
    ).first()
    assert (open_["CRA"], open_["ValorEmAberto"]) == (D("8.70"), D("810.00"))
