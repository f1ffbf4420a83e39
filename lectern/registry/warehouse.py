"""Star schema, KPIs and reports."""

import datetime as dt

from pyspark.sql import functions as F

from lectern.functions.scalar import date_key
from lectern.operators.ranking import class_ranking
from lectern.plans import reports as rep
from lectern.plans import warehouse as w
from lectern.registry.columns import WEEK_SQL
from lectern.registry.core import half_up, mean2, query, units
from lectern.registry.grouped import GPA_SQL, MINUTE_SQL, RANKING_SQL
from lectern.session import work_path
from lectern.sources.sinks import current, stored

AS_OF = dt.date(2001, 8, 2)
D0, D1 = dt.date(1996, 1, 1), dt.date(2000, 12, 31)
E0, E1 = dt.date(2024, 1, 5), dt.date(2024, 1, 25)


def _day(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def days_sql(d0: str, d1: str) -> str:
    return f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS TempoKey, CAST(d AS DATE) AS DataCompleta,
        CAST(year(d) AS INTEGER) AS Ano, CAST(month(d) AS INTEGER) AS Mes, CAST(day(d) AS INTEGER) AS Dia,
        CAST(quarter(d) AS INTEGER) AS Trimestre, {WEEK_SQL.format(d='d')} AS SemanaAno,
        CAST(dayofweek(d) + 1 AS INTEGER) AS DiaSemana, dayname(d) AS NomeDia, monthname(d) AS NomeMes,
        dayofweek(d) IN (0, 6) AS IsFimSemana
    FROM (SELECT unnest(generate_series({d0}, {d1}, INTERVAL 1 DAY)) AS d)"""


# ---- dimensions -------------------------------------------------------------
@query("dim_date", f"""
    WITH days AS ({days_sql(_day(D0), _day(D1))})
    SELECT * FROM days WHERE DataCompleta NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F')""")
def _(c):
    known = c.sql("SELECT CAST(o_orderdate AS DATE) AS DataCompleta FROM {orders} WHERE o_orderstatus = 'F'")
    return w.dim_date(c.spark, known, D0, D1)


CURRENT = f"true AS IsCurrent, {_day(AS_OF)} AS EffectiveStartDate, CAST(NULL AS DATE) AS EffectiveEndDate"
DIM_COURSE = f"""SELECT c.CursoID, c.Codigo AS CodigoCurso, c.Nome AS NomeCurso, d.Sigla AS DepartamentoSigla, c.Nivel,
    c.Modalidade, {CURRENT}, row_number() OVER (ORDER BY c.CursoID) AS CursoKey
    FROM Curso c JOIN Departamento d ON d.DepartamentoID = c.DepartamentoID"""
DIM_STUDENT = f"""SELECT AlunoID, RA, StatusAcademico, Bolsista, CASE WHEN PercentualBolsa = 0 THEN 'SEM_BOLSA'
    WHEN PercentualBolsa < 50 THEN 'PARCIAL' WHEN PercentualBolsa < 100 THEN 'ALTA' ELSE 'INTEGRAL' END AS FaixaBolsa,
    {CURRENT}, row_number() OVER (ORDER BY AlunoID) AS AlunoKey FROM Aluno"""
DIM_CLASS = """SELECT t.TurmaID, t.CodigoTurma, t.Ano, t.Periodo, t.Turno, d.Codigo AS DisciplinaCodigo,
    d.Nome AS DisciplinaNome, d.CursoID, t.ProfessorID, p.NomeExibicao AS ProfessorNome, t.Encerrada,
    row_number() OVER (ORDER BY t.TurmaID) AS TurmaKey
    FROM Turma t JOIN Disciplina d ON d.DisciplinaID = t.DisciplinaID
    JOIN Professor f ON f.ProfessorID = t.ProfessorID JOIN Pessoa p ON p.PessoaID = f.PessoaID"""


@query("dim_course", DIM_COURSE)
def dim_course(c):
    return w.dim_course(c.Curso, c.Departamento, AS_OF)


@query("dim_student", DIM_STUDENT)
def dim_student(c):
    return w.dim_student(c.Aluno, AS_OF)


@query("dim_class", DIM_CLASS)
def dim_class(c):
    return w.dim_class(c.Turma, c.Disciplina, c.Professor, c.Pessoa)


# ---- facts ------------------------------------------------------------------
DIMS = f"dc AS ({DIM_COURSE}), da AS ({DIM_STUDENT}), dt AS ({DIM_CLASS})"


def key_sql(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m%d') AS INTEGER)"


def academic_sql(d0: dt.date, d1: dt.date) -> str:
    return f"""SELECT {key_sql('m.DataMatricula')} AS TempoKey, da.AlunoKey, dc.CursoKey, dt.TurmaKey, m.MatriculaID,
        m.StatusMatricula, m.FrequenciaPercentual, m.NotaFinal,
        CASE m.StatusMatricula WHEN 'APROVADA' THEN true WHEN 'REPROVADA' THEN false END AS Aprovado,
        d.CargaHoraria, d.Creditos
    FROM Matricula m JOIN Turma t ON t.TurmaID = m.TurmaID JOIN Disciplina d ON d.DisciplinaID = t.DisciplinaID
    JOIN da ON da.AlunoID = m.AlunoID JOIN dc ON dc.CursoID = d.CursoID JOIN dt ON dt.TurmaID = t.TurmaID
    WHERE CAST(m.DataMatricula AS DATE) BETWEEN {_day(d0)} AND {_day(d1)}"""


def finance_sql(d0: dt.date, d1: dt.date, as_of: dt.date) -> str:
    return f"""SELECT {key_sql('p.DataVencimento')} AS TempoKey, da.AlunoKey, dc.CursoKey, p.ParcelaID, p.Competencia,
        p.StatusParcela, p.ValorLiquido, CAST(coalesce(p.ValorPago, 0) AS DECIMAL(12,2)) AS ValorPago,
        CAST(p.ValorLiquido - coalesce(p.ValorPago, 0) AS DECIMAL(12,2)) AS SaldoAberto,
        CAST(CASE WHEN p.StatusParcela IN ('ABERTA','ATRASADA','NEGOCIADA') AND p.DataVencimento < {_day(as_of)}
            THEN date_diff('day', p.DataVencimento, {_day(as_of)}) ELSE 0 END AS INTEGER) AS AtrasoDias
    FROM ParcelaFinanceira p JOIN da ON da.AlunoID = p.AlunoID
    LEFT JOIN (SELECT m.AlunoID, d.CursoID, row_number() OVER (PARTITION BY m.AlunoID
            ORDER BY m.DataMatricula DESC NULLS LAST, m.MatriculaID DESC NULLS LAST) AS rn
        FROM Matricula m JOIN Disciplina d ON d.DisciplinaID = m.TurmaID) x ON x.AlunoID = p.AlunoID AND x.rn = 1
    LEFT JOIN dc ON dc.CursoID = x.CursoID
    WHERE p.DataVencimento BETWEEN {_day(d0)} AND {_day(d1)}"""


def telemetry_sql(d0: dt.date, d1: dt.date) -> str:
    return f"""SELECT {key_sql('e.OccurredAt')} AS TempoKey, e.EventTypeID, da.AlunoKey, e.SessionID,
        count(*) AS Eventos,
        {mean2('sum(e.DurationMs)', 'count(e.DurationMs)', 'DECIMAL(18,2)', 0)} AS DuracaoMediaMs,
        CAST(sum(coalesce(e.NumericValue, 0)) AS DECIMAL(18,4)) AS ValorNumericoSoma
    FROM EventStream e LEFT JOIN da ON da.AlunoID = e.AlunoID
    WHERE CAST(e.OccurredAt AS DATE) BETWEEN {_day(d0)} AND {_day(d1)} GROUP BY ALL"""


def academic(c, d0=D0, d1=D1):
    dims = {"DimCurso": dim_course(c), "DimAluno": dim_student(c), "DimTurma": dim_class(c)}
    return w.fact_academic(c.Matricula, c.Turma, c.Disciplina, dims, d0, d1)


def finance(c, d0=D0, d1=D1):
    dims = {"DimCurso": dim_course(c), "DimAluno": dim_student(c)}
    return w.fact_finance(c.ParcelaFinanceira, c.Matricula, c.Turma, c.Disciplina, dims, d0, d1, AS_OF)


def telemetry(c, d0=E0, d1=E1):
    return w.fact_telemetry(c.EventStream, dim_student(c), d0, d1)


@query("fact_academic", f"WITH {DIMS} {academic_sql(D0, D1)}")
def _(c):
    return academic(c)


@query("fact_finance", f"WITH {DIMS} {finance_sql(D0, D1, AS_OF)}")
def _(c):
    return finance(c)


@query("fact_telemetry", f"WITH {DIMS} {telemetry_sql(E0, E1)}")
def _(c):
    return telemetry(c)


# ---- KPIs -------------------------------------------------------------------
def kpi_sql(name: str, unit: str, target: int, value: str, fact: str, d0: dt.date, d1: dt.date) -> str:
    return f"""SELECT d.DataCompleta AS DataRef, '{name}' AS KPIName, CAST({value} AS DECIMAL(18,4)) AS KPIValue,
        '{unit}' AS Unidade, CAST({target} AS DECIMAL(18,4)) AS MetaValor
    FROM days d LEFT JOIN {fact} f ON f.TempoKey = d.TempoKey
    WHERE d.DataCompleta BETWEEN {_day(d0)} AND {_day(d1)} GROUP BY d.DataCompleta"""


RATE = units(
    half_up(
        "100 * sum(CASE WHEN f.StatusMatricula = 'APROVADA' THEN 1 ELSE 0 END)",
        "CAST(sum(CASE WHEN f.StatusMatricula IN ('APROVADA','REPROVADA') THEN 1 ELSE 0 END) AS BIGINT)", 4,
    ), 4, "DECIMAL(18,4)",
)
VALUES = {
    "kpi_active_students": (*w.ACTIVE_STUDENTS, "count(DISTINCT f.AlunoKey)", "academic"),
    "kpi_approval_rate": (*w.APPROVAL_RATE, RATE, "academic"),
    "kpi_overdue_value": (*w.OVERDUE_VALUE, "sum(coalesce(f.SaldoAberto, 0))", "finance"),
    "kpi_events_total": (*w.EVENTS_TOTAL, "sum(coalesce(f.Eventos, 0))", "telemetry"),
}


def facts_sql(d0: dt.date, d1: dt.date, e0: dt.date, e1: dt.date) -> str:
    return f"""WITH {DIMS}, days AS ({days_sql(_day(min(d0, e0)), _day(max(d1, e1)))}),
        academic AS ({academic_sql(d0, d1)}), finance AS ({finance_sql(d0, d1, AS_OF)}),
        telemetry AS ({telemetry_sql(e0, e1)})"""


def days(c, d0, d1):
    return w.dim_date(c.spark, None, d0, d1)


@query("kpi_active_students", facts_sql(D0, D1, E0, E1) + kpi_sql(*VALUES["kpi_active_students"], D0, D1))
def _(c):
    return w.kpi_active_students(days(c, D0, D1), academic(c), D0, D1)


@query("kpi_approval_rate", facts_sql(D0, D1, E0, E1) + kpi_sql(*VALUES["kpi_approval_rate"], D0, D1))
def _(c):
    return w.kpi_approval_rate(days(c, D0, D1), academic(c), D0, D1)


@query("kpi_overdue_value", facts_sql(D0, D1, E0, E1) + kpi_sql(*VALUES["kpi_overdue_value"], D0, D1))
def _(c):
    return w.kpi_overdue_value(days(c, D0, D1), finance(c), D0, D1)


@query("kpi_events_total", facts_sql(D0, D1, E0, E1) + kpi_sql(*VALUES["kpi_events_total"], E0, E1))
def _(c):
    return w.kpi_events_total(days(c, E0, E1), telemetry(c), E0, E1)


A0, A1 = dt.date(1995, 1, 1), dt.date(2024, 1, 31)


@query("kpi_daily", facts_sql(A0, A1, A0, A1) + " UNION ALL ".join(kpi_sql(*v, A0, A1) for v in VALUES.values()))
def _(c):
    return w.kpi_daily(days(c, A0, A1), academic(c, A0, A1), finance(c, A0, A1), telemetry(c, A0, A1), A0, A1)


SOURCES = ("Matricula", "Curso", "Departamento", "Aluno", "Turma", "Disciplina", "Professor", "Pessoa",
           "ParcelaFinanceira", "EventStream")


def sources(c):
    """The source tables; enrolments, which every step reads, are derived from the order lines once."""
    enrolments = c.stored(
        "Matricula", "MatriculaID", "AlunoID", "TurmaID", "DataMatricula", "StatusMatricula", "FrequenciaPercentual", "NotaFinal"
    )
    return c.tables(*[name for name in SOURCES if name != "Matricula"]) | {"Matricula": enrolments}


def checksum_sql(table: str, source: str, numbers: str, texts: str, others: str) -> str:
    """Rows, filled values, sum of numbers and length of texts of a table; the columns as lists with blanks."""
    numbers, texts, others = numbers.split(), texts.split(), others.split()
    filled = " + ".join(f"count({c})" for c in [*numbers, *texts, *others])
    total = " + ".join(f"coalesce(sum(CAST({c} AS DECIMAL(28,4))), 0)" for c in numbers)
    chars = " + ".join(f"coalesce(sum(length({c})), 0)" for c in texts) or "0"
    return f"""SELECT '{table}' AS "table", count(*) AS "rows", CAST({filled} AS BIGINT) AS filled,
        CAST({total} AS DECIMAL(38,4)) AS total, CAST({chars} AS BIGINT) AS chars FROM {source}"""


BUILT_SQL = " UNION ALL ".join(checksum_sql(*x) for x in [
    ("DimTempo", "days", "TempoKey Ano Mes Dia Trimestre SemanaAno DiaSemana", "NomeDia NomeMes", "DataCompleta IsFimSemana"),
    ("DimCurso", "dc", "CursoKey CursoID", "CodigoCurso NomeCurso DepartamentoSigla Nivel Modalidade",
     "IsCurrent EffectiveStartDate EffectiveEndDate"),
    ("DimAluno", "da", "AlunoKey AlunoID", "RA StatusAcademico FaixaBolsa", "Bolsista IsCurrent EffectiveStartDate EffectiveEndDate"),
    ("DimTurma", "dt", "TurmaKey TurmaID Ano Periodo CursoID ProfessorID",
     "CodigoTurma Turno DisciplinaCodigo DisciplinaNome ProfessorNome", "Encerrada"),
    ("FatoAcademico", "academic", "TempoKey AlunoKey CursoKey TurmaKey FrequenciaPercentual NotaFinal CargaHoraria Creditos (TempoKey//100)",
     "MatriculaID StatusMatricula", "Aprovado"),
    ("FatoFinanceiro", "finance", "TempoKey AlunoKey CursoKey ParcelaID ValorLiquido ValorPago SaldoAberto AtrasoDias (TempoKey//100)",
     "Competencia StatusParcela", ""),
    ("FatoTelemetria", "telemetry", "TempoKey EventTypeID AlunoKey SessionID Eventos DuracaoMediaMs ValorNumericoSoma (TempoKey//100)", "", ""),
    ("KPI_Diario", "kpi", "KPIValue MetaValor", "KPIName Unidade", "DataRef"),
])


@query("rebuild_warehouse", f"""
    WITH {DIMS}, d0 AS (SELECT CAST(min(DataMatricula) AS DATE) AS d FROM Matricula),
    days AS (SELECT * FROM ({days_sql(_day(A0), _day(A1))}) WHERE DataCompleta >= (SELECT d FROM d0)),
    academic AS ({academic_sql(A0, A1)}),
    finance AS (SELECT * FROM ({finance_sql(A0, A1, A1)}) WHERE TempoKey >= (SELECT {key_sql('d')} FROM d0)),
    telemetry AS ({telemetry_sql(A0, A1)}),
    kpi AS ({' UNION ALL '.join(kpi_sql(*v, A0, A1) for v in VALUES.values())}) {BUILT_SQL}""")
def _(c):
    """Row counts and checksums of all tables, observed while they were written."""
    return w.rebuild_warehouse(c.spark, sources(c), work_path(c.spark, "warehouse"), "0001", A1)


W0, W1 = dt.date(1998, 3, 10), dt.date(1998, 9, 20)


@query("refresh_window", f"""
    WITH a1 AS (SELECT AlunoID, row_number() OVER (ORDER BY AlunoID) AS AlunoKey FROM Aluno WHERE AlunoID % 10 <> 3),
    a2 AS (SELECT * FROM a1 WHERE AlunoID % 10 <> 4 UNION ALL
        SELECT AlunoID, (SELECT count(*) FROM a1) + row_number() OVER (ORDER BY AlunoID) FROM Aluno WHERE AlunoID % 10 = 3),
    m AS (SELECT *, CAST(DataMatricula AS DATE) BETWEEN {_day(W0)} AND {_day(W1)} AS fresh FROM Matricula),
    fact AS (SELECT {key_sql('DataMatricula')} AS TempoKey, coalesce(a2.AlunoKey, a1.AlunoKey) AS AlunoKey, MatriculaID,
            StatusMatricula, CAST(DataMatricula AS DATE) AS DataRef
        FROM m LEFT JOIN a1 ON NOT fresh AND a1.AlunoID = m.AlunoID LEFT JOIN a2 ON fresh AND a2.AlunoID = m.AlunoID
        WHERE coalesce(a2.AlunoKey, a1.AlunoKey) IS NOT NULL)
    SELECT 'fact' AS Origem, TempoKey, AlunoKey, MatriculaID, StatusMatricula FROM fact
    UNION ALL SELECT 'kpi', {key_sql('d')}, (SELECT count(DISTINCT AlunoKey) FROM fact WHERE fact.DataRef = days.d), NULL, NULL
        FROM (SELECT CAST(unnest(generate_series({_day(W0)}, {_day(W1)}, INTERVAL 1 DAY)) AS DATE) AS d) AS days
    UNION ALL SELECT 'gone', NULL, AlunoKey, NULL, NULL FROM a1 WHERE AlunoID % 10 = 4""")
def _(c):
    """A warehouse without some students, refreshed for some months after others have left and those have joined."""
    out, src = work_path(c.spark, "refresh"), sources(c)
    before = dict(src, Aluno=c.Aluno.filter("AlunoID % 10 <> 3"))
    w.rebuild_warehouse(c.spark, before, out, "full", A1)
    w.refresh_window(c.spark, dict(src, Aluno=c.Aluno.filter("AlunoID % 10 <> 4")), out, "a-later-run", A1, W0, W1)
    fact, kpi, student = (current(c.spark, out, n) for n in ("FatoAcademico", "KPI_Diario", "DimAluno"))
    kpi = kpi.filter(F.col("DataRef").between(F.lit(W0), F.lit(W1)) & (F.col("KPIName") == w.ACTIVE_STUDENTS[0]))
    none = F.lit(None).cast("string")
    return (
        fact.select(F.lit("fact").alias("Origem"), "TempoKey", "AlunoKey", "MatriculaID", "StatusMatricula")
        .unionByName(kpi.select(
            F.lit("kpi").alias("Origem"), date_key("DataRef").alias("TempoKey"), F.col("KPIValue").cast("long").alias("AlunoKey"),
            none.alias("MatriculaID"), none.alias("StatusMatricula")))
        .unionByName(student.filter("NOT IsCurrent").select(
            F.lit("gone").alias("Origem"), F.lit(None).cast("int").alias("TempoKey"), "AlunoKey", none.alias("MatriculaID"),
            none.alias("StatusMatricula")))
    )


@query("rebuild_minute_metric", MINUTE_SQL.format(where=""))
def _(c):
    path, as_of = work_path(c.spark, "minutes"), dt.datetime(2024, 1, 31)
    w.rebuild_minute_metric(c.EventStream, c.EventType, path, as_of, dt.datetime(2024, 1, 1), as_of)
    w.rebuild_minute_metric(c.EventStream, c.EventType, path, as_of)
    return stored(c.spark, path).drop("DataRef")


# ---- reports ----------------------------------------------------------------
CLOCK = dt.date(2024, 2, 15)
STUDENT_SOURCES = ("Aluno", "Pessoa", "Matricula", "Turma", "Disciplina", "Curso", "ParcelaFinanceira", "EventStream")
STUDENT_SQL = f"""WITH gpa AS ({GPA_SQL}),
    fav AS (SELECT *, row_number() OVER (PARTITION BY AlunoID ORDER BY n DESC NULLS LAST, Nome ASC NULLS FIRST) AS rn FROM (
        SELECT m.AlunoID, c.CursoID, c.Codigo, c.Nome, count(*) AS n FROM Matricula m
        JOIN Disciplina d ON d.DisciplinaID = m.TurmaID JOIN Curso c ON c.CursoID = d.CursoID GROUP BY ALL)),
    bal AS (SELECT AlunoID,
        CAST(sum(CASE WHEN StatusParcela IN ('ABERTA','ATRASADA','NEGOCIADA') THEN 1 ELSE 0 END) AS BIGINT) AS pend,
        CAST(sum(CASE WHEN StatusParcela IN ('ABERTA','ATRASADA','NEGOCIADA') THEN ValorLiquido - coalesce(ValorPago, 0)
            ELSE 0 END) AS DECIMAL(38,2)) AS aberto,
        CAST(sum(coalesce(ValorPago, 0)) AS DECIMAL(38,2)) AS pago FROM ParcelaFinanceira GROUP BY AlunoID),
    acad AS (SELECT AlunoID, count(*) AS n, CAST(sum(CASE WHEN StatusMatricula = 'APROVADA' THEN 1 ELSE 0 END) AS BIGINT) AS ok,
        CAST(sum(CASE WHEN StatusMatricula = 'REPROVADA' THEN 1 ELSE 0 END) AS BIGINT) AS nok FROM Matricula GROUP BY AlunoID),
    tel AS (SELECT AlunoID, count(*) AS n, max(OccurredAt) AS last FROM EventStream
        WHERE OccurredAt >= TIMESTAMP '2024-01-16 00:00:00' GROUP BY AlunoID),
    ult AS (SELECT m.*, t.CodigoTurma, row_number() OVER (PARTITION BY m.AlunoID
        ORDER BY m.DataMatricula DESC NULLS LAST, m.MatriculaID DESC NULLS LAST) AS rn
        FROM Matricula m JOIN Turma t ON t.TurmaID = m.TurmaID),
    report AS (SELECT a.AlunoID, a.RA, p.NomeExibicao, p.Email, a.StatusAcademico, fav.Codigo AS CursoCodigo, fav.Nome AS CursoNome,
        gpa.CRA, bal.pend AS ParcelasPendentes, bal.aberto AS ValorEmAberto, bal.pago AS ValorPago,
        coalesce(acad.n, 0) AS TotalMatriculas, acad.ok AS Aprovacoes, acad.nok AS Reprovacoes,
        coalesce(tel.n, 0) AS Eventos30Dias, tel.last AS UltimoEventoEm, ult.CodigoTurma AS UltimaTurma,
        ult.StatusMatricula AS UltimoStatusMatricula, ult.DataMatricula AS UltimaMovimentacao
    FROM Aluno a JOIN Pessoa p ON p.PessoaID = a.PessoaID JOIN gpa ON gpa.AlunoID = a.AlunoID
    LEFT JOIN fav ON fav.AlunoID = a.AlunoID AND fav.rn = 1 LEFT JOIN bal ON bal.AlunoID = a.AlunoID
    LEFT JOIN acad ON acad.AlunoID = a.AlunoID LEFT JOIN tel ON tel.AlunoID = a.AlunoID
    LEFT JOIN ult ON ult.AlunoID = a.AlunoID AND ult.rn = 1)"""


def student_360(c):
    return rep.student_360(c.tables(*STUDENT_SOURCES), CLOCK)


@query("student_360", STUDENT_SQL + " SELECT * FROM report")
def _(c):
    return student_360(c)


@query("topk_student_360", STUDENT_SQL + """
    SELECT AlunoID, NomeExibicao, CursoNome, CRA, ValorEmAberto, Eventos30Dias FROM report
    ORDER BY ValorEmAberto DESC NULLS LAST, CRA DESC NULLS LAST, NomeExibicao ASC NULLS FIRST, AlunoID LIMIT 20""")
def _(c):
    return rep.topk_student_360(student_360(c))


PANEL_SOURCES = ("Curso", "Disciplina", "Turma", "Matricula", "ParcelaFinanceira")
OPEN = """CASE WHEN p.StatusParcela IN ('ABERTA','ATRASADA','NEGOCIADA') THEN p.ValorLiquido - coalesce(p.ValorPago, 0)
    ELSE 0 END"""
# A second derivation: enrolments and instalments meet per enrolment, the money of a student as one row.
PANEL_SQL = f"""WITH purse AS (SELECT p.AlunoID, count(*) AS n, sum({OPEN}) AS rest, sum(coalesce(p.ValorPago, 0)) AS paid
        FROM ParcelaFinanceira p GROUP BY p.AlunoID),
    taught AS (SELECT t.TurmaID, d.CursoID FROM Turma t JOIN Disciplina d USING (DisciplinaID)),
    fan AS (SELECT taught.CursoID, m.AlunoID, CAST(m.NotaFinal * 100 AS BIGINT) AS grade, greatest(coalesce(b.n, 1), 1) AS times,
            m.StatusMatricula = 'APROVADA' AS passed, coalesce(b.rest, 0) AS rest, coalesce(b.paid, 0) AS paid
        FROM Matricula m JOIN taught USING (TurmaID) LEFT JOIN purse b USING (AlunoID)),
    sums AS (SELECT CursoID, count(DISTINCT AlunoID) AS students, CAST(sum(grade * times) AS HUGEINT) AS points,
            CAST(sum(times) FILTER (grade IS NOT NULL) AS HUGEINT) AS graded, sum(rest) AS rest, sum(paid) AS paid,
            sum(times) FILTER (passed) AS passed FROM fan GROUP BY CursoID),
    panel AS (SELECT c.Codigo AS CursoCodigo, c.Nome AS CursoNome, coalesce(s.students, 0) AS Alunos,
        (SELECT count(*) FROM taught x WHERE x.CursoID = c.CursoID) AS Turmas,
        {mean2('s.points', 's.graded', 'DECIMAL(10,2)', 2, 8)} AS MediaNotas,
        CAST(coalesce(s.rest, 0) AS DECIMAL(38,2)) AS Inadimplencia,
        CAST(coalesce(s.paid, 0) AS DECIMAL(38,2)) AS ReceitaRealizada,
        CAST(coalesce(s.passed, 0) AS DECIMAL(38,2)) AS MatriculasAprovadas
    FROM Curso c LEFT JOIN sums s ON s.CursoID = c.CursoID)"""


def panel(c):
    return rep.course_panel(c.tables(*PANEL_SOURCES))


@query("course_panel", PANEL_SQL + " SELECT * FROM panel")
def _(c):
    return panel(c)


@query("topk_course_panel", PANEL_SQL + """
    SELECT CursoCodigo, CursoNome, Alunos, Inadimplencia, ReceitaRealizada, MediaNotas FROM panel
    ORDER BY Inadimplencia DESC NULLS LAST, CursoNome ASC NULLS FIRST, CursoCodigo LIMIT 20""")
def _(c):
    return rep.topk_course_panel(panel(c))


@query("course_panel_exact", f"""
    WITH taught AS (SELECT d.CursoID, t.TurmaID FROM Turma t JOIN Disciplina d ON d.DisciplinaID = t.DisciplinaID),
    e AS (SELECT taught.CursoID, m.* FROM Matricula m JOIN taught ON taught.TurmaID = m.TurmaID),
    acad AS (SELECT CursoID, count(DISTINCT AlunoID) AS alunos,
        {mean2('CAST(sum(NotaFinal * 100) AS HUGEINT)', 'count(NotaFinal)', 'DECIMAL(10,2)', 2, 8)} AS media,
        sum(CASE WHEN StatusMatricula = 'APROVADA' THEN 1 ELSE 0 END) AS ok FROM e GROUP BY CursoID),
    money AS (SELECT s.CursoID, sum({OPEN}) AS aberto, sum(coalesce(p.ValorPago, 0)) AS pago
        FROM (SELECT DISTINCT CursoID, AlunoID FROM e) s JOIN ParcelaFinanceira p ON p.AlunoID = s.AlunoID GROUP BY s.CursoID)
    SELECT c.Codigo AS CursoCodigo, c.Nome AS CursoNome, coalesce(acad.alunos, 0) AS Alunos,
        coalesce((SELECT count(*) FROM taught WHERE taught.CursoID = c.CursoID), 0) AS Turmas, acad.media AS MediaNotas,
        CAST(coalesce(money.aberto, 0) AS DECIMAL(38,2)) AS Inadimplencia,
        CAST(coalesce(money.pago, 0) AS DECIMAL(38,2)) AS ReceitaRealizada,
        CAST(coalesce(acad.ok, 0) AS DECIMAL(38,2)) AS MatriculasAprovadas
    FROM Curso c LEFT JOIN acad ON acad.CursoID = c.CursoID LEFT JOIN money ON money.CursoID = c.CursoID""")
def _(c):
    return rep.course_panel_exact(c.tables(*PANEL_SOURCES))


@query("recent_audit", """
    SELECT AuditID, EventTime, OrigemSchema, OrigemObjeto, Operacao, ChaveRegistro, AppUser, HostName, CorrelationID
    FROM ChangeAudit WHERE EventTime >= TIMESTAMP '2001-07-18 00:00:00'""")
def _(c):
    return rep.recent_audit(c.ChangeAudit, AS_OF)


@query("topk_class_ranking", f"""
    SELECT CodigoTurma, NomeAluno, NotaFinal, RankTurma, Quartil, MatriculaID FROM ({RANKING_SQL})
    ORDER BY CodigoTurma ASC NULLS FIRST, RankTurma ASC NULLS FIRST, MatriculaID LIMIT 20""")
def _(c):
    return rep.topk_class_ranking(c.tables("Matricula", "Turma", "Aluno", "Pessoa"))
