"""Joins, aggregations, rankings, top-k and set operations."""

import datetime as dt

from pyspark.sql import functions as F

from lectern.functions.sql import register_balance, register_date_key
from lectern.functions.status import CONCLUDED
from lectern.operators import aggregates as a
from lectern.operators import joins as j
from lectern.operators import ranking as r
from lectern.operators import sets
from lectern.plans.reports import gpa
from lectern.plans.warehouse import class_courses, dim_student
from lectern.registry.core import half_up, mean2, query, units

def _more_students(c):
    """Every student and as many keys without any rows."""
    return c.Aluno.select("AlunoID").unionByName(c.Aluno.select((-F.col("AlunoID")).alias("AlunoID")))


# ---- joins ------------------------------------------------------------------
@query("join_inner_chain", """
    SELECT m.MatriculaID, t.CodigoTurma, d.Codigo AS DisciplinaCodigo, c.Nome AS CursoNome
    FROM Matricula m JOIN Turma t ON t.TurmaID = m.TurmaID JOIN Disciplina d ON d.DisciplinaID = t.DisciplinaID
    JOIN Curso c ON c.CursoID = d.CursoID""")
def _(c):
    # The small tables meet first, so the enrolments are moved at most once.
    steps = [
        (c.Disciplina.select("DisciplinaID", "CursoID", F.col("Codigo").alias("DisciplinaCodigo")), "DisciplinaID"),
        (c.Curso.select("CursoID", F.col("Nome").alias("CursoNome")), "CursoID"),
    ]
    classes = j.chain(c.Turma.select("TurmaID", "DisciplinaID", "CodigoTurma"), steps)
    out = j.chain(c.Matricula.select("MatriculaID", "TurmaID"), [(classes, "TurmaID")])
    return out.select("MatriculaID", "CodigoTurma", "DisciplinaCodigo", "CursoNome")


@query("join_left_chain", """
    SELECT k.CursoID, d.DisciplinaID, t.TurmaID, m.MatriculaID, m.AlunoID,
        (SELECT count(*) FROM ParcelaFinanceira p WHERE p.AlunoID = m.AlunoID) AS Parcelas
    FROM (SELECT CursoID FROM Curso UNION ALL SELECT -1) k LEFT JOIN Disciplina d ON d.CursoID = k.CursoID
    LEFT JOIN Turma t ON t.DisciplinaID = d.DisciplinaID LEFT JOIN Matricula m ON m.TurmaID = t.TurmaID""")
def _(c):
    """Course to instalments through every hop; the last is counted per student, not multiplied out."""
    owed = c.ParcelaFinanceira.groupBy("AlunoID").agg(F.count("*").alias("Parcelas"))
    steps = [
        (c.Disciplina.select("CursoID", "DisciplinaID"), "CursoID"),
        (c.Turma.select("DisciplinaID", "TurmaID"), "DisciplinaID"),
        (c.Matricula.select("TurmaID", "MatriculaID", "AlunoID"), "TurmaID"),
        (owed, "AlunoID"),
    ]
    keys = c.Curso.select("CursoID").unionByName(c.spark.sql("SELECT -1 AS CursoID"))
    return j.chain(keys, steps, "left").select(
        "CursoID", "DisciplinaID", "TurmaID", "MatriculaID", "AlunoID", F.coalesce("Parcelas", F.lit(0)).alias("Parcelas")
    )


@query("join_current_dim", """
    SELECT EventID, CASE WHEN k.StatusAcademico = 'ATIVO' THEN k.AlunoKey END AS AlunoKey
    FROM EventStream e LEFT JOIN (SELECT AlunoID, StatusAcademico, row_number() OVER (ORDER BY AlunoID) AS AlunoKey
        FROM Aluno) k ON k.AlunoID = e.AlunoID""")
def _(c):
    # The built dimension; students who are not active count as no longer current.
    dim = dim_student(c.Aluno, dt.date(2001, 8, 2)).withColumn("IsCurrent", F.col("StatusAcademico") == "ATIVO")
    return j.with_key(c.EventStream.select("EventID", "AlunoID"), dim, "AlunoID", "AlunoKey", "left").drop("AlunoID")


@query("join_latest_lateral", """
    SELECT a.AlunoID, u.TurmaID, u.StatusMatricula, u.DataMatricula
    FROM (SELECT AlunoID FROM Aluno UNION ALL SELECT -AlunoID FROM Aluno) a LEFT JOIN (
        SELECT *, row_number() OVER (PARTITION BY AlunoID
            ORDER BY DataMatricula DESC NULLS LAST, MatriculaID DESC NULLS LAST) AS rn
        FROM Matricula) u ON u.AlunoID = a.AlunoID AND u.rn = 1""")
def _(c):
    return j.latest_per_key(
        _more_students(c), c.Matricula, "AlunoID", ["DataMatricula", "MatriculaID"],
        ["TurmaID", "StatusMatricula", "DataMatricula"],
    )


@query("join_mode_lateral", """
    WITH n AS (SELECT m.AlunoID, d.CursoID, count(*) AS n FROM Matricula m JOIN Disciplina d ON d.DisciplinaID = m.TurmaID
        GROUP BY ALL),
    t AS (SELECT *, row_number() OVER (PARTITION BY AlunoID ORDER BY n DESC NULLS LAST, CursoID ASC NULLS FIRST) AS rn FROM n)
    SELECT a.AlunoID, t.CursoID FROM (SELECT AlunoID FROM Aluno UNION ALL SELECT -AlunoID FROM Aluno) a
    LEFT JOIN t ON t.AlunoID = a.AlunoID AND t.rn = 1""")
def _(c):
    rows = c.Matricula.select("AlunoID", "TurmaID").join(class_courses(c.Turma, c.Disciplina), "TurmaID")
    return j.mode_per_key(_more_students(c), rows, "AlunoID", ["CursoID"], ["CursoID"])


@query("join_scalar_agg_lateral", """
    SELECT a.AlunoID, count(e.EventID) AS Eventos, max(e.OccurredAt) AS UltimoEvento, sum(e.NumericValue) AS Valor
    FROM Aluno a LEFT JOIN EventStream e ON e.AlunoID = a.AlunoID GROUP BY a.AlunoID""")
def _(c):
    out = j.agg_per_key(
        c.Aluno.select("AlunoID"), c.EventStream, "AlunoID", {"Eventos": F.count("*")},
        {"UltimoEvento": F.max("OccurredAt"), "Valor": F.sum("NumericValue").cast("decimal(38,4)")},
    )
    return out


@query("join_left_anti", """
    SELECT ParcelaID, DataVencimento FROM ParcelaFinanceira p
    WHERE NOT EXISTS (SELECT 1 FROM Pagamento g WHERE g.ParcelaID = p.ParcelaID AND g.GatewayStatus = 'CONFIRMED')""")
def _(c):
    paid = c.Pagamento.filter("GatewayStatus = 'CONFIRMED'").select("ParcelaID")
    return j.missing(c.ParcelaFinanceira, paid, "ParcelaID").select("ParcelaID", "DataVencimento")


@query("join_left_semi", """
    SELECT ParcelaID, DataVencimento FROM ParcelaFinanceira p
    WHERE EXISTS (SELECT 1 FROM Pagamento g WHERE g.ParcelaID = p.ParcelaID AND g.MeioPagamento = 'CHEQUE')""")
def _(c):
    cheques = c.Pagamento.filter("MeioPagamento = 'CHEQUE'").select("ParcelaID")
    return j.having_key(c.ParcelaFinanceira, cheques, "ParcelaID").select("ParcelaID", "DataVencimento")


@query("join_before_after", """
    SELECT n.ParcelaID, n.ValorLiquido AS Depois, o.ValorPago AS Antes, o.ParcelaID IS NULL AS Nova
    FROM ParcelaFinanceira n LEFT JOIN (SELECT * FROM ParcelaFinanceira WHERE DataVencimento < DATE '2000-01-01') o
    ON o.ParcelaID = n.ParcelaID""")
def _(c):
    cols = ["ParcelaID", "ValorLiquido", "ValorPago"]
    before = c.ParcelaFinanceira.filter(F.col("DataVencimento") < F.lit(dt.date(2000, 1, 1))).select(*cols)
    pairs = j.before_after(c.ParcelaFinanceira.select(*cols), before, "ParcelaID")
    return pairs.select(
        "ParcelaID", F.col("after.ValorLiquido").alias("Depois"), F.col("before.ValorPago").alias("Antes"),
        F.col("before").isNull().alias("Nova"),
    )


@query("join_theta_filter", """
    SELECT p.ProfessorID, d.DepartamentoID AS Lotacao, d.Nome AS LotacaoNome
    FROM Professor p JOIN Departamento d ON d.Sigla = 'D7'""")
def _(c):
    lookup = c.Departamento.select("Sigla", F.col("DepartamentoID").alias("Lotacao"), F.col("Nome").alias("LotacaoNome"))
    return j.attach_lookup(c.Professor.select("ProfessorID"), lookup, F.col("Sigla") == "D7", ["Lotacao", "LotacaoNome"])


@query("join_nonequi_guard", """
    SELECT n.NotaID, n.NotaObtida, a.NotaMaxima FROM Nota n JOIN Avaliacao a ON a.AvaliacaoID = n.AvaliacaoID
    WHERE n.NotaObtida > a.NotaMaxima""")
def _(c):
    return j.exceeds(c.Nota, c.Avaliacao, "AvaliacaoID", "NotaObtida", "NotaMaxima").select(
        "NotaID", "NotaObtida", "NotaMaxima"
    )


# ---- aggregations -----------------------------------------------------------
GPA_SQL = f"""
    SELECT a.AlunoID, CAST(coalesce({units(half_up('g.num', 'g.den', 0), 2, 'DECIMAL(5,2)')}, 0) AS DECIMAL(5,2)) AS CRA
    FROM Aluno a LEFT JOIN (
        SELECT m.AlunoID, CAST(sum(CAST(coalesce(m.NotaFinal, 0) * 100 AS BIGINT) * d.Creditos) AS BIGINT) AS num,
            CAST(sum(d.Creditos) AS BIGINT) AS den
        FROM Matricula m JOIN Turma t ON t.TurmaID = m.TurmaID JOIN Disciplina d ON d.DisciplinaID = t.DisciplinaID
        WHERE m.StatusMatricula IN ('APROVADA', 'REPROVADA') GROUP BY m.AlunoID) g ON g.AlunoID = a.AlunoID"""


@query("weighted_gpa", GPA_SQL)
def _(c):
    return gpa(c.Matricula, c.Turma, c.Disciplina, c.Aluno)


@query("udf_gpa", GPA_SQL)
def _(c):
    return gpa(c.Matricula, c.Turma, c.Disciplina, c.Aluno).select("AlunoID", "CRA")


@query("weighted_grade", f"""
    SELECT MatriculaID, {units(half_up('num', 'den', 0), 2, 'DECIMAL(5,2)')} AS NotaFinal FROM (
        SELECT n.MatriculaID, CAST(sum(CAST(n.NotaObtida * 100 AS BIGINT) * CAST(a.Peso AS BIGINT)) AS BIGINT) AS num,
            CAST(sum(CAST(a.Peso AS BIGINT)) AS BIGINT) AS den
        FROM Nota n JOIN Avaliacao a ON a.AvaliacaoID = n.AvaliacaoID GROUP BY n.MatriculaID)""")
def _(c):
    rows = c.Nota.join(c.Avaliacao.select("AvaliacaoID", "Peso"), "AvaliacaoID")
    return a.weighted_mean(rows, "MatriculaID", "NotaObtida", "Peso", "NotaFinal")


# Independent of the operator: filtered aggregates over what each instalment owes.
BALANCE_SQL = """
    WITH owed AS (SELECT AlunoID, coalesce(ValorPago, 0) AS paid, ValorLiquido - coalesce(ValorPago, 0) AS rest,
            list_contains(['ABERTA', 'ATRASADA', 'NEGOCIADA'], StatusParcela) AS open FROM ParcelaFinanceira)
    SELECT AlunoID, count(paid) AS ParcelasTotal, count(*) FILTER (open) AS ParcelasPendentes,
        CAST(coalesce(sum(rest) FILTER (open), 0) AS DECIMAL(38,2)) AS ValorEmAberto,
        CAST(sum(paid) AS DECIMAL(38,2)) AS ValorPago
    FROM owed GROUP BY AlunoID"""


@query("balance_summary", BALANCE_SQL)
def _(c):
    return a.balance_summary(c.ParcelaFinanceira)


@query("udtf_balance", f"""
    SELECT a.AlunoID, coalesce(b.ParcelasTotal, 0) AS ParcelasTotal, b.ParcelasPendentes, b.ValorEmAberto, b.ValorPago
    FROM (SELECT AlunoID FROM Aluno UNION ALL SELECT -AlunoID FROM Aluno) a LEFT JOIN ({BALANCE_SQL}) b ON b.AlunoID = a.AlunoID""")
def _(c):
    balance = register_balance(c.ParcelaFinanceira, "campus_balance")
    _more_students(c).createOrReplaceTempView("campus_balance_students")
    return c.spark.sql(
        "SELECT a.AlunoID, b.ParcelasTotal, b.ParcelasPendentes, b.ValorEmAberto, b.ValorPago"
        f" FROM campus_balance_students a LEFT JOIN LATERAL {balance}(a.AlunoID) b"
    )


@query("udf_date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS TempoKey FROM orders")
def _(c):


    name = register_date_key(c.spark)
    return c.raw("orders").selectExpr("o_orderkey", f"{name}(CAST(o_orderdate AS DATE)) AS TempoKey")


@query("payments_rollup", """
    SELECT ParcelaID, CAST(sum(ValorPagamento) AS DECIMAL(22,2)) AS TotalPago, max(DataPagamento) AS UltimoPagamento
    FROM Pagamento GROUP BY ParcelaID""")
def _(c):
    return a.payments_rollup(c.Pagamento)


@query("conditional_counts", """
    SELECT AlunoID, count(*) AS Total, CAST(sum(CASE WHEN StatusMatricula = 'APROVADA' THEN 1 ELSE 0 END) AS BIGINT) AS Aprovacoes,
        CAST(sum(CASE WHEN StatusMatricula = 'REPROVADA' THEN 1 ELSE 0 END) AS BIGINT) AS Reprovacoes
    FROM Matricula GROUP BY AlunoID""")
def _(c):
    status = F.col("StatusMatricula")
    return a.conditional_counts(
        c.Matricula, "AlunoID", {"Aprovacoes": status == "APROVADA", "Reprovacoes": status == "REPROVADA"}
    )


@query("distinct_counts", """
    SELECT d.CursoID, count(DISTINCT m.AlunoID) AS Alunos, count(DISTINCT m.TurmaID) AS Turmas
    FROM Matricula m JOIN Disciplina d ON d.DisciplinaID = m.TurmaID GROUP BY d.CursoID""")
def _(c):
    rows = c.Matricula.select("AlunoID", "TurmaID").join(class_courses(c.Turma, c.Disciplina), "TurmaID")
    return a.distinct_counts(rows, "CursoID", {"Alunos": "AlunoID", "Turmas": "TurmaID"})


RATIO_SQL = half_up("100 * sum(CASE WHEN StatusMatricula = 'APROVADA' THEN 1 ELSE 0 END)",
                    "CAST(sum(CASE WHEN StatusMatricula IN ('APROVADA','REPROVADA') THEN 1 ELSE 0 END) AS BIGINT)", 4)


@query("safe_ratio_pct", f"""
    SELECT TurmaID, {units(RATIO_SQL, 4, 'DECIMAL(18,4)')} AS Taxa FROM Matricula GROUP BY TurmaID""")
def _(c):
    status = F.col("StatusMatricula")
    ratio = a.safe_ratio_pct(a.count_if(status == "APROVADA"), a.count_if(status.isin(*CONCLUDED)))
    return c.Matricula.groupBy("TurmaID").agg(ratio.alias("Taxa"))


@query("decimal_avg", f"""
    SELECT EventTypeID, SourceSystem, {mean2('sum(DurationMs)', 'count(DurationMs)', 'DECIMAL(18,2)', 0)} AS Media
    FROM EventStream GROUP BY ALL""")
def _(c):
    return c.EventStream.groupBy("EventTypeID", "SourceSystem").agg(a.decimal_avg("DurationMs").alias("Media"))


@query("event_health", f"""
    SELECT t.EventCode, e.SourceSystem, count(*) AS Eventos,
        {mean2('sum(e.DurationMs)', 'count(e.DurationMs)', 'DECIMAL(18,2)', 0)} AS AvgDurationMs,
        max(e.OccurredAt) AS UltimoEvento,
        CAST(sum(CASE WHEN e.ProcessingStatus = 'E' THEN 1 ELSE 0 END) AS BIGINT) AS EventosComErro
    FROM EventStream e JOIN EventType t ON t.EventTypeID = e.EventTypeID GROUP BY t.EventCode, e.SourceSystem""")
def _(c):
    return a.event_health(c.EventStream, c.EventType)


@query("telemetry_daily", f"""
    SELECT CAST(OccurredAt AS DATE) AS DataRef, EventTypeID, AlunoID, SessionID, count(*) AS Eventos,
        {mean2('sum(DurationMs)', 'count(DurationMs)', 'DECIMAL(18,2)', 0)} AS DuracaoMediaMs,
        CAST(sum(coalesce(NumericValue, 0)) AS DECIMAL(18,4)) AS ValorNumericoSoma
    FROM EventStream WHERE CAST(OccurredAt AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-28' GROUP BY ALL""")
def _(c):
    keys = ["EventTypeID", "AlunoID", "SessionID"]
    return a.telemetry_daily(c.EventStream, keys, dt.date(2024, 1, 3), dt.date(2024, 1, 28))


MINUTE_SQL = """
    SELECT 'EVENT_COUNT' AS MetricName, date_trunc('minute', e.OccurredAt) AS MetricMinute, t.EventCode AS Dimension1,
        e.SourceSystem AS Dimension2, CAST(count(*) AS DECIMAL(18,4)) AS MetricValue
    FROM EventStream e JOIN EventType t ON t.EventTypeID = e.EventTypeID {where}
    GROUP BY ALL"""


@query("minute_counts", MINUTE_SQL.format(
    where="WHERE e.OccurredAt BETWEEN TIMESTAMP '2024-01-02 10:00:30' AND TIMESTAMP '2024-01-29 12:00:00'"))
def _(c):
    return a.minute_counts(c.EventStream, c.EventType, dt.datetime(2024, 1, 2, 10, 0, 30), dt.datetime(2024, 1, 29, 12))


@query("scalar_min_date", "SELECT CAST(min(DataMatricula) AS DATE) AS DataInicial FROM Matricula")
def _(c):
    return a.min_date(c.Matricula, "DataMatricula", dt.date(2001, 8, 2))


@query("seat_occupancy", """
    SELECT TurmaID, count(*) AS Ocupadas FROM Matricula WHERE StatusMatricula IN ('ATIVA','APROVADA','REPROVADA') GROUP BY TurmaID""")
def _(c):
    return a.seat_occupancy(c.Matricula)


# ---- windows ----------------------------------------------------------------
FULL = "OVER (PARTITION BY TurmaID ORDER BY NotaFinal DESC NULLS LAST, NomeAluno ASC NULLS FIRST, MatriculaID ASC NULLS FIRST)"
PLAIN = "OVER (PARTITION BY TurmaID ORDER BY NotaFinal DESC NULLS LAST)"
MEASURE_SQL = {
    r.ROW_NUMBER: f"row_number() {FULL}",
    r.RANK: f"rank() {PLAIN}",
    r.DENSE_RANK: f"dense_rank() {PLAIN}",
    r.NTILE: f"ntile(4) {FULL}",
    r.LAG: f"lag(NotaFinal) {FULL}",
    r.LEAD: f"lead(NotaFinal) {FULL}",
}
GRADED_SQL = """graded AS (
    SELECT t.TurmaID, t.CodigoTurma, m.MatriculaID, a.AlunoID, a.RA, p.NomeExibicao AS NomeAluno, m.NotaFinal,
        m.FrequenciaPercentual, m.StatusMatricula
    FROM Matricula m JOIN Turma t ON t.TurmaID = m.TurmaID JOIN Aluno a ON a.AlunoID = m.AlunoID
    JOIN Pessoa p ON p.PessoaID = a.PessoaID WHERE m.NotaFinal IS NOT NULL)"""
RANKING_SQL = f"""WITH {GRADED_SQL}
    SELECT *, {', '.join(f'{text} AS {name}' for name, text in MEASURE_SQL.items())} FROM graded"""


def ranking(c, want=r.ALL):
    return r.class_ranking(c.Matricula, c.Turma, c.Aluno, c.Pessoa, want)


@query("class_ranking", RANKING_SQL)
def _(c):
    return ranking(c)


def _register_measure(key: str, measure: str) -> None:
    @query(key, f"WITH {GRADED_SQL} SELECT TurmaID, MatriculaID, NotaFinal, {MEASURE_SQL[measure]} AS {measure} FROM graded")
    def _(c):
        return ranking(c, [measure]).select("TurmaID", "MatriculaID", "NotaFinal", measure)


for _key, _measure in {
    "rank_row_number": r.ROW_NUMBER, "rank_rank": r.RANK, "rank_dense_rank": r.DENSE_RANK,
    "rank_ntile4": r.NTILE, "rank_lag": r.LAG, "rank_lead": r.LEAD,
}.items():
    _register_measure(_key, _measure)


# ---- set operations ---------------------------------------------------------
@query("union_all", """
    SELECT AlunoID AS Chave, 'aluno' AS Tipo FROM Aluno UNION ALL SELECT ProfessorID, 'professor' FROM Professor
    UNION ALL SELECT DepartamentoID, 'departamento' FROM Departamento""")
def _(c):
    return sets.union_all(
        c.Aluno.select(F.col("AlunoID").alias("Chave"), F.lit("aluno").alias("Tipo")),
        c.Professor.select(F.col("ProfessorID").alias("Chave"), F.lit("professor").alias("Tipo")),
        c.Departamento.select(F.col("DepartamentoID").cast("long").alias("Chave"), F.lit("departamento").alias("Tipo")),
    )


@query("distinct_keys", "SELECT DISTINCT ParcelaID, GatewayStatus FROM Pagamento")
def _(c):
    return sets.distinct_keys(c.Pagamento, ["ParcelaID", "GatewayStatus"])


@query("date_series", """
    SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE)
        AS DataRef FROM orders""")
def _(c):
    bounds = c.raw("orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return sets.date_series_of(bounds, "a", "b")
