"""Projections, filters and scalar functions."""

import datetime as dt

from pyspark.sql import functions as F

from lectern.functions import scalar as s
from lectern.functions import status as st
from lectern.registry.core import json_sql, query

DUE = dt.date(2001, 8, 2)


# ---- projections, filters, predicates ---------------------------------------
@query("net_amount", """
    SELECT ParcelaID, CAST(ValorOriginal - ValorDesconto + ValorMulta AS DECIMAL(12,2)) AS ValorLiquido
    FROM ParcelaFinanceira""")
def _(c):
    return c.ParcelaFinanceira.select("ParcelaID", st.net_amount().alias("ValorLiquido"))


@query("grade_status", """
    SELECT MatriculaID, CASE WHEN FrequenciaPercentual >= 75 AND NotaFinal >= 6 THEN 'APROVADA' ELSE 'REPROVADA' END AS Situacao
    FROM Matricula""")
def _(c):
    return c.Matricula.select("MatriculaID", st.grade_status("NotaFinal", "FrequenciaPercentual").alias("Situacao"))


@query("grade_status_derived", """
    SELECT MatriculaID, CASE WHEN FrequenciaPercentual >= 75 AND NotaFinal >= 6 THEN 'APROVADA'
        WHEN FrequenciaPercentual < 75 OR NotaFinal < 6 THEN 'REPROVADA' ELSE StatusMatricula END AS Situacao
    FROM Matricula""")
def _(c):
    derived = st.grade_status_derived("NotaFinal", "FrequenciaPercentual", "StatusMatricula")
    return c.Matricula.select("MatriculaID", derived.alias("Situacao"))


@query("payment_status", """
    SELECT ParcelaID, CASE WHEN ValorPago >= ValorLiquido THEN 'PAGA' WHEN DataVencimento < DATE '2000-01-01' THEN 'ATRASADA'
        ELSE 'ABERTA' END AS Situacao
    FROM ParcelaFinanceira""")
def _(c):
    status = st.payment_status("ValorPago", "ValorLiquido", "DataVencimento", dt.date(2000, 1, 1))
    return c.ParcelaFinanceira.select("ParcelaID", status.alias("Situacao"))


@query("scholarship_band", """
    SELECT AlunoID, CASE WHEN PercentualBolsa = 0 THEN 'SEM_BOLSA' WHEN PercentualBolsa < 50 THEN 'PARCIAL'
        WHEN PercentualBolsa < 100 THEN 'ALTA' ELSE 'INTEGRAL' END AS FaixaBolsa
    FROM Aluno""")
def _(c):
    return c.Aluno.select("AlunoID", st.scholarship_band().alias("FaixaBolsa"))


@query("approved_flag", """
    SELECT MatriculaID, CASE StatusMatricula WHEN 'APROVADA' THEN true WHEN 'REPROVADA' THEN false END AS Aprovado
    FROM Matricula""")
def _(c):
    return c.Matricula.select("MatriculaID", st.approved_flag().alias("Aprovado"))


@query("open_balance", """
    SELECT ParcelaID, CAST(ValorLiquido - coalesce(ValorPago, 0) AS DECIMAL(12,2)) AS SaldoAberto FROM ParcelaFinanceira""")
def _(c):
    return c.ParcelaFinanceira.select("ParcelaID", st.open_balance().alias("SaldoAberto"))


@query("days_overdue", """
    SELECT ParcelaID, CAST(CASE WHEN StatusParcela IN ('ABERTA','ATRASADA','NEGOCIADA') AND DataVencimento < DATE '2001-08-02'
        THEN date_diff('day', DataVencimento, DATE '2001-08-02') ELSE 0 END AS INTEGER) AS AtrasoDias
    FROM ParcelaFinanceira""")
def _(c):
    late = st.days_overdue("StatusParcela", "DataVencimento", DUE)
    return c.ParcelaFinanceira.select("ParcelaID", late.alias("AtrasoDias"))


@query("date_window_filter", """
    SELECT event_id AS EventID, ts AS OccurredAt FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def _(c):
    rows = st.in_window(c.EventStream, "OccurredAt", dt.date(2024, 1, 5), dt.date(2024, 1, 20))
    return rows.select("EventID", "OccurredAt")


@query("trailing_window_filter", """
    SELECT event_id AS EventID, ts AS OccurredAt FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'""")
def _(c):
    return st.trailing(c.EventStream, "OccurredAt", 15, dt.date(2024, 1, 31)).select("EventID", "OccurredAt")


@query("pending_predicate", """
    SELECT ParcelaID, StatusParcela FROM ParcelaFinanceira WHERE StatusParcela IN ('ABERTA','ATRASADA','NEGOCIADA')""")
def _(c):
    return c.ParcelaFinanceira.filter(st.is_pending()).select("ParcelaID", "StatusParcela")


# ---- scalar functions -------------------------------------------------------
@query("fn_date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS TempoKey FROM orders")
def _(c):
    return c.raw("orders").select("o_orderkey", s.date_key("o_orderdate").alias("TempoKey"))


@query("fn_date_parts", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS Ano, CAST(month(o_orderdate) AS INTEGER) AS Mes,
        CAST(day(o_orderdate) AS INTEGER) AS Dia, CAST(quarter(o_orderdate) AS INTEGER) AS Trimestre
    FROM orders""")
def _(c):
    parts = [v.alias(n) for n, v in s.date_parts("o_orderdate").items()]
    return c.raw("orders").select("o_orderkey", *parts)


# %U counts weeks from the first Sunday; the model's week 1 holds 1 January.
WEEK_SQL = """CAST(CAST(strftime({d}, '%U') AS INTEGER)
    + CASE WHEN dayofweek(date_trunc('year', {d})) = 0 THEN 0 ELSE 1 END AS INTEGER)"""


@query("fn_week_us", f"SELECT o_orderkey, {WEEK_SQL.format(d='o_orderdate')} AS SemanaAno FROM orders")
def _(c):
    return c.raw("orders").select("o_orderkey", s.week_us("o_orderdate").alias("SemanaAno"))


@query("fn_weekday", """
    SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS DiaSemana,
        dayofweek(o_orderdate) IN (0, 6) AS IsFimSemana
    FROM orders""")
def _(c):
    return c.raw("orders").select(
        "o_orderkey", s.weekday("o_orderdate").alias("DiaSemana"), s.is_weekend("o_orderdate").alias("IsFimSemana")
    )


@query("fn_day_month_names", """
    SELECT o_orderkey, dayname(o_orderdate) AS NomeDia, monthname(o_orderdate) AS NomeMes FROM orders""")
def _(c):
    return c.raw("orders").select(
        "o_orderkey", s.day_name("o_orderdate").alias("NomeDia"), s.month_name("o_orderdate").alias("NomeMes")
    )


@query("fn_truncate_minute", "SELECT event_id, date_trunc('minute', ts) AS Minuto FROM events")
def _(c):
    return c.raw("events").select("event_id", s.minute_floor("ts").alias("Minuto"))


@query("fn_date_add_diff", """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS Prazo,
        CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS INTEGER) AS Dias,
        o_orderdate + INTERVAL 90 MINUTE AS Limite
    FROM orders""")
def _(c):
    return c.raw("orders").select(
        "o_orderkey",
        s.add_days("o_orderdate", 30).alias("Prazo"),
        s.days_between("o_orderdate", F.lit(DUE)).alias("Dias"),
        s.add_minutes("o_orderdate", 90).alias("Limite"),
    )


@query("fn_to_date", "SELECT event_id, CAST(ts AS DATE) AS Dia FROM events")
def _(c):
    return c.raw("events").select("event_id", s.to_day("ts").alias("Dia"))


@query("fn_concat_null_empty", """
    SELECT EventID, concat('e-', CAST(EventID AS VARCHAR), '/', coalesce(CAST(AlunoID AS VARCHAR), ''), '/',
        coalesce(CAST(DurationMs AS VARCHAR), '')) AS Texto
    FROM EventStream""")
def _(c):
    text = s.concat0(F.lit("e-"), "EventID", F.lit("/"), "AlunoID", F.lit("/"), "DurationMs")
    return c.EventStream.select("EventID", text.alias("Texto"))


@query("fn_isnull_nullif", """
    SELECT EventID, coalesce(NumericValue, 0) AS Valor, nullif(SourceSystem, 'API') AS Origem FROM EventStream""")
def _(c):
    value = s.isnull("NumericValue", 0).cast("decimal(18,4)")
    return c.EventStream.select("EventID", value.alias("Valor"), s.nullif("SourceSystem", "API").alias("Origem"))


@query("fn_round_half_up", """
    SELECT EventID, CAST((CAST(floor(NumericValue * 100) AS BIGINT) * 10 + 50) // 100 AS DECIMAL(18,1)) AS Arredondado
    FROM EventStream""")
def _(c):
    return c.EventStream.select(
        "EventID", s.round_dec(F.col("NumericValue") * 10, 18, 0).cast("decimal(18,1)").alias("Arredondado")
    )


@query("fn_sha256", "SELECT c_custkey, upper(sha256(c_name)) AS DocumentoHash FROM customer")
def _(c):
    return c.raw("customer").select("c_custkey", F.hex(s.doc_hash("c_name")).alias("DocumentoHash"))


@query("fn_uuid", """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS Dado, true AS Preenchido FROM events""")
def _(c):
    given = F.when(F.col("event_type") != "error", F.col("event_type"))
    filled = c.raw("events").withColumns({"given": given, "id": s.default_uuid(given)})
    fresh = F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    kept = F.col("given").isNotNull() & (F.col("id") == F.col("given"))
    return filled.select("event_id", F.col("given").alias("Dado"), (kept | fresh).alias("Preenchido"))


@query("fn_is_json", f"SELECT EventID, {json_sql('PayloadJson')} AS Valido FROM EventStream")
def _(c):
    return c.EventStream.select("EventID", s.is_json("PayloadJson").alias("Valido"))


@query("fn_json_build", """
    SELECT EventID, CAST(json_object('id', EventID, 'source', SourceSystem) AS VARCHAR) AS Payload FROM EventStream""")
def _(c):
    return c.EventStream.select("EventID", s.json_obj({"id": "EventID", "source": "SourceSystem"}).alias("Payload"))


@query("fn_competence_pattern", """
    SELECT ParcelaID, regexp_full_match(Competencia, '[12][0-9]{3}-(0[1-9]|1[0-2])') AS Valida FROM ParcelaFinanceira""")
def _(c):
    return c.ParcelaFinanceira.select("ParcelaID", s.is_competence("Competencia").alias("Valida"))


# ---- user-defined functions -------------------------------------------------
@query("udf_strict_json", f"""
    SELECT EventID, {json_sql('PayloadJson')} AS Estrito, false AS ComSobra, false AS Escalar FROM EventStream""")
def _(c):
    return c.EventStream.select(
        "EventID",
        s.is_json("PayloadJson").alias("Estrito"),
        s.is_json(F.concat("PayloadJson", F.lit(" x"))).alias("ComSobra"),
        s.is_json(F.col("EventID").cast("string")).alias("Escalar"),
    )
