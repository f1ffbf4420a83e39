"""Bulk jobs, audit, integrity rules."""

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators import audit as au
from lectern.operators.integrity import NotNull, relation_violations, row_violations, validate, violations
from lectern.plans import bulk as b
from lectern.registry.core import json_sql, query
from lectern.operators.sets import union_all
from lectern.schema import constraints as k
from lectern.schema.model import TABLES
from lectern.session import stage
from lectern.sources.sales_model import VIEWS

NOW = dt.datetime(2001, 8, 2)
TODAY = NOW.date()


def verdicts(out: b.Outcome, key: str, accepted_key: str | None = None) -> DataFrame:
    """(key, code) of every request; accepted ones without code."""
    ok = out.accepted.select(F.col(accepted_key or key).alias(key), F.lit(None).cast("int").alias("Codigo"))
    return ok.unionByName(out.rejected.select(key, "Codigo"))


# ---- bulk jobs --------------------------------------------------------------
# Every pair of an order and a part in it is one request.
ENROL_REQUESTS = """
    SELECT DISTINCT concat(CAST(o_orderkey AS STRING), '-', CAST(l_partkey AS STRING)) AS RequestID, o_custkey AS AlunoID,
        l_partkey AS TurmaID, o_orderdate AS RequestedAt,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'FAX' ELSE 'PORTAL' END AS OrigemMatricula
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""


def sql_of(text: str) -> str:
    return text.replace("{", "").replace("}", "")


@query("bulk_enrol", f"""
    WITH req AS ({sql_of(ENROL_REQUESTS)}), there AS (SELECT * FROM Matricula WHERE StatusMatricula = 'REPROVADA'),
    taken AS (SELECT TurmaID, count(*) AS n FROM there GROUP BY TurmaID),
    seats AS (SELECT t.TurmaID, t.Vagas - coalesce(k.n, 0) AS free FROM Turma t LEFT JOIN taken k ON k.TurmaID = t.TurmaID
        WHERE NOT t.Encerrada),
    checked AS MATERIALIZED (SELECT r.*, CASE WHEN r.OrigemMatricula NOT IN ('PORTAL','SECRETARIA','API','BATCH') THEN 51000
            WHEN a.AlunoID IS NULL THEN 51001 WHEN s.TurmaID IS NULL THEN 51002
            WHEN e.MatriculaID IS NOT NULL THEN 51003 END AS code, s.free
        FROM req r LEFT JOIN Aluno a ON a.AlunoID = r.AlunoID AND a.StatusAcademico = 'ATIVO'
        LEFT JOIN seats s ON s.TurmaID = r.TurmaID
        LEFT JOIN there e ON e.AlunoID = r.AlunoID AND e.TurmaID = r.TurmaID),
    copies AS (SELECT *, row_number() OVER (PARTITION BY AlunoID, TurmaID ORDER BY RequestedAt, RequestID) AS copy
        FROM checked WHERE code IS NULL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY TurmaID, copy = 1 ORDER BY RequestedAt, RequestID) AS place FROM copies),
    seated AS (SELECT *, max(CASE WHEN copy = 1 THEN place END) OVER (PARTITION BY AlunoID, TurmaID) AS seat FROM placed)
    SELECT RequestID, CAST(code AS INTEGER) AS Codigo FROM checked WHERE code IS NOT NULL
    UNION ALL SELECT RequestID, CAST(CASE WHEN seat > free THEN 51004 WHEN copy > 1 THEN 51003 END AS INTEGER) FROM seated""")
def _(c):
    there = c.stored("Matricula", "AlunoID", "TurmaID", "StatusMatricula", where="StatusMatricula = 'REPROVADA'")
    out = b.bulk_enrol(stage(c.sql(ENROL_REQUESTS), "requests"), c.Aluno, c.Turma, there, NOW)
    return verdicts(out, "RequestID", "MatriculaID")


GRADE_REQUESTS = """
    SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_suppkey AS STRING)) AS RequestID,
        CASE WHEN l_linenumber = 7 THEN 'none' ELSE concat(CAST(o_custkey AS STRING), '-', CAST(l_partkey AS STRING))
        END AS MatriculaID,
        l_shipdate AS RequestedAt, CAST(l_quantity * 0.22 AS DECIMAL(5,2)) AS NotaFinal,
        CAST(l_discount * 1100 AS DECIMAL(5,2)) AS FrequenciaPercentual
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""
GRADE_CODED = f"""WITH req AS ({sql_of(GRADE_REQUESTS)}),
    coded AS (SELECT r.*, CAST(CASE WHEN r.NotaFinal < 0 OR r.NotaFinal > 10 THEN 51010
        WHEN r.FrequenciaPercentual < 0 OR r.FrequenciaPercentual > 100 THEN 51011 WHEN m.MatriculaID IS NULL THEN 51012
        WHEN m.StatusMatricula IN ('CANCELADA','TRANCADA') THEN 51013 END AS INTEGER) AS Codigo
        FROM req r LEFT JOIN Matricula m ON m.MatriculaID = r.MatriculaID)"""


def post_grades(c) -> b.GradeOutcome:
    enrolments = c.Matricula.withColumn("UltimaAtualizacao", F.col("DataMatricula"))
    return b.bulk_post_grade(c.sql(GRADE_REQUESTS), enrolments, NOW)


@query("bulk_post_grade", GRADE_CODED + """,
    last AS (SELECT *, row_number() OVER (PARTITION BY MatriculaID ORDER BY RequestedAt DESC NULLS LAST,
        RequestID DESC NULLS LAST, NotaFinal DESC NULLS LAST, FrequenciaPercentual DESC NULLS LAST) AS rn
        FROM coded WHERE Codigo IS NULL)
    SELECT m.MatriculaID, m.AlunoID, m.TurmaID, m.DataMatricula, m.OrigemMatricula,
        CASE WHEN l.MatriculaID IS NULL THEN m.StatusMatricula
            WHEN l.FrequenciaPercentual >= 75 AND l.NotaFinal >= 6 THEN 'APROVADA' ELSE 'REPROVADA' END AS StatusMatricula,
        CASE WHEN l.MatriculaID IS NULL THEN m.FrequenciaPercentual ELSE l.FrequenciaPercentual END AS FrequenciaPercentual,
        CASE WHEN l.MatriculaID IS NULL THEN m.NotaFinal ELSE l.NotaFinal END AS NotaFinal,
        CASE WHEN l.MatriculaID IS NULL THEN m.DataMatricula ELSE TIMESTAMP '2001-08-02 00:00:00' END AS UltimaAtualizacao
    FROM Matricula m LEFT JOIN last l ON l.MatriculaID = m.MatriculaID AND l.rn = 1""")
def _(c):
    return post_grades(c).updated


@query("bulk_post_grade_codes", GRADE_CODED + " SELECT RequestID, MatriculaID, Codigo FROM coded")
def _(c):
    out = post_grades(c)
    ok = out.accepted.withColumn("Codigo", F.lit(None).cast("int"))
    cols = ["RequestID", "MatriculaID", "Codigo"]
    return ok.select(*cols).unionByName(out.rejected.select(*cols))


PAY_REQUESTS = """
    SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS RequestID,
        CASE WHEN l_discount > 0.095 THEN -1 - l_orderkey ELSE l_orderkey END AS ParcelaID, l_shipdate AS DataPagamento,
        CAST(CASE WHEN l_quantity = 1 THEN 0 ELSE l_extendedprice END AS DECIMAL(12,2)) AS ValorPagamento,
        CASE l_linenumber WHEN 1 THEN 'PIX' WHEN 7 THEN 'CHEQUE' ELSE 'BOLETO' END AS MeioPagamento
    FROM {lineitem}"""
PAY_CODED = f"""WITH req AS ({sql_of(PAY_REQUESTS)}),
    coded AS (SELECT r.*, CAST(CASE WHEN r.ValorPagamento <= 0 THEN 51020
        WHEN r.MeioPagamento NOT IN ('PIX','CARTAO','BOLETO','TRANSFERENCIA','DINHEIRO') THEN 51021
        WHEN p.ParcelaID IS NULL THEN 51022 WHEN p.StatusParcela = 'CANCELADA' THEN 51023 END AS INTEGER) AS Codigo
        FROM req r LEFT JOIN ParcelaFinanceira p ON p.ParcelaID = r.ParcelaID)"""
PAID_SQL = """SELECT p.ParcelaID, p.AlunoID, p.PlanoFinanceiroID, p.Competencia, p.DataVencimento, p.ValorOriginal,
        p.ValorDesconto, p.ValorMulta, p.CanalGeracao, p.ValorLiquido,
        CASE WHEN s.ParcelaID IS NULL THEN p.ValorPago ELSE CAST(s.total AS DECIMAL(12,2)) END AS ValorPago,
        CASE WHEN s.ParcelaID IS NULL THEN p.DataPagamento ELSE CAST(s.last AS DATE) END AS DataPagamento,
        CASE WHEN s.ParcelaID IS NULL THEN p.StatusParcela WHEN s.total >= p.ValorLiquido THEN 'PAGA'
            WHEN p.DataVencimento < DATE '2001-08-02' THEN 'ATRASADA' ELSE 'ABERTA' END AS StatusParcela
    FROM ParcelaFinanceira p LEFT JOIN totals s ON s.ParcelaID = p.ParcelaID"""


@query("bulk_pay", PAY_CODED + """,
    new AS (SELECT ParcelaID, DataPagamento, ValorPagamento FROM coded WHERE Codigo IS NULL),
    totals AS (SELECT ParcelaID, sum(ValorPagamento) AS total, max(DataPagamento) AS last FROM (
        SELECT * FROM new UNION ALL SELECT ParcelaID, DataPagamento, ValorPagamento FROM Pagamento
        WHERE ParcelaID IN (SELECT ParcelaID FROM new)) GROUP BY ParcelaID) """ + PAID_SQL)
def _(c):
    return b.bulk_pay(c.sql(PAY_REQUESTS), c.ParcelaFinanceira, c.Pagamento, TODAY).updated


@query("bulk_pay_codes", PAY_CODED + " SELECT RequestID, Codigo FROM coded")
def _(c):
    return verdicts(b.bulk_pay(c.sql(PAY_REQUESTS), c.ParcelaFinanceira, c.Pagamento, TODAY), "RequestID")


SESSION_REQUESTS = """
    SELECT event_id AS SessionID, concat('c-', CAST(user_id AS STRING)) AS ClientID, user_id AS AlunoID,
        CASE event_type WHEN 'view' THEN 'WEB' WHEN 'click' THEN 'MOBILE' WHEN 'error' THEN 'KIOSK' ELSE 'API' END AS Platform
    FROM {events}"""


@query("bulk_start_session", f"""
    WITH req AS ({sql_of(SESSION_REQUESTS)})
    SELECT SessionID, CAST(CASE WHEN Platform = 'KIOSK' THEN 51040 END AS INTEGER) AS Codigo,
        CASE WHEN Platform <> 'KIOSK' THEN concat('start-', CAST(SessionID AS VARCHAR)) END AS EventKey,
        CASE WHEN Platform <> 'KIOSK' THEN concat('{{"clientId":"', ClientID, '","platform":"', Platform, '"}}') END AS PayloadJson
    FROM req""")
def _(c):
    out = b.bulk_start_session(c.sql(SESSION_REQUESTS), c.EventType, NOW)
    rows = verdicts(out, "SessionID")
    return rows.join(out.events.select("SessionID", "EventKey", "PayloadJson"), "SessionID", "left")


EVENT_REQUESTS = """
    SELECT event_id AS EventID, CASE event_type WHEN 'view' THEN 'PAGE_VIEW' WHEN 'click' THEN 'API_CALL'
            WHEN 'signup' THEN 'SESSION_START' WHEN 'error' THEN 'LOGIN_FAILED' ELSE 'UNHEARD_OF' END AS EventCode,
        'GATEWAY' AS SourceSystem, CASE WHEN value > 20 THEN ts END AS OccurredAt,
        CASE WHEN value > 60 THEN concat('[', props) WHEN value > 55 THEN concat(props, ' x')
            WHEN value > 50 THEN replace(props, '"', '''') WHEN value > 45 THEN concat('[', props, '] ]')
            WHEN value > 40 THEN concat(props, props) WHEN value > 10 THEN props END AS PayloadJson
    FROM {events}"""


@query("bulk_ingest_event", f"""
    WITH req AS ({sql_of(EVENT_REQUESTS)}),
    coded AS (SELECT r.*, t.EventTypeID, CASE WHEN t.EventTypeID IS NULL THEN 51041
        WHEN r.PayloadJson IS NOT NULL AND NOT {json_sql('r.PayloadJson')} THEN 51042 END AS code
        FROM req r LEFT JOIN EventType t ON t.EventCode = r.EventCode AND t.Ativo)
    SELECT EventID, CAST(code AS INTEGER) AS Codigo, CASE WHEN code IS NULL THEN EventTypeID END AS EventTypeID,
        CASE WHEN code IS NULL THEN coalesce(OccurredAt, TIMESTAMP '2001-08-02 00:00:00') END AS OccurredAt,
        CASE WHEN code IS NULL THEN 36 END AS Correlacao FROM coded""")
def _(c):
    out = b.bulk_ingest_event(c.sql(EVENT_REQUESTS), c.EventType, NOW)
    ok = out.accepted.select(
        "EventID", F.lit(None).cast("int").alias("Codigo"), "EventTypeID", "OccurredAt",
        F.length("CorrelationID").alias("Correlacao"),
    )
    return ok.unionByName(out.rejected.select("EventID", "Codigo"), allowMissingColumns=True)


@query("derived_events", """
    SELECT t.EventTypeID, CAST(NULL AS BIGINT) AS SessionID, p.AlunoID, 'FINANCE' AS SourceSystem,
        concat('parcela-', CAST(p.ParcelaID AS VARCHAR)) AS EventKey, CAST(p.ValorPago AS DECIMAL(18,4)) AS NumericValue,
        concat('{"parcelaId":', CAST(p.ParcelaID AS VARCHAR), ',"canal":"', p.CanalGeracao, '"}') AS PayloadJson
    FROM ParcelaFinanceira p JOIN EventType t ON t.EventCode = 'PAYMENT_SUCCESS' WHERE p.StatusParcela = 'PAGA'""")
def _(c):
    paid = c.ParcelaFinanceira.filter("StatusParcela = 'PAGA'")
    key = F.concat(F.lit("parcela-"), F.col("ParcelaID").cast("string"))
    return b.derived_events(
        paid, "PAYMENT_SUCCESS", c.EventType, "FINANCE", key,
        {"parcelaId": "ParcelaID", "canal": "CanalGeracao"}, numeric=F.col("ValorPago"),
    )


# ---- audit ------------------------------------------------------------------
AFTER = """
    SELECT MatriculaID, CASE WHEN StatusMatricula = 'ATIVA' AND FrequenciaPercentual < 80 THEN 'CANCELADA'
            ELSE StatusMatricula END AS StatusMatricula,
        FrequenciaPercentual, CASE WHEN NotaFinal < 2 THEN NULL ELSE NotaFinal END AS NotaFinal, TurmaID
    FROM {Matricula}"""
IMAGE = """concat('Status=', {r}.StatusMatricula, '; Freq=', CAST({r}.FrequenciaPercentual AS VARCHAR), '; Nota=',
    coalesce(CAST({r}.NotaFinal AS VARCHAR), 'NULL'), '; Turma=', CAST({r}.TurmaID AS VARCHAR))"""


@query("audit_update_diff", f"""
    WITH af AS ({sql_of(AFTER)})
    SELECT 'core' AS OrigemSchema, 'Matricula' AS OrigemObjeto, i.MatriculaID AS ChaveRegistro, 'UPDATE' AS Operacao,
        {IMAGE.format(r='d')} AS DadosAntes, {IMAGE.format(r='i')} AS DadosDepois
    FROM af i JOIN Matricula d ON d.MatriculaID = i.MatriculaID
    WHERE i.StatusMatricula IS DISTINCT FROM d.StatusMatricula OR i.NotaFinal IS DISTINCT FROM d.NotaFinal
        OR i.FrequenciaPercentual IS DISTINCT FROM d.FrequenciaPercentual OR i.TurmaID IS DISTINCT FROM d.TurmaID""")
def _(c):
    tracked = {"Status": "StatusMatricula", "Freq": "FrequenciaPercentual", "Nota": "NotaFinal", "Turma": "TurmaID"}
    return au.audit_update_diff(c.Matricula, c.sql(AFTER), "MatriculaID", tracked, "core", "Matricula")


@query("audit_upsert", """
    WITH old AS (SELECT NotaID, CAST(NotaObtida / 2 AS DECIMAL(5,2)) AS NotaObtida, AvaliacaoID FROM Nota
        WHERE LancadaEm < TIMESTAMP '1999-01-01 00:00:00')
    SELECT 'core' AS OrigemSchema, 'Nota' AS OrigemObjeto, i.NotaID AS ChaveRegistro,
        CASE WHEN d.NotaID IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS Operacao,
        CASE WHEN d.NotaID IS NOT NULL THEN concat('Nota=', CAST(d.NotaObtida AS VARCHAR), '; AvaliacaoID=',
            CAST(d.AvaliacaoID AS VARCHAR)) END AS DadosAntes,
        concat('Nota=', CAST(i.NotaObtida AS VARCHAR), '; AvaliacaoID=', CAST(i.AvaliacaoID AS VARCHAR)) AS DadosDepois
    FROM Nota i LEFT JOIN old d ON d.NotaID = i.NotaID""")
def _(c):
    before = c.Nota.filter(F.col("LancadaEm") < F.lit(dt.datetime(1999, 1, 1)).cast("timestamp_ntz")).withColumn(
        "NotaObtida", (F.col("NotaObtida") / 2).cast("decimal(5,2)")
    )
    return au.audit_upsert(before, c.Nota, "NotaID", {"Nota": "NotaObtida", "AvaliacaoID": "AvaliacaoID"}, "core", "Nota")


@query("audit_insert", """
    SELECT 'core' AS OrigemSchema, 'Pagamento' AS OrigemObjeto, PagamentoID AS ChaveRegistro, 'INSERT' AS Operacao,
        CAST(NULL AS VARCHAR) AS DadosAntes, concat('Parcela=', CAST(ParcelaID AS VARCHAR), '; Valor=',
        CAST(ValorPagamento AS VARCHAR), '; Meio=', MeioPagamento, '; Gateway=', GatewayStatus) AS DadosDepois
    FROM Pagamento""")
def _(c):
    image = {"Parcela": "ParcelaID", "Valor": "ValorPagamento", "Meio": "MeioPagamento", "Gateway": "GatewayStatus"}
    return au.audit_insert(c.Pagamento, "PagamentoID", image, "core", "Pagamento")


# ---- integrity rules --------------------------------------------------------
def rows_sql(table: str, key: str, cases: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, CAST({key} AS VARCHAR) AS key, '{kind}' AS reason FROM {table} WHERE {bad}"
        for rule, kind, bad in cases
    )


# Every declared rule runs over every model table that the campus maps.  Left out are rules of columns
# that the campus views do not have, and foreign keys into tables that it does not map.
MAPPED = [t for t in TABLES if t in VIEWS]


def _has(table: str, *columns: str) -> bool:
    return all(re.search(rf"\b{c}\b", VIEWS[table]) for c in columns)


def _columns(rule) -> list[str]:
    """Columns of a rule; an expression over a whole row names none."""
    return list(getattr(rule, "cols", [rule.col] if hasattr(rule, "col") else []))


def _every_row_rule(c, declared) -> DataFrame:
    """Violations of ``declared(table)`` rules over all mapped tables."""
    found = []
    for table in MAPPED:
        rules = [r for r in declared(table) if _has(table, *_columns(r))]
        if rules:
            found.append(row_violations(getattr(c, table), rules, TABLES[table].key))
    return union_all(*found)


def _every_relation(c, declared, kept=lambda rule: True) -> DataFrame:
    rules = {t: [r for r in declared(t) if kept(r) and _has(t, *_columns(r))] for t in MAPPED}
    return relation_violations(c.tables(*MAPPED), rules, {t: TABLES[t].key for t in MAPPED})


def _declared_sql(cases: list[tuple[str, str, str, str]]) -> str:
    """(table, rule, kind, SQL that holds for bad rows)."""
    return " UNION ALL ".join(rows_sql(table, TABLES[table].key, [(rule, kind, bad)]) for table, rule, kind, bad in cases)


DOMAIN_CASES = [
    (t, f"{t}.{col}.domain", "Domain", f"{col} NOT IN ({', '.join(map(repr, values))})")
    for t in MAPPED for col, values in k.DOMAINS.get(t, {}).items() if _has(t, col)
]
RANGE_CASES = [
    (t, f"{t}.{col}.range", "Range",
     f"{col} {'<=' if open_low else '<'} {low}" + (f" OR {col} > {high}" if high is not None else ""))
    for t in MAPPED for col, (low, high, open_low) in k.RANGES.get(t, {}).items() if _has(t, col)
]
CHECK_CASES = [(t, f"{t}.{n}.check", "Expr", f"NOT ({text})") for t in MAPPED for n, text in k.EXPRESSIONS.get(t, {}).items()]
UNIQUE_CASES = [
    (t, f"{t}.{'_'.join(cols)}.unique", "Unique",
     f"({', '.join(cols)}) IN (SELECT ({', '.join(cols)}) FROM {t} GROUP BY {', '.join(cols)} HAVING count(*) > 1)")
    for t in MAPPED for cols in k.UNIQUE.get(t, ()) if _has(t, *cols)
]
PARENT_CASES = [
    (t, f"{t}.{col}.parent", "ForeignKey", f"{col} NOT IN (SELECT {TABLES[parent].key} FROM {parent})")
    for t in MAPPED for col, parent in k.PARENTS.get(t, {}).items() if _has(t, col) and parent in MAPPED
]
REQUIRED_CASES = [
    (t, f"{t}.{col}.required", "NotNull", f"{col} IS NULL") for t in MAPPED for col in TABLES[t].required if _has(t, col)
]


@query("rule_domain", _declared_sql(DOMAIN_CASES))
def _(c):
    return _every_row_rule(c, k.domain_rules)


@query("rule_range", _declared_sql(RANGE_CASES))
def _(c):
    return _every_row_rule(c, k.range_rules)


@query("rule_cross_column", _declared_sql(CHECK_CASES))
def _(c):
    return _every_row_rule(c, k.expression_rules)


@query("rule_pattern", rows_sql("ParcelaFinanceira", "ParcelaID", [
    ("ParcelaFinanceira.Competencia.pattern", "Pattern",
     "NOT regexp_full_match(Competencia, '[12][0-9]{3}-(0[1-9]|1[0-2])')")]))
def _(c):
    rules = [r for r in k.rules_for("ParcelaFinanceira") if r.name.endswith(".pattern")]
    return row_violations(c.ParcelaFinanceira, rules, "ParcelaID")


@query("rule_json", rows_sql("EventStream", "EventID", [
    ("EventStream.PayloadJson.json", "Json", f"NOT {json_sql('PayloadJson')}")]))
def _(c):
    rules = [r for r in k.rules_for("EventStream") if r.name.endswith(".json")]
    return row_violations(c.EventStream, rules, "EventID")


@query("rule_unique", _declared_sql(UNIQUE_CASES))
def _(c):
    return _every_relation(c, k.unique_rules)


@query("rule_foreign_key", _declared_sql(PARENT_CASES))
def _(c):
    return _every_relation(c, k.parent_rules, lambda rule: rule.parent in MAPPED)


@query("rule_not_null", _declared_sql(REQUIRED_CASES) + " UNION ALL " + rows_sql("EventStream", "EventID", [
    ("EventStream.SessionID.required", "NotNull", "SessionID IS NULL"),
    ("EventStream.Ator.required", "NotNull", "AlunoID IS NULL OR DurationMs IS NULL")]))
def _(c):
    """The declared ones, which the campus meets, and two more that it does not."""
    more = [
        NotNull("EventStream.SessionID.required", ("SessionID",)),
        NotNull("EventStream.Ator.required", ("AlunoID", "DurationMs")),
    ]
    return _every_row_rule(c, lambda t: [*k.required_rules(t), *(more if t == "EventStream" else [])])


@query("rule_cross_table", """
    SELECT 'Nota.NotaMaxima.limit' AS rule, NotaID AS key, 'CrossTable' AS reason
    FROM Nota n JOIN Avaliacao a ON a.AvaliacaoID = n.AvaliacaoID WHERE n.NotaObtida > a.NotaMaxima""")
def _(c):
    return violations(c.Nota, [k.grade_limit()], "NotaID", c.tables("Avaliacao"))


@query("rules_good_rows", f"""
    SELECT EventID FROM EventStream WHERE coalesce({json_sql('PayloadJson')}, true) AND DurationMs >= 0
        AND ProcessingStatus IN ('N','P','E','D') AND AlunoID IS NOT NULL""")
def _(c):
    rules = [r for r in k.rules_for("EventStream") if r.name.split(".")[1] in ("PayloadJson", "DurationMs", "ProcessingStatus")]
    rules += [NotNull("EventStream.AlunoID.required", ("AlunoID", "DurationMs"))]
    rules += [r for r in k.parent_rules("EventStream") if r.col in ("EventTypeID", "AlunoID")]
    return validate(c.EventStream, rules, "EventID", c.tables("EventType", "Aluno"))[0].select("EventID")
