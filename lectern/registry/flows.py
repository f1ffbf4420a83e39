"""Sources, sinks and streaming jobs, each writing to the shared folder and read back."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.aggregates import payments_rollup
from lectern.plans.bulk import apply_payments
from lectern.registry.changes import EVENT_REQUESTS, PAID_SQL, sql_of
from lectern.registry.core import half_up, json_sql, query, units
from lectern.registry.grouped import MINUTE_SQL
from lectern.operators.sets import union_all
from lectern.session import stage, work_path
from lectern.sources import scan, sinks
from lectern.sources.sales_model import RAW_SCHEMAS, SalesCampus
from lectern.streaming import jobs

NOW = dt.datetime(2024, 1, 31)
TODAY = dt.date(2001, 8, 2)


# ---- sources and sinks ------------------------------------------------------
@query("io_scan", """
    SELECT ParcelaID, Competencia, DataVencimento, CAST(ValorOriginal AS DECIMAL(10,2)) AS ValorOriginal, StatusParcela,
        CAST(NULL AS VARCHAR) AS Observacao FROM ParcelaFinanceira""")
def _(c):
    folder = work_path(c.spark, "model")
    stored = {f.name: f.dataType for f in scan.TABLES["ParcelaFinanceira"].struct.fields}
    rows = c.ParcelaFinanceira.drop("ValorLiquido")
    rows.select(*[F.col(n).cast(stored[n]).alias(n) for n in rows.columns]).write.parquet(f"{folder}/ParcelaFinanceira")
    table = scan.load(c.spark, folder, "ParcelaFinanceira")
    return table.select("ParcelaID", "Competencia", "DataVencimento", "ValorOriginal", "StatusParcela", "Observacao")


@query("io_ingest_defaults", """
    SELECT EventID, coalesce(CASE WHEN ProcessingStatus = 'E' THEN 'E' END, 'N') AS ProcessingStatus,
        CASE WHEN ProcessingStatus = 'E' THEN OccurredAt ELSE TIMESTAMP '2024-01-31 00:00:00' END AS OccurredAt,
        TIMESTAMP '2024-01-31 00:00:00' AS IngestedAt, 36 AS Tamanho
    FROM EventStream""")
def _(c):
    failed = F.col("ProcessingStatus") == "E"
    partial = c.EventStream.withColumns(
        {"OccurredAt": F.when(failed, F.col("OccurredAt")), "ProcessingStatus": F.when(failed, F.lit("E"))}
    )
    full = scan.with_defaults(partial, "EventStream", NOW)
    return full.select(
        "EventID", "ProcessingStatus", "OccurredAt", "IngestedAt", F.length("CorrelationID").alias("Tamanho")
    )


@query("io_append", """
    SELECT GatewayStatus, count(*) AS Pagamentos, CAST(sum(ValorPagamento) AS DECIMAL(22,2)) AS Total
    FROM Pagamento GROUP BY GatewayStatus""")
def _(c):
    path = work_path(c.spark, "append")
    confirmed = F.col("GatewayStatus") == "CONFIRMED"
    sinks.append(c.Pagamento.filter(confirmed), path)
    sinks.append(c.Pagamento.filter(~confirmed), path)
    return c.spark.read.parquet(path).groupBy("GatewayStatus").agg(
        F.count("*").alias("Pagamentos"), F.sum("ValorPagamento").alias("Total")
    )


@query("io_replace_window", """
    SELECT CAST(OccurredAt AS DATE) AS DataRef, SourceSystem, count(*) AS Eventos,
        CAST(sum(NumericValue) AS DECIMAL(28,4)) AS Valor FROM EventStream GROUP BY ALL""")
def _(c):
    """The stored window holds doubled values; replacing it restores the truth, also within a day."""
    path = work_path(c.spark, "window")
    t0, t1 = dt.datetime(2024, 1, 10, 6, 30), dt.datetime(2024, 1, 12, 18, 0)
    day = F.to_date("OccurredAt")
    rows = c.EventStream.select("EventID", "OccurredAt", "SourceSystem", "NumericValue").withColumn("DataRef", day)
    inside = F.col("OccurredAt").between(F.lit(t0).cast("timestamp_ntz"), F.lit(t1).cast("timestamp_ntz"))
    wrong = F.when(inside, F.col("NumericValue") * 2).otherwise(F.col("NumericValue")).cast("decimal(18,4)")
    sinks.append(rows.withColumn("NumericValue", wrong), path, ["DataRef"])
    sinks.replace_window(rows.filter(inside), path, "DataRef", "OccurredAt", t0, t1)
    return sinks.stored(c.spark, path).groupBy("DataRef", "SourceSystem").agg(
        F.count("*").alias("Eventos"), F.sum("NumericValue").alias("Valor")
    )


@query("io_full_reload", """
    SELECT 'Curso' AS "table", CAST(CursoID AS BIGINT) AS id, Nome AS text FROM Curso UNION ALL SELECT 'Turma', TurmaID, CodigoTurma FROM Turma
    UNION ALL SELECT 'ParcelaFinanceira', ParcelaID, StatusParcela FROM ParcelaFinanceira""")
def _(c):
    """A first load with other rows, replaced by a second one; a third is written but never published."""
    out = work_path(c.spark, "reload")
    columns = {"Curso": ("CursoID", "Nome"), "Turma": ("TurmaID", "CodigoTurma"), "ParcelaFinanceira": ("ParcelaID", "StatusParcela")}
    tables = c.tables(*columns)
    sinks.full_reload({n: df.filter(F.col(columns[n][0]) % 2 == 0) for n, df in tables.items()}, out, "0001")
    sinks.full_reload(tables, out, "0002", {"ParcelaFinanceira": "StatusParcela"})
    sinks.counted_write(tables["Curso"].limit(1), f"{out}/Curso/run=0003")
    return union_all(*[
        sinks.current(c.spark, out, n).select(F.lit(n).alias("table"), F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
        for n, (key, text) in columns.items()
    ])


@query("io_merge_add", """
    SELECT CAST(OccurredAt AS DATE) AS DataRef, Dim, CAST(count(*) AS DECIMAL(18,4)) AS MetricValue
    FROM (SELECT OccurredAt, nullif(SourceSystem, 'BATCH') AS Dim FROM EventStream) GROUP BY ALL""")
def _(c):
    dim = F.nullif(F.col("SourceSystem"), F.lit("BATCH")).alias("Dim")
    counts = lambda df: df.groupBy(F.to_date("OccurredAt").alias("DataRef"), dim).agg(
        F.count("*").cast("decimal(18,4)").alias("MetricValue")
    )
    failed = F.col("ProcessingStatus") == "E"
    target, delta = counts(c.EventStream.filter(failed)), counts(c.EventStream.filter(~failed))
    return sinks.merge_add(target, delta, ["DataRef", "Dim"], "MetricValue", ["Dim"])


@query("io_update_from", f"""
    WITH totals AS (SELECT ParcelaID, sum(ValorPagamento) AS total, max(DataPagamento) AS last FROM Pagamento
        WHERE GatewayStatus = 'CONFIRMED' GROUP BY ParcelaID) {PAID_SQL}""")
def _(c):
    totals = payments_rollup(c.Pagamento, gateway_status=["CONFIRMED"])
    return apply_payments(c.ParcelaFinanceira, totals, TODAY)


# ---- streaming --------------------------------------------------------------
class StreamCampus(SalesCampus):
    """The same views over file streams: the named source tables are read as they arrive."""

    def __init__(self, campus: SalesCampus, *streamed: str):
        super().__init__(campus.spark, campus.folder)
        self.streamed = streamed

    def raw(self, name: str) -> DataFrame:
        if name not in self.streamed:
            return super().raw(name)
        reader = self.spark.readStream.schema(RAW_SCHEMAS[name]).option("pathGlobFilter", f"{name}.parquet")
        return reader.parquet(self.folder)


def _paths(c, name: str) -> tuple[str, str]:
    base = work_path(c.spark, name)
    return f"{base}/out", f"{base}/checkpoint"


@query("stream_minute_counts", MINUTE_SQL.format(where=""))
def _(c):
    out, ckpt = _paths(c, "minute-counts")
    jobs.stream_minute_counts(StreamCampus(c, "events").EventStream, c.EventType, out, ckpt).awaitTermination()
    return jobs.read_minute_metric(c.spark, out)


@query("stream_minute_windowed", f"""
    WITH closed AS (SELECT max(ts) - INTERVAL 10 MINUTE AS t FROM events)
    SELECT m.* FROM ({MINUTE_SQL.format(where='')}) m WHERE m.MetricMinute + INTERVAL 1 MINUTE <= (SELECT t FROM closed)""")
def _(c):
    out, ckpt = _paths(c, "minute-windows")
    stream = StreamCampus(c, "events").EventStream
    jobs.stream_minute_windowed(stream, c.EventType, "10 minutes", out, ckpt).awaitTermination()
    return c.spark.read.parquet(out)


@query("stream_payment_rollup", f"""
    WITH totals AS (SELECT ParcelaID, sum(ValorPagamento) AS total, max(DataPagamento) AS last FROM Pagamento
        GROUP BY ParcelaID HAVING bool_or(GatewayStatus = 'CONFIRMED')) {PAID_SQL}""")
def _(c):
    """Pending payments are the history, confirmed ones arrive; instalments without arrivals keep their row."""
    out, ckpt = _paths(c, "payments")
    arriving = StreamCampus(c, "lineitem").Pagamento.filter("GatewayStatus = 'CONFIRMED'")
    history = c.Pagamento.filter("GatewayStatus <> 'CONFIRMED'")
    jobs.stream_payment_rollup(arriving, history, c.ParcelaFinanceira, TODAY, out, ckpt).awaitTermination()
    return jobs.read_instalments(c.spark, c.ParcelaFinanceira, out)


STREAMED_GRADES = """
    SELECT concat(CAST(o_custkey AS STRING), '-', CAST(l_partkey AS STRING)) AS MatriculaID,
        l_partkey * 10 + l_linenumber AS AvaliacaoID, CAST(l_quantity * 0.2 AS DECIMAL(5,2)) AS NotaObtida,
        l_shipdate AS LancadaEm
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""


GRADE_DAYS = ("1997-01-01", "1999-01-01", "2000-06-01")  # history before the first, then one batch up to each and one after


@query("stream_grade_derive", f"""
    WITH g AS (SELECT *, {' + '.join(f"CAST(LancadaEm >= TIMESTAMP '{d}' AS INTEGER)" for d in GRADE_DAYS)} AS batch
        FROM ({sql_of(STREAMED_GRADES)})),
    bad AS (SELECT DISTINCT g.batch, g.MatriculaID, g.AvaliacaoID FROM g JOIN Avaliacao a ON a.AvaliacaoID = g.AvaliacaoID
        WHERE g.NotaObtida > a.NotaMaxima AND g.batch > 0),
    good AS (SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM bad b
        WHERE b.batch = g.batch AND b.MatriculaID = g.MatriculaID AND b.AvaliacaoID = g.AvaliacaoID)),
    newest AS (SELECT *, row_number() OVER (PARTITION BY MatriculaID, AvaliacaoID
        ORDER BY LancadaEm DESC NULLS LAST, NotaObtida DESC NULLS LAST) AS rn FROM good),
    f AS (SELECT MatriculaID, {units(half_up('num', 'den', 0), 2, 'DECIMAL(5,2)')} AS final FROM (
        SELECT n.MatriculaID, CAST(sum(CAST(n.NotaObtida * 100 AS BIGINT) * CAST(a.Peso AS BIGINT)) AS BIGINT) AS num,
            CAST(sum(CAST(a.Peso AS BIGINT)) AS BIGINT) AS den
        FROM newest n JOIN Avaliacao a ON a.AvaliacaoID = n.AvaliacaoID WHERE n.rn = 1 GROUP BY n.MatriculaID
        HAVING n.MatriculaID IN (SELECT MatriculaID FROM good WHERE batch > 0)))
    SELECT m.MatriculaID, CASE WHEN f.MatriculaID IS NULL OR m.StatusMatricula IN ('CANCELADA','TRANCADA') THEN m.NotaFinal
            ELSE f.final END AS NotaFinal,
        CASE WHEN f.MatriculaID IS NULL OR m.StatusMatricula IN ('CANCELADA','TRANCADA') THEN m.StatusMatricula
            WHEN m.FrequenciaPercentual >= 75 AND f.final >= 6 THEN 'APROVADA'
            WHEN m.FrequenciaPercentual < 75 OR f.final < 6 THEN 'REPROVADA' ELSE m.StatusMatricula END AS StatusMatricula
    FROM Matricula m LEFT JOIN f ON f.MatriculaID = m.MatriculaID""")
def _(c):
    """Old grades are the history, the others arrive in three batches by their time."""
    out, ckpt = _paths(c, "grades")
    grades, day = stage(c.sql(STREAMED_GRADES), "grades"), F.col("LancadaEm")
    arrivals = f"{out}-arrivals"
    for low, high in zip(GRADE_DAYS, (*GRADE_DAYS[1:], "9999-01-01")):
        part = grades.filter((day >= F.lit(low).cast("timestamp_ntz")) & (day < F.lit(high).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("append").parquet(arrivals)
    history = grades.filter(day < F.lit(GRADE_DAYS[0]).cast("timestamp_ntz"))
    arriving = c.spark.readStream.schema(grades.schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
    # Derived from the order lines once: every batch reads the assessments, and the enrolments are read three times.
    assessments = c.stored("Avaliacao", "AvaliacaoID", "NotaMaxima", "Peso")
    enrolments = c.stored("Matricula", "MatriculaID", "FrequenciaPercentual", "NotaFinal", "StatusMatricula")
    jobs.stream_grade_derive(arriving, history, assessments, enrolments, out, ckpt).awaitTermination()
    return jobs.read_enrolments(c.spark, enrolments, out).select("MatriculaID", "NotaFinal", "StatusMatricula")


@query("stream_event_ingest", f"""
    WITH req AS ({sql_of(EVENT_REQUESTS)}),
    coded AS (SELECT r.*, t.EventTypeID, CASE WHEN t.EventTypeID IS NULL THEN 51041
        WHEN r.PayloadJson IS NOT NULL AND NOT {json_sql('r.PayloadJson')} THEN 51042 END AS code
        FROM req r LEFT JOIN EventType t ON t.EventCode = r.EventCode AND t.Ativo)
    SELECT EventID, EventCode, CAST(code AS INTEGER) AS Codigo,
        coalesce(OccurredAt, TIMESTAMP '2024-01-31 00:00:00') AS OccurredAt,
        CASE WHEN code IS NULL THEN 'good' ELSE 'bad' END AS Rota FROM coded""")
def _(c):
    out, ckpt = _paths(c, "events")
    arriving = StreamCampus(c, "events").sql(EVENT_REQUESTS)
    jobs.stream_event_ingest(arriving, c.EventType, NOW, out, ckpt).awaitTermination()
    routes = [
        jobs.read_events(c.spark, out, r).select("EventID", "EventCode", "Codigo", "OccurredAt", F.lit(r).alias("Rota"))
        for r in ("good", "bad")
    ]
    return routes[0].unionByName(routes[1])
