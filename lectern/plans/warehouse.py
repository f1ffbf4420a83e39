"""Star schema: dimensions, facts, daily KPIs and the rebuild job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.scalar import (
    date_key, date_parts, day_name, is_weekend, month_name, week_us, weekday,
)
from lectern.functions.status import (
    CONCLUDED, approved_flag, days_overdue, in_window, open_balance, scholarship_band, with_net_amount,
)
from lectern.operators.aggregates import count_if, min_date, minute_counts, safe_ratio_pct
from lectern.operators.joins import chain, latest_per_key, missing, shuffled, with_key
from lectern.operators.sets import date_series, union_all
from lectern.operators.skew import surrogate_key
from lectern.schema.model import TABLES
from lectern.sources.scan import with_defaults
from lectern.sources import manifest
from lectern.sources.sinks import current, observed_write, publish, replace_window

Tables = dict[str, DataFrame]

# Name, unit and target of each KPI.
ACTIVE_STUDENTS = ("ALUNOS_ATIVOS", "QTD", 100)
APPROVAL_RATE = ("TAXA_APROVACAO", "PCT", 85)
OVERDUE_VALUE = ("INADIMPLENCIA_VALOR", "BRL", 0)
EVENTS_TOTAL = ("EVENTOS_TOTAL", "QTD", 0)


# ---- dimensions -------------------------------------------------------------
def describe_days(days: DataFrame, col: str = "DataRef") -> DataFrame:
    return days.select(
        date_key(col).alias("TempoKey"),
        F.col(col).alias("DataCompleta"),
        *[c.alias(name) for name, c in date_parts(col).items()],
        week_us(col).alias("SemanaAno"),
        weekday(col).alias("DiaSemana"),
        day_name(col).alias("NomeDia"),
        month_name(col).alias("NomeMes"),
        is_weekend(col).alias("IsFimSemana"),
    )


def dim_date(spark: SparkSession, existing: DataFrame | None, d0: dt.date, d1: dt.date) -> DataFrame:
    """Days of the range that the dimension does not hold yet."""
    days = describe_days(date_series(spark, d0, d1))
    return days if existing is None else missing(days, existing.select("DataCompleta"), "DataCompleta")


def _current(df: DataFrame, as_of: dt.date) -> DataFrame:
    return df.withColumns(
        {
            "IsCurrent": F.lit(True),
            "EffectiveStartDate": F.lit(as_of),
            "EffectiveEndDate": F.lit(None).cast("date"),
        }
    )


def _keyed(rows: DataFrame, natural: str, key: str, as_of: dt.date, existing: DataFrame | None) -> DataFrame:
    """Rows with their surrogate key; of known ones the first start date stays, vanished ones end on ``as_of``.

    Vanished rows keep their place and key, so facts of other days still find them.
    """
    if existing is None:
        return surrogate_key(rows, natural, key)
    dated = "EffectiveStartDate" in rows.columns
    keyed = surrogate_key(rows, natural, key, existing)
    gone = missing(existing.select(*keyed.columns), shuffled(rows.select(natural)), natural)
    if dated:
        known = existing.select(natural, F.col("EffectiveStartDate").alias("_since"))
        keyed = keyed.join(shuffled(known), natural, "left").withColumn(
            "EffectiveStartDate", F.coalesce("_since", "EffectiveStartDate")
        ).drop("_since")
        gone = gone.withColumns({
            "IsCurrent": F.lit(False), "EffectiveEndDate": F.coalesce("EffectiveEndDate", F.lit(as_of)),
        })
    return keyed.unionByName(gone)


def dim_course(courses: DataFrame, departments: DataFrame, as_of: dt.date, existing: DataFrame | None = None) -> DataFrame:
    rows = courses.join(departments.select("DepartamentoID", "Sigla"), "DepartamentoID").select(
        "CursoID", F.col("Codigo").alias("CodigoCurso"), F.col("Nome").alias("NomeCurso"),
        F.col("Sigla").alias("DepartamentoSigla"), "Nivel", "Modalidade",
    )
    return _keyed(_current(rows, as_of), "CursoID", "CursoKey", as_of, existing)


def dim_student(students: DataFrame, as_of: dt.date, existing: DataFrame | None = None) -> DataFrame:
    rows = students.select(
        "AlunoID", "RA", "StatusAcademico", "Bolsista", scholarship_band().alias("FaixaBolsa")
    )
    return _keyed(_current(rows, as_of), "AlunoID", "AlunoKey", as_of, existing)


def dim_class(
    classes: DataFrame, subjects: DataFrame, teachers: DataFrame, people: DataFrame, existing: DataFrame | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    rows = chain(
        classes.select("TurmaID", "CodigoTurma", "Ano", "Periodo", "Turno", "Encerrada", "DisciplinaID", "ProfessorID"),
        [
            (
                shuffled(subjects).select(
                    "DisciplinaID", "CursoID", F.col("Codigo").alias("DisciplinaCodigo"),
                    F.col("Nome").alias("DisciplinaNome"),
                ),
                "DisciplinaID",
            ),
            (teachers.select("ProfessorID", "PessoaID"), "ProfessorID"),
            (shuffled(people).select("PessoaID", F.col("NomeExibicao").alias("ProfessorNome")), "PessoaID"),
        ],
    ).select(
        "TurmaID", "CodigoTurma", "Ano", "Periodo", "Turno", "DisciplinaCodigo", "DisciplinaNome",
        "CursoID", "ProfessorID", "ProfessorNome", "Encerrada",
    )
    return _keyed(rows, "TurmaID", "TurmaKey", as_of, existing)


# ---- facts ------------------------------------------------------------------
def class_courses(classes: DataFrame, subjects: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Class to course, with wanted subject columns."""
    return classes.select("TurmaID", "DisciplinaID").join(
        subjects.select("DisciplinaID", "CursoID", *extra), "DisciplinaID"
    ).drop("DisciplinaID")


def fact_academic(
    enrolments: DataFrame, classes: DataFrame, subjects: DataFrame, dims: Tables, d0: dt.date, d1: dt.date
) -> DataFrame:
    """Enrolments of the window with the four dimension keys."""
    rows = in_window(enrolments, "DataMatricula", d0, d1).select(
        "MatriculaID", "AlunoID", "TurmaID", "DataMatricula", "StatusMatricula", "FrequenciaPercentual", "NotaFinal"
    )
    # The small tables meet each other before the fact: one lookup per enrolment.
    courses = class_courses(classes, shuffled(subjects), ["CargaHoraria", "Creditos"])
    lookup = with_key(courses, dims["DimCurso"], "CursoID", "CursoKey")
    lookup = with_key(lookup, shuffled(dims["DimTurma"]), "TurmaID", "TurmaKey").drop("CursoID")
    keyed = with_key(rows.join(shuffled(lookup), "TurmaID"), shuffled(dims["DimAluno"]), "AlunoID", "AlunoKey")
    return keyed.select(
        date_key(F.to_date("DataMatricula")).alias("TempoKey"),
        "AlunoKey", "CursoKey", "TurmaKey", "MatriculaID", "StatusMatricula", "FrequenciaPercentual", "NotaFinal",
        approved_flag().alias("Aprovado"), "CargaHoraria", "Creditos",
    )


def fact_finance(
    instalments: DataFrame, enrolments: DataFrame, classes: DataFrame, subjects: DataFrame, dims: Tables,
    d0: dt.date, d1: dt.date, as_of: dt.date,
) -> DataFrame:
    """Instalments due in the window, with the course of the student's latest enrolment."""
    due = in_window(instalments, "DataVencimento", d0, d1)
    if "ValorLiquido" not in due.columns:
        due = with_net_amount(due)
    latest = latest_per_key(
        shuffled(dims["DimAluno"]).filter("IsCurrent").select("AlunoID", "AlunoKey"),
        enrolments.select("AlunoID", "DataMatricula", "MatriculaID", "TurmaID"),
        "AlunoID", ["DataMatricula", "MatriculaID"], ["TurmaID"],
    )
    courses = with_key(class_courses(classes, shuffled(subjects)), dims["DimCurso"], "CursoID", "CursoKey", "left")
    student = latest.join(shuffled(courses.drop("CursoID")), "TurmaID", "left").drop("TurmaID")
    paid = F.coalesce(F.col("ValorPago"), F.lit(0))
    return due.join(shuffled(student), "AlunoID").select(
        date_key("DataVencimento").alias("TempoKey"),
        "AlunoKey", "CursoKey", "ParcelaID", "Competencia", "StatusParcela",
        F.col("ValorLiquido").cast("decimal(12,2)").alias("ValorLiquido"),
        paid.cast("decimal(12,2)").alias("ValorPago"),
        open_balance().alias("SaldoAberto"),
        days_overdue("StatusParcela", "DataVencimento", as_of).alias("AtrasoDias"),
    )


def fact_telemetry(events: DataFrame, dim_student_: DataFrame, d0: dt.date, d1: dt.date) -> DataFrame:
    """Day × type × student × session.

    Events are aggregated by the natural student id before the key is attached.
    Students without a current version share the NULL key, so those groups are
    folded once more from sums and counts.
    """
    rows = in_window(events, "OccurredAt", d0, d1)
    part = rows.groupBy(F.to_date("OccurredAt").alias("_day"), "EventTypeID", "AlunoID", "SessionID").agg(
        F.count("*").alias("_n"),
        F.count("DurationMs").alias("_timed"),
        F.sum(F.col("DurationMs").cast("decimal(18,2)")).alias("_ms"),
        F.sum(F.coalesce(F.col("NumericValue"), F.lit(0))).alias("_value"),
    )
    keyed = with_key(part, shuffled(dim_student_), "AlunoID", "AlunoKey", "left")
    mean = (F.sum("_ms") / F.nullif(F.sum("_timed"), F.lit(0))).cast("decimal(22,6)").cast("decimal(18,2)")
    return keyed.groupBy(date_key("_day").alias("TempoKey"), "EventTypeID", "AlunoKey", "SessionID").agg(
        F.sum("_n").alias("Eventos"),
        mean.alias("DuracaoMediaMs"),
        F.sum("_value").cast("decimal(18,4)").alias("ValorNumericoSoma"),
    )


# ---- KPIs -------------------------------------------------------------------
def _kpi(days: DataFrame, per_day: DataFrame, spec, value, d0: dt.date, d1: dt.date) -> DataFrame:
    """Day spine with one aggregated row per day of the fact."""
    name, unit, target = spec
    spine = days.filter(F.col("DataCompleta").between(F.lit(d0), F.lit(d1))).select("TempoKey", "DataCompleta")
    return spine.join(per_day, "TempoKey", "left").select(
        F.col("DataCompleta").alias("DataRef"),
        F.lit(name).alias("KPIName"),
        value.cast("decimal(18,4)").alias("KPIValue"),
        F.lit(unit).alias("Unidade"),
        F.lit(target).cast("decimal(18,4)").alias("MetaValor"),
    )


def _inside(columns: Sequence[str], d0: dt.date, d1: dt.date) -> Column:
    """Day key within the range; where the month partition is there, it is bounded too and prunes files."""
    low, high = (int(d.strftime("%Y%m%d")) for d in (d0, d1))
    inside = F.col("TempoKey").between(low, high)
    return inside & F.col(MONTH).between(low // 100, high // 100) if MONTH in columns else inside


def _key_range(fact: DataFrame, d0: dt.date, d1: dt.date) -> DataFrame:
    return fact.filter(_inside(fact.columns, d0, d1))


def kpi_active_students(days: DataFrame, fact: DataFrame, d0, d1) -> DataFrame:
    per_day = _key_range(fact, d0, d1).groupBy("TempoKey").agg(F.count_distinct("AlunoKey").alias("v"))
    return _kpi(days, per_day, ACTIVE_STUDENTS, F.coalesce("v", F.lit(0)), d0, d1)


def kpi_approval_rate(days: DataFrame, fact: DataFrame, d0, d1) -> DataFrame:
    """NULL on days without concluded enrolments."""
    per_day = _key_range(fact, d0, d1).groupBy("TempoKey").agg(
        count_if(F.col("StatusMatricula") == "APROVADA").alias("passed"),
        count_if(F.col("StatusMatricula").isin(*CONCLUDED)).alias("concluded"),
    )
    return _kpi(days, per_day, APPROVAL_RATE, safe_ratio_pct(F.col("passed"), F.col("concluded")), d0, d1)


def kpi_overdue_value(days: DataFrame, fact: DataFrame, d0, d1) -> DataFrame:
    per_day = _key_range(fact, d0, d1).groupBy("TempoKey").agg(F.sum("SaldoAberto").alias("v"))
    return _kpi(days, per_day, OVERDUE_VALUE, F.coalesce("v", F.lit(0)), d0, d1)


def kpi_events_total(days: DataFrame, fact: DataFrame, d0, d1) -> DataFrame:
    per_day = _key_range(fact, d0, d1).groupBy("TempoKey").agg(F.sum("Eventos").alias("v"))
    return _kpi(days, per_day, EVENTS_TOTAL, F.coalesce("v", F.lit(0)), d0, d1)


def _kpi_academic(days: DataFrame, fact: DataFrame, d0, d1) -> DataFrame:
    """Both KPIs of the academic fact from one pass over it."""
    per_day = _key_range(fact, d0, d1).groupBy("TempoKey").agg(
        F.count_distinct("AlunoKey").alias("students"),
        count_if(F.col("StatusMatricula") == "APROVADA").alias("passed"),
        count_if(F.col("StatusMatricula").isin(*CONCLUDED)).alias("concluded"),
    )
    spine = days.filter(F.col("DataCompleta").between(F.lit(d0), F.lit(d1))).select("TempoKey", "DataCompleta")
    values = {
        ACTIVE_STUDENTS: F.coalesce("students", F.lit(0)),
        APPROVAL_RATE: safe_ratio_pct(F.col("passed"), F.col("concluded")),
    }
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("KPIName"), value.cast("decimal(18,4)").alias("KPIValue"), F.lit(unit).alias("Unidade"),
            F.lit(target).cast("decimal(18,4)").alias("MetaValor"),
        )
        for (name, unit, target), value in values.items()
    ])
    each = spine.join(per_day, "TempoKey", "left").select(F.col("DataCompleta").alias("DataRef"), F.explode(rows).alias("k"))
    return each.select("DataRef", "k.*")


def kpi_daily(days: DataFrame, academic: DataFrame, finance: DataFrame, telemetry: DataFrame, d0, d1) -> DataFrame:
    return union_all(
        _kpi_academic(days, academic, d0, d1),
        kpi_overdue_value(days, finance, d0, d1),
        kpi_events_total(days, telemetry, d0, d1),
    )


# ---- jobs -------------------------------------------------------------------
# Facts are stored by month: a day alone would leave small files in small
# warehouses, and inside a month the sorted day key still prunes row groups.
MONTH = "AnoMes"
FACTS = ("FatoAcademico", "FatoFinanceiro", "FatoTelemetria")


def window_defaults(src: Tables, d0, d1, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First enrolment day and ``as_of`` where a bound is not given."""
    if d0 is None:
        d0 = min_date(src["Matricula"], "DataMatricula", as_of).first()[0]
    return d0, d1 or as_of


def build_dims(spark: SparkSession, src: Tables, d0, d1, as_of: dt.date, old: Tables | None = None) -> Tables:
    old = old or {}
    days = dim_date(spark, old.get("DimTempo"), d0, d1)
    if "DimTempo" in old:
        days = old["DimTempo"].select(*days.columns).unionByName(days)
    # Keys are numbered on written rows; the three do not wait for each other.
    builders = {
        "DimCurso": lambda: dim_course(src["Curso"], src["Departamento"], as_of, old.get("DimCurso")),
        "DimAluno": lambda: dim_student(src["Aluno"], as_of, old.get("DimAluno")),
        "DimTurma": lambda: dim_class(
            src["Turma"], src["Disciplina"], src["Professor"], src["Pessoa"], old.get("DimTurma"), as_of
        ),
    }
    run = inheritable_thread_target(spark)(lambda build: build())
    with ThreadPoolExecutor(len(builders)) as pool:
        return {"DimTempo": days, **dict(zip(builders, pool.map(run, builders.values())))}


def build_facts(src: Tables, dims: Tables, d0, d1, as_of: dt.date) -> Tables:
    return {
        "FatoAcademico": fact_academic(src["Matricula"], src["Turma"], src["Disciplina"], dims, d0, d1),
        "FatoFinanceiro": fact_finance(
            src["ParcelaFinanceira"], src["Matricula"], src["Turma"], src["Disciplina"], dims, d0, d1, as_of
        ),
        "FatoTelemetria": fact_telemetry(src["EventStream"], dims["DimAluno"], d0, d1),
    }


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.floor(F.col("TempoKey") / 100).cast("int"))


def _declared(df: DataFrame, name: str, as_of: dt.date) -> DataFrame:
    """Columns and types of the declared table, stamps filled with ``as_of``.

    An identity of another kind than declared, such as text for a number, keeps its kind.
    """
    kinds = {f.name: f.dataType for f in TABLES[name].struct.fields}
    df = with_defaults(df, name, dt.datetime.combine(as_of, dt.time()))
    kept = [
        F.col(c) if kind.typeName() != "string" and df.schema[c].dataType.typeName() == "string" else F.col(c).cast(kind)
        for c, kind in kinds.items()
    ]
    return df.select(*[c.alias(n) for c, n in zip(kept, kinds)], *[c for c in df.columns if c not in kinds])


def _save(
    tables: Tables, out: str, run: str, counts: dict[str, dict], schemas: dict, as_of: dt.date, day: str | None = None
) -> Tables:
    """Write the tables as declared, side by side, note their row counts and checksums, and hand back the written files.

    The tables do not depend on each other; running their jobs together keeps
    the cluster busy through the tail of each.
    """
    by, within = ([MONTH], [day]) if day else ([], [])
    tables = {name: _declared(df, name, as_of) for name, df in tables.items()}
    spark = next(iter(tables.values())).sparkSession

    @inheritable_thread_target(spark)
    def write(name: str) -> dict[str, object]:
        return observed_write(tables[name], f"{out}/{name}/run={run}", by, within)

    with ThreadPoolExecutor(len(tables)) as pool:
        counts.update(zip(tables, pool.map(write, tables)))
    schemas.update({name: df.schema for name, df in tables.items()})
    return {name: spark.read.schema(df.schema).parquet(f"{out}/{name}/run={run}") for name, df in tables.items()}


def rebuild_warehouse(
    spark: SparkSession, src: Tables, out: str, run: str, as_of: dt.date,
    d0: dt.date | None = None, d1: dt.date | None = None,
) -> DataFrame:
    """Full rebuild into a new run; returns (table, rows, filled, total, chars), observed during the writes.

    Dimensions are written first and read back, so the three facts share files
    rather than a recomputed lineage; KPIs read the written facts.
    """
    d0, d1 = window_defaults(src, d0, d1, as_of)
    counts, schemas, base = {}, {}, manifest.load(spark, out)

    dims = _save(build_dims(spark, src, d0, d1, as_of), out, run, counts, schemas, as_of)
    facts = {name: _by_month(df) for name, df in build_facts(src, dims, d0, d1, as_of).items()}
    facts = _save(facts, out, run, counts, schemas, as_of, "TempoKey")
    kpis = kpi_daily(dims["DimTempo"], *[facts[f] for f in FACTS], d0, d1)
    _save({"KPI_Diario": kpis}, out, run, counts, schemas, as_of)
    return publish(spark, out, run, counts, schemas, base=base)


def refresh_window(
    spark: SparkSession, src: Tables, out: str, run: str, as_of: dt.date, d0: dt.date, d1: dt.date
) -> DataFrame:
    """Rebuild the facts and KPIs of a window of a built warehouse; everything outside stays.

    Known dimension rows keep their surrogate keys and vanished ones stay, so older facts
    stay valid.  Of the facts, only the months that the window touches are read and written
    anew.  Everything goes to a new run and is published by one manifest at the end: a
    failure before it leaves the previous warehouse whole, and a refresh that began before another one
    was published is refused.
    """
    counts, schemas, base = {}, {}, manifest.load(spark, out)
    old = {name: current(spark, out, name, base) for name in ("DimTempo", "DimCurso", "DimAluno", "DimTurma")}
    dims = _save(build_dims(spark, src, d0, d1, as_of, old), out, run, counts, schemas, as_of)
    low, high = (int(d.strftime("%Y%m%d")) for d in (d0, d1))
    months = [
        y * 100 + m for y in range(d0.year, d1.year + 1) for m in range(1, 13) if low // 100 <= y * 100 + m <= high // 100
    ]
    facts = {}
    for name, df in build_facts(src, dims, d0, d1, as_of).items():
        before = current(spark, out, name, base).filter(F.col(MONTH).between(low // 100, high // 100))
        kept = before.filter(~F.col("TempoKey").between(low, high))
        facts[name] = kept.unionByName(_declared(_by_month(df), name, as_of).select(*kept.columns))
    facts = _save(facts, out, run, counts, schemas, as_of, "TempoKey")
    kpis = _declared(kpi_daily(dims["DimTempo"], *[facts[f] for f in FACTS], d0, d1), "KPI_Diario", as_of)
    kept = current(spark, out, "KPI_Diario", base).filter(~F.col("DataRef").between(F.lit(d0), F.lit(d1)))
    _save({"KPI_Diario": kept.unionByName(kpis.select(*kept.columns))}, out, run, counts, schemas, as_of)
    return publish(spark, out, run, counts, schemas, dict.fromkeys(FACTS, months), base)


def rebuild_minute_metric(
    events: DataFrame, types: DataFrame, path: str, as_of: dt.datetime,
    t0: dt.datetime | None = None, t1: dt.datetime | None = None, metric: str = "EVENT_COUNT",
) -> None:
    """Recompute one minute metric for a window (the last seven days unless given).

    Both bounds are widened to whole minutes, so a boundary minute is neither
    half deleted nor half counted; other metrics in the table are kept.
    """
    t0 = (t0 or as_of - dt.timedelta(days=7)).replace(second=0, microsecond=0)
    last_minute = (t1 or as_of).replace(second=0, microsecond=0)
    t1 = last_minute + dt.timedelta(minutes=1, microseconds=-1)
    fresh = minute_counts(events, types, t0, t1, metric).withColumn("DataRef", F.to_date("MetricMinute"))
    replace_window(fresh, path, "DataRef", "MetricMinute", t0, t1, F.col("MetricName") == metric)
