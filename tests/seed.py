"""The seed campus as literal rows (fixed values; ids are ours, natural keys are the model's)."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from lectern.functions.status import with_net_amount
from lectern.schema.model import TABLES
from lectern.sources.scan import with_defaults

NOW = dt.datetime(2026, 3, 1)
AS_OF = dt.date(2026, 3, 20)
DUE, NEXT_DUE = dt.date(2026, 3, 10), dt.date(2026, 4, 10)

ROWS = {
    "Departamento": (
        "DepartamentoID Nome Sigla",
        [
            (1, "Departamento de Computacao Aplicada", "COMP"),
            (2, "Departamento de Gestao e Negocios", "GEST"),
            (3, "Departamento de Produto e Design", "DSGN"),
        ],
    ),
    "Pessoa": (
        "PessoaID NomeExibicao Email",
        [(1, "Docente Seed COMP 01", "prof.comp1"), (2, "Docente Seed GEST 01", "prof.gest1"),
         (3, "Docente Seed DSGN 01", "prof.dsgn1")]
        + [(3 + n, f"Aluno Seed 2026000{n}", f"aluno.2026000{n}") for n in range(1, 6)],
    ),
    "Professor": (
        "ProfessorID PessoaID DepartamentoID Titulacao RegimeTrabalho DataAdmissao",
        [
            (1, 1, 1, "DOUTORADO", "INTEGRAL", dt.date(2018, 2, 1)),
            (2, 2, 2, "MESTRADO", "PARCIAL", dt.date(2020, 8, 15)),
            (3, 3, 3, "ESPECIALIZACAO", "PARCIAL", dt.date(2021, 1, 10)),
        ],
    ),
    "Curso": (
        "CursoID DepartamentoID Codigo Nome Nivel Modalidade CargaHorariaTotal SemestresPrevistos",
        [
            (1, 1, "BSI", "Sistemas de Informacao", "GRADUACAO", "PRESENCIAL", 3200, 8),
            (2, 2, "ADM", "Administracao Estrategica", "GRADUACAO", "PRESENCIAL", 3000, 8),
            (3, 3, "DPD", "Design de Produto Digital", "GRADUACAO", "HIBRIDO", 2800, 8),
        ],
    ),
    "Disciplina": (
        "DisciplinaID CursoID Codigo Nome CargaHoraria Creditos SemestreSugerido",
        [
            (1, 1, "BSI-BD1", "Banco de Dados I", 80, 4, 3),
            (2, 1, "BSI-WEB", "Programacao Web", 80, 4, 3),
            (3, 2, "ADM-AF", "Analise Financeira", 60, 3, 2),
            (4, 3, "DPD-UX", "UX Strategy", 60, 3, 2),
        ],
    ),
    "Turma": (
        "TurmaID DisciplinaID ProfessorID CodigoTurma Ano Periodo Turno Vagas DataInicio DataFim",
        [
            (t, t, p, code, 2026, 1, shift, seats, dt.date(2026, 2, 10), dt.date(2026, 6, 30))
            for t, p, code, shift, seats in [
                (1, 1, "BSI-BD1-2026A", "NOITE", 45), (2, 1, "BSI-WEB-2026A", "NOITE", 40),
                (3, 2, "ADM-AF-2026A", "MANHA", 50), (4, 3, "DPD-UX-2026A", "TARDE", 35),
            ]
        ],
    ),
    "Aluno": (
        "AlunoID PessoaID RA DataIngresso StatusAcademico Bolsista PercentualBolsa",
        [
            (n, 3 + n, f"2026000{n}", dt.date(2026, 2, 1), "ATIVO", pct > 0, D(pct))
            for n, pct in [(1, 40), (2, 0), (3, 60), (4, 0), (5, 0)]
        ],
    ),
    "Matricula": (
        "MatriculaID AlunoID TurmaID OrigemMatricula StatusMatricula FrequenciaPercentual NotaFinal",
        [
            (1, 1, 1, "PORTAL", "APROVADA", D("92.50"), D("8.70")),
            (2, 2, 1, "PORTAL", "APROVADA", D("88.00"), D("7.90")),
            (3, 4, 1, "SECRETARIA", "REPROVADA", D("70.00"), D("5.20")),
            (4, 3, 3, "PORTAL", "ATIVA", D("80.00"), None),
            (5, 5, 4, "API", "ATIVA", D("85.00"), None),
            (6, 1, 2, "PORTAL", "ATIVA", D("90.00"), None),
        ],
    ),
    "Avaliacao": (
        "AvaliacaoID TurmaID NomeAvaliacao TipoAvaliacao Peso NotaMaxima DataAplicacao",
        [
            (1, 1, "Prova 1", "PROVA", D(40), D(10), dt.date(2026, 4, 10)),
            (2, 1, "Projeto Final", "PROJETO", D(60), D(10), dt.date(2026, 6, 20)),
            (3, 3, "Case Empresarial", "TRABALHO", D(100), D(10), dt.date(2026, 6, 15)),
            (4, 4, "Portfolio UX", "PROJETO", D(100), D(10), dt.date(2026, 6, 18)),
        ],
    ),
    "Nota": (
        "NotaID AvaliacaoID MatriculaID NotaObtida",
        [
            (1, 1, 1, D("8.50")), (2, 2, 1, D("8.90")), (3, 1, 2, D("7.30")),
            (4, 2, 2, D("8.30")), (5, 1, 3, D("5.00")), (6, 2, 3, D("5.30")),
        ],
    ),
    "PlanoFinanceiro": (
        "PlanoFinanceiroID CursoID AnoReferencia ValorMensalBase DiaVencimento",
        [(1, 1, 2026, D(1350), 10), (2, 2, 2026, D(1200), 10), (3, 3, 2026, D(1280), 10)],
    ),
    "ParcelaFinanceira": (
        "ParcelaID AlunoID PlanoFinanceiroID Competencia DataVencimento ValorOriginal ValorDesconto ValorMulta"
        " ValorPago DataPagamento StatusParcela",
        [
            (1, 1, 1, "2026-03", DUE, D(1350), D(540), D(0), D(810), dt.date(2026, 3, 9), "PAGA"),
            (2, 1, 1, "2026-04", NEXT_DUE, D(1350), D(540), D(0), None, None, "ABERTA"),
            (3, 2, 1, "2026-03", DUE, D(1350), D(0), D(20), None, None, "ATRASADA"),
            (4, 3, 2, "2026-03", DUE, D(1200), D(720), D(0), D(480), dt.date(2026, 3, 10), "PAGA"),
            (5, 4, 1, "2026-03", DUE, D(1350), D(0), D(0), D(1350), dt.date(2026, 3, 8), "PAGA"),
            (6, 5, 3, "2026-03", DUE, D(1280), D(0), D(0), None, None, "ABERTA"),
        ],
    ),
    "Pagamento": (
        "PagamentoID ParcelaID DataPagamento ValorPagamento MeioPagamento",
        [
            (1, 1, dt.datetime(2026, 3, 9, 10, 40), D(810), "PIX"),
            (2, 4, dt.datetime(2026, 3, 10, 9), D(480), "BOLETO"),
            (3, 5, dt.datetime(2026, 3, 8, 16, 25), D(1350), "CARTAO"),
        ],
    ),
    "UsuarioSistema": (
        "UsuarioID Login NomeExibicao Email Perfil",
        [(1, "analytics.ops", "Operador Analytics", "analytics.ops", "ANALYTICS")],
    ),
    "EventType": (
        "EventTypeID EventCode Categoria Severidade",
        [
            (n + 1, code, cat, sev)
            for n, (code, cat, sev) in enumerate([
                ("SESSION_START", "AUTH", 1), ("LOGIN_SUCCESS", "AUTH", 1), ("LOGIN_FAILED", "AUTH", 3),
                ("PAGE_VIEW", "USAGE", 0), ("API_CALL", "USAGE", 1), ("MATRICULA_CREATED", "ACADEMIC", 1),
                ("NOTE_UPDATED", "ACADEMIC", 1), ("PAYMENT_ATTEMPT", "FINANCE", 2),
                ("PAYMENT_SUCCESS", "FINANCE", 1), ("PAYMENT_FAILED", "FINANCE", 4),
            ])
        ],
    ),
    "SessionApp": (
        "SessionID AlunoID UsuarioID ClientID Platform StartedAt",
        [
            (1, 1, None, "web-client-001", "WEB", dt.datetime(2026, 3, 9, 10)),
            (2, 2, None, "mobile-client-002", "MOBILE", dt.datetime(2026, 3, 9, 10, 5)),
            (3, None, 1, "batch-analytics-001", "BATCH", dt.datetime(2026, 3, 9)),
        ],
    ),
    "EventStream": (
        "EventID EventTypeID SessionID AlunoID OccurredAt SourceSystem DurationMs NumericValue PayloadJson",
        [
            (1, 1, 1, 1, dt.datetime(2026, 3, 9, 10, 0, 1), "PORTAL", 50, None, '{"route":"login"}'),
            (2, 2, 1, 1, dt.datetime(2026, 3, 9, 10, 0, 5), "PORTAL", 120, None, '{"method":"password"}'),
            (3, 4, 1, 1, dt.datetime(2026, 3, 9, 10, 10), "PORTAL", 35, None, '{"route":"/dashboard"}'),
            (4, 6, 1, 1, dt.datetime(2026, 3, 9, 10, 12), "PORTAL", 180, None, '{"turma":"BSI-WEB-2026A"}'),
            (5, 9, 1, 1, dt.datetime(2026, 3, 9, 10, 15), "PORTAL", 220, D(810), '{"gateway":"pix"}'),
            (6, 5, 2, 2, dt.datetime(2026, 3, 9, 10, 16), "PORTAL", 90, None, '{"resource":"/api/turmas"}'),
            (7, 3, 2, 2, dt.datetime(2026, 3, 9, 10, 16, 20), "PORTAL", 110, None, '{"result":"invalid_password"}'),
        ],
    ),
}


def model_rows(spark, table, columns, rows):
    """Literal rows in the declared schema, defaults filled."""
    names = columns.split()
    types = {f.name: f for f in TABLES[table].struct.fields}
    from pyspark.sql.types import StructType

    df = spark.createDataFrame(rows, StructType([types[n] for n in names]))
    missing = [f for n, f in types.items() if n not in names and n not in TABLES[table].defaults]
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df
    return with_defaults(df, table, NOW).select(*types)


def campus_tables(spark):
    out = {name: model_rows(spark, name, cols, rows) for name, (cols, rows) in ROWS.items()}
    out["ParcelaFinanceira"] = with_net_amount(out["ParcelaFinanceira"])
    return out
