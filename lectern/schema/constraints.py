"""The declared integrity rules of each table (fixed values: names, lists, ranges)."""

from __future__ import annotations

from lectern.functions.scalar import COMPETENCE_PATTERN
from lectern.operators.integrity import CrossTable, Domain, Expr, ForeignKey, Json, NotNull, Pattern, Range, Unique
from lectern.schema.model import TABLES

ORIGINS = ("PORTAL", "SECRETARIA", "API", "BATCH")
METHODS = ("PIX", "CARTAO", "BOLETO", "TRANSFERENCIA", "DINHEIRO")
PLATFORMS = ("WEB", "MOBILE", "DESKTOP", "API", "BATCH")

DOMAINS = {
    "Aluno": {"StatusAcademico": ("ATIVO", "TRANCADO", "FORMADO", "DESLIGADO")},
    "Professor": {
        "Titulacao": ("GRADUACAO", "ESPECIALIZACAO", "MESTRADO", "DOUTORADO", "POS_DOUTORADO"),
        "RegimeTrabalho": ("HORISTA", "PARCIAL", "INTEGRAL"),
    },
    "Curso": {
        "Nivel": ("GRADUACAO", "POS", "TECNICO", "LIVRE"),
        "Modalidade": ("PRESENCIAL", "EAD", "HIBRIDO"),
    },
    "Turma": {"Periodo": (1, 2, 3), "Turno": ("MANHA", "TARDE", "NOITE", "EAD")},
    "Matricula": {
        "OrigemMatricula": ORIGINS,
        "StatusMatricula": ("ATIVA", "CANCELADA", "TRANCADA", "APROVADA", "REPROVADA"),
    },
    "Avaliacao": {"TipoAvaliacao": ("PROVA", "TRABALHO", "PROJETO", "QUIZ", "RECUPERACAO")},
    "ParcelaFinanceira": {
        "StatusParcela": ("ABERTA", "PAGA", "ATRASADA", "NEGOCIADA", "CANCELADA"),
        "CanalGeracao": ("MENSALIDADE", "ACORDO", "SERVICO", "MULTA", "OUTRO"),
    },
    "Pagamento": {
        "MeioPagamento": METHODS,
        "GatewayStatus": ("PENDING", "CONFIRMED", "FAILED", "CHARGEBACK"),
    },
    "UsuarioSistema": {"Perfil": ("ADMIN", "CORE_OPS", "FINANCE_OPS", "ANALYTICS", "OBSERVER")},
    "ChangeAudit": {"Operacao": ("INSERT", "UPDATE", "DELETE")},
    "ProcessRun": {
        "Camada": ("CORE", "LOG", "TELEMETRY", "ANALYTICS"),
        "StatusExecucao": ("STARTED", "SUCCESS", "FAILED", "PARTIAL"),
    },
    "SessionApp": {"Platform": PLATFORMS},
    "EventStream": {"ProcessingStatus": ("N", "P", "E", "D")},
}

# (low, high, low bound excluded)
RANGES = {
    "Curso": {"CargaHorariaTotal": (120, 12000, False), "SemestresPrevistos": (1, 20, False)},
    "Disciplina": {
        "CargaHoraria": (15, 400, False),
        "Creditos": (1, 20, False),
        "SemestreSugerido": (1, 20, False),
    },
    "Turma": {"Ano": (2000, 2100, False), "Vagas": (1, 1000, False)},
    "Matricula": {"FrequenciaPercentual": (0, 100, False), "NotaFinal": (0, 10, False)},
    "Avaliacao": {"Peso": (0, 100, True), "NotaMaxima": (0, 100, True)},
    "Nota": {"NotaObtida": (0, None, False)},
    "PlanoFinanceiro": {
        "AnoReferencia": (2000, 2100, False),
        "ValorMensalBase": (0, None, True),
        "DiaVencimento": (1, 28, False),
        "PercentualMulta": (0, 100, False),
        "PercentualJurosMes": (0, 100, False),
    },
    "Pagamento": {"ValorPagamento": (0, None, True)},
    "EventType": {"Severidade": (0, 5, False)},
    "EventStream": {"DurationMs": (0, None, False)},
}

EXPRESSIONS = {
    "Turma": {"Datas": "DataFim > DataInicio"},
    "Aluno": {
        "Bolsa": "(NOT Bolsista AND PercentualBolsa = 0)"
        " OR (Bolsista AND PercentualBolsa > 0 AND PercentualBolsa <= 100)"
    },
    "ParcelaFinanceira": {
        "Valores": "ValorOriginal > 0 AND ValorDesconto >= 0 AND ValorMulta >= 0"
        " AND ValorDesconto <= ValorOriginal AND (ValorPago IS NULL OR ValorPago >= 0)"
    },
}

UNIQUE = {
    "Pessoa": (("PessoaGuid",), ("Email",)),
    "Departamento": (("Nome",), ("Sigla",)),
    "Aluno": (("PessoaID",), ("RA",)),
    "Professor": (("PessoaID",),),
    "Curso": (("Codigo",), ("Nome",)),
    "Disciplina": (("Codigo",), ("CursoID", "Nome")),
    "Turma": (("CodigoTurma",),),
    "Matricula": (("AlunoID", "TurmaID"),),
    "Avaliacao": (("TurmaID", "NomeAvaliacao"),),
    "Nota": (("AvaliacaoID", "MatriculaID"),),
    "PlanoFinanceiro": (("CursoID", "AnoReferencia"),),
    "ParcelaFinanceira": (("AlunoID", "Competencia"),),
    "UsuarioSistema": (("Login",), ("Email",)),
    "EventType": (("EventCode",),),
    "MetricMinute": (("MetricName", "MetricMinute", "Dimension1", "Dimension2"),),
    "DimTempo": (("DataCompleta",),),
    "DimCurso": (("CursoID", "EffectiveStartDate"),),
    "DimAluno": (("AlunoID", "EffectiveStartDate"),),
    "DimTurma": (("TurmaID",),),
    "FatoAcademico": (("MatriculaID",),),
    "FatoFinanceiro": (("ParcelaID",),),
    "KPI_Diario": (("DataRef", "KPIName"),),
}

# column -> parent table; the parent's key is its own key column
PARENTS = {
    "Aluno": {"PessoaID": "Pessoa"},
    "Professor": {"PessoaID": "Pessoa", "DepartamentoID": "Departamento"},
    "Curso": {"DepartamentoID": "Departamento"},
    "Disciplina": {"CursoID": "Curso"},
    "Turma": {"DisciplinaID": "Disciplina", "ProfessorID": "Professor"},
    "Matricula": {"AlunoID": "Aluno", "TurmaID": "Turma"},
    "Avaliacao": {"TurmaID": "Turma"},
    "Nota": {"AvaliacaoID": "Avaliacao", "MatriculaID": "Matricula"},
    "PlanoFinanceiro": {"CursoID": "Curso"},
    "ParcelaFinanceira": {"AlunoID": "Aluno", "PlanoFinanceiroID": "PlanoFinanceiro"},
    "Pagamento": {"ParcelaID": "ParcelaFinanceira"},
    "AccessLog": {"UsuarioID": "UsuarioSistema"},
    "SessionApp": {"AlunoID": "Aluno", "UsuarioID": "UsuarioSistema"},
    "EventStream": {"EventTypeID": "EventType", "SessionID": "SessionApp", "AlunoID": "Aluno"},
    "FatoAcademico": {"TempoKey": "DimTempo", "AlunoKey": "DimAluno", "CursoKey": "DimCurso", "TurmaKey": "DimTurma"},
    "FatoFinanceiro": {"TempoKey": "DimTempo", "AlunoKey": "DimAluno", "CursoKey": "DimCurso"},
    "FatoTelemetria": {
        "TempoKey": "DimTempo", "EventTypeID": "EventType", "AlunoKey": "DimAluno", "SessionID": "SessionApp",
    },
}


def domain_rules(table: str) -> list[Domain]:
    return [Domain(f"{table}.{c}.domain", c, v) for c, v in DOMAINS.get(table, {}).items()]


def range_rules(table: str) -> list[Range]:
    return [Range(f"{table}.{c}.range", c, *v) for c, v in RANGES.get(table, {}).items()]


def expression_rules(table: str) -> list[Expr]:
    return [Expr(f"{table}.{n}.check", p) for n, p in EXPRESSIONS.get(table, {}).items()]


def unique_rules(table: str) -> list[Unique]:
    return [Unique(f"{table}.{'_'.join(cols)}.unique", cols) for cols in UNIQUE.get(table, ())]


def parent_rules(table: str) -> list[ForeignKey]:
    return [
        ForeignKey(f"{table}.{c}.parent", c, parent, TABLES[parent].key)
        for c, parent in PARENTS.get(table, {}).items()
    ]


def required_rules(table: str) -> list[NotNull]:
    return [NotNull(f"{table}.{c}.required", (c,)) for c in TABLES[table].required]


def grade_limit(reject: str = "row") -> CrossTable:
    return CrossTable("Nota.NotaMaxima.limit", "Avaliacao", "AvaliacaoID", "NotaObtida", "NotaMaxima", reject)


def rules_for(table: str) -> list:
    """All rules of a table."""
    rules: list = [*required_rules(table), *domain_rules(table), *range_rules(table), *expression_rules(table)]
    if table == "ParcelaFinanceira":
        rules.append(Pattern("ParcelaFinanceira.Competencia.pattern", "Competencia", COMPETENCE_PATTERN))
    if table == "EventStream":
        rules.append(Json("EventStream.PayloadJson.json", "PayloadJson"))
    if table == "Nota":
        rules.append(grade_limit())
    return [*rules, *unique_rules(table), *parent_rules(table)]
