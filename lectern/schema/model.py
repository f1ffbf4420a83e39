"""Declared tables: columns, keys, defaults.

The table and column names, lengths aside, are fixed values: data written for
the same model can be read unchanged.  ``TINYINT`` columns of the source model
are unsigned, hence SMALLINT here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Marker for defaults that are the load time or a fresh identifier.
NOW = "@now"
TODAY = "@today"
UUID = "@uuid"


@dataclass(frozen=True)
class Table:
    name: str
    layer: str
    key: str
    columns: str
    defaults: dict = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        """All columns are read as nullable; required ones are checked by rules."""
        plain = self.columns.replace(" NOT NULL", "")
        return T.StructType.fromDDL(plain)

    @property
    def required(self) -> list[str]:
        parts = [p.strip() for p in self.columns.replace("\n", " ").split(", ")]
        return [p.split()[0] for p in parts if p.endswith("NOT NULL")]


TABLES: dict[str, Table] = {}


def _table(layer: str, name: str, key: str, columns: str, **defaults) -> None:
    TABLES[name] = Table(name, layer, key, " ".join(columns.split()), defaults)


# ---- core -------------------------------------------------------------------
_table("core", "Pessoa", "PessoaID", """
    PessoaID INT NOT NULL, PessoaGuid STRING NOT NULL, NomeExibicao STRING NOT NULL,
    DocumentoHash BINARY, Email STRING NOT NULL, Telefone STRING, DataNascimento DATE,
    Ativo BOOLEAN NOT NULL, CriadoEm TIMESTAMP_NTZ NOT NULL, AtualizadoEm TIMESTAMP_NTZ NOT NULL
""", PessoaGuid=UUID, Ativo=True, CriadoEm=NOW, AtualizadoEm=NOW)

_table("core", "Departamento", "DepartamentoID", """
    DepartamentoID INT NOT NULL, Nome STRING NOT NULL, Sigla STRING NOT NULL, CentroCusto STRING,
    EmailContato STRING, Ativo BOOLEAN NOT NULL, CriadoEm TIMESTAMP_NTZ NOT NULL
""", Ativo=True, CriadoEm=NOW)

_table("core", "Aluno", "AlunoID", """
    AlunoID INT NOT NULL, PessoaID INT NOT NULL, RA STRING NOT NULL, DataIngresso DATE NOT NULL,
    StatusAcademico STRING NOT NULL, Bolsista BOOLEAN NOT NULL, PercentualBolsa DECIMAL(5,2) NOT NULL,
    CriadoEm TIMESTAMP_NTZ NOT NULL
""", DataIngresso=TODAY, StatusAcademico="ATIVO", Bolsista=False, PercentualBolsa="0", CriadoEm=NOW)

_table("core", "Professor", "ProfessorID", """
    ProfessorID INT NOT NULL, PessoaID INT NOT NULL, DepartamentoID INT NOT NULL, Titulacao STRING NOT NULL,
    RegimeTrabalho STRING NOT NULL, DataAdmissao DATE NOT NULL, Ativo BOOLEAN NOT NULL,
    CriadoEm TIMESTAMP_NTZ NOT NULL
""", Ativo=True, CriadoEm=NOW)

_table("core", "Curso", "CursoID", """
    CursoID INT NOT NULL, DepartamentoID INT NOT NULL, Codigo STRING NOT NULL, Nome STRING NOT NULL,
    Nivel STRING NOT NULL, Modalidade STRING NOT NULL, CargaHorariaTotal SMALLINT NOT NULL,
    SemestresPrevistos SMALLINT NOT NULL, Ativo BOOLEAN NOT NULL, CriadoEm TIMESTAMP_NTZ NOT NULL
""", Ativo=True, CriadoEm=NOW)

_table("core", "Disciplina", "DisciplinaID", """
    DisciplinaID INT NOT NULL, CursoID INT NOT NULL, Codigo STRING NOT NULL, Nome STRING NOT NULL,
    CargaHoraria SMALLINT NOT NULL, Creditos SMALLINT NOT NULL, SemestreSugerido SMALLINT NOT NULL,
    Ementa STRING, Ativa BOOLEAN NOT NULL, CriadoEm TIMESTAMP_NTZ NOT NULL
""", Ativa=True, CriadoEm=NOW)

_table("core", "Turma", "TurmaID", """
    TurmaID INT NOT NULL, DisciplinaID INT NOT NULL, ProfessorID INT NOT NULL, CodigoTurma STRING NOT NULL,
    Ano SMALLINT NOT NULL, Periodo SMALLINT NOT NULL, Turno STRING NOT NULL, Vagas SMALLINT NOT NULL,
    DataInicio DATE NOT NULL, DataFim DATE NOT NULL, Encerrada BOOLEAN NOT NULL, CriadoEm TIMESTAMP_NTZ NOT NULL
""", Encerrada=False, CriadoEm=NOW)

_table("core", "Matricula", "MatriculaID", """
    MatriculaID BIGINT NOT NULL, AlunoID INT NOT NULL, TurmaID INT NOT NULL, DataMatricula TIMESTAMP_NTZ NOT NULL,
    OrigemMatricula STRING NOT NULL, StatusMatricula STRING NOT NULL, FrequenciaPercentual DECIMAL(5,2) NOT NULL,
    NotaFinal DECIMAL(5,2), UltimaAtualizacao TIMESTAMP_NTZ NOT NULL
""", DataMatricula=NOW, OrigemMatricula="PORTAL", StatusMatricula="ATIVA", FrequenciaPercentual="0",
    UltimaAtualizacao=NOW)

_table("core", "Avaliacao", "AvaliacaoID", """
    AvaliacaoID INT NOT NULL, TurmaID INT NOT NULL, NomeAvaliacao STRING NOT NULL, TipoAvaliacao STRING NOT NULL,
    Peso DECIMAL(5,2) NOT NULL, NotaMaxima DECIMAL(5,2) NOT NULL, DataAplicacao DATE NOT NULL,
    CriadoEm TIMESTAMP_NTZ NOT NULL
""", CriadoEm=NOW)

_table("core", "Nota", "NotaID", """
    NotaID BIGINT NOT NULL, AvaliacaoID INT NOT NULL, MatriculaID BIGINT NOT NULL, NotaObtida DECIMAL(5,2) NOT NULL,
    Comentario STRING, LancadaEm TIMESTAMP_NTZ NOT NULL
""", LancadaEm=NOW)

_table("core", "PlanoFinanceiro", "PlanoFinanceiroID", """
    PlanoFinanceiroID INT NOT NULL, CursoID INT NOT NULL, AnoReferencia SMALLINT NOT NULL,
    ValorMensalBase DECIMAL(10,2) NOT NULL, DiaVencimento SMALLINT NOT NULL, PercentualMulta DECIMAL(5,2) NOT NULL,
    PercentualJurosMes DECIMAL(5,2) NOT NULL, Ativo BOOLEAN NOT NULL
""", PercentualMulta="2", PercentualJurosMes="1", Ativo=True)

_table("core", "ParcelaFinanceira", "ParcelaID", """
    ParcelaID BIGINT NOT NULL, AlunoID INT NOT NULL, PlanoFinanceiroID INT, Competencia STRING NOT NULL,
    DataVencimento DATE NOT NULL, ValorOriginal DECIMAL(10,2) NOT NULL, ValorDesconto DECIMAL(10,2) NOT NULL,
    ValorMulta DECIMAL(10,2) NOT NULL, ValorPago DECIMAL(10,2), DataPagamento DATE, StatusParcela STRING NOT NULL,
    CanalGeracao STRING NOT NULL, Observacao STRING
""", ValorDesconto="0", ValorMulta="0", StatusParcela="ABERTA", CanalGeracao="MENSALIDADE")

_table("core", "Pagamento", "PagamentoID", """
    PagamentoID BIGINT NOT NULL, ParcelaID BIGINT NOT NULL, DataPagamento TIMESTAMP_NTZ NOT NULL,
    ValorPagamento DECIMAL(10,2) NOT NULL, MeioPagamento STRING NOT NULL, GatewayStatus STRING NOT NULL,
    ReferenciaExterna STRING, UsuarioLancamento STRING, Observacao STRING
""", DataPagamento=NOW, GatewayStatus="CONFIRMED")

# ---- security and log -------------------------------------------------------
_table("security", "UsuarioSistema", "UsuarioID", """
    UsuarioID INT NOT NULL, Login STRING NOT NULL, NomeExibicao STRING NOT NULL, Email STRING NOT NULL,
    Perfil STRING NOT NULL, Ativo BOOLEAN NOT NULL, CriadoEm TIMESTAMP_NTZ NOT NULL
""", Ativo=True, CriadoEm=NOW)

_table("log", "ChangeAudit", "AuditID", """
    AuditID BIGINT NOT NULL, OrigemSchema STRING NOT NULL, OrigemObjeto STRING NOT NULL, ChaveRegistro STRING,
    Operacao STRING NOT NULL, DadosAntes STRING, DadosDepois STRING, AppUser STRING NOT NULL,
    HostName STRING NOT NULL, EventTime TIMESTAMP_NTZ NOT NULL, CorrelationID STRING NOT NULL
""", AppUser="spark", HostName="cluster", EventTime=NOW, CorrelationID=UUID)

_table("log", "ProcessRun", "ProcessRunID", """
    ProcessRunID BIGINT NOT NULL, ProcessoNome STRING NOT NULL, Camada STRING NOT NULL,
    IniciadoEm TIMESTAMP_NTZ NOT NULL, FinalizadoEm TIMESTAMP_NTZ, StatusExecucao STRING NOT NULL,
    LinhasLidas INT NOT NULL, LinhasProcessadas INT NOT NULL, LinhasRejeitadas INT NOT NULL, Mensagem STRING,
    CorrelationID STRING NOT NULL
""", IniciadoEm=NOW, StatusExecucao="STARTED", LinhasLidas=0, LinhasProcessadas=0, LinhasRejeitadas=0,
    CorrelationID=UUID)

_table("log", "ErrorLog", "ErrorID", """
    ErrorID BIGINT NOT NULL, ProcessoNome STRING NOT NULL, Etapa STRING, NumeroErro INT, Severidade SMALLINT,
    Estado SMALLINT, ProcedureName STRING, Linha INT, Mensagem STRING NOT NULL, Payload STRING,
    CorrelationID STRING, CriadoEm TIMESTAMP_NTZ NOT NULL
""", CriadoEm=NOW)

_table("log", "AccessLog", "AccessLogID", """
    AccessLogID BIGINT NOT NULL, UsuarioID INT, LoginEfetivo STRING NOT NULL, Acao STRING NOT NULL,
    Recurso STRING NOT NULL, IpOrigem STRING, UserAgent STRING, StatusCode SMALLINT NOT NULL, DuracaoMs INT,
    CriadoEm TIMESTAMP_NTZ NOT NULL
""", CriadoEm=NOW)

# ---- telemetry --------------------------------------------------------------
_table("telemetry", "EventType", "EventTypeID", """
    EventTypeID INT NOT NULL, EventCode STRING NOT NULL, Categoria STRING NOT NULL, Severidade SMALLINT NOT NULL,
    Ativo BOOLEAN NOT NULL, CriadoEm TIMESTAMP_NTZ NOT NULL
""", Severidade=1, Ativo=True, CriadoEm=NOW)

_table("telemetry", "SessionApp", "SessionID", """
    SessionID BIGINT NOT NULL, AlunoID INT, UsuarioID INT, ClientID STRING NOT NULL, Platform STRING NOT NULL,
    AppVersion STRING, StartedAt TIMESTAMP_NTZ NOT NULL, EndedAt TIMESTAMP_NTZ, IsAuthenticated BOOLEAN NOT NULL,
    IpAddress STRING, CountryCode STRING
""", StartedAt=NOW, IsAuthenticated=False)

_table("telemetry", "EventStream", "EventID", """
    EventID BIGINT NOT NULL, EventTypeID INT NOT NULL, SessionID BIGINT, AlunoID INT,
    OccurredAt TIMESTAMP_NTZ NOT NULL, IngestedAt TIMESTAMP_NTZ NOT NULL, SourceSystem STRING NOT NULL,
    CorrelationID STRING NOT NULL, EventKey STRING, DurationMs INT, NumericValue DECIMAL(18,4),
    BooleanValue BOOLEAN, PayloadJson STRING, ProcessingStatus STRING NOT NULL
""", OccurredAt=NOW, IngestedAt=NOW, CorrelationID=UUID, ProcessingStatus="N")

_table("telemetry", "MetricMinute", "MetricMinuteID", """
    MetricMinuteID BIGINT NOT NULL, MetricName STRING NOT NULL, MetricMinute TIMESTAMP_NTZ NOT NULL,
    Dimension1 STRING, Dimension2 STRING, MetricValue DECIMAL(18,4) NOT NULL, CreatedAt TIMESTAMP_NTZ NOT NULL
""", CreatedAt=NOW)

# ---- analytics --------------------------------------------------------------
_table("analytics", "DimTempo", "TempoKey", """
    TempoKey INT NOT NULL, DataCompleta DATE NOT NULL, Ano SMALLINT NOT NULL, Mes SMALLINT NOT NULL,
    Dia SMALLINT NOT NULL, Trimestre SMALLINT NOT NULL, SemanaAno SMALLINT NOT NULL, DiaSemana SMALLINT NOT NULL,
    NomeDia STRING NOT NULL, NomeMes STRING NOT NULL, IsFimSemana BOOLEAN NOT NULL
""")

_table("analytics", "DimCurso", "CursoKey", """
    CursoKey BIGINT NOT NULL, CursoID BIGINT NOT NULL, CodigoCurso STRING NOT NULL, NomeCurso STRING NOT NULL,
    DepartamentoSigla STRING NOT NULL, Nivel STRING NOT NULL, Modalidade STRING NOT NULL, IsCurrent BOOLEAN NOT NULL,
    EffectiveStartDate DATE NOT NULL, EffectiveEndDate DATE
""", IsCurrent=True, EffectiveStartDate=TODAY)

_table("analytics", "DimAluno", "AlunoKey", """
    AlunoKey BIGINT NOT NULL, AlunoID BIGINT NOT NULL, RA STRING NOT NULL, StatusAcademico STRING NOT NULL,
    Bolsista BOOLEAN NOT NULL, FaixaBolsa STRING NOT NULL, IsCurrent BOOLEAN NOT NULL,
    EffectiveStartDate DATE NOT NULL, EffectiveEndDate DATE
""", IsCurrent=True, EffectiveStartDate=TODAY)

_table("analytics", "DimTurma", "TurmaKey", """
    TurmaKey BIGINT NOT NULL, TurmaID BIGINT NOT NULL, CodigoTurma STRING NOT NULL, Ano SMALLINT NOT NULL,
    Periodo SMALLINT NOT NULL, Turno STRING NOT NULL, DisciplinaCodigo STRING NOT NULL,
    DisciplinaNome STRING NOT NULL, CursoID BIGINT NOT NULL, ProfessorID BIGINT NOT NULL, ProfessorNome STRING NOT NULL,
    Encerrada BOOLEAN NOT NULL
""")

_table("analytics", "FatoAcademico", "MatriculaID", """
    TempoKey INT NOT NULL, AlunoKey BIGINT NOT NULL, CursoKey BIGINT NOT NULL, TurmaKey BIGINT NOT NULL,
    MatriculaID BIGINT NOT NULL, StatusMatricula STRING NOT NULL, FrequenciaPercentual DECIMAL(5,2) NOT NULL,
    NotaFinal DECIMAL(5,2), Aprovado BOOLEAN, CargaHoraria SMALLINT NOT NULL, Creditos SMALLINT NOT NULL,
    AtualizadoEm TIMESTAMP_NTZ NOT NULL
""", AtualizadoEm=NOW)

_table("analytics", "FatoFinanceiro", "ParcelaID", """
    TempoKey INT NOT NULL, AlunoKey BIGINT NOT NULL, CursoKey BIGINT, ParcelaID BIGINT NOT NULL,
    Competencia STRING NOT NULL, StatusParcela STRING NOT NULL, ValorLiquido DECIMAL(12,2) NOT NULL,
    ValorPago DECIMAL(12,2) NOT NULL, SaldoAberto DECIMAL(12,2) NOT NULL, AtrasoDias INT NOT NULL,
    AtualizadoEm TIMESTAMP_NTZ NOT NULL
""", AtualizadoEm=NOW)

_table("analytics", "FatoTelemetria", "TempoKey", """
    TempoKey INT NOT NULL, EventTypeID INT NOT NULL, AlunoKey BIGINT, SessionID BIGINT, Eventos BIGINT NOT NULL,
    DuracaoMediaMs DECIMAL(18,2), ValorNumericoSoma DECIMAL(18,4), CriadoEm TIMESTAMP_NTZ NOT NULL
""", CriadoEm=NOW)

_table("analytics", "KPI_Diario", "DataRef", """
    DataRef DATE NOT NULL, KPIName STRING NOT NULL, KPIValue DECIMAL(18,4), Unidade STRING NOT NULL,
    MetaValor DECIMAL(18,4), RefreshTime TIMESTAMP_NTZ NOT NULL
""", RefreshTime=NOW)
