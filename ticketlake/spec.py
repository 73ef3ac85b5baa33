"""Table specifications, schemas and fixed business values."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Fixed values -------------------------------------------------------------
ORIGIN = "nm_arquivo_origem"
# Identity of a file: its whole path. Names may repeat in other folders.
PATH = "_caminho"
CREATED = "dt_insert"
UPDATED = "dt_atualizacao"
CONTROL_COLUMNS = (CREATED, UPDATED)

CLOSED_STATUSES = ("Resolvido", "Cancelado")
CRITICAL_PRIORITY = "P1"
PRIORITY_RANKS = {"P1": 1, "P2": 2, "P3": 3}
OTHER_PRIORITY_RANK = 4

RUN_OK = "sucesso"
RUN_FAILED = "falha"
RUN_PARTIAL = "parcial"

UNKNOWN_LABEL = "Não informado"
DASH_LABEL = "—"

FILTER_COLUMNS = (
    "status",
    "prioridade",
    "jornada_impactada",
    "gerente_responsavel",
    "departamento_relator",
    "paliativo",
)

ERROR_TEXT_LIMIT = 4000
ALERT_TEXT_LIMIT = 400
STACK_LINES = 5
SETTLE_SECONDS = 3
LOG_SOURCE = "docker"

# Cell texts a spreadsheet reader takes as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
# Texts a free-text date column may still hold after trimming.
NULL_DATE_TEXTS = ("nan", "NaT", "")

# Accepted layouts of the opening date, tried in this order for every row.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy")
# Range of a nanosecond timestamp, for specifications that take dates outside as unparseable.
NANOSECOND_DATES = ("1677-09-22", "2262-04-11")


# Table specification --------------------------------------------------------
@dataclass(frozen=True)
class Column:
    """One production column; ``max_len`` is the length rule of a text column."""

    name: str
    type: T.DataType = field(default_factory=T.StringType)
    max_len: int | None = None


@dataclass(frozen=True)
class TableSpec:
    """How files with one name prefix are read, cleaned and merged.

    ``date_range`` gives the first and last date that count; by default every date does.
    """

    prefix: str
    table: str
    key: str
    columns: tuple[Column, ...]
    sheet: str | int = 0
    drop: tuple[str, ...] = ()
    rename: dict[str, str] = field(default_factory=dict)
    date_columns: tuple[str, ...] = ()
    text_date_columns: tuple[str, ...] = ()
    date_formats: tuple[str, ...] = DATE_FORMATS
    date_range: tuple[str, str] | None = None

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def key_type(self) -> T.DataType:
        return next(c.type for c in self.columns if c.name == self.key)

    @property
    def length_limits(self) -> dict[str, int]:
        return {c.name: c.max_len for c in self.columns if c.max_len is not None}

    def staging_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    def production_schema(self) -> T.StructType:
        return T.StructType(
            self.staging_schema().fields
            + [
                T.StructField(CREATED, T.TimestampNTZType(), True),
                T.StructField(UPDATED, T.TimestampNTZType(), True),
            ]
        )

    def with_key_type(self, key_type: T.DataType) -> "TableSpec":
        return replace(
            self,
            columns=tuple(
                replace(c, type=key_type) if c.name == self.key else c for c in self.columns
            ),
        )


PROBLEMS = TableSpec(
    prefix="gproblemas",
    table="tb_problemas_gov_ti",
    key="numero",
    sheet="Página4",
    columns=(
        Column("numero", T.IntegerType()),
        Column("prioridade", max_len=5),
        Column("titulo", max_len=500),
        Column("descricao"),
        Column("dt_abertura", T.DateType()),
        Column("dt_conclusao", max_len=100),
        Column("status", max_len=100),
        Column("gerente_responsavel", max_len=200),
        Column("departamento_relator", max_len=200),
        Column("jornada_impactada", max_len=200),
        Column("sistema", max_len=200),
        Column("paliativo", max_len=10),
        Column("impacto"),
        Column("status_14_04"),
        Column("status_17_04"),
        Column("status_22_04"),
        Column("status_27_04"),
        Column(ORIGIN, max_len=500),
    ),
    # Headers of the blank spreadsheet columns, in sheet order.
    drop=(" ", " .1", " .2", " .3", " .4", " .5", " .6", " .7", " .8", " .9", " .10"),
    # Spreadsheet header -> column.
    rename={
        "Número": "numero",
        "Prioridade": "prioridade",
        "Descrição": "descricao",
        "Data": "dt_abertura",
        "Status": "status",
        "Data de conclusão": "dt_conclusao",
        "Gerente responsável": "gerente_responsavel",
        "Departamento relator": "departamento_relator",
        "Jornada impactada": "jornada_impactada",
        "Título": "titulo",
        "Sistema": "sistema",
        "Paliativo": "paliativo",
        "Impacto": "impacto",
        "Status 14/04": "status_14_04",
        "Status 17/04": "status_17_04",
        "Status 22/04": "status_22_04",
        "Status 27/04": "status_27_04",
    },
    date_columns=("dt_abertura",),
    text_date_columns=("dt_conclusao",),
)

SPECS: tuple[TableSpec, ...] = (PROBLEMS,)
KNOWN_TABLES: tuple[str, ...] = ("tb_problemas_gov_ti",)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("id_log", T.LongType()),
        T.StructField("nm_arquivo", T.StringType()),
        T.StructField("nm_tabela_destino", T.StringType()),
        T.StructField("dt_processamento", T.TimestampNTZType()),
        T.StructField("qt_linhas_recebidas", T.LongType()),
        T.StructField("qt_linhas_inseridas", T.LongType()),
        T.StructField("qt_linhas_rejeitadas", T.LongType()),
        T.StructField("ds_status", T.StringType()),
        T.StructField("ds_erro", T.StringType()),
        T.StructField("tm_duracao_seg", T.DecimalType(10, 2)),
    ]
)

LOG_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("id_log", T.LongType()),
        T.StructField("fonte", T.StringType()),
        T.StructField("nivel", T.StringType()),
        T.StructField("modulo", T.StringType()),
        T.StructField("mensagem", T.StringType()),
        T.StructField("dt_evento", T.TimestampNTZType()),
        T.StructField("dt_insert", T.TimestampNTZType()),
    ]
)
