"""KPI views and dashboard cards over the production and audit tables.

Texts compare without case and trailing blanks. Grouping stays cheap all the
same: rows are counted by their raw text first (hash aggregate with map-side
combine), and only the few groups left are folded by the comparison key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.columns import (
    ci_key,
    equals_text,
    fmt_day,
    is_open,
    is_p1_open,
    label_null,
    ntz,
    priority_rank,
)
from ticketlake.operators.filters import apply_filters
from ticketlake.session import Scratch, materialize
from ticketlake.spec import DASH_LABEL, RUN_FAILED, RUN_OK, RUN_PARTIAL, UNKNOWN_LABEL

OPEN_COLUMNS = (
    "numero", "prioridade", "titulo", "status", "dt_abertura", "gerente_responsavel",
    "departamento_relator", "jornada_impactada", "sistema", "paliativo", "impacto",
)


# Counts per group -------------------------------------------------------------
def _fold(raw: DataFrame, column: str, *counts: str) -> DataFrame:
    return (
        raw.groupBy(ci_key(column).alias("_chave"))
        .agg(F.min(column).alias(column), *[F.sum(c).alias(c) for c in counts])
        .select(column, *counts)
    )


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; NULL is one group."""
    raw = df.groupBy(column).agg(F.count("*").alias("qt_problemas"))
    return _fold(raw, column, "qt_problemas")


def count_open_by(df: DataFrame, column: str, label: str = UNKNOWN_LABEL) -> DataFrame:
    """Rows and open rows per value; the NULL group is labelled after grouping."""
    raw = df.groupBy(column).agg(
        F.count("*").alias("qt_problemas"), F.count_if(is_open()).alias("qt_abertos")
    )
    folded = _fold(raw, column, "qt_problemas", "qt_abertos")
    return folded.withColumn(column, label_null(column, label))


def card_by(
    df: DataFrame, column: str, label: str | None = None, order: str | None = "count"
) -> DataFrame:
    """Chart rows: counts per value, by count downwards, by value, or unordered.

    The value breaks ties of the count, so the order is repeatable.
    """
    counted = count_by(df, column)
    if order == "count":
        counted = counted.orderBy(F.desc("qt_problemas"), F.asc(column))
    elif order == "value":
        counted = counted.orderBy(F.asc(column))
    return counted.withColumn(column, label_null(column, label)) if label else counted


# Scalars -------------------------------------------------------------------------
def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def open_total(df: DataFrame) -> DataFrame:
    return df.filter(is_open()).agg(F.count("*").alias("abertos"))


def p1_open_total(df: DataFrame) -> DataFrame:
    return df.filter(is_p1_open()).agg(F.count("*").alias("p1_abertos"))


# Tables of open problems ----------------------------------------------------------
def open_problems(df: DataFrame) -> DataFrame:
    return df.filter(is_open()).select(*OPEN_COLUMNS)


def open_table_basic(df: DataFrame) -> DataFrame:
    """Open problems by priority and opening date (the date itself, not its text)."""
    return (
        df.filter(is_open())
        .select(
            "numero", "prioridade", "titulo", "status", "dt_abertura",
            "gerente_responsavel", "departamento_relator", "sistema",
        )
        .orderBy("prioridade", "dt_abertura", "numero")
        .withColumn("dt_abertura", fmt_day("dt_abertura"))
    )


def open_table_exec(df: DataFrame, only_open: bool = True, ordered: bool = True) -> DataFrame:
    """Problem table with dashes for missing texts, most urgent and oldest first."""
    labelled = ("jornada_impactada", "gerente_responsavel", "departamento_relator", "paliativo")
    rows = df.filter(is_open()) if only_open else df
    rows = rows.select("numero", "prioridade", "titulo", "status", "dt_abertura", *labelled)
    if ordered:
        rows = rows.orderBy(priority_rank(), "dt_abertura", "numero")
    return rows.withColumns(
        {
            "dt_abertura": fmt_day("dt_abertura"),
            **{c: label_null(c, DASH_LABEL) for c in labelled},
        }
    )


# Executive cards -------------------------------------------------------------------
Card = Callable[[DataFrame], DataFrame]

BASIC_CARDS: dict[str, Card] = {
    "by_status": lambda df: card_by(df, "status"),
    "by_priority": lambda df: card_by(df, "prioridade", order="value"),
    "by_manager": lambda df: card_by(df, "gerente_responsavel"),
    "by_department": lambda df: card_by(df, "departamento_relator"),
    "by_system": lambda df: card_by(df, "sistema"),
    "open_table": open_table_basic,
}

EXEC_CARDS: dict[str, Card] = {
    "total": total,
    "open_total": open_total,
    "p1_open": p1_open_total,
    "by_status": lambda df: card_by(df, "status"),
    "by_priority": lambda df: card_by(df, "prioridade", order="value"),
    "by_journey": lambda df: card_by(df, "jornada_impactada", UNKNOWN_LABEL),
    "by_workaround": lambda df: card_by(df, "paliativo", UNKNOWN_LABEL, order=None),
    "by_manager": lambda df: card_by(df, "gerente_responsavel", UNKNOWN_LABEL),
    "by_department": lambda df: card_by(df, "departamento_relator", UNKNOWN_LABEL),
    "open_table": open_table_exec,
}

# The parameterised versions: the same results without an order, and the table of
# problems not limited to open ones.
FILTERED_CARDS: dict[str, Card] = {
    "total": total,
    "open_total": open_total,
    "p1_open": p1_open_total,
    "by_status": lambda df: card_by(df, "status", order=None),
    "by_priority": lambda df: card_by(df, "prioridade", order=None),
    "by_journey": lambda df: card_by(df, "jornada_impactada", UNKNOWN_LABEL, None),
    "by_workaround": lambda df: card_by(df, "paliativo", UNKNOWN_LABEL, None),
    "by_manager": lambda df: card_by(df, "gerente_responsavel", UNKNOWN_LABEL, None),
    "by_department": lambda df: card_by(df, "departamento_relator", UNKNOWN_LABEL, None),
    "open_table": lambda df: open_table_exec(df, only_open=False, ordered=False),
}


def filtered(card: str, df: DataFrame, **params: str | None) -> DataFrame:
    """An executive card over the rows the filters leave."""
    return FILTERED_CARDS[card](apply_filters(df, **params))


# Charts of the dashboard: column, and label of its NULL group.
CHARTS: dict[str, tuple[str, str | None]] = {
    "by_status": ("status", None),
    "by_priority": ("prioridade", None),
    "by_journey": ("jornada_impactada", UNKNOWN_LABEL),
    "by_workaround": ("paliativo", UNKNOWN_LABEL),
    "by_manager": ("gerente_responsavel", UNKNOWN_LABEL),
    "by_department": ("departamento_relator", UNKNOWN_LABEL),
}
# Cards of one number, and the count they show; the table of problems counts its rows.
SCALARS = {"total": "_n", "open_total": "_abertos", "p1_open": "_p1", "open_table": "_n"}
_CARD = "card string, _chave string, label string, qt long"


def dashboard_counts(df: DataFrame, **params: str | None) -> DataFrame:
    """(card, label, qt) of all ten cards over one set of filters, from one scan.

    Rows are counted once by all chart columns together; grouping sets over those few groups
    give every chart and the totals. A card of one number has no label, and is 0 if no row
    is left.
    """
    columns = [c for c, _ in CHARTS.values()]
    keys = [f"_k_{c}" for c in columns]
    rows = apply_filters(df, **params).groupBy(*columns).agg(
        F.count("*").alias("_n"), F.count_if(is_open()).alias("_abertos"), F.count_if(is_p1_open()).alias("_p1")
    )
    keyed = rows.withColumns({k: ci_key(c) for k, c in zip(keys, columns, strict=True)})
    sets = keyed.groupingSets([[], *[[k] for k in keys]], *keys).agg(
        F.grouping_id().alias("_conjunto"),
        *[F.min(c).alias(c) for c in columns],
        *[F.sum(c).alias(c) for c in ("_n", "_abertos", "_p1")],
    )

    def cell(card: str, key: Column, label: Column, count: str) -> Column:
        values = (F.lit(card).alias("card"), key.alias("_chave"), label.alias("label"), F.col(count).alias("qt"))
        return F.struct(*values)

    none = F.lit(None).cast("string")
    # The id has a bit per column, set where the column is not grouped by.
    every = 2 ** len(keys) - 1
    cells = F.when(F.col("_conjunto") == every, F.array(*[cell(n, none, none, c) for n, c in SCALARS.items()]))
    for i, (name, (column, label)) in enumerate(CHARTS.items()):
        shown = label_null(column, label) if label else F.col(column)
        chart = F.array(cell(name, F.col(keys[i]), shown, "_n"))
        cells = cells.when(F.col("_conjunto") == every - 2 ** (len(keys) - 1 - i), chart)
    zeros = df.sparkSession.createDataFrame([(n, None, None, 0) for n in SCALARS], _CARD)
    found = sets.select(F.inline(cells)).unionByName(zeros)
    # A NULL group and the text of its label stay two rows.
    return found.groupBy("card", "_chave", "label").agg(F.sum("qt").alias("qt")).drop("_chave")


def dashboard(df: DataFrame, scratch: Scratch | None = None, **params: str | None) -> dict[str, DataFrame]:
    """All executive cards over one set of filters; all but the table of problems are cut
    from one aggregate, which is written once."""
    counts = materialize(dashboard_counts(df, **params), "dashboard", scratch)
    cards = {"open_table": filtered("open_table", df, **params)}
    names = {"total": "total", "open_total": "abertos", "p1_open": "p1_abertos"}
    for card, name in names.items():
        cards[card] = counts.filter(F.col("card") == card).select(F.col("qt").alias(name))
    for card, (column, _) in CHARTS.items():
        chart = counts.filter(F.col("card") == card)
        cards[card] = chart.select(F.col("label").alias(column), F.col("qt").alias("qt_problemas"))
    return cards


# Audit KPIs ---------------------------------------------------------------------------
def pipeline_health(runs: DataFrame) -> DataFrame:
    """Runs, outcomes, row sums and mean seconds per day."""

    def runs_with(status: str) -> Column:
        return F.count_if(equals_text("ds_status", status))

    return runs.groupBy(F.to_date("dt_processamento").alias("dt_execucao")).agg(
        F.count("*").alias("qt_execucoes"),
        runs_with(RUN_OK).alias("qt_sucesso"),
        runs_with(RUN_FAILED).alias("qt_falha"),
        runs_with(RUN_PARTIAL).alias("qt_parcial"),
        F.sum("qt_linhas_recebidas").alias("total_linhas_recebidas"),
        F.sum("qt_linhas_inseridas").alias("total_linhas_inseridas"),
        F.sum("qt_linhas_rejeitadas").alias("total_linhas_rejeitadas"),
        F.avg("tm_duracao_seg").alias("media_duracao_seg"),
    )


def health_card(runs: DataFrame) -> DataFrame:
    """Pipeline health with the day as text, newest day first."""
    return (
        pipeline_health(runs)
        .orderBy(F.desc("dt_execucao"))
        .select(
            fmt_day("dt_execucao").alias("data"),
            "qt_execucoes",
            "qt_sucesso",
            "qt_falha",
            "total_linhas_inseridas",
            F.round("media_duracao_seg", 2).alias("media_seg"),
        )
    )


def runs_on(runs: DataFrame, day: dt.date) -> DataFrame:
    """Runs of one day, as a half-open time range that reaches the file scan."""
    start = dt.datetime.combine(day, dt.time())
    end = start + dt.timedelta(days=1)
    time = F.col("dt_processamento")
    return runs.filter((time >= ntz(start)) & (time < ntz(end)))


def daily_summary(runs: DataFrame, day: dt.date) -> DataFrame:
    """Runs of one day in time order."""
    return (
        runs_on(runs, day)
        .orderBy("dt_processamento", "id_log")
        .select(
            "nm_arquivo", "nm_tabela_destino", "qt_linhas_recebidas", "qt_linhas_inseridas",
            "qt_linhas_rejeitadas", "ds_status", "ds_erro", "tm_duracao_seg",
        )
    )


def daily_totals(runs: DataFrame, day: dt.date) -> DataFrame:
    """Rows received and inserted on one day, and runs that did not go well."""

    def summed(column: str) -> Column:
        return F.coalesce(F.sum(F.coalesce(F.col(column), F.lit(0))), F.lit(0))

    return runs_on(runs, day).agg(
        summed("qt_linhas_recebidas").alias("total_recebidas"),
        summed("qt_linhas_inseridas").alias("total_inseridas"),
        F.count_if(~F.col("ds_status").eqNullSafe(RUN_OK)).alias("total_falhas"),
    )


# Named views --------------------------------------------------------------------------
PROBLEM_VIEWS: dict[str, Card] = {
    "vw_problemas_por_status": lambda df: count_by(df, "status"),
    "vw_problemas_por_prioridade": lambda df: count_by(df, "prioridade"),
    "vw_problemas_por_gerente": lambda df: count_by(df, "gerente_responsavel"),
    "vw_problemas_por_departamento": lambda df: count_by(df, "departamento_relator"),
    "vw_problemas_por_sistema": lambda df: count_by(df, "sistema"),
    "vw_problemas_abertos": open_problems,
    "vw_problemas_por_jornada": lambda df: count_open_by(df, "jornada_impactada"),
    "vw_problemas_por_paliativo": lambda df: count_open_by(df, "paliativo"),
}


def register_views(problems: DataFrame, runs: DataFrame) -> list[str]:
    """Temporary views for SQL users: both tables and the nine KPI views."""
    problems.createOrReplaceTempView("tb_problemas_gov_ti")
    runs.createOrReplaceTempView("tb_log_etl")
    for name, view in PROBLEM_VIEWS.items():
        view(problems).createOrReplaceTempView(name)
    pipeline_health(runs).createOrReplaceTempView("vw_pipeline_health")
    return ["tb_problemas_gov_ti", "tb_log_etl", *PROBLEM_VIEWS, "vw_pipeline_health"]
