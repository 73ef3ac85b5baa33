"""Audit rows, alerts and file outcomes, all as one row per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.spec import (
    ALERT_TEXT_LIMIT,
    ERROR_TEXT_LIMIT,
    ORIGIN,
    RUN_FAILED,
    RUN_OK,
)

DONE_FOLDER = "processados"
ERROR_FOLDER = "erros"
_CLOCK = "yyyy-MM-dd HH:mm:ss"


def audit_rows(
    results: DataFrame,
    table: str,
    ts: Column,
    seconds: Column | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One run row per file, without ``id_log``; ``carry`` names columns to keep as well.

    ``results`` has the file, ``qt_recebidas``, ``qt_validas``, ``qt_inseridas``,
    ``qt_atualizadas`` and ``ds_erro``. A failed file counts as all rejected.
    """
    failed = F.col("ds_erro").isNotNull()
    changed = F.coalesce(F.col("qt_inseridas"), F.lit(0)) + F.coalesce(F.col("qt_atualizadas"), F.lit(0))
    seconds = F.lit(None) if seconds is None else seconds
    return results.select(
        F.col(ORIGIN).alias("nm_arquivo"),
        F.lit(table).alias("nm_tabela_destino"),
        ts.cast("timestamp_ntz").alias("dt_processamento"),
        F.col("qt_recebidas").cast("long").alias("qt_linhas_recebidas"),
        F.when(failed, 0).otherwise(changed).cast("long").alias("qt_linhas_inseridas"),
        F.when(failed, F.col("qt_recebidas"))
        .otherwise(F.col("qt_recebidas") - F.col("qt_validas"))
        .cast("long")
        .alias("qt_linhas_rejeitadas"),
        F.when(failed, RUN_FAILED).otherwise(RUN_OK).alias("ds_status"),
        F.substring("ds_erro", 1, ERROR_TEXT_LIMIT).alias("ds_erro"),
        F.bround(seconds.cast("double"), 2).cast("decimal(10,2)").alias("tm_duracao_seg"),
        *carry,
    )


def disposition(runs: DataFrame, ts: Column) -> DataFrame:
    """Folder each processed file belongs in: by month when it went well."""
    month = F.concat(F.lit(f"{DONE_FOLDER}/"), F.date_format(ts, "yyyy-MM"))
    return runs.select(
        "nm_arquivo",
        "ds_status",
        F.when(F.col("ds_status") == RUN_OK, month).otherwise(ERROR_FOLDER).alias("nm_destino"),
        *[c for c in runs.columns if c == "nm_caminho"],
    )


def alert_rows(runs: DataFrame, ts: Column) -> DataFrame:
    """One message per file: row count of a good run, error of a failed one."""
    clock = F.date_format(ts, _CLOCK)
    good = F.format_string("%s carregado em %s, linhas novas: %d", "nm_arquivo", clock, "qt_linhas_inseridas")
    bad = F.format_string("%s recusado em %s: %s", "nm_arquivo", clock, "ds_erro")
    return runs.select(
        "nm_arquivo",
        "ds_status",
        F.when(F.col("ds_status") == RUN_OK, good).otherwise(bad).alias("ds_mensagem"),
    )


def unknown_table_alerts(files: DataFrame, ts: Column) -> DataFrame:
    """Message per file whose route names a table that is not registered."""
    clock = F.date_format(ts, _CLOCK)
    text = F.format_string("%s recusado em %s: tabela %s sem cadastro", ORIGIN, clock, "tabela")
    return files.select(
        F.col(ORIGIN).alias("nm_arquivo"),
        F.lit(RUN_FAILED).alias("ds_status"),
        text.alias("ds_mensagem"),
    )


def log_alert(events: DataFrame, order: tuple[str, ...] = ("log_file", "line_no")) -> DataFrame:
    """One row if there are ERROR events: how many, and the first message's start."""
    errors = events.filter(F.col("nivel") == "ERROR")
    first = F.min_by("mensagem", F.struct(*order))
    return errors.agg(
        F.count("*").alias("qt_erros"), F.substring(first, 1, ALERT_TEXT_LIMIT).alias("ds_amostra")
    ).filter("qt_erros > 0")


def replay_tally(runs: DataFrame, left_alone: DataFrame | None = None) -> DataFrame:
    """Good and failed files of a replay; files that no table takes count as failed."""
    good = runs.select((F.col("ds_status") == RUN_OK).alias("_bom"))
    if left_alone is not None:
        good = good.unionByName(left_alone.select(F.lit(False).alias("_bom")))
    return good.agg(
        F.count_if("_bom").alias("qt_sucesso"),
        F.count_if(~F.col("_bom")).alias("qt_falha"),
    )
