"""Which table a file belongs to, by the start of its name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.columns import is_workbook
from ticketlake.spec import KNOWN_TABLES, ORIGIN, SPECS, TableSpec

ROUTED = "roteado"
NO_PREFIX = "sem_prefixo"
UNKNOWN_TABLE = "tabela_desconhecida"


def prefix_of(name: Column, specs: Sequence[TableSpec] = SPECS) -> Column:
    """First prefix in configuration order that starts the name, case ignored."""
    lowered = F.lower(name)
    chain = None
    for spec in specs:
        test = lowered.startswith(spec.prefix.lower())
        chain = F.when(test, spec.prefix) if chain is None else chain.when(test, spec.prefix)
    return F.lit(None).cast("string") if chain is None else chain


def with_route(
    files: DataFrame,
    specs: Sequence[TableSpec] = SPECS,
    known_tables: Sequence[str] = KNOWN_TABLES,
    name: str = ORIGIN,
) -> DataFrame:
    """Add prefix, target table and route state to every file row."""
    prefix = prefix_of(F.col(name), specs)
    table = None
    for spec in specs:
        test = F.col("prefixo") == spec.prefix
        table = F.when(test, spec.table) if table is None else table.when(test, spec.table)
    if table is None:
        table = F.lit(None).cast("string")
    state = (
        F.when(F.col("prefixo").isNull(), NO_PREFIX)
        .when(F.col("tabela").isin(*known_tables), ROUTED)
        .otherwise(UNKNOWN_TABLE)
    )
    return files.withColumn("prefixo", prefix).withColumn("tabela", table).withColumn("rota", state)


def route(
    files: DataFrame,
    specs: Sequence[TableSpec] = SPECS,
    known_tables: Sequence[str] = KNOWN_TABLES,
    name: str = ORIGIN,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split files into routed ones, ones to leave alone and ones that need an alert.

    Neither of the last two gets an audit row; both stay where they are.
    """
    routed = with_route(files, specs, known_tables, name)
    return (
        routed.filter(F.col("rota") == ROUTED),
        routed.filter(F.col("rota") == NO_PREFIX),
        routed.filter(F.col("rota") == UNKNOWN_TABLE),
    )


def workbooks_only(files: DataFrame, name: str = ORIGIN) -> DataFrame:
    return files.filter(is_workbook(name))
