"""Dashboard filters: optional equality clauses and cross-filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.columns import equals_text
from ticketlake.spec import FILTER_COLUMNS, UNKNOWN_LABEL


class NullOr(str):
    """Filter value that selects NULL as well as the text itself."""


def apply_filters(df: DataFrame, **params: str | None) -> DataFrame:
    """Keep rows equal to every given parameter; an unset one adds no clause.

    Compares the raw column: a NULL row is only selected by a ``NullOr`` value.
    """
    unknown = sorted(set(params) - set(FILTER_COLUMNS))
    if unknown:
        raise ValueError(f"unknown filters: {unknown}")
    for column, value in params.items():
        if value is None:
            continue
        clause = equals_text(column, value)
        if isinstance(value, NullOr):
            clause = clause | F.col(column).isNull()
        df = df.filter(clause)
    return df


# Charts that can be clicked, and the column each one shows.
CROSS_FILTER_COLUMNS = {
    "by_status": "status",
    "by_priority": "prioridade",
    "by_journey": "jornada_impactada",
    "by_workaround": "paliativo",
    "by_manager": "gerente_responsavel",
    "by_department": "departamento_relator",
}


def cross_filter(card: str, value: str | None) -> dict[str, str]:
    """Filter parameters set by picking one group of a chart.

    The label of the NULL group selects all rows shown under it, NULL rows too;
    so does picking an unlabelled NULL group.
    """
    if value is None or value == UNKNOWN_LABEL:
        value = NullOr(UNKNOWN_LABEL)
    return {CROSS_FILTER_COLUMNS[card]: value}
