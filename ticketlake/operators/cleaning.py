"""Cleaning of landing rows. Rows are flagged first, so one pass serves both the
kept rows and the counts per file."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.columns import (
    KEY_BITS,
    coerce_date,
    exact_integer,
    key_number,
    norm_text,
    null_token,
    whole_number,
)
from ticketlake.functions.names import resolve_names, sanitize_name
from ticketlake.spec import ORIGIN, PROBLEMS, RUN_OK, TableSpec

KEPT = "_valida"
BAD_KEY = "_chave_invalida"

_WHOLE, _NUMBER = "_inteiro", "_numero"


def sanitize_columns(df: DataFrame, mapped: Sequence[str] = ()) -> DataFrame:
    """Sanitise every name that is not already a mapped one."""
    names = [c if c in mapped else sanitize_name(c) for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated or "" in names:
        raise ValueError(f"column names collide or vanish when sanitised: {repeated or ['']}")
    return df.toDF(*names)


def _read_cells(
    df: DataFrame, spec: TableSpec, columns: Sequence[str], key_present: Column | None
) -> tuple[DataFrame, Column, Column]:
    """Cells with missing values as NULL and the key as a number, plus two tests on
    them: is the row kept, and is its key out of range."""
    others = [c for c in df.columns if c not in columns]
    cells = df.select(*[null_token(c).alias(c) for c in columns], *others)
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns], F.lit(True))
    if spec.key not in columns:
        return cells, ~empty, F.lit(False)
    # Patterns are tried only where the plain cast finds no number.
    cells = cells.withColumn(_WHOLE, whole_number(spec.key))
    cells = cells.withColumn(_NUMBER, F.when(F.col(_WHOLE).isNull(), key_number(spec.key)))
    bits = KEY_BITS[spec.key_type]
    out_of_range = (F.col(_NUMBER) >= 2.0**bits) | (F.col(_NUMBER) <= -(2.0**bits) - 1)
    if bits < 63:
        out_of_range = F.coalesce(out_of_range, ~F.col(_WHOLE).between(-(2**bits), 2**bits - 1))
    # A row with a number in its key is not empty: the test looks at one column only.
    kept = F.col(_WHOLE).isNotNull() | F.col(_NUMBER).isNotNull()
    if key_present is not None:
        kept = kept | (~key_present & ~empty)
    return cells, kept, F.coalesce(out_of_range, F.lit(False))


def _typed_cells(spec: TableSpec, columns: Sequence[str], bad_key: Column) -> list[Column]:
    typed = []
    for name in columns:
        if name == spec.key:
            # Digits are cast as they are: a double would round long ones.
            number = F.col(_NUMBER)
            exact = F.when(number.isNotNull(), exact_integer(name).try_cast(spec.key_type))
            cell = F.when(
                ~bad_key, F.coalesce(F.col(_WHOLE).cast(spec.key_type), exact, number.cast(spec.key_type))
            )
        elif name in spec.date_columns:
            cell = coerce_date(name, spec.date_formats, spec.date_range)
        elif name in spec.text_date_columns:
            cell = norm_text(name)
        else:
            cell = F.col(name)
        typed.append(cell.alias(name))
    return typed


def flag_rows(
    df: DataFrame,
    spec: TableSpec = PROBLEMS,
    columns: Sequence[str] | None = None,
    key_present: Column | None = None,
) -> DataFrame:
    """Type the cells and flag the rows: kept (or rejected), and key out of range.

    ``columns`` are the data columns under their final names, all strings.
    Rejected are empty rows and rows whose key is no number. ``key_present`` tells
    for each row whether its file has the key column; rows of files without it
    are only rejected when empty.
    """
    columns = [c for c in (df.columns if columns is None else columns) if c != ORIGIN]
    others = [c for c in df.columns if c not in columns]
    cells, kept, bad_key = _read_cells(df, spec, columns, key_present)
    typed = _typed_cells(spec, columns, bad_key)
    return cells.select(*typed, *others, kept.alias(KEPT), bad_key.alias(BAD_KEY))


def map_names(df: DataFrame, spec: TableSpec = PROBLEMS, meta: Sequence[str] = (ORIGIN,)) -> DataFrame:
    """Drop junk, rename mapped and sanitise other headers of a uniform frame."""
    headers = [c for c in df.columns if c not in meta]
    resolved = resolve_names(headers, spec)
    if resolved.error:
        raise ValueError(resolved.error)
    cells = [F.col(f"`{header}`").alias(name) for name, header in resolved.sources.items()]
    return df.select(*cells, *[m for m in meta if m in df.columns])


def clean(df: DataFrame, spec: TableSpec = PROBLEMS, meta: Sequence[str] = (ORIGIN,)) -> DataFrame:
    """All cleaning steps on landing rows with one header row; kept rows only."""
    named = map_names(df, spec, meta)
    columns = [c for c in named.columns if c not in meta]
    others = [c for c in named.columns if c in meta]
    cells, kept, bad_key = _read_cells(named, spec, columns, None)
    return cells.filter(kept).select(*_typed_cells(spec, columns, bad_key), *others)


def account(flagged: DataFrame) -> DataFrame:
    """Received, kept and rejected rows per file."""
    return (
        flagged.groupBy(ORIGIN)
        .agg(
            F.count("*").alias("qt_recebidas"),
            F.count_if(KEPT).alias("qt_validas"),
        )
        .withColumn("qt_rejeitadas", F.col("qt_recebidas") - F.col("qt_validas"))
        .withColumn("ds_status", F.lit(RUN_OK))
    )
