"""Upsert by business key and additive schema evolution.

``MERGE INTO`` needs a table format with row-level changes; on Parquet the same
result is one full outer join on the key. Both sides have unique keys by then
(the batch is reduced to one row per key before the join), so no key can be hot.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.functions.columns import has_key
from ticketlake.operators.cleaning import KEPT
from ticketlake.operators.quality import to_staging
from ticketlake.spec import CONTROL_COLUMNS, CREATED, ORIGIN, PROBLEMS, UPDATED, TableSpec

ACTION = "_acao"
INSERTED = "INSERT"
CHANGED = "UPDATE"
FIRST_FILE = "_primeiro_arquivo"
OCCURRENCES = "_ocorrencias"
ABSENT = "_ausentes"


def new_columns(target: Sequence[str], source: Sequence[str]) -> list[str]:
    """Columns of the source the target lacks, sorted, without control columns."""
    existing = {c.lower() for c in target}
    return sorted(c for c in set(source) - existing - set(CONTROL_COLUMNS) if not c.startswith("_"))


def evolve(df: DataFrame, new: Sequence[str]) -> DataFrame:
    """Add nullable text columns; existing columns are never dropped or retyped."""
    return df.withColumns({c: F.lit(None).cast("string") for c in new})


def _business_columns(target: DataFrame, key: str) -> list[str]:
    return [c for c in target.columns if c != key and c not in CONTROL_COLUMNS]


def _merged_columns(
    target: DataFrame, key: str, ts: Column, keep: Column | None, repeated: Column
) -> list[Column]:
    """Output expressions over target columns and source columns named ``_s_...``."""
    hit_source = F.col(f"_s_{key}").isNotNull()
    hit_target = F.col(key).isNotNull()
    columns = [F.coalesce(F.col(f"_s_{key}"), F.col(key)).alias(key)]
    for name in target.columns:
        if name == key:
            continue
        if name == CREATED:
            column = F.when(hit_target, F.col(CREATED)).otherwise(ts)
        elif name == UPDATED:
            column = F.when(hit_source & (hit_target | repeated), ts).otherwise(F.col(UPDATED))
        else:
            column = F.when(hit_source, F.col(f"_s_{name}")).otherwise(F.col(name))
            if keep is not None:
                kept = hit_target & F.array_contains(keep, name)
                column = F.when(kept, F.col(name)).otherwise(column)
        columns.append(column.alias(name))
    action = F.when(hit_source, F.when(hit_target, CHANGED).otherwise(INSERTED))
    return [*columns, action.alias(ACTION)]


def _join(
    target: DataFrame,
    source: DataFrame,
    key: str,
    ts: Column,
    extra: Collection[str],
    keep_missing: bool,
    broadcast_source: bool,
) -> DataFrame:
    source_key = f"_s_{key}"
    payload = [key, *_business_columns(target, key)]
    packed = source.select(*[F.col(c).alias(f"_s_{c}") for c in payload], *extra)
    keep = F.coalesce(F.col(ABSENT), F.array().cast("array<string>")) if keep_missing else None
    repeated = F.coalesce(F.col(OCCURRENCES) > 1, F.lit(False)) if OCCURRENCES in extra else F.lit(False)
    shown = [FIRST_FILE] if FIRST_FILE in extra else []
    result = [*_merged_columns(target, key, ts, keep, repeated), *shown]
    if not broadcast_source:
        joined = target.join(packed, target[key] == packed[source_key], "full_outer")
        return joined.select(*result)
    # Small batch: the target streams past the batch and is never shuffled; the
    # second pass reads only its key column.
    small = F.broadcast(packed)
    updated = target.join(small, target[key] == small[source_key], "left").select(*result)
    present = (
        target.select(F.col(key).alias(source_key))
        .join(F.broadcast(packed.select(source_key)), source_key, "left_semi")
    )
    added = packed.join(F.broadcast(present), source_key, "left_anti")  # no more than the batch
    no_target = {c: F.lit(None).cast(target.schema[c].dataType) for c in target.columns}
    return updated.unionByName(added.withColumns(no_target).select(*result))


def _prepare(target: DataFrame, source: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Give both sides all columns of either one."""
    target = evolve(target, new_columns(target.columns, source.columns))
    missing = [c for c in _business_columns(target, key) if c not in source.columns]
    source = source.withColumns({c: F.lit(None).cast(target.schema[c].dataType) for c in missing})
    casts = {
        c: F.col(c).cast(target.schema[c].dataType)
        for c in [key, *_business_columns(target, key)]
        if source.schema[c].dataType != target.schema[c].dataType
    }
    return target, source.withColumns(casts) if casts else source


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    ts: Column,
    keep_missing: bool = False,
    broadcast_source: bool = False,
) -> DataFrame:
    """Target after the upsert of a source with unique keys, plus the action taken.

    A matched row takes every source value, NULL and unchanged ones too, and
    columns the source lacks are emptied. ``keep_missing`` leaves those alone.
    ``broadcast_source`` is for a batch whose size was checked.
    """
    provided = source.columns
    target, source = _prepare(target, source.filter(has_key(key)), key)
    extra: list[str] = []
    if keep_missing:
        absent = [c for c in _business_columns(target, key) if c not in provided]
        source = source.withColumn(ABSENT, F.array(*[F.lit(c) for c in absent]).cast("array<string>"))
        extra = [ABSENT]
    return _join(target, source, key, ts, extra, keep_missing, broadcast_source)


def latest_per_key(
    rows: DataFrame, key: str, order: Sequence[str], keep_missing: bool = False, by: str = ORIGIN
) -> DataFrame:
    """One row per key over a batch of files: last values, first file, occurrences.

    One window sorts the rows of a key by arrival; no aggregate carries the payload. A key is
    in a good file once, so a key has no more rows than the batch has files.
    """
    payload = [c for c in rows.columns if c not in (key, *order) and not c.startswith("_")]
    payload = list(dict.fromkeys([*payload, *([ORIGIN] if ORIGIN in rows.columns else [])]))
    arrivals = Window.partitionBy(key).orderBy(*order)
    found = {
        FIRST_FILE: F.first(by).over(arrivals),
        OCCURRENCES: F.row_number().over(arrivals).cast("long"),
        "_ultima": F.lead(F.lit(True)).over(arrivals).isNull(),
    }
    if not keep_missing:
        last = rows.withColumns(found).filter("_ultima")
        return last.select(key, *payload, FIRST_FILE, OCCURRENCES)
    # Latest file that has the column, column by column.
    latest = [F.when(~F.array_contains(ABSENT, c), F.struct(F.col(c).alias("v"))) for c in payload]
    found |= {f"_de_{i}": F.last(v, ignorenulls=True).over(arrivals) for i, v in enumerate(latest)}
    last = rows.withColumns(found).filter("_ultima")
    missing = F.filter(
        F.array(*[F.when(F.col(f"_de_{i}").isNull(), F.lit(c)) for i, c in enumerate(payload)]),
        lambda c: c.isNotNull(),
    )
    values = [F.col(f"_de_{i}")["v"].alias(c) for i, c in enumerate(payload)]
    return last.select(key, *values, FIRST_FILE, OCCURRENCES, missing.alias(ABSENT))


def merge_sequence(
    target: DataFrame,
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    ts: Column,
    keep_missing: bool = False,
    broadcast_source: bool = False,
    by: str = ORIGIN,
) -> DataFrame:
    """Merge files one after the other in the given order, as one job.

    The first file (``by`` tells files apart) with a key unknown to the target inserts it,
    every later one updates it; the last one gives the values.
    """
    source = latest_per_key(rows.filter(has_key(key)), key, order, keep_missing, by)
    target, source = _prepare(target, source, key)
    extra = [FIRST_FILE, OCCURRENCES, *([ABSENT] if keep_missing else [])]
    return _join(target, source, key, ts, extra, keep_missing, broadcast_source)


def production_rows(merged: DataFrame) -> DataFrame:
    """The new table without the helper columns of the merge."""
    return merged.drop(ACTION, FIRST_FILE)


def merge_actions(
    merged: DataFrame, rows: DataFrame | None = None, key: str = PROBLEMS.key
) -> DataFrame:
    """Inserted and updated rows per file.

    For a single upsert the file is the origin of the row. After a sequence
    (``rows`` given) inserts belong to the first file of a key, and all other
    keyed rows are updates. Only key columns are read, Catalyst prunes the rest.
    """
    if rows is None:
        return (
            merged.filter(F.col(ACTION).isNotNull())
            .groupBy(ORIGIN)
            .agg(
                F.count_if(F.col(ACTION) == INSERTED).alias("qt_inseridas"),
                F.count_if(F.col(ACTION) == CHANGED).alias("qt_atualizadas"),
            )
        )
    keyed = rows.groupBy(ORIGIN).agg(F.count(key).alias("qt_com_chave"))
    return sequence_tally(merged, keyed)


def sequence_tally(written: DataFrame, keyed: DataFrame, by: str = ORIGIN) -> DataFrame:
    """Inserted and updated rows per file of a merged sequence.

    ``written`` has the action and first file of each row, ``keyed`` one row per file with
    ``qt_com_chave``.
    """
    inserted = (
        written.filter(F.col(ACTION) == INSERTED)
        .groupBy(F.col(FIRST_FILE).alias(by))
        .agg(F.count("*").alias("_ins"))
    )
    inserts = F.coalesce(F.col("_ins"), F.lit(0))
    return keyed.join(inserted, by, "left").select(
        by, inserts.alias("qt_inseridas"), (F.col("qt_com_chave") - inserts).alias("qt_atualizadas")
    )


def staged(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """Kept rows in the shape of the staging table, unseen columns at the end."""
    return to_staging(flagged.filter(KEPT).drop(KEPT), spec.staging_schema())
