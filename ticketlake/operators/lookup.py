"""Joins with a per-file table, and row numbers that need no single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# One broadcast copy must stay small: row bound for tables with a few short columns.
BROADCAST_ROWS = 100_000
# Pieces a file's rows are split into when its lookup entry cannot be broadcast.
SALTS = 32


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Size check; reads at most ``limit + 1`` rows."""
    return df.limit(limit + 1).count() <= limit


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "inner",
    small: bool | None = None,
) -> DataFrame:
    """Join rows with a table of one row per file.

    The lookup is broadcast only if its size check passes (``small`` gives the
    result of an earlier check). Beyond the bound the join is salted: rows of one
    file spread over ``SALTS`` keys, each of which meets a copy of the file's entry.
    """
    if small is None:
        small = fits_broadcast(lookup)
    if small:
        return df.join(F.broadcast(lookup), on, how)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")
    copies = lookup.withColumn("_sal", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("_sal", salt).join(copies, [on, "_sal"], how).drop("_sal")


def _offsets(blocks: DataFrame, group: Sequence[str], block: str, total: str | None) -> DataFrame:
    """Rows before each block of its group, from one row per block with ``_rows``."""
    whole = Window.partitionBy(*group)
    before = whole.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return blocks.withColumn(total, F.sum("_rows").over(whole)) if total else blocks


def _join_blocks(rows: DataFrame, blocks: DataFrame, keys: dict[str, str]) -> DataFrame:
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()])
    return rows.join(blocks, same)


def number_blocks(
    placed: DataFrame, group: Sequence[str], block: str, seq: str, name: str, total: str | None = None
) -> DataFrame:
    """Dense numbers 1..n per group, for rows already sequenced inside blocks.

    ``seq`` grows by one from row to row of a block; blocks are ordered by
    ``block``. Only one row per block meets in the window that adds up the
    block sizes, so a group of any size is numbered in parallel.
    """
    keys = {c: f"_de_{c}" for c in [*group, block]}
    blocks = placed.groupBy(*[F.col(c).alias(k) for c, k in keys.items()]).agg(
        F.min(seq).alias("_first"), F.count("*").alias("_rows")
    )
    blocks = _offsets(blocks, [keys[c] for c in group], keys[block], total)
    number = (F.col("_offset") + F.col(seq) - F.col("_first") + 1).cast("long")
    kept = [c for c in placed.columns if c not in (block, seq)]
    return _join_blocks(placed, blocks, keys).select(*kept, number.alias(name), *([total] if total else []))


def number_rows(
    df: DataFrame, order: Sequence[str], name: str, group: Sequence[str] = (), block: Column | None = None
) -> DataFrame:
    """Dense row numbers per group in a total order.

    ``block`` is a coarse value that grows with the order, such as the hour of a time: rows
    are numbered inside blocks, which are then shifted by the sizes of the blocks before, so
    a task holds one block at most. Without it a group is one block.
    """
    rows = df.withColumn("_bloco", F.lit(0) if block is None else block)
    keys = {c: f"_de_{c}" for c in [*group, "_bloco"]}
    blocks = rows.groupBy(*[F.col(c).alias(k) for c, k in keys.items()]).agg(F.count("*").alias("_rows"))
    blocks = _offsets(blocks, [keys[c] for c in group], keys["_bloco"], None)
    inside = F.row_number().over(Window.partitionBy(*group, "_bloco").orderBy(*order))
    numbered = _join_blocks(rows.withColumn("_seq", inside), blocks, keys)
    return numbered.select(*df.columns, (F.col("_offset") + F.col("_seq")).cast("long").alias(name))
