"""Checks that fail a whole file, and the split into good and bad files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.operators.cleaning import BAD_KEY, KEPT
from ticketlake.operators.lookup import fits_broadcast, join_lookup
from ticketlake.spec import ORIGIN, PROBLEMS, RUN_OK, TableSpec

ERROR = "ds_erro"
# Flag of rows with filled cells beyond their header.
SURPLUS = "_excedente"


def _limits(df: DataFrame, spec: TableSpec) -> dict[str, int]:
    return {c: n for c, n in spec.length_limits.items() if c in df.columns}


def violations(rows: DataFrame, spec: TableSpec = PROBLEMS, by: str = ORIGIN) -> DataFrame:
    """Text columns with a value longer than the table allows, per file.

    Only the longest length per file and column is shuffled.
    """
    limits = _limits(rows, spec)
    longest = rows.groupBy(by).agg(*[F.max(F.length(c)).alias(f"_max_{c}") for c in limits])
    found = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("coluna"),
                    F.col(f"_max_{c}").alias("tamanho"),
                    F.lit(n).alias("limite"),
                )
                for c, n in limits.items()
            ]
        ),
        lambda v: v["tamanho"] > v["limite"],
    )
    return longest.select(by, F.inline(found))


def file_checks(flagged: DataFrame, spec: TableSpec = PROBLEMS, by: str = ORIGIN) -> DataFrame:
    """Row counts and rule violations per file in one pass over flagged rows."""
    limits = _limits(flagged, spec)
    kept = F.col(KEPT)
    keyed = F.count(F.when(kept, F.col(spec.key))) if spec.key in flagged.columns else F.lit(0).cast("long")
    wide = F.count_if(SURPLUS) if SURPLUS in flagged.columns else F.lit(0).cast("long")
    stats = flagged.groupBy(by).agg(
        F.count("*").alias("qt_recebidas"),
        F.count_if(kept).alias("qt_validas"),
        keyed.alias("qt_com_chave"),
        wide.alias("_excedentes"),
        F.count_if(kept & F.col(BAD_KEY)).alias("_chaves_invalidas"),
        *[F.max(F.when(kept, F.length(c))).alias(f"_max_{c}") for c in limits],
    )
    too_long = [
        F.when(
            F.col(f"_max_{c}") > n,
            F.format_string(f"coluna {c}: %d caracteres, limite {n}", F.col(f"_max_{c}")),
        )
        for c, n in limits.items()
    ]
    bad_keys = F.when(
        F.col("_chaves_invalidas") > 0,
        F.format_string(f"coluna {spec.key}: %d valor(es) fora da faixa", "_chaves_invalidas"),
    )
    surplus = F.when(
        F.col("_excedentes") > 0, F.format_string("%d linha(s) com mais células que o cabeçalho", "_excedentes")
    )
    text = F.concat_ws("; ", *too_long, bad_keys, surplus)
    return stats.select(
        by,
        "qt_recebidas",
        "qt_validas",
        "qt_com_chave",
        (F.col("qt_recebidas") - F.col("qt_validas")).alias("qt_rejeitadas"),
        F.when(text != "", text).alias(ERROR),
    )


def duplicate_keys(rows: DataFrame, key: str = PROBLEMS.key, by: str = ORIGIN) -> DataFrame:
    """Keys that occur more than once in one file.

    Grouped by file and key together, so neither a large file nor a key common
    to many files gathers in one task.
    """
    return (
        rows.filter(F.col(key).isNotNull())
        .groupBy(by, key)
        .agg(F.count("*").alias("qt"))
        .filter("qt > 1")
    )


def duplicate_errors(rows: DataFrame, key: str = PROBLEMS.key, by: str = ORIGIN) -> DataFrame:
    """One error text per file that repeats a key."""
    return (
        duplicate_keys(rows, key, by)
        .groupBy(by)
        .agg(F.count("*").alias("_chaves"), F.min(key).alias("_exemplo"))
        .select(
            by,
            F.format_string(
                "chave repetida no arquivo: %d chave(s), por exemplo %s",
                "_chaves",
                F.col("_exemplo").cast("string"),
            ).alias(ERROR),
        )
    )


def is_good(status: Column | str = "ds_status") -> Column:
    return (F.col(status) if isinstance(status, str) else status) == RUN_OK


def split_files(
    rows: DataFrame, bad_files: DataFrame, by: str = ORIGIN
) -> tuple[DataFrame, DataFrame]:
    """Rows of good files and rows of bad files; one bad file never blocks others."""
    bad = bad_files.select(by).distinct()
    small = fits_broadcast(bad)
    return (
        join_lookup(rows, bad, by, "left_anti", small),
        join_lookup(rows, bad, by, "left_semi", small),
    )


def to_staging(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the shape of ``schema``; columns the file lacks become NULL.

    Columns outside the schema stay at the end as they are.
    """
    extra = [c for c in rows.columns if c not in schema.names]
    aligned = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return rows.select(*aligned, *extra)
