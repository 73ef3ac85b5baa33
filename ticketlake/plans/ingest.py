"""From landing rows to production: one job per batch of files.

Many files run together as set logic. Checks, merge and audit work on all rows of
the batch; a file that fails a check drops out by an anti-join. Counts come from the
writes themselves: the staging write and the merge are observed, and the tally per file
reads two columns that the merge wrote.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.functions.columns import ntz
from ticketlake.functions.names import resolve_names
from ticketlake.operators.audit import alert_rows, audit_rows, disposition
from ticketlake.operators.cleaning import KEPT, flag_rows
from ticketlake.operators.lookup import number_rows
from ticketlake.operators.merge import (
    ABSENT,
    ACTION,
    CHANGED,
    FIRST_FILE,
    INSERTED,
    merge_sequence,
    production_rows,
    sequence_tally,
    staged,
)
from ticketlake.operators.quality import ERROR, duplicate_errors, file_checks, split_files
from ticketlake.session import materialize, materialize_observed, read_rows
from ticketlake.sources.landing import ARRIVAL, DIGEST, LAYOUT, SECONDS, Landing, column_places
from ticketlake.spec import AUDIT_SCHEMA, ORIGIN, PATH, PROBLEMS, TableSpec
from ticketlake.storage.snapshot import SnapshotTable

# A batch is broadcast to the merge only below this many bytes of text.
BROADCAST_BYTES = 64 * 1024 * 1024
_REFUSAL = "_recusa"
_RUN_SCHEMA = T.StructType(
    [
        *AUDIT_SCHEMA.fields,
        T.StructField("nm_caminho", T.StringType()),
        T.StructField("id_lote", T.StringType()),
    ]
)
_FILE_SCHEMA = f"{PATH} string, {DIGEST} string, id_lote string"


# Steps on rows ------------------------------------------------------------------
def _resolve(spec: TableSpec) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, places, refusals = [], [], []
            for header in batch["cabecalho"]:
                found, where = resolve_names(header, spec), {h: i for i, h in enumerate(header)}
                names.append(list(found.sources))
                places.append([where[h] for h in found.sources.values()])
                refusals.append(found.error)
            yield pd.DataFrame({LAYOUT: batch[LAYOUT], "nomes": names, "posicoes": places, _REFUSAL: refusals})

    return run


def resolve_layouts(layouts: DataFrame, spec: TableSpec) -> DataFrame:
    """Final column names of each header row and where they stand, or why it is refused."""
    schema = f"{LAYOUT} long, nomes array<string>, posicoes array<int>, {_REFUSAL} string"
    return layouts.select(LAYOUT, "cabecalho").mapInPandas(_resolve(spec), schema)


def project_landing(landing: Landing, spec: TableSpec, resolved: DataFrame) -> tuple[DataFrame, list[str]]:
    """Landing rows under their final column names, over all header layouts.

    Adds the list of table columns the row's file lacks. Rows of a file with a
    refused header keep no cells; they are only counted.
    """
    found = {r[0] for r in resolved.select(F.explode("nomes")).distinct().collect()}  # columns of the table
    columns = [n for n in spec.names if n in found] + sorted(found - set(spec.names))
    expected = [n for n in dict.fromkeys([*spec.names, *columns]) if n != ORIGIN]
    absent = F.filter(F.array(*[F.lit(n) for n in expected]), lambda n: ~F.array_contains("nomes", n))
    places = column_places(resolved, columns, absent.alias(ABSENT))
    return landing.placed(places, columns, ABSENT), columns


def file_errors(landing: Landing, resolved: DataFrame) -> DataFrame:
    """Every file, with the reason it cannot be read or its header is refused."""
    return landing.files.join(resolved.select(LAYOUT, _REFUSAL), LAYOUT, "left").select(
        PATH, F.coalesce(ERROR, _REFUSAL).alias(ERROR)
    )


def file_verdicts(
    flagged: DataFrame,
    spec: TableSpec = PROBLEMS,
    read_errors: DataFrame | None = None,
    by: str = ORIGIN,
) -> DataFrame:
    """Counts per file and the first reason to fail it, if any.

    ``read_errors`` lists every file of the batch, also those without any row,
    with the reason it could not be read. ``by`` is the column that tells files apart.
    """
    checks = file_checks(flagged, spec, by)
    repeated = duplicate_errors(staged(flagged, spec), spec.key, by).withColumnRenamed(ERROR, "_repetida")
    verdicts = checks.join(repeated, by, "left")
    reasons = [F.col(ERROR), F.col("_repetida")]
    if read_errors is not None:
        listed = read_errors.select(by, F.col(ERROR).alias("_leitura"))
        verdicts = listed.join(verdicts, by, "left")
        reasons.insert(0, F.col("_leitura"))
    counts = ("qt_recebidas", "qt_validas", "qt_com_chave", "qt_rejeitadas")
    return verdicts.select(
        by,
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce(*reasons).alias(ERROR),
    )


def run_results(verdicts: DataFrame, actions: DataFrame, by: str = ORIGIN) -> DataFrame:
    """Verdict and merge counts per file, the input of the audit rows."""
    return verdicts.join(actions, by, "left")


# Audit -------------------------------------------------------------------------------
def _committed(spark: SparkSession, audit_dir: str) -> DataFrame:
    return read_rows(spark, f"{audit_dir}/_lotes", "id_lote string").distinct()


def mark_committed(spark: SparkSession, audit_dir: str, batch_id: str) -> None:
    """Note that a batch is committed: from now on its rows count."""
    if _committed(spark, audit_dir).filter(F.col("id_lote") == batch_id).isEmpty():
        mark = spark.createDataFrame([(batch_id,)], "id_lote string").coalesce(1)
        mark.write.mode("append").parquet(f"{audit_dir}/_lotes")


def read_audit(spark: SparkSession, audit_dir: str) -> DataFrame:
    """Run rows of all committed batches; empty before the first one.

    Rows that a refused or interrupted batch left behind are not shown.
    """
    return read_rows(spark, audit_dir, _RUN_SCHEMA).join(_committed(spark, audit_dir), "id_lote", "left_semi").select(
        *_RUN_SCHEMA.names
    )


def known_files(spark: SparkSession, audit_dir: str) -> DataFrame:
    """Path and content digest of every file that committed batches took in."""
    files = read_rows(spark, f"{audit_dir}/_arquivos", _FILE_SCHEMA)
    return files.join(_committed(spark, audit_dir), "id_lote", "left_semi").select(PATH, DIGEST)


def append_audit(spark: SparkSession, runs: DataFrame, audit_dir: str, batch_id: str) -> DataFrame:
    """Add the batch's run rows, numbered after the highest ``id_log`` so far.

    A batch has its own folder, so writing it again after a failure replaces it.
    """
    earlier = read_audit(spark, audit_dir).filter(F.col("id_lote") != batch_id)
    last = earlier.agg(F.max("id_log")).first()[0] or 0
    numbered = number_rows(runs, [ARRIVAL, "nm_arquivo", "nm_caminho"], "id_log", block=F.date_trunc("hour", ARRIVAL))
    rows = numbered.withColumn("id_log", F.col("id_log") + last).select(*AUDIT_SCHEMA.names, "nm_caminho")
    rows.write.mode("overwrite").parquet(f"{audit_dir}/id_lote={batch_id}")
    return _batch_runs(spark, audit_dir, batch_id)


def _batch_runs(spark: SparkSession, audit_dir: str, batch_id: str) -> DataFrame:
    schema = T.StructType([f for f in _RUN_SCHEMA.fields if f.name != "id_lote"])
    return spark.read.schema(schema).parquet(f"{audit_dir}/id_lote={batch_id}")


# The batch job ---------------------------------------------------------------------
@dataclass(frozen=True)
class IngestResult:
    """Version of the table after the batch, and one row per file for each report.

    ``totals`` are the counts the writes observed; a skipped batch has none.
    """

    version: int
    skipped: bool
    runs: DataFrame
    alerts: DataFrame
    destinations: DataFrame
    totals: dict[str, Any] = field(default_factory=dict)


def _file_seconds(results: DataFrame, started: float) -> Column:
    """Seconds per file: its own reading, and its share of the batch's by rows."""
    rows, files = results.agg(F.sum("qt_recebidas"), F.count("*")).first()
    batch = (time.monotonic() - started) / ((rows or 0) + files + 1)
    return F.coalesce(F.col(SECONDS), F.lit(0.0)) + F.lit(batch) * (F.col("qt_recebidas") + 1)


def ingest_batch(
    spark: SparkSession,
    landing: Landing,
    table: SnapshotTable,
    audit_dir: str,
    batch_id: str,
    ts: dt.datetime,
    spec: TableSpec | None = None,
    keep_missing: bool = False,
) -> IngestResult:
    """Clean, check, merge and audit a batch of files of one table.

    Order of the writes: the touched buckets' new generation, audit rows, commit, mark. Until
    the commit everything can be done again under the same batch id; after it the batch is
    skipped. The landing's intermediates are removed, so it serves one call.
    """
    spec = spec or table.spec
    started = time.monotonic()
    stamp = ntz(ts)
    done = table.committed_version(spark, batch_id)
    if done is not None:
        landing.scratch.clear(spark)
        mark_committed(spark, audit_dir, batch_id)  # in case the last try ended between the two
        runs = _batch_runs(spark, audit_dir, batch_id)
        return IngestResult(done, True, runs, alert_rows(runs, stamp), disposition(runs, stamp))

    scratch = landing.scratch
    try:
        resolved = materialize(resolve_layouts(landing.layouts, spec), "layouts", scratch)
        rows, columns = project_landing(landing, spec, resolved)
        key_present = ~F.array_contains(ABSENT, spec.key)
        flagged = flag_rows(rows, spec, columns, key_present)
        texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns]
        flagged, totals = materialize_observed(
            flagged, "staging", scratch,
            qt_recebidas=F.count("*"), qt_validas=F.count_if(KEPT),
            qt_bytes=F.sum(F.when(F.col(KEPT), reduce(lambda a, b: a + b, texts, F.lit(0)).cast("long"))),
        )
        verdicts = file_verdicts(flagged, spec, file_errors(landing, resolved), PATH)
        verdicts = materialize(verdicts, "verdicts", scratch)

        good, _ = split_files(staged(flagged, spec), verdicts.filter(F.col(ERROR).isNotNull()), PATH)
        touched = table.touched(good)
        tasks = table.tasks(spark)
        version, current = table.part(spark, touched)
        small = (totals["qt_bytes"] or 0) <= BROADCAST_BYTES
        merged = merge_sequence(
            current if small else current.repartition(tasks, F.col(spec.key)),
            good.repartition(tasks, F.col(spec.key)),
            spec.key, [ARRIVAL, PATH], stamp, keep_missing, broadcast_source=small, by=PATH,
        )
        columns_after = production_rows(merged).schema
        folder = None
        tally = spark.createDataFrame([], f"{PATH} string, qt_inseridas long, qt_atualizadas long")
        if touched:
            folder, counts = table.write_observed(
                merged, version + 1,
                qt_inseridas=F.count_if(F.col(ACTION) == INSERTED), qt_atualizadas=F.count_if(F.col(ACTION) == CHANGED),
            )
            totals |= counts
            written = table.written(spark, folder, merged.select(ACTION, FIRST_FILE).schema)
            keyed = verdicts.filter(F.col(ERROR).isNull()).select(PATH, "qt_com_chave")
            tally = sequence_tally(written, keyed, PATH)
        listed = landing.files.select(PATH, ORIGIN, ARRIVAL, SECONDS, DIGEST)
        results = run_results(verdicts, tally, PATH).join(listed, PATH)
        results = materialize(results, "results", scratch)

        results.select(PATH, DIGEST).write.mode("overwrite").parquet(f"{audit_dir}/_arquivos/id_lote={batch_id}")
        runs = results.withColumn("nm_caminho", F.col(PATH))
        runs = audit_rows(runs, spec.table, stamp, _file_seconds(results, started), carry=[ARRIVAL, "nm_caminho"])
        runs = append_audit(spark, runs, audit_dir, batch_id)
        new_version = table.commit(spark, version, folder, batch_id, ts, columns_after, touched)
        mark_committed(spark, audit_dir, batch_id)
    finally:
        scratch.clear(spark)
    return IngestResult(
        new_version, False, runs, alert_rows(runs, stamp), disposition(runs, stamp), totals
    )
