"""Landing folder as a stream, and replay of failed files.

The unit of the stream is a file, told apart by path and content: equal names in two folders
are two files, and a path whose content was taken in before is not taken in again. A file is
taken when it has settled (see ``settled``); all files of a micro-batch are decoded once and
then go to their tables, each with a commit of its own under the batch's id, so a batch that
is done again after a crash only does what is missing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticketlake.functions.columns import ntz
from ticketlake.operators.audit import replay_tally, unknown_table_alerts
from ticketlake.operators.routing import prefix_of, route, workbooks_only
from ticketlake.plans.ingest import IngestResult, ingest_batch, known_files
from ticketlake.session import Scratch, exists
from ticketlake.sources.landing import LAYOUT, Landing, load_delimited, load_parquet, load_workbooks
from ticketlake.sources.workbook import SHEET, SHEET_NO, workbook_files
from ticketlake.spec import PATH, SETTLE_SECONDS, SPECS, TableSpec
from ticketlake.storage.snapshot import SnapshotTable, literal_path
from ticketlake.streaming.settled import look, settled_stream

WORKBOOK_GLOB = "*.{[xX][lL][sS],[xX][lL][sS][xX]}"
FILES_PER_BATCH = 1_000

Tables = SnapshotTable | Sequence[SnapshotTable]


def _by_name(tables: Tables) -> dict[str, SnapshotTable]:
    return {t.spec.table: t for t in ([tables] if isinstance(tables, SnapshotTable) else tables)}


def _sheet(specs: Sequence[TableSpec]) -> tuple[Column, Column]:
    """Sheet name or position that the route of a file asks for."""
    name, number = F.lit(None).cast("string"), F.lit(None).cast("int")
    for spec in specs:
        mine = F.col("prefixo") == spec.prefix
        if isinstance(spec.sheet, str):
            name = F.when(mine, F.lit(spec.sheet)).otherwise(name)
        else:
            number = F.when(mine, F.lit(spec.sheet)).otherwise(number)
    return name, number


def apply_batch(
    files: DataFrame,
    batch_id: str,
    tables: Tables,
    audit_dir: str,
    ts: dt.datetime | None = None,
    specs: Sequence[TableSpec] = SPECS,
    keep_missing: bool = False,
    known: DataFrame | None = None,
) -> list[IngestResult]:
    """Decode the workbooks of one batch once and ingest them, table by table.

    Files without a known prefix, or routed to none of ``tables``, stay out. Every table has
    its own commit under ``batch_id`` and the prefix: one that was committed before changes
    nothing. Files that ``known`` lists with their content are left out.
    """
    ts = ts or dt.datetime.now().replace(microsecond=0)
    spark, by_name = files.sparkSession, _by_name(tables)
    routed, _, _ = route(workbooks_only(files), specs, list(by_name))
    name, number = _sheet(specs)
    landing = load_workbooks(routed.withColumns({SHEET: name, SHEET_NO: number}), None, known)
    prefix = prefix_of(F.col("nm_arquivo_origem"), specs)
    present = {r[0] for r in landing.files.select(prefix).distinct().collect()}  # one per specification
    results = []
    try:
        for spec in specs:
            if spec.prefix not in present or spec.table not in by_name:
                continue
            mine = landing.files.filter(prefix == spec.prefix)
            layouts = landing.layouts.join(mine.select(LAYOUT).distinct(), LAYOUT, "left_semi")
            part = Landing(landing.rows.filter(prefix == spec.prefix), mine, layouts, Scratch())
            table = by_name[spec.table]
            results.append(
                ingest_batch(spark, part, table, audit_dir, f"{batch_id}-{spec.prefix}", ts, spec, keep_missing)
            )
    finally:
        landing.scratch.clear(spark)
    return results


def unknown_tables(
    files: DataFrame, ts: dt.datetime, specs: Sequence[TableSpec], known_tables: Sequence[str]
) -> DataFrame:
    """Alerts for files routed to a table that is not registered."""
    _, _, unknown = route(workbooks_only(files), specs, known_tables)
    return unknown_table_alerts(unknown, ntz(ts))


def stream_batch_id(batch: DataFrame, batch_id: int) -> str:
    """Batch number within its stream; a stream started on a new checkpoint is another
    stream, whose numbers start again."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"stream-{stream}-{batch_id}"


def move_files(spark: SparkSession, destinations: DataFrame, archive_dir: str) -> None:
    """Move processed files below the archive, by outcome; at most a batch's files.

    Files that no table takes were not processed and stay where they are. A file that is
    gone, since an earlier try moved it, is passed over.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for row in destinations.select("nm_caminho", "nm_arquivo", "nm_destino").collect():
        source = jvm.org.apache.hadoop.fs.Path(row["nm_caminho"])
        folder = jvm.org.apache.hadoop.fs.Path(f"{archive_dir}/{row['nm_destino']}")
        files = source.getFileSystem(conf)
        if files.exists(source):
            files.mkdirs(folder)
            files.rename(source, jvm.org.apache.hadoop.fs.Path(folder, row["nm_arquivo"]))


def stream_landing(
    spark: SparkSession,
    directory: str,
    checkpoint: str,
    tables: Tables,
    audit_dir: str,
    specs: Sequence[TableSpec] = SPECS,
    archive_dir: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    settle_seconds: float = SETTLE_SECONDS,
    on_alerts: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Ingest every settled workbook of a folder once; one call is one poll.

    The call looks at the folder twice, ``settle_seconds`` apart, and starts a query that ends
    when all released files are in. A file that still grows waits for a later call.
    ``archive_dir`` takes processed files away. ``on_alerts`` gets the alert rows of each
    batch: one per processed file, and one per file whose route names an unregistered table.
    """
    sightings = f"{checkpoint}/sightings"
    look(spark, directory, sightings, WORKBOOK_GLOB, settle_seconds)
    by_name = _by_name(tables)

    def ingest(batch: DataFrame, batch_id: int) -> None:
        session, ts = batch.sparkSession, dt.datetime.now().replace(microsecond=0)
        released = sorted({r[PATH] for r in batch.select(PATH).collect()})  # names of files
        paths = [p for p in released if exists(session, p)]  # an earlier try may have moved some
        name = stream_batch_id(batch, batch_id)
        for i in range(0, len(paths), files_per_batch):
            files = workbook_files(session, [literal_path(p) for p in paths[i : i + files_per_batch]])
            # Files of this batch count as known only after another batch took them in.
            known = known_files(session, audit_dir)
            results = apply_batch(
                files, f"{name}-{i // files_per_batch}", list(by_name.values()), audit_dir, ts, specs, known=known
            )
            for result in results:
                if on_alerts:
                    on_alerts(result.alerts)
                if archive_dir:
                    move_files(session, result.destinations, archive_dir)
            if on_alerts:
                on_alerts(unknown_tables(files, ts, specs, list(by_name)))

    released = settled_stream(spark, sightings, settle_seconds)
    writer = released.writeStream.foreachBatch(ingest).option("checkpointLocation", f"{checkpoint}/query")
    return writer.trigger(availableNow=True).start()


def ingest_delimited(
    spark: SparkSession,
    path: str | list[str],
    table: SnapshotTable,
    audit_dir: str,
    batch_id: str,
    ts: dt.datetime,
    **options,
) -> IngestResult:
    """The same ingest for delimited landing files."""
    landing = load_delimited(spark, path, **options)
    return ingest_batch(spark, landing, table, audit_dir, batch_id, ts, table.spec)


def replay(
    spark: SparkSession,
    path: str | list[str],
    tables: Tables,
    audit_dir: str,
    batch_id: str,
    ts: dt.datetime | None = None,
    fmt: str = "workbook",
    specs: Sequence[TableSpec] = SPECS,
    **options,
) -> DataFrame:
    """Load failed files again (one path, several, or a whole folder): good and failed files.

    Files are taken in whether or not they were before. Workbooks that no table takes count
    as failed. Delimited and Parquet files all go to the one table given; ``options`` are those
    of ``load_delimited``.
    """
    ts = ts or dt.datetime.now().replace(microsecond=0)
    if fmt != "workbook":
        (table,) = _by_name(tables).values()
        landing = load_delimited(spark, path, **options) if fmt == "csv" else load_parquet(spark, path)
        return replay_tally(ingest_batch(spark, landing, table, audit_dir, f"replay-{batch_id}", ts).runs)
    files = workbook_files(spark, path)
    _, ignored, unknown = route(workbooks_only(files), specs, list(_by_name(tables)))
    left_alone = ignored.select(PATH).unionByName(unknown.select(PATH))
    results = apply_batch(files, f"replay-{batch_id}", tables, audit_dir, ts, specs)
    runs = [r.runs.select("ds_status") for r in results]
    none = spark.createDataFrame([], "ds_status string")
    for more in runs:
        none = none.unionByName(more)
    return replay_tally(none, left_alone)
