"""Registered queries and their SQL counterparts.

Every query runs over whole tables of the given folder.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake import fixtures as fx
from ticketlake import oracle
from ticketlake.functions.columns import dedupe_headers as dedupe
from ticketlake.functions.columns import label_null, ntz
from ticketlake.operators import audit, cleaning, logs, merge, quality, routing
from ticketlake.operators.filters import cross_filter
from ticketlake.plans import ingest, kpi, log_poll
from ticketlake.session import materialize, scratch_path
from ticketlake.sources.landing import from_frame, load_workbooks, only_settled, read_landing
from ticketlake.sources.loglines import tail_lines
from ticketlake.spec import CREATED, ORIGIN, UPDATED, TableSpec
from ticketlake.storage.snapshot import SnapshotTable
from ticketlake.streaming.landing import replay

try:  # the subpackage and the pipeline, or a library they need, may be absent
    import corpus_pipeline
    from ticketlake.llm import queries as llm
except ImportError:
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

DAY = dt.date(2024, 1, 15)
STAMP = "2024-06-01 08:00:00"
LATER = "2024-06-02 08:00:00"
SETTLED_AT = "2024-01-15 12:00:00"
ENTRY_DIR = os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001")
TAIL = 100


def _moment(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def _stamp():
    return ntz(_moment(STAMP))


def _on_problems(card: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: card(fx.problems(spark, sf_dir))


def _on_runs(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(fx.etl_runs(spark, sf_dir))


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# Landing ---------------------------------------------------------------------------------
def landing_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landing(spark, f"{sf_dir}/orders.parquet", "parquet").drop("dt_chegada")


def dedupe_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = fx.header_rows(spark, sf_dir)
    return headers.select("o_custkey", F.posexplode(dedupe("cabecalho")).alias("posicao", "nome"))


def landing_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = fx.mixed_layouts(spark, sf_dir)
    resolved = ingest.resolve_layouts(landing.layouts, fx.SPEC)
    rows, columns = ingest.project_landing(landing, fx.SPEC, resolved)
    return rows.select(*columns, ORIGIN)


def workbook_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_workbooks(fx.workbooks(spark, sf_dir), fx.SPEC.sheet).to_frame().drop("dt_chegada")


def settled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as files with a size and a time, some of them empty or still warm."""
    files = fx.read(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % 5).alias("length"), F.col("ts").cast("timestamp_ntz").alias("dt_chegada")
    )
    return only_settled(files, now=ntz(_moment(SETTLED_AT))).select("event_id", "length")


def _file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file name per run, with prefixes and endings of several kinds."""
    n = F.col("id_log")
    start = (
        F.when(n % 5 == 0, "GProblemas_")
        .when(n % 5 == 1, "gproblemas")
        .when(n % 5 == 2, "outros_")
        .when(n % 5 == 3, "x_gproblemas_")
        .otherwise("gmudancas_")
    )
    end = F.when(n % 4 == 0, ".XLSX").when(n % 4 == 1, ".xls").when(n % 4 == 2, ".csv").otherwise(".xlsx")
    return fx.etl_runs(spark, sf_dir).select(
        "id_log", F.concat(start, n.cast("string"), end).alias(ORIGIN)
    )


def route_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = TableSpec(prefix="gmudancas", table="tb_mudancas", key="numero", columns=())
    files = routing.workbooks_only(_file_names(spark, sf_dir))
    return routing.with_route(files, [fx.SPEC, changes]).na.fill("-", ["prefixo", "tabela"])


def sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = {
        "o_orderkey": "numero",
        "o_custkey": " Nº do Cliente ",
        "o_orderstatus": "Status 30/04",
        "o_orderpriority": "__Prioridade--(nova)__",
    }
    raw = fx.read(spark, sf_dir, "orders").select(
        *[F.col(c).cast("string").alias(h) for c, h in headers.items()]
    )
    return cleaning.sanitize_columns(raw, mapped=["numero"])


def _flagged(rows: DataFrame) -> DataFrame:
    named = cleaning.map_names(rows, fx.SPEC)
    return cleaning.flag_rows(named, fx.SPEC, [c for c in named.columns if c != ORIGIN])


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(fx.landing_rows(spark, sf_dir), fx.SPEC)


def row_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.account(_flagged(fx.landing_rows(spark, sf_dir)))


def staging_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_rows(spark, sf_dir).drop("status_30_04", "sistema")
    return quality.to_staging(cleaned, fx.SPEC.staging_schema())


def length_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(cleaning.clean(fx.faulty_landing_rows(spark, sf_dir), fx.SPEC), fx.SPEC)


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(cleaning.clean(fx.faulty_landing_rows(spark, sf_dir), fx.SPEC))


# Merge ------------------------------------------------------------------------------------
MERGE_COLUMNS = (
    "numero", "prioridade", "titulo", "dt_abertura", "dt_conclusao", "status",
    "gerente_responsavel", "jornada_impactada", "paliativo", "impacto", ORIGIN, CREATED, UPDATED,
)


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = clean_rows(spark, sf_dir).drop("status_30_04")
    return merge.merge_upsert(fx.merge_target(spark, sf_dir), source, "numero", _stamp())


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select(*MERGE_COLUMNS, F.col(merge.ACTION).alias("acao"))


def merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_actions(_merged(spark, sf_dir))


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows of the four files, then of a fifth one that revises some of them."""
    rows = clean_rows(spark, sf_dir).drop("status_30_04")
    position = F.substring_index(F.substring_index(ORIGIN, "_", -1), ".", 1).cast("int")
    start = F.expr("TIMESTAMP_NTZ '2024-05-01 00:00:00'")
    revised = F.array(
        F.struct(F.col("titulo"), F.col(ORIGIN)),
        F.struct(
            F.concat(F.lit("Revisto "), F.col("titulo")).alias("titulo"),
            F.lit("gproblemas_9.csv").alias(ORIGIN),
        ),
    )
    copies = F.explode(F.when(F.col("numero") % 5 == 0, revised).otherwise(F.slice(revised, 1, 1)))
    spread = rows.withColumn("_copia", copies)
    return spread.withColumns({"titulo": F.col("_copia.titulo"), ORIGIN: F.col(f"_copia.{ORIGIN}")}).drop(
        "_copia"
    ).withColumn("dt_chegada", start + F.make_dt_interval(mins=position))


def merge_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge.merge_sequence(
        fx.merge_target(spark, sf_dir), _arrivals(spark, sf_dir), "numero",
        ["dt_chegada", ORIGIN], _stamp(),
    )
    return merged.select(
        *MERGE_COLUMNS,
        F.col(merge.ACTION).alias("acao"),
        F.col(merge.FIRST_FILE).alias("primeiro_arquivo"),
    )


def sequence_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _arrivals(spark, sf_dir)
    merged = merge.merge_sequence(
        fx.merge_target(spark, sf_dir), rows, "numero", ["dt_chegada", ORIGIN], _stamp()
    )
    return merge.merge_actions(merged, rows)


def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge.merge_upsert(
        fx.merge_target(spark, sf_dir), clean_rows(spark, sf_dir), "numero", _stamp()
    )
    return merge.production_rows(merged).select(
        "numero", "status", "status_27_04", "status_30_04", CREATED, UPDATED
    )


def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after a large and a small batch, each of which rewrote its own buckets."""
    table = SnapshotTable(scratch_path(spark, "snapshot"), fx.SPEC, buckets=16)
    table.publish(fx.merge_target(spark, sf_dir), "inicio", _moment("2024-01-01"))
    batches = {STAMP: clean_rows(spark, sf_dir).drop("status_30_04"), LATER: fx.reopened(spark, sf_dir)}
    for stamp, rows in batches.items():
        ts, tasks = _moment(stamp), table.tasks(spark)
        touched = table.touched(rows)
        version, part = table.part(spark, touched)
        sides = [side.repartition(tasks, F.col("numero")) for side in (part, rows)]
        merged = merge.merge_upsert(*sides, "numero", ntz(ts))
        folder = table.write(merged, version + 1)
        table.commit(spark, version, folder, stamp, ts, merge.production_rows(merged).schema, touched)
    return table.current(spark)[1].select(
        "numero", "prioridade", "titulo", "dt_abertura", "status", "gerente_responsavel", ORIGIN, CREATED, UPDATED
    )


def batch_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after one batch was handed in twice."""
    folder = scratch_path(spark, "retry")
    table = SnapshotTable(f"{folder}/table", fx.SPEC, buckets=8)
    for stamp in (STAMP, LATER):
        landing = from_frame(fx.landing_rows(spark, sf_dir), ntz(_moment("2024-05-01")))
        ingest.ingest_batch(spark, landing, table, f"{folder}/audit", "lote", _moment(stamp))
    return table.current(spark)[1].select(
        "numero", "status", "dt_abertura", "status_30_04", ORIGIN, CREATED, UPDATED
    )


# Audit ------------------------------------------------------------------------------------
def _batch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = materialize(_flagged(fx.faulty_landing_rows(spark, sf_dir)), "staging")
    verdicts = materialize(ingest.file_verdicts(flagged, fx.SPEC), "verdicts")
    bad = verdicts.filter(F.col("ds_erro").isNotNull())
    good, _ = quality.split_files(merge.staged(flagged, fx.SPEC), bad)
    upsert = merge.merge_upsert(
        fx.merge_target(spark, sf_dir), good.drop(cleaning.BAD_KEY), "numero", _stamp()
    )
    results = ingest.run_results(verdicts, merge.merge_actions(upsert))
    return audit.audit_rows(results, fx.SPEC.table, _stamp(), F.lit(1.256))


def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(_batch_runs(spark, sf_dir), "tm_duracao_seg").na.fill("-", ["ds_erro"])


def file_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.disposition(_batch_runs(spark, sf_dir), _stamp())


def replay_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty files, written as delimited files of one folder each, loaded again.

    There are few files however many rows there are, so many tasks write parts of each.
    """
    folder = scratch_path(spark, "replay")
    rows = fx.faulty_landing_rows(spark, sf_dir)
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.partitionBy(ORIGIN).options(**options).csv(f"{folder}/erros")
    table = SnapshotTable(f"{folder}/table", fx.SPEC, buckets=8)
    return replay(spark, f"{folder}/erros", table, f"{folder}/audit", "1", _moment(STAMP), fmt="csv", parts=True)


def alert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.alert_rows(_batch_runs(spark, sf_dir), _stamp())


def kpi_pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(kpi.pipeline_health(fx.etl_runs(spark, sf_dir)), "media_duracao_seg")


def card_pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(kpi.health_card(fx.etl_runs(spark, sf_dir)), "media_seg")


def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = kpi.daily_summary(fx.etl_runs(spark, sf_dir), DAY)
    return _doubles(summary, "tm_duracao_seg").withColumn("ds_erro", label_null("ds_erro", "-"))


# Logs -------------------------------------------------------------------------------------
def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.extract_events(fx.log_lines(spark, sf_dir))


def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tail_lines(fx.log_lines(spark, sf_dir), TAIL)


def log_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.high_water(_events(spark, sf_dir))


def log_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after the newest one captured by an earlier poll, which saw the files
    up to the middle of the month."""
    lines = fx.log_lines(spark, sf_dir)
    captured = logs.extract_events(lines.filter(F.col("log_file") <= F.lit(DAY)))
    mark = logs.high_water(captured).scalar()
    return logs.extract_events(lines, mark)


def event_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured events of two polls, the second of which saw more files."""
    folder = scratch_path(spark, "events")
    lines = fx.log_lines(spark, sf_dir)
    first = logs.extract_events(lines.filter(F.col("log_file") <= F.lit(DAY)))
    log_poll.append_events(spark, first, folder, "1", _moment(STAMP))
    mark = logs.high_water(log_poll.read_events(spark, folder)).first()[0]
    log_poll.append_events(spark, logs.extract_events(lines, mark), folder, "2", _moment(LATER))
    return log_poll.read_events(spark, folder).drop("id_lote")


def log_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.log_alert(_events(spark, sf_dir))


# Registry -----------------------------------------------------------------------------------
FILTERS = {
    "total": {"status": "Aberto", "paliativo": "Sim"},
    "open_total": {"prioridade": "P2"},
    "p1_open": {"jornada_impactada": "ASIA"},
    "by_status": {"prioridade": "P1"},
    "by_priority": {"status": "Em andamento"},
    "by_journey": {"status": "Resolvido", "departamento_relator": "BUILDING"},
    "by_workaround": {"gerente_responsavel": "NATION_3"},
    "by_manager": {"jornada_impactada": "EUROPE"},
    "by_department": {"paliativo": "Não", "prioridade": "P3"},
    "open_table": {
        "status": "Aberto", "prioridade": "P1", "jornada_impactada": "ASIA",
        "paliativo": "Sim", "departamento_relator": "BUILDING",
    },
}


def _filtered(card: str) -> Query:
    return lambda spark, sf_dir: kpi.filtered(card, fx.problems(spark, sf_dir), **FILTERS[card])


DASHBOARD = {"jornada_impactada": "ASIA", "prioridade": "P2"}


def _cross_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = {**cross_filter("by_journey", "Não informado"), **cross_filter("by_priority", "P1")}
    return kpi.filtered("by_status", fx.problems(spark, sf_dir), **params)


def entry(spark: SparkSession) -> DataFrame:
    """Problems and open problems per journey."""
    return kpi.count_open_by(fx.problems(spark, ENTRY_DIR), "jornada_impactada")


def queries() -> dict[str, Query]:
    """One query per operator; each takes the session and the table folder."""
    result: dict[str, Query] = {
        "landing_read": landing_read,
        "landing_layouts": landing_layouts,
        "dedupe_headers": dedupe_headers,
        "workbook_read": workbook_read,
        "settled_files": settled_files,
        "route_by_prefix": route_by_prefix,
        "sanitize_names": sanitize_names,
        "clean_rows": clean_rows,
        "row_accounting": row_accounting,
        "staging_align": staging_align,
        "length_violations": length_violations,
        "duplicate_keys": duplicate_keys,
        "merge_upsert": merge_upsert,
        "merge_actions": merge_actions,
        "merge_sequence": merge_sequence,
        "sequence_actions": sequence_actions,
        "schema_evolve": schema_evolve,
        "snapshot_merge": snapshot_merge,
        "batch_retry": batch_retry,
        "audit_rows": audit_rows,
        "file_disposition": file_disposition,
        "replay_tally": replay_tally,
        "alert_rows": alert_rows,
        "kpi_by_status": _on_problems(lambda df: kpi.count_by(df, "status")),
        "kpi_by_priority": _on_problems(lambda df: kpi.count_by(df, "prioridade")),
        "kpi_by_manager": _on_problems(lambda df: kpi.count_by(df, "gerente_responsavel")),
        "kpi_by_department": _on_problems(lambda df: kpi.count_by(df, "departamento_relator")),
        "kpi_by_system": _on_problems(lambda df: kpi.count_by(df, "sistema")),
        "kpi_open": _on_problems(kpi.open_problems),
        "kpi_by_journey": _on_problems(lambda df: kpi.count_open_by(df, "jornada_impactada")),
        "kpi_by_workaround": _on_problems(lambda df: kpi.count_open_by(df, "paliativo")),
        "kpi_pipeline_health": kpi_pipeline_health,
        "card_total": _on_problems(kpi.total),
        "card_open_total": _on_problems(kpi.open_total),
        "card_p1_open": _on_problems(kpi.p1_open_total),
        "card_open_basic": _on_problems(kpi.open_table_basic),
        "card_open_exec": _on_problems(kpi.open_table_exec),
        "card_pipeline_health": card_pipeline_health,
        "daily_summary": daily_summary,
        "daily_totals": _on_runs(lambda df: kpi.daily_totals(df, DAY)),
        "cross_filter": _cross_filtered,
        "log_tail": log_tail,
        "log_events": _events,
        "log_high_water": log_high_water,
        "log_incremental": log_incremental,
        "log_alert": log_alert,
        "event_append": event_append,
        "dashboard_filtered": _on_problems(lambda df: kpi.dashboard_counts(df, **DASHBOARD)),
    }
    for name in ("by_status", "by_priority", "by_manager", "by_department", "by_system"):
        result[f"card_{name}"] = _on_problems(kpi.BASIC_CARDS[name])
    for name in ("by_status", "by_priority", "by_journey", "by_workaround", "by_manager", "by_department"):
        result[f"exec_{name}"] = _on_problems(kpi.EXEC_CARDS[name])
    for name in kpi.FILTERED_CARDS:
        key = name.removeprefix("by_")
        result[f"filtered_{key}"] = _filtered(name)
    if llm is not None:
        result |= llm.queries()
        result["pipeline"] = corpus_pipeline.run
    return result


def oracle_sql() -> dict[str, str]:
    """The same results in SQL over the same tables."""
    result = oracle.statements(DAY, STAMP, TAIL, FILTERS)
    result |= oracle.more_statements(DAY, STAMP, LATER, SETTLED_AT, DASHBOARD, fx.BOOK_ROWS)
    if llm is not None:
        result |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            result["pipeline"] = corpus_pipeline.ORACLE_SQL
    return result
