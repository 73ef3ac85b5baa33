"""One poll of the server logs: extract new events, keep them, raise an alert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.functions.columns import ntz
from ticketlake.operators.logs import extract_events, high_water
from ticketlake.operators.audit import log_alert
from ticketlake.operators.lookup import number_rows
from ticketlake.session import Scratch, materialize, read_rows
from ticketlake.sources.loglines import read_log_lines
from ticketlake.spec import LOG_EVENT_SCHEMA


# Lines, or bytes, of a log that are numbered by one task.
BLOCK_LINES = 50_000


def read_events(spark: SparkSession, events_dir: str) -> DataFrame:
    """All captured events; empty before the first poll."""
    schema = T.StructType([*LOG_EVENT_SCHEMA.fields, T.StructField("id_lote", T.StringType())])
    return read_rows(spark, events_dir, schema)


def append_events(
    spark: SparkSession, events: DataFrame, events_dir: str, batch_id: str, ts: dt.datetime
) -> DataFrame:
    """Add events in line order with their ids; a repeated batch replaces itself."""
    earlier = read_events(spark, events_dir).filter(F.col("id_lote") != batch_id)
    last = earlier.agg(F.max("id_log")).first()[0] or 0
    block = F.struct("log_file", F.floor(F.col("line_no") / BLOCK_LINES))
    rows = (
        number_rows(events, ["log_file", "line_no"], "id_log", block=block)
        .withColumns(
            {"id_log": F.col("id_log") + last, "dt_insert": ntz(ts)}
        )
        .select(*LOG_EVENT_SCHEMA.names)
    )
    target = f"{events_dir}/id_lote={batch_id}"
    rows.write.mode("overwrite").parquet(target)
    return spark.read.schema(LOG_EVENT_SCHEMA).parquet(target)


def poll_logs(
    spark: SparkSession,
    path: str | list[str],
    events_dir: str,
    batch_id: str,
    ts: dt.datetime,
    tail: int | None = None,
    since_mark: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """New events of the log files and the alert row, if one is due.

    ``since_mark`` is for files read again at every poll: only events after the
    newest captured one are new. By default all lines are read, however many a file
    gained since the last poll; ``tail`` limits them to the last ones of each file.
    """
    earlier = read_events(spark, events_dir).filter(F.col("id_lote") != batch_id)
    mark = high_water(earlier).first()[0] if since_mark else None
    scratch = Scratch()
    try:
        lines = read_log_lines(spark, path, tail, scratch)
        events = materialize(extract_events(lines, mark), "events", scratch)
        added = append_events(spark, events, events_dir, batch_id, ts)
    finally:
        scratch.clear(spark)
    return added, log_alert(added, ("id_log",))
