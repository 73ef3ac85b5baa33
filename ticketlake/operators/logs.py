"""Error events from numbered log lines."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.functions.columns import ntz, trim_all
from ticketlake.spec import ERROR_TEXT_LIMIT, LOG_SOURCE, STACK_LINES

# Shape of an event line, of a stack line, and the words that make
# a warning relevant.
HEADER = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),\d+\s+(ERROR|WARN)\s+(\S+)\s+::\s+(?s:(.+))$"
STACK = r"^\s*(at |Caused by:|com\.microsoft\.|java\.)"
RELEVANT = (
    r"(?i)sql|query|exception|jdbc|sqlserver|invalid|parameter|template.tag|"
    r"order by|should be a string|non-blank"
)
# Lines per window group. A group also sees the first lines of the next one, so
# cutting a file into groups changes no result and bounds the work of one task.
CHUNK_LINES = 50_000


def match_header(line: Column | str, part: int) -> Column:
    """Part of an event line: 1 time, 2 level, 3 module, 4 message."""
    return F.regexp_extract(line, HEADER, part)


def event_time(text: Column) -> Column:
    """Second-precise time without zone; NULL for an impossible date."""
    return text.try_cast("timestamp_ntz")


def is_relevant(level: Column, message: Column) -> Column:
    return (level == "ERROR") | message.rlike(RELEVANT)


def attach_stack(
    lines: DataFrame,
    stack_lines: int = STACK_LINES,
    chunk: int = CHUNK_LINES,
    wanted: Column | None = None,
) -> DataFrame:
    """Event lines with the stack lines that directly follow, as ``stack`` (text or NULL).

    Lines that are neither, and event lines that are not ``wanted``, are dropped before
    the shuffle; whether a stack line directly follows is told by its line number.
    """
    chunk = max(chunk, stack_lines)  # the margin of a group is the start of the next one only
    is_header = F.col("line").rlike(HEADER)
    kept = F.col("_event") if wanted is None else F.col("_event") & wanted
    useful = lines.withColumn("_event", is_header).filter(kept | F.col("line").rlike(STACK))
    group = F.floor((F.col("line_no") - 1) / chunk)
    in_margin = ((F.col("line_no") - 1) % chunk < stack_lines) & (group > 0) & ~F.col("_event")
    spread = useful.withColumn(
        "_group", F.explode(F.when(in_margin, F.array(group, group - 1)).otherwise(F.array(group)))
    )
    window = Window.partitionBy("log_file", "_group").orderBy("line_no")
    follows = []
    for step in range(1, stack_lines + 1):
        adjacent = (F.lead("line_no", step).over(window) == F.col("line_no") + step) & ~F.lead(
            "_event", step
        ).over(window)
        follows.append(F.when(adjacent, F.lead("line", step).over(window)).alias(f"_l{step}"))
    ahead = spread.select("log_file", "line_no", "line", "_event", *follows).filter("_event")
    # A gap ends the stack: line k counts only if lines 1..k-1 do.
    taken: list[Column] = []
    unbroken: list[Column] = []
    for step in range(1, stack_lines + 1):
        unbroken.append(F.col(f"_l{step}").isNotNull())
        whole = reduce(lambda a, b: a & b, unbroken)
        taken.append(F.when(whole, trim_all(f"_l{step}")))
    stack = F.concat_ws("\n", *taken)
    return ahead.select(
        "log_file", "line_no", "line", F.when(F.col("_l1").isNotNull(), stack).alias("stack")
    )


def parse_events(
    lines: DataFrame, chunk: int = CHUNK_LINES, mark: Column | dt.datetime | None = None
) -> DataFrame:
    """Relevant ERROR and WARN events after the mark, with their stack, message cut to its limit."""
    wanted = is_relevant(match_header("line", 2), match_header("line", 4))
    if mark is not None:
        wanted = wanted & is_newer(event_time(match_header("line", 1)), mark)
    return as_events(attach_stack(lines, chunk=chunk, wanted=wanted))


def as_events(ahead: DataFrame) -> DataFrame:
    """Event rows of event lines (log_file, line_no, line) with their ``stack``."""
    events = ahead.select(
        "log_file",
        "line_no",
        event_time(match_header("line", 1)).alias("dt_evento"),
        match_header("line", 2).alias("nivel"),
        match_header("line", 3).alias("modulo"),
        match_header("line", 4).alias("_mensagem"),
        "stack",
    )
    message = F.concat_ws("\n", "_mensagem", "stack")
    return events.select(
        "log_file",
        "line_no",
        F.lit(LOG_SOURCE).alias("fonte"),
        "nivel",
        "modulo",
        F.substring(message, 1, ERROR_TEXT_LIMIT).alias("mensagem"),
        "dt_evento",
    )


def is_newer(time: Column, mark: Column | dt.datetime) -> Column:
    """Strictly after the mark; a NULL mark or event time counts as newer.

    Events of the mark's own second that arrive later are lost by this rule, as
    are events logged out of order.
    """
    mark = mark.cast("timestamp_ntz") if isinstance(mark, Column) else ntz(mark)
    return mark.isNull() | time.isNull() | (time > mark)


def newer_than(events: DataFrame, mark: Column | dt.datetime | None) -> DataFrame:
    """Events after the mark, see ``is_newer``."""
    return events if mark is None else events.filter(is_newer(F.col("dt_evento"), mark))


def high_water(events: DataFrame, source: str = LOG_SOURCE) -> DataFrame:
    """Time of the newest captured event of a source, one row."""
    return events.filter(F.col("fonte") == source).agg(F.max("dt_evento").alias("dt_evento"))


def extract_events(
    lines: DataFrame, mark: Column | dt.datetime | None = None, chunk: int = CHUNK_LINES
) -> DataFrame:
    """New events of numbered log lines."""
    return parse_events(lines, chunk, mark)
