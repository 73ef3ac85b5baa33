"""Events of growing log files, with stacks that two polls share.

A poll may end in the middle of an event's stack lines. Each task attaches stacks within its
block of lines; what touches a block's ends (stack lines before its first event, an event that
is open at its end) goes to a stateful operator, which keeps the last open event of each file
until its stack has ended. So the events are those of one poll over the whole file. Only such
ends meet by file, a few lines per block; complete events are dealt over many groups.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ticketlake.functions.columns import trim_all
from ticketlake.operators.logs import HEADER, STACK, as_events, is_relevant, match_header
from ticketlake.plans.log_poll import append_events
from ticketlake.sources.growing_logs import read_growing_logs
from ticketlake.spec import STACK_LINES
from ticketlake.streaming.landing import stream_batch_id

#: Kinds of pieces, in the order in which those of one place are taken.
LEAD, OPEN, WHOLE = 0, 1, 2
#: Groups that complete events are dealt to.
GROUPS = 64
_PIECES = "log_file string, tipo int, inicio long, fim long, segue boolean, line string, pilha array<string>"
_EVENTS = "log_file string, line_no long, line string, pilha array<string>"
_STATE = "inicio long, fim long, line string, pilha array<string>"


def _pieces(stack_lines: int):
    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Events of one block of lines, and what its ends leave open."""
        event, lead, limit = None, None, 0
        for f in frames:
            done = []
            for r in f.itertuples(index=False):
                limit = r.limite
                if lead is None:
                    lead = [r.log_file, LEAD, r.inicio, r.inicio, False, None, []]
                if r.evento:
                    if event:
                        done.append(event)
                    event = [r.log_file, WHOLE, r.inicio, r.fim, False, r.line, []]
                elif not r.pilha:
                    continue
                elif event is None and r.inicio == lead[3]:
                    lead[3] = r.fim
                    lead[6].append(r.line)
                    del lead[6][stack_lines:]
                elif event and r.inicio == event[3] and len(event[6]) < stack_lines:
                    event[3] = r.fim
                    event[6].append(r.line)
            if done:
                yield _frame(done)
        last = []
        if lead:
            lead[4] = event is None and lead[3] >= limit
            last.append(lead)
        if event:
            if event[3] >= limit and len(event[6]) < stack_lines:
                event[1] = OPEN
            last.append(event)
        if last:
            yield _frame(last)

    return pieces


def _frame(rows: list[list]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _PIECES.split(", ")])


def _join(stack_lines: int, wait_ms: int):
    def found(name: str, events: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(name, e[0], e[2], e[3]) for e in events], columns=["log_file", "line_no", "line", "pilha"])

    def join(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            held = state.get
            state.remove()
            yield found(key[0], [held])
            return
        if key[1] >= 0:  # complete events
            for f in frames:
                yield f.rename(columns={"inicio": "line_no"})[["log_file", "line_no", "line", "pilha"]]
            return
        held = tuple(state.get) if state.exists else None
        rows, done = pd.concat(frames).sort_values(["lido", "inicio", "tipo"], kind="stable"), []
        for r in rows.itertuples(index=False):
            if r.tipo == LEAD:
                if held and r.inicio == held[1]:
                    stack = [*held[3], *r.pilha][:stack_lines]
                    held = (held[0], r.fim, held[2], stack)
                    if r.segue and len(stack) < stack_lines:
                        continue
                if held:
                    done.append(held)
                    held = None
            else:
                if held:
                    done.append(held)
                held = (r.inicio, r.fim, r.line, list(r.pilha))
        if held:
            state.update((int(held[0]), int(held[1]), held[2], list(held[3])))
            state.setTimeoutTimestamp(int(rows["lido"].max()) + wait_ms)
        elif state.exists:
            state.remove()
        if done:
            yield found(key[0], done)

    return join


def joined_events(lines: DataFrame, stack_lines: int = STACK_LINES, wait_seconds: float = 60) -> DataFrame:
    """Event lines of a stream of lines with their stacks: log_file, line_no (the byte where
    the event starts), line, stack.

    An event that is open when its file rests is given out by the first batch with news of
    any file after ``wait_seconds``.
    """
    header = F.col("line").rlike(HEADER)
    wanted = header & is_relevant(match_header("line", 2), match_header("line", 4))
    marked = lines.withColumns({"evento": F.coalesce(wanted, F.lit(False)), "pilha": F.col("line").rlike(STACK) & ~header})
    # Lines of no use go before Python sees them; the first of a block tells where it starts.
    useful = marked.filter("evento OR pilha OR primeira")
    pieces = useful.mapInPandas(_pieces(stack_lines), _PIECES).withColumns({
        "hora": F.current_timestamp(),
        "parte": F.when(F.col("tipo") == WHOLE, F.pmod(F.hash("inicio"), F.lit(GROUPS))).otherwise(-1),
    })
    timed = pieces.withWatermark("hora", "0 seconds").withColumn("lido", F.unix_millis("hora"))
    events = timed.groupBy("log_file", "parte").applyInPandasWithState(
        _join(stack_lines, int(wait_seconds * 1000)), _EVENTS, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    trimmed = F.transform("pilha", trim_all)
    stack = F.when(F.size("pilha") > 0, F.array_join(trimmed, "\n")).alias("stack")
    return events.select("log_file", "line_no", "line", stack)


def stream_growing_logs(
    spark: SparkSession,
    directory: str,
    checkpoint: str,
    events_dir: str,
    glob: str = "*.log",
    wait_seconds: float = 60,
    **options,
) -> StreamingQuery:
    """Extract the events of all lines that log files gained since the last call, once each.

    The checkpoint keeps how far each file was read and the events that are still open.
    """
    lines = read_growing_logs(spark, directory, glob=glob, **options)
    events = as_events(joined_events(lines, wait_seconds=wait_seconds))

    def keep(batch: DataFrame, batch_id: int) -> None:
        ts = dt.datetime.now().replace(microsecond=0)
        append_events(batch.sparkSession, batch, events_dir, stream_batch_id(batch, batch_id), ts)

    writer = events.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
