"""Server logs as numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.operators.lookup import join_lookup, number_blocks
from ticketlake.session import Scratch, materialize

# Line ends besides \n, \r and \r\n that also end a line of captured output.
_OTHER_LINE_ENDS = r"[\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def read_log_lines(
    spark: SparkSession,
    path: str | list[str],
    tail: int | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """All lines of every file, or only its last ``tail``, numbered from 1.

    Files are read in splits. Inside a split the scan keeps the line order, and
    the splits of a file are ordered by their start offset, so line numbers
    need neither whole files in one row nor one task per file.
    """
    lines = spark.read.text(path).select(
        F.explode(F.split("value", _OTHER_LINE_ENDS)).alias("line"),
        F.col("_metadata.file_path").alias("log_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    placed = materialize(
        lines.withColumn("_seq", F.monotonically_increasing_id()), "log-lines", scratch
    )
    numbered = number_blocks(
        placed, ["log_file"], "_block", "_seq", "line_no", total="_total"
    )
    if tail is not None:
        numbered = numbered.filter(F.col("line_no") > F.col("_total") - tail)
    return numbered.select("log_file", "line_no", "line")


def tail_lines(lines: DataFrame, tail: int) -> DataFrame:
    """Last ``tail`` lines per source, for lines numbered 1..n without gaps.

    One pre-aggregated row per source carries the length; no window sorts the
    lines of a source.
    """
    ends = lines.groupBy("log_file").agg(F.max("line_no").alias("_last"))
    ends = materialize(ends, "ends")  # for the size check and the join
    return (
        join_lookup(lines, ends, "log_file")
        .filter(F.col("line_no") > F.col("_last") - tail)
        .select(lines.columns)
    )
