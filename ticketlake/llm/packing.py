"""Packing documents into fixed windows by minimum bin slack.

A document longer than the window gives full pieces and a remainder. What is left to pack is
the multiset of piece lengths, a histogram with at most one entry per length, whatever the
number of documents. For each window a bitset subset-sum finds the lengths that come closest
to its capacity, starting from the longest one left; the choice is traced back and repeated
as often as the counts allow. Pieces then take their places by their rank within their
length: the only thing that crosses the driver is the histogram and the plan over it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.text import materialize
from ticketlake.llm.tokens import encoder, runs

CAPACITY = 1024


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Lengths and how often, for one window: the longest, and what leaves least slack."""
    longest = max(counts)
    room = capacity - longest
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        free = min(counts[length] - (length == longest), room // length)
        k = 1
        while free > 0 and not reach >> room & 1:
            k = min(k, free)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            free -= k
            k *= 2
        if reach >> room & 1:
            break
    chosen = {longest: 1}
    left = (reach & mask).bit_length() - 1
    for length, k, before in reversed(steps):
        if not before >> left & 1:
            chosen[length] = chosen.get(length, 0) + k
            left -= length * k
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(repetitions, filling) per kind of window, until all pieces are placed."""
    counts = {n: c for n, c in counts.items() if c}
    windows = []
    while counts:
        chosen = fill(counts, capacity)
        times = min(counts[n] // k for n, k in chosen.items())
        for n, k in chosen.items():
            counts[n] -= times * k
            if not counts[n]:
                del counts[n]
        windows.append((times, chosen))
    return windows


def placements(windows: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, pieces per window, first sequence, first offset)."""
    rows: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, chosen in windows:
        offset = 0
        for n in sorted(chosen, reverse=True):
            rows.setdefault(n, []).append((used.get(n, 0), chosen[n], sequence, offset))
            used[n] = used.get(n, 0) + times * chosen[n]
            offset += n * chosen[n]
        sequence += times
    return {n: np.array(r, np.int64) for n, r in rows.items()}


_PIECES = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])


def _cut(vocabulary: str, spaces: bool, end: int, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, spaces)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, stop in runs(texts):
                rows, out = [], []
                for i, text in enumerate(texts[first:stop], first):
                    ids = enc.encode(text, end).tobytes()
                    for start in range(0, len(ids), 4 * capacity):
                        piece = ids[start : start + 4 * capacity]
                        rows.append(i)
                        out.append((start // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                # Ids are passed on as they are: a number in a float would lose its last digits.
                names = batch.column("doc_id").take(pa.array(rows, pa.int64()))
                columns = [pa.array(c, pa.int64()) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([names, *columns], schema=_PIECES)

    return cut


def pieces(
    docs: DataFrame, vocabulary: str, end: int, spaces: bool = True, capacity: int = CAPACITY
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): full pieces and a remainder per document.

    Null texts are empty: one piece with the end id alone. A repeated row gives its pieces
    again.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(_cut(vocabulary, spaces, end, capacity), schema)


def ranked(rows: DataFrame, buckets: int) -> DataFrame:
    """Adds ``rank``, gapless from 0 within each length.

    A length's pieces are numbered in hashed buckets, which are then shifted by the counts
    of the buckets before: a length that a third of all pieces have is many tasks.
    """
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    numbered = dealt.withColumn("_no", F.row_number().over(inside) - 1)
    joined = numbered.join(sizes, ["length", "_bucket"])
    return joined.withColumn("rank", F.col("_start") + F.col("_no")).drop("_bucket", "_start", "_no")


def pack(rows: DataFrame, capacity: int = CAPACITY, scratch=None) -> DataFrame:
    """Adds sequence_id and offset to pieces; every piece gets exactly one place."""
    rows = materialize(rows, "pieces", scratch)
    histogram = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # one row per length
    places = placements(plan(histogram, capacity))
    names = rows.columns

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                here, table = np.flatnonzero(length == n), places[n]
                row = table[np.searchsorted(table[:, 0], rank[here], side="right") - 1]
                nth = rank[here] - row[:, 0]
                sequence[here] = row[:, 2] + nth // row[:, 1]
                offset[here] = row[:, 3] + nth % row[:, 1] * n
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", sequence_id long, offset long"
    return ranked(rows, buckets).mapInArrow(placed, schema)
