"""Token ids in Simple-8b block files.

A block holds the ids of whole consecutive documents. Ids become codes through the block's
own table of frequent ids, most frequent first, so that common ids are small; an id beyond
the table is code 0, an escape, and stands in the block's escape list. Codes are packed into
64-bit words: the upper four bits select how many codes of how many bits fill the other 60.
Every 512th word's code position and the escapes before it are stored. Decoding starts at the
last of these before the wanted codes, and decodes all words of one selector together.

Files are Parquet folders with one row per block, so they live in any store Spark writes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.tokens import encoder

#: Codes per word and their bits, by selector: the scheme's fixed values.
SELECTORS = (
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
COUNTS = np.array([n for n, _ in SELECTORS])
#: Ids after which a block ends with its document, entries of a table, words per offset.
BLOCK_IDS, TABLE_IDS, STRIDE = 1 << 17, 4095, 512
#: Ids below this are counted in an array.
COUNTED_IDS = 1 << 22
SCHEMA = (
    "shard int, block int, block_start long, n_ids long, doc_ids array<bigint>, lengths binary,"
    " table binary, words binary, offsets binary, escapes binary"
)


def pack(codes: np.ndarray) -> np.ndarray:
    """Simple-8b words of unsigned codes below 2**60.

    Each word takes as many codes as fit; the last one may hold fewer than its selector says.
    """
    codes = np.ascontiguousarray(codes, np.uint64)
    n = len(codes)
    if not n:
        return np.empty(0, np.uint64)
    if int(codes.max()) >> 60:
        raise ValueError("codes must be below 2**60")
    at = np.arange(n)
    best = np.full(n, len(SELECTORS) - 1, np.int8)
    undecided = np.ones(n, bool)
    for s, (count, bits) in enumerate(SELECTORS[:-1]):
        large = np.where(codes >> np.uint64(bits) != 0, at, n + 240)
        # Position of the next code that is too large for this selector.
        stop = np.minimum.accumulate(large[::-1])[::-1]
        fits = undecided & (stop - at >= count)
        best[fits] = s
        undecided &= ~fits
        if not undecided.any():
            break
    jump = COUNTS[best].tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += jump[i]
    first = np.array(starts)
    selector = best[first]
    padded = np.concatenate([codes, np.zeros(240, np.uint64)])
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector):
        count, bits = SELECTORS[s]
        if bits:
            rows = np.flatnonzero(selector == s)
            for k in range(count):
                words[rows] |= padded[first[rows] + k] << np.uint64(bits * k)
    return words


def unpack(words: np.ndarray, n: int, marks: np.ndarray | None = None) -> np.ndarray:
    """The n codes of Simple-8b words; ``marks`` are the code positions of every 512th word."""
    words = words.astype(np.uint64, copy=False)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    if marks is None:
        first = np.cumsum(counts) - counts
    else:  # words of a stride are placed from its mark
        rows = np.zeros((len(marks), STRIDE), np.int64)
        rows.ravel()[: len(counts)] = counts
        first = (np.cumsum(rows, axis=1) - rows + marks[:, None]).ravel()[: len(counts)]
    out = np.zeros(max(n, int(counts.sum())) + 240, np.uint64)
    for s in np.unique(selector):
        count, bits = SELECTORS[s]
        if bits:
            rows = np.flatnonzero(selector == s)
            mask = np.uint64((1 << bits) - 1)
            for k in range(count):
                out[first[rows] + k] = (words[rows] >> np.uint64(bits * k)) & mask
    return out[:n]


def encode_block(ids: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """(table, words, offsets, escapes) of a block's ids.

    An offset is a pair: position of the stride's first code, and escapes before it.
    """
    if int(ids.max(initial=0)) < COUNTED_IDS:  # ids of a vocabulary are counted, not sorted
        times = np.bincount(ids)
        values = np.flatnonzero(times)
        times, which, size = times[values], ids, int(values[-1]) + 1 if len(values) else 0
    else:
        values, which, times = np.unique(ids, return_inverse=True, return_counts=True)
        size = len(values)
    order = np.argsort(-times, kind="stable")[:TABLE_IDS]
    code = np.zeros(size, np.uint64)
    code[values[order] if which is ids else order] = np.arange(1, len(order) + 1)
    codes = code[which]
    words = pack(codes)
    first = np.concatenate([[0], np.cumsum(COUNTS[(words >> np.uint64(60)).astype(int)])])[:-1]
    marks = first[::STRIDE]
    escaped = np.concatenate([[0], np.cumsum(codes == 0)])[marks]
    return (
        values[order].astype("<u4").tobytes(), words.astype("<u8").tobytes(),
        np.column_stack([marks, escaped]).astype("<u4").tobytes(), ids[codes == 0].astype("<u4").tobytes(),
    )


def decode_range(
    table: bytes, words: bytes, offsets: bytes, escapes: bytes, start: int, n: int
) -> np.ndarray:
    """The n ids of a block from position ``start`` on, read from the stride they start in."""
    if not n:
        return np.empty(0, np.uint32)
    marks, before = np.frombuffer(offsets, "<u4").astype(np.int64).reshape(-1, 2).T
    lo = int(np.searchsorted(marks, start, side="right")) - 1
    hi = int(np.searchsorted(marks, start + n, side="left"))
    part = np.frombuffer(words, "<u8")[lo * STRIDE : hi * STRIDE]
    skip = start - int(marks[lo])
    codes = unpack(part, skip + n, marks[lo:hi] - marks[lo]).astype(np.int64)
    out = np.concatenate([[0], np.frombuffer(table, "<u4")]).astype(np.uint32)[codes]
    escaped = codes == 0
    out[escaped] = np.frombuffer(escapes, "<u4")[before[lo] : before[lo] + int(escaped.sum())]
    return out[skip:]


def decode_block(table: bytes, words: bytes, offsets: bytes, escapes: bytes, n: int) -> np.ndarray:
    """The n ids of a block."""
    return decode_range(table, words, offsets, escapes, 0, n)


def _write_blocks(path: str, spaces: bool, end: int, block_ids: int):
    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path, spaces)
        shard, number, before = 0, 0, 0
        held: list[np.ndarray] = []
        names: list = []
        size = 0

        def block() -> pd.DataFrame:
            nonlocal number, before, size
            ids = np.concatenate(held)
            table, words, offsets, escapes = encode_block(ids)
            lengths = pack(np.array([len(h) for h in held])).astype("<u8").tobytes()
            row = (shard, number, before, len(ids), list(names), lengths, table, words, offsets, escapes)
            number, before, size = number + 1, before + len(ids), 0
            held.clear()
            names.clear()
            return pd.DataFrame([row], columns=[c.split()[0] for c in SCHEMA.split(", ")])

        for f in frames:
            for part, doc_id, text, known in zip(f["shard"], f["doc_id"], f["text"], f["known"], strict=True):
                shard = part
                ids = enc.encode(text, end)
                held.append(ids)
                names.append(int(doc_id) if known else None)
                size += len(ids)
                if size >= block_ids:
                    yield block()
        if held:
            yield block()

    return blocks


def write_files(
    docs: DataFrame, target: str, vocabulary: str, end: int, spaces: bool = False,
    files: int | None = None, block_ids: int = BLOCK_IDS,
) -> None:
    """Write ``docs`` (doc_id, text) as block files in ascending doc_id order.

    ``vocabulary`` is a tokenizers file that every executor has. Null texts are empty: the
    end id alone. Equal ids go by a hash of their text, null ids come last. A document is
    never split; a block ends with the document that fills it. No rows, no blocks.
    """
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", "text", F.col("doc_id").isNull().alias("_null"), F.xxhash64("text").alias("_tie"))
    order = ("_null", "doc_id", "_tie")
    # Texts cross the shuffle once, before tokenizing; tasks then write finished blocks.
    dealt = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order)
    rows = dealt.select(
        F.spark_partition_id().alias("shard"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        "text", (~F.col("_null")).alias("known"),
    )
    rows.mapInPandas(_write_blocks(vocabulary, spaces, end, block_ids), SCHEMA).write.parquet(target)


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("n_ids", "block_start", "shard", "doc_ids", "lengths", "table", "words", "offsets", "escapes")
    for batch in batches:
        # One block at a time; its ids stay whole numbers beside nulls.
        for i in range(batch.num_rows):
            b = {c: batch.column(c)[i].as_py() for c in names}
            lengths = unpack(np.frombuffer(b["lengths"], "<u8"), len(b["doc_ids"])).astype(np.int64)
            ids = decode_block(b["table"], b["words"], b["offsets"], b["escapes"], b["n_ids"]).astype("<u4")
            ends = np.cumsum(lengths)
            parts = [ids[e - n : e].tobytes() for n, e in zip(lengths, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b["shard"]] * len(parts), pa.int32()), pa.array(b["doc_ids"], pa.int64()),
                    pa.array(b["block_start"] + ends - lengths), pa.array(parts, pa.binary()),
                ],
                ["shard", "doc_id", "inside", "ids"],
            )


def read_files(spark: SparkSession, target: str) -> DataFrame:
    """(doc_id, start, ids) per document; ids are little-endian unsigned 32-bit numbers.

    ``start`` counts the ids of all documents before it: shard sizes are summed over one
    row per file.
    """
    blocks = spark.read.schema(SCHEMA).parquet(target)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    starts = sizes.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    docs = blocks.mapInArrow(_read_blocks, "shard int, doc_id long, inside long, ids binary")
    # One row per file.
    return docs.join(F.broadcast(starts), "shard").select(
        "doc_id", (F.col("_start") + F.col("inside")).alias("start"), "ids"
    )


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids)
