"""Words, hashes and column helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from pathlib import PurePath

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.session import materialize

__all__ = [
    "BoundedCache", "bucket_of", "held_out", "lower_ascii", "materialize", "per_text", "python_path",
    "runs", "shingle_hashes", "splitmix", "words_of",
]

_ODD = np.uint64(0x9E3779B97F4A7C15)


# Native columns -------------------------------------------------------------------------
def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; empty for null.

    The five other separators become blanks first, so that the split is on one character.
    """
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """Lower case of A-Z alone."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text falls into the fold; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def bucket_of(key: Column, n: int | Column) -> Column:
    """Bucket 0..n-1 by a hash of the key."""
    return F.pmod(F.xxhash64(key), n if isinstance(n, Column) else F.lit(n))


# Inside tasks ---------------------------------------------------------------------------
class BoundedCache(dict):
    """A dict that computes missing values, and starts anew when it is full."""

    def __init__(self, compute: Callable, limit: int = 1_000_000) -> None:
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


#: Entries of a cache by word. A worker keeps its caches from task to task and stage to stage, so
#: they stay small; the usual words are soon back in a cache that starts anew.
WORD_CACHE = 1 << 16
WORD_HASHES = BoundedCache(xxhash.xxh64_intdigest, WORD_CACHE)


def splitmix(x: np.ndarray) -> np.ndarray:
    """Mixes the bits of unsigned 64-bit values."""
    x = x + _ODD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: list[bytes], k: int) -> np.ndarray:
    """A 64-bit hash of each run of k words; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))
    if len(h) < k:
        k = len(h)
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = splitmix(out ^ h[i : i + n]) if i == k - 1 else (out ^ h[i : i + n]) * _ODD
    return out


def shingle_hashes(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's k-word shingles, A-Z lower-cased.

    ``bytes.split`` parts at exactly blank and \\x09-\\x0D, ``bytes.lower`` changes A-Z alone.
    """
    return np.unique(window_hashes((text or "").encode().lower().split(), k))


def python_path(path: str) -> str:
    """Name of a vocabulary file without its folder, for file headers."""
    return PurePath(path).name


#: Texts that are worked on at once, and their characters: what a task holds beside its cache.
BATCH_ROWS, BATCH_CHARS = 512, 4_000_000


def runs(texts: Sequence[str | None]):
    """(start, stop) of runs of texts that are worked on at once."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and (i - start >= BATCH_ROWS or size + n > BATCH_CHARS):
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def per_text(docs: DataFrame, schema: str, columns: Callable[[list], dict[str, pa.Array]], start: Callable = lambda: ()) -> DataFrame:
    """Per row of ``docs`` its doc_id, as it is, and columns made from the texts of a batch.

    Ids do not leave Arrow: beside a null, a data frame would hold them as doubles, and those
    above 2**53 would lose digits. ``start`` makes what a task needs once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = start()
        for batch in batches:
            out = columns(batch.column("text").to_pylist(), *made)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *out.values()], ["doc_id", *out])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {schema}")


def each_copy(alike: DataFrame, n: str, block: int | None = 1 << 16) -> DataFrame:
    """One row per copy of rows with a count ``n``, numbered from 0 as ``_copy``.

    A count beyond ``block`` is dealt to many tasks, a block each; None deals nothing.
    """
    if block is None:
        numbers = F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
        return alike.filter(F.col(n) > 0).withColumn("_copy", F.explode(numbers))
    start = F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(block).cast("long"))
    blocks = alike.filter(F.col(n) > 0).withColumn("_start", F.explode(start))
    tasks = int(alike.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = blocks.filter(F.col(n) > block).repartition(tasks, "_start")
    dealt = blocks.filter(F.col(n) <= block).unionByName(many)
    last = F.least(F.col("_start") + block, F.col(n)) - 1
    return dealt.withColumn("_copy", F.explode(F.sequence("_start", last))).drop("_start")


def take_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, those with the smallest hash of the key: a repeatable sample."""
    return df.orderBy(F.xxhash64(key), key).limit(limit)
