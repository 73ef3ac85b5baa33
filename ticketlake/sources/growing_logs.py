"""Log files that grow, as a streaming source that reads only what is new.

The offset of the stream is a byte position per file, kept in the query's checkpoint; a
micro-batch reads from the last position to the end of the last whole line, cut into blocks,
one task per block. No byte before the last position is read again. Positions are places of
lines too: two lines follow each other if one starts where the other ends.

Files are opened by pyarrow, on the driver to find a file's last line end and on the executors
to read blocks, so ``path`` is a local folder or a URI of a store that pyarrow knows. A file
that is shorter than its last position was started anew and is read from its start.
"""

from __future__ import annotations

import fnmatch
import io
import re
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: ``limite`` is where the next block starts, ``primeira`` marks a block's first line.
SCHEMA = "log_file string, inicio long, fim long, limite long, primeira boolean, line string"
_ARROW = pa.schema(
    [
        ("log_file", pa.string()), ("inicio", pa.int64()), ("fim", pa.int64()), ("limite", pa.int64()),
        ("primeira", pa.bool_()), ("line", pa.string()),
    ]
)
BLOCK_BYTES, LINES_PER_BATCH, TAIL_BYTES = 16 << 20, 10_000, 1 << 16
# Line ends beside \n that also end a line of captured output.
_LINE_END = re.compile(rb"\r\n|[\n\r\x0b\x0c\x1c-\x1e]|\xc2\x85|\xe2\x80[\xa8\xa9]")


@dataclass
class Block(InputPartition):
    """Lines of a file that start in [lo, hi); the batch's lines start at ``base``."""

    path: str
    base: int
    lo: int
    hi: int
    stop: int


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class GrowingLogsReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.glob = options["path"], options.get("glob", "*.log")
        self.block = int(options.get("blockbytes", BLOCK_BYTES))
        self.closed = float(options.get("closedafterseconds", 3600))

    def initialOffset(self) -> dict:
        return {}

    def _whole(self, store: fs.FileSystem, file: fs.FileInfo) -> int:
        """End of the file's last whole line; of the file, if nobody writes it any more."""
        if file.mtime is not None and time.time() - file.mtime.timestamp() > self.closed:
            return file.size
        with store.open_input_file(file.path) as stream:
            end = file.size
            while end > 0:
                start = max(end - TAIL_BYTES, 0)
                stream.seek(start)
                at = stream.read(end - start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                end = start
        return 0

    def latestOffset(self) -> dict:
        store, folder = _open(self.path)
        found = store.get_file_info(fs.FileSelector(folder))
        files = [f for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, self.glob)]
        return {f.path: self._whole(store, f) for f in sorted(files, key=lambda f: f.path)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        blocks = []
        for path, stop in end.items():
            base = start.get(path, 0)
            base = 0 if base > stop else base
            blocks += [Block(path, base, lo, min(lo + self.block, stop), stop) for lo in range(base, stop, self.block)]
        return blocks

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        store, _ = _open(self.path)
        rows: list[tuple] = []
        with store.open_input_file(partition.path) as source:
            stream, at = io.BufferedReader(source, 1 << 20), partition.lo
            if at > partition.base:  # the line that crosses into this block belongs to the one before
                stream.seek(at - 1)
                at += len(stream.readline()) - 1
            else:
                stream.seek(at)
            first = True
            while at < partition.hi:
                raw = stream.readline(partition.stop - at)
                if not raw:
                    break
                for start, end, line in _lines(raw, at):
                    rows.append((partition.path, start, end, partition.hi, first, line))
                    first = False
                at += len(raw)
                if len(rows) >= LINES_PER_BATCH:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _lines(raw: bytes, at: int) -> Iterator[tuple[int, int, str]]:
    """Lines in the bytes up to a line feed, with their places."""
    start = 0
    for end in _LINE_END.finditer(raw):
        yield at + start, at + end.end(), raw[start : end.start()].decode(errors="replace")
        start = end.end()
    if start < len(raw):
        yield at + start, at + len(raw), raw[start:].decode(errors="replace")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW, strict=True)], schema=_ARROW)


class GrowingLogs(DataSource):
    """Options: ``path`` (a folder), ``glob``, ``blockBytes``, ``closedAfterSeconds``."""

    @classmethod
    def name(cls) -> str:
        return "growing_logs"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return GrowingLogsReader(self.options)


def read_growing_logs(spark: SparkSession, path: str, **options):
    """Streaming frame of the new lines of all log files in a folder."""
    spark.dataSource.register(GrowingLogs)
    return spark.readStream.format("growing_logs").options(**options).load(path)
