"""Files of a folder that are no longer being written, as a stream.

Spark's file source hands a file over at first sight, even if it is still being copied. Here
a folder is looked at again and again; each look notes path, size and time of every file. The
notes are a stream with state per path: a file is released when two looks at least some
seconds apart found the same size and time, and once per such state. A file that is written
anew later is released again.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ticketlake.functions.columns import file_path
from ticketlake.spec import PATH, SETTLE_SECONDS

SIGHTING = f"{PATH} string, tamanho long, modificado long, visto timestamp"
_STATE = "tamanho long, modificado long, desde long, solto boolean"
_RELEASED = f"{PATH} string, tamanho long"
# A path that no look has found for so long is forgotten.
FORGET_DAYS = 30


def sight(spark: SparkSession, directory: str, sightings: str, glob: str) -> None:
    """Note the files that are in a folder now; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
    now = F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    notes = files.select(
        file_path().alias(PATH), F.col("length").alias("tamanho"),
        F.unix_micros("modificationTime").alias("modificado"), now.alias("visto"),
    )
    notes.write.mode("append").parquet(sightings)


def _release(seconds: float):
    wait = int(seconds * 1_000_000)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        size, changed, since, free = state.get if state.exists else (None, None, 0, False)
        rows = pd.concat(frames).sort_values("micros")
        released = []
        for row in rows.itertuples(index=False):
            if (row.tamanho, row.modificado) != (size, changed):
                size, changed, since, free = row.tamanho, row.modificado, row.micros, False
            elif not free and size > 0 and row.micros - since >= wait:
                free = True
                released.append((key[0], size))
        state.update((int(size), int(changed), int(since), free))
        last = int(rows["micros"].max()) // 1000
        state.setTimeoutTimestamp(last + FORGET_DAYS * 86_400_000)
        yield pd.DataFrame(released, columns=[PATH, "tamanho"])

    return run


def settled(sightings: DataFrame, seconds: float = SETTLE_SECONDS) -> DataFrame:
    """Released files of a stream of sightings, a row per release."""
    noted = sightings.withWatermark("visto", "0 seconds").withColumn("micros", F.unix_micros("visto"))
    return noted.groupBy(PATH).applyInPandasWithState(
        _release(seconds), _RELEASED, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def look(spark: SparkSession, directory: str, sightings: str, glob: str, seconds: float = SETTLE_SECONDS) -> None:
    """Two looks, far enough apart for a file that rests to be released by this call."""
    sight(spark, directory, sightings, glob)
    time.sleep(seconds)
    sight(spark, directory, sightings, glob)


def settled_stream(spark: SparkSession, sightings: str, seconds: float = SETTLE_SECONDS) -> DataFrame:
    """Released files as a streaming frame over the folder of sightings.

    Notes that were taken in are deleted by the source.
    """
    notes = spark.readStream.schema(SIGHTING).option("cleanSource", "delete").parquet(sightings)
    return settled(notes, seconds)
