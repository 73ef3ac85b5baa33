"""Production table as Parquet files in buckets of its key; a batch rewrites what it touches.

Rows lie in folders per bucket, a hash of the key. A batch writes the buckets its keys fall
into as a new generation of folders, next to those that readers use; the other buckets stay
where they are. A version is one small pointer file that names the generation of each bucket,
and one row of the commit table. No path that is being read is ever overwritten.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.session import read_rows, remove_path, write_observed
from ticketlake.spec import PROBLEMS, TableSpec

BUCKET = "_balde"
_COMMITS = T.StructType(
    [
        T.StructField("versao", T.LongType()),
        T.StructField("id_lote", T.StringType()),
        T.StructField("dt_registro", T.TimestampNTZType()),
        T.StructField("qt_baldes", T.IntegerType()),
        T.StructField("nm_pasta", T.StringType()),
        T.StructField("ds_esquema", T.StringType()),
    ]
)
_POINTERS = f"{BUCKET} int, nm_pasta string"


class ConcurrentCommit(RuntimeError):
    """Another batch was committed after this one had read the table."""


def literal_path(path: str) -> str:
    """A path whose brackets, stars and the like are no pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


@dataclass(frozen=True)
class SnapshotTable:
    """``buckets`` counts for a new table; one that exists keeps its own count."""

    path: str
    spec: TableSpec = PROBLEMS
    buckets: int = 64

    # Versions ---------------------------------------------------------------------------
    def commits(self, spark: SparkSession) -> DataFrame:
        return read_rows(spark, f"{self.path}/commits", _COMMITS)

    def committed_version(self, spark: SparkSession, batch_id: str) -> int | None:
        """Version a batch produced, if it was committed before."""
        return self.commits(spark).filter(F.col("id_lote") == batch_id).agg(F.max("versao")).first()[0]

    def _newest(self, spark: SparkSession) -> T.Row | None:
        """Last commit that has data."""
        state = F.struct("versao", "nm_pasta", "qt_baldes", "ds_esquema")
        return self.commits(spark).filter("nm_pasta IS NOT NULL").agg(F.max(state).alias("c")).first()["c"]

    def pointers(self, spark: SparkSession, folder: str | None) -> dict[int, str]:
        """Generation of each bucket that has rows, in the version a pointer file describes."""
        if folder is None:
            return {}
        rows = spark.read.schema(_POINTERS).parquet(f"{self.path}/pointers/{folder}")
        return {r[BUCKET]: r["nm_pasta"] for r in rows.collect()}  # one row per bucket

    # Reading ----------------------------------------------------------------------------
    def current(self, spark: SparkSession) -> tuple[int, DataFrame]:
        """Newest committed version; version 0 is an empty table."""
        return self.part(spark, None)

    def part(self, spark: SparkSession, buckets: Collection[int] | None) -> tuple[int, DataFrame]:
        """Newest version, and its rows in some buckets (None for all); no other is read."""
        last = self._newest(spark)
        if last is None:
            return 0, spark.createDataFrame([], self.spec.production_schema())
        schema = T.StructType.fromJson(json.loads(last["ds_esquema"]))
        known = self.pointers(spark, last["nm_pasta"])
        wanted = sorted(known if buckets is None else known.keys() & set(buckets))
        if not wanted:
            return last["versao"], spark.createDataFrame([], schema)
        paths = [literal_path(f"{self.path}/data/{known[b]}/{BUCKET}={b}") for b in wanted]
        return last["versao"], spark.read.schema(schema).parquet(*paths)

    def bucket(self, spark: SparkSession, key: str | None = None) -> Column:
        """Bucket of a key: the hash that shuffles use, so that tasks of a shuffle by the key
        hold few buckets each."""
        return F.pmod(F.hash(key or self.spec.key), F.lit(self._count(spark)))

    def _count(self, spark: SparkSession) -> int:
        last = self._newest(spark)
        return last["qt_baldes"] if last else self.buckets

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets that the rows' keys fall into; no more than the table has."""
        rows = keys.filter(F.col(self.spec.key).isNotNull())
        found = rows.select(self.bucket(keys.sparkSession).alias(BUCKET)).distinct().collect()
        return sorted(r[BUCKET] for r in found)

    def tasks(self, spark: SparkSession) -> int:
        """Tasks for a shuffle by the key whose every task writes one bucket: a multiple of
        the buckets, not below the session's number."""
        wanted, buckets = int(spark.conf.get("spark.sql.shuffle.partitions")), self._count(spark)
        return buckets * -(-wanted // buckets)

    # Writing ----------------------------------------------------------------------------
    def write(self, df: DataFrame, version: int) -> str:
        """Write rows into a new generation; nobody reads it yet."""
        return self.write_observed(df, version, qt_linhas=F.count("*"))[0]

    def write_observed(self, df: DataFrame, version: int, **metrics: Column) -> tuple[str, dict[str, Any]]:
        """As ``write``, with metrics of the rows written.

        Columns whose names start with an underscore are written for ``written`` and are
        no part of the table.
        """
        folder = f"v={version}-{uuid.uuid4().hex}"
        rows = df.withColumn(BUCKET, self.bucket(df.sparkSession))
        return folder, write_observed(rows, f"{self.path}/data/{folder}", (BUCKET,), **metrics)

    def written(self, spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
        """Columns of a generation as it was written."""
        return spark.read.schema(schema).parquet(f"{self.path}/data/{folder}")

    def _folders(self, spark: SparkSession, path: str) -> list[str]:
        """Names in a folder, none if it is absent."""
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []

    def commit(
        self,
        spark: SparkSession,
        base: int,
        folder: str | None,
        batch_id: str,
        ts: dt.datetime,
        columns: T.StructType | None = None,
        touched: Sequence[int] | None = None,
    ) -> int:
        """Make a written generation the next version after ``base``.

        ``touched`` names the buckets it replaces (None for all). Without a folder the batch
        is noted as done and the version stays. Refuses if the table moved on since ``base``
        was read: the batch must merge again.
        """
        last = self._newest(spark)
        version, buckets = (last["versao"], last["qt_baldes"]) if last else (0, self.buckets)
        if folder is None:
            row = (version, batch_id, ts, buckets, None, None)
        elif version != base:
            raise ConcurrentCommit(f"version is {version}, the batch was merged into {base}")
        else:
            kept = self.pointers(spark, last["nm_pasta"] if last else None)
            kept = {b: f for b, f in kept.items() if touched is not None and b not in touched}
            names = [n for n in self._folders(spark, f"{self.path}/data/{folder}") if n.startswith(f"{BUCKET}=")]
            kept |= {int(n.partition("=")[2]): folder for n in names}
            rows = spark.createDataFrame(sorted(kept.items()), _POINTERS).coalesce(1)
            rows.write.mode("overwrite").parquet(f"{self.path}/pointers/{folder}")
            schema = columns or self.spec.production_schema()
            row = (version + 1, batch_id, ts, buckets, folder, schema.json())
        spark.createDataFrame([row], _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return row[0]

    def publish(self, df: DataFrame, batch_id: str, ts: dt.datetime) -> int:
        """Write and commit all rows as the next version, once per batch id."""
        spark = df.sparkSession
        done = self.committed_version(spark, batch_id)
        if done is not None:
            return done
        last = self._newest(spark)
        base = last["versao"] if last else 0
        rows = df.repartition(self.tasks(spark), F.col(self.spec.key))
        return self.commit(spark, base, self.write(rows, base + 1), batch_id, ts, df.schema)

    def expire(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Remove the bucket folders that none of the newest ``keep`` versions points to, also
        those of attempts that old which were never committed."""
        kept = self.commits(spark).filter("nm_pasta IS NOT NULL").select("versao", "nm_pasta").distinct()
        newest = {r["nm_pasta"]: r["versao"] for r in kept.orderBy(F.desc("versao")).limit(keep).collect()}
        if not newest:
            return []
        used = {(b, f) for pointer in newest for b, f in self.pointers(spark, pointer).items()}
        removed = []
        for folder in self._folders(spark, f"{self.path}/data"):
            version = int(folder.removeprefix("v=").partition("-")[0])
            if folder in newest or version > max(newest.values()) - keep:
                continue
            alive = {f"{BUCKET}={b}" for b, f in used if f == folder}
            names = self._folders(spark, f"{self.path}/data/{folder}")
            old = [f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET}=") and n not in alive]
            for name in old if alive else [folder]:
                remove_path(spark, f"{self.path}/data/{name}")
                removed.append(name)
            remove_path(spark, f"{self.path}/pointers/{folder}")
        return sorted(removed)
