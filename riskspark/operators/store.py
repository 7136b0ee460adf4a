"""A keyed table that is brought up to date in place: only the buckets that a delta touches are read and written.

A row lies in the bucket of the hash of its key. Every version has a folder of its own that
holds the buckets it wrote, and one small file that names, for each bucket, the version whose
folder has its rows. That file comes last: a run that stops before it has changed nothing, and
a version that someone still reads stays where it is. There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"


@dataclass(frozen=True)
class KeyedStore:
    """``folder`` lies where all executors reach it; ``buckets`` is fixed when the store is made."""

    spark: SparkSession
    folder: str
    key: str
    buckets: int = 256

    def bucket(self, key: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        try:
            found = self.spark.read.schema("bucket int, at long, version long").parquet(f"{self.folder}/manifest")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted(r.version for r in found.select("version").distinct().collect())

    def placed(self, version: int | None = None) -> dict[int, int]:
        """bucket -> version that holds its rows: at most ``buckets`` numbers."""
        version = self.versions()[-1] if version is None else version
        rows = self.spark.read.schema("bucket int, at long").parquet(f"{self.folder}/manifest/version={version}")
        return {r.bucket: r.at for r in rows.collect() if r.at is not None}

    def create(self, rows: DataFrame) -> int:
        """First version, from rows with one row per key; null keys are left out."""
        if self.versions():
            raise ValueError(f"{self.folder} holds a store already")
        schema = rows.schema
        self.spark.createDataFrame([], schema).write.parquet(f"{self.folder}/empty")
        return self._commit(0, rows.filter(F.col(self.key).isNotNull()), {})

    def read(self, version: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version (the newest, if none is named), of some buckets if ``only`` is given."""
        schema = self.spark.read.parquet(f"{self.folder}/empty").schema
        placed = self.placed(version)
        wanted = placed if only is None else {b: placed[b] for b in only if b in placed}
        paths = [f"{self.folder}/data/version={v}/{BUCKET}={b}" for b, v in sorted(wanted.items())]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def upsert(self, keys: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> int:
        """Next version: ``merge`` gets the stored rows of the touched keys and gives their new rows,
        one per key, with the store's columns. All other rows stay as they are; those in
        other buckets are not even read. ``keys``: every key that ``merge`` may give."""
        version = self.versions()[-1]
        named = keys.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        touched = [r[0] for r in named.select(self.bucket()).distinct().collect()]
        before = self.read(version, touched)
        out = before.join(named, self.key, "left_anti").unionByName(merge(before.join(named, self.key, "left_semi")).select(*before.columns))
        return self._commit(version + 1, out, self.placed(version), touched)

    def _commit(self, version: int, rows: DataFrame, placed: dict[int, int], touched: Iterable[int] | None = None) -> int:
        folder = f"{self.folder}/data/version={version}"
        # overwrites what a broken run of the same version has left
        rows.withColumn(BUCKET, self.bucket()).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        have = {r[0] for r in self.spark.read.schema(f"{BUCKET} int").option("basePath", folder).parquet(folder).select(BUCKET).distinct().collect()}
        gone = set(touched or ()) - have
        now = {b: v for b, v in placed.items() if b not in gone} | dict.fromkeys(have, version)
        # a row for every bucket, null for an empty one
        self.spark.createDataFrame([(b, now.get(b)) for b in range(self.buckets)], "bucket int, at long").coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/manifest/version={version}")
        return version
