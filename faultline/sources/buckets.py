"""Rows by key in hash buckets, for state that batches look up and change: a batch reads and writes only the buckets its keys fall in.

Layout: <path>/of_<buckets>/bucket=<b>/version=<v>. Batch n writes the rows it changes as version 2n, and may leave everything a bucket
holds as version 2n + 1, its base. The state before batch n is the newest base below 2n with the changes after it, the newest row of each key. So a
batch that is delivered again reads what it read the first time and overwrites what it wrote.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.sources.files import delete_folders, folder_names, glob_folders, path_exists

#: Keys are spread evenly by hash, so a bucket is this part of the table, and a batch writes at most so many files. Fixed for the life of a table: take
#: so many that a bucket's keys are work for one task, thousands for tables of 10^11 keys.
BUCKETS = 64
#: Changes a bucket gathers before they are merged into a new base.
MERGE_AFTER = 16
#: Batches that can still be delivered again, as Spark's own state keeps them.
KEEP = 100


@dataclass(frozen=True)
class BucketTable:
    """schema: the columns of a row, key among them."""

    path: str
    schema: str
    key: str
    buckets: int = BUCKETS

    @property
    def root(self) -> str:
        return f"{self.path}/of_{self.buckets}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of these rows: at most `buckets` numbers, distinct in each task before they meet."""
        return sorted(row[0] for row in rows.select(self.bucket()).distinct().collect())

    def versions(self, spark: SparkSession) -> dict[int, list[int]]:
        """The versions of each bucket, oldest first, by one listing."""
        if path_exists(spark, self.path) and [name for name in folder_names(spark, self.path) if name != f"of_{self.buckets}"]:
            raise ValueError(f"{self.path} has another number of buckets")
        found: dict[int, list[int]] = {}
        for name in glob_folders(spark, f"{self.root}/bucket=*/version=*"):
            if match := re.search(r"bucket=(\d+)/version=(\d+)$", name):
                found.setdefault(int(match[1]), []).append(int(match[2]))
        return {bucket: sorted(versions) for bucket, versions in found.items()}

    def _parts(self, versions: dict[int, list[int]], touched: Sequence[int], before: int) -> list[tuple[int, int]]:
        parts = []
        for bucket in touched:
            older = [v for v in versions.get(bucket, ()) if v < 2 * before]
            base = max((v for v in older if v % 2), default=0)
            parts += [(bucket, v) for v in older if v >= base]
        return parts

    def _read(self, spark: SparkSession, parts: Sequence[tuple[int, int]]) -> DataFrame:
        schema = f"{self.schema}, bucket int, version bigint"
        paths = [f"{self.root}/bucket={bucket}/version={version}" for bucket, version in parts]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", self.root).parquet(*paths)

    def read(self, spark: SparkSession, touched: Sequence[int], before: int) -> DataFrame:
        """The rows of these buckets as batch `before` finds them, one for each key, with their bucket."""
        return self._newest(self._read(spark, self._parts(self.versions(spark), touched, before)))

    def read_all(self, spark: SparkSession, touched: Sequence[int], before: int) -> DataFrame:
        """As read, for tables whose keys are written once: no row is looked for twice."""
        return self._read(spark, self._parts(self.versions(spark), touched, before)).drop("version")

    def _newest(self, rows: DataFrame) -> DataFrame:
        names = [name for name in rows.columns if name not in (self.key, "bucket", "version")]
        newest = F.max_by(F.struct(*names), "version").alias("_row")
        return rows.groupBy(self.key, "bucket").agg(newest).select(self.key, "bucket", "_row.*")

    def _write(self, rows: DataFrame, version: int) -> None:
        placed = rows.withColumns({"bucket": self.bucket(), "version": F.lit(version).cast("bigint")})
        names = [part.split()[0] for part in self.schema.split(", ")]
        # A bucket is written by one task; keys are distinct, so hashing them leaves no bucket larger than others.
        ordered = placed.select(*names, "bucket", "version").repartition("bucket").sortWithinPartitions("bucket", self.key)
        ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(self.root)

    def write(self, rows: DataFrame, batch: int) -> None:
        """The rows that batch adds or changes, one for each key."""
        self._write(rows, 2 * batch)

    def merge(self, spark: SparkSession, batch: int, touched: Sequence[int], keep: Column | None = None, after: int = MERGE_AFTER) -> list[int]:
        """Write a new base for those buckets that have gathered enough changes, of rows that meet `keep`, and drop versions no batch can ask for."""
        versions = self.versions(spark)
        parts = self._parts(versions, touched, batch + 1)
        full = [b for b in touched if sum(part == b and v % 2 == 0 for part, v in parts) >= after]
        if full:
            rows = self._newest(self._read(spark, [part for part in parts if part[0] in set(full)]))
            self._write(rows if keep is None else rows.filter(keep), 2 * batch + 1)
        old = []
        for bucket, found in versions.items():
            base = max((v for v in found if v % 2 and v < 2 * (batch - KEEP)), default=0)
            old += [f"{self.root}/bucket={bucket}/version={v}" for v in found if v < base]
        delete_folders(spark, old)
        return full
