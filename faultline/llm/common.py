"""What the operators share: reading tables, learnable rows, the shared folder, batches of Arrow rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.session import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def held_out(folds: int, fold_out: int) -> Column:
    """Whether nothing may be learned from a row; true for a null id, which no label can name."""
    return F.coalesce(fold("doc_id", folds) == fold_out, F.lit(True))


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the folder that all executors share, and read again: a lost executor costs nothing before this."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold_out: int, per_class: int) -> DataFrame:
    """At most per_class learnable documents with text of either class: those with the smallest hashes of their ids.

    Columns doc_id, text, label. A document labelled twice takes the smaller label; a document id that occurs twice
    in docs may come twice. The ids of the sample are at most 2 * per_class, which bounds the broadcast.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(folds, fold_out))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("label = 0").orderBy(*order).limit(per_class)
    picked = picked.unionByName(known.where("label = 1").orderBy(*order).limit(per_class))
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(picked), "doc_id")


def class_counts(labels: DataFrame, label: str, folds: int, fold_out: int) -> tuple[int, int]:
    """How many learnable rows are labelled 0 and 1: one row of sums."""
    row = (
        labels.where(~held_out(folds, fold_out))
        .agg(F.count(F.when(F.col(label) == 0, 1)).alias("zero"), F.count(F.when(F.col(label) == 1, 1)).alias("one"))
        .first()
    )
    return row["zero"], row["one"]


#: Longer keys are not kept in caches: texts without spaces are single words, and seldom come again.
LONGEST = 64


class Cache(dict):
    """Values by key, computed on first use; emptied when it holds `most` entries of at most LONGEST bytes, which bounds a worker's memory."""

    def __init__(self, make, most: int = 150_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(key) > LONGEST:
            return self.make(key)
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about most_bytes of text at most, or one row, so that a batch of long texts stays small."""
    for batch in batches:
        rows, size = batch.num_rows, batch.column(text).nbytes
        step = max(1, rows * most_bytes // max(size, 1))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def passage(text: bytes, most: int) -> bytes:
    """A text of at most `most` bytes itself; of a longer one whole characters of about that many, from a place chosen by its hash."""
    if len(text) <= most:
        return text
    start = zlib.crc32(text) % (len(text) - most + 1)
    return text[start : start + most].decode("utf-8", "ignore").encode()
