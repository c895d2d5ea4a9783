"""From queue messages to the store, the quarantine, the dead letters and the raw archive.

Each batch may be delivered again after a failure, so every write can be repeated: the store by its
duplicate rule, the others because a batch owns a folder within each day or bucket. How often a message was rejected is kept by message, in hash
buckets, so that its receives may have been sent at any time, and a batch reads the buckets of its own messages and no quarantine.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.ranking import first_of_each
from faultline.operators.quality import MAX_RECEIVES, accepted, parse_messages, rejected
from faultline.sources.buckets import BUCKETS, BucketTable
from faultline.sources.files import folder_names
from faultline.sources.store import append_new
from faultline.streaming.jobs import BROKEN_LINE, MESSAGE_SCHEMA, run_available, settings

MESSAGE_COLUMNS = ["message_id", "sent_at", "body", "receive"]
QUARANTINE_SCHEMA = (
    "message_id string, sent_at timestamp_ntz, body string, receive int, reject_reason string, sent_date date, batch bigint"
)
#: The folder of messages without a time.
NO_DAY = "sent_date=__HIVE_DEFAULT_PARTITION__"
DEAD_LETTER_SCHEMA = "message_id string, receives bigint, reject_reason string, body string, batch bigint"


#: Landed bytes for one task. Landed files may be compressed, and a batch's rows are kept with their bodies, at many times that.
SPLIT_BYTES = 32 << 20


@dataclass(frozen=True)
class Sinks:
    """root: where all sinks are; buckets: those of the message counters, fixed for the life of the sinks."""

    root: str
    buckets: int = BUCKETS

    @property
    def store(self) -> str:
        return f"{self.root}/store"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def dead_letter(self) -> str:
        return f"{self.root}/dead_letter"

    @property
    def receives(self) -> BucketTable:
        """How often each message has been rejected so far."""
        return BucketTable(f"{self.root}/receives", "message_id string, receives bigint", "message_id", self.buckets)

    @property
    def archive(self) -> str:
        return f"{self.root}/archive"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def with_broken_lines(messages: DataFrame) -> DataFrame:
    """Landed lines that are no messages get the line as their body."""
    if BROKEN_LINE not in messages.columns:
        messages = messages.withColumn(BROKEN_LINE, F.lit(None).cast("string"))
    return messages.withColumn("body", F.coalesce(BROKEN_LINE, "body"))


def parse_landed(messages: DataFrame) -> DataFrame:
    """parse_messages, with broken lines rejected as such."""
    parsed = parse_messages(with_broken_lines(messages))
    reason = F.when(F.col(BROKEN_LINE).isNotNull(), F.lit("broken envelope")).otherwise(F.col("reject_reason"))
    return parsed.withColumn("reject_reason", reason)


def _in_days(rows: DataFrame, batch_id: int):
    dated = rows.withColumn("batch", F.lit(batch_id).cast("bigint"))
    return dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sent_date", "batch")


def archive_raw(messages: DataFrame, path: str, batch_id: int) -> None:
    """Whole messages as gzip JSON lines; a line that was no message is archived as it came."""
    line = F.coalesce(BROKEN_LINE, F.to_json(F.struct(*MESSAGE_COLUMNS)))
    lines = messages.select(line.alias("value"), F.to_date("sent_at").alias("sent_date"))
    _in_days(lines, batch_id).option("compression", "gzip").text(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(f"{MESSAGE_SCHEMA}, {BROKEN_LINE} string, sent_date date, batch bigint")
    return reader.option("columnNameOfCorruptRecord", BROKEN_LINE).json(path).drop("sent_date", "batch")


def read_quarantine(spark: SparkSession, sinks: Sinks) -> DataFrame:
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(sinks.quarantine)


def read_quarantine_days(spark: SparkSession, sinks: Sinks, first: dt.date, last: dt.date) -> DataFrame:
    """The quarantine of messages sent on these days or with no time; other days' folders are not listed."""
    days = {f"sent_date={first + dt.timedelta(days=n)}" for n in range((last - first).days + 1)} | {NO_DAY}
    paths = [f"{sinks.quarantine}/{name}" for name in folder_names(spark, sinks.quarantine) if name in days]
    return spark.read.schema(QUARANTINE_SCHEMA).option("basePath", sinks.quarantine).parquet(*paths)


def read_dead_letters(spark: SparkSession, sinks: Sinks) -> DataFrame:
    return spark.read.schema(DEAD_LETTER_SCHEMA).parquet(sinks.dead_letter)


def _write_quarantine(refused: DataFrame, sinks: Sinks, batch_id: int) -> None:
    _in_days(refused.withColumn("sent_date", F.to_date("sent_at")), batch_id).parquet(sinks.quarantine)


def _write_dead_letters(refused: DataFrame, sinks: Sinks, batch_id: int, max_receives: int) -> None:
    """Messages whose number of rejected receives reaches the limit in this batch.

    Broken lines have no message to count receives of. Keys are counted first; bodies are fetched for the letters alone, from this batch.
    """
    spark, table = refused.sparkSession, sinks.receives
    refused = refused.filter(F.col("message_id").isNotNull())
    counted = refused.groupBy("message_id").agg(F.count("*").alias("_now"))
    touched = table.touched(counted)
    if not touched:
        return
    before = table.read(spark, touched, batch_id).withColumnRenamed("receives", "_before")
    totals = counted.join(before, "message_id", "left").select(
        "message_id", F.coalesce("_before", F.lit(0).cast("bigint")).alias("_before"), (F.coalesce("_before", F.lit(0)) + F.col("_now")).alias("receives")
    )
    table.write(totals, batch_id)
    reached = totals.filter((F.col("receives") >= max_receives) & (F.col("_before") < max_receives)).drop("_before")
    bodies = first_of_each(refused.select("message_id", "reject_reason", "body", "receive"), ["message_id"], ["receive"]).drop("receive")
    letters = reached.join(bodies, "message_id").select("message_id", "receives", "reject_reason", "body")
    letters.write.mode("overwrite").parquet(f"{sinks.dead_letter}/batch={batch_id}")
    table.merge(spark, batch_id, touched)


def ingest_batch(messages: DataFrame, batch_id: int, sinks: Sinks, max_receives: int = MAX_RECEIVES) -> None:
    parsed = parse_landed(messages).persist()
    try:
        archive_raw(parsed, sinks.archive, batch_id)
        append_new(accepted(parsed), sinks.store)
        refused = rejected(parsed, MESSAGE_COLUMNS)
        _write_quarantine(refused, sinks, batch_id)
        _write_dead_letters(refused, sinks, batch_id, max_receives)
    finally:
        parsed.unpersist()


def ingest(messages: DataFrame, sinks: Sinks, max_receives: int = MAX_RECEIVES, parts: int | None = None) -> None:
    """Run the ingest over all waiting messages."""
    writer = messages.writeStream.foreachBatch(
        lambda batch, batch_id: ingest_batch(batch, batch_id, sinks, max_receives)
    )
    with settings(messages.sparkSession, {"spark.sql.files.maxPartitionBytes": str(SPLIT_BYTES)}):
        run_available(messages.sparkSession, writer, sinks.checkpoint, parts)
