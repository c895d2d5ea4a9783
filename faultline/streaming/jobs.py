"""Reading, running and reading back streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from faultline.contract import EVENT_SCHEMA
from faultline.session import work_path

MESSAGE_SCHEMA = "message_id string, sent_at timestamp_ntz, body string, receive int"
#: A landed line that is no message is kept whole in this column.
BROKEN_LINE = "broken_line"


def message_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Queue messages landed as JSON lines; the schema is fixed, so a new file cannot change it.

    A line that cannot be read comes with its text in broken_line and no other column.
    """
    reader = spark.readStream.schema(f"{MESSAGE_SCHEMA}, {BROKEN_LINE} string").option("columnNameOfCorruptRecord", BROKEN_LINE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stored events as a stream."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def with_event_time(events: DataFrame, delay: str) -> DataFrame:
    """A watermark wants an instant; event times carry no zone and are read as UTC."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def without_zone(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in columns})


#: State on the executor's disk, with only its changes written to the checkpoint: the default keeps all state on the heap, which the
#: keys of duplicate removal outgrow. Sessions of one service meet in one task; merging them before the shuffle as well keeps that small.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with other settings, which are put back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def run_available(spark: SparkSession, writer: DataStreamWriter, checkpoint: str, parts: int | None = None) -> None:
    """Process what is there, then stop. A service would leave the trigger out and keep the query.

    parts: how many state stores each stateful step has, fixed for the life of its checkpoint; the session's shuffle partitions by default.
    """
    with settings(spark, STREAM_SETTINGS | ({"spark.sql.shuffle.partitions": str(parts)} if parts else {})):
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def to_table(stream: DataFrame, path: str, checkpoint: str, parts: int | None = None) -> DataFrame:
    """Append a stream to Parquet and read it back; the file sink lists each batch's files once."""
    spark = stream.sparkSession
    run_available(spark, stream.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint, parts)
    return spark.read.schema(stream.schema).parquet(path)


def materialize(stream: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    spark = stream.sparkSession
    return to_table(stream, work_path(spark, name), work_path(spark, f"{name}-checkpoint"), parts)
