"""The services of a store by day, kept beside it, so that names can be compared loosely and looked up exactly.

A collation that ignores case and accents cannot be pushed into a scan. The spellings that a store holds are few, so they are compared instead,
and those that match are looked up as they are written, which prunes days, row groups and pages like any exact name. A day is read anew, its service
column alone, when its listing is not the one its names were taken from.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.contract import LOOSE_COLLATION
from faultline.sources.files import folder_names, path_exists
from faultline.sources.store import day_directories, read_store

SCHEMA = "service string, listing bigint, event_date date"


def _table(path: str) -> str:
    return f"{path.rstrip('/')}.services"


def _listing(spark: SparkSession, folder: str) -> int:
    return zlib.crc32("\n".join(sorted(n for n in folder_names(spark, folder) if n.endswith(".parquet"))).encode())


def services(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The distinct services of the stored days from `first` to `last`: service."""
    days = {day: folder for day, folder in day_directories(spark, path).items() if (first is None or day >= first) and (last is None or day <= last)}
    now = {day: _listing(spark, folder) for day, folder in days.items()}
    known: dict[dt.date, int] = {}
    if path_exists(spark, _table(path)):
        rows = _names(spark, path, now).select("event_date", "listing").distinct().collect()
        known = {row["event_date"]: row["listing"] for row in rows}
    stale = [day for day, listing in now.items() if known.get(day) != listing]
    if stale:
        taken = spark.createDataFrame([(day, now[day]) for day in stale], "event_date date, listing bigint")
        found = read_store(spark, path).filter(F.col("event_date").isin(stale)).select("event_date", "service").distinct().join(F.broadcast(taken), "event_date")
        writer = found.select("service", "listing", "event_date").repartition("event_date").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(_table(path))
    return _names(spark, path, now).select("service").distinct()


def _names(spark: SparkSession, path: str, days: Iterable[dt.date]) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(_table(path)).filter(F.col("event_date").isin(list(days)))


def spellings(spark: SparkSession, path: str, name: str, first: dt.date | None = None, last: dt.date | None = None) -> list[str]:
    """How a store spells a service whose name is given without regard to case, accents and trailing spaces."""
    if not day_directories(spark, path):
        return []
    same = F.collate("service", LOOSE_COLLATION) == F.collate(F.lit(name), LOOSE_COLLATION)
    return sorted(row[0] for row in services(spark, path, first, last).filter(same).collect())
