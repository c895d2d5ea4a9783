"""Ranks and nearest-rank percentiles that never put all rows of a key into one task.

Everything starts from the count of rows per (key, value), which is combined on the map side, so a
key with a third of all rows costs no more after the shuffle than its number of distinct values.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sorts before every 32-bit value; stands for NULL, which ranks first.
_NULL_KEY = -(2**31) - 1
_LOW_BITS = 16


def rank_key(value: str) -> Column:
    return F.coalesce(F.col(value).cast("bigint"), F.lit(_NULL_KEY).cast("bigint"))


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows per (keys, value); value may be NULL."""
    return df.groupBy(*keys, value).agg(F.count("*").alias("n"))


def value_runs(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each distinct value, given with its row count n, and the row numbers its rows take in its order.

    All rows of one value are neighbours in ROW_NUMBER() OVER (PARTITION BY keys ORDER BY value), so
    first_rn, last_rn and cnt say all that the row-by-row numbering says. Rows of smaller high bits are summed first,
    so no window sees more than 65,537 rows of one key.
    """
    counts = counts.withColumn("_run_key", rank_key(value)).withColumn("_run_high", F.shiftright("_run_key", _LOW_BITS))
    earlier = Window.partitionBy(*keys).orderBy("_run_high").rowsBetween(Window.unboundedPreceding, -1)
    highs = (
        counts.groupBy(*keys, "_run_high")
        .agg(F.sum("n").alias("_run_n"))
        .withColumn("_run_before", F.coalesce(F.sum("_run_n").over(earlier), F.lit(0)))
        .withColumn("cnt", F.sum("_run_n").over(Window.partitionBy(*keys)))
        .drop("_run_n")
    )
    within = Window.partitionBy(*keys, "_run_high").orderBy("_run_key").rowsBetween(Window.unboundedPreceding, 0)
    return (
        counts.join(highs, [*keys, "_run_high"])
        .withColumn("last_rn", F.col("_run_before") + F.sum("n").over(within))
        .withColumn("first_rn", F.col("last_rn") - F.col("n") + 1)
        .drop("_run_key", "_run_high", "_run_before")
    )


def target_rank(q: str, cnt: Column) -> Column:
    """CEIL(q * cnt) in decimals; a double product can land just above a whole number."""
    return F.ceil(F.lit(Decimal(q)) * cnt.cast("decimal(19,0)")).cast("bigint")


def values_at(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """The 32-bit integers at given ranks of each key, NULLs counted and ranked first; one column for each rank.

    ranks: by name, the rank as an expression of the column cnt, the key's number of rows. Two steps down a histogram:
    the high 16 bits find the bucket that holds the rank, then only the values of that bucket are walked. No window sees
    more than 65,537 rows of one key, whatever the number of rows or of distinct values.
    """
    return values_at_counts(value_counts(df, keys, value), keys, value, ranks)


def values_at_counts(counts: DataFrame, keys: list[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """values_at for rows that are counted already: one row for each key and value, with their number n."""
    counts = counts.withColumn("_key", rank_key(value))
    counts = counts.withColumn("_high", F.shiftright("_key", _LOW_BITS))

    by_high = Window.partitionBy(*keys).orderBy("_high").rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("bigint").alias("rank")) for name, rank in ranks.items()]))
    buckets = (
        counts.groupBy(*keys, "_high")
        .agg(F.sum("n").alias("_in_bucket"))
        .withColumn("_upto", F.sum("_in_bucket").over(by_high))
        .withColumn("cnt", F.sum("_in_bucket").over(Window.partitionBy(*keys)))
        .withColumn("_rank", wanted)
        .filter((F.col("_upto") >= F.col("_rank.rank")) & (F.col("_upto") - F.col("_in_bucket") < F.col("_rank.rank")))
        .select(*keys, "_high", F.col("_rank.name").alias("_name"), (F.col("_rank.rank") - F.col("_upto") + F.col("_in_bucket")).alias("_left"))
    )
    by_value = Window.partitionBy(*keys, "_name").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    # A NULL key is a key like any other.
    buckets = buckets.withColumnsRenamed({k: f"_in_{k}" for k in (*keys, "_high")})
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_in_{k}")) for k in (*keys, "_high")))
    found = (
        counts.join(buckets, same)
        .withColumn("_upto", F.sum("n").over(by_value))
        .filter((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("n") < F.col("_left")))
    )
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == name, F.col(value))).alias(name) for name in ranks])


def nearest_rank(df: DataFrame, keys: list[str], value: str, q: str, out: str) -> DataFrame:
    """The 32-bit integer at rank CEIL(q * rows) of each key, NULLs counted and ranked first."""
    return values_at(df, keys, value, {out: target_rank(q, F.col("cnt"))})


def median_ranks() -> dict[str, Column]:
    """The ranks of the one or two values in the middle."""
    return {"_low": F.expr("(cnt + 1) div 2"), "_high_value": F.expr("cnt div 2 + 1")}


def median_of_ranks(out: str) -> Column:
    return ((F.col("_low").cast("double") + F.col("_high_value")) / 2).alias(out)


def median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """The median of the non-NULL 32-bit integers of each key, half-way between the two in the middle of an even number."""
    middle = values_at(df.filter(F.col(value).isNotNull()), keys, value, median_ranks())
    return middle.select(*keys, median_of_ranks(out))


def tie_shift(df: DataFrame, tie: str) -> int:
    """Low bits of the tie that one block spans: at most 2**20 blocks, and no less than 2**16 ties each.

    Read from one row of minimum and maximum. Dense ids up to 2**40 give blocks of at most 2**20 rows;
    hashed ids spread evenly over their blocks.
    """
    lo, hi = df.agg(F.min(tie), F.max(tie)).first()
    return 16 if lo is None else max(16, (hi - lo).bit_length() - 20)


def row_numbers(df: DataFrame, key: str, value: str, tie: str, shift: int | None = None) -> DataFrame:
    """Every row with its ROW_NUMBER over (key, ordered by value and tie) and the key's row count.

    A window over the key would sort all its rows in one task. The number is instead a sum of three
    offsets: rows of smaller values, rows of the same value in blocks of smaller ties, and the place
    within (key, value, block). Only the last sorts rows, and unique ties bound a block, so that even
    a key whose rows all have one value is spread out.
    """
    shift = tie_shift(df, tie) if shift is None else shift
    blocked = df.select(key, value, tie, rank_key(value).alias("_key"), F.shiftright(tie, shift).alias("_block"))
    earlier = Window.partitionBy(key, "_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    counts = blocked.groupBy(key, "_key", "_block").agg(F.count("*").alias("n"))
    blocks = counts.select(key, "_key", "_block", (F.sum("n").over(earlier) - F.col("n")).alias("_before_block"))
    runs = value_runs(counts.groupBy(key, "_key").agg(F.sum("n").alias("n")), [key], "_key").select(
        key, "_key", (F.col("first_rn") - 1).alias("_before_value"), "cnt"
    )
    place = F.row_number().over(Window.partitionBy(key, "_key", "_block").orderBy(tie))
    number = F.col("_before_value") + F.col("_before_block") + F.col("_place")
    return (
        blocked.withColumn("_place", place)
        .join(blocks.join(runs, [key, "_key"]), [key, "_key", "_block"])
        .select(tie, key, value, number.alias("rn"), "cnt")
    )


def first_of_each(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key in a full order.

    The rank filter is applied before the shuffle as well, so a key with many copies sends one row
    per map task. dropDuplicates would keep any of the rows.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", first).filter(F.col("_rn") == 1).drop("_rn")
