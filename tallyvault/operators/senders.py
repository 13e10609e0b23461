"""Exact distinct senders that add up: dense account numbers and one bitmap a day.

A count of distinct senders can't be summed over days, so a month's or a year's number would need
all of its rows again.  Here every account gets a dense number once; a day's senders of a currency
are bitmaps over these numbers (4 KiB for each 32,768 accounts), and any set of days is the union of
their bitmaps.  A late day replaces its own bitmaps and nothing else.

Both aggregates combine before their shuffle, so a currency that holds much of the rows sends one
bitmap per task and block of numbers, not its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .mart import joined_rows

NUMBERS = "account long, number long"
BITMAPS = "currency_code long, block long, senders binary, day date"
#: Parts in which new accounts are numbered side by side.
NUMBERED_IN = 64
PERIODS = ("day", "month", "year")


def dense_numbers(accounts: DataFrame, last: int = 0) -> DataFrame:
    """(account, number): numbers from ``last`` + 1 on without gaps, the same for the same accounts.

    Accounts are numbered within parts; a part begins where the ones before it end, by a table of
    ``NUMBERED_IN`` counts.
    """
    parted = accounts.select("account").distinct().withColumn("_part", F.pmod(F.xxhash64("account"), F.lit(NUMBERED_IN)).cast("int"))
    inside = parted.withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy("account")))
    sizes = parted.groupBy(F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (inside.join(starts, F.col("_part") == F.col("_p"))
            .select("account", (F.lit(last) + F.col("_start") + F.col("_place")).cast("long").alias("number")))


def day_bitmaps(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """(currency_code, block, senders, day) of rows with (day, currency_code, account)."""
    numbered = rows.select("day", "currency_code", "account").join(numbers, "account")
    return (numbered.groupBy("day", F.col("currency_code").cast("long").alias("currency_code"), F.bitmap_bucket_number("number").alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("senders"))
            .select("currency_code", "block", "senders", "day"))


def senders_of(bitmaps: DataFrame, period: str) -> DataFrame:
    """(period_start, currency_code, senders): exact distinct senders of every day, month or year."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    start = F.trunc("day", period) if period != "day" else F.col("day")
    merged = (bitmaps.groupBy(start.alias("period_start"), "currency_code", "block").agg(F.bitmap_or_agg("senders").alias("senders")))
    return merged.groupBy("period_start", "currency_code").agg(F.sum(F.bitmap_count("senders")).cast("long").alias("senders"))


class SenderIndex:
    """The numbers and the bitmaps of a root, kept up day by day."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.path = spark, f"{root.rstrip('/')}/senders"

    def _table(self, name: str, schema: str) -> DataFrame:
        from ..plans.pipeline import read_table

        return read_table(self.spark, f"{self.path}/{name}", self.spark.createDataFrame([], schema).schema)

    def numbers(self) -> DataFrame:
        return self._table("numbers", NUMBERS)

    def bitmaps(self) -> DataFrame:
        return self._table("bitmaps", BITMAPS)

    def update(self, vault: dict[str, DataFrame], days: list) -> None:
        """Bring in some days, or bring them in again: new accounts get the next numbers, the days' bitmaps are replaced.

        A broken update can be repeated: accounts that were numbered keep their numbers.
        """
        from ..plans.storage import clear_days, exists, write_read

        rows = joined_rows(vault, min(days), max(days)).where(F.col("day").isin(list(days))).select("day", "currency_code", "account").distinct()
        work = f"{self.path}/_rows"
        rows = write_read(rows, work)
        known = self.numbers()
        last = known.agg(F.max("number")).first()[0] or 0
        new = dense_numbers(rows.join(known, "account", "left_anti"), last)
        new.write.mode("append" if exists(self.spark, f"{self.path}/numbers") else "overwrite").parquet(f"{self.path}/numbers")
        fresh = write_read(day_bitmaps(rows, self.numbers()), f"{self.path}/_fresh")
        clear_days(self.spark, f"{self.path}/bitmaps", days, column="day")      # a day may have no senders any more
        fresh.write.mode("append").partitionBy("day").parquet(f"{self.path}/bitmaps")

    def report(self, period: str) -> DataFrame:
        return senders_of(self.bitmaps(), period)
