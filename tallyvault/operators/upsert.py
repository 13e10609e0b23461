"""Upsert (MERGE) of the metrics mart.

MERGE semantics: a source row whose key matches a target row replaces its
four measures, an unmatched source row is inserted, and target rows with
no source row are kept.  On plain Parquet that is "target minus matched
keys, plus source", computed only over the partitions the source touches
and swapped in with a dynamic partition overwrite.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..schemas import GLOBAL_METRICS, MART_KEY


def upsert(target: DataFrame, source: DataFrame, key: list[str] = MART_KEY) -> DataFrame:
    cols = target.columns
    return target.join(source.select(*key), key, "left_anti").select(*cols) \
        .unionByName(source.select(*cols))


def upsert_table(spark: SparkSession, path: str, source: DataFrame, key: list[str] = MART_KEY,
                 partition_col: str = "date_update") -> None:
    """Merge ``source`` into the Parquet table at ``path``.

    The source is computed once, into a folder beside the target.  Only the
    partitions present in it are read and rewritten; the merged rows are
    written beside the target too before they replace it, so the overwrite
    never reads the files it replaces, and a failed run can be repeated.  An
    empty source changes nothing.
    """
    from ..plans.storage import remove, write_read

    work = f"{path.rstrip('/')}__merge-{uuid.uuid4().hex[:12]}"
    cols = GLOBAL_METRICS.fieldNames()
    try:
        staged = write_read(source.select(*cols), f"{work}/source")
        # Semi join on the partition column: dynamic partition pruning reads
        # only the days the source touches.
        touched = staged.select(partition_col).distinct()
        table = mart_table(spark, path)
        if table.groups():          # days kept in a month or a year get folders of their own again
            table.reopen([r[0] for r in touched.collect()])
        target = read_mart(spark, path).join(touched, partition_col, "left_semi")
        merged = write_read(upsert(target, staged, key).select(*cols), f"{work}/merged")
        (merged.repartition(partition_col).sortWithinPartitions(*key).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))
    finally:
        remove(spark, work)


def mart_table(spark: SparkSession, path: str):
    """The stored mart by day, closed days by month and year."""
    from ..plans.calendar_table import CalendarTable

    return CalendarTable(spark, path, GLOBAL_METRICS, day="date_update", sort=["currency_from"])


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """The stored mart, empty when nothing was ever written."""
    return mart_table(spark, path).rows()
