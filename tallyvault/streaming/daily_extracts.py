"""Catch-up loading of daily extracts with Structured Streaming.

The reference schedules one run per day with catch-up and one active run
at a time.  Here a file stream watches the CSV extract folders of both
tables, and ``foreachBatch`` runs the daily loads, in day order, for every
day of which files arrived.  A day is always loaded whole and its staging
rows and satellites are replaced, so a day whose files come in several
batches, or a batch that is replayed after a failure, gives the same vault
as one load of the day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import pipeline as P
from ..plans.storage import has_days


def start(spark: SparkSession, root: str, checkpoint: str, load_dt=None,
          rate_mode: str = "reference", available_now: bool = True) -> StreamingQuery:
    files = None
    for table in P.STG_SCHEMAS:
        path = f"{root}/extract/{table}"
        if has_days(spark, path):
            one = spark.readStream.schema("value string, ds date").format("text").load(path).select("ds")
            files = one if files is None else files.unionByName(one)
    if files is None:
        raise ValueError(f"no extract folder under {root}/extract")

    def load_batch(batch: DataFrame, _epoch: int) -> None:
        # Days present in this micro-batch: a handful of dates, not rows.
        days = sorted(r[0] for r in batch.distinct().collect())
        for ds in days:
            for table in P.STG_SCHEMAS:
                P.load_days(spark, root, table, [ds], load_dt, replace_slice=True)
            P.load_vault_day(spark, root, ds, load_dt, replace_slice=True)
            P.load_mart_day(spark, root, ds, rate_mode)

    writer = files.where(F.col("ds").isNotNull()).writeStream \
        .option("checkpointLocation", checkpoint).foreachBatch(load_batch)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
