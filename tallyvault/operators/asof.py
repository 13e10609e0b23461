"""As-of lookup: for each probe, the latest rate at or before its time.

Spark has no as-of join; the literal form (join every earlier rate, keep the newest) fans out by
the rate history, and one over time buckets still compares every probe with every rate of a busy
bucket.  Here probes and rates become one stream, range-partitioned by (keys, time, rates first),
so a busy key or moment is cut into as many pieces as its rows need:

* inside a piece a running ``last`` over (key, time) gives each probe the newest rate before it;
* a probe before its key's first rate in the piece takes the newest rate of the pieces before: one
  row per piece and key, a table no longer than the pieces and the keys together.

No rate is ever paired with a probe that does not get it.  The pieces are fixed by storing the
stream once: range bounds are sampled, and two samplings need not agree.  Ties on the rate time
are broken toward the larger value.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_lookup(probes: DataFrame, rates: DataFrame, keys: list[str], probe_time: str,
                rate_time: str, value: str, out: str) -> DataFrame:
    """``probes`` plus ``out`` = struct(_ts, _v) of the latest rate with
    the same ``keys`` and ``rate_time <= probe_time`` (null when none)."""
    from ..plans.storage import scratch_path, write_read

    spark = probes.sparkSession
    r = (rates.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*keys, rate_time)))
         .groupBy(*keys, F.col(rate_time).alias("_ts")).agg(F.max(value).alias("_v"))            # tie -> larger value
         .select(*keys, "_ts", F.lit(0).alias("_side"), F.struct("_ts", "_v").alias("_rate")))
    p = probes.select(*keys, F.col(probe_time).alias("_ts"), F.lit(1).alias("_side"), F.struct(*probes.columns).alias("_row"))
    stream = r.unionByName(p, allowMissingColumns=True)
    # equal keys and times may be cut apart too: their rows are spread by what else is in them
    stream = stream.withColumn("_spread", F.xxhash64("_row"))
    pieces = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = write_read(stream.repartitionByRange(pieces, *keys, "_ts", "_side", "_spread").withColumn("_piece", F.spark_partition_id()).drop("_spread"),
                        scratch_path(spark, "asof", uuid.uuid4().hex[:12]))

    so_far = Window.partitionBy("_piece", *keys).orderBy("_ts", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = placed.withColumn("_near", F.last("_rate", ignorenulls=True).over(so_far)).where(F.col("_side") == 1)
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = (placed.groupBy("_piece", *keys).agg(F.max("_rate").alias("_end"))
               .withColumn("_carried", F.max("_end").over(before))
               .where(F.col("_carried").isNotNull() & F.col(keys[0]).isNotNull())
               .select(F.col("_piece").alias("_c_piece"), *[F.col(k).alias(f"_c_{k}") for k in keys], "_carried"))
    same = F.col("_piece") == F.col("_c_piece")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_c_{k}"))
    return (swept.join(carried, same, "left")
            .select("_row.*", F.coalesce("_near", "_carried").alias(out)))
