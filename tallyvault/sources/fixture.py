"""Test-data source: the two staging inputs derived from ``events``/``nation``.

The reference ships no data.  Transactions and exchange rates are derived
deterministically from the driver's ``events`` and ``nation`` tables, with
the same expressions in Spark and DuckDB, so both engines see identical
inputs.  Two consecutive events form one operation (a status history).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture recipe.
LOAD_SRC = "postgre"
NO_RATE_NATION = 3          # currency 430 never has a rate
RATE_EVERY_N_DAYS = 3

_TX_EXPRS = [
    "'op-' || CAST(op_no AS STRING) AS operation_id",
    "CAST((op_no * 31) % 211 - 1 + 211 * FLOOR(op_no / 10000) AS BIGINT) AS account_number_from",
    "CAST(CASE WHEN op_no % 23 = 0 THEN NULL WHEN op_no % 29 = 0 THEN 0 "
    "ELSE (op_no * 17) % 199 + 1 + 211 * FLOOR(op_no / 10000) END AS BIGINT) AS account_number_to",
    "CAST(CASE WHEN op_no % 41 = 0 THEN NULL ELSE 400 + 10 * (op_no % 7) END AS BIGINT) AS currency_code",
    "CASE op_no % 7 WHEN 0 THEN (CASE WHEN op_no % 2 = 0 THEN 'USA' ELSE 'usa' END) "
    "WHEN 1 THEN 'England' WHEN 2 THEN 'RUSSIA' WHEN 3 THEN 'Turkey' WHEN 4 THEN 'china' "
    "WHEN 5 THEN 'Germany' ELSE 'Japan' END AS country",
    "CASE event_type WHEN 'click' THEN 'queued' WHEN 'error' THEN 'blocked' "
    "WHEN 'view' THEN 'chargeback' ELSE 'done' END AS status",
    "CASE WHEN event_id % 10 = 0 THEN 'authorization' ELSE 'transfer_outgoing' END AS transaction_type",
    "CAST(ROUND(value * 100) AS BIGINT) * CASE WHEN event_id % 5 = 0 THEN -1 ELSE 1 END AS amount",
    "CAST(ts AS TIMESTAMP_NTZ) AS transaction_dt",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, load_dt=None) -> DataFrame:
    """Staging ``transactions`` rows (all days) derived from ``events``."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    ev = ev.withColumn("op_no", F.floor(F.col("event_id") / 2).cast("bigint"))
    return ev.selectExpr(*_TX_EXPRS).select(
        "*",
        (F.lit(load_dt) if load_dt is not None else F.lit(None)).cast("timestamp_ntz").alias("load_dt"),
        F.lit(LOAD_SRC).alias("load_src"),
    )


def currencies(spark: SparkSession, sf_dir: str, load_dt=None) -> DataFrame:
    """Staging ``currencies`` rows: pairs of nations per event day.

    Candidate nation keys up to the largest are generated per day and kept only
    where ``nation`` has them (equi-joins; no cartesian product is formed).
    """
    nation = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"))
    days = (read_table(spark, sf_dir, "events")
            .select(F.to_date(F.col("ts").cast("timestamp_ntz")).alias("d")).distinct())
    keys = F.sequence(F.lit(0).cast("bigint"), nation.agg(F.max("k")).scalar())
    a_rows = (days.select("d", F.explode(keys).alias("a"))
              .join(nation.withColumnRenamed("k", "a"), "a", "left_semi")
              .where((F.col("a") != NO_RATE_NATION)
                     & (((F.dayofmonth("d") + F.col("a")) % RATE_EVERY_N_DAYS) == 0)))
    pairs = (a_rows.select("d", "a", F.explode(keys).alias("b"))
             .join(nation.withColumnRenamed("k", "b"), "b", "left_semi")
             .where(F.col("a") != F.col("b")))
    return pairs.select(
        (F.col("d").cast("timestamp_ntz") + F.make_interval(hours=(F.col("a") * 2).cast("int")))
        .alias("date_update"),
        (F.lit(400) + F.lit(10) * F.col("a")).cast("bigint").alias("currency_code"),
        (F.lit(400) + F.lit(10) * F.col("b")).cast("bigint").alias("currency_code_with"),
        ((((F.col("a") * 7 + F.col("b") * 3 + F.dayofmonth("d") * 11) % 900) + 100)
         .cast("decimal(5,0)") * F.lit(0.001).cast("decimal(3,3)")).cast("decimal(5,3)")
        .alias("currency_with_div"),
        (F.lit(load_dt) if load_dt is not None else F.lit(None)).cast("timestamp_ntz").alias("load_dt"),
        F.lit(LOAD_SRC).alias("load_src"),
    )


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, ds): a CSV line for every event, some of them broken in one of six ways.

    Good lines have times without a fraction, as the source's extract writes them.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return ev.selectExpr(*_CSV_LINE)


_CSV_LINE = [
    "concat_ws(',', 'op-' || event_id, '7', CASE WHEN event_id % 12 = 4 THEN 'x' ELSE '' END, '410', "
    "CASE event_id % 12 WHEN 3 THEN '' WHEN 5 THEN repeat('ab', 31) ELSE 'England' END, 'done', 'transfer', "
    "CASE event_id % 12 WHEN 0 THEN '1O' ELSE '10' END, "
    "CASE WHEN event_id % 12 = 6 THEN 'noon' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END) "
    "|| CASE event_id % 12 WHEN 2 THEN ',9' ELSE '' END AS value",
    "to_date(ts) AS ds",
]


# The same recipe as DuckDB SQL, for the oracle (CTE bodies).
DUCKDB_TRANSACTIONS = """
SELECT 'op-' || CAST(op_no AS VARCHAR) AS operation_id,
       CAST((op_no * 31) % 211 - 1 + 211 * (op_no // 10000) AS BIGINT) AS account_number_from,
       CAST(CASE WHEN op_no % 23 = 0 THEN NULL WHEN op_no % 29 = 0 THEN 0
                 ELSE (op_no * 17) % 199 + 1 + 211 * (op_no // 10000) END AS BIGINT) AS account_number_to,
       CAST(CASE WHEN op_no % 41 = 0 THEN NULL ELSE 400 + 10 * (op_no % 7) END AS BIGINT) AS currency_code,
       CASE op_no % 7 WHEN 0 THEN (CASE WHEN op_no % 2 = 0 THEN 'USA' ELSE 'usa' END)
            WHEN 1 THEN 'England' WHEN 2 THEN 'RUSSIA' WHEN 3 THEN 'Turkey' WHEN 4 THEN 'china'
            WHEN 5 THEN 'Germany' ELSE 'Japan' END AS country,
       CASE event_type WHEN 'click' THEN 'queued' WHEN 'error' THEN 'blocked'
            WHEN 'view' THEN 'chargeback' ELSE 'done' END AS status,
       CASE WHEN event_id % 10 = 0 THEN 'authorization' ELSE 'transfer_outgoing' END AS transaction_type,
       CAST(ROUND(value * 100) AS BIGINT) * CASE WHEN event_id % 5 = 0 THEN -1 ELSE 1 END AS amount,
       CAST(ts AS TIMESTAMP) AS transaction_dt,
       'postgre' AS load_src
FROM (SELECT *, CAST(FLOOR(event_id / 2) AS BIGINT) AS op_no FROM events) e
"""

DUCKDB_CURRENCIES = """
SELECT CAST(d AS TIMESTAMP) + to_hours(CAST(2 * a.n_nationkey AS BIGINT)) AS date_update,
       CAST(400 + 10 * a.n_nationkey AS BIGINT) AS currency_code,
       CAST(400 + 10 * b.n_nationkey AS BIGINT) AS currency_code_with,
       CAST(CAST((a.n_nationkey * 7 + b.n_nationkey * 3 + EXTRACT(DAY FROM d) * 11) % 900 + 100 AS DECIMAL(5,0))
            * CAST(0.001 AS DECIMAL(3,3)) AS DECIMAL(5,3)) AS currency_with_div,
       'postgre' AS load_src
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) days, nation a, nation b
WHERE a.n_nationkey <> b.n_nationkey
  AND a.n_nationkey <> 3 AND (EXTRACT(DAY FROM d) + a.n_nationkey) % 3 = 0
"""

DUCKDB_CSV_REJECTS = """
SELECT CAST(ts AS DATE) AS ds,
       CASE event_id % 12 WHEN 3 THEN 'null:country' WHEN 5 THEN 'length:country' ELSE 'malformed' END AS reason,
       'op-' || event_id || ',7,' || CASE event_id % 12 WHEN 4 THEN 'x' ELSE '' END || ',410,'
       || CASE event_id % 12 WHEN 3 THEN '' WHEN 5 THEN repeat('ab', 31) ELSE 'England' END || ',done,transfer,'
       || CASE event_id % 12 WHEN 0 THEN '1O' ELSE '10' END || ','
       || CASE event_id % 12 WHEN 6 THEN 'noon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END
       || CASE event_id % 12 WHEN 2 THEN ',9' ELSE '' END AS raw_record
FROM events WHERE event_id % 12 IN (0, 2, 3, 4, 5, 6)
"""
