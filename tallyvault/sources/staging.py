"""Staging: daily slices, CSV extracts, and the CSV load with rejects.

* ``slice_by_day`` - the incremental extract ``date_col::DATE = ds``
  (Catalyst turns it into a timestamp range and pushes it to the scan).
* ``write_extract`` - one CSV folder per table and day, with header,
  re-created on re-run (dynamic partition overwrite touches only the days
  written).
* ``load_extract`` - explicit schema, header skipped; malformed lines and
  rows breaking NOT NULL / length rules go to a reject DataFrame with the
  raw record and a reason; good rows get ``load_dt``/``load_src``.
* ``jdbc_slice_options`` - option map for reading a slice from a
  relational source with Spark's JDBC reader (the query runs remotely).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.storage import has_days
from ..schemas import CURRENCY_COLUMNS, STG_CURRENCIES, STG_TRANSACTIONS, TRANSACTION_COLUMNS

# Fixed values of the load.
DEFAULT_LOAD_SRC = "postgre"
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"',
               "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "encoding": "UTF-8"}
MAX_BYTES = {"operation_id": 120, "country": 60, "status": 60, "transaction_type": 60, "load_src": 40}
CORRUPT = "_corrupt_record"
MAX_RECORDS_PER_FILE = 5_000_000

SOURCES = {
    "transactions": ("transaction_dt", TRANSACTION_COLUMNS, STG_TRANSACTIONS),
    "currencies": ("date_update", CURRENCY_COLUMNS, STG_CURRENCIES),
}


def _as_date(ds) -> _dt.date:
    return ds if isinstance(ds, _dt.date) else _dt.date.fromisoformat(str(ds))


def slice_by_day(df: DataFrame, date_col: str, ds) -> DataFrame:
    return df.where(F.to_date(F.col(date_col)) == F.lit(_as_date(ds)))


def slice_by_days(df: DataFrame, date_col: str, days: list[_dt.date]) -> DataFrame:
    """The rows of some days: the range from the first to the last (pushed to the scan), and of it the days named."""
    day = F.to_date(F.col(date_col))
    return df.where((day >= F.lit(min(days))) & (day <= F.lit(max(days))) & day.isin(list(days)))


def write_extract(df: DataFrame, root: str, table: str, date_col: str) -> str:
    """Write ``df``'s source columns as CSV under ``root/table/ds=<day>``."""
    cols = SOURCES[table][1]
    path = f"{root.rstrip('/')}/{table}"
    # No repartition by day: a day of a large table must not funnel into
    # one task.  Every task writes its rows into the day folders it holds;
    # files are capped in size for the readers downstream.
    (df.select(*cols, F.to_date(F.col(date_col)).alias("ds"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**CSV_OPTIONS)
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy("ds").csv(path))
    return path


def _line_schema(table: str) -> T.StructType:
    """What a CSV line parses into: times as text (their fraction is optional), and the line if it doesn't fit."""
    _, cols, schema = SOURCES[table]
    text = lambda c: T.StringType() if isinstance(schema[c].dataType, T.TimestampNTZType) else schema[c].dataType
    return T.StructType([T.StructField(c, text(c), True) for c in cols] + [T.StructField(CORRUPT, T.StringType(), True)])


def _reject_reason(table: str) -> Column:
    _, cols, schema = SOURCES[table]
    checks: list[tuple[Column, str]] = [(F.col(f"line.{CORRUPT}").isNotNull(), "malformed")]
    for c in cols:
        if isinstance(schema[c].dataType, T.TimestampNTZType):
            checks.append((F.col(f"line.{c}").isNotNull() & F.col(c).isNull(), "malformed"))
    for c in cols:
        if not schema[c].nullable:
            checks.append((F.col(c).isNull(), f"null:{c}"))
    for c, n in MAX_BYTES.items():
        if c in cols:
            checks.append((F.octet_length(c) > n, f"length:{c}"))
    reason = F.lit(None).cast("string")
    for cond, label in reversed(checks):
        reason = F.when(cond, F.lit(label)).otherwise(reason)
    return reason


def load_extract(spark: SparkSession, root: str, table: str, ds=None, load_dt=None,
                 load_src: str = DEFAULT_LOAD_SRC, days=None) -> tuple[DataFrame, DataFrame]:
    """Read CSV extracts (one day, some, or all) -> (good staging rows, rejects).

    A line is read as text and parsed once, whole, into a struct, so which
    rows are good can't depend on the columns that a query goes on to read,
    and a reject keeps its line as it stood.  Times lose what is finer than a
    millisecond.  ``load_dt`` is the run's time; by default that of the read.
    """
    _, cols, schema = SOURCES[table]
    path = f"{root.rstrip('/')}/{table}"
    lines = T.StructType([T.StructField("value", T.StringType()), T.StructField("ds", T.DateType())])
    raw = spark.read.schema(lines).text(path) if has_days(spark, path) else spark.createDataFrame([], lines)
    wanted = [_as_date(d) for d in (days if days is not None else [ds] if ds is not None else [])]
    if wanted:
        raw = raw.where(F.col("ds").isin(wanted))                # partition pruning
    raw = raw.where((F.col("value") != ",".join(cols)) & (F.length("value") > 0))
    options = {k: v for k, v in CSV_OPTIONS.items() if k in ("sep", "quote", "escape")}
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    raw = raw.withColumn("line", _parsed(table, options))
    for c in cols:
        parsed = F.col(f"line.{c}")
        if isinstance(schema[c].dataType, T.TimestampNTZType):
            parsed = F.date_trunc("millisecond", parsed.try_cast("timestamp_ntz")).cast("timestamp_ntz")
        raw = raw.withColumn(c, parsed.cast(schema[c].dataType))
    raw = raw.withColumn("_reason", _reject_reason(table))
    stamp = F.lit(load_dt) if load_dt is not None else F.localtimestamp()
    good = (raw.where(F.col("_reason").isNull())
            .select(*cols, F.date_trunc("second", stamp.cast("timestamp_ntz")).cast("timestamp_ntz").alias("load_dt"),
                    F.lit(load_src).alias("load_src"), "ds"))
    bad = raw.where(F.col("_reason").isNotNull()).select(
        "ds", F.col("_reason").alias("reason"), F.col("value").alias("raw_record"))
    return good, bad


def _parsed(table: str, options: dict[str, str]) -> Column:
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _line_schema(table).fields)
    return F.from_csv("value", ddl, options)


def jdbc_slice_options(url: str, table: str, date_col: str, ds, user: str | None = None,
                       password: str | None = None, sslmode: str = "require",
                       fetchsize: int = 10000, tasks: int = 8, **extra: str) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")`` reading one day of ``table``.

    The date predicate travels inside the query text so the source filters
    before rows cross the network; the day is read in ``tasks`` ranges of its
    time.  Secrets are passed in by the caller.
    """
    ds = _as_date(ds)
    opts = {
        "url": url if "sslmode=" in url else f"{url}{'&' if '?' in url else '?'}sslmode={sslmode}",
        "dbtable": f"(SELECT * FROM {table} WHERE CAST({date_col} AS DATE) = DATE '{ds.isoformat()}') day_slice",
        "partitionColumn": date_col,
        "lowerBound": f"{ds.isoformat()} 00:00:00",
        "upperBound": f"{(ds + _dt.timedelta(days=1)).isoformat()} 00:00:00",
        "numPartitions": str(tasks),
        "fetchsize": str(fetchsize),
    }
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def jdbc_slice(spark: SparkSession, table: str, ds, **connection) -> DataFrame:
    """One day of a source table in a relational database, for ``stage_day``."""
    return spark.read.format("jdbc").options(**jdbc_slice_options(table=table, date_col=SOURCES[table][0], ds=ds, **connection)).load()
