"""Daily pipeline: stage days, load the vault day by day, merge the mart.

Storage layout under one root (a shared filesystem path on a cluster)::

    root/extract/<table>/ds=<day>/   CSV extracts (header), one folder per day
    root/stg/<table>/ds=<day>/       staging Parquet (appended); closed days in root/stg/<table>__closed (``compact``)
    root/rejects/<table>/ds=<day>/   rejected CSV records with a reason
    root/dds/<table>/ds=<day>/       vault tables, partitioned by load day, bucketed by key
    root/mart/global_metrics/date_update=<day>/    closed days in root/mart/global_metrics__closed
    root/ledger/ds=<day>/            the steps that are done

``run_range`` replays days in order (the reference's daily schedule with
catch-up) and goes on where a broken run stopped; ``backfill`` loads the
same days set-based in one pass and yields the same vault (see
``operators/vault.py``).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import mart as M
from ..operators import upsert as U
from ..operators import vault as V
from ..schemas import HUBS, LAYOUT, SATELLITES, STG_CURRENCIES, STG_TRANSACTIONS, VAULT
from ..sources import staging
from .calendar_table import CalendarTable
from .ledger import Ledger
from .storage import clear_days, exists, remove, write_read
from .vault_store import PARALLEL_WRITES, VaultStore

STG_SCHEMAS = {"transactions": STG_TRANSACTIONS, "currencies": STG_CURRENCIES}
#: Days that a replay stages, and merges into the mart, at once.
CHUNK = 15
DATE_COLUMNS = {"transactions": "transaction_dt", "currencies": "date_update"}


def _day(ds) -> _dt.date:
    return ds if isinstance(ds, _dt.date) else _dt.date.fromisoformat(str(ds))


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stored table, or an empty one of that schema when absent or without rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_vault(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return VaultStore(spark, root).read()


def staging_table(spark: SparkSession, root: str, table: str) -> CalendarTable:
    # A new StructType: ``StructType.add`` would modify the shared schema.
    schema = T.StructType(STG_SCHEMAS[table].fields + [T.StructField("ds", T.DateType(), True)])
    _part, sort_cols, dist = LAYOUT[f"stg_{table}"]
    return CalendarTable(spark, f"{root}/stg/{table}", schema, sort=[*sort_cols, *dist])


def read_staging(spark: SparkSession, root: str, table: str, ds=None) -> DataFrame:
    """A staging table, or one day of it (partition pruning, whatever the day is kept in)."""
    day = None if ds is None else _day(ds)
    return staging_table(spark, root, table).rows(day, day)


def compact(spark: SparkSession, root: str, as_of, active_months: int = 3, active_years: int = 2) -> None:
    """Bring days of the staging tables and the mart that ``as_of`` closes into months and years."""
    tables = [staging_table(spark, root, t) for t in STG_SCHEMAS] + [U.mart_table(spark, f"{root}/mart/global_metrics")]
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        list(pool.map(lambda t: t.compact(_day(as_of), active_months, active_years), tables))


def _clustered(name: str, df: DataFrame) -> DataFrame:
    _part, sort_cols, dist = LAYOUT[name]
    return df.repartition("ds", *dist).sortWithinPartitions(*sort_cols)


def load_days(spark: SparkSession, root: str, table: str, days: list[_dt.date], load_dt=None,
              replace_slice: bool = False) -> None:
    """Load the extracts of some days of one table into staging; their rejects replace earlier ones."""
    staging_table(spark, root, table).reopen(days)
    for day in days if replace_slice else []:
        remove(spark, f"{root}/stg/{table}/ds={day.isoformat()}")
    clear_days(spark, f"{root}/rejects/{table}", days)
    good, bad = staging.load_extract(spark, f"{root}/extract", table, days=days, load_dt=_run_time(load_dt))
    _clustered(f"stg_{table}", good).write.mode("append").partitionBy("ds").parquet(f"{root}/stg/{table}")
    bad.write.mode("append").partitionBy("ds").parquet(f"{root}/rejects/{table}")


def stage_days(spark: SparkSession, root: str, sources: dict[str, DataFrame], days: list[_dt.date], load_dt=None,
               replace_slice: bool = False) -> None:
    """Extract some days of each source to CSV, then load them into staging; the tables side by side.

    The days' extracts are made anew even if the source has no rows for them any more.
    """
    def stage(item: tuple[str, DataFrame]) -> None:
        table, src = item
        date_col = DATE_COLUMNS[table]
        clear_days(spark, f"{root}/extract/{table}", days)
        staging.write_extract(staging.slice_by_days(src, date_col, days), f"{root}/extract", table, date_col)
        load_days(spark, root, table, days, load_dt, replace_slice)

    with ThreadPoolExecutor(max_workers=len(sources)) as pool:
        list(pool.map(stage, sources.items()))


def stage_day(spark: SparkSession, root: str, sources: dict[str, DataFrame], ds, load_dt=None) -> None:
    stage_days(spark, root, sources, [_day(ds)], load_dt)


def _run_time(load_dt) -> _dt.datetime:
    """The load time of a run, to the second: now, unless the caller gives one."""
    return load_dt or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)


class VaultDay:
    """One daily vault run: first the hubs, then links and satellites, in the reference's statement order.

    The day's staging rows whose operation, or whose currencies, are in their hub are computed beside
    the hubs and stored for the links and satellites, which then need no hub; tables that don't
    read each other are written side by side.  Hubs only depend on hubs and links on links, so a
    replay may load the next day's hubs while a day's links are written.

    ``replace_slice`` makes a repeated load of the day give the same satellites (the reference's
    own re-run adds them again).  ``as_of_day`` lets the day see hub rows of its own and earlier
    days only, as when it first ran.  Tables in ``skip`` are left as they are; ``done`` hears of
    each table written.
    """

    def __init__(self, spark: SparkSession, root: str, ds, load_dt=None, replace_slice: bool = False, as_of_day: bool = False,
                 done=lambda name: None, skip: frozenset[str] | set[str] = frozenset()) -> None:
        self.spark, self.root, self.ds, self.load_dt = spark, root, _day(ds), _run_time(load_dt)
        self.replace_slice, self.as_of_day, self.done, self.skip = replace_slice, as_of_day, done, skip
        self.store, self.work = VaultStore(spark, root), f"{root}/_work/{uuid.uuid4().hex[:12]}"
        self.tx, self.cur = (read_staging(spark, root, t, self.ds) for t in ("transactions", "currencies"))

    def _left(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {n: t for n, t in tables.items() if n not in self.skip}

    def hubs(self) -> None:
        vault, day = self.store.read(), F.col("day") == F.lit(self.ds)
        known = {h: df.where(F.col("ds") <= F.lit(self.ds)) if self.as_of_day else df for h, df in vault.items() if h in HUBS}
        t = V.prepare_transactions(self.tx, self.store.key).where(day)
        c = V.prepare_currencies(self.cur).where(day)
        with ThreadPoolExecutor(max_workers=2) as beside:
            found = [beside.submit(write_read, V.in_hub_after(t, known["h_transactions"]), f"{self.work}/transactions"),
                     beside.submit(write_read, V.rates_in_hub_after(c, t, known["h_currencies"]), f"{self.work}/currencies")]
            self.store.append_all(self._left(V.load_day(self.tx, self.cur, vault, self.ds, self.load_dt, phase="hubs", key=self.store.key)), self.done)
            self.tx_in_hub, self.rates_in_hub = (f.result() for f in found)

    def links_and_satellites(self) -> None:
        rows = self._left(V.load_day(self.tx, self.cur, self.store.read(), self.ds, self.load_dt, phase=("links", "satellites"),
                                     tx_in_hub=self.tx_in_hub, rates_in_hub=self.rates_in_hub, key=self.store.key))
        for name in SATELLITES if self.replace_slice else ():
            if name in rows:
                self.store.clear(name, [self.ds])
        self.store.append_all(rows, self.done)

    def close(self) -> None:
        remove(self.spark, self.work)


def load_vault_day(spark: SparkSession, root: str, ds, load_dt=None, replace_slice: bool = False) -> None:
    """The daily vault run of one day (see :class:`VaultDay`)."""
    run = VaultDay(spark, root, ds, load_dt, replace_slice)
    try:
        run.hubs()
        run.links_and_satellites()
    finally:
        run.close()


def load_vault_days(spark: SparkSession, root: str, days: list[_dt.date], ledger: Ledger, load_dt=None) -> None:
    """The daily runs of some days in order, a day's links beside the next day's hubs; what the ledger has is left out."""
    runs, failures = [], []

    def second_half(run: VaultDay) -> None:
        if not failures:       # links of a day never come before those of the day before
            try:
                run.links_and_satellites()
            except BaseException as e:
                failures.append(e)
                raise

    try:
        with ThreadPoolExecutor(max_workers=1) as second:
            behind = []
            for ds in days:
                if failures:
                    break
                runs.append(VaultDay(spark, root, ds, load_dt, replace_slice=True, as_of_day=True, skip=ledger.done(ds),
                                     done=lambda name, ds=ds: ledger.mark(ds, name)))
                runs[-1].hubs()
                behind.append(second.submit(second_half, runs[-1]))
        for f in behind:
            f.result()
    finally:
        for run in runs:
            run.close()


def load_mart_days(spark: SparkSession, root: str, start, end, rate_mode: str = "reference") -> None:
    """Merge the metrics of [start, end]; a day sees what the vault loaded by that day, whatever came later."""
    metrics = M.global_metrics(read_vault(spark, root), ds_from=_day(start), ds_to=_day(end), rate_mode=rate_mode)
    U.upsert_table(spark, f"{root}/mart/global_metrics", metrics)


def load_mart_day(spark: SparkSession, root: str, ds, rate_mode: str = "reference") -> None:
    load_mart_days(spark, root, ds, ds, rate_mode)


def run_day(spark: SparkSession, root: str, sources: dict[str, DataFrame], ds, load_dt=None,
            rate_mode: str = "reference") -> None:
    stage_day(spark, root, sources, ds, load_dt)
    load_vault_day(spark, root, ds, load_dt)
    load_mart_day(spark, root, ds, rate_mode)


def days_between(start, end) -> list[_dt.date]:
    s, e = _day(start), _day(end)
    return [s + _dt.timedelta(days=i) for i in range((e - s).days + 1)]


def run_range(spark: SparkSession, root: str, sources: dict[str, DataFrame], start, end, load_dt=None,
              rate_mode: str = "reference", chunk: int = CHUNK) -> None:
    """Replay days in order (catch-up), going on where an earlier run of the same root stopped.

    Days are taken in chunks: a chunk is staged at once, its vault days are loaded in order, as
    each tests its keys against the days before, and its mart days are merged at once, as they only
    read what was loaded by their own day.  The ledger holds what is done; steps
    that a broken run left unmarked are done again and give what one unbroken run gives.
    """
    ledger, load_dt, days = Ledger(spark, root, uuid.uuid4().hex[:12]), _run_time(load_dt), days_between(start, end)
    for at in range(0, len(days), chunk):
        part = days[at:at + chunk]
        known = {ds: ledger.done(ds) for ds in part}
        if new := [ds for ds in part if "stage" not in known[ds]]:
            stage_days(spark, root, sources, new, load_dt, replace_slice=True)
            for ds in new:
                ledger.mark(ds, "stage")
        load_vault_days(spark, root, [ds for ds in part if not set(VAULT) <= known[ds]], ledger, load_dt)
        if left := [ds for ds in part if "mart" not in known[ds]]:
            load_mart_days(spark, root, left[0], left[-1], rate_mode)
            for ds in left:
                ledger.mark(ds, "mart")


def backfill(spark: SparkSession, root: str, sources: dict[str, DataFrame], start, end, load_dt=None,
             rate_mode: str = "reference") -> None:
    """Load [start, end] set-based: one pass per table instead of one per day.

    What the vault holds for these days is replaced; what it holds for other
    days stays, and its keys are not inserted again, as in a replay of the
    days on that vault.  The new rows are built beside the vault and swapped
    in when all of them are there.
    """
    s, e, load_dt = _day(start), _day(end), _run_time(load_dt)
    days = days_between(s, e)
    inside = (F.col("ds") >= F.lit(s)) & (F.col("ds") <= F.lit(e))
    stage_days(spark, root, sources, days, load_dt, replace_slice=True)
    tx = read_staging(spark, root, "transactions").where(inside)
    cur = read_staging(spark, root, "currencies").where(inside)
    work = f"{root}/_work/{uuid.uuid4().hex[:12]}"
    store = VaultStore(spark, root)
    old = {name: df.where(~inside) for name, df in store.read().items()}
    try:
        new = V.build_vault(tx, cur, load_dt, persist=lambda name, df: write_read(df, f"{work}/{name}"), stored=old,
                            key=store.key)
        with ThreadPoolExecutor(max_workers=PARALLEL_WRITES) as pool:
            list(pool.map(lambda name: store.replace(name, new[name], days), VAULT))
    finally:
        remove(spark, work)
    load_mart_days(spark, root, s, e, rate_mode)
    ledger = Ledger(spark, root, uuid.uuid4().hex[:12])
    for ds in days:
        for step in ("stage", *VAULT, "mart"):
            ledger.mark(ds, step)
