"""Tables stored by day whose closed days are kept by month and by year.

Days are written as ``path/<day column>=<day>/``.  What the calendar rule puts into a month or a
year (``functions/calendar.py``) is rewritten into one group, ``path__closed/first=<day>/last=<day>/``,
whose files are sorted by day: a table of ten years has a few dozen folders instead of thousands,
and a query for some days still reads their groups only, and of these, by the files' statistics,
the row groups that hold the days.

A group counts from the moment its mark ``_closed`` is written, after its files; from then on it
stands for all of its days, whatever their own folders or narrower groups still hold.  Hence a
compaction that breaks off at any point has changed nothing, or everything and left folders that
nobody reads (``sweep`` takes them away).  A closed day that is to be written again is opened
first (``reopen``): its group goes back to day folders, which count when the mark is gone.
Rows are always those of one or the other.  There is one writer of a table at a time; a reader that
planned its scan before a ``sweep`` may miss files and has to read again (``compact(...,
sweep=False)`` leaves them for later).
"""

from __future__ import annotations

import datetime as _dt
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import calendar_period
from .storage import bytes_of, folders, has_days, remove, write_file

#: Bytes and rows that a file of a group is aimed at.  One task sorts a file's rows, which take many times its bytes in memory
#: (how many depends on what the columns compress to, so rows are bounded besides).
FILE_BYTES = 64 << 20
FILE_ROWS = 4_000_000
MARK = "_closed"

Period = tuple[_dt.date, _dt.date]


def _inside(narrow: Period, wide: Period) -> bool:
    return wide[0] <= narrow[0] and narrow[1] <= wide[1]


def _dates(folder: str) -> list[_dt.date]:
    return [_dt.date.fromisoformat(part.split("=", 1)[1]) for part in folder.split("/") if "=" in part][-2:]


class CalendarTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, day: str = "ds", sort: list[str] | None = None) -> None:
        self.spark, self.path, self.schema, self.day = spark, path.rstrip("/"), schema, day
        self.closed, self.sort = f"{self.path}__closed", [c for c in sort or [] if c != day]

    # ---- what is there

    def _folder(self, p: Period) -> str:
        return f"{self.closed}/first={p[0].isoformat()}/last={p[1].isoformat()}"

    def _marked(self) -> list[Period]:
        return [tuple(_dates(f.rsplit("/", 1)[0])) for f in folders(self.spark, f"{self.closed}/first=*/last=*/{MARK}")]

    def groups(self) -> list[Period]:
        """The groups that count: closed ones that no wider closed one holds."""
        marked = self._marked()
        return [p for p in marked if not any(p != w and _inside(p, w) for w in marked)]

    def _day_folders(self) -> list[_dt.date]:
        return [_dates(f)[-1] for f in folders(self.spark, f"{self.path}/{self.day}=*")]

    def open_days(self) -> list[_dt.date]:
        """Days in folders of their own that count."""
        groups = self.groups()
        return [d for d in self._day_folders() if not any(_inside((d, d), g) for g in groups)]

    # ---- reading

    def _between(self, periods: list[Period]) -> Column:
        out = F.lit(False)
        for a, b in periods:
            out = out | F.col(self.day).between(F.lit(a), F.lit(b))
        return out

    def _of_groups(self, periods: list[Period]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("first", T.DateType()), T.StructField("last", T.DateType())])
        one = F.lit(False)
        for a, b in periods:
            one = one | ((F.col("first") == F.lit(a)) & (F.col("last") == F.lit(b)))
        return self.spark.read.schema(schema).parquet(self.closed).where(one)

    def rows(self, start: _dt.date | None = None, end: _dt.date | None = None, grouped: bool = False) -> DataFrame:
        """The rows, or those of [start, end]; with ``grouped`` also ``first`` and ``last`` of what they are kept in."""
        names, groups = self.schema.fieldNames(), self.groups()
        parts = []
        if has_days(self.spark, self.path, self.day):
            own = self.spark.read.schema(self.schema).parquet(self.path)
            own = own.where(~self._between(groups)) if groups else own
            parts.append(own.withColumns({"first": F.col(self.day), "last": F.col(self.day)}) if grouped else own)
        wanted = [g for g in groups if (end is None or g[0] <= end) and (start is None or g[1] >= start)]
        if wanted:
            parts.append(self._of_groups(wanted))
        names = [*names, "first", "last"] if grouped else names
        if not parts:
            empty = T.StructType([*self.schema.fields, *([T.StructField(c, T.DateType()) for c in ("first", "last")] if grouped else [])])
            return self.spark.createDataFrame([], empty)
        out = parts[0].select(*names)
        for p in parts[1:]:
            out = out.unionByName(p.select(*names))
        if start is not None:
            out = out.where(F.col(self.day) >= F.lit(start))
        return out if end is None else out.where(F.col(self.day) <= F.lit(end))

    # ---- writing

    def compact(self, as_of: _dt.date, active_months: int = 3, active_years: int = 2, sweep: bool = True) -> list[Period]:
        """Bring what ``as_of`` closes into months and years; the groups that were made.

        All of a run's groups are written by one job.  What is rewritten has known sizes, so its files are laid out
        beforehand: days in order, up to ``FILE_BYTES`` and ``FILE_ROWS`` a file, a larger day in several files by
        the hash of its rows.  A group of less is a single file.
        """
        kept = [(d, d) for d in self.open_days()] + self.groups()
        target = {p: calendar_period(p[0], as_of, active_months, active_years) for p in kept}
        moved = {p: t for p, t in target.items() if t[0] <= p[0] and p[1] <= t[1] and t != p and t[0] != t[1]}
        new = sorted(set(moved.values()))
        if new:
            layout, files = self._layout(moved)
            rows = self.rows(new[0][0], new[-1][1]).where(self._between(new))
            rows = rows.join(F.broadcast(layout), F.col(self.day) == F.col("_day")).drop("_day")     # a row per calendar day
            spread = F.pmod(F.xxhash64(*self.schema.fieldNames()), F.col("_files")).cast("int")
            (rows.withColumn("_file", F.col("_file") + spread).repartitionById(files, "_file").drop("_file", "_files")
             .sortWithinPartitions("first", self.day, *self.sort)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("first", "last").parquet(self.closed))
            for p in new:
                self._mark(p, as_of)
        if sweep:
            self.sweep()
        return new

    def _layout(self, moved: dict[Period, Period]) -> tuple[DataFrame, int]:
        """(_day, first, last, _file, _files): each day's group, its first file and over how many it is spread; all files' number."""
        counted = dict(self.rows(min(moved)[0], max(p[1] for p in moved)).groupBy(self.day).count().collect())     # a row per calendar day
        days: list[tuple] = []
        at, room, group = -1, 0.0, None     # in files
        for p in sorted(moved):
            size = bytes_of(self.spark, f"{self.path}/{self.day}={p[0].isoformat()}" if p[0] == p[1] else self._folder(p))
            own = [p[0] + _dt.timedelta(days=i) for i in range((p[1] - p[0]).days + 1)]
            need = max(size / FILE_BYTES, sum(counted.get(d, 0) for d in own) / FILE_ROWS)
            if moved[p] != group or need > room:
                at, room, group = at + 1, 1.0, moved[p]
            n = max(1, math.ceil(need))
            days += [(d, *moved[p], at, n) for d in own]
            at, room = at + n - 1, room - need if n == 1 else 0.0
        return self.spark.createDataFrame(days, "_day date, first date, last date, _file int, _files int"), at + 1

    def _mark(self, p: Period, as_of: _dt.date) -> None:
        write_file(self.spark, f"{self._folder(p)}/{MARK}", json.dumps({"as_of": as_of.isoformat()}) + "\n")

    def sweep(self) -> None:
        """Remove folders that a closed group stands for, and groups that were never closed."""
        marked, groups = set(self._marked()), self.groups()
        for folder in folders(self.spark, f"{self.closed}/first=*/last=*"):
            p = tuple(_dates(folder))
            if p not in groups:
                if p in marked:
                    remove(self.spark, f"{self._folder(p)}/{MARK}")
                remove(self.spark, self._folder(p))
        for d in self._day_folders():
            if any(_inside((d, d), g) for g in groups):
                remove(self.spark, f"{self.path}/{self.day}={d.isoformat()}")

    def reopen(self, days: list[_dt.date]) -> list[Period]:
        """Bring the groups that hold some days back to day folders, so that these can be written again."""
        wanted = [g for g in self.groups() if any(_inside((d, d), g) for d in days)]
        if wanted:
            self.sweep()
            rows = self._of_groups(wanted).select(*self.schema.fieldNames())
            (rows.repartitionByRange(self.day, *self.sort).sortWithinPartitions(self.day, *self.sort)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.day).parquet(self.path))
            for p in wanted:
                remove(self.spark, f"{self._folder(p)}/{MARK}")
                remove(self.spark, self._folder(p))
        return wanted
