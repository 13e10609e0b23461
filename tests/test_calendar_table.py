"""Days kept by month and year: the same rows whatever step a compaction breaks off at, fewer files, days still pruned."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyvault.functions.calendar import calendar_hierarchy_key, calendar_period
from tallyvault.operators import upsert as U
from tallyvault.plans import calendar_table as C
from tallyvault.plans import pipeline as P

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ds", T.DateType())])
DAYS = [dt.date(2022, 12, 30) + dt.timedelta(days=17 * i) for i in range(30)]      # to May 2024
AS_OF = dt.date(2024, 5, 20)


def _rows(spark, days, per_day=40):
    return spark.createDataFrame([(1000 * i + j, None if j % 7 == 0 else "x" * (j % 5), d) for i, d in enumerate(days) for j in range(per_day)], SCHEMA)


def _write(df, path):
    df.write.mode("append").partitionBy("ds").parquet(path)


def _table(spark, scratch):
    t = C.CalendarTable(spark, f"{scratch}/t", SCHEMA, sort=["id"])
    _write(_rows(spark, DAYS), t.path)
    return t


def _content(df):
    return sorted(map(tuple, df.select("id", "text", "ds").collect()), key=str)


def _files(t):
    return len(glob.glob(f"{t.path}/**/*.parquet", recursive=True) + glob.glob(f"{t.closed}/**/*.parquet", recursive=True))


def test_periods_follow_the_calendar_rule(spark):
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(1000)]
    for as_of in (dt.date(2024, 1, 31), dt.date(2024, 3, 1), dt.date(2024, 12, 31)):
        df = spark.createDataFrame([(d, as_of) for d in days], "d date, a date").select("d", calendar_hierarchy_key("d", "a").alias("k"))
        for r in df.collect():
            first, last = calendar_period(r.d, as_of)
            assert first == r.k and first <= r.d <= last
    assert calendar_period(dt.date(2024, 2, 3), dt.date(2024, 12, 1)) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))


def test_rows_stay_and_files_get_fewer(spark, scratch):
    t = _table(spark, scratch)
    before, files = _content(t.rows()), _files(t)
    made = t.compact(AS_OF)
    assert (dt.date(2022, 1, 1), dt.date(2022, 12, 31)) in made and (dt.date(2024, 2, 1), dt.date(2024, 2, 29)) in made
    assert _content(t.rows()) == before and _files(t) < files
    assert len(glob.glob(f"{t.closed}/**/*.parquet", recursive=True)) == len(t.groups())
    assert t.open_days() == [d for d in DAYS if d >= dt.date(2024, 3, 1)]
    assert t.compact(AS_OF) == []                                            # nothing is done again
    t.compact(dt.date(2026, 1, 1))                                           # months become years
    assert [g[0].year for g in t.groups()] == [2022, 2023, 2024] and t.open_days() == []
    assert _content(t.rows()) == before and _files(t) == 3
    assert _content(t.rows(DAYS[3], DAYS[5])) == [r for r in before if DAYS[3] <= r[2] <= DAYS[5]]


def test_large_days_are_spread_and_small_ones_share_a_file(spark, scratch, monkeypatch):
    t = C.CalendarTable(spark, f"{scratch}/t", SCHEMA, sort=["id"])
    days = [dt.date(2023, 1, d) for d in range(1, 11)]
    _write(_rows(spark, days, 5).unionByName(_rows(spark, days[4:5], 4000)).coalesce(1), t.path)
    before = _content(t.rows())
    monkeypatch.setattr(C, "FILE_BYTES", 4 * C.bytes_of(spark, f"{t.path}/ds=2023-01-01"))
    t.compact(AS_OF)
    sizes = [r.n for r in t.rows().groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert _content(t.rows()) == before and len(sizes) > 4 and max(sizes) < 3000


def test_no_file_has_more_rows_than_a_task_may_sort(spark, scratch, monkeypatch):
    """Rows that compress to nearly nothing are bounded by their number: a file is sorted by one task."""
    t = C.CalendarTable(spark, f"{scratch}/t", SCHEMA, sort=["id"])
    days = [dt.date(2023, 1, d) for d in range(1, 11)]
    _write(_rows(spark, days, 100).unionByName(_rows(spark, days[4:5], 2000)), t.path)
    before = _content(t.rows())
    monkeypatch.setattr(C, "FILE_ROWS", 300)
    t.compact(AS_OF)
    sizes = [r.n for r in t.rows().groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert _content(t.rows()) == before and max(sizes) < 400 and len(sizes) < 14
    assert C.FILE_BYTES <= 64 << 20
    t.compact(dt.date(2026, 1, 1))                                           # a month of 3,000 rows becomes a year
    sizes = [r.n for r in t.rows().groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert _content(t.rows()) == before and max(sizes) < 400


def test_a_query_for_a_day_reads_its_group_only(spark, scratch):
    t = _table(spark, scratch)
    t.compact(AS_OF)
    day, before = DAYS[6], _content(t.rows())
    df = t.rows(day, day)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ds" in plan.split("PushedFilters")[-1]
    assert f"PartitionFilters: [isnotnull(first" in plan and calendar_period(day, AS_OF)[1].isoformat() in plan
    for group in t.groups():                                                 # the other groups' files aren't needed
        if group != calendar_period(day, AS_OF):
            for f in glob.glob(f"{t._folder(group)}/*.parquet"):
                open(f, "wb").close()
    assert _content(df) == [r for r in before if r[2] == day]


@pytest.mark.parametrize("step", range(6))
def test_a_compaction_that_breaks_off_changes_no_row(spark, scratch, monkeypatch, step):
    t = _table(spark, scratch)
    before, calls = _content(t.rows()), []

    def breaking(real):
        def call(*a):
            calls.append(a)
            if len(calls) > step * 7:
                raise RuntimeError("broken off")
            return real(*a)
        return call

    with monkeypatch.context() as m:
        m.setattr(C, "write_file", breaking(C.write_file))
        m.setattr(C, "remove", breaking(C.remove))
        with pytest.raises(RuntimeError, match="broken off"):
            t.compact(AS_OF)
    assert _content(t.rows()) == before
    t.compact(AS_OF)
    assert _content(t.rows()) == before
    groups, calls = t.groups(), []
    with monkeypatch.context() as m:
        m.setattr(C, "remove", breaking(C.remove))
        try:
            t.reopen([DAYS[0], DAYS[4]])
        except RuntimeError:
            pass
    assert _content(t.rows()) == before
    t.reopen([DAYS[0], DAYS[4]])
    assert _content(t.rows()) == before and len(t.groups()) == len(groups) - 2 and DAYS[4] in t.open_days()


def test_a_closed_day_comes_again(spark, scratch):
    t = _table(spark, scratch)
    t.compact(AS_OF)
    kept = [r for r in _content(t.rows()) if r[2] != DAYS[2]]
    t.reopen([DAYS[2]])
    C.remove(spark, f"{t.path}/ds={DAYS[2].isoformat()}")
    _write(spark.createDataFrame([(-1, "late", DAYS[2])], SCHEMA), t.path)
    t.compact(AS_OF)
    assert _content(t.rows()) == sorted([*kept, (-1, "late", DAYS[2])], key=str)


def test_tables_without_rows_or_folders(spark, scratch):
    t = C.CalendarTable(spark, f"{scratch}/none", SCHEMA)
    assert t.compact(AS_OF) == [] and t.reopen(DAYS) == [] and t.rows().count() == 0 and t.rows(grouped=True).columns[-2:] == ["first", "last"]


def test_staging_and_mart_of_a_pipeline(spark, scratch):
    """Days of a compacted root are loaded and merged again as if nothing had been compacted."""
    from tallyvault.sources import fixture

    from conftest import SF_SMALL

    sources = {"transactions": fixture.transactions(spark, SF_SMALL), "currencies": fixture.currencies(spark, SF_SMALL)}
    first, last, when = dt.date(2024, 1, 1), dt.date(2024, 1, 3), dt.datetime(2024, 2, 1)
    P.backfill(spark, scratch, sources, first, last, when)
    read = lambda: (sorted(map(str, U.read_mart(spark, f"{scratch}/mart/global_metrics").collect())),
                    sorted(map(str, P.read_staging(spark, scratch, "transactions").collect())))
    before = read()
    P.compact(spark, scratch, dt.date(2024, 6, 1))
    assert U.mart_table(spark, f"{scratch}/mart/global_metrics").groups() and read() == before
    assert P.read_staging(spark, scratch, "currencies", last).select("ds").distinct().collect()[0][0] == last
    P.backfill(spark, scratch, sources, last, last, when)
    assert read() == before
