"""Daily bitmaps of senders against sets."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tallyvault.operators import senders as S

DAYS = [dt.date(2023, 12, 30) + dt.timedelta(days=i) for i in range(5)]


def _rows(spark, rows):
    return spark.createDataFrame(rows, "day date, currency_code long, account long")


def test_numbers_have_no_gaps_and_go_on(spark):
    accounts = [(1 << 60) + 7 * i for i in range(5000)]
    df = spark.createDataFrame([(a,) for a in accounts + accounts[:100]], "account long")
    got = {r.account: r.number for r in S.dense_numbers(df).collect()}
    assert sorted(got.values()) == list(range(1, 5001)) and set(got) == set(accounts)
    assert {r.account: r.number for r in S.dense_numbers(df.repartition(7)).collect()} == got
    assert sorted(r.number for r in S.dense_numbers(df.limit(10).distinct(), 40).collect()) == list(range(41, 51))
    assert S.dense_numbers(df.limit(0)).count() == 0


def test_periods_add_up_over_many_blocks(spark):
    g = random.Random(3)
    rows = [(g.choice(DAYS), g.choice([400, 410]), g.randrange(60_000)) for _ in range(90_000)] + [(DAYS[0], 420, None), (DAYS[1], None, 5)]
    df = _rows(spark, rows)
    numbers = S.dense_numbers(df.where("account IS NOT NULL"))
    maps = S.day_bitmaps(df, numbers)
    assert maps.select("block").distinct().count() == 2
    plan = maps._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan
    for period, start in (("day", lambda d: d), ("month", lambda d: d.replace(day=1)), ("year", lambda d: d.replace(month=1, day=1))):
        sets = {}
        for d, c, a in rows:
            if a is not None:
                sets.setdefault((start(d), c), set()).add(a)
        assert {(r.period_start, r.currency_code): r.senders for r in S.senders_of(maps, period).collect()} == {k: len(v) for k, v in sets.items()}


def test_late_and_repeated_days_change_their_own_bitmaps_only(spark, scratch, monkeypatch):
    g = random.Random(4)
    rows = [(g.choice(DAYS), 400, g.randrange(300)) for _ in range(2000)]
    state = {"rows": rows}
    monkeypatch.setattr(S, "joined_rows", lambda vault, a, b: _rows(spark, state["rows"]).where(F.col("day").between(a, b)))
    index = S.SenderIndex(spark, scratch)
    index.update({}, [d for d in DAYS if d != DAYS[2]])
    index.update({}, [DAYS[2]])
    numbers = {r.account: r.number for r in index.numbers().collect()}
    assert sorted(numbers.values()) == list(range(1, len(numbers) + 1))
    state["rows"] = [r for r in rows if r[0] != DAYS[3]] + [(DAYS[1], 400, 999)]
    index.update({}, [DAYS[1], DAYS[3]])                      # a day with one sender more, one without any
    expected = {d: len({a for x, _, a in state["rows"] if x == d}) for d in DAYS if d != DAYS[3]}
    assert {r.period_start: r.senders for r in index.report("day").collect()} == expected
    assert {r.account: r.number for r in index.numbers().collect()} == numbers | {999: len(numbers) + 1}
