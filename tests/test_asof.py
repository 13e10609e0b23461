"""The as-of sweep against a plain search, with a busy pair, ties, nulls and many pieces."""

import bisect
import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyvault.operators.asof import asof_lookup

T0 = dt.datetime(2024, 1, 5)


def _frames(spark, rates, probes):
    r = spark.createDataFrame(rates, "f long, t long, at timestamp_ntz, rate decimal(5,3)")
    p = spark.createDataFrame(probes, "id long, f long, t long, moment timestamp_ntz")
    return r, p


def _plain(rates, probes):
    by = {}
    for f, t, at, rate in rates:
        if None not in (f, t, at):
            own = by.setdefault((f, t), {})
            own[at] = max(own.get(at, rate), rate)
    lists = {k: sorted(v.items()) for k, v in by.items()}
    out = []
    for i, f, t, moment in probes:
        own = lists.get((f, t), [])
        n = 0 if moment is None else bisect.bisect_right([a for a, _ in own], moment) if len(own) < 50 else bisect.bisect_right(own, (moment, Decimal(10 ** 6)))
        out.append((i, *(own[n - 1] if n else (None, None))))
    return sorted(out, key=str)


def _swept(r, p):
    got = asof_lookup(p, r, ["f", "t"], "moment", "at", "rate", "found")
    assert got.columns == ["id", "f", "t", "moment", "found"]
    return sorted(((x.id, x.found and x.found._ts, x.found and x.found._v) for x in got.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_lookup_equals_a_search(spark, seed):
    g = random.Random(seed)
    when = lambda: T0 + dt.timedelta(seconds=g.randrange(400_000))
    rates = [(g.randrange(4), g.randrange(3), when(), Decimal(g.randrange(100, 999)) / 1000) for _ in range(300)]
    rates += [(f, t, at, v + Decimal("0.001")) for f, t, at, v in rates[:40]] + [(None, 1, T0, Decimal(1)), (1, 1, None, Decimal(1))]
    probes = [(i, g.randrange(5), g.randrange(3), when()) for i in range(600)]
    probes += [(1000 + i, f, t, at) for i, (f, t, at, _) in enumerate(rates[:60])] + [(2000, None, 1, T0), (2001, 1, 1, None), (2002, 1, 1, None)]
    r, p = _frames(spark, rates, probes)
    assert _swept(r, p) == _plain(rates, probes)
    assert _swept(r.limit(0), p) == sorted(((i, None, None) for i, *_ in probes), key=str)
    assert _swept(r, p.limit(0)) == []


def test_a_busy_pair_is_swept_without_pairing_its_rows(spark):
    """10^5 rates and as many probes of one pair in one day: no join sees more than a row per piece and key."""
    n = 100_000
    moment = F.timestamp_micros((F.col("id") * 863_000 + 1_704_412_800_000_000)).cast("timestamp_ntz")
    rates = spark.range(n).select(F.lit(1).cast("long").alias("f"), F.lit(2).cast("long").alias("t"), moment.alias("at"),
                                  (F.col("id") % 900 + 100).cast("decimal(5,0)").alias("rate"))
    probes = spark.range(n).select("id", F.lit(1).cast("long").alias("f"), F.lit(2).cast("long").alias("t"),
                                   F.timestamp_micros((F.col("id") * 863_000 + 1_704_412_800_000_000 + 431_000)).cast("timestamp_ntz").alias("moment"))
    got = asof_lookup(probes, rates, ["f", "t"], "moment", "at", "rate", "found")
    wrong = got.where(F.col("found").isNull() | (F.col("found._v") != F.col("id") % 900 + 100) | (F.col("found._ts") > F.col("moment")))
    assert got.count() == n and wrong.count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x]
    assert joins and all("_piece" in x and "_ts" not in x for x in joins) and "Cartesian" not in plan


def test_one_moment_of_all_rows_is_cut_apart(spark):
    """Every probe at the same time of the same pair, after one rate: pieces carry the rate over."""
    r, p = _frames(spark, [(1, 2, T0, Decimal("0.5"))], [(0, 1, 2, T0)])
    p = spark.range(20_000).select("id", F.lit(1).cast("long").alias("f"), F.lit(2).cast("long").alias("t"), F.lit(T0).cast("timestamp_ntz").alias("moment"))
    got = asof_lookup(p, r, ["f", "t"], "moment", "at", "rate", "found")
    assert got.where("found._v = 0.5").count() == 20_000
