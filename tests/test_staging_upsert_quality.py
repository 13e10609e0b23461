import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyvault.functions.calendar import calendar_hierarchy_key
from tallyvault.operators import quality as Q
from tallyvault.operators import upsert as U
from tallyvault.operators import vault as V
from tallyvault.schemas import GLOBAL_METRICS
from tallyvault.sources import staging

import golden as G


def test_csv_rejects_capture_bad_lines(spark, scratch):
    day = f"{scratch}/extract/currencies/ds=2022-10-01"
    import os
    os.makedirs(day)
    lines = [
        "date_update,currency_code,currency_code_with,currency_with_div",
        "2022-10-01 06:00:00.000000,410,400,0.500",       # good
        "2022-10-01 06:00:00.000000,abc,400,0.500",       # non-numeric int
        "2022-10-01 06:00:00.000000,410,400,123.456",     # does not fit NUMERIC(5,3)
        "2022-10-01 06:00:00.000000,410,400",             # short line
        "2022-10-01 06:00:00.000000,410,400,0.5,9",       # long line
        "2022-10-01 06:00:00.000000,,400,0.500",          # empty required field
        ",410,400,0.250",                                 # empty optional field: good
        '"2022-10-01 07:00:00.000000","410","400","0.700"',  # quoted fields: good
        "2022-10-01 08:00:00,410,400,0.600",              # whole seconds: good
        "noon,410,400,0.600",                             # not a time, in an optional field
    ]
    with open(f"{day}/part-0.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    good, bad = staging.load_extract(spark, f"{scratch}/extract", "currencies")
    assert good.count() == len(good.collect()) == 4       # whatever columns a query reads
    assert bad.count() == len(bad.collect()) == 6
    assert all(r.load_dt is not None for r in good.collect())
    reasons = {r.raw_record: r.reason for r in bad.collect()}
    assert reasons == {lines[2]: "malformed", lines[3]: "malformed", lines[4]: "malformed", lines[5]: "malformed",
                       lines[6]: "null:currency_code", lines[10]: "malformed"}


def test_csv_roundtrip_equals_slice(spark, scratch):
    tx, _ = G.frames(spark)
    staging.write_extract(tx, scratch, "transactions", "transaction_dt")
    good, bad = staging.load_extract(spark, scratch, "transactions", ds="2022-10-02")
    assert bad.count() == 0
    exp = staging.slice_by_day(tx, "transaction_dt", "2022-10-02").drop("load_dt")
    assert sorted(map(tuple, good.drop("load_dt", "ds").collect())) == sorted(map(tuple, exp.collect()))


def test_slice_predicate_reaches_the_scan(spark, scratch):
    tx, _ = G.frames(spark)
    tx.write.parquet(f"{scratch}/stg")
    plan = staging.slice_by_day(spark.read.parquet(f"{scratch}/stg"), "transaction_dt", "2022-10-02") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(transaction_dt), GreaterThanOrEqual(transaction_dt" in plan


def _metrics(spark, rows):
    return spark.createDataFrame(
        [(dt.date(2022, 10, d), c, Decimal(a), Decimal(a), Decimal(a), n) for d, c, a, n in rows], GLOBAL_METRICS)


def test_upsert_updates_inserts_and_keeps(spark, scratch):
    path = f"{scratch}/mart"
    U.upsert_table(spark, path, _metrics(spark, [(1, 400, "1.000", 1), (2, 400, "2.000", 1)]))
    U.upsert_table(spark, path, _metrics(spark, [(2, 400, "5.000", 3), (2, 410, "7.000", 1)]))
    rows = sorted((r.date_update.day, r.currency_from, str(r.amount_total), r.cnt_accounts_make_transactions)
                  for r in spark.read.parquet(path).collect())
    assert rows == [(1, 400, "1.000", 1), (2, 400, "5.000", 3), (2, 410, "7.000", 1)]
    U.upsert_table(spark, path, _metrics(spark, [(2, 400, "5.000", 3), (2, 410, "7.000", 1)]))
    assert spark.read.parquet(path).count() == 3     # idempotent


def test_quality_report_counts_injected_violations(spark):
    tx, cur = G.frames(spark)
    v = V.build_vault(tx, cur)
    clean = {(r.table_name, r.rule): r.violations for r in Q.quality_report(v, tx, cur).collect()}
    assert sum(n for (_, rule), n in clean.items() if rule != "not_null:load_dt") == 0
    assert clean[("h_accounts", "not_null:load_dt")] == v["h_accounts"].count()    # built without a load time
    dup = dict(v)
    dup["h_currencies"] = v["h_currencies"].unionByName(v["h_currencies"].limit(1).withColumn("load_src", F.lit("x")))
    dup["s_transactions"] = v["s_transactions"].unionByName(
        v["s_transactions"].limit(1).withColumn("hk_operation_id", F.lit(1).cast("bigint")))
    bad = {(r.table_name, r.rule): r.violations for r in Q.quality_report(dup).collect()}
    assert bad[("h_currencies", "primary_key:hk_currency_code")] == 1
    assert bad[("s_transactions", "foreign_key:hk_operation_id->h_transactions.hk_operation_id")] == 1


def test_calendar_hierarchy_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 4, 1),), (dt.date(2024, 3, 31),), (dt.date(2023, 1, 5),),
                                (dt.date(2022, 12, 31),)], "d date")
    got = [r[0] for r in df.select(calendar_hierarchy_key("d", F.lit(dt.date(2024, 6, 10)))).collect()]
    assert got == [dt.date(2024, 4, 1), dt.date(2024, 3, 1), dt.date(2023, 1, 1), dt.date(2022, 1, 1)]


def test_jdbc_options_carry_the_day_predicate():
    o = staging.jdbc_slice_options("jdbc:postgresql://h:5432/db", "transactions", "transaction_dt",
                                   "2022-10-01", user="u", password="p")
    assert o["url"].endswith("sslmode=require")
    assert "CAST(transaction_dt AS DATE) = DATE '2022-10-01'" in o["dbtable"]
    assert o["partitionColumn"] == "transaction_dt" and o["numPartitions"] == "8"
    assert o["lowerBound"] < o["upperBound"]
    assert o["user"] == "u" and o["password"] == "p"


def test_keys_are_checked_in_one_pass_and_one_shuffle(spark, scratch):
    tx, cur = G.frames(spark)
    v = {}
    for name, df in V.build_vault(tx, cur).items():
        df.write.parquet(f"{scratch}/{name}")
        v[name] = spark.read.parquet(f"{scratch}/{name}")
    plan = Q.quality_report(v)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2 * len(v)       # one for the rules of a row, one for all keys
    assert plan.count("Exchange hashpartitioning(domain") <= 2 and "LeftAnti" not in plan


def test_null_keys_refer_to_nothing(spark):
    tx, cur = G.frames(spark)
    v = V.build_vault(tx, cur)
    n = v["h_currencies"].count()
    null = F.lit(None).cast("bigint")
    odd = dict(v)
    odd["h_currencies"] = v["h_currencies"].unionByName(v["h_currencies"].withColumn("hk_currency_code", null))
    odd["l_currency_ratio"] = v["l_currency_ratio"].withColumn("hk_currency_to", null)
    bad = {(r.table_name, r.rule): r.violations for r in Q.quality_report(odd).collect()}
    links = v["l_currency_ratio"].count()
    assert links > 0 and bad[("l_currency_ratio", "foreign_key:hk_currency_to->h_currencies.hk_currency_code")] == links
    assert bad[("l_currency_ratio", "foreign_key:hk_currency_from->h_currencies.hk_currency_code")] == 0
    assert bad[("h_currencies", "primary_key:hk_currency_code")] == n - 1       # the null key's rows beyond its first
