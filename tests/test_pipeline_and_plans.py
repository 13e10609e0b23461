import datetime as dt

from pyspark.sql import functions as F

from tallyvault.operators import mart as M
from tallyvault.operators import vault as V
from tallyvault.plans import pipeline as P
from tallyvault.sources import fixture
from tallyvault.streaming import daily_extracts

from conftest import SF_SMALL

START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 4)


def _rows(df, drop=("load_dt",)):
    return sorted(tuple(r) for r in df.drop(*drop).collect())


def _sources(spark):
    return {"transactions": fixture.transactions(spark, SF_SMALL),
            "currencies": fixture.currencies(spark, SF_SMALL)}


def test_replay_equals_backfill_on_storage(spark, scratch):
    src = _sources(spark)
    P.run_range(spark, f"{scratch}/replay", src, START, END)
    P.backfill(spark, f"{scratch}/backfill", src, START, END)
    a, b = P.read_vault(spark, f"{scratch}/replay"), P.read_vault(spark, f"{scratch}/backfill")
    for name in a:
        assert _rows(a[name]) == _rows(b[name]), name
    ma = spark.read.parquet(f"{scratch}/replay/mart/global_metrics")
    mb = spark.read.parquet(f"{scratch}/backfill/mart/global_metrics")
    assert ma.count() > 0 and _rows(ma, ()) == _rows(mb, ())


def test_rerun_of_a_day_keeps_hubs_links_and_mart(spark, scratch):
    src = _sources(spark)
    root = f"{scratch}/rerun"
    P.run_range(spark, root, src, START, START + dt.timedelta(days=1))
    before = {k: v.count() for k, v in P.read_vault(spark, root).items()}
    mart_before = _rows(spark.read.parquet(f"{root}/mart/global_metrics"), ())
    P.run_day(spark, root, src, START + dt.timedelta(days=1))
    after = {k: v.count() for k, v in P.read_vault(spark, root).items()}
    for k in before:
        if k.startswith(("h_", "l_")):
            assert after[k] == before[k], k
    assert after["s_transactions"] > before["s_transactions"]      # the reference's satellites duplicate
    assert _rows(spark.read.parquet(f"{root}/mart/global_metrics"), ()) == mart_before


def test_streaming_catch_up_equals_replay(spark, scratch):
    src = _sources(spark)
    root = f"{scratch}/stream"
    days = P.days_between(START, END)
    from tallyvault.sources import staging
    for ds in days:                      # currencies staged first, transactions only extracted
        P.stage_day(spark, root, {"currencies": src["currencies"]}, ds)
        staging.write_extract(staging.slice_by_day(src["transactions"], "transaction_dt", ds),
                              f"{root}/extract", "transactions", "transaction_dt")
    q = daily_extracts.start(spark, root, f"{scratch}/stream-ckpt")
    q.awaitTermination()
    P.run_range(spark, f"{scratch}/replay2", src, START, END)
    assert _rows(spark.read.parquet(f"{root}/mart/global_metrics"), ()) == \
        _rows(spark.read.parquet(f"{scratch}/replay2/mart/global_metrics"), ())


def test_mart_plan_has_no_cartesian_product_and_keeps_anti_join(spark):
    v = V.build_vault(*_sources(spark).values())
    for df in (M.global_metrics(v), M.global_metrics(v, rate_mode="per_transaction"), M.join_result(v)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "LeftAnti" in M.joined_rows(v)._jdf.queryExecution().executedPlan().toString()


def test_hot_currency_aggregates_before_shuffle(spark):
    t = V.prepare_transactions(_sources(spark)["transactions"])
    plan = V.first_loaded(V.hub_currencies_candidates(t), ["hk_currency_code"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tx(spark, rows):
    """(operation, day, currency, country, amount) -> source transactions."""
    return spark.createDataFrame(
        [(op, 1, 2, cur, country, "done", "transfer", amount, dt.datetime(2024, 1, day, 12)) for op, day, cur, country, amount in rows],
        "operation_id string, account_number_from long, account_number_to long, currency_code long, country string, "
        "status string, transaction_type string, amount long, transaction_dt timestamp_ntz")


def _rates(spark, days):
    from decimal import Decimal
    return spark.createDataFrame([(dt.datetime(2024, 1, d, 6), 410, 400, Decimal("0.500")) for d in days],
                                 "date_update timestamp_ntz, currency_code long, currency_code_with long, currency_with_div decimal(5,3)")


ROWS = [("a", 1, 400, "usa", 100), ("b", 1, 410, "japan", 200), ("c", 2, 410, "japan", 300)]


def test_a_first_day_without_rates_and_a_mart_without_dollars(spark, scratch):
    src = {"transactions": _tx(spark, [r for r in ROWS if r[3] != "usa"]), "currencies": _rates(spark, [2])}
    P.run_range(spark, scratch, src, "2024-01-01", "2024-01-02")
    v = P.read_vault(spark, scratch)
    assert v["h_transactions"].count() == 2 and v["s_l_currency_ratio"].count() == 0    # 400 never came
    from tallyvault.operators.upsert import read_mart
    assert read_mart(spark, f"{scratch}/mart/global_metrics").count() == 0


def test_an_emptied_day_is_staged_empty(spark, scratch):
    P.stage_day(spark, scratch, {"transactions": _tx(spark, ROWS)}, "2024-01-01")
    P.stage_day(spark, scratch, {"transactions": _tx(spark, ROWS[2:])}, "2024-01-01")
    from tallyvault.sources import staging
    good, _ = staging.load_extract(spark, f"{scratch}/extract", "transactions", ds="2024-01-01")
    assert good.count() == 0
    assert P.read_staging(spark, scratch, "transactions").count() == 2       # the first load's, as appended


def test_backfill_on_a_loaded_vault_equals_replay(spark, scratch):
    src = _sources(spark)
    first = START + dt.timedelta(days=1)
    P.run_range(spark, f"{scratch}/a", src, START, first)
    P.backfill(spark, f"{scratch}/a", src, first + dt.timedelta(days=1), END)
    P.backfill(spark, f"{scratch}/a", src, first + dt.timedelta(days=1), END)          # and again
    P.run_range(spark, f"{scratch}/b", src, START, END)
    a, b = P.read_vault(spark, f"{scratch}/a"), P.read_vault(spark, f"{scratch}/b")
    for name in a:
        assert _rows(a[name]) == _rows(b[name]), name


def test_streaming_is_the_same_for_few_and_many_files_and_for_days_with_rates_only(spark, scratch):
    from tallyvault.sources import staging
    rows = [(f"op{k}", 1, 410, "japan", k) for k in range(90)] + [("u", 1, 400, "usa", 5)]
    counts = []
    for root, files in ((f"{scratch}/one", 1), (f"{scratch}/many", 91)):
        staging.write_extract(_tx(spark, rows).repartition(files), f"{root}/extract", "transactions", "transaction_dt")
        staging.write_extract(_rates(spark, [1, 3]), f"{root}/extract", "currencies", "date_update")
        daily_extracts.start(spark, root, f"{root}-ckpt").awaitTermination()
        v = P.read_vault(spark, root)
        counts.append({k: d.count() for k, d in v.items()})
    assert counts[0] == counts[1]
    assert counts[0]["s_transactions"] == 91 and counts[0]["s_l_currency_ratio"] == 2


def test_daily_mart_opens_only_its_day(spark, scratch):
    P.backfill(spark, scratch, _sources(spark), START, END)
    st = M.satellite_days(P.read_vault(spark, scratch), END, END)
    assert "PartitionFilters: [isnotnull(ds" in _plan(st)
    full = M.join_result(P.read_vault(spark, scratch), END, END, rate_mode="per_transaction")
    assert "CartesianProduct" not in _plan(full)


def test_operation_tables_shuffle_once_from_stored_rows(spark, scratch):
    t = V.prepare_transactions(_sources(spark)["transactions"])
    t.write.parquet(f"{scratch}/t")
    plan = _plan(V.first_loaded(V.hub_transactions_candidates(spark.read.parquet(f"{scratch}/t")), ["hk_operation_id"], ["hk_operation_id"]))
    assert plan.count("Exchange hashpartitioning") == 1


def test_keys_of_few_values_are_hashed_once_each(spark):
    """Accounts, countries and currencies are brought together before their keys are hashed, not row by row."""
    tx, cur = fixture.transactions(spark, SF_SMALL), fixture.currencies(spark, SF_SMALL)
    out = V.build_vault(tx, cur)
    for name in ("h_accounts", "h_countries", "h_currencies"):
        plan = out[name]._jdf.queryExecution().optimizedPlan().toString().splitlines()
        hashed = [i for i, x in enumerate(plan) if "md5" in x]
        read = next(i for i, x in enumerate(plan) if i > hashed[-1] and "Relation" in x)
        below = [x.split("], [")[0] for x in plan[hashed[-1]:read] if "Aggregate [" in x]      # what it groups by
        assert below and not any("md5" in x for x in below), name
