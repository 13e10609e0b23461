"""The bucketed vault, and replays that are broken off and go on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyvault.operators import vault as V
from tallyvault.plans import pipeline as P
from tallyvault.plans import vault_store as VS
from tallyvault.plans.vault_store import VaultStore
from tallyvault.schemas import VAULT
from tallyvault.sources import fixture

from conftest import SF_SMALL

FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 1, 3)
WHEN = dt.datetime(2024, 2, 1, 1, 2, 3)


def _sources(spark):
    return {"transactions": fixture.transactions(spark, SF_SMALL), "currencies": fixture.currencies(spark, SF_SMALL)}


def _state(spark, root):
    out = {name: sorted(map(str, df.collect())) for name, df in P.read_vault(spark, root).items()}
    out["mart"] = sorted(map(str, spark.read.parquet(f"{root}/mart/global_metrics").collect()))
    out["stg"] = P.read_staging(spark, root, "transactions").count()
    return out


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("whole"))
    P.run_range(spark, root, _sources(spark), FIRST, LAST, WHEN)
    return root


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _above_scan_of(plan, table):
    """Lines of the plan from the scan of a table up to its join."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and f".{table}[" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    out, level = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < level:
            level = depth(x)
            out.append(x)
            if "Join" in x:
                break
    return out


def test_daily_anti_joins_read_the_stored_keys_in_place(spark, whole):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vault = P.read_vault(spark, whole)
        tx, cur = (P.read_staging(spark, whole, t, LAST) for t in ("transactions", "currencies"))
        new = V.load_day(tx, cur, vault, LAST, WHEN)
        for name in VAULT:
            if name not in ("s_transactions", "s_l_currency_ratio"):
                above = _above_scan_of(_plan(new[name]), name)
                assert above and "Join" in above[-1] and not any("Exchange" in x for x in above), (name, above)
        assert "hashpartitioning(hk_operation_id" in _plan(new["l_accounts_transactions"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rates_are_kept_whichever_moment_their_link_is_stored(spark, whole, scratch):
    """Satellites look at the stored links once: a link that another job stores meanwhile is old or new, never neither."""
    P.run_range(spark, scratch, _sources(spark), FIRST, FIRST, WHEN)
    day = FIRST + dt.timedelta(days=1)
    P.stage_day(spark, scratch, _sources(spark), day, WHEN)
    run = P.VaultDay(spark, scratch, day, WHEN)
    try:
        run.hubs()
        new = V.load_day(run.tx, run.cur, run.store.read(), day, WHEN, phase=("links", "satellites"), tx_in_hub=run.tx_in_hub, rates_in_hub=run.rates_in_hub)
        rates = new["s_l_currency_ratio"]
        assert sum("FileScan" in x and ".l_currency_ratio[" in x for x in _plan(rates).splitlines()) == 1
        run.store.append("l_currency_ratio", new["l_currency_ratio"])
        assert sorted(map(str, rates.collect())) == sorted(map(str, P.read_vault(spark, whole)["s_l_currency_ratio"].where(F.col("ds") == F.lit(day)).collect()))
    finally:
        run.close()


def test_an_operation_s_rows_are_joined_without_an_exchange(spark, whole):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        v = P.read_vault(spark, whole)
        j = (v["s_transactions"].join(v["l_currency_transaction"].select("hk_operation_id", "hk_currency_code"), "hk_operation_id")
             .join(v["l_accounts_transactions"].select("hk_operation_id", "hk_account_number_from"), "hk_operation_id"))
        assert "Exchange" not in _plan(j)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_new_session_s_catalog_finds_the_stored_tables(spark, whole):
    store = VaultStore(spark, whole)
    before = {n: df.count() for n, df in store.read().items()}
    for name in VAULT:
        spark.sql(f"DROP TABLE {store.database}.{name}")       # an external table's files stay
    assert {n: df.count() for n, df in VaultStore(spark, whole).read().items()} == before
    assert store.days("h_transactions") == P.days_between(FIRST, LAST)
    by_day = {(r.table_name, r.ds): r.row_count for r in store.rows_by_day().collect()}
    assert sum(n for (t, _), n in by_day.items() if t == "s_transactions") == before["s_transactions"]


@pytest.mark.parametrize("table, nth", [("h_accounts", 2), ("l_currency_transaction", 2), ("s_transactions", 1), ("s_l_currency_ratio", 3), ("mart", 1)])
def test_a_broken_replay_goes_on_and_gives_the_same(spark, whole, scratch, monkeypatch, table, nth):
    """The write of one table of one day fails; the repeated run gives what one unbroken run gives."""
    append, merge, calls = VaultStore.append, P.load_mart_days, []

    def breaking(self, name, rows):
        if name == table:
            calls.append(name)
            if len(calls) == nth:
                if name.startswith("s_"):
                    append(self, name, rows.limit(3))      # half of its files are there
                raise RuntimeError("broken off")
        append(self, name, rows)

    def breaking_merge(*a, **k):
        calls.append("mart")
        if table == "mart" and len(calls) == nth:
            raise RuntimeError("broken off")
        merge(*a, **k)

    monkeypatch.setattr(VaultStore, "append", breaking)
    monkeypatch.setattr(P, "load_mart_days", breaking_merge)
    with pytest.raises(RuntimeError, match="broken off"):
        P.run_range(spark, scratch, _sources(spark), FIRST, LAST, WHEN)
    ledger = P.Ledger(spark, scratch)
    assert any(set(VAULT) | {"stage", "mart"} != ledger.done(d) for d in P.days_between(FIRST, LAST))
    P.run_range(spark, scratch, _sources(spark), FIRST, LAST, WHEN)
    assert _state(spark, scratch) == _state(spark, whole)
    assert ledger.rows().groupBy("ds").count().where(F.col("count") == len(VAULT) + 2).count() == 3


def test_a_finished_replay_does_nothing_again(spark, whole, monkeypatch):
    def never(*a, **k):
        raise AssertionError("a step was done again")
    for name in ("stage_days", "load_mart_days", "VaultDay"):
        monkeypatch.setattr(P, name, never)
    P.run_range(spark, whole, _sources(spark), FIRST, LAST, WHEN)


def test_a_backfill_that_fails_leaves_the_vault(spark, scratch, monkeypatch):
    src = _sources(spark)
    P.run_range(spark, scratch, src, FIRST, FIRST, WHEN)
    before = {n: sorted(map(str, df.collect())) for n, df in P.read_vault(spark, scratch).items()}
    monkeypatch.setattr(P.V, "build_vault", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("broken off")))
    with pytest.raises(RuntimeError):
        P.backfill(spark, scratch, src, FIRST, LAST, WHEN)
    assert {n: sorted(map(str, df.collect())) for n, df in P.read_vault(spark, scratch).items()} == before


def test_a_small_root_gets_few_buckets_whatever_the_shuffle_partitions(spark, scratch, monkeypatch):
    """A file and a task for every bucket, table and day: their number follows the staged rows, not the session."""
    monkeypatch.setattr(VS, "BUCKET_BYTES", 1 << 20)
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        few, many, none = (VaultStore(spark, f"{scratch}/{n}") for n in ("few", "many", "none"))
        P.stage_day(spark, few.root, _sources(spark), FIRST, WHEN)
        assert few.buckets() == VS.LEAST_BUCKETS and none.buckets() == 200
        rows = spark.range(0, 3_000_000, numPartitions=4).selectExpr("xxhash64(id) AS a")
        rows.write.parquet(f"{many.root}/stg/transactions/ds=2024-01-01")
        assert 16 < many.buckets() < 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert VaultStore(spark, few.root).buckets() == VS.LEAST_BUCKETS
