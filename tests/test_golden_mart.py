from decimal import Decimal

from tallyvault.operators import mart as M
from tallyvault.operators import vault as V

import golden as G


def _mart(spark, rows=G.TX, country_map=None, mode="reference"):
    tx, cur = G.frames(spark, rows, country_map)
    v = V.build_vault(tx, cur)
    return {(r.date_update, r.currency_from): r for r in M.global_metrics(v, rate_mode=mode).collect()}


def test_reference_mode_matches_hand_worked_rows(spark):
    got = _mart(spark)
    assert set(got) == set(G.EXPECTED)
    for key, (total, vol, avg, senders, _tx) in G.EXPECTED.items():
        r = got[key]
        assert (r.amount_total, r.cnt_transactions, r.avg_transactions_per_account) == \
            (Decimal(total), Decimal(vol), Decimal(avg)), key
        assert r.cnt_accounts_make_transactions == senders


def test_per_transaction_mode(spark):
    got = _mart(spark, mode="per_transaction")
    assert {k: str(v.amount_total) for k, v in got.items()} == {k: e[4] for k, e in G.EXPECTED.items()}


def test_two_dollar_currencies_double_counts(spark):
    got = _mart(spark, rows=G.TX + [G.EXTRA_DOLLAR])
    assert got[(G.D1, 400)].amount_total == Decimal("16.000")
    assert got[(G.D1, 470)].amount_total == Decimal("2.000")
    assert got[(G.D2, 410)].amount_total == Decimal("60.000")


def test_no_dollar_country_gives_empty_mart(spark):
    assert _mart(spark, country_map={"USA": "France", "usa": "France"}) == {}


def test_replay_day_by_day_equals_set_based(spark):
    tx, cur = G.frames(spark)
    backfill = V.build_vault(tx, cur)
    stored = V.empty_vault(spark)
    for ds in (G.D1, G.D2):
        new = V.load_day(tx, cur, stored, ds)
        stored = {k: stored[k].unionByName(new[k]) for k in stored}
    for name in backfill:
        a = sorted(tuple(r) for r in backfill[name].drop("load_dt").collect())
        b = sorted(tuple(r) for r in stored[name].drop("load_dt").collect())
        assert a == b, name
