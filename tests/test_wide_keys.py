"""Keys of other widths, vaults made of them, and the audit of keys that business keys share."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tallyvault.functions.keys import canonical, hk, key_function
from tallyvault.operators import key_audit as K
from tallyvault.operators import mart as M
from tallyvault.operators import quality as Q
from tallyvault.plans import pipeline as P
from tallyvault.plans.vault_store import KEY_BITS_SETTING, VaultStore
from tallyvault.sources import fixture

from conftest import SF_SMALL

DAY = dt.date(2024, 1, 2)


def test_a_wide_key_is_the_whole_md5(spark):
    df = spark.createDataFrame([("op-1", 3), (None, 3), ("", None)], "a string, b long")
    r = df.select(hk("a", "b", bits=128).alias("k"), hk("a", "b").alias("n"), canonical("a", "b").alias("t")).collect()
    for x, text in zip(r, ("4:op-11:3", "N1:3", "0:N")):
        digest = hashlib.md5(text.encode()).hexdigest()
        assert x.t == text and x.k == bytearray.fromhex(digest) and x.n == int(digest[:15], 16)
    for bits in (0, 3, 64, 61, 256):
        with pytest.raises(ValueError):
            key_function(bits)


def test_a_stored_vault_of_wide_keys(spark, scratch):
    """Daily runs of a vault with 128-bit keys: the mart of the narrow one, whatever later sessions are set to."""
    sources = {"transactions": fixture.transactions(spark, SF_SMALL), "currencies": fixture.currencies(spark, SF_SMALL)}
    spark.conf.set(KEY_BITS_SETTING, "128")
    try:
        P.run_range(spark, f"{scratch}/wide", sources, dt.date(2024, 1, 1), DAY, dt.datetime(2024, 2, 1))
    finally:
        spark.conf.unset(KEY_BITS_SETTING)
    store = VaultStore(spark, f"{scratch}/wide")
    assert store.key_bits() == 128
    P.backfill(spark, f"{scratch}/wide", sources, DAY, DAY)                     # keeps to the root's width
    P.run_range(spark, f"{scratch}/narrow", sources, dt.date(2024, 1, 1), DAY, dt.datetime(2024, 2, 1))
    wide, narrow = P.read_vault(spark, f"{scratch}/wide"), P.read_vault(spark, f"{scratch}/narrow")
    assert wide["h_transactions"].schema["hk_operation_id"].dataType.typeName() == "binary"
    assert {t: df.count() for t, df in wide.items()} == {t: df.count() for t, df in narrow.items()}
    for mode in ("reference", "per_transaction"):
        a, b = (sorted(map(str, M.global_metrics(v, rate_mode=mode).collect())) for v in (wide, narrow))
        assert a == b and a
    a, b = (sorted(map(str, Q.quality_report(v).collect())) for v in (wide, narrow))
    assert a == b


def test_shared_keys_are_found_and_only_those(spark):
    tx = fixture.transactions(spark, SF_SMALL)
    cur = fixture.currencies(spark, SF_SMALL)
    assert K.shared_keys(tx, cur).count() == 0 and K.shared_keys(tx, cur, key_function(128)).count() == 0
    made = lambda *cols, **_: hk(*cols) if len(cols) > 1 else F.when(F.col(cols[0]).cast("string") == "840", F.lit(0).cast("bigint")).otherwise(hk(*cols))
    codes = spark.createDataFrame([("a", 1, 2, 840), ("a", 1, 2, 840), ("b", 1, 2, 0)], "operation_id string, account_number_from long, account_number_to long, currency_code long") \
        .withColumn("country", F.lit("USA"))
    assert K.shared_keys(codes, cur.limit(0), made).count() == 0                # a repeated business key shares nothing
    zero = lambda *cols: F.lit(0).cast("bigint") if cols == ("currency_code",) else hk(*cols)
    (r,) = K.shared_keys(codes, cur.limit(0), zero).collect()
    assert (r.table_name, r.hk, r.first_business_key, r.last_business_key, r.row_count) == ("h_currencies", 0, "1:0", "3:840", 3)
    assert K.audit(codes.limit(0), cur.limit(0)).count() == 0
    plan = K.shared_keys(tx, cur)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(table_name") == 1


def test_business_keys_are_counted_once_and_by_hash(spark):
    """Business keys are brought together before they are hashed, by hash maps and not by sorting texts."""
    tx, cur = fixture.transactions(spark, SF_SMALL), fixture.currencies(spark, SF_SMALL)
    rows = K.audit(tx, cur, key_function(8))
    lines = [x for x in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate(" in x]
    assert lines and all("HashAggregate(" in x for x in lines)
    assert sum(r.shared_keys for r in rows.collect()) > 0
    codes = spark.createDataFrame([("a", 1, 2, 840), ("a", 1, 2, 840), (None, 1, None, 0)], "operation_id string, account_number_from long, account_number_to long, currency_code long") \
        .withColumn("country", F.lit("USA"))
    told = {(r.table_name, r.business_key): r.row_count for r in K.candidates(codes, cur.limit(0)).collect()}
    assert told == {("h_transactions", "1:a"): 2, ("h_countries", "3:usa"): 3, ("h_currencies", "3:840"): 2, ("h_currencies", "1:0"): 1, ("h_accounts", "1:1"): 3,
                    ("h_accounts", "1:2"): 2, ("l_accounts_transactions", "1:a1:11:2"): 2, ("l_countries_transactions", "1:a3:usa"): 2, ("l_countries_transactions", "N3:usa"): 1,
                    ("l_currency_transaction", "3:8401:a"): 2, ("l_currency_transaction", "1:0N"): 1, ("l_countries_currencies", "3:usa3:840"): 2, ("l_countries_currencies", "3:usa1:0"): 1}
