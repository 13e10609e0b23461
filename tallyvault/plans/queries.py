"""Registry of the queries checked against the DuckDB oracle.

Every query reads the driver's parquet tables (``events``, ``nation``)
through the fixture source, builds the staging views, and runs the
operator it is named after over all rows and all days.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import calendar_hierarchy_key
from ..functions.keys import HK_WIDE, hk, key_function
from ..functions.money import cents_to_units, half_up_ratio, round_money, scale_rate
from ..operators import key_audit as K
from ..operators import mart as M
from ..operators import upsert as U
from ..operators import quality as Q
from ..operators import senders as S
from ..operators import vault as V
from ..schemas import VAULT, VAULT_ORDER
from ..sources import fixture, staging
from .oracle import AS_OF_DATES, AUDITED_BITS, COMPACTED_AS_OF, REPLAY_TIME, SHARED_BITS, SLICE_DAY, UPSERT_FROM_DAY, VAULT_COLUMNS
from . import pipeline as P
from .storage import parquet_persister, remove, scratch_path

_VAULTS: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir.rstrip("/")


def staging_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fixture.transactions(spark, sf_dir), fixture.currencies(spark, sf_dir)


def stored_vault(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Set-based vault over all days, written once per session and dataset."""
    k = _key(spark, sf_dir)
    if k not in _VAULTS:
        tx, cur = staging_tables(spark, sf_dir)
        tag = hashlib.sha1(k[1].encode()).hexdigest()[:10]
        _VAULTS[k] = V.build_vault(tx, cur, persist=parquet_persister(scratch_path(spark, "vault", tag)))
    return _VAULTS[k]


def _vault_query(table: str) -> Callable[[SparkSession, str], DataFrame]:
    cols = [c.strip() for c in VAULT_COLUMNS[table].split(",")]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return stored_vault(spark, sf_dir)[table].select(*cols)
    return run


def q_global_metrics(spark, sf_dir):
    return M.global_metrics(stored_vault(spark, sf_dir))


def q_global_metrics_per_transaction(spark, sf_dir):
    return M.global_metrics(stored_vault(spark, sf_dir), rate_mode="per_transaction")


def q_mart_bad_operations(spark, sf_dir):
    return M.bad_operations(M.satellite_days(stored_vault(spark, sf_dir))).distinct()


def q_mart_clean_transactions(spark, sf_dir):
    return M.clean_transactions(M.satellite_days(stored_vault(spark, sf_dir))).distinct()


def q_mart_dollar(spark, sf_dir):
    return M.dollar_currencies(stored_vault(spark, sf_dir))


def q_mart_join_result(spark, sf_dir):
    return M.join_result(stored_vault(spark, sf_dir))


def q_rate_reference(spark, sf_dir):
    return M.reference_rates(stored_vault(spark, sf_dir)).select(
        "day", F.col("currency_code").cast("bigint").alias("currency_code"), "rate")


def q_slice_transactions(spark, sf_dir):
    tx, _ = staging_tables(spark, sf_dir)
    return staging.slice_by_day(tx, "transaction_dt", SLICE_DAY).drop("load_dt")


def q_slice_currencies(spark, sf_dir):
    _, cur = staging_tables(spark, sf_dir)
    return staging.slice_by_day(cur, "date_update", SLICE_DAY).drop("load_dt")


def q_csv_roundtrip(spark, sf_dir):
    """Extract every day to CSV (one folder per table and day), load it back."""
    tx, _ = staging_tables(spark, sf_dir)
    root = scratch_path(spark, "csv", hashlib.sha1(sf_dir.encode()).hexdigest()[:10])
    staging.write_extract(tx, root, "transactions", "transaction_dt")
    good, _bad = staging.load_extract(spark, root, "transactions")
    return good.drop("load_dt", "ds")


def q_csv_rejects(spark, sf_dir):
    """A line of CSV for every event, one in two broken: the rejects with their reasons."""
    root = scratch_path(spark, "csv-rejects", hashlib.sha1(sf_dir.encode()).hexdigest()[:10])
    fixture.csv_lines(spark, sf_dir).write.mode("overwrite").partitionBy("ds").text(f"{root}/transactions")
    _good, bad = staging.load_extract(spark, root, "transactions")
    return bad


def q_stg_replay_dedup(spark, sf_dir):
    """Every day appended to staging twice, without a truncate between: the vault built from it is unchanged."""
    tx, cur = staging_tables(spark, sf_dir)
    root = scratch_path(spark, "replay", hashlib.sha1(sf_dir.encode()).hexdigest()[:10])
    remove(spark, root)
    for _ in range(2):
        for table, df in (("transactions", tx), ("currencies", cur)):
            rows = df.withColumn("ds", F.to_date(P.DATE_COLUMNS[table])).drop("load_dt")
            rows.write.mode("append").partitionBy("ds").parquet(f"{root}/{table}")
    again = [spark.read.parquet(f"{root}/{t}").drop("ds") for t in ("transactions", "currencies")]
    v = V.build_vault(*again, persist=parquet_persister(f"{root}/vault"))
    counts = [v[t].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
              for t in VAULT_ORDER]
    counts += [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(f"stg_{t}").alias("table_name"), "row_count")
               for t, df in zip(("transactions", "currencies"), again)]
    return _union(counts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_REPLAYS: dict[tuple[str, str], str] = {}


def replayed(spark: SparkSession, sf_dir: str) -> str:
    """Root of a day-by-day replay of all days, done in two runs of which the second goes on where the first stopped."""
    k = _key(spark, sf_dir)
    if k not in _REPLAYS:
        tx, cur = staging_tables(spark, sf_dir)
        root = scratch_path(spark, "replayed", hashlib.sha1(k[1].encode()).hexdigest()[:10])
        remove(spark, root)
        days = P.days_between(*tx.agg(F.min("transaction_dt").cast("date"), F.max("transaction_dt").cast("date")).first())
        sources, when = {"transactions": tx, "currencies": cur}, _dt.datetime.fromisoformat(REPLAY_TIME)
        P.run_range(spark, root, sources, days[0], days[len(days) // 2], when)
        P.run_range(spark, root, sources, days[0], days[-1], when)
        _REPLAYS[k] = root
    return _REPLAYS[k]


def q_vault_replay(spark, sf_dir):
    """All vault tables of the replay, by load day: rows, sums of their keys and values, and the load times."""
    parts = []
    for t, df in P.read_vault(spark, replayed(spark, sf_dir)).items():
        keys = [c for c in df.columns if c.startswith("hk_")]
        value = {"s_transactions": F.col("amount"), "s_l_currency_ratio": F.col("currency_with_div") * 1000}.get(t, F.lit(0))
        wide = lambda c: F.sum(c.cast("decimal(28,0)")).cast("decimal(38,0)")
        parts.append(df.groupBy("ds").agg(F.count(F.lit(1)).alias("row_count"), wide(sum((F.col(c).cast("decimal(20,0)") for c in keys), F.lit(0))).alias("key_sum"),
                                          wide(value).alias("value_sum"), F.min("load_dt").alias("first_load"), F.max("load_dt").alias("last_load"),
                                          F.min("load_src").alias("load_src"))
                     .select(F.lit(t).alias("table_name"), "ds", "row_count", "key_sum", "value_sum", "first_load", "last_load", "load_src"))
    return _union(parts)


def q_mart_replay(spark, sf_dir):
    """The stored mart, as the replay's merges left it."""
    return U.read_mart(spark, f"{replayed(spark, sf_dir)}/mart/global_metrics")


def q_replay_ledger(spark, sf_dir):
    """Steps that the replay's ledger holds for each day."""
    return P.Ledger(spark, replayed(spark, sf_dir)).rows().groupBy("ds").agg(F.count(F.lit(1)).alias("steps"), F.countDistinct("step").alias("different"))


def q_senders_by_period(spark, sf_dir):
    """Distinct senders of every day, month and year from daily bitmaps; one day comes late, and another twice."""
    vault = stored_vault(spark, sf_dir)
    root = scratch_path(spark, "senders", hashlib.sha1(sf_dir.encode()).hexdigest()[:10])
    remove(spark, root)
    ends = vault["s_transactions"].agg(F.min("ds"), F.max("ds")).first()
    days, late = P.days_between(*ends), _dt.date.fromisoformat(SLICE_DAY)
    index = S.SenderIndex(spark, root)
    index.update(vault, [d for d in days if d != late])
    index.update(vault, [late, days[0]])
    return _union([index.report(p).select(F.lit(p).alias("period"), "period_start", "currency_code", "senders") for p in S.PERIODS])


REPLAYED_DAYS = 2


def q_backfill_equals_replay(spark, sf_dir):
    """The first days replayed one by one, the rest backfilled onto that vault, against one set-based build."""
    tx, cur = staging_tables(spark, sf_dir)
    root = scratch_path(spark, "mixed", hashlib.sha1(sf_dir.encode()).hexdigest()[:10])
    remove(spark, root)
    sources = {"transactions": tx, "currencies": cur}
    ends = tx.agg(F.min("transaction_dt").cast("date"), F.max("transaction_dt").cast("date")).first()
    days = P.days_between(*ends)
    for ds in days[:REPLAYED_DAYS]:
        P.run_day(spark, root, sources, ds)
    P.backfill(spark, root, sources, days[REPLAYED_DAYS], days[-1])
    mixed, whole = P.read_vault(spark, root), stored_vault(spark, sf_dir)
    parts = []
    for t in VAULT_ORDER:
        cols = [c.strip() for c in VAULT_COLUMNS[t].split(",")]
        if "transaction_dt" in cols or "date_update" in cols:   # staged times keep milliseconds
            time = "transaction_dt" if "transaction_dt" in cols else "date_update"
            a, b = (d.withColumn(time, F.date_trunc("millisecond", time).cast("timestamp_ntz")).select(*cols).distinct()
                    for d in (mixed[t], whole[t]))
        else:
            a, b = mixed[t].select(*cols), whole[t].select(*cols)
        both = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(-1)))
        diff = both.groupBy(*cols).agg(F.sum("side").alias("d"), F.count_if(F.col("side") == 1).alias("n"))
        parts.append(diff.agg(F.sum("n").cast("bigint").alias("row_count"),
                              F.count_if(F.col("d") > 0).alias("only_replay"), F.count_if(F.col("d") < 0).alias("only_backfill"))
                     .select(F.lit(t).alias("table_name"), "row_count", "only_replay", "only_backfill"))
    return _union(parts)


def q_filters_day_slice(spark, sf_dir):
    """Day equality, bounds, IN, equality and null tests of the loads and the mart in one filter."""
    tx, _ = staging_tables(spark, sf_dir)
    return (staging.slice_by_day(tx, "transaction_dt", SLICE_DAY)
            .where((F.col("account_number_from") >= V.MIN_ACCOUNT) & (F.col("account_number_to") >= V.MIN_RECEIVER_FOR_TX_HUB)
                   & F.col("country").isNotNull()
                   & (F.col("status").isin(*M.BAD_STATUSES) | (F.col("transaction_type") == M.BAD_TYPE)))
            .select("operation_id", "status", "transaction_type", "transaction_dt"))


def q_join_hub_using(spark, sf_dir):
    v = stored_vault(spark, sf_dir)
    return (v["l_currency_transaction"].join(v["h_transactions"].select("hk_operation_id", "operation_id"), "hk_operation_id")
            .join(v["h_currencies"].select("hk_currency_code", "currency_code"), "hk_currency_code")
            .select("operation_id", "currency_code").distinct())


def q_anti_join_new_keys(spark, sf_dir):
    """Operations that a run of one day would insert: candidates of the day without an earlier hub row."""
    tx, _ = staging_tables(spark, sf_dir)
    hub = stored_vault(spark, sf_dir)["h_transactions"].where(F.col("ds") < F.lit(_dt.date.fromisoformat(SLICE_DAY)))
    cands = V.hub_transactions_candidates(V.prepare_transactions(tx)).where(F.col("day") == F.lit(_dt.date.fromisoformat(SLICE_DAY)))
    return cands.join(hub.select("operation_id"), "operation_id", "left_anti").select("operation_id").distinct()


def q_anti_join_bad_ops(spark, sf_dir):
    """Operations with a satellite row but without a bad one on the same day."""
    st = M.satellite_days(stored_vault(spark, sf_dir))
    return st.select("hk_operation_id", "day").distinct().join(M.bad_operations(st), ["hk_operation_id", "day"], "left_anti")


def q_rate_asof_per_tx(spark, sf_dir):
    """Every joined row's own rate: the newest at or before its time, 1 when there is none."""
    rows = M.join_result(stored_vault(spark, sf_dir), rate_mode="per_transaction")
    return rows.select("hk_operation_id", "transaction_dt", F.col("currency_code").cast("bigint").alias("currency_code"),
                       "account", "currency_code_dollar", "amount_in_dollar")


def q_mart_rates(spark, sf_dir):
    return M.rate_history(stored_vault(spark, sf_dir)).select("hk_currency_from", "hk_currency_to", "date_update", "currency_with_div")


def q_distinct_rows(spark, sf_dir):
    tx, _ = staging_tables(spark, sf_dir)
    return tx.select("country", "currency_code", "status").distinct()


def _by_currency(spark, sf_dir):
    return M.joined_rows(stored_vault(spark, sf_dir)).groupBy(F.col("currency_code").cast("bigint").alias("currency_code"))


def q_agg_sum_by_currency(spark, sf_dir):
    return _by_currency(spark, sf_dir).agg(round_money(F.sum("amount")).alias("volume"))


def q_agg_count_distinct_accounts(spark, sf_dir):
    return _by_currency(spark, sf_dir).agg(F.countDistinct("account").alias("accounts"))


def q_agg_ratio_rounded(spark, sf_dir):
    return _by_currency(spark, sf_dir).agg(
        half_up_ratio(F.sum("amount") * F.lit(100), F.countDistinct("account")).alias("average"))


def q_fn_lower_country(spark, sf_dir):
    tx, _ = staging_tables(spark, sf_dir)
    return tx.select("country", F.lower("country").alias("country_name")).distinct()


def q_fn_coalesce_rate(spark, sf_dir):
    """Each transaction currency's day with a rate to currency 400 that day, 1 where there is none."""
    tx, cur = staging_tables(spark, sf_dir)
    days = tx.where("currency_code is not null").select(F.to_date("transaction_dt").alias("day"), "currency_code").distinct()
    rates = (cur.where("currency_code_with = 400")
             .groupBy(F.to_date("date_update").alias("day"), "currency_code").agg(F.max("currency_with_div").alias("rate")))
    return days.join(rates, ["day", "currency_code"], "left").select(
        "day", "currency_code", scale_rate(F.col("rate")).alias("rate"))


def q_dq_injected(spark, sf_dir):
    """The quality report over tables with violations of every kind put in; the rules that found any."""
    tx, cur = staging_tables(spark, sf_dir)
    v = dict(stored_vault(spark, sf_dir))
    number = F.col("account_number_from")
    tx = tx.select(*[
        F.when(number % 10 == 3, F.lit(None)).otherwise(F.col("country")).alias("country") if c == "country" else
        F.when(number % 10 == 4, F.repeat(F.col("status"), 20)).otherwise(F.col("status")).alias("status") if c == "status" else
        F.lit(_dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("load_dt") if c == "load_dt" else F.col(c)
        for c in tx.columns])
    stamp = F.lit(_dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    v = {t: df.withColumn("load_dt", stamp) for t, df in v.items()}
    acc = v["h_accounts"]
    v["h_accounts"] = acc.unionByName(acc.where("account_number % 10 = 5").withColumn("load_src", F.lit("again"))) \
        .unionByName(acc.where("account_number % 10 = 6").withColumn("hk_account_number", -F.col("hk_account_number"))
                     .withColumn("account_number", F.lit(-5).cast("bigint")))
    ratio = v["l_currency_ratio"]
    v["l_currency_ratio"] = ratio.unionByName(ratio.withColumn("hk_l_currency_ratio", -F.col("hk_l_currency_ratio")))
    sat = v["s_transactions"]
    v["s_transactions"] = sat.unionByName(sat.where("status = 'blocked'").withColumn("hk_operation_id", -F.col("hk_operation_id"))) \
        .withColumn("load_dt", F.when(F.col("status") == "queued", F.lit(None)).otherwise(F.col("load_dt")))
    v["h_countries"] = v["h_countries"].withColumn("load_dt", F.lit(_dt.datetime(2024, 1, 1, 0, 0, 0, 500_000)).cast("timestamp_ntz"))
    rate = F.col("currency_with_div").cast("decimal(9,4)")
    v["s_l_currency_ratio"] = v["s_l_currency_ratio"].withColumn(
        "currency_with_div", F.when(rate < F.lit(0.2).cast("decimal(3,1)"), rate + F.lit(0.0001).cast("decimal(5,4)")).otherwise(rate))
    return Q.quality_report(v, tx, cur.withColumn("load_dt", stamp)).where("violations > 0")


def q_mart_upsert(spark, sf_dir):
    v = stored_vault(spark, sf_dir)
    target = M.global_metrics(v, rate_mode="per_transaction")
    source = M.global_metrics(v, ds_from=UPSERT_FROM_DAY)
    return U.upsert(target, source)


def q_calendar_hierarchy(spark, sf_dir):
    tx, _ = staging_tables(spark, sf_dir)
    days = tx.select(F.to_date("transaction_dt").alias("day")).distinct()
    as_of = F.explode(F.array(*[F.lit(_dt.date.fromisoformat(d)) for d in AS_OF_DATES])).alias("as_of")
    return days.select("day", as_of).select(
        "day", "as_of", calendar_hierarchy_key("day", "as_of").alias("partition_key"))


def q_union_distinct_accounts(spark, sf_dir):
    tx, _ = staging_tables(spark, sf_dir)
    return V.hub_accounts_candidates(V.prepare_transactions(tx)).select("account_number").distinct()


def q_join_two_roles(spark, sf_dir):
    v = stored_vault(spark, sf_dir)
    acc = v["h_accounts"].select("hk_account_number", "account_number")
    frm = acc.withColumnRenamed("hk_account_number", "hk_account_number_from") \
        .withColumnRenamed("account_number", "account_from")
    to = acc.withColumnRenamed("hk_account_number", "hk_account_number_to") \
        .withColumnRenamed("account_number", "account_to")
    return (v["l_accounts_transactions"].join(v["h_transactions"].select("hk_operation_id", "operation_id"),
                                              "hk_operation_id")
            .join(frm, "hk_account_number_from").join(to, "hk_account_number_to")
            .select("operation_id", "account_from", "account_to").distinct())


def q_fn_hash_keys(spark, sf_dir):
    tx, _ = staging_tables(spark, sf_dir)
    return tx.select("operation_id", "account_number_from", "account_number_to",
                     hk("operation_id").alias("hk1"),
                     hk("operation_id", "account_number_from").alias("hk2"),
                     hk("operation_id", "account_number_from", "account_number_to").alias("hk3"),
                     F.lower(F.hex(hk("operation_id", bits=HK_WIDE))).alias("wide1"),
                     F.lower(F.hex(hk("operation_id", "account_number_from", "account_number_to", bits=HK_WIDE))).alias("wide3"))


def q_key_audit(spark, sf_dir):
    """Surrogate keys of every hub and link, and those that different business keys share, for keys of several widths."""
    tx, cur = staging_tables(spark, sf_dir)
    return _union([K.audit(tx, cur, key_function(bits)).select(F.lit(bits).cast("bigint").alias("bits"), "*") for bits in AUDITED_BITS])


def q_shared_keys(spark, sf_dir):
    """Business keys that share a surrogate key of few bits."""
    tx, cur = staging_tables(spark, sf_dir)
    return K.shared_keys(tx, cur, key_function(SHARED_BITS))


def q_global_metrics_wide_keys(spark, sf_dir):
    """The mart of a vault whose surrogate keys have 128 bits."""
    tx, cur = staging_tables(spark, sf_dir)
    root = scratch_path(spark, "wide-vault", hashlib.sha1(sf_dir.encode()).hexdigest()[:10])
    return M.global_metrics(V.build_vault(tx, cur, persist=parquet_persister(root), key=key_function(HK_WIDE)))


def q_calendar_compaction(spark, sf_dir):
    """Days brought into months and years: each table's days, what they hold and what they are kept in.

    The transactions are closed into a month, then into a year; of the currencies one closed day comes
    again with other rates, and the month is closed once more; the mart's closed days are merged again.
    """
    tx, cur = staging_tables(spark, sf_dir)
    root = scratch_path(spark, "calendar", hashlib.sha1(sf_dir.encode()).hexdigest()[:10])
    remove(spark, root)
    late, month, year = (_dt.date.fromisoformat(d) for d in (SLICE_DAY, *COMPACTED_AS_OF))

    def store(table: str, rows: DataFrame) -> None:
        rows.withColumn("ds", F.to_date(P.DATE_COLUMNS[table])).write.mode("append").partitionBy("ds").parquet(f"{root}/stg/{table}")

    store("transactions", tx)
    store("currencies", cur.where("date_update IS NOT NULL"))
    mart, metrics = f"{root}/mart/global_metrics", M.global_metrics(stored_vault(spark, sf_dir))
    U.upsert_table(spark, mart, metrics)
    P.compact(spark, root, month)
    P.staging_table(spark, root, "transactions").compact(year)
    currencies = P.staging_table(spark, root, "currencies")
    currencies.reopen([late])
    remove(spark, f"{root}/stg/currencies/ds={late.isoformat()}")
    again = staging.slice_by_day(cur, "date_update", late)
    store("currencies", again.withColumn("currency_with_div", (F.col("currency_with_div") + 1).cast("decimal(5,3)")))
    currencies.compact(month)
    U.upsert_table(spark, mart, metrics.where(F.col("date_update") >= F.lit(late)))
    parts = []
    for name, rows, day, value in (("stg_transactions", P.staging_table(spark, root, "transactions"), "ds", F.col("amount")),
                                   ("stg_currencies", currencies, "ds", F.col("currency_with_div") * 1000),
                                   ("global_metrics", U.mart_table(spark, mart), "date_update", F.col("cnt_transactions") * 1000)):
        parts.append(rows.rows(grouped=True).groupBy(F.col(day).alias("day"), F.col("first").alias("kept_from"), F.col("last").alias("kept_to"))
                     .agg(F.count(F.lit(1)).alias("row_count"), F.sum(value).cast("decimal(38,0)").alias("value_sum"))
                     .select(F.lit(name).alias("table_name"), "day", "kept_from", "kept_to", "row_count", "value_sum"))
    return _union(parts)


def q_fn_money_scaling(spark, sf_dir):
    tx, _ = staging_tables(spark, sf_dir)
    return tx.select("operation_id", "transaction_dt", "amount",
                     cents_to_units(F.col("amount")).alias("amount_units"))


def q_dq_report(spark, sf_dir):
    tx, cur = staging_tables(spark, sf_dir)
    stamp = F.lit(_dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    v = {t: df.withColumn("load_dt", stamp) for t, df in stored_vault(spark, sf_dir).items()}
    tx, cur = tx.withColumn("load_dt", stamp), cur.withColumn("load_dt", stamp)
    missing = M.reference_rates(v).where("missing")
    return Q.quality_report(v, tx, cur, M.global_metrics(v), missing)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "global_metrics": q_global_metrics,
        "global_metrics_per_transaction": q_global_metrics_per_transaction,
    }
    for table in VAULT:
        q[table] = _vault_query(table)
    q.update({
        "mart_bad_operations": q_mart_bad_operations,
        "mart_clean_transactions": q_mart_clean_transactions,
        "mart_dollar": q_mart_dollar,
        "mart_join_result": q_mart_join_result,
        "rate_reference": q_rate_reference,
        "slice_transactions": q_slice_transactions,
        "slice_currencies": q_slice_currencies,
        "csv_roundtrip": q_csv_roundtrip,
        "csv_rejects": q_csv_rejects,
        "stg_replay_dedup": q_stg_replay_dedup,
        "mart_upsert": q_mart_upsert,
        "calendar_hierarchy": q_calendar_hierarchy,
        "calendar_compaction": q_calendar_compaction,
        "key_audit": q_key_audit,
        "shared_keys": q_shared_keys,
        "global_metrics_wide_keys": q_global_metrics_wide_keys,
        "union_distinct_accounts": q_union_distinct_accounts,
        "join_two_roles": q_join_two_roles,
        "fn_hash_keys": q_fn_hash_keys,
        "fn_money_scaling": q_fn_money_scaling,
        "dq_report": q_dq_report,
        "dq_injected": q_dq_injected,
        "backfill_equals_replay": q_backfill_equals_replay,
        "senders_by_period": q_senders_by_period,
        "vault_replay": q_vault_replay,
        "mart_replay": q_mart_replay,
        "replay_ledger": q_replay_ledger,
        "filters_day_slice": q_filters_day_slice,
        "join_hub_using": q_join_hub_using,
        "anti_join_new_keys": q_anti_join_new_keys,
        "anti_join_bad_ops": q_anti_join_bad_ops,
        "rate_asof_per_tx": q_rate_asof_per_tx,
        "mart_rates": q_mart_rates,
        "distinct_rows": q_distinct_rows,
        "agg_sum_by_currency": q_agg_sum_by_currency,
        "agg_count_distinct_accounts": q_agg_count_distinct_accounts,
        "agg_ratio_rounded": q_agg_ratio_rounded,
        "fn_lower_country": q_fn_lower_country,
        "fn_coalesce_rate": q_fn_coalesce_rate,
    })
    return q
