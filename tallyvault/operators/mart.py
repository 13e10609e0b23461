"""Daily per-currency metrics mart (``global_metrics``).

Semantics kept from the reference for a day ``d`` (computed for many days
at once by keying everything on the transaction's own day):

* bad operations: any satellite row of the same day that is blocked,
  a chargeback, or an authorization; clean rows are ``done`` rows of
  operations not bad that day (amount = |amount| / 100, exact);
* a clean row joins every currency link and every sender link of its
  operation that was loaded by day ``d``;
* "dollar" is every currency linked to the country ``usa`` by day ``d``;
  each row counts once per dollar currency (the reference cross joins);
* rate mode ``reference``: one rate per (day, currency): 1 when, for some
  dollar currency, no rate is at or before the day's first transaction
  (a null sorts first in the reference's descending window), otherwise
  the newest rate at or before the day's last transaction;
* rate mode ``per_transaction``: each row gets the newest rate at or
  before its own time (1 when none);
* ``cnt_transactions`` is the summed volume, not a count.

No cartesian product is built: the dollar set per day is an equi-join on
the day, and the rate lookup is the sorted sweep of ``asof.py``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import cents_to_units, half_up_ratio, one_rate, round_money, scale_rate
from ..session import ensure_checkpoint_dir
from .asof import asof_lookup

# Fixed values from the mart definition.
BAD_STATUSES = ["blocked", "chargeback"]
BAD_TYPE = "authorization"
DONE_STATUS = "done"
DOLLAR_COUNTRY = "usa"
RATE_MODES = ("reference", "per_transaction")


def _as_date(v):
    if v is None or isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v))


def _materialize_small(df: DataFrame) -> DataFrame:
    """Cut lineage of a small derived table (one row per day and currency,
    or per day and dollar code) with a reliable checkpoint in the shared
    checkpoint folder, so the plans that use it several times do not
    recompute the transaction joins behind it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def satellite_days(vault: dict[str, DataFrame], ds_from=None, ds_to=None) -> DataFrame:
    st = vault["s_transactions"].withColumn("day", F.to_date("transaction_dt"))
    ds_from, ds_to = _as_date(ds_from), _as_date(ds_to)
    # A satellite row is loaded by the run of its own day, so the partition
    # column prunes what the day filter asks for.
    if ds_from is not None:
        st = st.where((F.col("day") >= F.lit(ds_from)) & (F.col("ds") >= F.lit(ds_from)))
    if ds_to is not None:
        st = st.where((F.col("day") <= F.lit(ds_to)) & (F.col("ds") <= F.lit(ds_to)))
    return st


def _loaded_by(table: DataFrame, ds_to) -> DataFrame:
    """Rows of a hub or link loaded by a day (partitions after it are not opened)."""
    return table if ds_to is None else table.where(F.col("ds") <= F.lit(_as_date(ds_to)))


def bad_operations(st: DataFrame) -> DataFrame:
    """M1: (operation, day) pairs with a blocked/chargeback/authorization row."""
    return (st.where(F.col("status").isin(*BAD_STATUSES) | (F.col("transaction_type") == BAD_TYPE))
            .select("hk_operation_id", "day"))


def clean_transactions(st: DataFrame) -> DataFrame:
    """M2 rows (not yet de-duplicated): done rows of operations not bad that day.

    The anti join keys on the operation only and tests the day as a
    residual condition, so the result stays partitioned by operation for
    the link joins that follow (no second shuffle).
    """
    bad = bad_operations(st).withColumnRenamed("hk_operation_id", "_bad_op").withColumnRenamed("day", "_bad_day")
    done = st.where(F.col("status") == DONE_STATUS)
    cond = (done["hk_operation_id"] == bad["_bad_op"]) & (F.datediff(done["day"], bad["_bad_day"]) == 0)
    return (done.join(bad, cond, "left_anti")
            .select("hk_operation_id", cents_to_units(F.col("amount")).alias("amount"),
                    "transaction_dt", "day"))


def dollar_currencies(vault: dict[str, DataFrame]) -> DataFrame:
    """M3: currencies linked to the dollar country, with the day they appear."""
    hc = vault["h_countries"].where(F.col("country_name") == DOLLAR_COUNTRY) \
        .select("hk_country_name", F.col("ds").alias("_c_ds"))
    lcc = vault["l_countries_currencies"].select("hk_country_name", "hk_currency_code", F.col("ds").alias("_l_ds"))
    cur = vault["h_currencies"].select("hk_currency_code", "currency_code", F.col("ds").alias("_h_ds"))
    return (hc.join(lcc, "hk_country_name").join(cur, "hk_currency_code")
            .select(F.col("currency_code").alias("currency_code_dollar"),
                    F.col("hk_currency_code").alias("hk_currency_code_dollar"),
                    F.greatest("_c_ds", "_l_ds", "_h_ds").alias("dollar_ds"))
            .groupBy("currency_code_dollar", "hk_currency_code_dollar")
            .agg(F.min("dollar_ds").alias("dollar_ds")))


def rate_history(vault: dict[str, DataFrame]) -> DataFrame:
    """M4 without the day bound: (from, to, date_update, rate) of every
    loaded rate; the as-of lookup applies ``date_update <= t``."""
    link = vault["l_currency_ratio"].select("hk_l_currency_ratio", "hk_currency_from", "hk_currency_to").distinct()
    sat = vault["s_l_currency_ratio"].select("hk_l_currency_ratio", "currency_with_div", "date_update")
    return sat.join(link, "hk_l_currency_ratio").drop("hk_l_currency_ratio")


def joined_rows(vault: dict[str, DataFrame], ds_from=None, ds_to=None) -> DataFrame:
    """Distinct (operation, amount, time, day, currency, sender) rows: M5
    before the dollar set and the rate are attached."""
    st = satellite_days(vault, ds_from, ds_to)
    clean = clean_transactions(st)
    lct = _loaded_by(vault["l_currency_transaction"], ds_to).select("hk_operation_id", "hk_currency_code", F.col("ds").alias("_lct_ds"))
    hc = _loaded_by(vault["h_currencies"], ds_to).select("hk_currency_code", "currency_code", F.col("ds").alias("_hc_ds"))
    lac = _loaded_by(vault["l_accounts_transactions"], ds_to).select(
        "hk_operation_id", F.col("hk_account_number_from").alias("account"), F.col("ds").alias("_lac_ds"))
    return (clean.join(lct, "hk_operation_id").where(F.col("_lct_ds") <= F.col("day"))
            .join(lac, "hk_operation_id").where(F.col("_lac_ds") <= F.col("day"))
            .join(hc, "hk_currency_code").where(F.col("_hc_ds") <= F.col("day"))
            .select("hk_operation_id", "amount", "transaction_dt", "day", "currency_code",
                    "hk_currency_code", "account")
            .distinct())


def dollar_by_day(vault: dict[str, DataFrame], days: DataFrame, ds_to=None) -> DataFrame:
    """(day, dollar code, dollar key) for every day up to the last of ``days``.

    The dollar set only grows; each dollar row is spread over the days from
    its first day to the last day in play (a scalar subquery), so the
    per-day attachment is an equi-join on the day.
    """
    last_day = F.lit(_as_date(ds_to)) if ds_to is not None else days.agg(F.max("day")).scalar()
    d = dollar_currencies(vault).where(F.col("dollar_ds") <= last_day)
    return d.select(F.explode(F.sequence("dollar_ds", last_day)).alias("day"),
                    "currency_code_dollar", "hk_currency_code_dollar")


def reference_rates(vault: dict[str, DataFrame], ds_from=None, ds_to=None) -> DataFrame:
    """(day, currency_code, rate, missing): the rate the reference's window
    gives each currency-day, and whether it fell back to 1 for want of a
    rate (for a currency that is not itself a dollar currency that day)."""
    _rows, sums, dollars = _day_currency_frames(vault, ds_from, ds_to)
    r = _reference_rates(sums, dollars, rate_history(vault), keep_missing=True)
    is_dollar = dollars.select("day", F.col("currency_code_dollar").alias("currency_code")).distinct() \
        .withColumn("_is_dollar", F.lit(True))
    return (r.join(is_dollar, ["day", "currency_code"], "left")
            .select("day", "currency_code", "rate",
                    ((F.col("missing") == 1) & F.col("_is_dollar").isNull()).alias("missing")))


def _day_currency_frames(vault: dict[str, DataFrame], ds_from=None, ds_to=None):
    """(rows, per day-currency sums, dollar set per day); the last two are
    small and materialized once."""
    rows = joined_rows(vault, ds_from, ds_to)
    sums = _materialize_small(rows.groupBy("day", "currency_code", "hk_currency_code").agg(
        F.sum("amount").alias("s"), F.countDistinct("account").alias("n"),
        F.min("transaction_dt").alias("mn"), F.max("transaction_dt").alias("mx")))
    dollars = _materialize_small(dollar_by_day(vault, sums, ds_to))
    return rows, sums, dollars


def _reference_rates(sums: DataFrame, dollars: DataFrame, rates: DataFrame,
                     keep_missing: bool = False) -> DataFrame:
    """(day, currency_code) -> rate, as the reference's descending window picks it."""
    probes = (sums.select("day", "currency_code", F.col("hk_currency_code").alias("hk_currency_from"), "mn", "mx")
              .join(dollars.select("day", F.col("hk_currency_code_dollar").alias("hk_currency_to")), "day"))
    keys = ["hk_currency_from", "hk_currency_to"]
    # the first and the last moment of a day are looked up in one sweep
    moments = F.array(F.struct(F.col("mn").alias("t"), F.lit(True).alias("opens")), F.struct(F.col("mx").alias("t"), F.lit(False).alias("opens")))
    both = probes.select("day", "currency_code", *keys, F.explode(moments).alias("x")).select("day", "currency_code", *keys, "x.t", "x.opens")
    looked = asof_lookup(both, rates, keys, "t", "date_update", "currency_with_div", "r")
    per = looked.groupBy("day", "currency_code").agg(
        F.max((F.col("opens") & F.col("r").isNull()).cast("int")).alias("missing"),
        F.max(F.when(~F.col("opens"), F.col("r"))).alias("best"))
    out = per.select("day", "currency_code",
                     F.when(F.col("missing") == 1, one_rate())
                     .otherwise(F.col("best._v")).alias("rate"), "missing")
    return out if keep_missing else out.drop("missing")


def _with_dollars(rows: DataFrame, sums: DataFrame, dollars: DataFrame) -> DataFrame:
    """``rows`` once per dollar currency of their day.

    The dollars are first spread over the (day, currency) pairs that occur, a
    small table, so the rows are joined by day and currency: a day's rows are
    not one key, Spark broadcasts the pairs when it measures them as small, and
    splits a currency-day that holds much of the rows otherwise.
    """
    pairs = sums.select("day", "currency_code").join(dollars, "day")
    return rows.join(pairs, ["day", "currency_code"])


def join_result(vault: dict[str, DataFrame], ds_from=None, ds_to=None, rate_mode: str = "reference") -> DataFrame:
    """M5: the reference's ``join_result`` rows (one per row and dollar code)."""
    rows, sums, dollars = _day_currency_frames(vault, ds_from, ds_to)
    rates = rate_history(vault)
    with_d = _with_dollars(rows, sums, dollars)
    if rate_mode == "reference":
        rate = _reference_rates(sums, dollars, rates)
        out = with_d.join(rate, ["day", "currency_code"])
    else:
        out = asof_lookup(with_d.withColumnRenamed("hk_currency_code", "hk_currency_from")
                          .withColumnRenamed("hk_currency_code_dollar", "hk_currency_to"),
                          rates, ["hk_currency_from", "hk_currency_to"], "transaction_dt",
                          "date_update", "currency_with_div", "r") \
            .withColumn("rate", scale_rate(F.col("r._v")))
    return out.select("hk_operation_id", "amount", (F.col("amount") * F.col("rate")).alias("amount_in_dollar"),
                      "transaction_dt", "currency_code", "account", "currency_code_dollar")


def global_metrics(vault: dict[str, DataFrame], ds_from=None, ds_to=None, rate_mode: str = "reference") -> DataFrame:
    """M6: one row per (day, currency) with the four measures."""
    if rate_mode not in RATE_MODES:
        raise ValueError(f"rate_mode must be one of {RATE_MODES}")
    rows, sums, dollars = _day_currency_frames(vault, ds_from, ds_to)
    rates = rate_history(vault)

    if rate_mode == "reference":
        # The rate is constant per (day, currency), so it factors out of the
        # sum; every row counts k times (once per dollar code).
        k = dollars.groupBy("day").agg(F.countDistinct("currency_code_dollar").alias("k"))
        rate = _reference_rates(sums, dollars, rates)
        m = sums.join(k, "day").join(rate, ["day", "currency_code"]).select(
            "day", "currency_code", "n",
            (F.col("s") * F.col("k")).alias("vol"),
            (F.col("s") * F.col("k") * F.col("rate")).alias("usd"))
    else:
        with_d = _with_dollars(rows, sums, dollars)
        looked = asof_lookup(with_d.withColumnRenamed("hk_currency_code", "hk_currency_from")
                             .withColumnRenamed("hk_currency_code_dollar", "hk_currency_to"),
                             rates, ["hk_currency_from", "hk_currency_to"], "transaction_dt",
                             "date_update", "currency_with_div", "r")
        rate = scale_rate(F.col("r._v"))
        m = looked.groupBy("day", "currency_code").agg(
            F.countDistinct("account").alias("n"),
            F.sum("amount").alias("vol"),
            F.sum(F.col("amount") * rate).alias("usd"))
    return m.select(
        F.col("day").alias("date_update"),
        F.col("currency_code").cast("bigint").alias("currency_from"),
        round_money(F.col("usd")).alias("amount_total"),
        round_money(F.col("vol")).alias("cnt_transactions"),
        half_up_ratio(F.col("vol") * F.lit(100), F.col("n")).alias("avg_transactions_per_account"),
        F.col("n").cast("bigint").alias("cnt_accounts_make_transactions"),
    )
