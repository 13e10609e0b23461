"""Data Vault loads (hubs, links, satellites).

Two equivalent forms:

* ``build_vault(tx, cur)`` - set-based over any number of days.  Every
  hub/link row gets ``ds`` = the first day on which a day-by-day replay
  would have inserted it: the earliest day whose staging rows qualify,
  where "qualify" includes the insert-if-absent test and membership of the
  hubs it joins (a hub key is present from its own first day on).
* ``load_day(tx_day, cur_day, vault, ds)`` - one day against the stored
  vault (the reference's incremental run): candidates minus existing keys.

Both read staging rows only through DataFrame ops, so filters and column
pruning reach the scan.  Aggregations pre-combine map-side before their
shuffle, which keeps a hot key (a currency or country holding a third of
all rows) from landing whole in one task.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import KeyFunction, hk
from ..schemas import BUCKET_KEY, HUBS, LINKS, SATELLITES, VAULT, VAULT_KEYS

# Status filters live in the mart; here only the bounds used
# by the loads (sender >= 0, receiver >= 1 for the transaction hub).
MIN_ACCOUNT = 0
MIN_RECEIVER_FOR_TX_HUB = 1
MIN_CURRENCY = 0
MIN_RATE = 0
#: Stands for the load day of rows that were stored before the days of a run.
BEFORE_ALL = _dt.date(1000, 1, 1)


def _day(col: str) -> Column:
    return F.to_date(F.col(col))


def prepare_transactions(tx: DataFrame, key: KeyFunction = hk) -> DataFrame:
    """Staging transactions with the derived columns every load needs."""
    return tx.select(
        "operation_id", "account_number_from", "account_number_to", "currency_code",
        F.lower("country").alias("country_name"), "status", "transaction_type", "amount",
        "transaction_dt", "load_src", _day("transaction_dt").alias("day"),
        key("operation_id").alias("hk_operation_id"),
    )


def prepare_currencies(cur: DataFrame) -> DataFrame:
    return cur.select(
        "date_update", "currency_code", "currency_code_with", "currency_with_div", "load_src",
        _day("date_update").alias("day"),
    ).where(F.col("day").isNotNull())


# ---------------------------------------------------------------- candidates
# Each returns (candidate rows with a ``day`` column) for one table, before
# the insert-if-absent rule.  Hub-membership conditions are applied by the
# callers because they differ between the set-based and daily forms.
# ``key`` makes the surrogate keys; all rows of a vault need the same one.

def hub_transactions_candidates(t: DataFrame, key: KeyFunction = hk) -> DataFrame:
    return (t.where((F.col("account_number_from") >= MIN_ACCOUNT)
                    & (F.col("account_number_to") >= MIN_RECEIVER_FOR_TX_HUB))
            .select("hk_operation_id", "operation_id", "load_src", "day"))


def hub_countries_candidates(t: DataFrame, key: KeyFunction = hk) -> DataFrame:
    return (t.where(F.col("country_name").isNotNull())
            .select(key("country_name").alias("hk_country_name"), "country_name", "load_src", "day"))


def hub_currencies_candidates(t: DataFrame, key: KeyFunction = hk) -> DataFrame:
    return (t.where(F.col("currency_code") >= MIN_CURRENCY)
            .select(key("currency_code").alias("hk_currency_code"), "currency_code", "load_src", "day"))


def hub_accounts_candidates(t: DataFrame, key: KeyFunction = hk) -> DataFrame:
    """Senders UNION receivers (set union: duplicates collapse later)."""
    def side(c: str) -> DataFrame:
        return (t.where(F.col(c) >= MIN_ACCOUNT)
                .select(key(c).alias("hk_account_number"), F.col(c).alias("account_number"),
                        "load_src", "day"))
    return side("account_number_from").unionByName(side("account_number_to"))


def link_accounts_candidates(t_in_hub: DataFrame, key: KeyFunction = hk) -> DataFrame:
    # Both accounts pass the account hub's own filter on this very row, so
    # the hub joins of the reference can only confirm them: not repeated.
    return (t_in_hub.where((F.col("account_number_from") >= MIN_ACCOUNT)
                           & (F.col("account_number_to") >= MIN_ACCOUNT))
            .select(key("operation_id", "account_number_from", "account_number_to")
                    .alias("hk_l_account_transaction"),
                    "hk_operation_id",
                    key("account_number_from").alias("hk_account_number_from"),
                    key("account_number_to").alias("hk_account_number_to"),
                    "load_src", "day"))


def link_countries_transactions_candidates(t_in_hub: DataFrame, key: KeyFunction = hk) -> DataFrame:
    return (t_in_hub.where(F.col("country_name").isNotNull())
            .select(key("operation_id", "country_name").alias("hk_countries_transactions"),
                    key("country_name").alias("hk_country_name"), "hk_operation_id",
                    "load_src", "day"))


def link_currency_transaction_candidates(t_in_hub: DataFrame, key: KeyFunction = hk) -> DataFrame:
    # The currency hub join of the reference keeps exactly codes >= 0.
    return (t_in_hub.where(F.col("currency_code") >= MIN_CURRENCY)
            .select(key("currency_code", "operation_id").alias("hk_l_currency_transaction"),
                    key("currency_code").alias("hk_currency_code"), "hk_operation_id",
                    "load_src", "day"))


def link_countries_currencies_candidates(t_in_hub: DataFrame, key: KeyFunction = hk) -> DataFrame:
    return (t_in_hub.where(F.col("country_name").isNotNull()
                           & (F.col("currency_code") >= MIN_CURRENCY))
            .select(key("country_name", "currency_code").alias("hk_l_countries_currencies"),
                    key("country_name").alias("hk_country_name"),
                    key("currency_code").alias("hk_currency_code"),
                    "load_src", "day"))


def link_currency_ratio_candidates(c_in_hub: DataFrame, key: KeyFunction = hk) -> DataFrame:
    return c_in_hub.select(
        key("currency_code", "currency_code_with").alias("hk_l_currency_ratio"),
        key("currency_code").alias("hk_currency_from"),
        key("currency_code_with").alias("hk_currency_to"),
        "load_src", "day")


def sat_transactions_candidates(t_in_hub: DataFrame, key: KeyFunction = hk) -> DataFrame:
    return (t_in_hub.where(F.col("status").isNotNull() & F.col("transaction_type").isNotNull()
                           & F.col("amount").isNotNull())
            .select("hk_operation_id", "status", "transaction_type", "amount",
                    "transaction_dt", "load_src", "day"))


def sat_rate_candidates(c: DataFrame, key: KeyFunction = hk) -> DataFrame:
    return (c.where(F.col("currency_with_div").isNotNull()
                    & (F.col("currency_with_div") >= MIN_RATE))
            .select(key("currency_code", "currency_code_with").alias("hk_l_currency_ratio"),
                    "currency_with_div", "date_update", "load_src", "day"))


# ---------------------------------------------------------------- set-based

def first_loaded(cands: DataFrame, key: list[str], cluster_by: list[str] | None = None,
                 stored: DataFrame | None = None) -> DataFrame:
    """Rows a day-by-day insert-if-absent replay would have kept.

    A key is inserted on its first qualifying day, with every distinct row
    of that day; later days add nothing for it, and a key of ``stored`` is
    never inserted.  The groupBy pre-combines duplicates map-side
    (skew-safe); the window then sees at most one row per distinct (key,
    attributes) and runs on already-reduced data.  Tables with a row or two
    per operation gain nothing from that: with ``cluster_by`` their rows are
    shuffled once by the operation, which the grouping, the window and the
    test against the stored keys then share.
    """
    if cluster_by:
        cands = cands.repartition(*cluster_by)
    if stored is not None:
        cands = cands.join(stored.select(*{*key, *(cluster_by or [])}), [*{*key, *(cluster_by or [])}], "left_anti")
    attrs = [c for c in cands.columns if c != "day"]
    per_row = cands.groupBy(*attrs).agg(F.min("day").alias("ds"))
    first = F.min("ds").over(Window.partitionBy(*key, *[c for c in cluster_by or [] if c not in key]))
    return per_row.withColumn("_first", first).where(F.col("ds") == F.col("_first")).drop("_first")


def _stamp(df: DataFrame, table: str, load_dt) -> DataFrame:
    """Select the table's columns in schema order with load_dt filled (keys are as wide as they were made)."""
    when = "NULL" if load_dt is None else f"'{load_dt.isoformat(sep=' ')}'"
    return df.selectExpr(*[f"CAST({when} AS TIMESTAMP_NTZ) AS load_dt" if f.name == "load_dt" else
                           f"`{f.name}`" if f.name.startswith("hk_") else f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in VAULT[table].fields])


def build_vault(tx: DataFrame, cur: DataFrame, load_dt: _dt.datetime | None = None,
                persist: Callable[[str, DataFrame], DataFrame] | None = None,
                parallel: int = 4, stored: dict[str, DataFrame] | None = None, key: KeyFunction = hk) -> dict[str, DataFrame]:
    """All 11 vault tables' new rows from staging rows of any number of days.

    ``stored`` (optional) is what the vault holds already, outside the days
    loaded here: its keys are not inserted again, and its hubs and links
    count as present from the start, as they do for a replay of these days.

    ``persist(name, df)`` (optional) stores an intermediate and returns the
    stored table.  The pipeline passes one that writes Parquet to the shared
    checkpoint folder: hubs are then read back by the links instead of
    being recomputed, and the hub-filtered staging rows are written once
    for the four operation links and the satellite.  Without it the result
    is one lazy plan per table.
    """
    def keep_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        # Tables of one phase do not depend on each other: store them as
        # concurrent Spark jobs when a persister is given.
        if persist is None:
            return tables
        if len(tables) == 1 or parallel <= 1:
            return {n: persist(n, df) for n, df in tables.items()}
        with ThreadPoolExecutor(max_workers=min(parallel, len(tables))) as pool:
            futures = {n: pool.submit(persist, n, df) for n, df in tables.items()}
            return {n: f.result() for n, f in futures.items()}

    def new_rows(name: str, cands: DataFrame, cluster_by: list[str] | None = None) -> DataFrame:
        return _stamp(first_loaded(cands, VAULT_KEYS[name], cluster_by, stored and stored[name]), name, load_dt)

    def present(name: str, col: str, since: str) -> DataFrame:
        """(col, since): the day from which each key is there; stored ones always were."""
        rows = out[name].select(col, F.col("ds").alias(since))
        if stored is not None:
            rows = rows.unionByName(stored[name].select(col, F.lit(BEFORE_ALL).alias(since)))
        return rows.groupBy(col).agg(F.min(since).alias(since))

    def each_once(rows: DataFrame, *cols: str) -> DataFrame:
        """Every combination of business columns on its first day: keys are hashed for these few, not for every row."""
        return rows.groupBy(*cols, "load_src").agg(F.min("day").alias("day"))

    t = prepare_transactions(tx, key)
    c = prepare_currencies(cur)
    accounts = each_once(t, "account_number_from").unionByName(each_once(t, "account_number_to"), allowMissingColumns=True)
    by_op = ["hk_operation_id"]
    out: dict[str, DataFrame] = {}
    out.update(keep_all({
        name: new_rows(name, fn(rows, key), cluster)
        for name, fn, rows, cluster in (("h_transactions", hub_transactions_candidates, t, by_op),
                                        ("h_countries", hub_countries_candidates, each_once(t, "country_name"), None),
                                        ("h_currencies", hub_currencies_candidates, each_once(t, "currency_code"), None),
                                        ("h_accounts", hub_accounts_candidates, accounts, None))}))

    # Rows whose operation is in the transaction hub by the row's own day.
    op_first = present("h_transactions", "operation_id", "op_ds")
    # Rates need both currencies in the hub by the rate's day.
    cur_first = present("h_currencies", "currency_code", "cur_ds")
    c_in_hub = (c.join(cur_first, "currency_code")
                .where(F.col("cur_ds") <= F.col("day")).drop("cur_ds")
                .join(cur_first.withColumnRenamed("currency_code", "currency_code_with")
                      .withColumnRenamed("cur_ds", "with_ds"), "currency_code_with")
                .where(F.col("with_ds") <= F.col("day")).drop("with_ds"))
    phase2 = keep_all({
        "_tx_in_hub": t.join(op_first, "operation_id").where(F.col("op_ds") <= F.col("day")).drop("op_ds"),
        "l_currency_ratio": new_rows("l_currency_ratio", link_currency_ratio_candidates(c_in_hub, key))})
    t_in_hub = phase2.pop("_tx_in_hub")
    out.update(phase2)

    link_first = present("l_currency_ratio", "hk_l_currency_ratio", "l_ds")
    phase3 = {
        name: new_rows(name, fn(rows, key), cluster)
        for name, fn, rows, cluster in (
            ("l_accounts_transactions", link_accounts_candidates, t_in_hub, by_op),
            ("l_countries_transactions", link_countries_transactions_candidates, t_in_hub, by_op),
            ("l_currency_transaction", link_currency_transaction_candidates, t_in_hub, by_op),
            # The reference also requires the operation in its hub here.
            ("l_countries_currencies", link_countries_currencies_candidates, each_once(t_in_hub, "country_name", "currency_code"), None))}
    phase3["s_transactions"] = _stamp(
        sat_transactions_candidates(t_in_hub, key).distinct().withColumnRenamed("day", "ds"), "s_transactions", load_dt)
    phase3["s_l_currency_ratio"] = _stamp(
        sat_rate_candidates(c, key).join(link_first, "hk_l_currency_ratio")
        .where(F.col("l_ds") <= F.col("day")).drop("l_ds").distinct().withColumnRenamed("day", "ds"),
        "s_l_currency_ratio", load_dt)
    out.update(keep_all(phase3))
    return {name: out[name] for name in VAULT}


def _same(left: str, right: str) -> Column:
    """Equality that the join only tests, so that its other key alone decides how rows are dealt out."""
    return (F.col(left) >= F.col(right)) & (F.col(left) <= F.col(right))


def in_transaction_hub(t: DataFrame, hub: DataFrame) -> DataFrame:
    """Rows whose operation is in the hub: by business key, as the reference joins, dealt out by the surrogate
    key, so that a stored hub bucketed by it is read in place."""
    keys = hub.select(F.col("hk_operation_id").alias("_hk"), F.col("operation_id").alias("_op"))
    return t.join(keys, (F.col("hk_operation_id") == F.col("_hk")) & _same("operation_id", "_op"), "left_semi")


def rates_in_hub_after(c: DataFrame, t: DataFrame, hub: DataFrame) -> DataFrame:
    """A day's rates with both currencies in the hub once the day's own rows are inserted."""
    codes = hub.select("currency_code").unionByName(hub_currencies_candidates(t).select("currency_code"))
    return (c.join(codes, "currency_code", "left_semi")
            .join(codes.withColumnRenamed("currency_code", "currency_code_with"), "currency_code_with", "left_semi"))


def in_hub_after(t: DataFrame, hub: DataFrame) -> DataFrame:
    """Rows of a day whose operation is in the hub once the day's own rows are inserted.

    The day's candidates and the stored hub are asked one after the other: a union of both would
    have to be shuffled, the stored hub with it.
    """
    own = hub_transactions_candidates(t).select("hk_operation_id", "operation_id")
    keys = own.select(F.col("hk_operation_id").alias("_hk"), F.col("operation_id").alias("_op"))
    same = (F.col("hk_operation_id") == F.col("_hk")) & _same("operation_id", "_op")
    return t.join(keys, same, "left_semi").unionByName(in_transaction_hub(t.join(keys, same, "left_anti"), hub))


# ---------------------------------------------------------------- one day

def _new_keys(cands: DataFrame, existing: DataFrame, table: str, ds) -> DataFrame:
    """Distinct candidates of one day whose key is not stored yet (NOT EXISTS).

    The join is dealt out by the column that the stored table is bucketed by, so only the day's rows move.
    """
    rows = cands.drop("day").distinct()
    (key,), by = VAULT_KEYS[table], BUCKET_KEY[table]
    if by == key:
        new = rows.join(existing.select(key), key, "left_anti")
    else:
        old = existing.select(F.col(by).alias("_by"), F.col(key).alias("_key"))
        new = rows.join(old, (F.col(by) == F.col("_by")) & _same(key, "_key"), "left_anti")
    return new.withColumn("ds", F.lit(ds).cast("date"))


def load_day(tx_day: DataFrame, cur_day: DataFrame, vault: dict[str, DataFrame], ds,
             load_dt: _dt.datetime | None = None, phase: str | tuple[str, ...] | None = None,
             tx_in_hub: DataFrame | None = None, rates_in_hub: DataFrame | None = None, key: KeyFunction = hk) -> dict[str, DataFrame]:
    """Rows one daily run appends, given the stored vault before it.

    Statement order matters as in the reference: hubs, then links (which
    see this run's hub rows), then satellites (which see this run's
    links).  With ``phase`` = "hubs" / "links" / "satellites", or several of
    them, only those groups are computed against ``vault`` as stored, later
    groups seeing the earlier ones' new rows (the pipeline passes the day's rows
    whose operation or currencies are in their hub as ``tx_in_hub`` and
    ``rates_in_hub``); ``phase=None`` means all.
    """
    groups = ("hubs", "links", "satellites") if phase is None else (phase,) if isinstance(phase, str) else phase
    ds = _dt.date.fromisoformat(str(ds)) if not isinstance(ds, _dt.date) else ds
    t = prepare_transactions(tx_day, key).where(F.col("day") == F.lit(ds))
    c = prepare_currencies(cur_day).where(F.col("day") == F.lit(ds))
    new: dict[str, DataFrame] = {}
    if "hubs" in groups:
        for name, fn in (("h_transactions", hub_transactions_candidates),
                         ("h_countries", hub_countries_candidates),
                         ("h_currencies", hub_currencies_candidates),
                         ("h_accounts", hub_accounts_candidates)):
            new[name] = _new_keys(fn(t, key), vault[name], name, ds)

    if "links" in groups:
        t_in_hub = tx_in_hub if tx_in_hub is not None else in_hub_after(t, vault["h_transactions"])
        for name, fn in (("l_accounts_transactions", link_accounts_candidates),
                         ("l_countries_transactions", link_countries_transactions_candidates),
                         ("l_currency_transaction", link_currency_transaction_candidates),
                         ("l_countries_currencies", link_countries_currencies_candidates)):
            new[name] = _new_keys(fn(t_in_hub, key), vault[name], name, ds)
        rates = rates_in_hub if rates_in_hub is not None else rates_in_hub_after(c, t, vault["h_currencies"])
        ratios = link_currency_ratio_candidates(rates, key)
        new["l_currency_ratio"] = _new_keys(ratios, vault["l_currency_ratio"], "l_currency_ratio", ds)
    if "satellites" in groups:
        t_in_hub = tx_in_hub if tx_in_hub is not None else in_hub_after(t, vault["h_transactions"])
        new["s_transactions"] = (sat_transactions_candidates(t_in_hub, key).drop("day").distinct()
                                 .withColumn("ds", F.lit(ds).cast("date")))
        links = vault["l_currency_ratio"].select("hk_l_currency_ratio")
        if "links" in groups:
            # This run's links are named by its candidates, not by those that are new: links and satellites are
            # written side by side, and a link that is stored between two looks at its table would be neither.
            links = links.unionByName(ratios.select("hk_l_currency_ratio"))
        new["s_l_currency_ratio"] = (sat_rate_candidates(c, key).join(links, "hk_l_currency_ratio", "left_semi")
                                     .drop("day").distinct().withColumn("ds", F.lit(ds).cast("date")))
    wanted = {"hubs": HUBS, "links": LINKS, "satellites": SATELLITES}
    return {k: _stamp(new[k], k, load_dt) for g in groups for k in wanted[g]}


def empty_vault(spark) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in VAULT.items()}
