"""Explicit schemas for the 14 tables (never inferred).

Staging tables carry the source columns plus ``load_dt``/``load_src``.
Vault tables carry ``load_dt``/``load_src`` plus ``ds``: the logical day
whose run inserted the row (the partition column; the reference derives
its partitions from the load timestamp).  Integer columns are 64-bit.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, S, D = T.LongType(), T.StringType(), T.DateType()
TS = T.TimestampNTZType()
RATE = T.DecimalType(5, 3)
MONEY = T.DecimalType(18, 3)


def _st(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_LOAD = (("load_dt", TS, True), ("load_src", S, False))
_VAULT = (("load_dt", TS, True), ("load_src", S, False), ("ds", D, False))

# Source column order of the CSV extracts (header skipped, not matched).
TRANSACTION_COLUMNS = [
    "operation_id", "account_number_from", "account_number_to", "currency_code",
    "country", "status", "transaction_type", "amount", "transaction_dt",
]
CURRENCY_COLUMNS = ["date_update", "currency_code", "currency_code_with", "currency_with_div"]

STG_TRANSACTIONS = _st(
    ("operation_id", S, False), ("account_number_from", L, False),
    ("account_number_to", L, True), ("currency_code", L, True),
    ("country", S, False), ("status", S, False), ("transaction_type", S, False),
    ("amount", L, False), ("transaction_dt", TS, False), *_LOAD,
)
STG_CURRENCIES = _st(
    ("date_update", TS, True), ("currency_code", L, False),
    ("currency_code_with", L, False), ("currency_with_div", RATE, False), *_LOAD,
)

VAULT = {
    "h_transactions": _st(("hk_operation_id", L, False), ("operation_id", S, False), *_VAULT),
    "h_accounts": _st(("hk_account_number", L, False), ("account_number", L, False), *_VAULT),
    "h_currencies": _st(("hk_currency_code", L, False), ("currency_code", L, False), *_VAULT),
    "h_countries": _st(("hk_country_name", L, False), ("country_name", S, False), *_VAULT),
    "l_accounts_transactions": _st(
        ("hk_l_account_transaction", L, False), ("hk_operation_id", L, False),
        ("hk_account_number_from", L, False), ("hk_account_number_to", L, False), *_VAULT),
    "l_countries_transactions": _st(
        ("hk_countries_transactions", L, False), ("hk_country_name", L, False),
        ("hk_operation_id", L, False), *_VAULT),
    "l_currency_transaction": _st(
        ("hk_l_currency_transaction", L, False), ("hk_currency_code", L, False),
        ("hk_operation_id", L, False), *_VAULT),
    "l_countries_currencies": _st(
        ("hk_l_countries_currencies", L, False), ("hk_country_name", L, False),
        ("hk_currency_code", L, False), *_VAULT),
    "l_currency_ratio": _st(
        ("hk_l_currency_ratio", L, False), ("hk_currency_from", L, False),
        ("hk_currency_to", L, False), *_VAULT),
    "s_transactions": _st(
        ("hk_operation_id", L, False), ("status", S, False), ("transaction_type", S, False),
        ("amount", L, False), ("transaction_dt", TS, False), *_VAULT),
    "s_l_currency_ratio": _st(
        ("hk_l_currency_ratio", L, False), ("currency_with_div", RATE, False),
        ("date_update", TS, False), *_VAULT),
}

def vault_schema(table: str, wide_keys: bool = False) -> T.StructType:
    """A vault table's schema; with ``wide_keys`` its surrogate keys are 16 bytes instead of longs."""
    if not wide_keys:
        return VAULT[table]
    return T.StructType([T.StructField(f.name, T.BinaryType(), f.nullable) if f.name.startswith("hk_") else f
                         for f in VAULT[table].fields])


# Insert-if-absent key of each hub and link (satellites are append-only).
VAULT_KEYS = {
    "h_transactions": ["hk_operation_id"],
    "h_accounts": ["hk_account_number"],
    "h_currencies": ["hk_currency_code"],
    "h_countries": ["hk_country_name"],
    "l_accounts_transactions": ["hk_l_account_transaction"],
    "l_countries_transactions": ["hk_countries_transactions"],
    "l_currency_transaction": ["hk_l_currency_transaction"],
    "l_countries_currencies": ["hk_l_countries_currencies"],
    "l_currency_ratio": ["hk_l_currency_ratio"],
}

HUBS = ["h_transactions", "h_countries", "h_currencies", "h_accounts"]
LINKS = ["l_accounts_transactions", "l_countries_transactions", "l_currency_transaction",
         "l_countries_currencies", "l_currency_ratio"]
SATELLITES = ["s_transactions", "s_l_currency_ratio"]
VAULT_ORDER = HUBS + LINKS + SATELLITES

# The key that a stored vault table is bucketed by: the operation where rows belong to one.
BUCKET_KEY = {
    **{t: keys[0] for t, keys in VAULT_KEYS.items()},
    **{t: "hk_operation_id" for t in ("l_accounts_transactions", "l_countries_transactions", "l_currency_transaction", "s_transactions")},
    "s_l_currency_ratio": "hk_l_currency_ratio",
}

GLOBAL_METRICS = _st(
    ("date_update", D, False), ("currency_from", L, True),
    ("amount_total", MONEY, True), ("cnt_transactions", MONEY, True),
    ("avg_transactions_per_account", MONEY, True),
    ("cnt_accounts_make_transactions", L, True),
)
MART_KEY = ["date_update", "currency_from"]

# Physical layout per table: (partition column, sort columns, distribution key).
LAYOUT = {
    "stg_transactions": ("ds", ["transaction_dt"], ["operation_id"]),
    "stg_currencies": ("ds", ["date_update"], ["currency_code", "currency_code_with"]),
    "global_metrics": ("date_update", ["date_update", "currency_from"], ["date_update", "currency_from"]),
    **{t: ("ds", ["load_dt"], VAULT_KEYS.get(t, ["hk_operation_id"] if t == "s_transactions"
                                             else ["hk_l_currency_ratio"]))
       for t in VAULT},
}
