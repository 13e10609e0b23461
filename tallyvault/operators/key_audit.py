"""Which business keys share a surrogate key.

A vault that inserts by surrogate key drops, without a word, a business key whose surrogate is
taken by another one.  The stored tables can't tell: the loser is not in them.  The audit
therefore reads the staged rows, makes every hub's and link's candidates as the loads do, and
asks of each surrogate whether all its business keys are the same.  Business keys are first
brought together as they are, before anything is hashed: a grouping without texts to compare,
combined before its shuffle (a currency with a third of all rows becomes a row per task).  Only
what is left, each business key once, gets its surrogate, and those of more than one are shared.
All nine tables are tagged and share the first shuffle, which doesn't depend on the width of
the keys either, so that audits of several widths may reuse it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import KeyFunction, canonical, hk
from .vault import MIN_ACCOUNT, MIN_CURRENCY, MIN_RECEIVER_FOR_TX_HUB

# The business columns behind each surrogate key, in the order of its arguments.
TRANSACTION_KEYS = {
    "h_transactions": ["operation_id"],
    "h_countries": ["country_name"],
    "h_currencies": ["currency_code"],
    "l_accounts_transactions": ["operation_id", "account_number_from", "account_number_to"],
    "l_countries_transactions": ["operation_id", "country_name"],
    "l_currency_transaction": ["currency_code", "operation_id"],
    "l_countries_currencies": ["country_name", "currency_code"],
}
ACCOUNT_COLUMNS = ["account_number_from", "account_number_to"]
RATE_KEY = ["currency_code", "currency_code_with"]
#: All of them; an account, sender or receiver, is told by the first account column.
KEYS = {**TRANSACTION_KEYS, "h_accounts": ACCOUNT_COLUMNS[:1], "l_currency_ratio": RATE_KEY}
TABLES = [*KEYS]
BUSINESS_COLUMNS = ["operation_id", *ACCOUNT_COLUMNS, "country_name", *RATE_KEY]


def _accounts(least_receiver: int) -> Column:
    return (F.col("account_number_from") >= MIN_ACCOUNT) & (F.col("account_number_to") >= least_receiver)


def _conditions() -> dict[str, Column]:
    """Which staged rows are a candidate of each table (before the tests against the hubs)."""
    country, currency = F.col("country_name").isNotNull(), F.col("currency_code") >= MIN_CURRENCY
    operation = _accounts(MIN_RECEIVER_FOR_TX_HUB)
    return {"h_transactions": operation, "h_countries": country, "h_currencies": currency, "l_accounts_transactions": _accounts(MIN_ACCOUNT),
            "l_countries_transactions": country, "l_currency_transaction": currency, "l_countries_currencies": country & currency}


def business_keys(transactions: DataFrame, currencies: DataFrame) -> DataFrame:
    """(the business columns, table, row_count): every business key of every table once, and how many staged rows have it.

    ``table`` is the table's place in ``TABLES``; a key has its own columns, the others are null.  Rows are candidates whether or not
    their operation or currency is in its hub: a link's key may only be reported for more rows than the load would insert.
    """
    t = transactions.withColumn("country_name", F.lower("country"))
    types = {**dict(t.dtypes), RATE_KEY[1]: dict(currencies.dtypes)[RATE_KEY[1]]}

    def key_of(table: str, cols: dict[str, str]) -> Column:
        return F.struct(*[(F.col(cols[c]) if c in cols else F.lit(None).cast(types[c])).alias(c) for c in BUSINESS_COLUMNS], F.lit(TABLES.index(table)).alias("table"))

    told = [F.when(when, key_of(table, dict(zip(TRANSACTION_KEYS[table], TRANSACTION_KEYS[table])))) for table, when in _conditions().items()]
    told += [F.when(F.col(c) >= MIN_ACCOUNT, key_of("h_accounts", {ACCOUNT_COLUMNS[0]: c})) for c in ACCOUNT_COLUMNS]
    of_rows = t.select(F.explode(F.array_compact(F.array(*told))).alias("x")).select("x.*")
    of_rates = currencies.where(F.col("date_update").isNotNull()).select(key_of("l_currency_ratio", dict(zip(RATE_KEY, RATE_KEY))).alias("x")).select("x.*")
    return of_rows.unionByName(of_rates).groupBy(*BUSINESS_COLUMNS, "table").agg(F.count(F.lit(1)).alias("row_count"))


def candidates(transactions: DataFrame, currencies: DataFrame, key: KeyFunction = hk) -> DataFrame:
    """(table_name, hk, business_key, row_count) of every table's business keys, each once; the business key is the text that is hashed."""
    def by_table(made: Callable[[str], Column]) -> Column:
        return F.coalesce(*[F.when(F.col("table") == i, made(table)) for i, table in enumerate(TABLES)])

    return business_keys(transactions, currencies).select(
        by_table(F.lit).alias("table_name"), by_table(lambda t: key(*KEYS[t])).alias("hk"), by_table(lambda t: canonical(*KEYS[t])).alias("business_key"), "row_count")


def shared_keys(transactions: DataFrame, currencies: DataFrame, key: KeyFunction = hk) -> DataFrame:
    """A row per surrogate key that different business keys share: its first and its last of them, and all rows' number."""
    per_key = candidates(transactions, currencies, key).groupBy("table_name", "hk").agg(
        F.min("business_key").alias("first_business_key"), F.max("business_key").alias("last_business_key"), F.sum("row_count").alias("row_count"))
    return per_key.where(F.col("first_business_key") != F.col("last_business_key"))


def audit(transactions: DataFrame, currencies: DataFrame, key: KeyFunction = hk) -> DataFrame:
    """Per table: its surrogate keys, and how many of them different business keys share."""
    per_key = candidates(transactions, currencies, key).groupBy("table_name", "hk").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("table_name").agg(F.count(F.lit(1)).alias("surrogate_keys"), F.count_if(F.col("n") > 1).alias("shared_keys"))
