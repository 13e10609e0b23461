"""Data-quality report for the declared constraints.

The reference declares NOT NULL, primary keys, unique keys, foreign keys,
CHECKs and column lengths in its DDL; Spark enforces none of these on
Parquet, so they are verified by one report of ``(table_name, rule,
violations)``.  Rules are declared once as data; ``rule_sql`` renders the
same rules as portable SQL (used by the DuckDB oracle).

Per table, all row-level rules (not null, check, length, precision) are
evaluated in a single pass of ``count_if``s; all keys of all tables, primary,
unique and foreign, in one more pass and one shuffle (:class:`KeyRules`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import GLOBAL_METRICS, STG_CURRENCIES, STG_TRANSACTIONS, VAULT, VAULT_KEYS

SCHEMAS = {"stg_transactions": STG_TRANSACTIONS, "stg_currencies": STG_CURRENCIES,
           "global_metrics": GLOBAL_METRICS, **VAULT}

# The constraints declared by the reference's DDL.
PRIMARY_KEYS = {**VAULT_KEYS, "global_metrics": ["date_update", "currency_from"]}
UNIQUE_KEYS = {
    "l_accounts_transactions": ["hk_operation_id", "hk_account_number_from", "hk_account_number_to"],
    "l_currency_ratio": ["hk_currency_from", "hk_currency_to"],
    "l_currency_transaction": ["hk_currency_code", "hk_operation_id"],
    "l_countries_currencies": ["hk_country_name", "hk_currency_code"],
    "l_countries_transactions": ["hk_country_name", "hk_operation_id"],
}
FOREIGN_KEYS = [
    ("s_transactions", "hk_operation_id", "h_transactions", "hk_operation_id"),
    ("l_accounts_transactions", "hk_operation_id", "h_transactions", "hk_operation_id"),
    ("l_accounts_transactions", "hk_account_number_from", "h_accounts", "hk_account_number"),
    ("l_accounts_transactions", "hk_account_number_to", "h_accounts", "hk_account_number"),
    ("l_currency_ratio", "hk_currency_from", "h_currencies", "hk_currency_code"),
    ("l_currency_ratio", "hk_currency_to", "h_currencies", "hk_currency_code"),
    ("s_l_currency_ratio", "hk_l_currency_ratio", "l_currency_ratio", "hk_l_currency_ratio"),
    ("l_currency_transaction", "hk_operation_id", "h_transactions", "hk_operation_id"),
    ("l_currency_transaction", "hk_currency_code", "h_currencies", "hk_currency_code"),
    ("l_countries_currencies", "hk_country_name", "h_countries", "hk_country_name"),
    ("l_countries_currencies", "hk_currency_code", "h_currencies", "hk_currency_code"),
    ("l_countries_transactions", "hk_country_name", "h_countries", "hk_country_name"),
    ("l_countries_transactions", "hk_operation_id", "h_transactions", "hk_operation_id"),
]
CHECKS = [
    ("global_metrics", "date_update >= DATE '2020-01-01'"),
    ("global_metrics", "currency_from >= 0"),
    ("global_metrics", "amount_total >= 0"),
    ("global_metrics", "cnt_transactions >= 0"),
    ("global_metrics", "avg_transactions_per_account >= 0"),
    ("global_metrics", "cnt_accounts_make_transactions >= 0"),
    ("s_transactions", "CAST(transaction_dt AS DATE) > DATE '2000-01-01'"),
    ("h_accounts", "account_number >= 0"),
    ("h_currencies", "currency_code >= 0"),
    ("s_l_currency_ratio", "currency_with_div >= 0"),
]
MAX_LENGTHS = {
    "stg_transactions": {"operation_id": 120, "country": 60, "status": 60, "transaction_type": 60,
                         "load_src": 40},
    "stg_currencies": {"load_src": 40},
}
for _t in VAULT:
    MAX_LENGTHS.setdefault(_t, {})["load_src"] = 40
MAX_LENGTHS["h_transactions"]["operation_id"] = 120
MAX_LENGTHS["h_countries"]["country_name"] = 60
MAX_LENGTHS["s_transactions"].update({"status": 60, "transaction_type": 60})


# Digits of a second that a time keeps, and (precision, scale) of the numbers, as declared.
TIME_DIGITS = {
    **{t: {"load_dt": 0} for t in SCHEMAS if t != "global_metrics"},
    "stg_transactions": {"transaction_dt": 3, "load_dt": 0},
    "stg_currencies": {"date_update": 3, "load_dt": 0},
}
TIME_DIGITS["s_transactions"]["transaction_dt"] = TIME_DIGITS["s_l_currency_ratio"]["date_update"] = 3
NUMBER_DIGITS = {
    "stg_currencies": {"currency_with_div": (5, 3)}, "s_l_currency_ratio": {"currency_with_div": (5, 3)},
    "global_metrics": {c: (18, 3) for c in ("amount_total", "cnt_transactions", "avg_transactions_per_account")},
}
_UNIT = {0: "second", 3: "millisecond"}


def row_rules(table: str) -> list[tuple[str, str]]:
    """(rule name, SQL expression counting a violation) for one table."""
    rules = [(f"not_null:{f.name}", f"{f.name} IS NULL")
             for f in SCHEMAS[table].fields if not f.nullable or f.name == "load_dt"]
    rules += [(f"check:{expr}", f"NOT ({expr})") for t, expr in CHECKS if t == table]
    rules += [(f"length:{c}<={n}", f"octet_length({c}) > {n}")
              for c, n in MAX_LENGTHS.get(table, {}).items()]
    rules += [(f"precision:{c}<={n}", f"CAST(date_trunc('{_UNIT[n]}', {c}) AS TIMESTAMP_NTZ) <> {c}")
              for c, n in TIME_DIGITS.get(table, {}).items()]
    rules += [(f"precision:{c}({p},{s})", f"abs({c}) >= 1{'0' * (p - s)} OR round({c}, {s}) <> {c}")
              for c, (p, s) in NUMBER_DIGITS.get(table, {}).items()]
    return rules


def _row_report(table: str, df: DataFrame) -> DataFrame | None:
    rules = row_rules(table)
    if not rules:
        return None
    agg = df.agg(*[F.count_if(F.expr(cond)).alias(f"r{i}") for i, (_, cond) in enumerate(rules)])
    stacked = ", ".join(f"'{name.replace(chr(39), chr(39) * 2)}', r{i}" for i, (name, _) in enumerate(rules))
    return agg.selectExpr(f"stack({len(rules)}, {stacked}) AS (rule, violations)") \
        .select(F.lit(table).alias("table_name"), "rule", F.col("violations").cast("bigint"))


class KeyRules:
    """All primary, unique and foreign keys of some tables, as one stream of tagged keys.

    A *domain* is one key of one table, primary or unique: its values are told by the rows of the table
    (slot 0) and by the rows of the tables that refer to it (a slot for each foreign key).  Every table
    is read once and explodes each row into the keys it takes part in; one aggregation by (domain,
    key), pre-combined before its shuffle, then says for every key how many rows have it and how many
    refer to it: more than one of the former breaks the key, none of them makes the latter orphans.
    """

    def __init__(self, tables: dict[str, DataFrame]) -> None:
        self.tables = tables
        #: Per table: (domain, slot, columns) of the keys its rows take part in.
        self.parts: dict[str, list[tuple[int, int, list[str]]]] = {t: [] for t in tables}
        #: (domain, slot) -> (table, rule): what the count of a slot reports.
        self.rules: list[tuple[int, int, str, str]] = []
        domains: dict[tuple[str, tuple[str, ...]], int] = {}

        def domain(table: str, cols: list[str]) -> int:
            key = (table, tuple(cols))
            if key not in domains:
                domains[key] = len(domains)
                self.parts[table].append((domains[key], 0, cols))
            return domains[key]

        for kind, keys in (("primary_key", PRIMARY_KEYS), ("unique", UNIQUE_KEYS)):
            for table, cols in keys.items():
                if table in tables:
                    self.rules.append((domain(table, cols), 0, table, f"{kind}:{','.join(cols)}"))
        referring: dict[int, int] = {}
        for child, col, parent, pcol in FOREIGN_KEYS:
            if child in tables and parent in tables:
                d = domain(parent, [pcol])
                referring[d] = slot = referring.get(d, 0) + 1
                self.parts[child].append((d, slot, [col]))
                self.rules.append((d, slot, child, f"foreign_key:{col}->{parent}.{pcol}"))
        self.slots = max(referring.values(), default=0)
        wide = any(tables[t].schema[c].dataType.typeName() == "binary" for t, parts in self.parts.items() for _, _, cols in parts for c in cols)
        self.kind = "binary" if wide else "long"
        self.width = max((len(c) for parts in self.parts.values() for _, _, c in parts), default=0)

    def _told(self, table: str) -> DataFrame:
        """(domain, slot, k0, k1, ...) of every row of a table and every key that it takes part in."""
        def key(c: str):       # dates and numbers alike become longs, and all become bytes beside keys of bytes
            kind = self.tables[table].schema[c].dataType.typeName()
            if kind == "binary":
                return F.col(c)
            number = F.unix_date(c).cast("long") if kind == "date" else F.col(c).cast("long")
            return F.to_binary(F.hex(number), F.lit("hex")) if self.kind == "binary" else number

        def one(d: int, slot: int, cols: list[str]):
            keys = [key(c) for c in cols] + [F.lit(None).cast(self.kind)] * (self.width - len(cols))
            return F.struct(F.lit(d).alias("domain"), F.lit(slot).alias("slot"), *[k.alias(f"k{i}") for i, k in enumerate(keys)])

        return self.tables[table].select(F.explode(F.array(*[one(*p) for p in self.parts[table]])).alias("x")).select("x.*")

    def report(self) -> DataFrame | None:
        told = [self._told(t) for t, parts in self.parts.items() if parts]
        if not told:
            return None
        rows = told[0]
        for more in told[1:]:
            rows = rows.unionByName(more)
        keys = [f"k{i}" for i in range(self.width)]
        per_key = rows.groupBy("domain", *keys).agg(
            *[F.count_if(F.col("slot") == s).alias(f"n{s}") for s in range(self.slots + 1)])
        # a null refers to nothing, whatever rows have a null key of their own
        orphan = (F.col("n0") == 0) | F.col("k0").isNull()
        per_domain = per_key.groupBy("domain").agg(
            F.sum(F.greatest(F.col("n0") - 1, F.lit(0))).alias("v0"),
            *[F.sum(F.when(orphan, F.col(f"n{s}")).otherwise(0)).alias(f"v{s}") for s in range(1, self.slots + 1)])
        found = per_domain.select("domain", F.posexplode(F.array(*[F.col(f"v{s}") for s in range(self.slots + 1)])).alias("slot", "violations"))
        spark = rows.sparkSession
        rules = spark.createDataFrame(self.rules, "r_domain int, r_slot int, table_name string, rule string")
        return (rules.join(found, (F.col("r_domain") == F.col("domain")) & (F.col("r_slot") == F.col("slot")), "left")
                .select("table_name", "rule", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")))


def quality_report(vault: dict[str, DataFrame], stg_transactions: DataFrame | None = None,
                   stg_currencies: DataFrame | None = None, mart: DataFrame | None = None,
                   missing_rates: DataFrame | None = None) -> DataFrame:
    tables = dict(vault)
    if stg_transactions is not None:
        tables["stg_transactions"] = stg_transactions
    if stg_currencies is not None:
        tables["stg_currencies"] = stg_currencies
    if mart is not None:
        tables["global_metrics"] = mart
    parts: list[DataFrame] = []
    for t, df in tables.items():
        r = _row_report(t, df)
        if r is not None:
            parts.append(r)
    keys = KeyRules(tables).report()
    if keys is not None:
        parts.append(keys)
    if missing_rates is not None:
        parts.append(missing_rates.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
            F.lit("global_metrics").alias("table_name"), F.lit("missing_rate").alias("rule"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rule_sql(tables: list[str], with_missing_rate: bool = False, prefix: str = "") -> str:
    """The same report as portable SQL over views named like the tables (after ``prefix``)."""
    sel = []
    for t in tables:
        view = prefix + t
        for name, cond in row_rules(t):
            q = name.replace("'", "''")
            cond = cond.replace("octet_length(", "strlen(").replace("TIMESTAMP_NTZ", "TIMESTAMP")      # DuckDB's names
            sel.append(f"SELECT '{t}' AS table_name, '{q}' AS rule, "
                       f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM {view}")
        for kind, keys in (("primary_key", PRIMARY_KEYS.get(t)), ("unique", UNIQUE_KEYS.get(t))):
            if keys:
                k = ", ".join(keys)
                sel.append(f"SELECT '{t}', '{kind}:{','.join(keys)}', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) "
                           f"FROM (SELECT count(*) AS n FROM {view} GROUP BY {k}) g WHERE n > 1")
    for child, col, parent, pcol in FOREIGN_KEYS:
        if child in tables and parent in tables:
            sel.append(f"SELECT '{child}', 'foreign_key:{col}->{parent}.{pcol}', CAST(count(*) AS BIGINT) "
                       f"FROM {prefix}{child} x WHERE NOT EXISTS (SELECT 1 FROM {prefix}{parent} p WHERE p.{pcol} = x.{col})")
    if with_missing_rate:
        sel.append("SELECT 'global_metrics', 'missing_rate', CAST(count(*) AS BIGINT) FROM missing_rate")
    return "\nUNION ALL\n".join(sel)
