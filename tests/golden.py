"""Hand-made micro case (FIXTURES.md section 4), expected rows worked out by hand."""

import datetime as dt
from decimal import Decimal

from tallyvault.schemas import STG_CURRENCIES, STG_TRANSACTIONS

T = "transfer_outgoing"
TX = [
    ("z", "10-01 00:30", 9, 1, 400, "USA", "done", T, 100),
    ("i", "10-01 10:00", 5, 1, 400, "usa", "done", T, -700),
    ("a", "10-01 01:00", 1, 2, 410, "England", "done", T, 1000),
    ("b", "10-01 12:00", 2, 1, 410, "England", "done", T, 2000),
    ("c", "10-02 05:00", 1, 2, 410, "England", "done", T, 1000),
    ("d", "10-02 12:00", 2, 1, 410, "England", "done", T, 2000),
    ("e", "10-02 12:00", 1, 2, 420, "Russia", "done", T, 1000),
    ("f", "10-01 10:00", 3, 1, 430, "Turkey", "done", T, 5000),
    ("f", "10-02 10:00", 3, 1, 430, "Turkey", "chargeback", T, 5000),
    ("g", "10-01 10:00", 3, 1, 440, "China", "done", T, 5000),
    ("g", "10-01 11:00", 3, 1, 440, "China", "blocked", T, 5000),
    ("h", "10-01 10:00", 3, 0, 450, "Germany", "done", T, 5000),
    ("j", "10-01 10:00", 6, 1, 460, "Japan", "done", T, 100),
    ("k", "10-01 10:01", 6, 1, 460, "Japan", "done", T, 101),
    ("l", "10-01 10:02", 7, 1, 460, "Japan", "done", T, 100),
    ("m", "10-01 10:03", 8, 1, 460, "Japan", "done", "authorization", 999),
    ("n", "10-01 10:04", 8, 1, 460, "Japan", "queued", T, 999),
]
RATES = [("10-01 06:00", 410, 400, "0.500"), ("10-02 06:00", 410, 400, "0.600"),
         ("10-01 00:00", 420, 400, "0.300")]
EXTRA_DOLLAR = ("y", "10-01 00:31", 9, 1, 470, "USA", "done", T, 100)

D1, D2 = dt.date(2022, 10, 1), dt.date(2022, 10, 2)
# (day, currency) -> (amount_total, cnt_transactions, avg, senders, per-transaction amount_total)
EXPECTED = {
    (D1, 400): ("8.000", "8.000", "4.000", 2, "8.000"),
    (D1, 410): ("30.000", "30.000", "15.000", 2, "20.000"),
    (D1, 430): ("50.000", "50.000", "50.000", 1, "50.000"),
    (D1, 460): ("3.010", "3.010", "1.505", 2, "3.010"),
    (D2, 410): ("18.000", "30.000", "15.000", 2, "17.000"),
    (D2, 420): ("10.000", "10.000", "10.000", 1, "10.000"),
}


def ts(s):
    return dt.datetime.strptime("2022-" + s, "%Y-%m-%d %H:%M")


def tx_rows(rows=TX, country_map=None):
    out = []
    for op, t, f, to, cur, country, status, typ, amount in rows:
        if country_map:
            country = country_map.get(country, country)
        out.append(("op-" + op, f, to, cur, country, status, typ, amount, ts(t), None, "postgre"))
    return out


def frames(spark, rows=TX, country_map=None):
    tx = spark.createDataFrame(tx_rows(rows, country_map), STG_TRANSACTIONS)
    cur = spark.createDataFrame([(ts(t), a, b, Decimal(r), None, "postgre") for t, a, b, r in RATES],
                                STG_CURRENCIES)
    return tx, cur
