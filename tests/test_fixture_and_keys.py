from pyspark.sql import functions as F

from tallyvault.functions.keys import hk, hk_sql_duckdb
from compare import duckdb_connection
from tallyvault.sources import fixture

from conftest import SF_SMALL


def test_fixture_counts_match_documented_properties(spark):
    t = fixture.transactions(spark, SF_SMALL)
    c = fixture.currencies(spark, SF_SMALL)
    row = t.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("operation_id").alias("ops"),
        F.count_if(F.col("account_number_from") < 0).alias("neg_from"),
        F.count_if(F.col("account_number_to").isNull()).alias("to_null"),
        F.count_if(F.col("account_number_to") == 0).alias("to_zero"),
        F.count_if(F.col("currency_code").isNull()).alias("cur_null"),
        F.count_if(F.col("amount") < 0).alias("neg_amount"),
        F.count_if(F.col("status") == "done").alias("done"),
        F.count_if(F.col("transaction_type") == "authorization").alias("auth"),
    ).first()
    assert tuple(row) == (1000, 500, 6, 44, 34, 26, 200, 401, 100)
    assert c.count() == 5760


def test_keys_match_duckdb_for_one_two_three_args_and_nulls(spark):
    rows = [("op-1", 3, None), ("op-1", None, 3), (None, None, None), ("a|b", 12, 7)]
    df = spark.createDataFrame(rows, "a string, b long, c long")
    got = df.select(hk("a").alias("k1"), hk("a", "b").alias("k2"), hk("a", "b", "c").alias("k3")).collect()
    con = duckdb_connection(SF_SMALL)
    for (a, b, c), g in zip(rows, got):
        sql = (f"SELECT {hk_sql_duckdb('a')}, {hk_sql_duckdb('a', 'b')}, {hk_sql_duckdb('a', 'b', 'c')} "
               "FROM (SELECT ?::VARCHAR AS a, ?::BIGINT AS b, ?::BIGINT AS c)")
        assert tuple(g) == con.execute(sql, [a, b, c]).fetchone()
    # argument order and nulls are significant
    assert got[0].k2 != got[1].k2
    assert spark.range(1).select(hk(F.lit("op-1"), F.lit("3"))).first()[0] == 520679456985514063   # md5("4:op-11:3"), first 15 hex digits
