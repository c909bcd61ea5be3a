import datetime as dt

from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.presets import UNKNOWN_LABEL


def test_clean_label_edge_rows(spark):
    df = spark.createDataFrame([(" N/A ",), ("Unknown",), ("",), (None,), (" Queens ",)], "v string")
    got = [r[0] for r in df.select(X.clean_label("v", UNKNOWN_LABEL)).collect()]
    assert got == [UNKNOWN_LABEL] * 4 + ["Queens"]


def test_row_hash_null_token_separates_neighbours(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    plain = {r[0] for r in df.select(X.row_hash(["a", "b"])).collect()}
    tok = {r[0] for r in df.select(X.row_hash(["a", "b"], null_token="\\N")).collect()}
    assert len(plain) == 1 and len(tok) == 2


def test_pct_null_on_zero_divisor(spark):
    df = spark.createDataFrame([(5, 0), (1, 3)], "n long, d long")
    got = [r[0] for r in df.select(X.pct("n", "d")).collect()]
    assert got == [None, 33.33]


def test_mean_exact_tie(spark):
    df = spark.createDataFrame([(17.703,), (18.507,)], "x double")
    assert df.select(X.avg_where("x", None, 2, scale=3)).first()[0] == 18.11


def test_any_true_null_is_false(spark):
    df = spark.createDataFrame([(None, None), (None, True), (False, None)], "a boolean, b boolean")
    assert [r[0] for r in df.select(X.any_true(["a", "b"])).collect()] == [False, True, False]


def test_positive_or_null(spark):
    df = spark.createDataFrame([(0,), (None,), (2,)], "p int")
    assert [r[0] for r in df.select(X.positive_or_null("p")).collect()] == [None, None, 2]


def test_in_month_literal_is_pushed_down(spark, tmp):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 31, 23, 59, 59),), (dt.datetime(2025, 2, 1),)], "t timestamp")
    df.write.parquet(f"{tmp}/t")
    r = spark.read.parquet(f"{tmp}/t").filter(X.in_month("t", "2025-01"))
    assert r.count() == 1
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual" in plan and "LessThan" in plan


def test_decode_map_and_ladder(spark):
    df = spark.createDataFrame([(1,), (8,)], "k int")
    assert [r[0] for r in df.select(X.decode_map({1: "a"}, "k")).collect()] == ["a", None]
    lad = X.ladder([(F.col("k") > 5, "big")], "small")
    assert [r[0] for r in df.select(lad).collect()] == ["small", "big"]


def test_mean_leaves_out_values_that_are_not_finite(spark):
    from strata.functions.exprs import avg_where
    df = spark.createDataFrame([(1.5,), (2.5,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double")
    r = df.agg(avg_where("x", None, 2, 2).alias("a"), avg_where("x").alias("b")).first()
    assert (r.a, r.b) == (2.0, 2.0)
    big = spark.createDataFrame([(1e17,), (3e17,)], "x double").agg(avg_where("x", None, 2, 3).alias("a")).first()
    assert big.a == 2e17
