"""Operators against brute force, including tables where one key holds a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from regionledger.operators import aggregates, columns, joins, quality, sets, windows


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows; a third share key 0 and value 5."""
    df = spark.range(0, 30000, numPartitions=8).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(10000)) / 7).alias("v"),
    )
    return df, df.toPandas()


@pytest.mark.parametrize("accuracy", [10000, 200])
def test_exact_quantiles_with_hot_value(skewed, accuracy):
    df, pdf = skewed
    probs = [0.0, 0.01, 0.05, 0.25, 0.5, 0.95, 0.99, 1.0]
    long = df.select(F.lit("v").alias("name"), F.col("v").alias("value")).union(df.select(F.lit("k"), F.col("k").cast("double")))
    got = {r["name"]: r for r in aggregates.exact_quantiles(long, "name", "value", probs, accuracy).collect()}
    for name in ("v", "k"):
        assert got[name]["value_cnt"] == len(pdf)
        np.testing.assert_allclose(got[name]["quantiles"], pdf[name].quantile(probs).to_numpy(), rtol=1e-12)


def test_exact_quantiles_tiny(spark):
    long = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 2.0), ("b", None)], "name string, value double")
    got = {r["name"]: r["quantiles"] for r in aggregates.exact_quantiles(long, "name", "value", [0.5, 0.9]).collect()}
    assert got["a"] == [1.0, 1.0] and got["b"] == pytest.approx([1.5, 1.9])


def test_global_row_number_with_hot_value(skewed):
    df, pdf = skewed
    got = windows.global_row_number(df, ["v", "id"], "rn").select("id", "rn").toPandas().set_index("id")["rn"]
    want = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    assert (got.loc[want["id"]].to_numpy() == np.arange(1, len(want) + 1)).all()


@pytest.mark.parametrize("n", [1, 2, 3, 99, 100, 101, 257, 1000])
def test_percentile_bin_is_quantile_cut(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 7).alias("x"))
    got = windows.percentile_bin(df, "x", ["id"], "b").orderBy("x", "id").select("b").toPandas()["b"]
    if n == 1:
        assert list(got) == [0]
        return
    ranks = pd.Series(np.arange(1, n + 1))
    exact = [max(-(-((r - 1) * 100) // (n - 1)) - 1, 0) for r in ranks]
    assert list(got) == exact
    # Float edges in pandas move the odd row that sits exactly on a cut.
    off = got.to_numpy() - pd.qcut(ranks, 100, labels=False).to_numpy()
    assert abs(off).max() <= 1 and (off != 0).sum() <= 3


def test_keep_one_on_hot_key(skewed):
    df, pdf = skewed
    got = aggregates.keep_one(df, ["k"], [-F.col("v"), F.col("id")]).toPandas()
    want = pdf.sort_values(["v", "id"], ascending=[False, True]).drop_duplicates("k")
    assert dict(zip(got["k"], got["id"])) == dict(zip(want["k"], want["id"]))


def test_overrides_win_and_absent_rows_append(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    over = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    assert dict(sets.with_overrides(base, over, ["k"]).collect()) == {"a": 1, "b": 9, "c": 3}
    assert dict(sets.append_absent(base, over, ["k"]).collect()) == {"a": 1, "b": 2, "c": 3}


def test_many_to_one_rejects_repeated_right_key(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="repeats its key"):
        joins.many_to_one(left, right, ["k"]).collect()
    assert joins.many_to_one(left, right.limit(1), ["k"]).count() == 2


def test_previous_total_is_previous_year_not_previous_row(spark):
    rows = [("c", 2020, "11", 1), ("c", 2020, "21", 2), ("c", 2022, "11", 5), ("c", 2022, "21", None), ("c", 2023, "11", 7)]
    df = spark.createDataFrame(rows, "county string, year_num int, sector string, firms int")
    df = df.withColumn("total", windows.group_sum("firms", ["county", "year_num"]))
    got = df.withColumn("prev", windows.previous_group_total("total", ["county"])).collect()
    assert {(r["year_num"], r["total"], r["prev"]) for r in got} == {(2020, 3, None), (2022, 5, 3), (2023, 7, 5)}


def test_year_over_year_golden(spark):
    df = spark.createDataFrame([(2022, 47077235294000), (2023, 41678706048000)], "year_num int, r long")
    assert round(windows.year_over_year(df, {"r": "yoy"}).first()["yoy"] * 100, 2) == -11.47


def test_gaps(spark):
    df = spark.createDataFrame([(2020,), (2023,), (2020,), (None,)], "year_num int")
    assert sorted(r[0] for r in sets.gaps(df, "year_num").collect()) == [2021, 2022]
    assert sets.gaps(df.where("year_num > 3000"), "year_num").count() == 0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.99,), (10.0,), (None,)], "v double")
    assert dict(aggregates.histogram(df, "v", 10).collect()) == {0: 1, 1: 1, 9: 2}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert dict(aggregates.histogram(flat, "v", 10).collect()) == {0: 2}


def test_synonyms_first_wins_and_missing_raises(spark):
    df = spark.createDataFrame([("1", "2", "3")], ["Naics", "INDUSTRY_CODE", "year"])
    names = {"ind": ["industry_code", "naics"], "year_num": ["year"]}
    assert columns.rename_synonyms(df, names).columns == ["Naics", "ind", "year_num"]
    with pytest.raises(ValueError, match="qtr"):
        columns.rename_synonyms(df, names | {"qtr": ["qtr"]})


def test_duplicate_headers_keep_first(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"]).toDF("a", "b", "a")
    assert columns.drop_duplicate_headers(df).first().asDict() == {"a": 1, "b": 2}


def test_gates(spark):
    df = spark.createDataFrame([(1, -1.0), (1, 2.0)], "k int, v double")
    with pytest.raises(ValueError, match="1 rows repeat"):
        quality.fail_on_duplicates(df, ["k"], "t")
    with pytest.raises(Exception, match="negative value"):
        quality.require_non_negative(df, ["v"], "t").collect()
    assert quality.require_non_negative(df, ["k"], "t").count() == 2
    quality.fail_on_duplicates(df, ["k", "v"], "t")


def test_total_ownership_or_private(spark):
    from regionledger.operators import filters

    both = spark.createDataFrame([("0",), ("5",)], "own_code string")
    assert [r[0] for r in filters.total_ownership_or_private(both).collect()] == ["0"]
    assert [r[0] for r in filters.total_ownership_or_private(both.where("own_code = '5'")).collect()] == ["5"]
