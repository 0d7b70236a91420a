import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldbook.operators import binning, cleaning, imputing, shaping


def test_tidy_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Blood  Type ", "Return %", "PRICE"])
    assert cleaning.tidy_columns(df).columns == ["blood_type", "return_", "price"]


def test_tidy_names_refuse_collisions(spark):
    with pytest.raises(ValueError, match="collide"):
        cleaning.tidy_columns(spark.createDataFrame([(1, 2)], ["a b", "A_B"]))


def test_drop_listed_matches_tidy_names_unless_raw(spark):
    df = spark.createDataFrame([(1, 2)], ["Name", "Age"])
    assert cleaning.drop_listed(df, ["name"]).columns == ["Age"]
    assert cleaning.drop_listed(df, ["name"], raw_names=True).columns == ["Name", "Age"]


def test_strip_and_title(spark):
    df = spark.createDataFrame([(" o'neil-smith llc. \n", 1)], ["s", "n"])
    assert cleaning.strip_text(df, title=True).first()["s"] == "O'Neil-Smith Llc."


def test_date_promotion_needs_enough_rows(spark):
    rows = [("2024-01-02", "x", "2024-01-02")] * 3 + [("bad", "y", "2024-01-03")]
    df = spark.createDataFrame(rows, ["order_date", "update_dt", "code"])
    out = cleaning.promote_dates(df, ["yyyy-MM-dd"], ["date", "dt"], 0.5)
    types = dict(out.dtypes)
    assert types == {"order_date": "timestamp", "update_dt": "string", "code": "string"}
    assert out.filter(F.col("order_date").isNull()).count() == 1
    assert dict(cleaning.promote_dates(df, ["yyyy-MM-dd"], ["date", "dt"], 0.8).dtypes)["order_date"] == "string"
    listed = cleaning.promote_dates(df, ["yyyy-MM-dd"], [], 0.5, listed=["code"])
    assert dict(listed.dtypes)["code"] == "timestamp"


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (5.0,), (50.0,)], "v double")
    got = [r[0] for r in df.select(cleaning.clip(F.col("v"), 10.0, 20.0)).collect()]
    assert got == [None, 10.0, 20.0]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert cleaning.nan_to_null(df).filter("v is null").count() == 1


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert cleaning.drop_null_columns(df).columns == ["a"]


def test_imputation(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "b", None), (2, None, None, dt.datetime(2024, 1, 1)), (3, 4.0, "a", None), (4, 9.0, "b", None), (5, None, "a", dt.datetime(2024, 1, 2))],
        "id int, v double, s string, t timestamp",
    )
    assert [r["v"] for r in imputing.fill_median(df, ["v"]).orderBy("id").collect()] == [1.0, 4.0, 4.0, 9.0, 4.0]
    assert imputing.fill_mode(df, ["s"]).filter("id = 2").first()["s"] == "a"  # tie: smallest
    t = [r["t"] for r in imputing.fill_previous(df, ["t"], "id").orderBy("id").collect()]
    assert t[0] is None and t[1] == t[2] == t[3] == dt.datetime(2024, 1, 1)
    mean = [r["v"] for r in imputing.fill_mean(df, ["v"]).orderBy("id").collect()]
    assert mean[1] == pytest.approx(14 / 3)


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(0,), (1,), (18,), (19,), (65,), (120,), (121,), (None,)], "a int")
    labels = ("<18", "18-35", "36-50", "51-65", "65+")
    got = [r[0] for r in df.select(binning.cut(F.col("a"), (0, 18, 35, 50, 65, 120), labels)).collect()]
    assert got == [None, "<18", "<18", "18-35", "51-65", "65+", None, None]


def test_quantile_cut_and_collapsed_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 9)], "v double")
    tiers = binning.quantile_cut(df, "v", ["q1", "q2", "q3", "q4"], "t").groupBy("t").count().collect()
    assert {r["t"]: r["count"] for r in tiers} == {"q1": 2, "q2": 2, "q3": 2, "q4": 2}
    flat = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (2.0,)], "v double")
    with pytest.raises(ValueError, match="collapse"):
        binning.quantile_cut(flat, "v", ["a", "b", "c", "d"], "t")


def test_outlier_flags_only_where_needed(spark):
    df = spark.createDataFrame([(float(i), 1.0) for i in range(10)] + [(1000.0, 1.0), (None, 1.0)], "v double, c double")
    out = binning.flag_outliers(df, ["v", "c", "absent"])
    assert out.columns == ["v", "c", "v_is_outlier"]
    assert out.filter("v_is_outlier = 1").count() == 1
    assert {r["column"]: r["outliers"] for r in binning.outlier_totals(out).collect()} == {"v": 1}


def test_log_columns_need_positive_minimum(spark):
    df = spark.createDataFrame([(1.0, 0.0, -1.0)], "a double, b double, c double")
    assert binning.log_columns(df).columns == ["a", "b", "c", "log_a"]


def test_union_of_filters_keeps_copies(spark):
    df = spark.createDataFrame([(1,), (5,), (9,)], "v int")
    out = shaping.union_of_filters(df, {"small": F.col("v") < 6, "odd": F.col("v") % 2 == 1})
    assert sorted((r["v"], r["matched"]) for r in out.collect()) == [(1, "odd"), (1, "small"), (5, "odd"), (5, "small"), (9, "odd")]


def test_row_at_position(spark):
    df = spark.range(0, 1000, 3).withColumnRenamed("id", "k")
    assert shaping.row_at(df, 10, "k").first()["k"] == 30
    assert shaping.row_at(df, 10_000, "k").count() == 0
    tied = spark.range(50).selectExpr("id DIV 20 AS k", "49 - id AS t")
    got = [shaping.row_at(tied, i, "k", ["t"]).first() for i in (0, 19, 20, 49)]
    assert [(r["k"], r["t"]) for r in got] == [(0, 30), (0, 49), (1, 10), (2, 9)]


def test_null_map_buckets(spark):
    df = spark.createDataFrame([(i, None if i < 5 else 1) for i in range(10)], "k int, v int")
    got = {r["bucket"]: r["nulls"] for r in cleaning.null_map(df, "k", 2, ["v"]).collect()}
    assert got == {0: 5, 1: 0}
