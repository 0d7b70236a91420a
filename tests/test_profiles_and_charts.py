import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldbook.operators import charts, grouping, inference, profile


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"k": rng.choice(list("abc"), 500), "v": rng.gamma(2, 3, 500), "w": rng.integers(0, 9, 500)})
    pdf.loc[::9, "v"] = np.nan
    return pdf, spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))


def test_describe_equals_pandas(frame):
    pdf, df = frame
    got = {r["column"]: r for r in profile.describe(df).collect()}
    d = pdf[["v", "w"]].describe(percentiles=[0.1, 0.25, 0.5, 0.75, 0.9])
    for c in ("v", "w"):
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("p10", "10%"), ("p50", "50%"), ("p90", "90%"), ("max", "max")):
            assert got[c][mine] == pytest.approx(d[c][theirs])
        assert got[c]["skewness"] == pytest.approx(pdf[c].skew())
        assert got[c]["kurtosis"] == pytest.approx(pdf[c].kurtosis())


def test_moments_of_tiny_groups_are_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    row = profile.describe(df).first()
    assert row["skewness"] is None and row["kurtosis"] is None


def test_describe_of_empty_table(spark):
    row = profile.describe(spark.createDataFrame([], "v double")).first()
    assert row["count"] == 0 and row["mean"] is None and row["p50"] is None


def test_histogram_counts_everything(frame):
    pdf, df = frame
    got = charts.histogram(df, "v", 12).orderBy("bin").toPandas()
    want, edges = np.histogram(pdf["v"].dropna(), 12)
    assert got["count"].tolist() == want.tolist()
    assert got["low"].to_numpy() == pytest.approx(edges[:-1])
    width = edges[1] - edges[0]
    assert (got["density"] * width).sum() == pytest.approx(1.0)


def test_histogram_of_constant_column(spark):
    got = charts.histogram(spark.createDataFrame([(3.0,)] * 5, "v double"), "v", 4).toPandas()
    assert got["count"].sum() == 5 and len(got) == 4


def test_density_integrates_to_one_and_equals_the_sum(frame):
    pdf, df = frame
    got = charts.density_curve(df, "v", points=400).orderBy("point").toPandas()
    v = pdf["v"].dropna().to_numpy()
    h = v.std(ddof=1) * len(v) ** -0.2
    want = np.exp(-0.5 * ((got["x"].to_numpy()[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * math.sqrt(2 * math.pi))
    assert got["density"].to_numpy() == pytest.approx(want, rel=1e-9, abs=1e-300)
    assert (got["density"] * (got["x"][1] - got["x"][0])).sum() == pytest.approx(1.0, abs=1e-3)


def test_box_flags_rows_outside_fences(frame):
    pdf, df = frame
    for r in charts.box_statistics(df, "v", "k").collect():
        v = pdf.loc[pdf["k"] == r["k"], "v"].dropna()
        q1, q3 = v.quantile(0.25), v.quantile(0.75)
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        assert (r["whisker_low"], r["whisker_high"], r["outliers"]) == (inside.min(), inside.max(), len(v) - len(inside))


def test_shares_and_crosstabs_add_up(frame):
    _, df = frame
    assert grouping.value_counts(df, "k").agg(F.sum("pct")).first()[0] == pytest.approx(100)
    values = [r["w"] for r in df.select("w").dropna().distinct().collect()]
    assert grouping.crosstab(df, "k", "w").agg(F.sum("n")).first()[0] == 500
    table = grouping.crosstab(df, "k", "w", values).toPandas().set_index("k")
    assert table.to_numpy().sum() == 500
    percent = grouping.crosstab_percent(df, "k", "w", values).toPandas().set_index("k")
    assert percent.sum(axis=1).to_numpy() == pytest.approx([100, 100, 100])


def test_month_gaps_are_filled(spark):
    df = spark.createDataFrame([("2024-01-05", 1.0), ("2024-01-31", 3.0), ("2024-04-01", 5.0), (None, 9.0)], "d string, v double")
    out = charts.month_ends(df.withColumn("d", F.to_timestamp("d")), "d", n=F.count("*"), mean=F.avg("v")).orderBy("month_end").collect()
    assert [(str(r["month_end"]), r["n"], r["mean"]) for r in out] == [
        ("2024-01-31", 2, 2.0), ("2024-02-29", 0, None), ("2024-03-31", 0, None), ("2024-04-30", 1, 5.0)
    ]


def test_extremes_take_first_key_on_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0), ("d", 0)], "k string, m int")
    assert tuple(grouping.extremes(df, "k", "m").first()) == ("a", 1, "c", 0)


def test_constant_columns_have_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.5, 5.0)], "a double, b double, c double")
    assert [(r["x"], r["y"]) for r in profile.top_correlations(df).collect()] == [("a", "b")]


def test_categorical_summary(spark):
    df = spark.createDataFrame([("x", None), ("x", "p"), ("y", "q")], "a string, b string")
    got = {r["column"]: r for r in profile.categorical_summary(df).collect()}
    assert (got["a"]["unique_count"], got["a"]["top_value"], got["a"]["top_pct"]) == (2, "x", 66.67)
    assert got["b"]["value_counts"] == {"p": 1, "q": 1} and got["b"]["top_value"] == "p"


def test_densities_of_very_many_groups(spark):
    rows = spark.range(300_000, numPartitions=8).select((F.col("id") % 100_000).alias("g"), F.sqrt(F.col("id").cast("double")).alias("v"))
    got = charts.density_curve(rows, "v", "g", points=4)
    one = got.where("g = 77").orderBy("point").toPandas()
    v = np.sqrt([77.0, 100_077.0, 200_077.0])
    h = v.std(ddof=1) * 3**-0.2
    want = [np.exp(-0.5 * ((x - v) / h) ** 2).sum() / (3 * h * math.sqrt(2 * math.pi)) for x in one["x"]]
    assert one["density"].to_numpy() == pytest.approx(want, rel=1e-9)
    assert got.count() == 400_000


def test_wide_correlations_equal_those_of_few_columns(spark, monkeypatch):
    rng = np.random.default_rng(3)
    values = rng.normal(1e6, 1, (300, 20)) + rng.normal(0, 1, (300, 1))
    values[:, 5], values[:, 6] = 3.3, values[:, 7] * -2
    rows = [[None if rng.random() < 0.1 else float(x) for x in row] for row in values]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(20))).repartition(3)
    monkeypatch.setattr(profile, "BLOCK_COLUMNS", 8)
    wide = {(r["x"], r["y"]): r["r"] for r in profile.correlations(df).collect()}
    monkeypatch.setattr(profile, "FEW_COLUMNS", 100)
    few = {(r["x"], r["y"]): r["r"] for r in profile.correlations(df).collect()}
    assert wide.keys() == few.keys() and len(wide) == 190
    assert all(wide[k] is None if "c5" in k else wide[k] == pytest.approx(few[k], abs=1e-6) for k in few)


def test_correlations_of_five_hundred_columns(spark):
    rng = np.random.default_rng(4)
    values = rng.normal(0, 1, (60, 500))
    values[rng.random(values.shape) < 0.05] = np.nan
    df = spark.createDataFrame(pd.DataFrame(values, columns=[f"c{i}" for i in range(500)])).replace(float("nan"), None)
    got = {(r["x"], r["y"]): r["r"] for r in profile.correlations(df).collect()}
    want = pd.DataFrame(values).corr()
    assert len(got) == 500 * 499 // 2
    assert all(got[f"c{i}", f"c{j}"] == pytest.approx(want.iloc[i, j], abs=1e-9) for i, j in [(0, 1), (3, 499), (250, 251), (100, 400)])


def test_distinct_counts_of_all_types_without_expanding_rows(spark):
    rows = [(i % 7, i, -i * 10**12, float(i % 5) if i % 9 else None, i % 2 == 0, "x" * (i % 4), 0.0 if i % 2 else -0.0) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b long, c long, d double, e boolean, f string, z double").withColumn("day", F.expr("date'2020-01-01' + a")).withColumn("n", F.lit(None).cast("int"))
    df = df.withColumn("l", F.array("f"))
    got = {r["column"]: r["n_unique"] for r in profile.schema_profile(df).collect()}
    want = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    assert got == want
    assert "Expand" not in profile.schema_profile(df)._jdf.queryExecution().toString()
    by = {(r["a"], r["column"]): r["n_unique"] for r in profile.distinct_counts(df, ["f", "b"], ["a"]).collect()}
    assert by[3, "f"] == 4 and by[3, "b"] == df.where("a = 3").count()


def test_moments_of_many_columns_go_a_few_to_an_aggregate(spark):
    df = spark.range(50).select(*[(F.pow(F.col("id"), F.lit(1 + i / 3)) if i else F.lit(None).cast("double")).alias(f"c{i}") for i in range(7)])
    pdf = df.toPandas()
    for made in (profile.describe(df), inference.normality(df, df.columns)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert max(line.count("kurtosis(") for line in plan.splitlines()) <= profile.MOMENT_COLUMNS
    got = {r["column"]: r for r in profile.describe(df).collect()}
    assert list(got) == df.columns and got["c0"]["count"] == 0
    for c in df.columns[1:]:
        want = (pdf[c].mean(), pdf[c].std(), pdf[c].median(), pdf[c].skew(), pdf[c].kurt())
        assert tuple(got[c][k] for k in ("mean", "std", "p50", "skewness", "kurtosis")) == pytest.approx(want)
