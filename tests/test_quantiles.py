import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.operators.quantiles import linear_position, medians, order_statistics, quantiles, top_share

PROBS = [0.0, 0.02, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """200 000 rows; one key holds a third of them, values are heavy-tailed with ties."""
    x = F.col("id")
    return spark.range(200_000).select(
        F.when(x % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (x % 5).cast("string"))).alias("k"),
        F.when(x % 11 == 0, F.lit(None)).when(x % 7 == 0, 5.0)
        .otherwise(F.exp((F.hash("id") % 1000) / 100.0)).alias("v"),
        (F.hash("id") % 100).cast("int").alias("w"),
    ).persist()


@pytest.mark.parametrize("bracket", [True, False])
def test_grouped_quantiles_equal_numpy(skewed, bracket):
    got = {r["k"]: r for r in quantiles(skewed, ["v", "w"], PROBS, ["k"], bracket=bracket).collect()}
    pdf = skewed.toPandas()
    assert set(got) == set(pdf["k"])
    for key, part in pdf.groupby("k"):
        for c in ("v", "w"):
            want = np.quantile(part[c].dropna(), PROBS)
            np.testing.assert_allclose(got[key][c], want, rtol=1e-12)


@pytest.mark.parametrize("bracket", [True, False])
def test_whole_table_quantiles_equal_numpy(skewed, bracket):
    got = quantiles(skewed, ["v"], PROBS, bracket=bracket).first()["v"]
    np.testing.assert_allclose(got, np.quantile(skewed.toPandas()["v"].dropna(), PROBS), rtol=1e-12)


def test_every_group_can_use_brackets(skewed):
    """With no small-group shortcut, groups of tens of thousands still come out exact."""
    targets = [(0.5, lambda n: (n - 1) * 0.5), (0.75, lambda n: (n - 1) * 0.75)]
    got = {r["k"]: r["v"] for r in order_statistics(skewed, ["v"], targets, ["k"], bracket=True, small_group=20_000).collect()}
    for key, part in skewed.toPandas().groupby("k"):
        np.testing.assert_allclose(got[key], np.quantile(part["v"].dropna(), [0.5, 0.75]), rtol=1e-12)


def test_null_keys_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), (None, 9.0)], "k string, v double")
    for bracket in (True, False):
        got = {r["k"]: r["v"] for r in medians(df, ["v"], ["k"], bracket=bracket).collect()}
        assert got == {"a": 2.0, "b": None}


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, v double")
    for bracket in (True, False):
        assert medians(df, ["v"], bracket=bracket).first()["v"] is None
        assert medians(df, ["v"], ["k"], bracket=bracket).count() == 0


def test_extra_aggregates_ride_along(skewed):
    for bracket in (True, False):
        got = medians(skewed, ["v"], ["k"], bracket=bracket, n=F.count("*")).collect()
        assert sum(r["n"] for r in got) == 200_000
        one = medians(skewed, ["v"], bracket=bracket, n=F.count("*")).first()
        assert one["n"] == 200_000


def test_missed_bracket_is_widened(spark):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("v"))
    found = order_statistics(df, ["v"], [(0.2, lambda n: n * 0.8)], bracket=True)
    assert found.first()["v"] == [80_000.0]


@pytest.mark.parametrize("by", [[], ["k"]])
def test_no_task_ranks_more_than_a_fixed_number_of_rows(skewed, monkeypatch, by):
    from fieldbook.operators import quantiles as q
    from fieldbook.operators import running

    monkeypatch.setattr(q, "RANK_ROWS", 100)
    seen = []
    chunked = running.with_chunks
    monkeypatch.setattr(running, "with_chunks", lambda *a: seen.append(chunked(*a)) or seen[-1])
    targets = [(p, linear_position(p)) for p in (0.1, 0.5, 0.99)]
    got = {tuple(r[c] for c in by): r["v"] for r in order_statistics(skewed, ["v"], targets, by, accuracy=100, bracket=True, small_group=10_000).collect()}
    assert seen and max(f.groupBy("_chunk").count().agg(F.max("count")).first()[0] for f in seen) < 400
    pdf = skewed.toPandas().dropna(subset=["v"])
    for key, part in pdf.groupby(by[0]) if by else [((), pdf)]:
        assert got[(key,) if by else ()] == pytest.approx(np.quantile(part["v"], [0.1, 0.5, 0.99]).tolist(), rel=1e-12)


def test_top_share_counts_ties_once(spark):
    df = spark.createDataFrame([(float(v),) for v in [10, 10, 10, 1, 1, 1, 1, 1, 1, 1]], "v double")
    for bracket in (True, False):
        row = top_share(df, "v", 0.2, bracket=bracket).first()
        assert (row["k"], row["top_sum"], row["total"]) == (2, 20.0, 37.0)


def test_top_share_of_large_table(spark):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("v"))
    row = top_share(df, "v", 0.1, bracket=True).first()
    assert row["k"] == 10_000
    assert row["top_sum"] == float(sum(range(90_000, 100_000)))


def test_many_large_groups_are_joined_with_salts(skewed, monkeypatch):
    """Too large a group table for a broadcast is salted for hot keys, and gives the same rows."""
    from fieldbook import session

    groups = skewed.groupBy("k").agg(F.count("*").alias("n"))
    plain = session.attach_groups(skewed, groups, ["k"])
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    salted = session.attach_groups(skewed, groups, ["k"])
    assert "_salt" in salted._jdf.queryExecution().toString() and salted.columns == plain.columns
    total = lambda df: df.agg(F.count("*"), F.sum("n"), F.sum("v")).first()
    assert total(salted) == pytest.approx(total(plain))
    targets = [(0.5, lambda n: (n - 1) * 0.5)]
    for r in order_statistics(skewed, ["v"], targets, ["k"], bracket=True, small_group=20_000).collect():
        part = skewed.filter(F.col("k") == r["k"]).toPandas()["v"].dropna()
        assert r["v"][0] == pytest.approx(np.median(part), rel=1e-12)
