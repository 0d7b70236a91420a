import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldbook.operators import imputing, running


@pytest.fixture(scope="module")
def rows(spark):
    """5 000 rows; one key holds a third, nulls come in long runs."""
    x = F.col("id")
    return spark.range(5000).select(
        "id", F.when(x % 3 == 0, 0).otherwise(x % 10).alias("k"),
        F.when((x / 100).cast("int") % 3 != 0, (x % 17).cast("double")).alias("v"), ((x % 9) + 1).cast("double").alias("amount"),
    ).persist()


@pytest.mark.parametrize("chunks", [1, 7, 64])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_carry_forward_equals_ffill(rows, chunks, by):
    got = running.carry_forward(rows, "v", ["id"], by, chunks=chunks).orderBy("id").toPandas()["carried"]
    pdf = rows.toPandas().sort_values("id")
    want = pdf.groupby("k")["v"].ffill() if by else pdf["v"].ffill()
    pd.testing.assert_series_equal(got, want.reset_index(drop=True), check_names=False)


@pytest.mark.parametrize("chunks", [1, 7, 64])
def test_running_totals_equal_cumsum(rows, chunks):
    got = running.running_totals(rows, "amount", ["id"], ["k"], chunks=chunks).orderBy("id").toPandas()
    pdf = rows.toPandas().sort_values("id")
    assert (got["running_sum"].to_numpy() == pdf.groupby("k")["amount"].cumsum().to_numpy()).all()
    assert (got["running_n"].to_numpy() == pdf.groupby("k").cumcount().to_numpy() + 1).all()


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, None), (3, "a", None)], "id int, k string, v double")
    got = running.carry_forward(df, "v", ["id"], ["k"], chunks=2).orderBy("id").collect()
    assert [r["carried"] for r in got] == [1.0, 1.0, None]


@pytest.mark.parametrize("chunks", [1, 7, 64])
@pytest.mark.parametrize("kind", ["null", "text", "date"])
def test_order_columns_of_any_type_with_nulls(spark, chunks, kind):
    """Null order values come first, in one chunk as in many; text and dates can be cut."""
    n = F.col("id")
    at = {"null": n, "text": F.concat(F.lit("t"), F.lpad(n.cast("string"), 5, "0")), "date": F.date_add(F.lit("2020-01-01"), n.cast("int"))}[kind]
    df = spark.range(600).select("id", F.when(n % 50 != 0, at).alias("t"), (n % 3).alias("k"), F.when(n % 4 != 0, n.cast("double")).alias("v"))
    pdf = df.toPandas().assign(known=lambda x: x["t"].notna()).sort_values(["known", "id"]).reset_index(drop=True)
    order = lambda out: out.orderBy(F.col("t").isNotNull(), "id").toPandas()
    totals = order(running.running_totals(df, "v", ["t", "id"], ["k"], chunks))
    assert totals["running_n"].tolist() == (pdf.groupby("k").cumcount() + 1).tolist()
    assert totals["running_sum"].tolist() == pdf["v"].fillna(0).groupby(pdf["k"]).cumsum().tolist()
    carried = order(running.carry_forward(df, "v", ["t", "id"], (), chunks))["carried"]
    pd.testing.assert_series_equal(carried, pdf["v"].ffill(), check_names=False)


LEDGER = [
    ("a", 1, 9000.0), ("a", 2, 9000.0), ("a", 3, 9000.0), ("a", 4, 1.0),  # total breaks first
    ("b", 1, 1.0), ("b", 2, 1.0), ("b", 3, 1.0), ("b", 4, 1.0), ("b", 5, 1.0),  # count breaks first
    ("c", 1, 20000.0),  # exactly at the limit
]


@pytest.mark.parametrize("chunks", [1, 3])
def test_limit_ledger(spark, chunks):
    df = spark.createDataFrame(LEDGER, "account string, seq int, amount double")
    out = running.limit_ledger(df, "account", "amount", ["seq"], 3, 20_000.0, chunks).orderBy("account", "seq").collect()
    assert [r["reason"] for r in out] == [
        "accepted", "accepted", "total limit passed", "session ended",
        "accepted", "accepted", "accepted", "count limit passed", "session ended", "accepted",
    ]
    kept = pd.DataFrame([r.asDict() for r in out if r["accepted"]]).groupby("account")["amount"].agg(["count", "sum"])
    assert (kept["count"] <= 3).all() and (kept["sum"] <= 20_000).all()


def test_tied_order_values_are_cut_again(spark):
    """Two thirds of the rows share one order value."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(1500).alias("t"), "id", (F.col("id") % 7).cast("double").alias("v")
    )
    chunked = running.with_chunks(df, ["t", "id"], 20)
    assert chunked.groupBy("_chunk").count().agg(F.max("count")).first()[0] < 300
    got = running.running_totals(df, "v", ["t", "id"], chunks=20).orderBy("t", "id").toPandas()
    want = df.toPandas().sort_values(["t", "id"])["v"].cumsum()
    assert (got["running_sum"].to_numpy() == want.to_numpy()).all()


@pytest.mark.parametrize("chunks", [1, 3])
def test_rows_without_account_share_one(spark, chunks):
    df = spark.createDataFrame([(None, i, 1.0) for i in range(6)], "account string, seq int, amount double")
    out = running.limit_ledger(df, "account", "amount", ["seq"], 3, 20_000.0, chunks).orderBy("seq").collect()
    assert [r["accepted"] for r in out] == [1, 1, 1, 0, 0, 0]


@pytest.mark.parametrize("chunks", [1, 9])
def test_several_columns_are_carried_with_one_range_shuffle(rows, chunks):
    both = rows.withColumn("w", F.when(F.col("id") % 13 == 0, F.col("id").cast("string")))
    found = running.carry_all_forward(both, ["v", "w"], ["id"], ["k"], chunks)
    got, pdf = found.orderBy("id").toPandas(), both.toPandas().sort_values("id")
    for i, c in enumerate("vw"):
        want = pdf.groupby("k")[c].ffill().reset_index(drop=True)
        pd.testing.assert_series_equal(got[f"carried_{i}"], want, check_names=False, check_dtype=False)
    assert imputing.fill_previous(both, ["v", "w"], "id").columns == both.columns


def test_carrying_without_keys_takes_small_chunks(spark, tmp_path, monkeypatch):
    pdf = pd.DataFrame({"k": range(3000), "v": [float(i) if i % 7 == 3 else None for i in range(3000)]})
    spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 == 3, F.col("id").cast("double")).alias("v")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    made, chunked = [], running.with_chunks
    monkeypatch.setattr(running, "with_chunks", lambda rows, order, chunks: made.append(chunks) or chunked(rows, order, chunks))
    monkeypatch.setattr(running, "LONE_CHUNK_BYTES", 4_000)
    got = running.carry_all_forward(df, ["v"], ["k"]).toPandas().sort_values("k")["carried_0"]
    pd.testing.assert_series_equal(got.reset_index(drop=True), pdf["v"].ffill(), check_names=False)
    assert len(made) == 1 and made[0] > 2
