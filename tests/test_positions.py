import datetime
import random

import pytest
from pyspark.sql import functions as F

from fieldbook.operators import positions
from fieldbook.operators.positions import concat_by_position, cut_at, first_rows, number_rows
from fieldbook.operators.shaping import row_at, sample_rows


@pytest.fixture
def tight(monkeypatch):
    monkeypatch.setattr(positions, "FEW_ROWS", 5)
    monkeypatch.setattr(positions, "SMALL", 40)
    monkeypatch.setattr(positions, "SAMPLE", 64)


@pytest.fixture(scope="module")
def frame(spark):
    draw = random.Random(2)
    rows = [
        (
            2**60 + draw.randrange(50) if draw.random() < 0.9 else None, draw.choice(["", "a", "ab", "é", "b", None]), draw.choice([0.5, float("nan"), None, -1.0, float("inf")]),
            datetime.date(2020, 1, 1 + draw.randrange(28)), i,
        )
        for i in range(1500)
    ]
    return spark.createDataFrame(rows, "k long, t string, x double, d date, i long").repartition(5)


ORDERS = [["k"], [("k", True), "t"], ["t", ("x", True)], [("d", True), "x", "i"], ["x"], [("t", True)], ["i"], [("i", True)]]


@pytest.mark.parametrize("order", ORDERS, ids=str)
@pytest.mark.parametrize("n", [1, 44, 750, 1499, 1500, 1501])
def test_first_rows_are_those_of_a_sort(tight, frame, order, n):
    names = [name for name, _ in positions.pairs(order)]
    want = frame.orderBy(*positions.sort_columns(order)).limit(n).groupBy(*names).count()
    got = first_rows(frame, order, n)
    assert sorted(map(str, got.groupBy(*names).count().collect())) == sorted(map(str, want.collect()))
    assert got.select("i").distinct().count() == min(n, 1500)  # whole rows, none twice


def test_cut_counts_the_rows_before_it(tight, frame):
    key, before = cut_at(frame, ["k"], 700)
    assert before == frame.where(F.col("k").isNull() | (F.col("k") < key["k"])).count()
    assert before < 700 <= before + frame.where(F.col("k") == key["k"]).count()
    assert cut_at(frame, ["k"], 0) is None and cut_at(frame, ["k"], 1501) is None


def test_keys_beyond_doubles_and_one_key_with_a_third_of_the_rows(tight, spark):
    rows = spark.range(3000, numPartitions=6).select((F.lit(2**53) + F.when(F.col("id") % 3 == 0, 1000).otherwise(F.col("id"))).alias("k"), "id")
    for n in (500, 1001, 1700):
        got = sorted(r["k"] for r in first_rows(rows, ["k"], n).collect())
        assert got == sorted(r["k"] for r in rows.collect())[:n]
    assert row_at(rows, 1, "k").first()["k"] == 2**53 + 2


def test_a_large_sample_is_not_sorted_in_one_task(tight, frame):
    got = sample_rows(frame, 300, "i")
    want = frame.orderBy(F.md5(F.concat(F.col("i").cast("string"), F.lit(":42"))), "i").limit(300)
    assert {r["i"] for r in got.collect()} == {r["i"] for r in want.collect()}
    assert "SinglePartition" not in got._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_numbers_and_frames_of_unequal_length(spark):
    left = spark.range(1000, numPartitions=7).select(F.col("id").alias("a"), (F.col("id") * 7 % 1000).alias("b"))
    numbered = number_rows(left, "n", ["b"], chunks=4)
    assert all(r["n"] == r["b"] for r in numbered.collect())
    assert sorted(r["position"] for r in number_rows(left).collect()) == list(range(1000))
    right = spark.range(300, numPartitions=2).select((F.col("id") * 2).alias("A"), F.col("id").alias("position"))
    both = concat_by_position(left, right, ["a"], [("A", True)])
    rows = {r["position"]: r for r in both.collect()}
    assert both.columns == ["position", "a", "b", "A_right", "position_right"] and len(rows) == 1000
    assert all(r["a"] == p and r["A_right"] == (2 * (299 - p) if p < 300 else None) for p, r in rows.items())
    assert concat_by_position(left, right, ["a"], ["A"], "inner").count() == 300
    assert concat_by_position(left.limit(0), right, ["a"], ["A"]).count() == 300
    assert "SinglePartition" not in both._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
