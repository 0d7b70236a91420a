import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from fieldbook.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, vector string, row string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def plain(rows, chosen, positives=5, negatives=3, share=(50, 95)):
    """The definition, row by row."""
    kept = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, label, [float(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for a in sorted({r[0] for r in kept if chosen(r[0])}):
        _, label, q = min(r for r in kept if r[0] == a)
        scores = {(i, lab, int(sum(x * y for x, y in zip(v, q)))) for i, lab, v in kept if i != a}
        same = sorted({(-s, i) for i, lab, s in scores if lab == label})[:positives]
        for minus, p in same:
            s = -minus
            fits = sorted({(-x, i) for i, lab, x in scores if lab != label and share[0] * s <= 100 * x <= share[1] * s})[:negatives]
            out += [(a, p, k + 1, i, s, -x) for k, (x, i) in enumerate(fits)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = contract.queries()["op13_hard_negatives"](spark, sf)
    assert found(got) == sorted(con.sql(contract.oracle_sql()["op13_hard_negatives"]).fetchall()) and got.count() > 20


@pytest.mark.parametrize("wave_bytes", [1, 8 * 6 * 7, 1 << 20])
def test_waves_and_blocks_of_any_size_equal_the_definition(spark, monkeypatch, wave_bytes):
    monkeypatch.setattr(negatives, "BLOCK", 17)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0.2, 0.2, 6)], int(rng.integers(0, 4))) for i in range(240)]
    rows += [(1000 + i, [0.25, 0.5, -0.25, 0.5, 0.0, 0.0], i % 3) for i in range(60)]  # ties
    got = negatives.hard_negatives(frame(spark, rows).repartition(5), F.col("vec_id") % 20 == 0, wave_bytes=wave_bytes)
    want = plain(rows, lambda i: i % 20 == 0)
    assert found(got) == want and len(want) > 100


def test_a_large_group_of_copies_and_one_label(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0.3, 0.1, 4)], 1) for i in range(100)]
    rows += [(100 + i, [0.5, 0.5, 0.25, 0.25], 1 + (i % 50 == 0)) for i in range(400)]
    got = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0)
    assert found(got) == plain(rows, lambda i: i % 50 == 0)
    alone = [r for r in rows if r[2] == 1]
    assert negatives.hard_negatives(frame(spark, alone), F.col("vec_id") % 50 == 0).count() == 0


def test_odd_rows_and_empty_tables(spark):
    inf, nan = float("inf"), float("nan")
    base = [(i, [0.01 * i, 0.5, 0.2 + 0.01 * (i % 7)], i % 3) for i in range(40)]
    odd = [
        (None, [0.1, 0.2, 0.3], 1), (50, None, 1), (51, [0.1, 0.2, 0.3], None), (52, [inf, 0.0, 0.1], 1), (53, [0.1, nan, 0.0], 1), (54, [0.1, None, 0.0], 1), (55, [], 1), (56, [0.5], 2),
        (57, [0.4, 0.5, 0.3, 0.2], 2), base[0], base[0], base[3], (10, [0.9, 0.4, 0.1], 2), (10, [0.9, 0.4, 0.1], 0), (60, [1e30, -1.0, 0.0], 1), (61, [-0.5, -0.5, -0.5], 0),
    ]
    odd = [r for r in odd if r[0] != 60]
    got = negatives.hard_negatives(frame(spark, base + odd), F.col("vec_id") % 10 == 0)
    assert found(got) == plain(base + odd, lambda i: i % 10 == 0)
    huge = negatives.hard_negatives(frame(spark, [*base, (60, [1e30, -1.0, 0.0], 1)]), F.col("vec_id") % 10 == 0)
    assert huge.count() > 0  # beyond 2^53 scores are rounded, and nothing fails
    assert negatives.hard_negatives(frame(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(frame(spark, base), F.lit(False)).count() == 0


def test_scan_reads_by_magnitude_and_prunes():
    rng = np.random.default_rng(6)
    vectors = np.floor(256 * rng.normal(0, 0.1, (2000, 32)))
    block = negatives.Block(np.arange(2000), np.zeros(2000, int), vectors)
    query = vectors[7] * np.where(np.arange(32) < 4, 10, 0.1).round(1)
    query = np.floor(query)
    left = []

    def keep(least, most):
        exact = np.sort(vectors @ query)[-5]
        left.append(int((most >= exact).sum()))
        return most >= exact

    place, score = negatives.vertical_scan(block, query, slice(None), keep)
    assert sorted(score) == sorted((vectors @ query)[vectors @ query >= np.sort(vectors @ query)[-5]])
    assert left[0] < 200 and left[-1] == len(place)  # the four large dimensions are read first
