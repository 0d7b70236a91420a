import math

import numpy as np
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from fieldbook.operators import applying
from fieldbook.operators.applying import GroupFunction, apply_columns, apply_groups, apply_rows, apply_whole_groups, map_columns, summed

#: The values seen, and the most rows ever added at once.
SEEN = GroupFunction(
    lambda: (np.zeros(0), 0), lambda s, b: (np.union1d(s[0], pc.drop_null(b.column(0)).to_numpy()), max(s[1], b.num_rows)),
    lambda a, b: (np.union1d(a[0], b[0]), max(a[1], b[1])), lambda s: (len(s[0]), float(s[0].max()) if len(s[0]) else None, s[1]),
)


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(None if i % 11 == 0 else f"k{i % 5}", i % 3, None if i % 7 == 0 else float(i % 50)) for i in range(2000)]
    return spark.createDataFrame(rows, "g string, h int, x double").repartition(6)


def plain(frame, keys):
    groups = {}
    for r in frame.collect():
        key = tuple(r[k] for k in keys)
        if None not in key:
            groups.setdefault(key, []).append(r["x"])
    return {k: (len({x for x in v if x is not None}), max((x for x in v if x is not None), default=None)) for k, v in groups.items()}


@pytest.mark.parametrize("steps", [1, 2])
@pytest.mark.parametrize("keys", [["g"], ["g", "h"], ["h"]])
def test_groups_equal_plain_ones(frame, keys, steps):
    got = apply_groups(frame, keys, ["x"], SEEN, "n long, top double, most long", steps).collect()
    assert {tuple(r[k] for k in keys): (r["n"], r["top"]) for r in got} == plain(frame, keys)


def test_a_group_with_nine_tenths_of_the_rows_is_never_gathered(spark):
    rows = spark.range(100_000, numPartitions=8).select(F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("g"), (F.col("id") % 97).cast("double").alias("x"))
    found = apply_groups(rows, ["g"], ["x"], SEEN, "n long, top double, most long", 2)
    hot = found.where("g = 0").first()
    assert (hot["n"], hot["top"]) == (97, 96.0) and hot["most"] <= 100_000 / 8
    assert found.count() == 10_000
    plan = found._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    # Only keys and states are exchanged, never the rows.
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanged) == 2 and "SinglePartition" not in plan


def test_no_keys_empty_tables_and_keys_of_many_types(spark, frame):
    assert apply_groups(frame, [], ["x"], summed(lambda b: b.num_rows), "n long").collect()[0]["n"] == 2000
    assert apply_groups(frame.limit(0), [], ["x"], summed(lambda b: b.num_rows), "n long").count() == 0
    assert apply_groups(frame.limit(0), ["g"], ["x"], SEEN, "n long, top double, most long").count() == 0
    odd = spark.createDataFrame([(0.0, 1), (-0.0, 2), (float("nan"), 3), (float("nan"), 4), (1.5, 5)], "k double, v int").repartition(3)
    got = apply_groups(odd.withColumn("d", F.current_date()), ["k", "d"], ["v"], summed(lambda b: pc.sum(b.column(0)).as_py()), "s long").collect()
    assert sorted(r["s"] for r in got) == [3, 5]  # the two zeros are one key; NaN is none, as null


def test_whole_groups_and_their_limit(frame):
    got = apply_whole_groups(frame, ["h"], ["x"], lambda f: (float(f["x"].median()), len(f)), "median double, n long")
    want = frame.groupBy("h").agg(F.median("x").alias("m"), F.count("*").alias("n"))
    assert {(r["h"], r["median"], r["n"]) for r in got.collect()} == {(r["h"], r["m"], r["n"]) for r in want.collect()}
    with pytest.raises(ValueError, match="666|667"):
        apply_whole_groups(frame, ["h"], ["x"], len, "n long", most_rows=600)


def test_columns_and_rows(spark, frame):
    two = frame.select("x", F.col("h").cast("double").alias("y"))
    total = summed(lambda b: pc.sum(b.column(0)).as_py() or 0.0, 0.0)
    want = two.agg(F.sum("x"), F.sum("y")).first()
    assert {r["column"]: r["s"] for r in apply_columns(two, ["x", "y"], total, "s double").collect()} == {"x": want[0], "y": want[1]}
    assert [r["s"] for r in apply_columns(two.limit(0), ["x"], total, "s double").collect()] == [0.0]
    nulls = spark.createDataFrame([(1.0, 5.0), (None, 2.0), (None, None)], "a double, b double")
    passed = apply_rows(nulls, ["a", "b"], lambda f: f.max(axis=1), "m").collect()
    assert [None if r["m"] is None or math.isnan(r["m"]) else r["m"] for r in passed] == [5.0, 2.0, None]
    assert [r["m"] for r in apply_rows(nulls, ["a", "b"], lambda f: f.max(axis=1), "m", nulls="null").collect()] == [5.0, None, None]
    with pytest.raises(ValueError):
        apply_rows(nulls, ["a"], len, "m", nulls="drop")
    assert [r["b"] for r in map_columns(nulls, ["b"], lambda v: v * 2).collect()] == [10.0, 4.0, None]


def test_states_of_many_groups_are_not_held_together(monkeypatch, spark):
    """One state at a time: the function is never begun again before the last one is done."""
    made = apply_groups(spark.range(50_000, numPartitions=2).withColumn("g", F.col("id") % 20_000), ["g"], ["id"], summed(lambda b: b.num_rows), "n long", 1)
    assert made.agg(F.sum("n"), F.count("*")).first() == (50_000, 20_000)
    assert applying.FAN_IN > 1


def test_many_whole_groups_go_in_one_batch(spark):
    """Groups of any size, over several batches, in the frames that they have by themselves."""
    rows = [(f"g{i % 7}" if i % 3 else f"s{i}", i if i % 5 else None, i % 2 == 0 if i % 11 else None, float(i) if i % 4 else None) for i in range(40_000)]
    df = spark.createDataFrame([*rows, (None, 1, True, 1.0)], "k string, a long, b boolean, x double").repartition(3)

    def told(f):
        kinds = ",".join(str(t) for t in f.dtypes)
        return kinds, int(f["a"].sum()), int(f["a"].isna().sum()), f["b"].isna().sum(), None if f["x"].isna().any() else float(f["x"].sum()), len(f), f.index[-1] == len(f) - 1

    returns = "kinds string, a long, holes long, no_b long, x double, n long, numbered boolean"
    made = apply_whole_groups(df, ["k"], ["a", "b", "x"], told, returns)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan  # no frame sent for each group
    got = {r["k"]: tuple(r)[1:] for r in made.collect()}
    want = {}
    for k, a, b, x in rows:
        want.setdefault(k, []).append((a, b, x))
    assert got.keys() == want.keys()
    for k, own in want.items():
        a, b, x = (list(v) for v in zip(*own))
        kinds = ",".join(["float64" if None in a else "int64", "object" if None in b else "bool", "float64"])
        assert got[k] == (kinds, sum(v for v in a if v is not None), a.count(None), b.count(None), None if None in x else sum(x), len(own), True)
    assert apply_whole_groups(df.limit(0), ["k"], ["a"], len, "n long").collect() == []
