"""Statistical tests. One distributed aggregate per test gives the sufficient
statistics; the tail probability is taken on the single result row."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.operators.applying import GroupFunction, apply_groups, by_key
from fieldbook.operators.profile import correlation, stacked
from fieldbook.operators.quantiles import order_statistics
from fieldbook.operators.special import chi2_p_value, f_p_value, t_p_value
from fieldbook.session import attach_groups, materialise


def anova(df: DataFrame, metric: str, factor: str, alpha: float = 0.05) -> DataFrame:
    """One-way analysis of variance: ``f_statistic, df_between, df_within, p_value, significant``.

    Group means and variances are Spark's mergeable central moments, so large
    offsets do not cancel.
    """
    x = F.col(metric).cast("double")
    groups = (
        df.select(F.col(factor).alias("g"), x.alias("x")).dropna()
        .groupBy("g").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    )
    grand = groups.agg(F.sum(F.col("n") * F.col("m")) / F.sum("n")).scalar()
    sums = groups.withColumn("grand", grand).agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("m") - F.col("grand")) ** 2).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
    )
    d1, d2 = F.col("k") - 1, F.col("n") - F.col("k")
    stat = F.try_divide(F.try_divide(F.col("between"), d1), F.try_divide(F.col("within"), d2))
    return (
        sums.filter((F.col("k") > 1) & (d2 > 0))
        .select(stat.alias("f_statistic"), d1.alias("df_between"), d2.alias("df_within"))
        .withColumn("p_value", f_p_value("f_statistic", F.col("df_between").cast("double"), F.col("df_within").cast("double")))
        .withColumn("significant", (F.col("p_value") < alpha).cast("int"))
    )


def chi_square(df: DataFrame, a: str, b: str, alpha: float = 0.05) -> DataFrame:
    """Independence test of two categories: ``chi2, dof, p_value, significant``.

    Cells without rows add their expected count, which is what is left of n
    after the occupied cells, so the grid of all value pairs is never built.
    A 2 × 2 table gets the continuity correction.
    """
    cells = df.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna().groupBy("a", "b").agg(
        F.count("*").cast("double").alias("o")
    )
    rows = cells.groupBy("a").agg(F.sum("o").alias("r"))
    columns = cells.groupBy("b").agg(F.sum("o").alias("c"))
    n = rows.agg(F.sum("r")).scalar()
    margins = rows.agg(F.count("*").alias("k"), F.sum(1 / F.col("r")).alias("inv")).select(
        F.struct("k", "inv")
    ).scalar()
    margins_b = columns.agg(F.count("*").alias("k"), F.sum(1 / F.col("c")).alias("inv")).select(
        F.struct("k", "inv")
    ).scalar()
    placed = cells.join(rows, "a").join(columns, "b").withColumn("n", n)
    e = F.col("r") * F.col("c") / F.col("n")
    sums = placed.agg(
        F.sum((F.col("o") - e) ** 2 / e).alias("occupied"),
        F.sum(e).alias("expected"),
        F.max(F.abs(F.col("o") - e)).alias("gap"),
        F.max("n").alias("n"),
    ).withColumn("ma", margins).withColumn("mb", margins_b)
    dof = ((F.col("ma.k") - 1) * (F.col("mb.k") - 1)).cast("long")
    plain = F.col("occupied") + (F.col("n") - F.col("expected"))
    corrected = F.greatest(F.col("gap") - 0.5, F.lit(0.0)) ** 2 * F.col("n") * F.col("ma.inv") * F.col("mb.inv")
    return (
        sums.select(dof.alias("dof"), F.when(dof == 1, corrected).otherwise(plain).alias("chi2"))
        .filter(F.col("dof") > 0)
        .withColumn("p_value", chi2_p_value("chi2", F.col("dof").cast("double")))
        .withColumn("significant", (F.col("p_value") < alpha).cast("int"))
        .select("chi2", "dof", "p_value", "significant")
    )


def welch(df: DataFrame, metric: str, factor: str, first: object, second: object, alpha: float = 0.05) -> DataFrame:
    """Two-sample test without equal variances: ``t_statistic, df, p_value, mean_1, mean_2,
    significant``; no row unless both groups have two values."""
    x = F.col(metric).cast("double")
    aggs = []
    for i, value in ((1, first), (2, second)):
        part = F.when(F.col(factor) == value, x)
        aggs += [F.count(part).alias(f"n{i}"), F.avg(part).alias(f"mean_{i}"), F.var_samp(part).alias(f"v{i}")]
    s = df.filter(F.col(factor).isin(first, second)).agg(*aggs)
    e1, e2 = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
    return (
        s.filter((F.col("n1") > 1) & (F.col("n2") > 1))
        .select(
            F.try_divide(F.col("mean_1") - F.col("mean_2"), F.sqrt(e1 + e2)).alias("t_statistic"),
            F.try_divide((e1 + e2) ** 2, e1**2 / (F.col("n1") - 1) + e2**2 / (F.col("n2") - 1)).alias("df"),
            "mean_1", "mean_2",
        )
        .withColumn("p_value", t_p_value("t_statistic", "df"))
        .withColumn("significant", (F.col("p_value") < alpha).cast("int"))
    )


def normality(df: DataFrame, columns: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Omnibus normality test from skewness and kurtosis, per column:
    ``column, n, skewness, kurtosis, k2, p_value, is_normal``; needs eight values.
    Skewness and kurtosis are reported bias-corrected."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs.append(
            F.struct(
                F.lit(c).alias("column"), F.count(x).cast("double").alias("n"),
                F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2"),
            )
        )
    s = stacked(df, aggs)
    s = s.filter(F.col("n") >= 8)
    n, g1, g2 = F.col("n"), F.col("g1"), F.col("g2")

    y = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    b2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (b2 - 1)) - 1
    delta = 1 / F.sqrt(0.5 * F.log(w2))
    ya = y / F.sqrt(2 / (w2 - 1))
    z1 = delta * F.log(ya + F.sqrt(ya * ya + 1))

    e = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (g2 + 3 - e) / F.sqrt(var)
    sb = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / sb * (2 / sb + F.sqrt(1 + 4 / (sb * sb)))
    ratio = (1 - 2 / a) / (1 + x * F.sqrt(2 / (a - 4)))
    z2 = (1 - 2 / (9 * a) - F.signum(ratio) * F.pow(F.abs(ratio), 1 / 3)) / F.sqrt(2 / (9 * a))

    k2 = z1 * z1 + z2 * z2
    skew = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))
    return (
        s.select(
            "column", n.cast("long").alias("n"), skew.alias("skewness"), kurt.alias("kurtosis"), k2.alias("k2")
        )
        .withColumn("p_value", F.exp(-F.col("k2") / 2))
        .withColumn("is_normal", (F.col("p_value") > alpha).cast("int"))
    )


def linear_fit(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares line on the rows having both values: ``n, slope, intercept, r_squared, r, p_value``."""
    a, b = F.col(y).cast("double"), F.col(x).cast("double")
    s = df.select(a.alias("y"), b.alias("x")).dropna().agg(
        F.count("*").alias("n"), F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"), F.regr_r2("y", "x").alias("r_squared"),
        correlation("x", "y").alias("r"),
    )
    return _with_r_p_value(s)


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation on the rows having both values: ``n, r, p_value``."""
    s = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna().agg(
        F.count("*").alias("n"), correlation("x", "y").alias("r")
    )
    return _with_r_p_value(s)


def _with_r_p_value(s: DataFrame) -> DataFrame:
    r, n = F.col("r"), F.col("n")
    t = r * F.sqrt(F.try_divide((n - 2).cast("double"), 1 - r * r))
    return s.withColumn("p_value", t_p_value(t, (n - 2).cast("double")))


def ridge(df: DataFrame, target: str, features: Sequence[str], penalty: float = 1.0) -> DataFrame:
    """Ridge regression with a free intercept and unscaled features:
    ``term, coefficient, r_squared``.

    One aggregate gives the centred cross products of the complete rows; the
    p × p system is solved where that single row lives.
    """
    features = list(features)
    names = [*features, target]
    data = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)]).dropna()
    p = len(features)
    aggs: list[Column] = [F.count("*").cast("double").alias("n")]
    aggs += [F.avg(f"x{i}").alias(f"m{i}") for i in range(p + 1)]
    aggs += [
        F.covar_pop(f"x{i}", f"x{j}").alias(f"s{i}_{j}") for i in range(p + 1) for j in range(i, p + 1)
    ]

    def solve(batches):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                n = row["n"]
                if n == 0:
                    continue
                s = np.array(
                    [[row[f"s{min(i, j)}_{max(i, j)}"] for j in range(p + 1)] for i in range(p + 1)]
                ) * n
                gram, cross, total = s[:p, :p], s[:p, p], s[p, p]
                beta = np.linalg.solve(gram + penalty * np.eye(p), cross)
                mean = np.array([row[f"m{i}"] for i in range(p + 1)])
                residual = total - 2 * beta @ cross + beta @ gram @ beta
                yield pd.DataFrame(
                    {
                        "term": ["intercept", *features],
                        "coefficient": [mean[p] - beta @ mean[:p], *beta],
                        "r_squared": 1 - residual / total if total > 0 else None,
                    }
                )

    return data.agg(*aggs).mapInPandas(solve, "term string, coefficient double, r_squared double")


def _draws(key: np.ndarray, replicate: np.ndarray) -> np.ndarray:
    """Poisson(1) weights of (key, replicate): the number of cumulative probabilities not
    above a 31-bit hash from multiply and xor-shift steps. No step exceeds 64 bits, so the
    same draws come out on any engine and after any retry."""
    prime = 2_147_483_647
    h = np.fmod(key, prime)[:, None] * 48_271 + replicate[None, :] * 69_621 + 12_345
    for factor, shift in ((48_271, 15), (69_621, 13), (39_373, 16)):
        h = np.fmod(np.fmod(h, prime) * factor, prime)
        h ^= h >> shift
    u = np.fmod(h, prime) / float(prime)
    term = float(np.exp(-1.0))
    steps = np.cumsum([term / math.factorial(k) for k in range(10)])
    return np.searchsorted(steps, u, side="right")


#: Rows whose draws are made at a time; a task then holds so many times the replicates.
DRAWN_ROWS = 2_000


def _weighted(replicates: int):
    """For batches whose last column is the key: pairs of (rows from, to, their weights)."""
    number = np.arange(1, replicates + 1)

    def parts(batch: pa.RecordBatch):
        keys = batch.column(batch.num_columns - 1).to_numpy()
        for i in range(0, len(keys), DRAWN_ROWS):
            yield i, i + DRAWN_ROWS, _draws(keys[i : i + DRAWN_ROWS], number)

    return parts


def bootstrap_mean(
    df: DataFrame, group: str, metric: str, key: str, replicates: int = 1000, level: float = 0.95
) -> DataFrame:
    """Mean per group with a bootstrap interval: ``group, mean, low, high``.

    Each row enters each replicate with a Poisson(1) weight drawn from its key,
    so replicates are sums, two numbers each per task and group; nothing is resampled or moved.
    """
    rows = df.select(
        F.col(group).alias("g"), F.col(metric).cast("double").alias("x"), F.col(key).cast("long").alias("k")
    ).dropna()
    parts, tail = _weighted(replicates), 50 * (1 - level)

    def add(sums: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        x = batch.column(0).to_numpy()
        for a, b, w in parts(batch):
            sums[0] += x[a:b] @ w
            sums[1] += w.sum(axis=0)
        return sums

    def interval(sums: np.ndarray) -> tuple:
        means = sums[0][sums[1] > 0] / sums[1][sums[1] > 0]
        return tuple(float(v) for v in np.percentile(means, [tail, 100 - tail])) if len(means) else (None, None)

    fn = GroupFunction(lambda: np.zeros((2, replicates)), add, np.add, interval)
    means = rows.groupBy("g").agg(F.avg("x").alias("mean"))
    return means.join(apply_groups(rows, ["g"], ["x", "k"], fn, "low double, high double"), "g").select(
        F.col("g").alias(group), "mean", "low", "high"
    )


class _Middles:
    """Medians of all replicates of a group, from its values in rising order with the weights
    of each, after the sums of the weights below them and of all."""

    def __init__(self, replicates: int):
        self.seen = self.total = None
        self.low, self.high = np.full(replicates, np.nan), np.full(replicates, np.nan)

    def add(self, batch: pa.RecordBatch) -> "_Middles":
        values, made = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            weights = np.frombuffer(made[i].as_buffer(), np.int64)
            if not values[i].is_valid:
                self.seen, self.total = weights.reshape(2, -1)
                self.outside = self.seen >= np.maximum((self.total + 1) // 2, 1)
                continue
            x = values[i].as_py()
            now = self.seen + weights
            for ends, rank in ((self.low, (self.total + 1) // 2), (self.high, self.total // 2 + 1)):
                ends[(self.seen < rank) & (rank <= now)] = x
            self.seen = now
        return self

    def interval(self, tail: float) -> tuple:
        drawn = self.total > 0
        medians = ((self.low + self.high) / 2)[drawn]
        missed = bool(self.outside[drawn].any() or np.isnan(medians).any())
        if missed or not len(medians):
            return None, None, missed
        return *(float(v) for v in np.percentile(medians, [tail, 100 - tail])), False


def bootstrap_median(
    df: DataFrame, group: str, metric: str, key: str, replicates: int = 1000, level: float = 0.95, reach: float = 4.0
) -> DataFrame:
    """Median per group with its bootstrap interval by resampling: ``group, median, low, high``.

    Rows enter replicates as in ``bootstrap_mean``; a replicate's median is the mean of its two
    middle rows, and a replicate without rows has none. Where a replicate's median lies among
    the group's n values differs from n/2 by a few times √n/2, so the values at ranks
    n/2 ± reach·√n bracket all of them. Below the bracket only sums of weights count; within it,
    a value's weights are added up, and one walk over the values finds all medians. A task
    holds weights of one value at a time, a group's bracket about 2·reach·√n values. Where a
    median falls outside, the bracket is widened, in the end to all values: results never
    depend on it.
    """
    rows = df.select(
        F.col(group).alias("g"), F.col(metric).cast("double").alias("x"), F.col(key).cast("long").alias("k")
    ).dropna()
    parts, tail = _weighted(replicates), 50 * (1 - level)

    def add_sums(sums: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        below = (batch.column(0).to_numpy() < batch.column(1).to_numpy()).astype(np.int64)
        for a, b, w in parts(batch):
            sums[0] += below[a:b] @ w
            sums[1] += w.sum(axis=0)
        return sums

    def add_weights(sums: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        for _, _, w in parts(batch):
            sums += w.sum(axis=0)
        return sums

    below = GroupFunction(lambda: np.zeros((2, replicates), np.int64), add_sums, np.add, np.ndarray.tobytes)
    weights = GroupFunction(lambda: np.zeros(replicates, np.int64), add_weights, np.add, np.ndarray.tobytes)
    schema = T.StructType([rows.schema["g"], *T.StructType.fromDDL("low double, high double, missed boolean").fields])
    middles = by_key(1, lambda: _Middles(replicates), _Middles.add, lambda m: m.interval(tail), schema)
    for wide in (reach, 16 * reach, None):
        around = [
            (0.5, lambda n: (n - 1) / 2),
            (0.5, lambda n: F.greatest(F.floor(n / 2 - F.sqrt(n) * (wide or 0)) - 1, F.lit(0.0)).cast("double")),
            (0.5, lambda n: F.least(F.ceil(n / 2 + F.sqrt(n) * (wide or 0)), n - 1).cast("double")),
        ]
        spans = [(0.5 - 0.001 * (wide or 1), 0.5 + 0.001 * (wide or 1))]
        found = order_statistics(rows, ["x"], around, ["g"], spans=spans, small_group=1_000_000)
        inf = F.lit(float("inf"))
        bracket = materialise(found.select(
            "g", F.col("x")[0].alias("median"), (F.col("x")[1] if wide else -inf).alias("lo"), (F.col("x")[2] if wide else inf).alias("hi")
        ), "brackets")
        placed = attach_groups(rows, bracket.drop("median"), ["g"])
        sums = apply_groups(placed, ["g"], ["x", "lo", "k"], below, "w binary").select("g", F.lit(None).cast("double").alias("x"), "w")
        inside = apply_groups(placed.where(F.col("x").between(F.col("lo"), F.col("hi"))), ["g", "x"], ["k"], weights, "w binary")
        walked = sums.unionByName(inside).repartition("g").sortWithinPartitions("g", "x").mapInArrow(middles, schema)
        ends = materialise(walked, "medians")
        if not wide or not ends.where("missed").limit(1).count():
            return bracket.join(ends, "g").select(F.col("g").alias(group), "median", "low", "high")


def median_interval(df: DataFrame, group: str, metric: str, bracket: bool | None = None) -> DataFrame:
    """Median per group with the 95 % interval that resampling tends to:
    ``group, median, low, high``.

    A resampled median falls on the k-th smallest value with a known binomial
    probability; for many replicates the interval ends are the values at ranks
    n/2 ± 1.96·√n/2, found by exact rank selection without resampling.
    """
    half = lambda n: F.lit(1.959963984540054) * F.sqrt(n) / 2
    targets = [
        (0.5, lambda n: (n - 1) / 2),
        (0.5, lambda n: F.greatest(F.floor(n / 2 - half(n)).cast("double") - 1, F.lit(0.0))),
        (0.5, lambda n: F.least(F.ceil(n / 2 + half(n)).cast("double") - 1, n - 1)),
    ]
    # The ranks spread by less than 0.1 % of a group of a million; smaller ones are ranked whole.
    out = order_statistics(
        df, [metric], targets, [group], bracket=bracket,
        spans=[(0.4986, 0.5014)], small_group=1_000_000,
    )
    q = F.col(metric)
    return out.select(group, q[0].alias("median"), q[1].alias("low"), q[2].alias("high"))


def mean_and_deviation(df: DataFrame, group: str, metric: str) -> DataFrame:
    """Mean and sample deviation per group, the table behind error bars."""
    return df.dropna(subset=[group]).groupBy(group).agg(
        F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"), F.count(metric).alias("n")
    )
