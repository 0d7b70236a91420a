"""The tables behind the charts: histograms, densities, boxes, shares, calendars."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.grouping import group, group_with_median
from fieldbook.operators.profile import correlations
from fieldbook.operators.quantiles import medians, quantiles
from fieldbook.operators.shaping import columns_of, sample_rows, top_groups
from fieldbook.session import attach_groups


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(bin, low, high, count, density) for equal-width bins from minimum to maximum;
    the last bin is closed and empty bins are listed. A constant column gets a
    unit range around its value."""
    x = F.col(column).cast("double")
    bounds = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n")).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"), "n",
    )
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    index = F.least(F.floor((x - F.col("b.lo")) / width), F.lit(bins - 1)).cast("int")
    counted = (
        df.filter(x.isNotNull()).withColumn("b", bounds.select(F.struct("*")).scalar())
        .groupBy(index.alias("bin")).agg(F.count("*").alias("count"))
    )
    grid = bounds.filter(F.col("n") > 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi", "n"
    )
    step = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counted, "bin", "left").select(
        "bin", (F.col("lo") + F.col("bin") * step).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * step).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
        (F.coalesce("count", F.lit(0)) / (F.col("n") * step)).alias("density"),
    )


# Beyond this many bandwidths exp(-z²/2) is zero in double precision (fixed value).
KERNEL_REACH = 38.6
# Cells of an eighth of a bandwidth and a series of 20 terms: with |t·d| <= 38.6/16 the first
# term left out is below 2.5^20/20!, a relative error of 4e-11.
CELLS_PER_BANDWIDTH, TERMS = 8, 20


def _series(t: Column) -> Column:
    """Sum of m_p · t^p / p! over the cell's moments, by Horner's rule."""
    total = F.col(f"m{TERMS - 1}")
    for p in range(TERMS - 2, -1, -1):
        total = F.col(f"m{p}") + t / (p + 1) * total
    return total


def density_curve(df: DataFrame, column: str, by: str | None = None, points: int = 1000) -> DataFrame:
    """(by, point, x, density): Gaussian kernel density, bandwidth std·n^(-1/5), on a
    grid reaching half the range beyond both ends.

    A fast Gauss transform: values are gathered by cells of an eighth of a bandwidth into the
    moments sum(exp(-d²/2)·d^p) of their distances d from the cell's centre, and a cell at
    distance t adds exp(-t²/2)·sum(moment·t^p/p!) to a grid point. Moments are plain sums, so
    rows shrink to cells before any shuffle; the work beyond is cells × grid points, for any
    number of rows. Relative error below 1e-10. Groups of one value have no density.
    """
    keys = [by] if by else []
    rows = df.select(*keys, F.col(column).cast("double").alias("v")).dropna()
    stats = rows.groupBy(*keys).agg(
        F.count("v").alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi")
    ).filter((F.col("n") > 1) & (F.col("sd") > 0)).select(
        *keys, "n",
        (F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"),
        (F.col("lo") - (F.col("hi") - F.col("lo")) / 2).alias("start"),
        (2 * (F.col("hi") - F.col("lo")) / (points - 1)).alias("step"),
    )
    if by:
        placed = attach_groups(rows, stats, [by])
    else:
        # One row of a few numbers: brought back once, then literals.
        one = stats.first()
        stats = df.sparkSession.createDataFrame([one] if one else [], stats.schema)
        known = {c: F.lit(one[c] if one else None).cast("double") for c in ("h", "start", "step")}
        placed = rows.withColumns(known) if one else rows.limit(0).withColumns(known)
    z = (F.col("v") - F.col("start")) / F.col("h")
    placed = placed.select(*keys, (F.col("step") / F.col("h")).alias("step"), z.alias("z"))
    placed = placed.withColumn("cell", F.floor(F.col("z") * CELLS_PER_BANDWIDTH))
    placed = placed.withColumn("d", F.col("z") - (F.col("cell") + 0.5) / CELLS_PER_BANDWIDTH)
    placed = placed.withColumn("m", F.exp(-F.col("d") * F.col("d") / 2))
    power, moments = F.col("m"), []
    for p in range(TERMS):
        moments.append(F.sum(power).alias(f"m{p}"))
        power = power * F.col("d")
    cells = placed.groupBy(*keys, "step", "cell").agg(*moments).withColumn("centre", (F.col("cell") + 0.5) / CELLS_PER_BANDWIDTH)
    # Grid points a cell reaches; distances are in bandwidths, and point i is at i·step.
    step = F.col("step")
    reach = KERNEL_REACH + 0.5 / CELLS_PER_BANDWIDTH
    first = F.greatest(F.ceil((F.col("centre") - reach) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("centre") + reach) / step), F.lit(points - 1)).cast("int")
    met = cells.withColumns({"first": first, "last": last}).where("first <= last").withColumn("point", F.explode(F.sequence("first", "last")))
    t = F.col("t")
    made = met.withColumn("t", F.col("point") * step - F.col("centre")).select(*keys, "point", (F.exp(-t * t / 2) * _series(t)).alias("part"))
    sums = made.groupBy(*keys, "point").agg(F.sum("part").alias("total"))
    grid = stats.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return grid.join(sums, [*keys, "point"], "left").select(
        *keys, "point", (F.col("start") + F.col("point") * F.col("step")).alias("x"),
        (F.coalesce("total", F.lit(0.0)) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"),
    )


def box_statistics(df: DataFrame, column: str, by: str, k: float = 1.5) -> DataFrame:
    """(by, n, q1, median, q3, whisker_low, whisker_high, outliers) per group; whiskers
    end at the last value inside the fences."""
    rows = df.select(by, F.col(column).cast("double").alias("v")).dropna()
    q = quantiles(rows, ["v"], [0.25, 0.5, 0.75], [by]).select(
        by, F.col("v")[0].alias("q1"), F.col("v")[1].alias("median"), F.col("v")[2].alias("q3")
    )
    reach = k * (F.col("q3") - F.col("q1"))
    inside = F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)
    return attach_groups(rows, q, [by]).groupBy(by, "q1", "median", "q3").agg(
        F.count("*").alias("n"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def violin_statistics(df: DataFrame, column: str, by: str, points: int = 100) -> DataFrame:
    """Density curve per group, joined with the group's quartiles."""
    q = quantiles(df, [column], [0.25, 0.5, 0.75], [by]).select(
        by, F.col(column)[0].alias("q1"), F.col(column)[1].alias("median"), F.col(column)[2].alias("q3")
    )
    return density_curve(df, column, by, points).join(q, by)


def scatter_sample(
    df: DataFrame, x: str, y: str, key: str, n: int, hue: str | None = None, upper: float | None = None
) -> DataFrame:
    """Reproducible sample for a scatter chart; with ``upper``, the y axis ends at that
    quantile of the whole column and ``y_limit`` carries it."""
    picked = sample_rows(df.select(key, x, y, *([hue] if hue else [])), n, key)
    if upper is None:
        return picked
    return picked.withColumn("y_limit", F.lit(quantiles(df, [y], [upper]).first()[y][0]))


def pair_plot(df: DataFrame, columns: Sequence[str], key: str, n: int, bins: int = 10) -> dict[str, DataFrame]:
    """Tables of a pair plot: a histogram per column and a sample per pair."""
    tables = {f"hist_{c}": histogram(df, c, bins) for c in columns}
    picked = sample_rows(df.select(key, *columns), n, key)
    for a, b in combinations(columns, 2):
        tables[f"scatter_{a}_{b}"] = picked.select(key, a, b)
    return tables


def month_ends(df: DataFrame, date: str, **aggregates: Column) -> DataFrame:
    """Aggregates per calendar month labelled with its last day. Months without rows
    are listed: counts named ``n`` are 0 there, everything else null."""
    month = F.last_day(F.col(date).cast("date"))
    per_month = df.filter(F.col(date).isNotNull()).groupBy(month.alias("month_end")).agg(
        *[a.alias(name) for name, a in aggregates.items()]
    )
    span = per_month.agg(F.min("month_end").alias("a"), F.max("month_end").alias("b"))
    calendar = span.filter(F.col("a").isNotNull()).select(
        F.explode(F.sequence(F.trunc("a", "month"), F.trunc("b", "month"), F.expr("interval 1 month"))).alias("m")
    ).select(F.last_day("m").alias("month_end"))
    out = calendar.join(per_month, "month_end", "left")
    return out.na.fill(0, ["n"]) if "n" in aggregates else out


def correlation_triangle(df: DataFrame, columns: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """Lower triangle of the correlations of all numeric columns, or the first ``limit``,
    flags and ids left out."""
    names = columns or [
        c for c in columns_of(df, "numeric")
        if not c.endswith("_is_outlier") and c != "id" and not c.endswith("_id")
    ][:limit]
    return correlations(df, names).select(F.col("y").alias("row"), F.col("x").alias("column"), "r")


def dual_ranking(df: DataFrame, key: str, value: str, n: int = 20) -> DataFrame:
    """The n most frequent keys with their median value and whether it exceeds the
    overall median."""
    top = top_groups(df, [key], F.count("*"), n, name="count")
    rows = df.join(top, key)
    middle = group_with_median(rows, [key], value)
    overall = medians(df, [value]).first()[value]
    return top.join(middle, key).withColumn("above_overall", (F.col("median") > F.lit(overall)).cast("int"))


def kpi_tiles(df: DataFrame, **aggregates: Column) -> DataFrame:
    """Headline numbers in one aggregate."""
    return df.agg(*[a.alias(name) for name, a in aggregates.items()])


def calendar_profile(df: DataFrame, date: str, part: Column) -> DataFrame:
    """Row counts per calendar part, in the part's order."""
    return group(df.withColumn("part", part), ["part"], n=F.count("*")).orderBy("part")
