"""Grouped summaries with the null and tie rules the reports rely on:
rows without a key are left out and equal values are ordered by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldbook.operators.quantiles import medians


def group(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Named aggregates per key."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(
        *[a.alias(name) for name, a in aggregates.items()]
    )


def group_with_median(df: DataFrame, keys: Sequence[str], value: str, **aggregates: Column) -> DataFrame:
    """Exact median of a value per key, with any further aggregates."""
    return medians(df, [value], keys, **aggregates).withColumnRenamed(value, "median")


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """(column, count, pct): counts of the non-null values, most frequent first."""
    counts = group(df, [column], count=F.count("*"))
    total = df.agg(F.count(column)).scalar()
    shares = counts.withColumn("pct", F.col("count") / total * 100)
    ordered = shares.orderBy(F.desc("count"), column)
    return ordered.limit(n) if n else ordered


def share_where(condition: Column) -> Column:
    """Aggregate: percentage of all rows meeting a condition, null counting as not met."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double")) * 100


def extremes(groups: DataFrame, key: str, metric: str) -> DataFrame:
    """One row: key and value of the largest and smallest metric, first key on a tie."""
    top = F.min_by(key, F.struct((-F.col(metric)).alias("m"), F.col(key)))
    low = F.min_by(key, F.struct(F.col(metric), F.col(key)))
    return groups.filter(F.col(metric).isNotNull()).agg(
        top.alias("top_key"), F.max(metric).alias("top_value"),
        low.alias("low_key"), F.min(metric).alias("low_value"),
    )


def crosstab(df: DataFrame, row: str, column: str, values: Sequence | None = None) -> DataFrame:
    """Counts of each value pair, as (row, column, n) of the pairs there are. With ``values``, one
    row per row value and a column for each of them, 0 where a pair is absent."""
    rows = df.dropna(subset=[row, column])
    if values is None:
        return rows.groupBy(row, column).agg(F.count("*").alias("n"))
    return rows.groupBy(row).pivot(column, list(values)).count().na.fill(0)


def cross_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """The same counts in long form with the row's percentage; absent pairs have no row."""
    counts = group(df, [row, column], n=F.count("*"))
    total = F.sum("n").over(Window.partitionBy(row))
    return counts.withColumn("pct", F.col("n") / total * 100)


def crosstab_percent(df: DataFrame, row: str, column: str, values: Sequence | None = None) -> DataFrame:
    """Row percentages of a cross table, in the same two forms; (row, column, pct) in the long one."""
    shares = cross_counts(df, row, column)
    if values is None:
        return shares.select(row, column, "pct")
    return shares.groupBy(row).pivot(column, list(values)).agg(F.first("pct")).na.fill(0.0)


def ratio_by_key(df: DataFrame, key: str, hit: Column, name: str = "pct") -> DataFrame:
    """Percentage of a key's rows that meet a condition, two decimals."""
    return group(df, [key], hits=F.count_if(hit), n=F.count("*")).withColumn(
        name, F.round(100 * F.try_divide(F.col("hits"), F.col("n")), 2)
    )


def pivot_mean(df: DataFrame, index: str, column: str, value: str, values: Sequence | None = None) -> DataFrame:
    """Mean of a value per index and column value, as (index, column, mean), or with ``values`` as
    a column for each of them."""
    rows = df.dropna(subset=[index, column])
    if values is None:
        return rows.groupBy(index, column).agg(F.avg(value).alias("mean"))
    return rows.groupBy(index).pivot(column, list(values)).agg(F.avg(value))
