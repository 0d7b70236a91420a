"""Filling nulls: constants, means, exact medians, modes and the previous value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.quantiles import medians
from fieldbook.operators.running import carry_all_forward


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n): the most frequent value per column, smallest on a tie.

    Values are counted first and the winner is a plain maximum over the counts,
    so no task holds a column's set of values.
    """
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        ).alias("cell")
    ).select("cell.*")
    counts = long.dropna(subset=["value"]).groupBy("column", "value").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), "value", "n"))
    return counts.groupBy("column").agg(best.alias("b")).select("column", "b.value", "b.n")


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls with the column mean."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    out = df.withColumn("_m", means)
    return out.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col("_m")[c]) for c in columns}
    ).drop("_m")


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls with the exact column median; the columns become double."""
    row = medians(df, columns).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(row[c])) for c in columns})


def fill_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls with the most frequent value, smallest on a tie."""
    found = {r["column"]: r["value"] for r in modes(df, columns).collect()}  # one row per column
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in found.items()}
    ) if found else df


def fill_previous(df: DataFrame, columns: Sequence[str], order: str, by: Sequence[str] = ()) -> DataFrame:
    """Fill nulls with the previous non-null value in the order of a column, all columns in one pass."""
    place = {c: F.col(f"carried_{i}").alias(c) for i, c in enumerate(columns)}
    return carry_all_forward(df, columns, [order], by).select(*[place.get(c, F.col(c)) for c in df.columns])
