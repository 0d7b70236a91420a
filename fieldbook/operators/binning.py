"""Bins, tiers, log columns and outlier flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.quantiles import quantiles
from fieldbook.operators.shaping import columns_of, present


def cut(column: Column, edges: Sequence[float], labels: Sequence[str], lowest: bool = False) -> Column:
    """Label of the right-closed bin a value falls into, null outside all bins."""
    if len(labels) != len(edges) - 1:
        raise ValueError(f"{len(edges)} edges need {len(edges) - 1} labels, got {len(labels)}")
    out = F.lit(None).cast("string")
    for i in reversed(range(len(labels))):
        above = column >= edges[i] if lowest and i == 0 else column > edges[i]
        out = F.when(above & (column <= edges[i + 1]), F.lit(labels[i])).otherwise(out)
    return out


def label_rank(column: Column, labels: Sequence[str]) -> Column:
    """Position of a label in its order, so sorting follows the labels' meaning."""
    order = F.create_map(*[x for i, name in enumerate(labels) for x in (F.lit(name), F.lit(i))])
    return F.try_element_at(order, column)


def quantile_edges(df: DataFrame, column: str, q: int) -> list[float]:
    """The q + 1 quantile edges of a column, as exact numbers."""
    return list(quantiles(df, [column], [i / q for i in range(q + 1)]).first()[column] or [])


def quantile_cut(df: DataFrame, column: str, labels: Sequence[str], name: str) -> DataFrame:
    """Add a tier column of equally filled, right-closed bins, the lowest edge included."""
    edges = quantile_edges(df, column, len(labels))
    if not edges or edges[0] is None:
        return df.withColumn(name, F.lit(None).cast("string"))
    distinct = sorted(set(edges))
    if len(distinct) != len(edges):
        raise ValueError(
            f"quantile edges of {column} collapse to {len(distinct)} values; "
            f"{len(distinct) - 1} labels fit, got {len(labels)}"
        )
    return df.withColumn(name, cut(F.col(column).cast("double"), edges, labels, lowest=True))


def fixed_bin(column: Column, size: float, peg: float = 0.0) -> Column:
    """Lower edge of the fixed-size bin holding the value."""
    return F.floor((column - peg) / size) * size + peg


def log_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``log_<c>`` = log(1 + c) for each numeric column whose minimum is positive."""
    numeric = present(df, columns) if columns is not None else columns_of(df, "numeric")
    if not numeric:
        return df
    lows = df.agg(*[F.min(c).alias(c) for c in numeric]).first()
    positive = [c for c in numeric if lows[c] is not None and lows[c] > 0]
    return df.withColumns({f"log_{c}": F.log1p(F.col(c)) for c in positive}) if positive else df


def fences(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> dict[str, tuple[float, float]]:
    """Lower and upper fence per column, from one pass over the quartiles."""
    row = quantiles(df, columns, [0.25, 0.75]).first()
    found = {}
    for c in columns:
        if row[c] and row[c][0] is not None:
            q1, q3 = row[c]
            found[c] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return found


def outside(column: Column, low: float, high: float) -> Column:
    """Whether a value lies outside the fences; a null does not."""
    return F.coalesce((column < low) | (column > high), F.lit(False))


def flag_outliers(
    df: DataFrame, columns: Sequence[str], k: float = 1.5, keep_empty: bool = False
) -> DataFrame:
    """Add ``<c>_is_outlier`` (0/1) for each column that has rows outside its fences.

    Two passes over the named columns: quartiles, then the counts deciding
    which flags exist. The thresholds are plain numbers in the plan.
    """
    columns = present(df, columns)
    if not columns:
        return df
    limits = fences(df, columns, k)
    flags = {c: outside(F.col(c).cast("double"), *limits[c]) for c in limits}
    if not flags:
        return df
    if not keep_empty:
        counts = df.agg(*[F.count_if(f).alias(c) for c, f in flags.items()]).first()
        flags = {c: f for c, f in flags.items() if counts[c]}
    return df.withColumns({f"{c}_is_outlier": f.cast("int") for c, f in flags.items()}) if flags else df


def outlier_totals(df: DataFrame) -> DataFrame:
    """(column, outliers) for every ``_is_outlier`` flag, one pass."""
    flags = [c for c in df.columns if c.endswith("_is_outlier")]
    if not flags:
        return df.sparkSession.createDataFrame([], "column string, outliers long")
    sums = df.agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in flags])
    return sums.unpivot([], flags, "column", "outliers").select(
        F.regexp_replace("column", "_is_outlier$", "").alias("column"), "outliers"
    )
