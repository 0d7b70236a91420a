"""Whole-table profiles: quality counts, descriptive statistics, correlations.

Each profile is one aggregate over the columns concerned (quantiles add the
passes of exact rank selection), reshaped to one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations, combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldbook.operators.applying import GroupFunction, apply_groups
from fieldbook.operators.quantiles import quantiles
from fieldbook.operators.shaping import columns_of

PERCENTILES = (0.10, 0.25, 0.50, 0.75, 0.90)


def data_quality(df: DataFrame) -> DataFrame:
    """One row: rows, columns, cells, null cells, completeness % and column kinds."""
    kinds = {k: len(columns_of(df, k)) for k in ("numeric", "text", "datetime")}
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    base = df.agg(F.count("*").alias("total_rows"), nulls.alias("null_cells"))
    cells = F.col("total_rows") * len(df.columns)
    return base.select(
        "total_rows",
        F.lit(len(df.columns)).cast("long").alias("total_columns"),
        cells.alias("total_cells"),
        "null_cells",
        F.round((1 - F.try_divide(F.col("null_cells"), cells)) * 100, 2).alias("completeness_pct"),
        F.lit(kinds["numeric"]).cast("long").alias("numeric_columns"),
        F.lit(kinds["text"]).cast("long").alias("categorical_columns"),
        F.lit(kinds["datetime"]).cast("long").alias("datetime_columns"),
    )


def _rows_per_column(one: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One wide row of ``<i>_<field>`` columns as one row per column."""
    cells = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{f}").alias(f) for f in fields])
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*cells)))


#: Columns whose moments one aggregate takes: the compiled code for more is too long for the JVM to optimise.
MOMENT_COLUMNS = 4


def stacked(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """One row per struct of aggregates over all rows, a few structs to an aggregate."""
    parts = [structs[i : i + MOMENT_COLUMNS] for i in range(0, len(structs), MOMENT_COLUMNS)]
    rows = [df.agg(*[s.alias(f"s{i}") for i, s in enumerate(part)]).select(F.inline(F.array(*[f"s{i}" for i in range(len(part))]))) for part in parts]
    return reduce(DataFrame.unionByName, rows)


#: Whole numbers of one bitmap page, and the bytes of a page (fixed by Spark's bitmap functions).
PAGE_VALUES, PAGE_BYTES = 32_768, 4_096


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, n_unique): exact numbers of distinct non-null values, of all columns in one go.

    Each row gives one short cell per column, and equal cells collapse before the shuffle.
    Whole numbers and dates that lie close together go into bitmap pages; of other values a
    128-bit hash stands for the value. Cells are keyed by column and hash (or page), so the
    shuffle is even whatever the columns hold.
    """
    by, columns = list(by), list(columns or df.columns)
    kinds = {f.name: f.dataType for f in df.schema}
    whole = [c for c in columns if isinstance(kinds[c], T.IntegralType | T.DateType)] if not by else []
    numbers = {c: (F.unix_date(c) if isinstance(kinds[c], T.DateType) else F.col(c)).cast("long") for c in whole}
    dense = []
    if whole:
        seen = df.agg(*[f(numbers[c]).alias(f"{i}_{n}") for i, c in enumerate(whole) for f, n in ((F.min, "lo"), (F.max, "hi"), (F.count, "n"))]).first()
        for i, c in enumerate(whole):
            pages = 0 if seen[f"{i}_lo"] is None else 1 + (seen[f"{i}_hi"] - seen[f"{i}_lo"]) // PAGE_VALUES
            if pages * PAGE_BYTES <= max(PAGE_BYTES, 8 * seen[f"{i}_n"]):
                dense.append(c)
    parts = []
    if dense:
        cells = F.array(*[
            F.struct(F.lit(c).alias("column"), F.bitmap_bucket_number(numbers[c]).alias("page"), F.bitmap_bit_position(numbers[c]).alias("bit"))
            for c in dense
        ])
        pages = df.select(F.inline(cells)).dropna(subset=["bit"]).groupBy("column", "page").agg(
            F.bitmap_count(F.bitmap_construct_agg("bit")).alias("n")
        )
        parts.append(pages.groupBy("column").agg(F.sum("n").alias("n_unique")))
    others = [c for c in columns if c not in dense]
    if others:
        plain = {c: F.col(c) + F.lit(0).cast(kinds[c]) if isinstance(kinds[c], T.FractionalType) else F.col(c) for c in others}
        cells = F.array(*[
            F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column"), F.xxhash64(plain[c]).alias("h"), F.xxhash64(plain[c], F.lit(c)).alias("g")))
            for c in others
        ])
        rows = df.select(*[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)], F.explode(cells).alias("cell")).where("cell IS NOT NULL")
        keys = [f"_by{i}" for i in range(len(by))]
        hashes = rows.select(*keys, "cell.*").groupBy(*keys, "column", "h", "g").agg(F.lit(1).alias("one"))
        counted = hashes.groupBy(*keys, "column").agg(F.count("*").alias("n_unique"))
        parts.append(counted.withColumnsRenamed(dict(zip(keys, by))))
    return reduce(DataFrame.unionByName, parts)


def schema_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column, dtype, n_unique, null_pct) per column."""
    aggs = []
    for i, c in enumerate(df.columns):
        aggs.append(F.round(F.avg(F.col(c).isNull().cast("double")) * 100, 2).alias(f"{i}_null_pct"))
        if approximate:
            aggs.append(F.approx_count_distinct(F.col(c)).alias(f"{i}_n_unique"))
    long = _rows_per_column(df.agg(*aggs), df.columns, ["n_unique", "null_pct"] if approximate else ["null_pct"])
    if not approximate:
        # One row per column on both sides.
        long = long.join(distinct_counts(df), "column", "left").na.fill(0, ["n_unique"])
    types = F.create_map(*[x for n, t in df.dtypes for x in (F.lit(n), F.lit(t))])
    return long.withColumn("dtype", types[F.col("column")]).select("column", "n_unique", "null_pct", "dtype")


def sample_skewness(column: Column) -> Column:
    """Bias-corrected skewness; null below three values."""
    n = F.count(column).cast("double")
    return F.when(n > 2, F.skewness(column) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def sample_kurtosis(column: Column) -> Column:
    """Bias-corrected excess kurtosis; null below four values."""
    n = F.count(column).cast("double")
    corrected = ((n + 1) * F.kurtosis(column) + 6) * (n - 1)
    return F.when(n > 3, F.try_divide(corrected, (n - 2) * (n - 3)))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, percentiles, max, skewness, kurtosis and cv% per numeric column."""
    columns = list(columns or columns_of(df, "numeric"))
    moments = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        moments.append(F.struct(
            F.lit(i).alias("at"), F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max"), sample_skewness(x).alias("skewness"),
            sample_kurtosis(x).alias("kurtosis"),
        ))
    # Several scans: moments of a few columns compile to one tight loop, which more of them, or
    # sharing a pass with the object-based percentile buffers, would undo.
    wide = quantiles(df, columns, PERCENTILES)
    cells = [F.struct(F.lit(i).alias("at"), F.col(c).alias("q")) for i, c in enumerate(columns)]
    names = [f"p{round(p * 100)}" for p in PERCENTILES]
    q = wide.select(F.inline(F.array(*cells)))
    both = stacked(df, moments).select("at", F.struct("*").alias("m")).join(F.broadcast(q), "at")
    m = F.col("m")
    return both.select(
        m["column"].alias("column"), m["count"].alias("count"), m["mean"].alias("mean"), m["std"].alias("std"), m["min"].alias("min"),
        *[F.col("q")[i].alias(n) for i, n in enumerate(names)],
        m["max"].alias("max"), m["skewness"].alias("skewness"), m["kurtosis"].alias("kurtosis"),
        F.round(F.try_divide(m["std"], m["mean"]) * 100, 2).alias("cv_pct"),
    )


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None, top: int = 10) -> DataFrame:
    """Per text column: unique values, the most frequent one with its share, and a
    map of the ``top`` most frequent values."""
    columns = list(columns or columns_of(df, "text"))
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    counts = (
        df.select(F.inline(cells)).groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("column").agg(
        F.count("value").alias("unique_count"), F.sum("n").alias("rows")
    )
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    ranked = (
        counts.filter(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    )
    best = ranked.groupBy("column").agg(
        F.min_by("value", "rank").alias("top_value"),
        F.max("n").alias("top_freq"),
        F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("entries"),
    )
    return totals.join(best, "column", "left").select(
        "column", "unique_count", "top_value", "top_freq",
        F.round(F.col("top_freq") / F.col("rows") * 100, 2).alias("top_pct"),
        F.map_from_arrays("entries.value", "entries.n").alias("value_counts"),
    )


def correlation(a: Column | str, b: Column | str) -> Column:
    """Aggregate: Pearson correlation of the rows having both values, null when either
    is constant there (the built-in one fails on that in ANSI mode)."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(
        F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    )


#: Up to this many columns all pairs fit one compiled aggregate.
FEW_COLUMNS = 16
#: Columns of one block of the matrices of a wide table: four of 512 × 512 numbers, 8 MB.
BLOCK_COLUMNS = 512


def _pair_sums(p: int, q: int):
    """A function over batches of p + q columns, the first p against the other q: for each pair
    the rows having both, the sums of either one's values and squares on them, and of products."""

    def add(sums: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        known = (~np.isnan(values)).astype(float)
        values = np.where(known > 0, values, 0.0)
        x, y, in_x, in_y = values[:, :p], values[:, p:], known[:, :p], known[:, p:]
        return sums + np.stack([in_x.T @ in_y, x.T @ in_y, in_x.T @ y, (x * x).T @ in_y, in_x.T @ (y * y), x.T @ y])

    return GroupFunction(lambda: np.zeros((6, p, q)), add, np.add, lambda s: _pearson(s).ravel().tolist())


def _pearson(sums: np.ndarray) -> np.ndarray:
    """Correlations from the sums of pairs; NaN where either side is constant on the common rows."""
    n, sx, sy, xx, yy, xy = sums
    with np.errstate(all="ignore"):
        x2, y2 = xx / n - (sx / n) ** 2, yy / n - (sy / n) ** 2
        # What is left of a constant's variance after rounding is no variance.
        steady = (x2 <= 1e-13 * xx / n) | (y2 <= 1e-13 * yy / n)
        return np.where(steady, np.nan, (xy / n - sx / n * sy / n) / np.sqrt(np.where(steady, 1.0, x2 * y2)))


def _wide_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """As ``correlations``, by matrix products on Arrow batches. Values are taken from the
    column's median-like value first, so large offsets do not cancel."""
    shifts = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 100).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    shifted = df.select(*[
        (F.col(c).cast("double") - F.lit(shifts[f"s{i}"] or 0.0)).alias(f"c{i}") for i, c in enumerate(columns)
    ])
    blocks = [list(range(i, min(i + BLOCK_COLUMNS, len(columns)))) for i in range(0, len(columns), BLOCK_COLUMNS)]
    parts = []
    for a, b in combinations_with_replacement(blocks, 2):
        fn = _pair_sums(len(a), len(b))
        one = apply_groups(shifted.select(*[F.col(f"c{i}").alias(f"l{i}") for i in a], *[F.col(f"c{j}").alias(f"r{j}") for j in b]), [],
                           [*[f"l{i}" for i in a], *[f"r{j}" for j in b]], fn, "r array<double>")
        cells = one.select(F.posexplode("r").alias("at", "r"))
        i, j = F.lit(a[0]) + F.floor(F.col("at") / len(b)).cast("int"), F.lit(b[0]) + F.pmod(F.col("at"), F.lit(len(b)))
        parts.append(cells.select(i.alias("i"), j.alias("j"), F.nanvl("r", F.lit(None)).alias("r")).where("i < j"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "n int, name string")
    return (
        reduce(DataFrame.unionByName, parts)
        .join(F.broadcast(names.toDF("i", "x")), "i").join(F.broadcast(names.toDF("j", "y")), "j").select("x", "y", "r")
    )


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(x, y, r) for every pair of numeric columns, on the rows where both exist.

    A few columns are one aggregate for all pairs; of more, each task takes matrix products
    of its rows, column block by column block, and these add up as a tree.
    """
    columns = list(columns or columns_of(df, "numeric"))
    if len(columns) > FEW_COLUMNS:
        return _wide_correlations(df, columns)
    pairs = list(combinations(columns, 2))
    one = df.agg(*[correlation(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"p{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*cells)))


def top_correlations(df: DataFrame, columns: Sequence[str] | None = None, n: int = 20) -> DataFrame:
    """The n pairs with the largest absolute correlation; undefined ones left out."""
    return (
        correlations(df, columns).dropna(subset=["r"])
        .orderBy(F.abs("r").desc(), "x", "y").limit(n)
    )


def date_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, first, last, days) per date column."""
    columns = list(columns or columns_of(df, "datetime"))
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.min(c).alias(f"{i}_first"), F.max(c).alias(f"{i}_last")]
    long = _rows_per_column(df.agg(*aggs), columns, ["first", "last"])
    return long.withColumn("days", F.datediff("last", "first"))


def geo_summary(df: DataFrame, latitude: str, longitude: str) -> DataFrame:
    """One row: coordinate ranges and mean centre."""
    return df.agg(
        F.min(latitude).alias("lat_min"), F.max(latitude).alias("lat_max"),
        F.min(longitude).alias("lon_min"), F.max(longitude).alias("lon_max"),
        F.avg(latitude).alias("center_lat"), F.avg(longitude).alias("center_lon"),
    )
