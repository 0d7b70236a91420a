"""Names, text, dates, duplicates and nulls: the preparation steps of a table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.text import strip, title_case
from fieldbook.operators.shaping import columns_of, present


def tidy_name(name: str) -> str:
    """Lower-case name with whitespace runs as one underscore and only word characters."""
    return re.sub(r"\W", "", re.sub(r"\s+", "_", name.strip())).lower()


def tidy_columns(df: DataFrame) -> DataFrame:
    """Rename all columns with :func:`tidy_name`; two columns may not become one."""
    names = [tidy_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after tidying: {clashes}")
    return df.toDF(*names)


def drop_listed(df: DataFrame, names: Sequence[str], raw_names: bool = False) -> DataFrame:
    """Drop the listed columns that exist. Names match after tidying unless ``raw_names``."""
    if raw_names:
        return df.drop(*present(df, names))
    wanted = {tidy_name(n) for n in names}
    return df.drop(*[c for c in df.columns if tidy_name(c) in wanted])


def strip_text(df: DataFrame, title: bool = False) -> DataFrame:
    """Trim every text column, with title case on request; other columns are untouched."""
    clean = (lambda c: title_case(strip(c))) if title else strip
    text = columns_of(df, "text")
    return df.withColumns({c: clean(F.col(c)) for c in text}) if text else df


def to_timestamp_any(column: Column, formats: Sequence[str]) -> Column:
    """Parse text with the first format that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(column, F.lit(f)) for f in formats])


def parse_rates(df: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> DataFrame:
    """One row: per column the share of all rows that parse as a date."""
    return df.agg(
        *[
            F.avg(to_timestamp_any(F.col(c), formats).isNotNull().cast("double")).alias(c)
            for c in columns
        ]
    )


def promote_dates(
    df: DataFrame,
    formats: Sequence[str],
    hints: Sequence[str],
    min_rate: float = 0.5,
    listed: Sequence[str] = (),
) -> DataFrame:
    """Turn text columns into timestamps: listed ones always, hinted ones when
    more than ``min_rate`` of the rows parse (one aggregate decides for all)."""
    text = columns_of(df, "text")
    chosen = [c for c in text if c in listed]
    hinted = [c for c in text if c not in chosen and any(h in c.lower() for h in hints)]
    if hinted:
        rates = parse_rates(df, hinted, formats).first()
        chosen += [c for c in hinted if rates[c] is not None and rates[c] > min_rate]
    return df.withColumns({c: to_timestamp_any(F.col(c), formats) for c in chosen}) if chosen else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make NaN null in floating columns, so aggregates skip it."""
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row of null counts, one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def null_mask(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """1 where a cell is null, else 0."""
    return df.select(
        *keep, *[F.col(c).isNull().cast("int").alias(c) for c in df.columns if c not in keep]
    )


def null_map(df: DataFrame, key: str, buckets: int, columns: Sequence[str]) -> DataFrame:
    """Nulls per (equal-width key bucket, column): the table behind a null heat map."""
    span = df.agg(F.struct(F.min(key).alias("lo"), F.max(key).alias("hi"))).scalar()
    k, lo, hi = F.col(key).cast("double"), F.col("_s.lo").cast("double"), F.col("_s.hi").cast("double")
    bucket = F.least(F.floor(F.try_divide((k - lo) * buckets, hi - lo)), F.lit(buckets - 1))
    counted = (
        df.withColumn("_s", span).withColumn("bucket", F.coalesce(bucket, F.lit(0)))
        .groupBy("bucket").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    )
    return counted.unpivot("bucket", list(columns), "column", "nulls")


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Keep only the columns without nulls; one aggregate finds them."""
    nulls = null_counts(df).first()
    return df.select(*[c for c in df.columns if not nulls[c]])


def clip(column: Column, lower: object = None, upper: object = None) -> Column:
    """Limit values to a range; null stays null."""
    out = column
    if upper is not None:
        out = F.least(out, upper if isinstance(upper, Column) else F.lit(upper))
    if lower is not None:
        out = F.greatest(out, lower if isinstance(lower, Column) else F.lit(lower))
    return F.when(column.isNotNull(), out)
