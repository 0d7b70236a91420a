"""Projection, filtering, ordering, joins and set operations that need more than
one DataFrame call to get right."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldbook.operators.positions import cut_at, first_rows, is_at

KINDS = {
    "numeric": (T.NumericType,),
    "text": (T.StringType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
    "boolean": (T.BooleanType,),
}


def columns_of(df: DataFrame, *kinds: str) -> list[str]:
    """Names of the columns whose type is of one of the given kinds."""
    types = tuple(t for kind in kinds for t in KINDS[kind])
    return [f.name for f in df.schema if isinstance(f.dataType, types)]


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The given names that exist in the frame; operators skip the others."""
    return [n for n in names if n in df.columns]


def row_at(df: DataFrame, position: int, key: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row at a 0-based position in the order of a key, rows of equal keys in the order of
    ``ties``; rows without a key are left out.

    The key's value at that rank is found by counting, so a deep position neither
    sorts the table into one task nor ships it to the driver.
    """
    rows, order = df.filter(F.col(key).isNotNull()), [key, *[t for t in ties if t != key]]
    found = cut_at(rows, order, position + 1) if position >= 0 else None
    return rows.limit(0) if found is None else rows.filter(is_at(order, found[0])).limit(1)


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """A reproducible sample of n rows: the n smallest seeded hashes of the key, for any n."""
    tag = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return first_rows(df.withColumn("_tag", tag), ["_tag", key], n).drop("_tag")


def top_groups(
    df: DataFrame, keys: Sequence[str], metric: Column, n: int, descending: bool = True,
    name: str = "metric",
) -> DataFrame:
    """The n groups with the largest (or smallest) aggregate; ties fall to the key order."""
    order = F.desc(name) if descending else F.asc(name)
    return (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(metric.alias(name))
        .orderBy(order, *keys).limit(n)
    )


def keep_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in the frame of groups (a semi join)."""
    return df.join(groups.select(*keys), list(keys), "left_semi")


def align_to(keys: DataFrame, values: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every given key with its values, null where there are none."""
    return keys.join(values, list(on), "left")


def stack_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Append frames by column name; a missing column becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_of_filters(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One copy of a row per condition it meets, labelled with the condition.

    A single scan: each row explodes into the labels that hold.
    """
    labels = F.array_compact(
        F.array(*[F.when(cond, F.lit(label)) for label, cond in conditions.items()])
    )
    return df.withColumn("matched", F.explode(labels))


def largest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each group; the rank limit also applies before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
