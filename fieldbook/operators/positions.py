"""Row numbers, rows at a rank, and the first rows of an order, for any number of rows.

Nothing here gathers rows: numbers come from counts per partition of stored rows, and the cut
of "the first n" is a key found by counting. Order columns may be of any type that Spark
orders and are compared as they are, so whole numbers beyond 2^53, text and bytes keep their
exact order. An order is a list of names, or of (name, descending) pairs; as in Spark, nulls
come first, in a descending column last.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from fieldbook.operators.running import chunk_count
from fieldbook.session import materialise

Order = Sequence[str | tuple[str, bool]]

#: Up to this many first rows are kept by each task and merged by one.
FEW_ROWS = 10_000
#: A cut is looked up among so many rows, once counting has narrowed it down to them.
SMALL = 100_000
#: Rows sampled to choose where to count; results do not depend on it.
SAMPLE = 4_096


def pairs(order: Order) -> list[tuple[str, bool]]:
    return [(o, False) if isinstance(o, str) else (o[0], o[1]) for o in order]


def sort_columns(order: Order) -> list[Column]:
    return [F.desc(name) if down else F.asc(name) for name, down in pairs(order)]


def number_rows(df: DataFrame, name: str = "position", order: Order = (), chunks: int | None = None) -> DataFrame:
    """Add each row's number from 0, in the given order, or as the rows stand.

    The rows are stored with their place in their partition; a partition's first number is
    the count of all rows before it, one number per partition from the driver. Rows that
    tie in the whole order are numbered in no particular order.
    """
    rows = df
    if order:
        by = sort_columns(order)
        rows = df.repartitionByRange(chunk_count(df, chunks), *by).sortWithinPartitions(*by)
    # The id is the partition times 2^33, plus the row's place in it.
    stored = materialise(rows.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col("_id"), 33).cast("int")
    counts = sorted((r["part"], r["n"]) for r in stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for number, n in counts:
        before.append((number, total))
        total += n
    firsts = df.sparkSession.createDataFrame(before, "_part int, _first long")
    return stored.join(F.broadcast(firsts), part == F.col("_part")).withColumn(
        name, F.col("_first") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    ).drop("_id", "_part", "_first")


def concat_by_position(
    left: DataFrame, right: DataFrame, left_order: Order = (), right_order: Order = (), how: str = "outer", suffix: str = "_right",
    name: str = "position",
) -> DataFrame:
    """The two frames side by side, row by row: ``position`` from 0, the left columns, the right ones.

    Rows are matched by their number in their order, or as they stand. Where a frame has no
    more rows its columns are null; ``how`` = "inner" ends with the shorter one. Right columns
    that are named as left ones get the suffix. Numbers are distinct, so the join spreads
    evenly whatever the frames hold.
    """
    taken = {c.lower() for c in left.columns} | {name.lower()}
    renamed = right.withColumnsRenamed({c: c + suffix for c in right.columns if c.lower() in taken})
    right_order = [(c + suffix if c.lower() in taken else c, down) for c, down in pairs(right_order)]
    return number_rows(left, name, left_order).join(number_rows(renamed, name, right_order), name, how)


def is_before(order: Order, key: Sequence) -> Column:
    """Whether a row comes before a key in the order."""
    out, equal = F.lit(False), F.lit(True)
    for (name, down), value in zip(pairs(order), key):
        c = F.col(name)
        if value is None:
            here = c.isNotNull() if down else F.lit(False)
        elif down:
            here = F.coalesce(c > F.lit(value), F.lit(False))
        else:
            here = c.isNull() | F.coalesce(c < F.lit(value), F.lit(False))
        out = out | (equal & here)
        equal = equal & c.eqNullSafe(F.lit(value))
    return out


def is_at(order: Order, key: Sequence) -> Column:
    """Whether a row has the key's values in all order columns."""
    return reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.lit(v)) for (name, _), v in zip(pairs(order), key)], F.lit(True))


def cut_at(df: DataFrame, order: Order, n: int) -> tuple[Row, int] | None:
    """The order columns' values of the n-th row (from 1), and the number of rows strictly
    before those values; None if there are fewer rows.

    A sample suggests two keys around the rank; the rows before, between and after them are
    counted exactly, and the search goes on among those that hold the rank. A few passes
    leave at most SMALL rows, or rows that are all equal in the order.
    """
    inside = df.select(*[name for name, _ in pairs(order)])
    size, before, seed, narrow = inside.count(), 0, 1, True
    if not 1 <= n <= size:
        return None
    while size > SMALL:
        seed += 1
        drawn = inside.sample(min(1.0, SAMPLE / size), seed).orderBy(*sort_columns(order)).limit(2 * SAMPLE).collect()
        if not drawn:
            continue
        at = (n - before) / size * len(drawn)
        reach = 3 * math.sqrt(len(drawn)) if narrow else 0
        low, high = (drawn[min(len(drawn) - 1, max(0, int(x)))] for x in (at - reach, at + reach))
        upto = is_before(order, high) | is_at(order, high)
        first, second = inside.agg(F.count_if(is_before(order, low)), F.count_if(upto)).first()
        rank = n - before
        if rank <= first:
            inside, left = inside.where(is_before(order, low)), first
        elif rank > second:
            inside, left, before = inside.where(~upto), size - second, before + second
        elif low == high:
            return low, before + first
        else:
            inside, left, before = inside.where(upto & ~is_before(order, low)), second - first, before + first
        # Many equal keys can hold both ends in place; one key in the middle then parts the rows.
        narrow, size = left < size / 2, left
    key = inside.orderBy(*sort_columns(order)).limit(n - before).tail(1)[0] if n - before <= FEW_ROWS else (
        inside.orderBy(*sort_columns(order)).offset(n - before - 1).limit(1).first()
    )
    return key, before + inside.where(is_before(order, key)).count()


def first_rows(df: DataFrame, order: Order, n: int) -> DataFrame:
    """The first n rows in the order, as a set; all rows if there are fewer.

    A large n is a filter at the cut found by ``cut_at``; of rows that tie with the last one
    in the whole order, as many as fit. Rows are neither sorted nor brought together. The
    frame is read several times, so store it first if it is costly or not repeatable.
    """
    if n <= FEW_ROWS:
        return df.orderBy(*sort_columns(order)).limit(max(n, 0))
    found = cut_at(df, order, n)
    if found is None:
        return df
    key, before = found
    ties = df.where(is_at(order, key))
    whole = df.where(is_before(order, key) | is_at(order, key))
    if ties.count() == n - before:
        return whole
    some = number_rows(ties, "_number").where(F.col("_number") < n - before).drop("_number")
    return df.where(is_before(order, key)).unionByName(some)
