"""Running computations that do not need a group's rows in one task.

Rows are cut into chunks at range boundaries of the order columns, so a chunk
holds about the same number of rows however skewed the keys are. Work inside
(key, chunk) is an ordinary window; what a chunk inherits from the ones before
it comes from one small row per (key, chunk).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldbook.session import ROW_GROUP, attach_groups, materialise, scanned_bytes

CHUNK_BYTES = 128 * 1024 * 1024
# Without keys a chunk is all that one task has to do, so chunks are smaller.
LONE_CHUNK_BYTES = 8 * 1024 * 1024


def chunk_count(df: DataFrame, chunks: int | None = None, most: int | None = None) -> int:
    """The number given, or one that follows the size of the tables below (chunks of ``most`` bytes),
    or the session's shuffle partitions where a size is not known."""
    if chunks is not None:
        return chunks
    size = scanned_bytes(df)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if size is None else 1 + size // (most or CHUNK_BYTES)


def with_chunks(df: DataFrame, order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """Add ``_chunk``, increasing with the order columns, nulls first as in a window.

    The cuts are those of a range partitioning, so order columns may be of any type,
    and rows that tie in the first one are cut by the next. The numbered rows are
    stored, as the cuts come from a sample and must be the same in every use.
    """
    numbered = df.repartitionByRange(chunk_count(df, chunks), *order).withColumn("_chunk", F.spark_partition_id())
    return materialise(numbered, "chunks", ROW_GROUP)


def _before(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)



def _up_to_here(by: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def _with_inherited(rows: DataFrame, per_chunk: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Attach each chunk's inherited values to its rows."""
    right = per_chunk.select(*[F.col(b).alias(f"_k_{b}") for b in by], F.col("_chunk").alias("_k_chunk"), *names)
    cond = F.col("_chunk") == F.col("_k_chunk")
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"_k_{b}"))
    return rows.join(right, cond).drop("_k_chunk", *[f"_k_{b}" for b in by])


def carry_all_forward(
    df: DataFrame, columns: Sequence[str], order: Sequence[str], by: Sequence[str] = (), chunks: int | None = None
) -> DataFrame:
    """Add ``carried_0``, ``carried_1`` ... : each column's value or the latest non-null one before it.

    All columns share one range shuffle and one stored copy of the rows.
    """
    by, columns = list(by), list(columns)
    chunks = chunk_count(df, chunks, None if by else min(CHUNK_BYTES, LONE_CHUNK_BYTES))
    if chunks <= 1:
        here = _up_to_here(by, order)
        return df.withColumns({f"carried_{i}": F.last(c, ignorenulls=True).over(here) for i, c in enumerate(columns)})
    rows = with_chunks(df, order, chunks)
    # max_by skips rows whose ordering is null, here those without a value.
    place = F.struct(*order)
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_last{i}") for i, c in enumerate(columns)]
    before, names = _before(by), [f"_inherited{i}" for i in range(len(columns))]
    inherited = rows.groupBy(*by, "_chunk").agg(*latest).withColumns(
        {name: F.last(f"_last{i}", ignorenulls=True).over(before) for i, name in enumerate(names)}
    )
    local = _up_to_here([*by, "_chunk"], order)
    return _with_inherited(rows, inherited, by, names).withColumns({
        f"carried_{i}": F.coalesce(F.last(c, ignorenulls=True).over(local), F.col(names[i])) for i, c in enumerate(columns)
    }).drop(*names, "_chunk")


def carry_forward(
    df: DataFrame, column: str, order: Sequence[str], by: Sequence[str] = (), chunks: int | None = None
) -> DataFrame:
    """Add ``carried``: the value itself or the latest non-null one before it."""
    return carry_all_forward(df, [column], order, by, chunks).withColumnRenamed("carried_0", "carried")


def running_totals(
    df: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = (), chunks: int | None = None
) -> DataFrame:
    """Add ``running_n`` and ``running_sum`` up to and including each row."""
    by = list(by)
    if chunk_count(df, chunks) <= 1:
        here = _up_to_here(by, order)
        total = F.coalesce(F.sum(value).over(here), F.lit(0))
        return df.withColumns({"running_n": F.count(F.lit(1)).over(here), "running_sum": total})
    rows = with_chunks(df, order, chunks)
    per_chunk = rows.groupBy(*by, "_chunk").agg(
        F.count("*").alias("_n"), F.sum(value).alias("_sum")
    )
    inherited = per_chunk.select(
        *by, "_chunk",
        F.coalesce(F.sum("_n").over(_before(by)), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_sum").over(_before(by)), F.lit(0)).alias("_sum0"),
    )
    local = _up_to_here([*by, "_chunk"], order)
    return (
        _with_inherited(rows, inherited, by, ["_n0", "_sum0"])
        .withColumn("running_n", F.col("_n0") + F.count(F.lit(1)).over(local))
        .withColumn("running_sum", F.col("_sum0") + F.coalesce(F.sum(value).over(local), F.lit(0)))
        .drop("_n0", "_sum0", "_chunk")
    )


def limit_ledger(
    df: DataFrame, account: str, amount: str, order: Sequence[str],
    max_count: int, max_total: float, chunks: int | None = None,
) -> DataFrame:
    """Accept an account's transactions until one breaks the count or total limit.

    The first breach is rejected with its reason (the count limit is tested
    first) and ends the account's session: later rows are rejected as well. Rows
    without an account share one.
    """
    running = running_totals(df, amount, order, [account], chunks)
    over_count = F.col("running_n") > max_count
    over_total = F.col("running_sum") > max_total
    place = F.struct(*order)
    running = materialise(running, "ledger")  # read twice: for the first breach and for the rows
    first = running.filter(over_count | over_total).groupBy(account).agg(F.min(place).alias("_first"))
    joined = attach_groups(running, first, [account], "left")
    accepted = F.col("_first").isNull() | (place < F.col("_first"))
    reason = (
        F.when(accepted, F.lit("accepted"))
        .when(place > F.col("_first"), F.lit("session ended"))
        .when(over_count, F.lit("count limit passed"))
        .otherwise(F.lit("total limit passed"))
    )
    return joined.withColumn("accepted", accepted.cast("int")).withColumn("reason", reason).drop("_first")


def share_of_total(df: DataFrame, metric: str, name: str = "share") -> DataFrame:
    """Add each row's share of the metric's total; for aggregated rows of any number."""
    total = df.agg(F.sum(metric)).scalar()
    return df.withColumn(name, F.try_divide(F.col(metric), total))
