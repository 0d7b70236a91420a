"""Exact order statistics that never put a whole group into one task.

Built-in ``percentile``/``median`` hold every distinct value of a group in one
aggregation buffer. Here a bounded sketch first brackets each wanted rank; all
values outside the brackets collapse onto their edge in the map-side combine,
and only the bracketed sliver of a group is sorted. Counts are exact
everywhere, so the result is exact as well. Slivers of more than ``RANK_ROWS``
values are ranked in chunks, and a bracket that missed its rank is widened.

Plan parameters: ``SMALL_INPUT``, ``SMALL_GROUP`` and ``RANK_ROWS`` choose between
plans, not between results; ``tools/check_queries.py --tight`` runs all queries with
plans as for large inputs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldbook.operators.running import running_totals
from fieldbook.session import attach_groups, estimated_bytes, materialise

ACCURACY = 10_000
# Groups up to this size are ranked whole: the sketch's error would be below a few ranks.
SMALL_GROUP = 4 * ACCURACY
# Below this plan size the sketch pass costs more than it saves.
SMALL_INPUT = 16 * 1024 * 1024
# More values than this are not ranked by one task.
RANK_ROWS = 1_000_000

Position = Callable[[Column], Column]


def _brackets(fractions: Sequence[float], margin: float) -> list[tuple[float, float]]:
    spans: list[tuple[float, float]] = []
    for p in sorted(set(fractions)):
        low, high = max(0.0, p - margin), min(1.0, p + margin)
        if spans and low <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
        else:
            spans.append((low, high))
    return spans


def _collapsed(
    value: Column, edges: Column | Sequence[Column], whole: Column, spans: int
) -> tuple[Column, Column]:
    """(value, gap): gap 0 inside a bracket, else the nearest edge with a non-zero gap."""
    out, gap = edges[0], F.lit(-1)
    for i in range(spans):
        low, high = edges[2 * i], edges[2 * i + 1]
        out = F.when(value > high, high).when(value >= low, value).otherwise(out)
        gap = F.when(value > high, 1).when(value >= low, 0).otherwise(gap)
    keep = value.isNull() | whole
    return F.when(keep, value).otherwise(out), F.when(keep, 0).otherwise(gap)


def order_statistics(
    df: DataFrame,
    columns: Sequence[str],
    targets: Sequence[tuple[float, Position]],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
    bracket: bool | None = None,
    spans: Sequence[tuple[float, float]] | None = None,
    small_group: int | None = None,
) -> DataFrame:
    """Values at (possibly fractional) 0-based rank positions, per group.

    ``targets`` pairs an approximate fraction with a function of the group's
    non-null count giving the exact position. The result has the ``by`` columns
    and, per input column, an array of doubles in target order. Rows whose key
    is null are left out. ``bracket`` forces or skips the sketch pass; by
    default the plan's estimated size decides. ``spans`` replaces the brackets
    around the fractions, for positions that spread around them.
    """
    small_group = SMALL_GROUP if small_group is None else small_group
    if bracket is None:
        bracket = estimated_bytes(df.select(*by, *columns)) > SMALL_INPUT
    if not bracket:
        return _statistics(df, columns, targets, by, accuracy, None, small_group, False).drop("_missed")
    spans = list(spans) if spans else _brackets([p for p, _ in targets], 2.0 / accuracy)
    for wider in (0.0, 0.01, 0.1, None):
        around = wider if wider is None else [(max(0.0, a - wider), min(1.0, b + wider)) for a, b in spans]
        found = materialise(_statistics(df, columns, targets, by, accuracy, around, small_group), "ranks")
        if around is None or not found.where("_missed").limit(1).count():
            return found.drop("_missed")


def _statistics(
    df: DataFrame, columns: Sequence[str], targets: Sequence[tuple[float, Position]], by: Sequence[str],
    accuracy: int, spans: list[tuple[float, float]] | None, small_group: int, chunked: bool = True,
) -> DataFrame:
    """As order_statistics, with ``_missed``: whether a rank fell outside its bracket."""
    by = list(by)
    data = df.select(
        *by, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)]
    )
    if by:
        data = data.dropna(subset=by)
    if spans is not None:
        marks = F.array(*[F.lit(float(x)) for span in spans for x in span])
        sketches = []
        for i in range(len(columns)):
            sketches += [
                F.count(f"_v{i}").alias(f"_n{i}"),
                F.percentile_approx(f"_v{i}", marks, accuracy).alias(f"_e{i}"),
            ]
        if by:
            # Only large groups need brackets, at most one per small_group rows.
            large = data.groupBy(*by).agg(*sketches).filter(
                F.greatest(*[F.col(f"_n{i}") for i in range(len(columns))], F.lit(0)) > small_group
            )
            data = attach_groups(data, large, by, "left")
            known = [
                (F.col(f"_e{i}"), F.coalesce(F.col(f"_n{i}"), F.lit(0)) <= small_group)
                for i in range(len(columns))
            ]
        else:
            # One row of a few numbers: brought back once, then literals in the scan.
            row = data.agg(*sketches).first()
            known = [
                (
                    [F.lit(x).cast("double") for x in row[f"_e{i}"] or [None] * (2 * len(spans))],
                    F.lit(row[f"_n{i}"] <= small_group),
                )
                for i in range(len(columns))
            ]
        cells = [
            _collapsed(F.col(f"_v{i}"), edges, whole, len(spans))
            for i, (edges, whole) in enumerate(known)
        ]
    else:
        cells = [(F.col(f"_v{i}"), F.lit(0)) for i in range(len(columns))]

    flat = data.select(
        *by,
        *[x.alias(f"_x{i}") for i, (x, _) in enumerate(cells)],
        *[g.alias(f"_g{i}") for i, (_, g) in enumerate(cells)],
    )
    if len(cells) == 1:
        cells_long = flat.select(*by, F.lit(0).alias("_col"), F.col("_x0").alias("_value"), F.col("_g0").alias("_gap"))
    else:
        rows = ", ".join(f"{i}, _x{i}, _g{i}" for i in range(len(cells)))
        cells_long = flat.select(*by, F.expr(f"stack({len(cells)}, {rows}) AS (_col, _value, _gap)"))

    counts = cells_long.groupBy(*by, "_col", "_value", "_gap").agg(F.count("_value").alias("_k"))
    ranked = _ranked(counts, [*by, "_col"], chunked)

    picks, finals, misses = [], [], []
    for i, column in enumerate(columns):
        values = []
        mine = (F.col("_col") == i) & (F.col("_n") > 0)
        for j, (_, position) in enumerate(targets):
            at = position(F.col("_n").cast("double"))
            before = F.col("_cum") - F.col("_k")
            missed = F.lit(False)
            for rank in (F.floor(at), F.ceil(at)):
                missed = missed | ((F.col("_gap") != 0) & (F.col("_cum") > rank) & (before <= rank))
            picks += [
                F.min(F.when(mine & (F.col("_cum") > F.floor(at)), F.col("_value"))).alias(f"_a{i}_{j}"),
                F.min(F.when(mine & (F.col("_cum") > F.ceil(at)), F.col("_value"))).alias(f"_b{i}_{j}"),
                F.max(F.when(mine, at - F.floor(at))).alias(f"_f{i}_{j}"),
                F.max(mine & missed).alias(f"_m{i}_{j}"),
            ]
            low, high, part = F.col(f"_a{i}_{j}"), F.col(f"_b{i}_{j}"), F.col(f"_f{i}_{j}")
            values.append(low + part * (high - low))
            misses.append(F.coalesce(F.col(f"_m{i}_{j}"), F.lit(False)))
        finals.append(F.array(*values).alias(column))
    return ranked.groupBy(*by).agg(*picks).select(*by, *finals, F.array_contains(F.array(*misses), True).alias("_missed"))


def _ranked(counts: DataFrame, group: list[str], chunked: bool) -> DataFrame:
    """Counted values with ``_cum``, the number of values up to each, and ``_n``, the group's.

    A group's values are ranked by one task only if there are at most RANK_ROWS of all groups;
    more are ranked in chunks of about that many."""
    if chunked:
        counts = materialise(counts, "rank-cells")
        chunks = -(-counts.count() // RANK_ROWS)
        if chunks > 1:
            summed = running_totals(counts, "_k", ["_value", "_gap"], group, chunks).withColumnRenamed("running_sum", "_cum")
            return attach_groups(summed.drop("running_n"), counts.groupBy(*group).agg(F.sum("_k").alias("_n")), group)
    whole = Window.partitionBy(*group)
    running = whole.orderBy("_value", "_gap").rowsBetween(Window.unboundedPreceding, 0)
    return counts.select("*", F.sum("_k").over(running).alias("_cum"), F.sum("_k").over(whole).alias("_n"))


def linear_position(p: float) -> Position:
    """Position of the linearly interpolated p-quantile."""
    return lambda n: (n - 1) * F.lit(float(p))


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    bracket: bool | None = None,
    **extra: Column,
) -> DataFrame:
    """Linearly interpolated quantiles: ``by`` columns, one array per column, and any
    ``extra`` aggregates, taken in the same pass.

    A plan whose estimated size fits one task comfortably uses the built-in
    ``percentile``; anything larger goes through the bracketed selection.
    """
    by = list(by)
    if bracket is None:
        bracket = estimated_bytes(df.select(*by, *columns)) > SMALL_INPUT
    if not bracket:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        rows = df.dropna(subset=by) if by else df
        return rows.groupBy(*by).agg(
            *[F.percentile(F.col(c).cast("double"), wanted).alias(c) for c in columns],
            *[a.alias(name) for name, a in extra.items()],
        )
    targets = [(p, linear_position(p)) for p in probs]
    found = order_statistics(df, columns, targets, by, bracket=True)
    if not extra:
        return found
    others = [a.alias(name) for name, a in extra.items()]
    if by:
        return found.join(df.dropna(subset=by).groupBy(*by).agg(*others), by)
    return found.withColumn("_x", df.agg(F.struct(*others)).scalar()).select(
        *columns, *[F.col("_x")[name].alias(name) for name in extra]
    )


def medians(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bracket: bool | None = None, **extra: Column
) -> DataFrame:
    """Median per column, as plain doubles under the input names, with ``extra`` aggregates."""
    out = quantiles(df, columns, [0.5], by, bracket=bracket, **extra)
    return out.select(*by, *[F.col(c)[0].alias(c) for c in columns], *extra)


def top_share(df: DataFrame, column: str, fraction: float, bracket: bool | None = None) -> DataFrame:
    """Share of the column's total held by its largest ``floor(n * fraction)`` values.

    The cut value comes from rank selection; ties at the cut count only as often
    as they fit, so no global sort or numbering is needed. One row:
    ``n, k, top_sum, total, share``.
    """
    cut = order_statistics(
        df,
        [column],
        [(1.0 - fraction, lambda n: F.greatest(n - F.greatest(F.floor(n * fraction), F.lit(1)), F.lit(0)))],
        bracket=bracket,
    ).select(F.col(column)[0].alias("cut"))
    value = F.col(column).cast("double")
    sums = df.select(value.alias("v")).withColumn("cut", cut.scalar()).agg(
        F.count("v").alias("n"),
        F.sum("v").alias("total"),
        F.count_if(F.col("v") > F.col("cut")).alias("above"),
        F.coalesce(F.sum(F.when(F.col("v") > F.col("cut"), F.col("v"))), F.lit(0.0)).alias("above_sum"),
        F.max("cut").alias("cut"),
    )
    k = F.floor(F.col("n") * fraction)
    top = F.when(k == 0, F.lit(0.0)).otherwise(
        F.col("above_sum") + (k - F.col("above")) * F.col("cut")
    )
    return sums.select(
        "n", k.cast("long").alias("k"), top.alias("top_sum"), "total",
        F.try_divide(top, F.col("total")).alias("share"),
    )
