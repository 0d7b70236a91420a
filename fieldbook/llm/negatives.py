"""Hard negatives by a vertical scan with branch and bound (BOND).

Rows stand in blocks stored by dimension. For an anchor, the dimensions are read in order of
the anchor's magnitude, largest first, so the partial inner products settle early. What the
dimensions still unread can add to a row lies between the sums of their smallest and largest
contributions, taken from each dimension's minimum and maximum in the block. Rows that
cannot reach what is asked for leave the block's set of candidates; when all dimensions are
read, the scores of the rows left are exact.

The scan is used twice. First it looks for each anchor's positives, the best rows of its own
label: a row stays while it can still be among the best few. The positives' scores give
windows, and the second scan keeps the rows of other labels that can still lie in one of
them.

Anchors go to the rows, not the reverse: they are taken in waves of at most ``WAVE_BYTES``,
the one thing sent to every task, and each wave passes over all rows, which stay where they
are. A task keeps the best few of each anchor over all its blocks and hands those on, so what
is shuffled is a few rows per anchor and task. Every pair of an anchor and a row is decided;
blocks bound memory, not results. The number of waves grows with the number of anchors, as
the work does: anchors are a share of the rows, and each is held against all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldbook.llm.common import mapped
from fieldbook.session import materialise, scratch_path

#: Bytes of the vectors of one wave of anchors.
WAVE_BYTES = 32 * 1024 * 1024
#: Most rows of a block.
BLOCK = 16384
#: Dimensions read between two looks at the bounds: many first, while bounds are wide.
STEPS = (0.25, 0.375, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


@dataclass(frozen=True)
class Wave:
    """Anchors: ids, labels, and vectors with the dimensions as columns."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


class Block:
    """Rows sorted by label, stored by dimension, with each dimension's bounds."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.repeats = len(np.unique(ids)) < len(ids)

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))


def vertical_scan(block: Block, query: np.ndarray, rows: np.ndarray | slice, keep) -> tuple[np.ndarray, np.ndarray]:
    """Places in the block, and exact scores, of the rows that ``keep`` let through.

    rows: the candidates to begin with. keep(least, most): which of the candidates may still
    be wanted, given the least and greatest score each can have.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    q = query[order]
    a, b = q * block.low[order], q * block.high[order]
    most_left = np.concatenate([np.cumsum(np.maximum(a, b)[::-1])[::-1], [0.0]])
    least_left = np.concatenate([np.cumsum(np.minimum(a, b)[::-1])[::-1], [0.0]])
    place = np.arange(len(block.ids))[rows]
    whole = isinstance(rows, slice)
    score = np.zeros(len(place))
    read = 0
    for to in sorted({max(1, round(s * len(q))) for s in STEPS}) if len(q) else ():
        if not len(place):
            break
        chosen = order[read:to]
        part = block.columns[chosen, rows] if whole else block.columns[np.ix_(chosen, place)]
        score = score + q[read:to] @ part
        read = to
        stay = keep(score + least_left[read], score + most_left[read])
        if not stay.all():
            place, score, whole = place[stay], score[stay], False
    return place, score


def first_distinct(ids: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n by falling score, then rising id; a pair of id and score counts once."""
    if len(ids) > 8 * n:  # only what reaches the score of some n different ids can be among them
        cut = np.partition(scores, len(scores) - 4 * n)[len(scores) - 4 * n]
        top = scores >= cut
        if len(np.unique(ids[top])) >= n:
            ids, scores = ids[top], scores[top]
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])
    return ids[new][:n], scores[new][:n]


class Positives:
    """The best rows of its own label for each anchor, over the blocks of a task."""

    def __init__(self, wave: Wave, n: int):
        self.wave, self.n = wave, n
        self.best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in wave.ids]

    def add(self, block: Block) -> None:
        for k, (anchor, label) in enumerate(zip(self.wave.ids, self.wave.labels)):
            begin, end = block.of_label(label)
            if begin == end:
                continue
            ids, scores = self.best[k]
            known = scores[-1] if len(scores) == self.n else -np.inf

            def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
                floor = known
                if not block.repeats and len(least) > self.n + 1:  # n others of the block, beside the anchor itself, reach this
                    floor = max(floor, np.partition(least, -self.n - 1)[-self.n - 1])
                return most >= floor

            place, score = vertical_scan(block, self.wave.vectors[k], slice(begin, end), keep)
            other = block.ids[place] != anchor
            if other.any():
                self.best[k] = first_distinct(np.concatenate([ids, block.ids[place][other]]), np.concatenate([scores, score[other]]), self.n)

    def rows(self) -> Iterator[tuple[int, int, float]]:
        for anchor, (ids, scores) in zip(self.wave.ids.tolist(), self.best):
            yield from ((anchor, i, s) for i, s in zip(ids.tolist(), scores.tolist()))


class Negatives:
    """For each anchor and positive, the best rows of other labels within the positive's
    window, over the blocks of a task.

    windows: per anchor the positives (ids, scores)."""

    def __init__(self, wave: Wave, windows: list[tuple[np.ndarray, np.ndarray]], n: int, share: tuple[int, int]):
        self.wave, self.windows, self.n, self.share = wave, windows, n, share
        self.best = [[(np.zeros(0, np.int64), np.zeros(0))] * len(ids) for ids, _ in windows]

    def add(self, block: Block) -> None:
        low, high = self.share
        for k, label in enumerate(self.wave.labels):
            scores = self.windows[k][1]
            if not len(scores):
                continue
            begin, end = block.of_label(label)
            # A window may ask for more than its share: the score of its last row, once it is full.
            floor = [max(low * s / 100, b[-1] if len(b) == self.n else -np.inf) for s, (_, b) in zip(scores, self.best[k])]
            least, top = min(floor), high * scores.max() / 100
            if least > top:
                continue
            rows = slice(None) if begin == end else np.r_[0:begin, end : len(block.ids)]
            slack = 1e-6 * max(1.0, abs(top))  # bounds only prune; the window itself is checked in whole numbers below
            place, score = vertical_scan(
                block, self.wave.vectors[k], rows, lambda lo, hi: (hi >= least - slack) & (lo <= top + slack)
            )
            if not len(place):
                continue
            ids = block.ids[place]
            for j, s in enumerate(scores):
                inside = (low * s <= 100 * score) & (100 * score <= high * s)
                if inside.any():
                    known = self.best[k][j]
                    self.best[k][j] = first_distinct(np.concatenate([known[0], ids[inside]]), np.concatenate([known[1], score[inside]]), self.n)

    def rows(self) -> Iterator[tuple[int, int, float, int, float]]:
        for anchor, (positives, scores), best in zip(self.wave.ids.tolist(), self.windows, self.best):
            for positive, s, (ids, found) in zip(positives.tolist(), scores.tolist(), best):
                yield from ((anchor, positive, s, i, x) for i, x in zip(ids.tolist(), found.tolist()))


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Lists of numbers as rows of ``dims`` columns; shorter lists are filled with zeros."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == dims).all():
        return values.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims))
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    fits = column < dims
    out[row[fits], column[fits]] = values[fits]
    return out


def _passed(rows: DataFrame, dims: int, make, schema: str) -> DataFrame:
    """Each task's rows block by block through the gatherer that ``make`` returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gatherer = make()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                gatherer.add(Block(part.column(0).to_numpy(), part.column(1).to_numpy(), matrix(part.column(2), dims)))
        columns = list(zip(*gatherer.rows()))
        if columns:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f"c{i}" for i in range(len(columns))])

    names = schema.split(", ")
    found = mapped(rows, run, ", ".join(f"c{i} {n.split()[1]}" for i, n in enumerate(names)))
    return found.toDF(*[n.split()[0] for n in names])


def hard_negatives(
    embeddings: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, share: tuple[int, int] = (50, 95), scale: int = 256,
    wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Per anchor, the first ``positives`` other rows of its label by falling score, and for each
    of them the first ``negatives`` rows of other labels whose score is ``share`` per cent of
    the positive's (share[0] * positive <= 100 * negative <= share[1] * positive), with rank
    from 1. A score is the inner product of floor(scale * component); equal scores are ordered
    by the smaller vec_id. anchors: a condition on vec_id that chooses them.

    Rows without an id, label or vector, or with a null or non-finite component, take no
    part. A row with the anchor's id is no other row; a pair of vec_id and score counts once
    however often it is repeated. If rows with different labels or vectors share an anchor's
    id, the smallest (label, vector) is the anchor. Components that a shorter vector lacks
    count as zero. Scores are exact below 2^53, rounded beyond, and held to the range of long. An anchor without positives, and a positive
    without rows in its window (always so below zero), give no row; an empty table gives an
    empty one. Other columns are not read.
    """
    spark = embeddings.sparkSession
    x = F.col("vector")
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform(F.col("embedding"), lambda v: v.cast("double")).alias("vector"),
    ).dropna().where(finite)
    rows = rows.withColumn("vector", F.transform(x, lambda v: _floored(v * scale)))
    rows = materialise(rows, "vectors")
    chosen = rows.where(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    chosen = materialise(chosen.select("vec_id", "row.label", "row.vector"), "anchors")
    dims, n = (v or 0 for v in rows.agg(F.max(F.size("vector")), F.count("*")).first())
    per_wave = max(1, wave_bytes // (8 * max(1, dims)))
    path, last, schema = scratch_path(spark, "negatives"), None, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    while n:
        after = chosen if last is None else chosen.where(F.col("vec_id") > last)
        taken = after.orderBy("vec_id").limit(per_wave).toArrow().combine_chunks()
        if not taken.num_rows:
            break
        last = taken.column("vec_id")[-1].as_py()
        wave = Wave(taken.column("vec_id").to_numpy(), taken.column("label").to_numpy(), matrix(taken.column("vector").combine_chunks(), dims))
        _mined(rows, dims, wave, positives, negatives, share).write.mode("append").parquet(path)
        if taken.num_rows < per_wave:
            break
    return spark.read.schema(schema).parquet(path)


def _floored(x: Column) -> Column:
    """Rounded down, as double; from 2^53 on every double is whole."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def _as_long(x: Column) -> Column:
    most = 2**63 - 1
    return F.when(x >= float(most), F.lit(most)).when(x <= float(-most), F.lit(-most - 1)).otherwise(x.cast("long"))


def _first(found: DataFrame, keys: list[str], by: str, then: str, n: int) -> DataFrame:
    """The first n distinct rows of each key, by falling score, then rising id, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc(by), then)
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _mined(rows: DataFrame, dims: int, wave: Wave, positives: int, negatives: int, share: tuple[int, int]) -> DataFrame:
    """The result for one wave of anchors."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((wave.ids, wave.labels, wave.vectors))
    near = _passed(rows, dims, lambda: Positives(Wave(*sent.value), positives), "anchor_id long, positive_id long, score double")
    near = _first(near, ["anchor_id"], "score", "positive_id", positives).orderBy("anchor_id", "rank").toArrow().combine_chunks()
    # A few rows per anchor of the wave, in the order of the anchors.
    at = np.searchsorted(near.column("anchor_id").to_numpy(), wave.ids)
    to = np.searchsorted(near.column("anchor_id").to_numpy(), wave.ids, "right")
    ids, scores = near.column("positive_id").to_numpy(), near.column("score").to_numpy()
    windows = spark.sparkContext.broadcast([(ids[a:b], scores[a:b]) for a, b in zip(at, to)])
    found = _passed(
        rows, dims, lambda: Negatives(Wave(*sent.value), windows.value, negatives, share),
        "anchor_id long, positive_id long, positive_score double, negative_id long, negative_score double",
    )
    return _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        _as_long(F.col("positive_score")).alias("positive_score"), _as_long(F.col("negative_score")).alias("negative_score"),
    )


#: The query: labels of every seventh id moved on, every fiftieth row an anchor.
SQL = """
WITH given AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
    SELECT DISTINCT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_dot_product(a.v, b.v)::BIGINT AS score
    FROM given a JOIN given b ON a.vec_id % 50 = 0 AND (b.vec_id <> a.vec_id)),
positive AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pair WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negative AS (
    SELECT p.anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
    FROM positive p JOIN pair n ON p.anchor_id = n.anchor_id AND NOT same
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 3
"""
