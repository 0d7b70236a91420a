"""Packing of token pieces into sequences of a fixed length, planned on the lengths alone.

Texts are encoded where they lie and cut into pieces. How many pieces there are of each
length is a table of at most ``capacity`` rows, and the plan is made from it: pieces longer
than a third of the capacity go at most two to a sequence, the longest first, each with the
longest partner that fits; shorter pieces, the longest first, go where the least room is
left. Equal sequences are planned together as a pattern with a number of copies, so the
plan's size depends on the capacity and not on the number of pieces. A piece then finds its
place from its length and its number among the pieces of that length, which is a count
within its partition plus the prefix sum of the partitions before.

Null or empty text: one piece that holds the end id only. Null id: packed like any other.
Repeated rows: packed once per row. Empty table: no rows. Columns other than doc_id and text
are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import mapped, texts
from fieldbook.llm.encoding import TextEncoder
from fieldbook.llm.tokenfiles import slices, with_end
from fieldbook.session import materialise

CAPACITY = 2048
RUNS = "length int, first long, past long, first_sequence long, copies long, at long"


def cutter(tokenizer: str, end_id: int, capacity: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = None, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows in slices(batch):
                encoder = encoder or TextEncoder(tokenizer)
                ids, bounds = with_end(*encoder.encode(pa.compute.fill_null(rows.column("text"), "")), end_id)
                sizes = np.diff(bounds)
                n = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                length = np.minimum(sizes[doc] - piece * capacity, capacity)
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - np.searchsorted(ordered, ordered) + seen[ordered]
                seen += np.bincount(length, minlength=capacity + 1)
                raw = memoryview(ids).cast("B")
                begin = (bounds[doc] + piece * capacity) * 4
                spans = list(zip(begin.tolist(), (begin + length * 4).tolist()))
                columns = {
                    "doc_id": rows.column("doc_id").take(pa.array(doc)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(piece * capacity, pa.int64()),
                    "length": pa.array(length, pa.int32()),
                    "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
                    "part": pa.array(np.full(len(doc), part), pa.int32()),
                    "nth": pa.array(nth, pa.int64()),
                }
                if keep_ids:
                    columns["ids"] = pa.array([bytes(raw[a:b]) for a, b in spans], pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return cut


def match_large(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns of one or two pieces longer than a third of the capacity, with their numbers."""
    left = {k: n for k, n in counts.items() if 3 * k > capacity}
    sizes, patterns = sorted(left), []
    while sizes:
        big = sizes[-1]
        at = bisect_left(sizes, capacity - big + 1) - 1
        if at < 0:
            patterns.append(([(big, 1)], left[big]))
            sizes.pop()
            continue
        small = sizes[at]
        if small == big:
            pairs, left[big] = divmod(left[big], 2)
            if pairs:
                patterns.append(([(big, 2)], pairs))
            if left[big]:  # one is over: its partner is the next shorter
                if at:
                    patterns.append(([(big, 1), (sizes[at - 1], 1)], 1))
                    left[sizes[at - 1]] -= 1
                    if not left[sizes[at - 1]]:
                        sizes.pop(at - 1)
                else:
                    patterns.append(([(big, 1)], 1))
            sizes.remove(big)
            continue
        pairs = min(left[big], left[small])
        patterns.append(([(big, 1), (small, 1)], pairs))
        for k in (big, small):
            left[k] -= pairs
            if not left[k]:
                sizes.remove(k)
    return patterns


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """All patterns: (length, copies) of the pieces of one sequence, and how many such sequences."""
    room: dict[int, list[tuple[list[tuple[int, int]], int]]] = defaultdict(list)
    gaps: list[int] = []
    done = []

    def put(items: list[tuple[int, int]], number: int) -> None:
        gap = capacity - sum(k * c for k, c in items)
        if not number:
            return
        if not gap:
            done.append((items, number))
            return
        if not room[gap]:
            insort(gaps, gap)
        room[gap].append((items, number))

    for items, number in match_large(counts, capacity):
        put(items, number)
    for size in sorted((k for k in counts if 3 * k <= capacity), reverse=True):
        todo = counts[size]
        while todo:
            at = bisect_left(gaps, size)
            if at == len(gaps):
                gap, (items, number) = capacity, ([], todo)
            else:
                gap = gaps[at]
                items, number = room[gap].pop()
                if not room[gap]:
                    gaps.pop(at)
            # The tightest sequence stays the tightest until nothing more fits in.
            copies = gap // size
            full = min(number, todo // copies)
            put([*items, (size, copies)], full)
            todo -= full * copies
            if full < number:
                if 0 < todo:
                    put([*items, (size, todo)], 1)
                    number, todo = number - 1, 0
                if items:
                    put(items, number - full)
    return done + [p for gap in gaps for p in room[gap]]


def runs(patterns: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length, which numbers of its pieces go where."""
    taken: dict[int, int] = defaultdict(int)
    sequence, out = 0, []
    for items, number in patterns:
        at = 0
        for size, copies in items:
            out.append((size, taken[size], taken[size] + number * copies, sequence, copies, at))
            taken[size] += number * copies
            at += size * copies
        sequence += number
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with
    ``keep_ids`` the ids as little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long"
    schema += ", ids binary" if keep_ids else ""
    pieces = materialise(mapped(texts(docs), cutter(tokenizer, end_id, capacity, keep_ids), schema), "pieces")
    counts = materialise(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    # At most `capacity` rows.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.createDataFrame(runs(plan(histogram, capacity)), RUNS)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    p = pieces.join(bases, ["part", "length"]).withColumn("number", F.col("base") + F.col("nth")).alias("p")
    r = F.broadcast(places).alias("r")
    here = (F.col("p.length") == F.col("r.length")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("past"))
    turn = F.col("number") - F.col("first")
    kept = [F.col("p.doc_id"), F.col("p.piece"), F.col("p.start"), F.col("p.length").cast("long").alias("length"), F.col("p.ids_crc32")]
    return p.join(r, here).select(
        *kept, (F.col("first_sequence") + F.floor(turn / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("at") + (turn % F.col("copies")) * F.col("p.length")).cast("long").alias("offset"),
        *([F.col("p.ids")] if keep_ids else []),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces that carry ids: sequence_id and ids."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.aggregate(inside, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
