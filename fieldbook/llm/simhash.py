"""SimHash near-duplicates by a self-join of binary tries.

A document's fingerprint has, in each of 64 places, the bit that more than half of its word
shingles' hashes have set. Two fingerprints within ``radius`` bits are linked, and linked
documents form groups.

The join walks pairs of nodes of a binary trie over the distinct fingerprints, both nodes one
bit down at a time, adds up the bits in which their paths differ, and gives a pair up once its
errors exceed the budget. To keep the tries apart on the cluster, and the budget small near
the roots, the bits are cut into radius + 1 blocks in a ring, and there is a trie for each
block to start with: of any two fingerprints within the radius, some starting block has, for
every k, at most k * radius / (radius + 1) errors in the first k blocks, so none in the first
block. The first block names the subtree that a task works on; a subtree with more than
``SUBTREE`` fingerprints is dealt out as pairs of its parts, each pair meeting in one task.
A task takes its subtrees in order, sorted by Spark, and holds about ``SUBTREE`` fingerprints,
or one subtree, at a time, however many its partition has.
Tasks return each subtree's groups as stars, and the stars are joined into components.

Nodes whose fingerprints are in one group already need no further comparison, so dense groups
of near copies don't cost the square of their size.

Null and empty texts have fingerprint zero and are linked like any other. A null id has a
fingerprint; its component is the smallest id in its group, null if there is none. Repeated
rows fall together by their fingerprint. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import free_name, mapped, raw_texts
from fieldbook.llm.components import smallest_reachable
from fieldbook.session import materialise

SHINGLE, RADIUS = 4, 4
SUBTREE = 200_000  # fingerprints of one subtree handled by one task together
SUBTREE_KEY = ["start", "block", "one", "other"]
FRONTIER = 1 << 18  # node pairs walked down together


def fingerprint(text: bytes, words_each: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    from xxhash import xxh64_digest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words_each, len(words))
    spans = list(zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(spans), 1 << 15):
        hashes = b"".join([xxh64_digest(joined[a:b], 42) for a, b in spans[i : i + (1 << 15)]])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(spans)).view(">i8")[0])


def fingerprints(docs: DataFrame, words_each: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), words_each) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], names=["doc_id", "fingerprint"])

    return mapped(raw_texts(docs), run, "doc_id long, fingerprint long")


def blocks(radius: int) -> list[int]:
    """Sizes of the radius + 1 blocks of the 64 bits."""
    base, more = divmod(64, radius + 1)
    return [base + (i < more) for i in range(radius + 1)]


def budgets(radius: int, start: int) -> np.ndarray:
    """Errors allowed after each depth of the trie that starts at a block."""
    sizes = blocks(radius)
    sizes = sizes[start:] + sizes[:start]
    return np.concatenate([[0], *[[(k + 1) * radius // (radius + 1)] * n for k, n in enumerate(sizes)]]).astype(np.int64)


class Groups:
    """Which leaves are known to belong together."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self._settle()

    def _settle(self) -> None:
        self.changes = np.concatenate([[0], np.cumsum(self.root[1:] != self.root[:-1])]) if len(self.root) else self.root

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.root[i], self.root[j]
        new = a != b
        if not new.any():
            return
        pairs = np.unique(np.stack([np.minimum(a, b)[new], np.maximum(a, b)[new]], axis=1), axis=0)
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            path = []
            while (up := parent.get(x, x)) != x:
                path.append(x)
                x = up
            for p in path:
                parent[p] = x
            return x

        for x, y in pairs.tolist():
            x, y = top(x), top(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        to = np.arange(len(self.root))
        for x in list(parent):
            to[x] = top(x)
        self.root = to[self.root]
        self._settle()

    def settled(self, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> np.ndarray:
        """Pairs of leaf ranges that lie within one group."""
        one = (self.changes[a1 - 1] == self.changes[a0]) & (self.changes[b1 - 1] == self.changes[b0])
        return one & (self.root[a0] == self.root[b0])


def trie_groups(x: np.ndarray, depth: int, budget: np.ndarray, radius: int, frontier: int = FRONTIER) -> np.ndarray:
    """For ascending distinct 64-bit values, the index of the first value of each one's group.

    The walk begins with every node at ``depth`` paired with itself. A node is a range of
    values that share a prefix.
    """
    groups = Groups(len(x))
    if len(x) < 2:
        return groups.root
    heads = np.flatnonzero(np.concatenate([[True], x[1:] >> np.uint64(64 - depth) != x[:-1] >> np.uint64(64 - depth)])) if depth else np.zeros(1, np.int64)
    tails = np.concatenate([heads[1:], [len(x)]])
    many = tails - heads > 1
    heads, tails = heads[many], tails[many]
    stack = [(depth, heads, tails, heads, tails, np.zeros(len(heads), np.int64))]
    while stack:
        depth, a0, a1, b0, b1, errors = stack.pop()
        if len(a0) > frontier:
            half = len(a0) // 2
            stack += [(depth, *(v[half:] for v in (a0, a1, b0, b1, errors))), (depth, *(v[:half] for v in (a0, a1, b0, b1, errors)))]
            continue
        go = ~groups.settled(a0, a1, b0, b1)
        a0, a1, b0, b1, errors = (v[go] for v in (a0, a1, b0, b1, errors))
        leaves = (a1 - a0 == 1) & (b1 - b0 == 1)
        i, j = a0[leaves], b0[leaves]
        near = np.bitwise_count(x[i] ^ x[j]) <= radius
        groups.link(i[near], j[near])
        a0, a1, b0, b1, errors = (v[~leaves] for v in (a0, a1, b0, b1, errors))
        if not len(a0):
            continue
        bit = np.uint64(1 << (63 - depth))
        split = lambda lo, hi: np.clip(np.searchsorted(x, (x[lo] | bit) & ~(bit - np.uint64(1))), lo, hi)
        am, bm = split(a0, a1), split(b0, b1)
        same = a0 == b0
        parts = [(a0, am, b0, bm, errors), (am, a1, bm, b1, errors), (a0, am, bm, b1, errors + 1)]
        parts.append(tuple(v[~same] for v in (am, a1, b0, bm, errors + 1)))
        a0, a1, b0, b1, errors = (np.concatenate(v) for v in zip(*parts))
        depth += 1
        full = (a1 > a0) & (b1 > b0) & (errors <= budget[depth]) & ~((a0 == b0) & (a1 - a0 == 1))
        if full.any():
            stack.append((depth, *(v[full] for v in (a0, a1, b0, b1, errors))))
    return groups.root


def whole_subtrees(frames: Iterable[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by subtree, put together into frames of whole subtrees. A frame ends at the
    first border at which it has ``rows`` rows, so what is held is less than ``rows`` and one subtree."""
    held, count = [], 0
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        count += len(frame)
        if count < rows:
            continue
        table = pd.concat(held, ignore_index=True)
        key = table[SUBTREE_KEY].to_numpy()
        new = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        cuts, begin = [], 0
        for border in new.tolist():
            if border - begin >= rows:
                cuts.append((begin, border))
                begin = border
        if len(new) and begin < new[-1]:  # the last subtree may go on in the next frame
            cuts.append((begin, int(new[-1])))
            begin = int(new[-1])
        for x, y in cuts:
            yield table.iloc[x:y]
        held, count = [table.iloc[begin:]], len(table) - begin
    if count:
        yield pd.concat(held, ignore_index=True)


def subtree_stars(radius: int, subtree: int = SUBTREE):
    sizes = blocks(radius)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in whole_subtrees(frames, subtree):
            for (start, _, _), part in table.groupby(["start", "one", "other"], sort=False):
                value = part["value"].to_numpy().astype(np.int64).view(np.uint64)
                turn = np.uint64(sum(sizes[:start]))
                x = np.unique((value << turn) | (value >> np.uint64(64) - turn) if turn else value)
                root = trie_groups(x, sizes[start], budgets(radius, start), radius)
                back = ((x >> turn) | (x << np.uint64(64) - turn) if turn else x).view(np.int64)
                linked = root != np.arange(len(x))
                if linked.any():
                    yield pd.DataFrame({"a": back[linked], "b": back[root[linked]]})

    return run


def near_links(distinct: DataFrame, radius: int = RADIUS, subtree: int = SUBTREE) -> DataFrame:
    """From distinct fingerprints, links (a, b) whose components are those of all pairs within the radius."""
    sizes = blocks(radius)
    starts = []
    for i in range(radius + 1):
        turn = sum(sizes[:i])
        turned = F.shiftleft("fingerprint", turn).bitwiseOR(F.shiftrightunsigned("fingerprint", 64 - turn)) if turn else F.col("fingerprint")
        starts.append(F.struct(F.lit(i).alias("start"), F.shiftrightunsigned(turned, 64 - sizes[i]).cast("int").alias("block")))
    rows = distinct.select(F.col("fingerprint").alias("value"), F.explode(F.array(*starts)).alias("t")).select("value", "t.*")
    # One row per start and block value, at most (radius + 1) * 2 ** (64 / (radius + 1)).
    loads = rows.groupBy("start", "block").agg(F.count("*").alias("n")).where(F.col("n") > subtree)
    hot = loads.select("start", "block", F.ceil(F.col("n") / F.lit(subtree)).cast("int").alias("parts"))
    rows = rows.join(F.broadcast(hot), ["start", "block"], "left")
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("value"), parts).cast("int")
    meet = F.transform(F.sequence(F.lit(0), parts - 1), lambda p: F.struct(F.least(own, p).alias("one"), F.greatest(own, p).alias("other")))
    dealt = rows.select("value", "start", "block", F.explode(meet).alias("m")).select("value", "start", "block", "m.*")
    sorted_ = dealt.repartition(*SUBTREE_KEY).sortWithinPartitions(*SUBTREE_KEY).select(*SUBTREE_KEY, "value")
    return sorted_.mapInPandas(subtree_stars(radius, subtree), "a long, b long")


def near_groups(docs: DataFrame, words_each: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (long) and component_id of every row."""
    marked = materialise(fingerprints(docs, words_each), "fingerprints")
    firsts = materialise(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    root = smallest_reachable(near_links(firsts.select("fingerprint"), radius)).select(F.col("a").alias("fingerprint"), F.col("b").alias("root"))
    rooted = firsts.join(root, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(least, "root").select("fingerprint", "component_id")
    return marked.join(of, "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_near_copies(docs: DataFrame, words_each: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of one document of each group, the one with the smallest id, with all their columns.

    An id stands for one document: its rows stay or go together. Rows without an id stay.
    """
    groups, name = near_groups(docs, words_each, radius), free_name(docs, "gone")
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")
