"""Quality from document statistics: histogram gradient-boosted trees in flat arrays.

A text becomes ``FEATURES``: sizes, shares of character classes, repetition of words, lines and
word runs. Trees are grown level by level from gradient histograms over binned features, each
as a complete binary tree whose splits and leaves lie in arrays, so all texts of a batch walk a
tree together by index arithmetic.

The trees are learned from a sample of at most ``ROWS`` labelled rows, the ones with the smallest
hashes; statistics and scores cover all of every text.

Null or empty text: statistics of a text without words, scored like any other. Null id or label:
never learned from. Several labels for an id: each is learned. Repeated rows: scored each; of
rows with one id the one whose statistics sort first is learned from, however many there are. No
labels to learn from: score 0; labels of one kind only: that kind's score everywhere. Empty table:
no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import fold, mapped, raw_texts, texts
from fieldbook.llm.toxicity import labelled_sample

ROWS = 20_000  # bound of the learning sample
HELD_OUT, FOLDS = 0, 5
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE = 60, 4, 64, 0.1

CLASSES = {
    "letters": [*range(65, 91), *range(97, 123)], "capitals": range(65, 91), "digits": range(48, 58),
    "spaces": [32, *range(9, 14)], "stops": [33, 46, 63], "commas": [44, 58, 59], "symbols": list(b"#*$%&|<>{}[]=_\\/@^~"),
    "bars": list(b"|"), "beyond_ascii": range(128, 256), "newlines": [10],
}
FEATURES = [
    "log_bytes", "log_words", *CLASSES, "word_length", "word_length_spread", "distinct_words", "commonest_word",
    "distinct_runs", "words_per_line", "repeated_lines", "unfinished_lines", "symbol_words", "entropy",
]
MEMBERS = np.zeros((256, len(CLASSES)))
for _k, _codes in enumerate(CLASSES.values()):
    MEMBERS[list(_codes), _k] = 1


def statistics(text: bytes) -> list[float]:
    """The values of FEATURES for one text."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if text else np.zeros(256)
    size = max(len(text), 1)
    shares = counts[counts > 0] / size
    words = text.lower().split()
    n = max(len(words), 1)
    tally = Counter(words)
    number = dict(zip(tally, range(len(tally))))
    code = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    runs = len(np.unique(code[:-1] * len(tally) + code[1:])) / (n - 1) if n > 1 else 1.0
    lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
    m = max(len(lines), 1)
    marked = sum(c for w, c in tally.items() if not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:!?\"')")
    return [
        np.log1p(len(text)), np.log1p(len(words)), *(counts @ MEMBERS / size), lengths.mean(), lengths.std(),
        len(tally) / n, max(tally.values(), default=0) / n, runs, len(words) / m,
        1 - len(set(lines)) / m, sum(x[-1:] not in b".!?\"')" for x in lines) / m, marked / n,
        float(-(shares * np.log2(shares)).sum()),
    ]


@dataclass(frozen=True)
class Forest:
    """Complete binary trees: node i of a level-ordered tree has children 2i + 1 and 2i + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    above: np.ndarray  # trees x inner nodes: a larger value goes right
    leaf: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, above, leaf in zip(self.feature, self.above, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > above[node])
            total += leaf[node - inner] if len(x) else 0
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, ridge: float = 1.0, least: float = 5.0) -> Forest:
    """A forest for the log-odds of label 1."""
    inner, leaves = 2**depth - 1, 2**depth
    none = (np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if not len(y) or y.min() == y.max():
        return Forest(30.0 if len(y) and y[0] else -30.0, *none)
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, bins) / bins)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    score = np.full(len(y), base)
    features, aboves, leafs = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, p * (1 - p)
        feature, above = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            best = np.full(wide, 1e-6)
            for f, e in enumerate(edges):
                key = (node - first) * bins + binned[:, f]
                g = np.bincount(key, grad, wide * bins).reshape(wide, bins).cumsum(axis=1)
                h = np.bincount(key, hess, wide * bins).reshape(wide, bins).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
                gain[(h < least / 10) | (h_all - h < least / 10)] = -1
                gain = gain[:, : len(e)]
                if not gain.shape[1]:
                    continue
                at = gain.argmax(axis=1)
                found = gain[np.arange(wide), at]
                better = found > best
                best[better] = found[better]
                feature[first : first + wide][better] = f
                above[first : first + wide][better] = e[at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > above[node])
        leaf_of = node - inner
        leaf = -rate * np.bincount(leaf_of, grad, leaves) / (np.bincount(leaf_of, hess, leaves) + ridge)
        score += leaf[leaf_of]
        features.append(feature)
        aboves.append(above)
        leafs.append(leaf)
    return Forest(base, np.array(features), np.array(aboves), np.array(leafs))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "statistics"])

    return mapped(raw_texts(docs), run, "doc_id long, statistics array<double>")


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Forest:
    sample = F.broadcast(labelled_sample(labels, "quality", rows))  # at most `rows` rows of two numbers
    chosen = texts(docs).join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    known = measured(chosen).join(sample, "doc_id").groupBy("doc_id", "label").agg(F.min("statistics").alias("statistics"))
    table = known.orderBy("doc_id", "label").toPandas()  # at most `rows`, as one row stands for an id
    x = np.array(table["statistics"].tolist()).reshape(-1, len(FEATURES))
    return grow(x, table["label"].to_numpy().astype(float))


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column("text")]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(forest.scores(x))], names=["doc_id", "score"])

    return mapped(raw_texts(docs), run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
