"""Toxicity from character n-grams: bags of subword embeddings under a linear softmax.

A word's vector is the mean of the embeddings of its hashed character n-grams, a passage's is
the mean over its ``PASSAGE`` places, where a word counts once and its repetitions and places
beyond a short text's end are zero, and a two-class softmax scores the passage. Embeddings and softmax are
learned together in numpy. Misspellings share most n-grams with words that were seen. A mean
over a long text would drown a few insults, so a text has the score of its worst passage; in
learning, too, each text's currently worst passage stands for it.

Passages overlap, so that no verdict depends on where a grid falls. In scoring a passage begins
at every word: a word adds to the passages that hold it and no earlier place of the same word,
a range of begins, so the sums of all passages are running sums of differences. They are taken in
whole numbers, so equal texts have equal scores wherever they stand. In learning a passage
begins at every ``STEP`` words, and the last one ends with the text.

The model is learned from a sample of labelled rows, each with all its passages and whole words:
those of the ``ROWS`` ids with the smallest hashes, as many as ``TEXT_BYTES`` of texts and
``WORD_BYTES`` of their distinct words hold (with the rows that cross the bounds); scoring covers
all passages of all texts.

Null or empty text: the score of a passage without words. Null id or label: never learned from.
Several labels for an id: each is learned. Repeated rows: scored each, learned from once. No labels to learn from:
score 0; labels of one kind only: that kind's score everywhere. Empty table: no rows. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import fold, hand_back, mapped, texts
from fieldbook.llm.tokenfiles import slices
from fieldbook.llm.words import parts_of_words, words_of
from fieldbook.session import materialise

ROWS, TEXT_BYTES, WORD_BYTES = 10_000, 64 << 20, 12 << 20  # bounds of the learning sample
PASSAGE, STEP = 24, 12  # words; in learning, from one passage's begin to the next
FIXED = float(1 << 32)  # scores are summed in such parts
SIZES, BUCKETS, WIDTH = (3, 4, 5), 1 << 17, 8
HELD_OUT, FOLDS = 0, 5
THRESHOLD = 0.5
BATCH_BYTES = 2 << 20  # of texts scored together, with some hundred bytes held for each word
LEARN_BYTES, STEP_PARTS = 4 << 20, 1 << 21  # texts encoded, n-grams moved at a time in learning
MEAN_PASSAGES = 1 << 16  # passages whose means are taken at a time


def begins(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and lengths of the learning passages of each range of words, and their range; a
    passage at every STEP words, the last one at the end. An empty range has none."""
    size = np.diff(bounds)
    last = np.maximum(size - PASSAGE, 0)
    n = np.where(size > 0, -(-last // STEP) + 1, 0)
    owner = np.repeat(np.arange(len(size)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return bounds[:-1][owner] + np.minimum(nth * STEP, last[owner]), np.minimum(size, PASSAGE)[owner], owner


def distinct_words(code: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each passage's words without repetitions, in a row, and where each passage's begin (with
    the end). A passage has at most PASSAGE words."""
    at = starts[:, None] + np.arange(PASSAGE)
    inside = np.arange(PASSAGE) < lengths[:, None]
    words = np.where(inside, code[np.minimum(at, max(len(code) - 1, 0))] if len(code) else 0, np.iinfo(np.int32).max)
    words.sort(axis=1)
    keep = words != np.iinfo(np.int32).max
    keep[:, 1:] &= words[:, 1:] != words[:, :-1]
    return words[keep], np.concatenate([[0], np.cumsum(keep.sum(axis=1))])


@dataclass(frozen=True)
class Scorer:
    """What scoring needs: each n-gram's share in the difference of the two classes."""

    weights: np.ndarray
    bias: float

    def scores(self, texts_: pa.Array) -> np.ndarray:
        """Score of every text: that of its worst passage."""
        code, bounds, words = words_of(texts_)
        total, count = np.zeros(len(words)), np.zeros(len(words))
        for owner, bucket in parts_of_words(words, SIZES, BUCKETS):
            total += np.bincount(owner, self.weights[bucket], len(words))
            count += np.bincount(owner, minlength=len(words))
        per_word = np.rint(total / np.maximum(count, 1) * FIXED)
        worst_sum = worst_windows(code, bounds, per_word)
        return 1 / (1 + np.exp(-np.clip(worst_sum / FIXED / PASSAGE + self.bias, -30, 30)))


def worst_windows(code: np.ndarray, bounds: np.ndarray, per_word: np.ndarray) -> np.ndarray:
    """Of each range of words, the greatest sum of a passage's distinct words, over passages
    from every word; the only one of a short range is the range itself, of an empty one 0."""
    n, size = len(code), np.diff(bounds)
    out = np.zeros(len(size))
    if not n:
        return out
    owner = np.repeat(np.arange(len(size)), size)
    order = np.argsort(owner * (int(code.max()) + 1) + code, kind="stable")
    again = (code[order][1:] == code[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    before = np.full(n, -1)
    before[order[1:][again]] = order[:-1][again]
    place = np.arange(n)
    last = (bounds[:-1] + np.maximum(size - PASSAGE, 0))[owner]
    first = np.maximum(np.maximum(before + 1, place - PASSAGE + 1), bounds[:-1][owner])
    to = np.minimum(place, last)
    use = first <= to
    value = per_word[code[use]]
    steps = np.bincount(first[use], value, n + 1) - np.bincount(to[use] + 1, value, n + 1)
    sums = np.cumsum(steps.astype(np.int64))[:n]
    sums[place > last] = np.iinfo(np.int64).min
    filled = size > 0
    out[filled] = np.maximum.reduceat(sums, bounds[:-1][filled])
    return out


@dataclass(frozen=True)
class Passages:
    """The passages of texts: each one's distinct words as numbers in a row, where they begin
    (with the end), the words, and the text that each belongs to (ascending)."""

    code: np.ndarray
    bounds: np.ndarray
    words: pa.Array
    owner: np.ndarray
    texts: int


def encoded(parts: Iterable[pa.Array]) -> Passages:
    """All passages of texts that come in parts. No part is taken after ``WORD_BYTES`` of words."""
    codes, ends, owners, words, known, total, rows, held = [], [np.zeros(1, np.int64)], [], [], 0, 0, 0, 0
    for texts_ in parts:
        code, bounds, found = words_of(texts_)
        starts, lengths, owner = begins(bounds)
        code, begin = distinct_words(code, starts, lengths)
        codes.append((code + known).astype(np.int32))
        ends.append(begin[1:] + total)
        owners.append(owner + rows)
        words.append(found)
        known, total, rows = known + len(found), total + len(code), rows + len(texts_)
        held += pa.compute.sum(pa.compute.binary_length(found)).as_py() or 0
        if held >= WORD_BYTES:
            break
    coded = pa.chunked_array(words, pa.large_string()).combine_chunks().dictionary_encode()
    words.clear()
    number = coded.indices.to_numpy()
    # Part by part, so that the words' places are held once.
    code, at = np.empty(total, np.int32), 0
    for i, part in enumerate(codes):
        code[at : at + len(part)] = number[part]
        at, codes[i] = at + len(part), None
    return Passages(code, np.concatenate(ends), coded.dictionary, np.concatenate([np.zeros(0, np.int64), *owners]), rows)


class Learner:
    """Embeddings and softmax under lazy Adam steps on batches of passages."""

    def __init__(self, passages: Passages, share: float, rate: float, seed: int):
        self.rng, self.rate, self.turn = np.random.default_rng(seed), rate, 0
        self.embed = self.rng.normal(0, 0.2, (BUCKETS, WIDTH)).astype(np.float32)
        self.soft = self.rng.normal(0, 0.2, (WIDTH, 2)).astype(np.float32)
        self.bias = np.log([1 - share, share]).astype(np.float32)
        self.state = [np.zeros_like(x) for x in (self.embed, self.embed, self.soft, self.soft, self.bias, self.bias)]
        self.code, self.bounds, words = passages.code, passages.bounds, passages.words
        # A word with its two frame marks has as many n-grams as places for them, so their room is known.
        length = pa.compute.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 2
        self.parts = sum(np.maximum(length - n + 1, 0) for n in SIZES)
        self.begin = np.concatenate([[0], np.cumsum(self.parts)])
        self.bucket, at = np.empty(self.begin[-1], np.int32), 0
        for some in slices(pa.RecordBatch.from_arrays([words], names=["text"]), limit=1 << 18):
            own = in_order(some.column("text"))
            self.bucket[at : at + len(own)] = own
            at += len(own)

    def step(self, chosen: np.ndarray, labels: np.ndarray) -> None:
        sizes = np.diff(self.bounds)[chosen]
        chosen, labels, sizes = chosen[sizes > 0], labels[sizes > 0], sizes[sizes > 0]
        if not len(chosen):
            return
        at = np.arange(sizes.sum()) + np.repeat(self.bounds[chosen] - (np.cumsum(sizes) - sizes), sizes)
        used, local = np.unique(self.code[at], return_inverse=True)
        n = self.parts[used]
        if n.sum() > STEP_PARTS and len(chosen) > 1:
            half = len(chosen) // 2
            self.step(chosen[:half], labels[:half])
            return self.step(chosen[half:], labels[half:])
        own = np.arange(n.sum()) + np.repeat(self.begin[used] - (np.cumsum(n) - n), n)
        part_word = np.repeat(np.arange(len(used)), n)
        buckets, part = np.unique(self.bucket[own], return_inverse=True)
        row = np.repeat(np.arange(len(chosen)), sizes)
        per_part = (1 / np.maximum(n, 1)).astype(np.float32)[:, None]
        per_row = np.float32(1 / PASSAGE)
        e = self.embed[buckets]
        word = added(part_word, e[part], len(used)) * per_part
        text = added(row, word[local], len(chosen)) * per_row
        logits = text @ self.soft + self.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - np.eye(2, dtype=np.float32)[labels]) / np.float32(len(chosen))
        d_word = added(local, ((d @ self.soft.T) * per_row)[row], len(used)) * per_part
        d_embed = added(part, d_word[part_word], len(buckets))
        self.turn += 1
        moved = ((self.embed, d_embed, buckets), (self.soft, text.T @ d, slice(None)), (self.bias, d.sum(axis=0), slice(None)))
        for k, (value, grad, where) in enumerate(moved):
            m, v = self.state[2 * k], self.state[2 * k + 1]
            m[where] = 0.9 * m[where] + 0.1 * grad
            v[where] = 0.99 * v[where] + 0.01 * grad**2
            step = self.rate * (m[where] / (1 - 0.9**self.turn)) / (np.sqrt(v[where] / (1 - 0.99**self.turn)) + 1e-6)
            value[where] -= step.astype(np.float32)

    def epoch(self, chosen: np.ndarray, labels: np.ndarray, most: int) -> None:
        """One pass in batches of up to ``most`` passages, smaller for few, so that there are some steps."""
        size = int(np.clip(len(chosen) // 40, 24, most))
        order = self.rng.permutation(len(chosen))
        for i in range(0, len(order), size):
            self.step(chosen[order[i : i + size]], labels[order[i : i + size]])

    def means(self) -> np.ndarray:
        """Every passage's present difference of the classes."""
        shares = self.embed @ (self.soft[:, 1] - self.soft[:, 0])
        per_word = averages(shares[self.bucket], self.begin)
        out = np.empty(len(self.bounds) - 1)
        for i in range(0, len(out), MEAN_PASSAGES):
            bounds = self.bounds[i : i + MEAN_PASSAGES + 1]
            of = averages(per_word[self.code[bounds[0] : bounds[-1]]], bounds - bounds[0])
            out[i : i + MEAN_PASSAGES] = of * (np.diff(bounds) / PASSAGE)
        return out

    def scorer(self) -> Scorer:
        return Scorer((self.embed @ (self.soft[:, 1] - self.soft[:, 0])).astype(float), float(self.bias[1] - self.bias[0]))


def in_order(words: pa.Array) -> np.ndarray:
    """The buckets of all n-grams, word by word."""
    found = list(parts_of_words(words, SIZES, BUCKETS))
    owner, bucket = (np.concatenate([np.zeros(0, np.int64), *v]) for v in (list(zip(*found)) or ([], [])))
    return bucket[np.argsort(owner, kind="stable")].astype(np.int32)


def averages(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean of each range of values, 0 for an empty one."""
    out, sizes = np.zeros(len(bounds) - 1, np.float32), np.diff(bounds)
    if (sizes > 0).any():
        out[sizes > 0] = np.add.reduceat(values, bounds[:-1][sizes > 0]) / sizes[sizes > 0]
    return out


def added(key: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Rows added up by key."""
    return np.stack([np.bincount(key, rows[:, k], size) for k in range(rows.shape[1])], axis=1).astype(np.float32)


def worst(means: np.ndarray, owner: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Of each text, its ``number`` passages with the highest means."""
    ranked = np.lexsort((-means, owner))
    first = np.unique(owner[ranked], return_index=True)[1]
    nth = np.arange(len(ranked)) - np.repeat(first, np.diff(first, append=len(ranked)))
    return ranked[nth < number[owner[ranked]]]


def learn(passages: pa.Array, owner: np.ndarray, labels: np.ndarray, rounds: int = 8, spread: int = 12, hard: int = 4, batch: int = 512, rate: float = 0.1, seed: int = 7) -> Scorer:
    """A scorer from passages, the text each belongs to (ascending), and the texts' labels."""
    found = encoded([passages])
    return learned(replace(found, owner=np.asarray(owner)[found.owner]), labels, rounds, spread, hard, batch, rate, seed)


def learned(passages: Passages, labels: np.ndarray, rounds: int = 8, spread: int = 12, hard: int = 4, batch: int = 512, rate: float = 0.1, seed: int = 7) -> Scorer:
    """A scorer from passages and their texts' labels.

    The first round takes ``spread`` passages of each text at random, all with its label. In the
    others the worst passage stands for a toxic text, and the ``hard`` worst for any other."""
    if not len(labels):
        return Scorer(np.zeros(BUCKETS), -30.0)
    if labels.min() == labels.max():
        return Scorer(np.zeros(BUCKETS), 30.0 if labels[0] else -30.0)
    learner, owner = Learner(passages, float(labels.mean()), rate, seed), passages.owner
    some = worst(learner.rng.random(len(owner)), owner, np.full(len(labels), spread))
    learner.epoch(some, labels[owner[some]], batch)
    for _ in range(rounds):
        some = worst(learner.means(), owner, np.where(labels == 1, 1, hard))
        learner.epoch(some, labels[owner[some]], batch)
    return learner.scorer()


def labelled_sample(labels: DataFrame, column: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out fold, those with the smallest hashes."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label")).distinct()
    usable = known.where(F.col("label").isin(0, 1) & (fold(FOLDS) != HELD_OUT))
    return usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Scorer:
    sample = F.broadcast(labelled_sample(labels, "toxic", rows))  # at most `rows` rows of two numbers
    order = ["key", "doc_id", "label"]
    known = materialise(texts(docs).join(sample, "doc_id").select(F.xxhash64("doc_id", "label", "text").alias("key"), "doc_id", "label", "text"), "learning-rows")
    sizes = known.groupBy(*order).agg(F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes")).orderBy(*order).limit(2 * rows).toArrow()
    if not len(sizes):
        return learned(encoded([]), np.zeros(0, np.int64))
    # Whole rows, up to the one that crosses the bound.
    size = sizes.column("bytes").to_numpy().astype(np.int64)
    last = sizes.slice(int((np.cumsum(size) - size < TEXT_BYTES).sum()) - 1, 1).to_pylist()[0]
    within = F.struct(*order) <= F.struct(F.lit(last["key"]).cast("long"), F.lit(last["doc_id"]).cast("long"), F.lit(last["label"]).cast("int"))
    table = known.where(within).groupBy(*order).agg(F.first("text").alias("text")).toArrow().sort_by([(c, "ascending") for c in order])
    parts = (part.column("text") for batch in table.combine_chunks().to_batches() for part in slices(batch, limit=LEARN_BYTES))
    passages = encoded(parts)
    label = table.column("label").to_numpy().astype(np.int64)[: passages.texts]
    del table, parts
    hand_back()
    found = learned(passages, label)
    del passages
    hand_back()
    return found


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, limit=BATCH_BYTES):
                found = scorer.scores(rows.column("text"))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return mapped(texts(docs), run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose text is not predicted toxic, with all their columns. Each row is judged by
    its own text in the scan that returns it, so nothing is joined back."""
    scorer = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, limit=BATCH_BYTES):
                yield rows.filter(pa.array(scorer.scores(rows.column("text")) < THRESHOLD))

    return mapped(docs.withColumn("text", F.col("text").cast("string")), run, docs.schema)
