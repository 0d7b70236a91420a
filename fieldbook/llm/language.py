"""Languages of a text as a mixture, by expectation-maximisation over n-gram likelihoods.

Every language has a smoothed distribution over hashed byte trigrams of <word>, counted over all
learning rows. A word's likelihood under a language is that of its trigrams. A text is a mixture:
each of its words comes from one of a few languages with unknown proportions, which expectation-
maximisation estimates. Which languages there are is chosen among the nested sets of the most
likely ones by the likelihood less a penalty of ``PENALTY`` times log(words) for each language
beyond the first. The predicted language is the one with the largest share.

Null text, or a text without letters: ``und`` with score 0 and no mixture. Null lang: not learned
from. Null id: outside the held-out fold's remainder and, having no remainder, not learned from.
Repeated rows: each predicted. Ties: the language that sorts first. Nothing to learn from: ``und``
everywhere. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import fold, mapped, texts
from fieldbook.llm.tokenfiles import slices
from fieldbook.llm.words import parts_of_words, words_of

SIZES, BUCKETS = (3,), 1 << 15
HELD_OUT, FOLDS = 2, 4
SMOOTH, PENALTY = 0.5, 3.0
SETTLED, ROUNDS = 1e-4, 500  # shares that move by less are settled; rounds at most
SLACK = 0.5  # log-likelihood by which a settled fit may fall short of the best one
UNKNOWN = "und"
BATCH_BYTES = 4 << 20


def lettered(texts_: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """As words_of, with everything but letters taken from the words; emptied words keep their place."""
    code, bounds, words = words_of(texts_)
    bare = pc.replace_substring_regex(words, r"[^\p{L}\p{M}]+", "").dictionary_encode()
    return bare.indices.to_numpy().astype(np.int64)[code] if len(words) else code, bounds, bare.dictionary


def count_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition, how often each trigram is seen in each language."""
    seen: dict[str, np.ndarray] = {}
    for batch in batches:
        for rows in slices(batch, limit=BATCH_BYTES):
            code, bounds, words = lettered(rows.column("text"))
            langs = rows.column("lang").dictionary_encode()
            of_word = np.repeat(langs.indices.to_numpy(), np.diff(bounds))
            parts = list(parts_of_words(words, SIZES, BUCKETS))
            filled = np.asarray(pc.binary_length(words)) > 0
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                times = np.bincount(code[of_word == k], minlength=len(words)) * filled
                total = seen.setdefault(lang, np.zeros(BUCKETS))
                for owner, bucket in parts:
                    total += np.bincount(bucket, times[owner], BUCKETS)
    for lang, total in seen.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))], names=["lang", "bucket", "n"])


@dataclass(frozen=True)
class Languages:
    names: list[str]
    logs: np.ndarray  # buckets x languages

    def mixtures(self, texts_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Share of each language in each text, and whether a text has any letters."""
        code, bounds, words = lettered(texts_)
        n, k = len(texts_), len(self.names)
        likely = np.zeros((len(words), k))
        for owner, bucket in parts_of_words(words, SIZES, BUCKETS):
            for j in range(k):
                likely[:, j] += np.bincount(owner, self.logs[bucket, j], len(words))
        real = np.asarray(pc.match_substring_regex(words, r"\p{L}")) if len(words) else np.zeros(0, bool)
        held = real[code] if len(code) else np.zeros(0, bool)
        text = np.repeat(np.arange(n), np.diff(bounds))[held]
        code = code[held]
        has = np.bincount(text, minlength=n)
        if not k or not len(code):
            return np.zeros((n, k)), has > 0
        some = np.flatnonzero(has)
        starts = np.concatenate([[0], np.cumsum(has[some])[:-1]])
        row = np.repeat(np.arange(len(some)), has[some])
        most = likely.max(axis=1, keepdims=True)
        p = np.exp(likely - most).astype(np.float32)[code]
        alone = np.add.reduceat(likely[code], starts, axis=0)  # each language by itself
        offset = np.add.reduceat(most[code, 0], starts)
        best = alone.argmax(axis=1)
        out = np.zeros((len(some), k))
        out[np.arange(len(some)), best] = 1
        value = alone.max(axis=1)
        cost = PENALTY * np.log(has[some] + 1.0)
        # No mixture beats every word taking its best language, so few texts need to be fitted.
        todo = np.flatnonzero((offset - value > cost) & (k > 1))
        if len(todo):
            every = self._fit(p, starts, has[some], todo, np.ones((len(todo), k), bool))
            rank = np.argsort(-every[0], axis=1, kind="stable")
            for size in range(2, k + 1):
                open_ = every[1] + SLACK + offset[todo] - cost[todo] * (size - 1) > value[todo]  # the fit of all bounds those of fewer
                open_ &= every[0][np.arange(len(todo)), rank[:, size - 1]] > 0
                if not open_.any():
                    break
                which = todo[open_]
                use = np.zeros((len(which), k), bool)
                np.put_along_axis(use, rank[open_][:, :size], True, axis=1)
                share, fit = self._fit(p, starts, has[some], which, use) if size < k else (every[0][open_], every[1][open_])
                gain = fit + offset[which] - cost[which] * (size - 1)
                better = gain > value[which]
                out[which[better]], value[which[better]] = share[better], gain[better]
        whole = np.zeros((n, k))
        whole[some] = out
        return whole, has > 0

    @staticmethod
    def _fit(p: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the languages in use, and the log-likelihood they reach."""
        n = sizes[which]
        begin = np.cumsum(n) - n
        rows = p[np.arange(n.sum()) + np.repeat(starts[which] - begin, n)]
        of = np.repeat(np.arange(len(which)), n)
        share = (use / use.sum(axis=1, keepdims=True)).astype(np.float32)
        going = np.arange(len(which))  # texts whose shares still move
        left, owner, first = rows, of, begin
        for _ in range(ROUNDS):
            weighed = left * share[owner]
            weighed /= np.maximum(weighed.sum(axis=1, keepdims=True), 1e-30)
            new = np.add.reduceat(weighed, first, axis=0) / n[going, None].astype(np.float32)
            moved = np.abs(new - share[going]).max(axis=1) > SETTLED
            share[going] = new
            if not moved.any():
                break
            if not moved.all():
                stay = np.repeat(moved, n[going])
                going, left, owner = going[moved], left[stay], owner[stay]
                first = np.cumsum(n[going]) - n[going]
        fit = np.add.reduceat(np.log(np.maximum((rows * share[of]).sum(axis=1), 1e-30)).astype(float), begin)
        return share.astype(float), fit


def train(docs: DataFrame) -> Languages:
    """Trigram distributions of all learning rows: at most languages x BUCKETS numbers reach the driver."""
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    usable = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(FOLDS) != HELD_OUT))
    counted = mapped(usable.select("text", "lang"), count_parts, "lang string, bucket int, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(table["lang"].unique())
    counts = np.zeros((BUCKETS, len(names)))
    counts[table["bucket"], [names.index(x) for x in table["lang"]]] = table["n"]
    return Languages(names, np.log((counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * BUCKETS)))


def predict(docs: DataFrame, model: Languages) -> DataFrame:
    """doc_id, lang_pred, score (the language's share) and mixture (language to share) of every row."""

    # A word takes a number per language, so with many languages fewer words are taken together.
    limit = max(1 << 16, 4 * BATCH_BYTES // max(4, len(model.names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, limit=limit):
                shares, has = model.mixtures(rows.column("text"))
                known = has & bool(model.names)
                top = shares.argmax(axis=1) if model.names else np.zeros(len(has), int)
                name = [model.names[t] if ok else UNKNOWN for t, ok in zip(top, known)]
                value = np.where(known, shares.max(axis=1, initial=0), 0.0)
                mixed = [[(model.names[j], float(s[j])) for j in np.flatnonzero(s)] for s in shares]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(name, pa.string()), pa.array(np.clip(value, 0, 1)), pa.array(mixed, pa.map_(pa.string(), pa.float64()))],
                    names=["doc_id", "lang_pred", "score", "mixture"])

    return mapped(texts(docs), run, "doc_id long, lang_pred string, score double, mixture map<string,double>")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and mixture of every row."""
    found = predict(docs, train(docs))
    return found.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "mixture")
