"""Periodic runs of words: stretches that repeat a short sequence of words, found by a
dictionary of basic factors.

Every factor of 1, 2, 4, 8 ... words gets a number, equal factors the same one; a factor's
number follows from those of its halves, so a length costs one sort. Where a factor's next
occurrence lies within twice its length, the distance is a candidate period, and places in a
row with one distance form arithmetic progressions of occurrences. Each progression of three
or more terms proposes a run, which is extended word by word to both sides; the same run,
proposed at several lengths, is kept once.

Nothing is missed: a run with period q and at least 4q words is proposed at the length L
with q <= L < 2q. Two occurrences of L words less than q apart would give the run a
shorter period, so each of its factors recurs after exactly q words, at q + 2 places in a row
or more. A factor found once in its text cannot be part of a repeated longer one, so places
drop out as lengths grow, and for ordinary prose little is left after a few.

Texts are taken whole, several in one array, each with numbers of its own so that nothing
spans two of them; a task holds about ``CHUNK_BYTES`` of them, or one longer text, at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldbook.llm.common import mapped, raw_texts

#: Least words of a run, and least periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Texts are put together until they have so many bytes; about a million words.
CHUNK_BYTES = 6_000_000

COLUMNS = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed", pa.string()),
])
DIGEST = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
])
AS_DDL = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
DIGEST_DDL = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def progressions(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each power-of-two length: begins and ends (places whose factors recur at one
    distance, of at least three terms) and that distance.

    codes: a number per word; owner: the text a word belongs to, ascending.
    """
    n = len(codes)
    size, place = 1, np.arange(n)
    key = owner.astype(np.int64) * (int(codes.max(initial=0)) + 1) + codes
    while len(place) > 1:
        order = np.argsort(key, kind="stable")
        at, ranked = place[order], key[order]
        same = ranked[1:] == ranked[:-1]
        gap = np.zeros(n, np.int64)
        gap[at[:-1][same]] = (at[1:] - at[:-1])[same]
        gap[gap > 2 * size] = 0
        # Places in a row with one distance; a text's last word never has one to the next text.
        edge = np.flatnonzero(np.diff(gap)) + 1
        begin, end = np.concatenate([[0], edge]), np.concatenate([edge, [n]])
        distance = gap[begin]
        found = (distance > 0) & (end - begin > distance)
        if found.any():
            yield begin[found], end[found] + size - 1, distance[found]
        # Factors found once are part of no repeated longer factor.
        number = np.full(n, -1, np.int64)
        number[at] = np.concatenate([[0], np.cumsum(~same)])
        repeated = np.zeros(len(at), bool)
        repeated[1:] |= same
        repeated[:-1] |= same
        number[at[~repeated]] = -1
        place = np.flatnonzero(number[: n - size] >= 0)
        half = place + size
        place = place[(number[half] >= 0) & (owner[half] == owner[place])]
        key = number[place] * n + number[place + size]
        size *= 2


def runs(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """All runs as rows (start, length, period), by start, then period; places count through
    all texts. See ``progressions`` for the arguments."""
    n, known = len(codes), []
    for begin, end, period in progressions(codes, owner):
        begin, end = begin.copy(), end.copy()  # words begin .. end - 1 equal those a period later
        going = np.arange(len(begin))
        while len(going):
            i = going[begin[going] > 0]
            i = i[(codes[begin[i] - 1] == codes[begin[i] - 1 + period[i]]) & (owner[begin[i] - 1] == owner[begin[i] - 1 + period[i]])]
            begin[i] -= 1
            going = i
        going = np.arange(len(begin))
        while len(going):
            i = going[end[going] + period[going] < n]
            i = i[(codes[end[i]] == codes[end[i] + period[i]]) & (owner[end[i]] == owner[end[i] + period[i]])]
            end[i] += 1
            going = i
        length = end + period - begin
        long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        known.append(np.stack([begin, length, period], axis=1)[long])
    if not known:
        return np.zeros((0, 3), np.int64)
    return np.unique(np.concatenate(known)[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def planted_repeats(doc_id: int | None, words: list) -> list:
    """The contract's change to every tenth document (by crc32 of its id): its words from some
    place on become a repetition. Other documents, and rows without an id, stay as they are."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _chunks(batch: pa.RecordBatch) -> Iterator[list[tuple[int | None, bytes]]]:
    """Rows of a batch, put together up to CHUNK_BYTES; a longer text stands alone."""
    chunk, held = [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1)):
        raw = text.as_buffer()
        size = 0 if raw is None else raw.size
        if chunk and held + size > CHUNK_BYTES:
            yield chunk
            chunk, held = [], 0
        chunk.append((doc_id.as_py(), b"" if raw is None else raw.to_pybytes()))
        held += size
    if chunk:
        yield chunk


def _found(chunk: list[tuple[int | None, bytes]], planted: bool) -> Iterator[tuple[int | None, list[bytes], np.ndarray]]:
    """Per row of a chunk: id, words, runs with places counted from 0."""
    texts = []
    for doc_id, raw in chunk:
        words = raw.split()  # bytes are split at exactly [\x20\x09-\x0D]
        texts.append(planted_repeats(doc_id, words) if planted else words)
    number: dict[bytes, int] = {}
    sizes = np.array([len(words) for words in texts], np.int64)
    codes = np.fromiter((number.setdefault(w, len(number)) for words in texts for w in words), np.int64, int(sizes.sum()))
    found = runs(codes, np.repeat(np.arange(len(texts)), sizes))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    cut = np.searchsorted(found[:, 0], bounds)
    for k, words in enumerate(texts):
        yield chunk[k][0], words, found[cut[k] : cut[k + 1]] - np.array([bounds[k], 0, 0])


def _collapsed(words: list[bytes], found: np.ndarray) -> bytes:
    """The words outside all runs and those of each run's first period, joined by a space."""
    if not len(found):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, found[:, 0] + found[:, 2], 1)
    np.add.at(step, found[:, 0] + found[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)])


def _strongest(found: np.ndarray) -> tuple[int, int, int]:
    """The run of greatest length / period, exactly; ties to the smallest start, then period."""
    best = None
    for start, length, period in found.tolist():  # by start, then period: the first one stays
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of documents.

    A run is a longest stretch of words with smallest period q, words q apart being identical,
    of at least max(6, 4q) words; runs are listed by start, then period. ``collapsed`` holds
    the words that no run contains after its first q words, joined by one space.

    Words are what lies between ASCII white space; case and marks count. A null or empty text
    has no words and no runs; its collapsed text is empty. Repeated rows, and rows without an
    id, each get a row. An empty table gives an empty one. Other columns are not read. Texts
    are taken whole: memory follows the longest text, about 100 bytes a word.

    planted: put repeats into every tenth document first, see ``planted_repeats``.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(batch):
                out = [
                    (doc_id, len(words), [dict(zip(("start", "length", "period"), r)) for r in found.tolist()], _collapsed(words, found).decode())
                    for doc_id, words, found in _found(chunk, planted)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), COLUMNS)], schema=COLUMNS)

    return mapped(raw_texts(docs), rows, AS_DDL)


def run_digests(docs: DataFrame, planted: bool = False) -> DataFrame:
    """Per row of documents: doc_id, n_runs, the strongest run (start, length, period,
    exponent_milli; nulls without one) and digests of all runs and of the collapsed text.

    The runs are those of ``periodic_runs``, whose docstring holds here, too; only the digests
    leave the task, not the texts.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(batch):
                out = []
                for doc_id, words, found in _found(chunk, planted):
                    best = _strongest(found) if len(found) else (None, None, None)
                    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found.tolist()).encode()
                    out.append((
                        doc_id, len(found), *best, 1000 * best[1] // best[2] if len(found) else None,
                        hashlib.sha256(listed).hexdigest(), hashlib.sha256(_collapsed(words, found)).hexdigest(),
                    ))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), DIGEST)], schema=DIGEST)

    return mapped(raw_texts(docs), rows, DIGEST_DDL)
