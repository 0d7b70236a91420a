"""Words of a batch of texts, each distinct word held once, and hashed parts of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LARGE = pa.large_string()
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…¿¡–—"


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The lower-cased words of texts as numbers of distinct words, where each text's words
    begin (with the end), and the distinct words, without marks at their ends. Words that are
    only marks become the empty word, which keeps its place."""
    lowered = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    cut = pc.utf8_split_whitespace(lowered)
    coded = cut.values.dictionary_encode()
    bare = pc.utf8_trim(coded.dictionary, EDGES).dictionary_encode()
    code = bare.indices.to_numpy().astype(np.int64)[coded.indices.to_numpy()]
    return code, cut.offsets.to_numpy().astype(np.int64), bare.dictionary


def parts_of_words(words: pa.Array, sizes: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, the hashed byte n-grams of <word> as pairs (number of the word, bucket).

    buckets: a power of two."""
    framed = pc.binary_join_element_wise(pa.scalar("<", LARGE), words.cast(LARGE), pa.scalar(">", LARGE), pa.scalar("", LARGE))
    if not len(framed):
        return
    buffers, offset = framed.buffers(), framed.offset
    ends = np.frombuffer(buffers[1], np.int64)[offset : offset + len(framed) + 1]
    raw = np.frombuffer(buffers[2], np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    owner = np.repeat(np.arange(len(framed)), np.diff(ends))
    shift = np.uint64(64 - (buckets - 1).bit_length())
    for n in sizes:
        if len(raw) < n:
            continue
        h = np.zeros(len(raw) - n + 1, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + raw[i : len(raw) - n + 1 + i] + np.uint64(1)
        inside = owner[: len(raw) - n + 1] == owner[n - 1 :]
        mixed = (h[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        yield owner[: len(raw) - n + 1][inside], ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> shift).astype(np.int64)


def spans(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of spans of up to ``size`` places within each range, and each span's range."""
    lengths = np.diff(bounds)
    n = -(-lengths // size)
    owner = np.repeat(np.arange(len(lengths)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return bounds[:-1][owner] + nth * size, owner
