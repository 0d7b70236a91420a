"""Token ids of whole texts from a public tokenizer, encoding each distinct word of a batch once.

A text is cut at single spaces that stand between two non-space characters. Both kinds
of tokenizer files used here cut there too, before merging, so the ids of a text are the
ids of its words in a row. Texts with other spacing, and texts that hold the beginning of
a special token, are encoded whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: int = 1 << 18) -> np.ndarray:
    """values[start : start + length] of every pair, in a row. Goes by ``step`` pairs, so that the
    index of one step is all that is held beside the result."""
    out, done = np.empty(int(lengths.sum()), values.dtype), 0
    for i in range(0, len(starts), step):
        length = lengths[i : i + step].astype(np.int64)
        n = int(length.sum())
        shift = starts[i : i + step] - (np.cumsum(length) - length)
        out[done : done + n] = values[np.arange(n) + np.repeat(shift, length)]
        done += n
    return out


GROUPS = 32  # groups of words encoded together: the tokenizer's own records of them are large


class TextEncoder:
    """Encodes texts to ids as ``Tokenizer.encode`` with ``add_special_tokens=False`` gives them."""

    def __init__(self, path: str, chunk: int = 200):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.chunk = Tokenizer.from_file(path), chunk
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        names = np.full(max(vocab.values(), default=-1) + 1, "", dtype=object)
        for token, number in vocab.items():
            names[number] = token
        # Either a word's first token begins with a space mark, or its last one has an end mark.
        self.word_ends = any(x.endswith("</w>") for x in vocab)
        mark = (lambda x: x.endswith("</w>")) if self.word_ends else (lambda x: x.startswith("Ġ"))
        self.edge = np.fromiter(map(mark, names), bool, len(names))
        # The model by itself takes words in the byte alphabet: a byte that prints stands for itself,
        # the others for the characters from 256 on.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        others = [b for b in range(256) if b <= 32 or 127 <= b <= 160 or b == 173]
        self.alphabet = {b: chr(256 + i) for i, b in enumerate(others)} | {32: " " if self.word_ends else " Ġ"}
        self.special = {t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.tails = {m: int(i[0]) for m in ".," if len(i := self.whole(m)) == 1}

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _words(self, words: list[str], simple: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that follow a space, in a row, and the number of ids of each. Simple words,
        of Latin letters only, are put into the model's alphabet here and need only its merges."""
        groups = [words[i : i + self.chunk] for i in range(0, len(words), self.chunk)]
        parts, lengths = [], []
        for i in range(0, len(groups), GROUPS):
            for group, ids in zip(groups[i : i + GROUPS], self._joined(groups[i : i + GROUPS], simple)):
                cuts = np.flatnonzero(self.edge[ids])
                if len(cuts) == len(group):
                    lengths.append(np.diff(cuts + 1, prepend=0) if self.word_ends else np.diff(cuts, append=len(ids)))
                else:  # some word is more than one to the tokenizer
                    single = [self.whole(" " + w) for w in group]
                    ids = np.concatenate(single)
                    lengths.append(np.array([len(x) for x in single]))
                parts.append(ids)
        if not parts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        return np.concatenate(parts), np.concatenate(lengths).astype(np.int64)

    def _joined(self, groups: list[list[str]], simple: bool) -> list[np.ndarray]:
        """Ids of each group of words, a space before each word."""
        joined = [" " + " ".join(g) for g in groups]
        if simple:
            joined = [(t.lower() if self.word_ends else t).encode().decode("latin-1").translate(self.alphabet) for t in joined]
        found = (self.merges if simple else self.tokenizer).encode_batch_fast(joined, add_special_tokens=False)
        return [np.asarray(one.ids, dtype="<u4") for one in found]

    def _table(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words in a row, their numbers, and whether a word may stand alone.

        A closing full stop or comma is always a token of its own after a letter, so only
        the part before it is encoded.
        """
        core_of: dict[str, int] = {}
        odd: dict[str, int] = {}
        at, tail, safe = np.zeros(len(words), np.int64), np.full(len(words), -1), np.ones(len(words), bool)
        for i, w in enumerate(words):
            end = self.tails.get(w[-1:])
            core = w if end is None else w[:-1]
            if core.isalpha() and (core.islower() or core.lower().isalpha()):
                at[i] = core_of.setdefault(core, len(core_of))
                if end is not None:
                    tail[i] = end
            elif w and not w[0].isspace() and not w[-1].isspace():
                at[i] = -1 - odd.setdefault(w, len(odd))
            else:
                safe[i] = False
        cores = list(core_of)
        simple = np.fromiter((w.isascii() or max(w) < "\u0250" and "\u0130" not in w for w in cores), bool, len(cores))
        place = np.where(simple, np.cumsum(simple) - 1, simple.sum() + np.cumsum(~simple) - 1)
        found = [self._words([w for w, x in zip(cores, simple) if x], simple=True), self._words([w for w, x in zip(cores, simple) if not x])]
        if self.word_ends:  # other words may be several to the tokenizer
            single = [self.whole(" " + w) for w in odd]
            found.append((np.concatenate([np.zeros(0, "<u4"), *single]), np.array([len(x) for x in single], np.int64)))
        else:
            found.append(self._words(list(odd)))
        ids, lengths = (np.concatenate(x) for x in zip(*found))
        ids = ids.astype("<u4", copy=False)
        if len(cores):
            at = np.where(at < 0, len(cores) - 1 - at, place[np.maximum(at, 0)])
        else:
            at = np.where(at < 0, -1 - at, at)
        if not len(lengths):
            return ids, np.zeros(len(words), np.int64), safe
        starts = np.cumsum(lengths) - lengths
        core_length = np.where(safe, lengths[at], 0)
        has_tail = tail >= 0
        length = core_length + has_tail
        table = np.empty(int(length.sum()), "<u4")
        inner = np.ones(len(table), bool)
        inner[np.cumsum(length)[has_tail] - 1] = False
        table[inner] = ragged(ids, starts[at], core_length)
        table[~inner] = tail[has_tail]
        return table, length, safe

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (with the end)."""
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        cut = pc.split_pattern(texts.cast(pa.large_string()), " ")
        coded = cut.values.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int32)
        bounds = cut.offsets.to_numpy().astype(np.int64)
        words = coded.dictionary.to_pylist()
        del cut, coded
        table, length, safe = self._table(words)
        heads, unsafe = bounds[:-1], ~safe[code]
        unsafe[heads] = False
        bad = np.add.reduceat(unsafe, heads) > 0
        for x in self.special:
            bad |= np.asarray(pc.match_substring(texts, x, ignore_case=True))
        first = [words[i] for i in code[heads]]
        bad |= np.fromiter((w[-1:].isspace() or (not w and n > 1) for w, n in zip(first, np.diff(bounds))), bool, len(first))
        # Beside the words: a text's first word, which follows no space, or a text encoded whole.
        alone = [self.whole(texts[i].as_py() if bad[i] else w) if w or bad[i] else np.zeros(0, "<u4") for i, w in enumerate(first)]
        table = np.concatenate([table, *alone]).astype("<u4", copy=False)
        length = np.concatenate([length, [len(x) for x in alone]]).astype(np.int64)
        code[heads] = len(words) + np.arange(len(heads))
        length = length.astype(np.int32)
        per_word = length[code]
        drop = np.repeat(bad, np.diff(bounds))
        drop[heads] = False
        per_word[drop] = 0
        begin = np.cumsum(length, dtype=np.int64) - length
        step = 1 << 18  # words
        per_text = np.add.reduceat(per_word, heads, dtype=np.int64)
        ids, done = np.empty(int(per_text.sum()), "<u4"), 0
        for i in range(0, len(code), step):
            part = ragged(table, begin[code[i : i + step]], per_word[i : i + step])
            ids[done : done + len(part)] = part
            done += len(part)
        return ids, np.concatenate([[0], np.cumsum(per_text)])


def encoder_of(path: str) -> TextEncoder:
    """The encoder of a tokenizer file, loaded once in a worker process and kept for its later
    tasks; the last one only. It is kept with the tokenizers library, as this module travels with
    every task anew."""
    import tokenizers

    key, held = (path, os.stat(path).st_mtime_ns), getattr(tokenizers, "_fieldbook_encoder", None)
    if held is None or held[0] != key:
        held = tokenizers._fieldbook_encoder = key, TextEncoder(path)
    return held[1]
