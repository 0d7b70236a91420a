"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of tags and words. Each word scores the probability that a word in its
place (the elements around it, their classes, whether it is a link) belongs to the article;
each tag costs its improbability, times a factor. One linear scan finds the contiguous
stretch of greatest sum: the content region. Blocks within it whose words are improbable by
themselves (adverts, forms, asides within an article) are left out of the text.

Probabilities come from a logistic regression learned from labelled pages, and so does the
factor: the one of ``FACTORS`` whose texts agree best with the labels. ``layouts.PAGES`` are
the labelled pages at hand; ``learn`` takes any others of the same form.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import mapped
from fieldbook.llm.layouts import PAGES

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"  # comments; one without an end takes the rest
    r"|<(?P<raw>script|style|title|textarea|xmp)\b[^>]*>(?:.*?</(?P=raw)[^>]*(?:>|$)|.*)"  # contents are no markup
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?(?P<name2>[a-z][^\s/>]*)[^>]*>"  # a quote without its end
    r"|<[/!?][^>]*>"
    r"|<[/a-z!?][^>]*$",  # cut off
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|aria-label|hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody tfoot thead tr ul".split()
)
#: Cells of a row stand in one block, with a space between.
SPACED = frozenset("td th br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("noscript template svg iframe object select button audio video canvas map datalist math".split())
#: Elements without a say of their own.
NEUTRAL = frozenset("html body div span section tbody table tr td th thead tfoot p b i em strong br hr center font".split())
LANDMARKS = frozenset("article main aside nav header footer form".split())
#: An opening tag of the first kind ends the innermost of the second, as their end tags may be left out.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: ... but not beyond these.
HOLD = frozenset("ul ol dl table menu select body article section div".split())
FACTORS = (1.0, 2.0, 3.0, 4.0, 6.0, 8.0)
#: Added to the log-odds without any feature: labelled pages are short, and have more around
#: their articles than pages have on average.
SHIFTS = (0.0, 0.5, 1.0, 1.5, 2.0, 2.5)
#: The log-odds around an element count up to these bounds for what is in it, so that an advert
#: stays one however much like an article its surroundings look.
HELD = (-6.0, 2.0)
#: Within the region, blocks of words less probable than this are left out.
LEAST = 0.25


@dataclass(frozen=True)
class Weights:
    """Log-odds per feature, the log-odds without any, and the cost factor of tags."""

    of: dict[str, float]
    bias: float
    factor: float

    def odds(self, features: Sequence[str]) -> float:
        return sum(self.of.get(f, 0.0) for f in features)


def _names(rest: str) -> tuple[list[str], bool]:
    """Words of an element's class, id, role ..., and whether it is hidden."""
    words, hidden = [], False
    for key, value in ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden":
            hidden |= value.lower() != "until-found"
        elif key == "style":
            hidden |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE) is not None
        else:
            words += [w.lower() for w in NAME_PART.findall(value)]
    return words, hidden


def features(name: str, rest: str, outer: str) -> tuple[list[str], bool]:
    """What an element says about the words in it, and whether it is hidden.

    outer: the nearest landmark element around it."""
    words, hidden = _names(rest) if rest else ([], False)
    own = [] if name in NEUTRAL else [f"<{name}>"]
    if name in LANDMARKS and outer:
        own.append(f"<{outer}><{name}>")
    # A name in the plural says the same, and a name joined of two says both.
    own += sorted({f".{w[:-1] if len(w) > 3 and w.endswith('s') else w}" for w in words})
    return own, hidden or name in HIDDEN


class Element:
    __slots__ = ("name", "odds", "hidden", "landmark", "own")

    def __init__(self, name, odds, hidden, landmark, own):
        self.name, self.odds, self.hidden, self.landmark, self.own = name, odds, hidden, landmark, own


def tokens(html: str, weights: Weights | None) -> Iterator[tuple[str, str, float, tuple]]:
    """(kind, text, log-odds, features) of a page's tags and stretches of text in order; a kind
    is "text", "block" (a tag at which blocks end), "space" or "inline". Features are given only
    without weights, for learning."""
    stack = [Element("", weights.bias if weights else 0.0, False, "", ())]
    known: dict[tuple[str, str, str], tuple[float, bool, tuple]] = {}
    done = 0

    def said(name: str, rest: str, outer: str) -> tuple[float, bool, tuple]:
        key = (name, rest, outer)
        if key not in known:
            own, hidden = features(name, rest, outer)
            known[key] = (weights.odds(own) if weights else 0.0, hidden, tuple(own))
        return known[key]

    def gathered() -> tuple:
        return () if weights else tuple({f for e in stack for f in e.own})

    for m in TOKEN.finditer(html):
        if m.start() > done and not stack[-1].hidden:
            yield "text", html[done : m.start()], stack[-1].odds, gathered()
        done = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            if m["raw"] and not stack[-1].hidden:
                yield "inline", "", stack[-1].odds, gathered()
            continue
        kind = "block" if name in BLOCKS else "space" if name in SPACED else "inline"
        if m["end"] or html[m.start() + 1] == "/":
            if not stack[-1].hidden:
                yield kind, name, stack[-1].odds, gathered()
            # Close up to the element of that name, if there is one open; an inline one ends no block.
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
                if kind == "inline" and name not in HIDDEN and stack[i].name in BLOCKS:
                    break
            continue
        for i in range(len(stack) - 1, 0, -1) if name in ENDS else ():
            if stack[i].name in ENDS[name]:
                del stack[i:]
                break
            if stack[i].name in HOLD:
                break
        if kind == "block":  # a paragraph ends where another block begins
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p":
                    del stack[i:]
                    break
                if stack[i].name in BLOCKS:
                    break
        top = stack[-1]
        rest = m["rest"] or ""
        if name in VOID or rest.endswith("/") and name in HIDDEN:
            if not top.hidden:
                yield kind, name, top.odds, gathered()
            continue
        odds, hidden, own = said(name, rest.strip(), top.landmark)
        if kind != "inline" or name in HIDDEN or own:
            landmark = name if name in LANDMARKS else top.landmark
            held = min(max(top.odds, HELD[0]), HELD[1]) if own else top.odds
            stack.append(Element(name, held + odds, top.hidden or hidden, landmark, own))
        if not stack[-1].hidden:
            yield kind, name, stack[-1].odds, gathered()
    if done < len(html) and not stack[-1].hidden:
        yield "text", html[done:], stack[-1].odds, gathered()


def region(scores: Sequence[float]) -> tuple[int, int]:
    """Begin and end of the contiguous stretch of greatest sum, in one pass; the longest of
    equals, then the first. (0, 0) if no sum is positive."""
    best, at, begin, total = (0.0, 0), (0, 0), 0, 0.0
    for i, x in enumerate(scores):
        if total < 0:
            begin, total = i, 0.0
        total += x
        if (total, i + 1 - begin) > best and total > 0:
            best, at = (total, i + 1 - begin), (begin, i + 1)
    return at


def probability(odds: float) -> float:
    return 1 / (1 + math.exp(-max(odds, -30.0)))


def score(kind: str, odds: float, words: int, factor: float) -> float:
    """What a token adds to the sum: words score their probability, a tag costs its improbability."""
    return probability(odds) * words if kind == "text" else -factor * (1 - probability(odds))


def main_text(html: str | None, weights: Weights) -> str:
    """The main text of one page: its blocks, joined by two line ends."""
    found = [
        (kind, odds, "" if kind != "text" else unescape(text) if "&" in text else text)
        for kind, text, odds, _ in tokens(html or "", weights)
    ]
    begin, end = region([score(kind, odds, len(text.split()), weights.factor) for kind, odds, text in found])
    blocks, parts = [], []
    for kind, odds, text in found[begin:end]:
        if kind == "text":
            parts.append(text if probability(odds) >= LEAST else "")
        elif kind == "space":
            parts.append(" ")
        elif kind == "block" and parts:
            blocks.append(" ".join("".join(parts).split()))
            parts = []
    blocks.append(" ".join("".join(parts).split()))
    return "\n\n".join(b for b in blocks if b)


def _labelled(page: str, weights: Weights | None = None) -> list[tuple[str, tuple, float, int, bool, bool]]:
    """(kind, features, log-odds, words, in the region, article text) of a labelled page's tokens."""
    out, within, aside = [], False, False
    for kind, text, odds, has in tokens(page, weights):
        for piece in re.split(r"(\[\[|\]\]|\{\{|\}\})", text) if kind == "text" else [None]:
            if piece in ("[[", "]]"):
                within = piece == "[["
            elif piece in ("{{", "}}"):
                aside = piece == "{{"
            elif piece is None or piece.strip():
                out.append((kind, has, odds, len(piece.split()) if piece else 0, within, within and not aside))
    return out


@lru_cache(maxsize=4)
def learn(pages: tuple[str, ...] = tuple(PAGES), penalty: float = 0.1, rounds: int = 100) -> Weights:
    """Weights from labelled pages (see ``layouts``): a logistic regression over all their words
    and tags by Newton steps, then shift and factor. Runs on the driver; the pages are few."""
    rows = [(has, max(words, 1), inside) for page in pages for _, has, _, words, _, inside in _labelled(page)]
    names = sorted({f for has, _, _ in rows for f in has})
    number = {f: i + 1 for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names) + 1))
    x[:, 0] = 1
    for row, (has, _, _) in zip(x, rows):
        row[[number[f] for f in has]] = 1
    y = np.array([inside for *_, inside in rows], float)
    weight = np.sqrt([n for _, n, _ in rows])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w)))
        slope = x.T @ (weight * (p - y)) + ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    of, bias = dict(zip(names, w[1:].tolist())), float(w[0])

    def agreement(weights: Weights) -> int:
        """Words rightly taken or left out."""
        right = 0
        for page in pages:
            marked = _labelled(page, weights)
            begin, end = region([score(kind, odds, words, weights.factor) for kind, _, odds, words, _, _ in marked])
            for i, (_, _, odds, words, _, inside) in enumerate(marked):
                right += words * (inside == (begin <= i < end and probability(odds) >= LEAST))
        return right

    return max((Weights(of, bias + shift, factor) for shift in SHIFTS for factor in FACTORS), key=agreement)


def main_texts(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages, from its whole html.

    Text keeps the article's blocks in page order, joined by two line ends: character
    references decoded, white space within a block (line breaks and the borders of table cells
    included) as one space, ends trimmed. Left out are scripts, styles, comments of the markup,
    hidden elements, and all that the method scores as no article text. A page without markup
    is one block. Markup that is cut off or never closed is read as browsers do.

    A null or empty html gives an empty text and 0 characters; so does a page without article
    words. Null ids and urls stay; repeated rows each get a row; an empty table gives an empty
    one; columns other than page_id, url and html are not read. The work is one pass without a
    shuffle, with one page at a time in a task's memory.
    """
    weights = weights or learn()
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py(), weights) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                schema=fields,
            )

    taken = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return mapped(taken, rows, "page_id long, url string, text string, n_chars long")
