"""Quality rules, lines first: clean a text line by line, then judge what the cleaning took.

A line is taken out if one of these holds: it ends as no sentence does (punctuation), it is a
menu (navigation), or it is a notice of the kind that sites repeat (boilerplate). A document
is rejected if it fails the base rules, or if the lines taken out hold more than ``MOST_LOST`` of
its words.

Sentences end with the marks of any script that has some; Thai and Lao, which part sentences by
a space, may end with a letter. A menu is told by its form, short items between separators, or
by its words; menu words and notices are those of the corpus's languages: English, German,
French and Spanish.

Words are runs of anything but ASCII white space. Null or empty text: no words, one empty line,
rejected. Null id: judged like any other. Repeated rows: judged each. Empty table: no rows. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldbook.llm.common import mapped, raw_texts

LEAST_WORDS, MOST_REPEATED = 50, 50  # words; per cent of words in repeated runs of RUN words
RUN = 3
MOST_LOST = 0.5
SYMBOLS = b"#*$%&|<>"
SYMBOLS_PER_WORD = 0.2
LONG_LINE = 8  # words from which a line may end without a mark if it has one inside

# Marks that end a sentence (or lead to the next line) by script, what may close after
# them, and marks within sentences.
END_MARKS = ".!?:;…‥‼⁇⁈⁉。！？；：｡．।॥؟۔؛։׃།༎။።፧។៕᙮᠃"
CLOSING = "\"')]}”’»“›」』）】"
INNER_MARKS = ".!?,…。！？，、،।॥؟۔؛։።、၊፣·"
#: Thai and Lao letters: a line may end with one.
UNMARKED = (0x0E00, 0x0EFF)
SEPARATORS = "|»›>·•"
# Words of menus, and beginnings of repeated notices.
MENU = (
    "home about contact login logout register search menu sitemap help faq blog news next previous "
    "startseite kontakt impressum anmelden abmelden registrieren suche hilfe weiter datenschutz "
    "accueil connexion inscription recherche aide plan actualités suivant contactez-nous "
    "inicio contacto acceso registro buscar ayuda mapa noticias siguiente anterior"
).split()
BEGINNING = r"^[ \t]*"  # for words that sentences have, too
NOTICE_WORDS = [
    r"all rights reserved", r"copyright (?:\(c\)|©|[0-9]{4})", r"terms of (?:use|service)", r"privacy policy", r"cookie policy", r"we use cookies", r"accept cookies",
    r"subscribe to our", r"sign up for", r"click here", r"read more", r"share this", r"follow us on", r"skip to (?:main )?content", BEGINNING + r"back to top", BEGINNING + r"powered by",
    r"alle rechte vorbehalten", BEGINNING + r"nutzungsbedingungen", r"datenschutz(?:erklärung|richtlinie|bestimmungen)", r"cookie-richtlinie", r"wir verwenden cookies", r"cookies akzeptieren",
    r"newsletter abonnieren", r"hier klicken", r"klicken sie hier", BEGINNING + r"weiterlesen", r"folgen sie uns", r"zum (?:haupt)?inhalt springen", BEGINNING + r"(?:zurück )?nach oben", BEGINNING + r"bereitgestellt von",
    r"tous droits réservés", r"conditions (?:générales )?d(?:'|’)utilisation", r"politique de confidentialité", r"politique (?:de|relative aux) cookies", r"nous utilisons des cookies",
    r"accepter les cookies", r"abonnez-vous", r"inscrivez-vous à", r"cliquez ici", BEGINNING + r"lire la suite", BEGINNING + r"en savoir plus", r"suivez-nous", r"aller au contenu", BEGINNING + r"(?:retour en )?haut de page", BEGINNING + r"propulsé par",
    r"todos los derechos reservados", r"términos (?:de uso|del servicio|y condiciones)", r"política de (?:privacidad|cookies)", r"(?:utilizamos|usamos) cookies", r"aceptar (?:las )?cookies",
    r"suscr(?:íbete|íbase) a", r"regístrate (?:en|para)", r"ha(?:ga|z) clic aquí", BEGINNING + r"leer más", r"síguenos en", r"(?:ir|saltar) al contenido", BEGINNING + r"volver arriba", BEGINNING + r"desarrollado por",
]


def either_case(pattern: str) -> str:
    """The pattern with each letter beyond ASCII in both cases, as only ASCII is lower-cased."""
    return "".join(f"(?:{c}|{c.upper()})" if ord(c) > 127 and c.upper() != c else c for c in pattern)


# As alternatives, since a class of bytes would take characters beyond ASCII apart.
def one_of(characters: str) -> bytes:
    return b"(?:" + b"|".join(re.escape(c).encode() for c in characters) + b")"


NOTICES = re.compile("|".join(map(either_case, NOTICE_WORDS)).encode())
ENDS = re.compile(one_of(END_MARKS) + one_of(CLOSING) + b"*$")
INSIDE = re.compile(one_of(INNER_MARKS))
UNMARKED_END = re.compile(rb"\xe0[\xb8-\xbb][\x80-\xbf]" + one_of(CLOSING) + b"*$")
SEPARATOR = re.compile(b"^" + one_of(SEPARATORS + "/-") + b"$")
MENU_BYTES = {w.encode() for w in MENU}
ITEM_WORDS = 3  # words of a menu's items, at most on average
SHORT_NOTICE = 25  # words up to which a line that holds a notice is one


def failing(line: bytes) -> str | None:
    """The first rule that a line with words fails."""
    words = line.split()
    lowered = line.lower()
    marks = len(line) - len(line.translate(None, SYMBOLS))
    if marks > SYMBOLS_PER_WORD * len(words) and marks >= 3:
        separators = sum(1 for w in words if SEPARATOR.match(w))
        return "navigation" if 2 * separators >= marks else "punctuation"
    between = sum(w.decode("utf-8", "replace") in SEPARATORS for w in words if len(w) <= 3)
    if between >= 2 and len(words) - between <= ITEM_WORDS * (between + 1):
        return "navigation"
    bare = [w.strip(b".,:;|>-/") for w in lowered.split()]
    if len(words) >= 2 and 2 * sum(w in MENU_BYTES or not w for w in bare) > len(words):
        return "navigation"
    if len(words) <= SHORT_NOTICE and NOTICES.search(lowered):
        return "boilerplate"
    end = line.rstrip()
    if not ENDS.search(end) and not UNMARKED_END.search(end) and not (len(words) >= LONG_LINE and INSIDE.search(line)):
        return "punctuation"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words that are in a run of RUN words found at least twice."""
    n = len(words) - RUN + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    code = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    run = code[:n]
    for i in range(1, RUN):  # numbered anew each time, so codes stay small
        _, run = np.unique(run * len(number) + code[i : i + n], return_inverse=True)
    again = np.bincount(run)[run] > 1
    covered = np.zeros(len(words), bool)
    for i in range(RUN):
        covered[i : i + n] |= again
    return int(covered.sum())


def judge(text: bytes, with_text: bool = True) -> dict:
    words = text.split()
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    n_dup = lost = removed = 0
    left = []
    for line in lines:
        size = len(line.split())
        if size:
            n_dup += line in seen
            seen.add(line)
            if failing(line):
                lost, removed = lost + size, removed + 1
                continue
        left.append(line)
    n, repeated = len(words), repeated_words(words)
    failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
    return {
        "n_words": n, "word_chars": len(b"".join(words).decode("utf-8", "replace")),
        "n_symbols": len(text) - len(text.translate(None, SYMBOLS)), "n_dup_lines": n_dup, "n_repeat_words": repeated,
        "base_failed": failed, "kept": not failed and lost <= MOST_LOST * n,
        "lines_removed": removed, "words_removed": lost, "cleaned": b"\n".join(left).decode("utf-8", "replace") if with_text else None,
    }


COLUMNS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(), "kept": pa.bool_(), "lines_removed": pa.int64(), "words_removed": pa.int64(), "cleaned": pa.string(),
}


def clean(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept, what was removed and, if asked for, the cleaned text."""
    names = [c for c in COLUMNS if with_text or c != "cleaned"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(t.as_py(), with_text) for t in batch.column("text")]
            columns = [pa.array([f[c] for f in found], COLUMNS[c]) for c in names]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])

    kinds = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string"}
    return mapped(raw_texts(docs), run, ", ".join(["doc_id long", *(f"{c} {kinds[COLUMNS[c]]}" for c in names)]))


def as_class(characters: str) -> str:
    """A class of characters for a pattern within SQL text."""
    return "[" + re.sub(r"([\]\[\\^-])", r"\\\1", characters).replace("'", "''") + "]"


SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM (SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
n AS (SELECT row, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars FROM w GROUP BY row),
t AS (SELECT row, pos, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM w WINDOW p AS (PARTITION BY row ORDER BY pos)),
c AS (SELECT row, pos, count(*) OVER (PARTITION BY row, w, w2, w3) AS n FROM t WHERE w3 IS NOT NULL),
r AS (SELECT row, count(DISTINCT pos + k) AS n_repeat_words FROM c, (SELECT unnest([0, 1, 2]) AS k) WHERE n >= 2 GROUP BY row),
l AS (SELECT row, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM (SELECT row, string_split(text, chr(10)) AS lines FROM d)),
m AS (
    SELECT row, line, len(ws) AS n, nth, len(list_filter(ws, lambda x: list_contains({list(SEPARATORS)}, x))) AS between, length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS marks, {LOWERED.format('line')} AS lowered,
        list_transform(ws, lambda x: trim({LOWERED.format('x')}, '.,:;|>-/')) AS bare, rtrim(line, {SPACE}) AS bared
    FROM (SELECT row, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws, row_number() OVER (PARTITION BY row, line ORDER BY i) AS nth FROM l)),
f AS (
    SELECT row, n, nth, (marks > {SYMBOLS_PER_WORD}::DOUBLE * n AND marks >= 3)
        OR (n >= 2 AND 2 * len(list_filter(bare, lambda x: x = '' OR list_contains({sorted(MENU)}, x))) > n)
        OR (between >= 2 AND n - between <= {ITEM_WORDS} * (between + 1))
        OR (n <= {SHORT_NOTICE} AND regexp_matches(lowered, '{NOTICES.pattern.decode().replace("'", "''")}'))
        OR (NOT regexp_matches(bared, '{as_class(END_MARKS)}{as_class(CLOSING)}*$') AND NOT regexp_matches(bared, '[\x{{{UNMARKED[0]:04X}}}-\x{{{UNMARKED[1]:04X}}}]{as_class(CLOSING)}*$')
            AND NOT (n >= {LONG_LINE} AND regexp_matches(line, '{as_class(INNER_MARKS)}'))) AS fails
    FROM m WHERE n > 0),
s AS (SELECT row, count(*) FILTER (nth > 1) AS n_dup_lines, count(*) FILTER (fails) AS lines_removed, coalesce(sum(n) FILTER (fails), 0)::BIGINT AS words_removed FROM f GROUP BY row),
a AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lines_removed, 0) AS lines_removed,
        coalesce(words_removed, 0) AS words_removed FROM d LEFT JOIN n USING (row) LEFT JOIN r USING (row) LEFT JOIN s USING (row)),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND words_removed <= {MOST_LOST}::DOUBLE * n_words AS kept, lines_removed, words_removed FROM b"""
