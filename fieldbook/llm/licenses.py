"""License scans by diagonal voting.

Every rolling run of ``RUN`` word hashes of a document is joined with the positions that the run
has in the templates, a bounded table. A hit votes for its diagonal, document position less
template position. A phrase or notice is found where a diagonal has all its votes. For changed
notices, the other near diagonals (words put in or left out move the rest to a neighbour) are
merged into one span, and the span is verified: of the words in span and template together, at
least ``SIMILAR`` must be matched. Where the merged span fails, as with changed copies side by
side, each of its diagonals is verified as a span of its own. Licenses of one family share most
words, so their notices mark the runs that differ (names, versions): a span without one of these
has half its similarity, which is below ``SIMILAR``.

Only hits and one line per document are shuffled. Words are runs of ASCII letters and digits, A-Z
lower-cased, and of anything beyond ASCII.

Null or empty text: no words, no places. Null id: scanned like any other. Repeated rows: scanned
each, as rows are told apart by their place in the table. Places that tie share the result: the
smallest and largest starts are told. Empty table: no rows. Columns other than doc_id and text are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import mapped, raw_texts

RUN = 3
SIMILAR = 0.8
NEAR = 4  # diagonals apart that may belong together
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# The phrases of the base scan, and standard license notices.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# A * marks the first word of a run that tells a license from its relatives.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit",
    "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit",
    "licensed under the apache license *version 2 0 the license you may not use this file except in compliance with the license": "apache-2",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-2",
    "licensed under the creative commons *attribution 4 0 international license": "cc-by",
    "licensed under the creative commons attribution *noncommercial 4 0 international license": "cc-by-nc",
    "licensed under the creative commons attribution *sharealike 4 0 international license": "cc-by-sa",
    "this work is licensed under the *gnu general public *license version 2": "gpl-2",
    "this work is licensed under the *gnu general public *license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the *gnu general public license as published by the free software foundation either *version 2 of the license": "gpl-2",
    "this program is free software you can redistribute it and or modify it under the terms of the *gnu general public license as published by the free software foundation either *version 3 of the license": "gpl-3",
    "this library is free software you can redistribute it and or modify it under the terms of the *gnu lesser general public license as published by the free software foundation either *version 2 1 of the license": "lgpl-2.1",
    "this library is free software you can redistribute it and or modify it under the terms of the *gnu lesser general public license as published by the free software foundation either *version 3 of the license": "lgpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the *gnu affero general public license as published by the free software foundation either *version 3 of the license": "agpl-3",
    "licensed under the *gnu lesser general public license *version 2 1": "lgpl-2.1",
    "licensed under the *gnu lesser general public *license version 3": "lgpl-3",
    "licensed under the *gnu affero general public *license version 3": "agpl-3",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this source code form is subject to the terms of the mozilla public license *v 2 0": "mpl-2",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
# Identifiers of the same licenses in the one-line form of source files.
IDENTIFIERS = {
    "mit": "mit", "apache 2 0": "apache-2", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "isc": "isc", "mpl 2 0": "mpl-2", "unlicense": "unlicense",
    "gpl 2 0": "gpl-2", "gpl 3 0": "gpl-3", "lgpl 2 1": "lgpl-2.1", "lgpl 3 0": "lgpl-3", "agpl 3 0": "agpl-3",
    "cc by 4 0": "cc-by", "cc by nc 4 0": "cc-by-nc", "cc by sa 4 0": "cc-by-sa",
}


def identifier_line(name: str) -> str:
    """The notice of an identifier; all its runs that hold a word of the name are needed."""
    words = f"spdx license identifier {name}".split()
    return " ".join(f"*{w}" if 0 < i <= len(words) - RUN else w for i, w in enumerate(words))


NOTICES |= {identifier_line(name): label for name, label in IDENTIFIERS.items()}


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_digest

    return np.frombuffer(b"".join([xxh64_digest(w) for w in words]), ">u8").astype(np.uint64)


def run_hashes(hashes: np.ndarray) -> np.ndarray:
    """A hash of each RUN consecutive words, as signed numbers."""
    if len(hashes) < RUN:
        return np.zeros(0, np.int64)
    n = len(hashes) - RUN + 1
    rolled = np.zeros(n, np.uint64)
    for i in range(RUN):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    rolled ^= rolled >> np.uint64(31)
    return (rolled * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def templates(phrases: dict[str, str], notices: dict[str, str]) -> list[tuple[int, int, int, int, str, bool, list[int]]]:
    """(run hash, template, position in it, words in it, label, whether it is a phrase, positions of the runs needed)."""
    out = []
    for k, (text, label, exact) in enumerate([(t, x, True) for t, x in phrases.items()] + [(t, x, False) for t, x in notices.items()]):
        words = text.replace("*", "").encode().split()
        needed = [i for i, w in enumerate(text.split()) if w.startswith("*")]
        if len(words) < RUN or any(i > len(words) - RUN for i in needed):
            raise ValueError(f"a template needs {RUN} words, and {RUN} from each mark: {text}")
        out += [(int(h), k, i, len(words), label, exact, needed) for i, h in enumerate(run_hashes(word_hashes(words)))]
    return out


def rolled(docs: DataFrame) -> DataFrame:
    """One line per row of documents (position -1, with the number of words), and one per run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                own, at, hashed, number, ids = [], [], [], [], []
                for i, t in zip(part.column("doc_id").to_pylist(), part.column("text")):
                    words = WORD.findall(t.as_py().lower())
                    found = run_hashes(word_hashes(words)) if words else np.zeros(0, np.int64)
                    own.append(np.full(len(found) + 1, row))
                    at.append(np.arange(-1, len(found)))
                    hashed.append(np.concatenate([[0], found]).astype(np.int64))
                    number.append(len(words))
                    ids.append(i)
                    row += 1
                sizes = [len(x) for x in at]
                repeat = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                columns = [
                    pa.array(np.concatenate(own)), pa.array(ids, pa.int64()).take(repeat), pa.array(np.array(number, np.int64)).take(repeat),
                    pa.array(np.concatenate(at)), pa.array(np.concatenate(hashed)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_words", "pos", "h"])

    return mapped(raw_texts(docs), run, "row long, doc_id long, n_words long, pos long, h long")


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """What a scan finds: one line per row of documents (row, doc_id, n_words), and the spans
    (also template, label, exact, low, high, whole, similar, and ``parts``, the diagonals merged)."""
    spark = docs.sparkSession
    table = spark.createDataFrame(templates(phrases, notices), "h long, template int, t long, size int, label string, exact boolean, needed array<int>")
    joined = rolled(docs).join(F.broadcast(table), "h", "left")  # a table of our own constants
    votes = joined.where("pos < 0 or template is not null")
    diagonals = votes.groupBy("row", "doc_id", "n_words", "template", "label", "exact", "size", (F.col("pos") - F.col("t")).alias("diagonal")).agg(
        F.count("t").alias("votes"), F.first("needed").alias("needed"), F.collect_set("t").alias("at"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    whole = F.coalesce(F.col("votes") == F.col("size") - RUN + 1, F.lit(False))
    split = diagonals.withColumn("whole", whole).withColumn("alone", whole | F.coalesce(F.col("exact"), F.lit(True)))
    # Neighbouring diagonals of a changed notice are one span, as long as its words are near, too.
    along = Window.partitionBy("row", "template", "alone").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > NEAR
    island = F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(along)
    spans = split.withColumn("island", F.when(F.col("alone"), F.col("diagonal")).otherwise(island)).withColumn("similar", similarity())
    merged = spans.groupBy("row", "doc_id", "n_words", "template", "label", "exact", "size", "alone", "island").agg(
        F.first("needed").alias("needed"), F.flatten(F.collect_list("at")).alias("at"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("whole").alias("whole"),
        F.collect_list(F.struct("low", "high", "similar")).alias("parts"))
    return merged.withColumn("similar", similarity()).drop("at", "needed")


def similarity() -> Column:
    """Of the words in a span and its template together, how many are matched; half of it where a
    run that tells the template from its relatives is missing."""
    told = F.when(F.size(F.array_except(F.col("needed").cast("array<bigint>"), "at")) > 0, F.lit(0.5)).otherwise(F.lit(1.0))
    matched = F.size(F.array_distinct(F.flatten(F.transform("at", lambda t: F.sequence(t, t + RUN - 1)))))
    return told * F.least(2 * matched / (F.col("high") - F.col("low") + RUN + F.col("size")), F.lit(1.0))


def licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word and last_word (of the phrases' places),
    base_labels, labels, score (the best span's similarity) and spans."""
    place, notice = F.col("exact") & F.col("whole"), ~F.col("exact")
    span = lambda p: F.struct("label", p.low.alias("first_word"), (p.high + RUN - 1).alias("last_word"), p.similar.alias("similarity"))
    similar = F.when(place, F.lit(1.0)).when(notice, F.col("similar")).otherwise(F.lit(0.0))
    found = scan(docs, phrases, notices).withColumn("similar", similar).withColumn("span", F.struct("low", "high", "similar"))
    told = F.when(F.col("similar") >= SIMILAR, F.array("span")).when(notice, F.filter("parts", lambda p: p.similar >= SIMILAR)).otherwise(F.array().cast("array<struct<low:bigint,high:bigint,similar:double>>"))
    found = found.withColumn("told", F.transform(told, span)).withColumn(
        "similar", F.when(notice, F.greatest("similar", F.array_max(F.transform("parts", lambda p: p.similar)))).otherwise(F.col("similar")))
    good = F.size("told") > 0
    listed = lambda labels: F.array_join(F.array_sort(labels), ",")
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(place, 1)).alias("n_base"), F.min(F.when(place, F.col("low"))).alias("first_word"),
        F.max(F.when(place, F.col("low"))).alias("last_word"), listed(F.collect_set(F.when(place, F.col("label")))).alias("base_labels"),
        listed(F.collect_set(F.when(good, F.col("label")))).alias("labels"),
        F.coalesce(F.max("similar"), F.lit(0.0)).alias("score"), F.array_sort(F.flatten(F.collect_list("told"))).alias("spans"),
    ).drop("row")


def sql(phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> str:
    """The scan as SQL over the table documents, on words instead of hashes and without spans."""
    listed = [(t, x, True) for t, x in phrases.items()] + [(t, x, False) for t, x in notices.items()]
    rows = ", ".join(f"({k}, '{t}', '{x}', {exact})" for k, (t, x, exact) in enumerate(listed))
    similar = f"""(CASE WHEN list_has_all(hit, needed) THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END) * least((2 * len(list_distinct(flatten(
        list_transform(hit, lambda t: range(t, t + {RUN}))))))::DOUBLE / (high - low + {RUN} + size), 1.0::DOUBLE)"""
    return f"""
    WITH template AS (SELECT k, string_split(replace(body, '*', ''), ' ') AS q, label, exact,
            list_filter(range(len(string_split(body, ' '))), lambda i: starts_with(string_split(body, ' ')[i + 1], '*')) AS needed
        FROM (VALUES {rows}) AS v(k, body, label, exact)),
    runs AS (SELECT k, label, exact, needed, len(q) AS size, t, q[t + 1 : t + {RUN}] AS run
        FROM (SELECT *, unnest(range(len(q) - {RUN - 1})) AS t FROM template)),
    words AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    rolled AS (SELECT row, pos, w[pos + 1 : pos + {RUN}] AS run FROM (SELECT row, w, unnest(range(len(w) - {RUN - 1})) AS pos FROM words WHERE len(w) >= {RUN})),
    diagonals AS (SELECT row, k, label, exact, needed, size, pos - t AS diagonal, count(*) AS votes, list(DISTINCT t) AS hit, min(pos) AS low, max(pos) AS high
        FROM rolled JOIN runs USING (run) GROUP BY ALL),
    split AS (SELECT *, votes = size - {RUN - 1} AS whole, exact OR votes = size - {RUN - 1} AS alone FROM diagonals),
    apart AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY row, k, alone ORDER BY diagonal) > {NEAR}, true) AS begins FROM split),
    islands AS (SELECT *, CASE WHEN alone THEN diagonal ELSE sum(begins::INT) OVER (PARTITION BY row, k, alone ORDER BY diagonal) END AS island, {similar} AS own FROM apart),
    merged AS (SELECT row, k, label, exact, size, any_value(needed) AS needed, flatten(list(hit)) AS hit, min(low) AS low, max(high) AS high,
            bool_or(whole) AS whole, max(own) AS best FROM islands GROUP BY row, k, label, exact, size, alone, island),
    found AS (SELECT row, label, low, exact AND whole AS place, CASE WHEN exact THEN whole::INT::DOUBLE ELSE greatest({similar}, best) END AS share FROM merged)
    SELECT d.doc_id, len(d.w) AS n_words, count(*) FILTER (place) AS n_base, min(low) FILTER (place) AS first_word, max(low) FILTER (place) AS last_word,
        coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (place)), ','), '') AS base_labels,
        coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (share >= {SIMILAR})), ','), '') AS labels, coalesce(max(share), 0) AS score
    FROM words d LEFT JOIN found USING (row) GROUP BY d.row, d.doc_id, d.w"""
