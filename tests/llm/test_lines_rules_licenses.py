import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import licenses, linededup, rules
from helpers import ODD, docs, rows_of

SPACE = "[\x20\x09-\x0d]"


def ascii_lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def plain_line_dedup(rows):
    lines = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda x: ascii_lower(re.sub(f"^{SPACE}+|{SPACE}+$", "", x))
    holders = {}
    for i, found in lines:
        for k in map(key, found):
            if i is not None and len(k) >= 10:
                holders.setdefault(k, set()).add(i)
    out = []
    for i, found in lines:
        kept = [x for x in found if i is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        out.append((i, len(found), len(found) - len(kept), "\n".join(kept)))
    return out


def found_lines(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, bytes(r.kept).decode()) for r in df.collect()), key=repr)


LINES = [
    *ODD, (20, "A LINE of some length here\r\nother\n\tA shared line, in here.  "), (19, "a shared line, in here.\nshort\nshort\n"),
    (21, "A shared line, in here."), (21, "Another text of the same id\nA shared line, in here."), (22, "ünïcödé zeilé\nÜnïcödé zeilé"), (23, "ünïcödé zeilé"),
    (None, "a shared line, in here."), (24, "exactly 10\nonly nine\n"), (25, "EXACTLY 10\nonly nine"),
]


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (4, 2), (9, 3)])
def test_line_dedup_equals_plain(spark, batches, fanout):
    assert found_lines(linededup.dedup_lines(docs(spark, LINES), batches, fanout)) == sorted(plain_line_dedup(LINES), key=repr)


def test_line_dedup_equals_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    theirs = sorted(con.sql(linededup.SQL).fetchall(), key=repr)
    found = linededup.dedup_lines(spark.read.parquet(f"{sf}/documents.parquet"))
    assert rows_of(found.withColumn("s", F.sha2("kept", 256)), "doc_id", "n_lines", "n_dropped", "s") == theirs


def test_runs_are_merged_into_levels(spark):
    runs = linededup.Runs(spark, fanout=2)
    batch = lambda low: spark.range(low, low + 10).select(F.col("id").alias("h"), F.col("id").alias("g"), F.col("id").alias("owner"))
    for k in range(5):  # each overlaps the one before by two
        stored = runs.add(batch(k * 8).withColumn("owner", F.col("owner") + 100 * k))
        assert stored.where("earlier is null").count() == (10 if k == 0 else 8)
        assert all(r.earlier == r.h + 100 * (k - 1) for r in stored.where("earlier is not null").collect())
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert runs.levels[2][0].count() == 34
    plan = runs.looked_up(runs.levels[2][0].select("h", "g", "owner"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan  # a run meets a run where both lie


def run_tables(spark):
    return {t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")}


def test_merged_runs_have_one_file_a_bucket_and_are_used_in_their_order(spark):
    batch = lambda low: spark.range(low, low + 400).select(F.xxhash64("id").alias("h"), F.col("id").alias("g"), F.col("id").alias("owner"))
    before = run_tables(spark)
    with linededup.Runs(spark, fanout=2) as runs:
        for k in range(4):
            runs.add(batch(k * 300))
        assert [len(x) for x in runs.levels] == [0, 0, 1]
        run = runs.levels[2][0]
        assert run.count() == 1300 and run.select("h", "g").distinct().count() == 1300
        files = run.select(F.input_file_name().alias("f")).distinct().count()
        assert files == runs.buckets
        runs.add(batch(5000))
        with linededup.ordered_scans(spark):
            plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
            looked = plan(runs.looked_up(batch(0).groupBy("h", "g").agg(F.min("owner").alias("owner")).repartition(runs.buckets, "h", "g")))
            # Only the batch is sorted, the two runs it meets are not.
            assert looked.count("SortMergeJoin") == 2 and looked.count("Sort [") == 1 and looked.count("Exchange") <= 2
            both = plan(runs.merged([runs.levels[2][0], runs.levels[0][0]]))
            assert "SortMergeJoin" in both and "Sort [" not in both and "Exchange" not in both
    assert run_tables(spark) == before


@pytest.mark.parametrize("fanout", [2, 3])
def test_later_calls_go_on_from_the_runs_of_earlier_ones(spark, tmp_path, fanout):
    rows = sorted((r for r in LINES if r[0] is not None), key=lambda r: r[0])
    cut = [[r for r in rows if r[0] <= 6], [r for r in rows if 6 < r[0] <= 20], [r for r in rows if r[0] > 20]]
    folder, found, before = str(tmp_path / "runs"), [], run_tables(spark)
    for part in cut:
        found += found_lines(linededup.dedup_lines(docs(spark, part), 2, fanout, folder))
    assert sorted(found, key=repr) == sorted(plain_line_dedup(rows), key=repr)
    assert run_tables(spark) == before
    again = found_lines(linededup.dedup_lines(docs(spark, [(99, "A shared line, in here.\nA line nobody else has")]), 2, fanout, folder))
    assert again == [(99, 2, 1, "A line nobody else has")]


def test_documents_keep_their_columns(spark):
    table = docs(spark, LINES)
    out = linededup.drop_repeated_lines(table)
    assert out.schema.names == table.schema.names and out.count() == len(LINES)
    left = {i: kept for i, _, dropped, kept in plain_line_dedup(LINES) if dropped}
    for r in out.collect():
        if r.doc_id in left and r.doc_id != 21:
            assert r.text == left[r.doc_id] and r.n_chars == len(r.text)
    assert linededup.drop_repeated_lines(table.limit(0)).collect() == []
    assert linededup.dedup_lines(table.limit(0)).collect() == []


def plain_rules(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n_dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), n_dup, len(repeated), failed


def test_rules_equal_plain_counts(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows_of(rules.clean(table), *names) == sorted(((r.doc_id, *plain_rules(r.text)) for r in table.collect()), key=repr)
    small = [r for r in ODD if len(r[1] or "") < 10_000]
    assert rows_of(rules.clean(docs(spark, small)), *names) == sorted(((i, *plain_rules(t)) for i, t in small), key=repr)
    assert rules.clean(docs(spark, [])).collect() == []


def test_rules_equal_sql(spark, sf, tmp_path):
    con = duckdb.connect()
    odd = docs(spark, [r for r in ODD if len(r[1] or "") < 60_000] + [(60, "Straße groß\nUne pensée é\nHome » About\nFin…»\n日本語。\n" + "word, " * 60), (61, "Eins zwei drei groß\n" * 30)])
    odd.select("doc_id", "text").write.parquet(str(tmp_path / "odd"))
    for path, df in ((f"{sf}/documents.parquet", spark.read.parquet(f"{sf}/documents.parquet")), (f"{tmp_path}/odd/*.parquet", odd)):
        con.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{path}'")
        theirs = con.sql(rules.SQL)
        assert rows_of(rules.clean(df, with_text=False), *theirs.columns) == sorted(theirs.fetchall(), key=repr)


def test_clean_documents_stay_and_junk_goes(spark):
    folder = "/root/testdata/sf0.01"
    found = rules.clean(spark.read.parquet(f"{folder}/documents.parquet")).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("not base_failed")
    share = {r.quality: r.kept for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.98 and share.get(0, 0) < 0.2


@pytest.mark.parametrize(("line", "rule"), [
    ("This sentence is fine.", None), ("\"Quoted speech?\"", None), ("Home | About | Contact | Login", "navigation"), ("Home About Contact", "navigation"),
    ("All rights reserved.", "boilerplate"), ("Copyright 2020 Example Inc.", "boilerplate"), ("Click here to read more!", "boilerplate"),
    ("no mark at its end", "punctuation"), ("Ein Satz ohne Ende, also groß", "punctuation"), ("Fin…»", None), ("日本語。", None), ("One, two, three four five six seven eight nine ten", None), ("Buy%%% now$$$ cheap*** stuff&&&.", "punctuation"),
])
def test_line_rules(line, rule):
    assert rules.failing(line.encode()) == rule


CLEAN = {
    "hindi": ["भारत एक विशाल देश है।", "यहाँ अनेक भाषाएँ बोली जाती हैं।", "क्या आप जानते हैं कि गंगा कहाँ से निकलती है?", "लोग खेतों में काम करते हैं।"],
    "arabic": ["اللغة العربية من أكثر اللغات انتشارا.", "هل تعرف تاريخ هذه المدينة؟", "يعمل الناس في الحقول كل يوم؛", "وصل القطار في المساء."],
    "urdu": ["یہ ایک خوبصورت شہر ہے۔", "لوگ صبح سویرے کام پر جاتے ہیں۔"],
    "thai": ["ประเทศไทยมีภาษาและวัฒนธรรมที่หลากหลาย", "ผู้คนทำงานในทุ่งนาทุกวัน", "เขาเดินทางไปเชียงใหม่เมื่อวานนี้"],
    "greek": ["Η Αθήνα είναι η πρωτεύουσα της Ελλάδας.", "Τι ώρα φεύγει το πλοίο;", "Ο καιρός ήταν καλός."],
    "armenian": ["Երևանը Հայաստանի մայրաքաղաքն է։"], "chinese": ["北京是中国的首都。", "你知道吗？"],
    "german": ["Der Weg führt nach oben zum Gipfel.", "Sie wollte das Buch weiterlesen.", "Was für ein Tag!"],
    "french": ["Il veut en savoir plus sur la ville.", "La rivière a débordé cette nuit.", "« Venez demain », dit-elle."],
    "spanish": ["¿Dónde está la estación?", "Es un método desarrollado por campesinos.", "Quiero leer más libros este año."],
}
JUNK = [
    ("Alle Rechte vorbehalten.", "boilerplate"), ("Wir verwenden Cookies, um Ihnen zu helfen.", "boilerplate"), ("Lesen Sie unsere Datenschutzerklärung.", "boilerplate"),
    ("TOUS DROITS RÉSERVÉS.", "boilerplate"), ("Nous utilisons des cookies.", "boilerplate"), ("Voir les conditions générales d’utilisation.", "boilerplate"),
    ("Todos los derechos reservados.", "boilerplate"), ("Utilizamos cookies propias y de terceros.", "boilerplate"), ("Términos y condiciones.", "boilerplate"),
    ("Startseite › Themen › Politik", "navigation"), ("Accueil · Actualités · Sport · Contact", "navigation"), ("Inicio • Noticias del día • Deportes", "navigation"), ("หน้าแรก | ข่าว | ติดต่อ", "navigation"),
    ("Startseite Kontakt Impressum.", "navigation"), ("Accueil Connexion Aide.", "navigation"), ("Inicio Contacto Ayuda.", "navigation"), ("ein Satz ohne Ende", "punctuation"),
]


@pytest.mark.parametrize("language", CLEAN)
def test_sentences_of_any_script_stay(language):
    assert [line for line in CLEAN[language] if rules.failing(line.encode())] == []
    text = "\n".join(f"{line} {i} {line}" for i in range(9) for line in CLEAN[language] for i in (i,))
    assert rules.judge(text.encode())["lines_removed"] == 0


@pytest.mark.parametrize(("line", "rule"), JUNK)
def test_menus_and_notices_of_the_corpus_languages_go(line, rule):
    assert rules.failing(line.encode()) == rule


def test_rules_of_scripts_and_long_texts_equal_sql(spark, tmp_path):
    lines = [x for group in CLEAN.values() for x in group] + [x for x, _ in JUNK]
    rows = [(i, "\n".join([line, "A sentence of its own stands here.", line + " "])) for i, line in enumerate(lines)]
    rows += [(900, "x" * 50_000), (901, "word " * 30_000), (902, "\n".join(lines * 300)), (903, "a b c. " * 20_000 + "\nHome | About | Us")]
    table = docs(spark, rows)
    table.select("doc_id", "text").write.parquet(str(tmp_path / "odd"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/odd/*.parquet'")
    theirs = con.sql(rules.SQL)
    got = rows_of(rules.clean(table, with_text=False), *theirs.columns)
    assert got == sorted(theirs.fetchall(), key=repr)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows_of(rules.clean(table), *names) == sorted(((i, *plain_rules(t)) for i, t in rows), key=repr)


def test_cleaned_text_has_lost_the_failing_lines():
    judged = rules.judge(b"Home | About | Contact\nA fine sentence stands here.\n\nAll rights reserved.")
    assert judged["cleaned"] == "A fine sentence stands here.\n" and judged["lines_removed"] == 2


def plain_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    found = [(k, label) for phrase, label in licenses.PHRASES.items() for q in [phrase.split()] for k in range(len(words) - len(q) + 1) if words[k : k + len(q)] == q]
    at = [k for k, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


NOTICES = [
    (30, "Released under the MIT License. And again: under the mit license, cc-by-nc, CC BY NC"), (31, "under the the mit license"),
    (32, "apache license version 2apache license, version 2.0"), (33, "This work is licensed under the terms of the GNU General Public License, version 3 of it"),
    (34, "licensed under the gnu general public license"), (35, "mit license " * 500), (36, "cc by nc " * 300), (37, "Permission is hereby granted, free of charge, to any person "
     "obtaining a copy of this nice software and associated documentation files (the \"Software\"), to deal in the Software without any restriction"),
]


def test_license_places_equal_plain(spark, sf):
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    table = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows_of(licenses.licenses(table), *names) == sorted(((r.doc_id, *plain_places(r.text)) for r in table.collect()), key=repr)
    rows = [*ODD, *NOTICES]
    assert rows_of(licenses.licenses(docs(spark, rows)), *names) == sorted(((i, *plain_places(t)) for i, t in rows), key=repr)
    assert licenses.licenses(docs(spark, [])).collect() == []


def test_license_notices_with_changed_words(spark):
    found = {r.doc_id: r for r in licenses.licenses(docs(spark, [*NOTICES, (38, "nothing of the kind here")])).collect()}
    assert found[33].labels == "gpl-3" and 0.8 <= found[33].score < 1
    assert found[37].labels == "mit" and found[37].base_labels == "" and 0.8 <= found[37].score < 1
    assert found[34].labels == "" and found[34].score < 0.8 and found[38].score == 0
    assert found[30].labels == "cc-by-nc,mit" and found[30].score == 1
    span = found[37].spans[0]
    assert span.first_word == 0 and span.last_word == found[37].n_words - 1 or span.last_word >= found[37].n_words - 3


def test_license_notices_in_a_row(spark):
    short = {"keep this notice unchanged": "keep"}
    rows = [
        (90, "All rights reserved.\nAll rights reserved."), (91, "All rights reserved. Yes, all rights reserved"), (92, "all rights reserved " * 50),
        (93, "all rights reserved"), (94, "all rights are reserved all rights"), (95, "keep this notice changed keep this notice changed"), (96, "x keep this notice unchanged " * 3),
    ]
    found = {r.doc_id: r for r in licenses.licenses(docs(spark, rows), notices={**licenses.NOTICES, **short}).collect()}
    places = {i: [(s.first_word, s.last_word) for s in r.spans] for i, r in found.items()}
    assert all(found[i].labels == "all-rights-reserved" and found[i].score == 1 for i in (90, 91, 92, 93))
    assert places[90] == [(0, 2), (3, 5)] and places[91] == [(0, 2), (4, 6)] and places[92] == [(k, k + 2) for k in range(0, 150, 3)]
    assert found[94].labels == "" and found[94].score < 0.8
    assert found[95].labels == "keep" and found[95].score == pytest.approx(6 / 7) and places[95] == [(0, 2), (4, 6)]
    assert found[96].labels == "keep" and found[96].score == 1 and places[96] == [(1, 4), (6, 9), (11, 14)]


def plain_licenses(text):
    """Labels and score by comparing words: runs on each diagonal, near diagonals together."""
    words, run = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or "")), licenses.RUN
    _, n, _, _, labels = plain_places(text)
    labels, score = set(labels.split(",")) - {""}, 1.0 if n else 0.0
    for body, label in licenses.NOTICES.items():
        q, needed = body.replace("*", "").split(), {i for i, w in enumerate(body.split()) if w.startswith("*")}

        def similar(hits):
            matched = {t + i for _, t in hits for i in range(run)}
            size = max(p for p, _ in hits) - min(p for p, _ in hits) + run + len(q)
            return min(1.0, 2 * len(matched) / size) * (1 if needed <= {t for _, t in hits} else 0.5)

        at = {}
        for p in range(len(words) - run + 1):
            for t in range(len(q) - run + 1):
                if words[p : p + run] == q[t : t + run]:
                    at.setdefault(p - t, []).append((p, t))
        spans = list(at.values())
        changed = sorted(d for d, hits in at.items() if len(hits) < len(q) - run + 1)
        for i, d in enumerate(changed):
            if i and d - changed[i - 1] <= licenses.NEAR:
                spans[-1] = spans[-1] + at[d]
            else:
                spans.append(at[d])
        best = max(map(similar, spans), default=0.0)
        score = max(score, best)
        labels |= {label} if best >= licenses.SIMILAR else set()
    return ",".join(sorted(labels)), pytest.approx(score, abs=1e-12)


def changed_notices():
    """Each notice as it stands, with words replaced, left out and put in, and two side by side."""
    draw, rows = random.Random(7), []
    bodies = [b.replace("*", "").split() for b in licenses.NOTICES]
    for k, q in enumerate(bodies):
        for share in (0, 0.04, 0.12):
            words = []
            for w in q:
                words += draw.choice([["other"], [], [w, "more"]]) if draw.random() < share else [w]
            rows.append((200 + len(rows), " ".join(["before", *words, "after"])))
        rows.append((200 + len(rows), " ".join(q + bodies[(k + 1) % len(bodies)])))
    return rows


FAMILIES = [
    (400, "# SPDX-License-Identifier: MIT", "mit"), (401, "// SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2"), (402, "SPDX-License-Identifier: LGPL-2.1-only", "lgpl-2.1"),
    (403, 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
     "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.", "mit"),
    (404, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
     "Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "agpl-3"),
    (405, "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
     "Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "lgpl-2.1"),
    (406, "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
     "Software Foundation; either version 2 of the License, or (at your option) any later version.", "gpl-2"),
    (407, "Licensed under the GNU Lesser General Public License version 3", "lgpl-3"), (408, "SPDX-License-Identifier: LicenseRef-own", ""),
    (409, "SPDX-License-Identifier: CC-BY-NC-4.0", "cc-by-nc"), (410, "Licensed under the Creative Commons Attribution 4.0 International License", "cc-by"),
]


def test_license_families_are_told_apart(spark):
    found = {r.doc_id: r for r in licenses.licenses(docs(spark, [(i, t) for i, t, _ in FAMILIES])).collect()}
    assert {i: r.labels for i, r in found.items()} == {i: label for i, _, label in FAMILIES}


def test_license_labels_equal_plain_words_and_sql(spark, tmp_path):
    rows = [*[r for r in ODD if len(r[1] or "") < 20_000], *NOTICES, *changed_notices(), *[(i, t) for i, t, _ in FAMILIES]]
    table = docs(spark, [*rows, *rows[:7]])
    got = {r.doc_id: (r.labels, r.score) for r in licenses.licenses(table).collect()}
    assert got == {i: plain_licenses(t) for i, t in rows}
    table.select("doc_id", "text").write.parquet(str(tmp_path / "docs"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/docs/*.parquet'")
    theirs = con.sql(licenses.sql())
    assert rows_of(licenses.licenses(table).drop("spans"), *theirs.columns) == sorted(theirs.fetchall(), key=repr)
