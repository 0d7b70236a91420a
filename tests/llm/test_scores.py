import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from fieldbook.llm import language, quality, toxicity, words
from helpers import ODD, docs, labels, rows_of


def held(i, parts, rest):
    return zlib.crc32(str(i).encode()) % parts == rest


def auc(scores, y):
    scores, y = np.asarray(scores), np.asarray(y)
    return (scores[y == 1][:, None] > scores[y == 0][None, :]).mean()


@pytest.fixture(scope="module")
def middle():
    return "/root/testdata/sf0.01"


def joined(spark, folder, found):
    return found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").toPandas()


def test_quality_on_held_out_rows(spark, middle):
    found = quality.quality(spark.read.parquet(f"{middle}/documents.parquet"), spark.read.parquet(f"{middle}/labels.parquet"))
    rows = found.collect()
    assert len(rows) == 1000 and all(r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    t = joined(spark, middle, found)
    assert auc(t["score"], t["quality"]) > 0.95 and (t["predicted"] == t["quality"]).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    middle = "/root/testdata/sf0.1"  # 3 000 labelled rows, one in twenty of them mislabelled
    found = toxicity.toxicity(spark.read.parquet(f"{middle}/documents.parquet"), spark.read.parquet(f"{middle}/labels.parquet"))
    rows = found.collect()
    assert len(rows) == 10_000 and all(r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    t = joined(spark, middle, found)
    assert auc(t["score"], t["toxic"]) > 0.85


def made_passages(rng, n):
    plain = ["".join(rng.choice(list("abdeilmnorstu"), rng.integers(3, 9))) for _ in range(400)]
    bad = ["wretched", "imbecile", "scoundrel", "vermin"]
    out, y = [], []
    for i in range(n):
        words = rng.choice(plain, 40).tolist()
        if i % 4 == 0:
            words[rng.integers(0, 40)] = bad[rng.integers(0, 4)]
        out.append(" ".join(words))
        y.append(int(i % 4 == 0))
    return out, np.array(y)


def test_toxicity_of_unseen_misspellings():
    rng = np.random.default_rng(0)
    texts, y = made_passages(rng, 1500)
    passages = [" ".join(t.split()[i : i + toxicity.PASSAGE]) for t in texts for i in (0, toxicity.PASSAGE)]
    scorer = toxicity.learn(pa.array(passages), np.repeat(np.arange(len(texts)), 2), y)
    clean, _ = made_passages(rng, 400)
    clean = [t for i, t in enumerate(clean) if i % 4]
    wrong = [t.replace(" ", f" {w} ", 1) for t in clean for w in ("imbecille", "scoundrell", "verminn", "wretchedd")][:400]
    assert (scorer.scores(pa.array(wrong)) >= 0.5).mean() > 0.8
    assert (scorer.scores(pa.array(clean)) >= 0.5).mean() < 0.1


def test_scores_equal_every_passage_by_hand():
    rng = np.random.default_rng(3)
    weights = rng.normal(0, 3, toxicity.BUCKETS)
    scorer = toxicity.Scorer(weights, -1.0)
    texts = [" ".join(rng.choice(["ab", "abc", "dé", "ghij", "k", "日本", "—"], n)) for n in (1, 5, 23, 24, 25, 60, 200)] + ["", None, "  \n ", "x"]

    def word_score(word):
        if not word:
            return 0.0
        found = [weights[b] for _, bucket in words.parts_of_words(pa.array([word], pa.large_string()), toxicity.SIZES, toxicity.BUCKETS) for b in bucket]
        return sum(found) / max(len(found), 1)

    want = []
    for text in texts:
        held = [w.strip(words.EDGES) for w in (text or "").lower().split()]
        means = [sum(word_score(w) for w in set(held[i : i + 24])) / 24 for i in range(max(len(held) - 24, 0) + 1)] if held else [0.0]
        want.append(1 / (1 + np.exp(-np.clip(max(means) - 1.0, -30, 30))))
    assert scorer.scores(pa.array(texts, pa.string())) == pytest.approx(want, abs=1e-8)
    twice = scorer.scores(pa.array(texts * 3, pa.string())).reshape(3, -1)
    assert (twice == twice[0]).all()  # wherever a text stands in a batch


def test_verdicts_do_not_depend_on_words_put_in_front():
    rng = np.random.default_rng(1)
    texts, y = made_passages(rng, 1500)
    scorer = toxicity.learn(pa.array(texts), np.arange(len(texts)), y)
    fresh, _ = made_passages(rng, 300)
    plain = [w for t in fresh[1].split() for w in [t]][:23]
    before = scorer.scores(pa.array(fresh)) >= 0.5
    changed = [(scorer.scores(pa.array([" ".join([*plain[:k], t]) for t in fresh])) >= 0.5) != before for k in range(1, 24)]
    assert np.mean(changed) < 0.01


def test_toxicity_is_learned_from_whole_rows(spark, monkeypatch):
    made = []

    class Kept(toxicity.Learner):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self)

    monkeypatch.setattr(toxicity, "Learner", Kept)
    known = [i for i in range(40) if not held(i, 5, 0)][:4]
    long = {i: " ".join(f"w{k}x{i}" for k in range(24 * n - 5)) for i, n in zip(known, (30, 200, 1, 40))}
    joined = "字" * 100 + "z" * 200  # 500 bytes without a space
    table = docs(spark, [*long.items(), (known[3], joined)])
    toxicity.train(table, labels(spark, [(i, 1, int(k % 2)) for k, i in enumerate(known)]))
    sizes = np.diff(made[0].bounds)
    n = [len(t.split()) for t in long.values()] + [1]
    # A passage at every twelfth word, the last one at the end; every word is in one.
    assert (sizes > 0).sum() == sum(-(-max(k - 24, 0) // 12) + 1 for k in n) and len(np.unique(made[0].code)) == sum(n)
    assert made[0].parts.max() == sum(502 - n + 1 for n in toxicity.SIZES)


def test_learning_bounds_take_whole_rows(spark, monkeypatch):
    known = [i for i in range(60) if not held(i, 5, 0)][:20]
    table = docs(spark, [(i, f"a{i} " * 50 + ("vermin " if k % 2 else "kind ") * 3) for k, i in enumerate(known)] * 2)
    marks = labels(spark, [(i, 1, k % 2) for k, i in enumerate(known)])
    taken = []
    plain = toxicity.encoded
    monkeypatch.setattr(toxicity, "encoded", lambda parts: taken.append([t for p in parts for t in p.to_pylist()]) or plain([pa.array(taken[-1], pa.string())]))
    toxicity.train(table, marks)
    assert len(taken[0]) == 20
    monkeypatch.setattr(toxicity, "TEXT_BYTES", 500)
    toxicity.train(table, marks)
    assert 2 <= len(taken[1]) <= 4 and taken[1] == taken[0][: len(taken[1])]


def test_scores_depend_on_nothing_but_the_text(spark, middle):
    table = spark.read.parquet(f"{middle}/documents.parquet")
    changed = table.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string"))
    known = spark.read.parquet(f"{middle}/labels.parquet")
    for op in (quality.quality, toxicity.toxicity):
        assert rows_of(op(table, known), "doc_id", "score") == rows_of(op(changed, known), "doc_id", "score")
    # Labels of held-out rows are never learned from.
    flipped = known.withColumns({c: F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    for op in (quality.quality, toxicity.toxicity):
        assert rows_of(op(table, known), "doc_id", "score") == rows_of(op(table, flipped), "doc_id", "score")


@pytest.mark.parametrize("op", [quality.quality, toxicity.toxicity])
def test_scores_of_odd_rows(spark, op):
    table = docs(spark, ODD)
    known = labels(spark, [(1, 1, 0), (3, 0, 1), (5, 0, 1), (5, 1, 0), (6, 1, None), (None, 1, 1), (7, 0, 1), (7, 0, 1)])
    rows = op(table, known).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert all((r.held_out is None) == (r.doc_id is None) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1
    assert {r.score < 1e-9 for r in op(table, known.limit(0)).collect()} == {True}  # nothing to learn from
    assert op(table.limit(0), known).collect() == []


def test_trees_equal_a_walk_by_hand():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.1)).astype(float)
    forest = quality.grow(x, y, trees=12, depth=3)
    for row, score in zip(x[:50], forest.scores(x[:50])):
        total = forest.base
        for feature, above, leaf in zip(forest.feature, forest.above, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > above[node] else 1)
            total += leaf[node - len(feature)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((forest.scores(x) > 0.5) == y).mean() > 0.95


def test_language_on_held_out_rows(spark, middle):
    table = spark.read.parquet(f"{middle}/documents.parquet")
    rows = language.languages(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, 4, 2) for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows if r.held_out]) > 0.98


def test_language_mixtures(spark, middle):
    table = spark.read.parquet(f"{middle}/documents.parquet")
    model = language.train(table)
    by = {k: [r.text for r in table.where(F.col("lang") == k).limit(6).collect()] for k in ("en", "de", "fr")}
    halves = [(a.split()[:120], b.split()[:50]) for a, b in zip(by["en"], by["de"])]
    both = [" ".join(a + b) for a, b in halves]
    for m in language.predict(docs(spark, list(enumerate(both))), model).collect():
        a, b = map(len, halves[m.doc_id])
        assert set(m.mixture) == {"en", "de"} and abs(m.mixture["de"] - b / (a + b)) < 0.2
        assert sum(m.mixture.values()) == pytest.approx(1, abs=1e-4) and m.score == pytest.approx(m.mixture["en"])
    three = [" ".join(" ".join(t.split()[:100]) for t in x) for x in zip(by["en"], by["de"], by["fr"])]
    assert {frozenset(m.mixture) for m in language.predict(docs(spark, list(enumerate(three))), model).collect()} == {frozenset(("en", "de", "fr"))}


def test_language_is_learned_from_its_fold_only(spark, middle):
    table = spark.read.parquet(f"{middle}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    other = table.withColumn("lang", F.when(fold == 2, F.lit("xx")).otherwise(F.col("lang")))
    assert rows_of(language.languages(table), "doc_id", "lang_pred", "score") == rows_of(language.languages(other), "doc_id", "lang_pred", "score")


def test_language_of_odd_rows(spark):
    table = docs(spark, [(i, t, None if k % 5 == 4 else "en") for k, (i, t) in enumerate(ODD)])
    rows = language.languages(table).collect()
    assert len(rows) == len(ODD)
    text = {i: t for i, t in ODD}
    for r in rows:
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text[r.doc_id] or "")) and 0 <= r.score <= 1
    assert {r.lang_pred for r in language.languages(table.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.languages(table.limit(0)).collect() == []


def test_shares_of_mixed_texts_equal_many_plain_rounds():
    rng = np.random.default_rng(12)
    k, sizes = 4, np.array([6, 40, 300, 9])
    p = rng.dirichlet(np.full(k, 0.3), sizes.sum()).astype(np.float32)
    p[46:346, 1] = p[46:346, 0] * 0.98  # two languages that are hard to tell apart: slow to settle
    p /= p.max(axis=1, keepdims=True)
    starts = np.cumsum(sizes) - sizes
    use = np.array([[1, 1, 1, 1], [1, 0, 1, 1], [1, 1, 1, 1], [0, 1, 1, 0]], bool)
    share, fit = language.Languages._fit(p, starts, sizes, np.arange(4), use)
    for i in range(4):
        rows, want = p[starts[i] : starts[i] + sizes[i]].astype(float), use[i] / use[i].sum()
        for _ in range(20_000):
            weighed = rows * want
            want = (weighed / weighed.sum(axis=1, keepdims=True)).mean(axis=0)
        best = np.log((rows * want).sum(axis=1)).sum()
        assert best - language.SLACK <= fit[i] <= best + 1e-2
        assert (share[i][~use[i]] == 0).all() and abs(share[i].sum() - 1) < 1e-4


def plain_statistics(text):
    share = lambda wanted: sum(b in wanted for b in text) / max(len(text), 1)
    words = re.findall(rb"[^ \t\n\r\x0b\x0c]+", bytes(b + 32 if 65 <= b <= 90 else b for b in text))
    n, tally = max(len(words), 1), Counter(words)
    sizes = [len(w) for w in words] or [0]
    mean = sum(sizes) / len(sizes)
    pairs = {(a, b) for a, b in zip(words, words[1:])}
    lines = [x for x in (re.sub(rb"^[ \t\r\x0b\x0c]+|[ \t\r\x0b\x0c]+$", b"", x) for x in re.split(rb"\n", text)) if x]
    m = max(len(lines), 1)
    symbol = [w for w in words if w[-1] < 128 and not chr(w[-1]).isalnum() and chr(w[-1]) not in ".,;:!?\"')"]
    chances = [c / len(text) for c in Counter(text).values()]
    return [
        np.log(1 + len(text)), np.log(1 + len(words)), share(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        share(b"0123456789"), share(b" \t\n\r\x0b\x0c"), share(b"!?."), share(b",;:"), share(b"#*$%&|<>{}[]=_\\/@^~"), share(b"|"), share(range(128, 256)), share(b"\n"),
        mean, (sum((k - mean) ** 2 for k in sizes) / len(sizes)) ** 0.5, len(tally) / n, max(tally.values(), default=0) / n,
        len(pairs) / (len(words) - 1) if len(words) > 1 else 1, len(words) / m, 1 - len(set(lines)) / m,
        sum(chr(x[-1]) not in ".!?\"')" for x in lines) / m, len(symbol) / n, -sum(c * np.log2(c) for c in chances),
    ]


def test_statistics_equal_plain_ones(spark, sf):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + [t or "" for _, t in ODD] + ["a|b | c~ d# #\n\n d#\r\n", "."]
    for t in texts:
        found = quality.statistics(t.encode())
        assert len(found) == len(quality.FEATURES) and found == pytest.approx(plain_statistics(t.encode()), abs=1e-9)


def plain_boosting(x, y, trees, depth, bins, rate):
    """Scores of the rows learned from: every split is tried by itself, rows are lists of numbers."""
    edges = [np.unique(np.quantile(x[:, f], [i / bins for i in range(1, bins)])) for f in range(x.shape[1])]
    score = [float(np.log(y.mean() / (1 - y.mean())))] * len(y)
    for _ in range(trees):
        p = [1 / (1 + np.exp(-s)) for s in score]
        grad, hess = [a - b for a, b in zip(p, y)], [a * (1 - a) for a in p]
        worth = lambda rows: sum(grad[i] for i in rows) ** 2 / (sum(hess[i] for i in rows) + 1)
        groups = [list(range(len(y)))]
        for _ in range(depth):
            halves = []
            for rows in groups:
                best, split = 1e-6, (rows, [])
                for f, found in enumerate(edges):
                    for e in found:
                        low, high = [i for i in rows if x[i, f] <= e], [i for i in rows if x[i, f] > e]
                        if min(sum(hess[i] for i in low), sum(hess[i] for i in high)) < 0.5:
                            continue
                        gain = worth(low) + worth(high) - worth(rows)
                        if gain > best + 1e-12:
                            best, split = gain, (low, high)
                halves += split
            groups = halves
        for rows in groups:
            step = rate * sum(grad[i] for i in rows) / (sum(hess[i] for i in rows) + 1)
            for i in rows:
                score[i] -= step
    return 1 / (1 + np.exp(-np.array(score)))


def test_trees_grow_as_plain_boosting():
    rng = np.random.default_rng(3)
    x = np.stack([rng.normal(size=90), rng.integers(0, 4, 90), rng.exponential(size=90), np.zeros(90)], axis=1)
    y = ((x[:, 0] + (x[:, 1] > 1) + rng.normal(size=90) * 0.5) > 0.6).astype(float)
    forest = quality.grow(x, y, trees=6, depth=3, bins=12)
    assert forest.scores(x) == pytest.approx(plain_boosting(x, y, 6, 3, 12, quality.RATE), abs=1e-9)


def test_quality_is_learned_from_each_id_once(spark, middle):
    table, known = spark.read.parquet(f"{middle}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{middle}/labels.parquet")
    first = known.where("quality is not null").first().doc_id
    hot = table.union(table.where(F.col("doc_id") == first).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("n"))
    a, b = quality.train(table, known), quality.train(hot, known)
    assert a.base == b.base and (a.feature == b.feature).all() and (a.above == b.above).all() and (a.leaf == b.leaf).all()


def plain_parts(word):
    raw = f"<{word}>".encode()
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        h = 0
        for x in (a, b, c):
            h = (h * 0x100000001B3 + x + 1) % 2**64
        h = (h + 3) * 0x9E3779B97F4A7C15 % 2**64
        yield ((h ^ h >> 29) * 0xBF58476D1CE4E5B9 % 2**64) >> 49


def plain_words(text):
    return [w for w in (regex.sub(r"[^\p{L}\p{M}]+", "", w) for w in text.lower().split()) if regex.search(r"\p{L}", w)]


def test_language_counts_and_choice_equal_plain_ones(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    rows, model = table.collect(), language.train(table)
    counts = {k: Counter() for k in model.names}
    for r in rows:
        if r.lang is not None and r.text is not None and r.doc_id is not None and not held(r.doc_id, 4, 2):
            for w in plain_words(r.text):
                counts[r.lang].update(plain_parts(w))
    assert sorted({r.lang for r in rows if r.lang}) == model.names
    for j, k in enumerate(model.names):
        total = sum(counts[k].values()) + 0.5 * 2**15
        assert model.logs[:, j] == pytest.approx([np.log((counts[k][b] + 0.5) / total) for b in range(2**15)], abs=1e-9)

    by = {k: [" ".join(r.text.split()[:90]) for r in rows if r.lang == k and r.text and len(r.text.split()) > 90][:6] for k in model.names}
    langs = sorted(by)
    mixed = [t for k in langs for t in by[k][:3]]
    mixed += [" ".join(a.split()[:n] + b.split()[:12]) for x, y in zip(langs, langs[1:]) for n in (20, 60) for a, b in zip(by[x], by[y])]
    mixed += [" ".join(y for x in parts for y in x.split()[:40]) for parts in zip(*by.values())]
    for m in language.predict(docs(spark, list(enumerate(mixed))), model).collect():
        words = plain_words(mixed[m.doc_id])
        likely = np.array([model.logs[list(plain_parts(w))].sum(axis=0) for w in words])
        p = np.exp(likely - likely.max(axis=1, keepdims=True))

        def fit(use):
            share = use / use.sum()
            for _ in range(3000):
                weighed = p * share
                share = (weighed / weighed.sum(axis=1, keepdims=True)).mean(axis=0)
            return share, np.log((p * share).sum(axis=1)).sum() + likely.max(axis=1).sum()

        every = fit(np.ones(len(langs)))[0]
        options = []
        for size in range(1, len(langs) + 1):
            if size == 1:
                use = np.eye(len(langs))[likely.sum(axis=0).argmax()]
            else:
                use = np.isin(np.arange(len(langs)), np.argsort(-every)[:size]).astype(float)
            share, value = fit(use)
            options.append((value - language.PENALTY * np.log(len(words) + 1) * (size - 1), share))
        share = max(options, key=lambda o: o[0])[1]
        want = {k: s for k, s in zip(model.names, share) if s > 1e-6}
        assert set(m.mixture) == set(want) and m.mixture == pytest.approx(want, abs=5e-3) and m.lang_pred == max(want, key=want.get)


def test_scoring_holds_little_beside_the_texts():
    import tracemalloc

    rng = np.random.default_rng(3)
    words = np.array([f"w{i:x}" for i in range(4000)])
    texts = pa.array([" ".join(rng.choice(words, 400)) for _ in range(3000)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    scorer = toxicity.Scorer(rng.normal(0, 1, toxicity.BUCKETS), 0.1)
    tracemalloc.start()
    parts = [scorer.scores(part.column("text")) for part in toxicity.slices(batch, limit=toxicity.BATCH_BYTES)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    assert np.array_equal(np.concatenate(parts), scorer.scores(texts))
