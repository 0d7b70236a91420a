import json
import random
from collections import Counter

import duckdb
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from fieldbook.llm import decontam, simhash, toxicity
from helpers import ODD, docs, items, rows_of
from test_lines_rules_licenses import plain_line_dedup
from test_simhash import plain_fingerprint, plain_groups
from test_tokens_and_packing import check_packing, expected_pieces


def shingles(text):
    words = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def plain_hits(rows, known):
    """Every window of an item's length against the item."""
    best = {}
    for i, text in rows:
        own = shingles(text)
        for j, other in known:
            item = shingles(other)
            if not item or not set(item) & set(own):
                continue
            want = Counter(item)
            for s in range(max(1, len(own) - len(item) + 1)):
                window = Counter(own[s : s + len(item)])
                common = sum((want & window).values())
                similar = common / (sum(window.values()) + len(item) - common)
                best[i, j] = max(best.get((i, j), 0), similar)
    return {k: v for k, v in best.items() if v >= 0.8}


def found_hits(df):
    return {(r.doc_id, r.item_id): r.similarity for r in df.collect()}


def test_hits_equal_plain(spark, sf):
    d, b = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    expected = plain_hits([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in b.collect()])
    assert found_hits(decontam.hits(d, b)) == pytest.approx(expected) and expected


WORDS = [f"w{i}" for i in range(60)]
ITEMS = [(1, " ".join(WORDS)), (2, "a b c d"), (3, None), (4, "one two three four five"), (5, " ".join(WORDS)), (6, "la " * 40), (None, "x y z u v w"), (7, "")]
TEXTS = [
    (40, "before " * 9 + " ".join(WORDS) + " after" * 9), (41, " ".join(["W0,", *WORDS[1:30], "changed", *WORDS[31:]])), (42, " ".join([*WORDS[:20], "new", *WORDS[20:]])),
    (43, " ".join([*WORDS[:20], *WORDS[22:]])), (44, " ".join([*WORDS[:10], "q", *WORDS[11:30], "q", *WORDS[31:50], "q", *WORDS[51:]])), (45, " ".join(WORDS[5:])),
    (46, " ".join(WORDS[:30])), (47, "one two three four five"), (48, "la " * 35), (49, "la " * 90), (50, " ".join(WORDS) + " . " + " ".join(WORDS)), (51, "x y z u v w"),
]


def test_hits_of_changed_copies_and_odd_rows(spark):
    rows = [*ODD, *TEXTS]
    known = [(i, t) for i, t in ITEMS]
    expected = plain_hits(rows, known)
    assert {40, 41, 42, 43, 45, 47, 50} <= {i for i, _ in expected} and 44 not in {i for i, _ in expected}
    assert found_hits(decontam.hits(docs(spark, rows), items(spark, ITEMS))) == pytest.approx(expected)
    first = {(r.doc_id, r.item_id): (r.first_word, r.n_words) for r in decontam.hits(docs(spark, rows), items(spark, ITEMS)).collect()}
    assert first[40, 1] == (9, 60) and first[50, 1] == (0, 60)
    assert decontam.hits(docs(spark, []), items(spark, ITEMS)).collect() == [] == decontam.hits(docs(spark, rows), items(spark, [])).collect()


def first_best(text, item):
    """The first of the best windows, and its similarity."""
    own, item = shingles(text), shingles(item)
    want, found = Counter(item), []
    for s in range(max(1, len(own) - len(item) + 1)):
        common = sum((want & Counter(own[s : s + len(item)])).values())
        found.append((common / (len(own[s : s + len(item)]) + len(item) - common), -s))
    return max(found)


def test_hits_of_moved_text(spark):
    around = [f"o{i}" for i in range(80)]
    orders = [[(30, 60), (0, 30)], [(40, 60), (0, 40)], [(20, 60), (0, 20)], [(0, 30), (45, 60), (30, 45)], [(50, 60), (10, 50), (0, 10)], [(1, 60)], [(0, 58)]]
    rows = [(i, " ".join([*around[:40], *[w for a, b in order for w in WORDS[a:b]], *around[40:]])) for i, order in enumerate(orders, 70)]
    rows += [(80, " ".join([*WORDS[30:], *WORDS[:30]])), (81, "la " * 20 + "x " + "la " * 30), (82, "p q r " * 90)]
    known = [(1, " ".join(WORDS)), (6, "la " * 40), (8, "p q r " * 13 + "p")]
    expected = {(i, j): first_best(text, item) for i, text in rows for j, item in known}
    expected = {k: v for k, v in expected.items() if v[0] >= 0.8}
    assert {(70, 1), (71, 1), (72, 1), (80, 1), (82, 8)} <= set(expected)
    found = {(r.doc_id, r.item_id): (r.similarity, -r.first_word) for r in decontam.hits(docs(spark, rows), items(spark, known)).collect()}
    assert found == {k: pytest.approx(v) for k, v in expected.items()}


def test_a_large_benchmark_is_joined_by_shuffle(spark, monkeypatch):
    expected = found_hits(decontam.hits(docs(spark, TEXTS), items(spark, ITEMS)))
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert found_hits(decontam.hits(docs(spark, TEXTS), items(spark, ITEMS))) == expected


def test_no_python_and_no_cross_products(spark, sf):
    d, b = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    plan = decontam.hits(d, b)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_fingerprint_places(spark):
    rows = spark.createDataFrame([(1, 5, 1), (1, 4, 1), (1, -1, 1), (2, 7, 3), (2, 0, 2), (3, -(2**63), 1)], "k int, h long, weight long")
    got = {r.k: r.fingerprint for r in decontam.simhashed(rows, ["k"]).collect()}
    assert {k: f[0] for k, f in got.items()} == {1: 5, 2: 7, 3: -(2**63)}
    assert all(len(f) == decontam.NUMBERS and len(set(f)) == len(f) for f in got.values())


def plain_bits(weights, number):
    """One number of the fingerprint of hashes with weights."""
    hashed = [((h if number == 0 else xxhash.xxh64_intdigest(int(number).to_bytes(4, "little"), seed=xxhash.xxh64_intdigest(h.to_bytes(8, "little", signed=True), seed=42))) % 2**64, w) for h, w in weights.items()]
    total = sum(w for _, w in hashed)
    return sum(1 << i for i in range(64) if 2 * sum(w for h, w in hashed if h >> i & 1) > total)


def test_fingerprints_equal_plain_ones(spark):
    draw = random.Random(5)
    sets = {k: {draw.randrange(-(2**63), 2**63): draw.choice([1, 1, 2, 5]) for _ in range(draw.choice([1, 2, 9, 40]))} for k in range(30)}
    rows = spark.createDataFrame([(k, h, w) for k, s in sets.items() for h, w in s.items()], "k int, h long, weight long")
    got = {r.k: [f % 2**64 for f in r.fingerprint] for r in decontam.simhashed(rows, ["k"]).collect()}
    assert got == {k: [plain_bits(s, j) for j in range(decontam.NUMBERS)] for k, s in sets.items()}


def test_no_similar_pair_is_beyond_the_radius(spark):
    """3000 pairs of windows just at the least similarity, from 9 to 96 shingles: all are within it."""
    draw, rows, wanted = random.Random(9), [], 0
    for k in range(3000):
        size = draw.randrange(9, 97)
        new = next(x for x in range(size, -1, -1) if (size - x) / (size + x) >= 0.8)
        shared = [draw.randrange(-(2**63), 2**63) for _ in range(size - new)]
        assert 0.8 <= (size - new) / (size + new) and (size - new - 1) / (size + new + 1) < 0.8
        for side in (0, 1):
            rows += [(k, side, h, 1) for h in [*shared, *[draw.randrange(-(2**63), 2**63) for _ in range(new)]]]
    marks = decontam.simhashed(spark.createDataFrame(rows, "k int, side int, h long, weight long").repartition(8), ["k", "side"])
    one = marks.where("side = 0").select("k", F.col("fingerprint").alias("a"), decontam.blocks(F.col("fingerprint")).alias("b"))
    other = marks.where("side = 1").select("k", F.col("fingerprint").alias("c"), decontam.blocks(F.col("fingerprint")).alias("b"))
    met = one.join(other, ["k", "b"]).select("k", decontam.apart(F.col("a"), F.col("c")).alias("bits")).distinct()
    bits = [r.bits for r in met.collect()]
    assert len(bits) == 3000 and max(bits) <= decontam.RADIUS


def test_the_index_meets_few_pairs_of_one_length(spark):
    draw = random.Random(11)
    texts = [" ".join(draw.choices([f"v{i}" for i in range(500)], k=60)) for _ in range(2000)]
    known = items(spark, list(enumerate(texts)))
    copies = [(i, "some words before it " + " ".join([*texts[i].split()[:30], "other", *texts[i].split()[31:]]) + " and after") for i in range(0, 2000, 20)]
    calls, join = [], decontam._candidates

    def counted(laid, window_marks, item_marks):
        window = [*decontam.ROW, "size", "start"]
        left = laid.join(window_marks, window).select(*window, "item", decontam.blocks(F.col("fingerprint")).alias("b"))
        right = item_marks.select("item", decontam.blocks(F.col("fingerprint")).alias("b"))
        calls.append((left.join(right, ["item", "b"]).count(), laid.select(*window).distinct().count() * 2000))
        return join(laid, window_marks, item_marks)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(decontam, "_candidates", counted)
        got = found_hits(decontam.hits(docs(spark, copies), known))
    assert {i for i, j in got if i == j} == {i for i, _ in copies}
    met, pairs = calls[0]
    assert 0 < met < pairs / 10


def test_hits_equal_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    d, b = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "benchmark"))
    got = sorted(tuple(r) for r in decontam.hits(d, b).collect())
    assert got == sorted(con.sql(decontam.SQL).fetchall()) and got


def test_repeated_rows_and_rows_without_id(spark):
    text = "before " * 4 + " ".join(WORDS) + " after"
    rows = [(1, text), (1, text), (None, text), (None, None), (2, None), (3, text + " x"), (3, "short")]
    got = [(r.doc_id, r.item_id, r.similarity, r.first_word) for r in decontam.hits(docs(spark, rows), items(spark, ITEMS)).collect()]
    assert sorted(got, key=repr) == sorted([(i, j, 1.0, 4) for i in (1, 3, None) for j in (1, 5)], key=repr)
    kept = decontam.drop_contaminated(docs(spark, rows), items(spark, ITEMS)).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == [2, None, None]


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Each stage's input and output over the smallest tables."""
    found, d = {}, spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, sf).persist()
        found[name] = ([r.asDict() for r in d.collect()], [r.asDict() for r in out.collect()])
        if name != "best-fit packing":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        d = out
    return found


def test_stages_equal_plain_versions(spark, sf, stages):
    before, after = stages["toxicity"]
    known = spark.read.parquet(f"{sf}/labels.parquet")
    d = spark.read.parquet(f"{sf}/documents.parquet")
    bad = {r.doc_id for r in toxicity.toxicity(d, known).where("predicted = 1").collect()}
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if r["doc_id"] not in bad)

    before, after = stages["line dedup"]
    expected = {i: kept for i, _, _, kept in plain_line_dedup([(r["doc_id"], r["text"]) for r in before])}
    assert {r["doc_id"]: r["text"] for r in after} == expected and all(r["n_chars"] == len(r["text"]) for r in after)

    before, after = stages["simhash near-dedup"]
    before.sort(key=lambda r: r["doc_id"])
    groups = plain_groups([plain_fingerprint(r["text"]) for r in before], 4)
    assert sorted(r["doc_id"] for r in after) == sorted(before[g]["doc_id"] for g in set(groups))

    before, after = stages["benchmark decontamination"]
    b = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hit = {i for i, _ in plain_hits([(r["doc_id"], r["text"]) for r in before], b)}
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if r["doc_id"] not in hit)

    before, after = stages["best-fit packing"]
    rows = [type("R", (), r) for r in after]
    check_packing(rows, expected_pieces([(r["doc_id"], r["text"]) for r in before], 2048), 2048)


def test_run_is_the_stages_in_turn(spark, sf, stages):
    names = ["doc_id", "piece", "ids_crc32"]
    assert rows_of(corpus_pipeline.run(spark, sf), *names) == sorted((tuple(r[c] for c in names) for r in stages["best-fit packing"][1]), key=repr)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_tables(spark, sf, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for rows in (ODD, []):
        d = docs(spark, rows)
        out = stage(spark, d, sf)
        n = out.count()
        if name != "best-fit packing":
            assert out.columns == d.columns and n <= len(rows)
        else:
            assert n >= len(rows)


def test_simhash_drop_names_survive(spark):
    d = docs(spark, ODD).withColumn("gone", F.lit(1)).withColumn("found", F.lit(json.dumps({})))
    assert simhash.drop_near_copies(d).columns == d.columns
    assert decontam.drop_contaminated(d, items(spark, ITEMS)).columns == d.columns
