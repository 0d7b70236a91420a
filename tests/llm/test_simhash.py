import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from fieldbook.llm import components, simhash
from helpers import ODD, docs, rows_of


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x7f" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values, radius):
    root = list(range(len(values)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(values))]


def test_groups_equal_all_pairs(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").unionByName(docs(spark, [r for r in ODD if r[0]]).select("doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 10_000))
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in table.collect()]
    groups = plain_groups([f for _, f in rows], 4)
    least = {g: min(rows[i][0] for i in range(len(rows)) if groups[i] == g) for g in set(groups)}
    found = simhash.near_groups(table).collect()
    assert sorted((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in found) == sorted((i, f, least[g]) for (i, f), g in zip(rows, groups))


def test_fingerprint_hash_is_the_engine_hash(spark):
    row = spark.sql("select xxhash64('a b c d') as h").first()
    assert simhash.fingerprint(b"A b\tC  D") == row.h


def cloud(rng, centres, each, flips):
    out = []
    for c in rng.integers(0, 2**63, centres).tolist():
        for _ in range(each):
            v = c
            for b in rng.choice(64, rng.integers(0, flips + 1), replace=False).tolist():
                v ^= 1 << b
            out.append(v)
    return sorted(set(out))


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 6), st.integers(0, 7))
def test_trie_walk_finds_the_groups(seed, radius, flips):
    values = cloud(np.random.default_rng(seed), 6, 20, flips)
    x = np.array(values, np.uint64)
    found = simhash.trie_groups(x, 0, np.full(65, radius), radius, frontier=50)
    assert found.tolist() == plain_groups(values, radius)


def test_links_of_dense_and_divided_subtrees(spark):
    rng = np.random.default_rng(3)
    values = cloud(rng, 8, 60, 6)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    expected = plain_groups(values, 4)
    for subtree in (10, 10_000):
        stars = {r.a: r.b for r in components.smallest_reachable(simhash.near_links(frame, subtree=subtree)).collect()}
        group = [stars.get(v, v) for v in signed]
        assert len(set(zip(group, expected))) == len(set(group)) == len(set(expected))


@pytest.mark.parametrize("rows", [1, 7, 100, 10_000])
def test_a_task_never_holds_more_than_its_rows_and_one_subtree(rows):
    rng = np.random.default_rng(rows)
    sizes = [1, 2, 40, 3, 300, 1, 1, 5, 60, 2] * 3
    key = np.repeat(np.arange(len(sizes)), sizes)
    table = pd.DataFrame({"start": key // 10, "block": key % 10, "one": 0, "other": 0, "value": rng.integers(0, 2**60, len(key))})
    most, given_out = 0, []

    def frames():
        nonlocal most
        for i in range(0, len(table), 16):
            most = max(most, min(i + 16, len(table)) - sum(map(len, given_out)))
            yield table.iloc[i : i + 16]

    for part in simhash.whole_subtrees(frames(), rows):
        given_out.append(part)
    assert most <= rows + 300 + 16
    pd.testing.assert_frame_equal(pd.concat(given_out, ignore_index=True), table)
    seen = [set(map(tuple, part[["start", "block"]].to_numpy())) for part in given_out]
    assert sum(map(len, seen)) == len(sizes)  # no subtree is in two frames


def test_odd_rows(spark):
    found = simhash.near_groups(docs(spark, ODD))
    none = [r.component_id for r in found.collect() if r.fingerprint == 0]
    assert len(none) == 4 and set(none) == {2}  # null, empty, white space, null id and text
    assert len(found.collect()) == len(ODD)
    kept = simhash.drop_near_copies(docs(spark, ODD))
    assert kept.columns == docs(spark, ODD).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 2 and 3 not in ids and 4 not in ids and ids.count(None) == 2
    assert simhash.near_groups(docs(spark, [])).collect() == []


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (5, 4)]
    found = rows_of(components.smallest_reachable(spark.createDataFrame(links, "a long, b long")), "a", "b")
    assert found == sorted([(i, 1) for i in range(2, 41)] + [(k, 100) for k in range(101, 140)], key=repr)
