import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldbook.llm import periods

from helpers import ODD, docs


def plain_runs(words):
    """All runs by looking at every period and start."""
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                if not any(all(words[x] == words[x + d] for x in range(i, i + length - d)) for d in range(1, q)):
                    out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    return (
        doc_id, len(found), *best, None if not found else 1000 * best[1] // best[2],
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


texts = st.lists(st.one_of(
    st.lists(st.integers(0, 2), max_size=40),
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 8), st.integers(0, 8)).map(lambda x: x[0] * x[1] + x[0][: x[2]]),
), max_size=4)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_runs_equal_plain_ones(found):
    sizes = [len(w) for w in found]
    codes = np.array([c for w in found for c in w], np.int64)
    got = periods.runs(codes, np.repeat(np.arange(len(found)), sizes))
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    assert got.tolist() == [[s + starts[k], n, q] for k, w in enumerate(found) for s, n, q in plain_runs(w)]


def test_factors_beyond_the_next_power_and_shorter_repeats_within_a_period():
    for period in ("a b a b c", "a a b", "a b c d e f g", "x", "a b a c a b a d"):
        words = (period.split() * 5)[:-1]
        assert plain_runs(words) == [tuple(r) for r in periods.runs(np.unique(words, return_inverse=True)[1], np.zeros(len(words), int)).tolist()]


def test_planted_digests_equal_plain_ones(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = [r for r in rows if len(r[1] or "") < 8000]
    got = {tuple(r) for r in periods.run_digests(docs(spark, rows), planted=True).collect()}
    assert got == {plain_row(*r) for r in rows}
    assert sum(r[1] > 0 for r in got) > 5 and any(r[1] == 0 for r in got)


def test_odd_rows_empty_tables_and_texts(spark):
    rows = [*ODD, (20, "a b a b a b a b tail"), (21, "go " * 5), (22, "go " * 6), (23, "a b c " * 3), (24, " x  x " * 4)]
    found = {}
    for r in periods.periodic_runs(docs(spark, rows)).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, found.values())) == len(rows)
    assert [(r.start, r.length, r.period) for r in found[20][0].runs] == [(0, 8, 2)] and found[20][0].collapsed == "a b tail"
    assert found[21][0].runs == [] and [tuple(r) for r in found[22][0].runs] == [(0, 6, 1)] and found[22][0].collapsed == "go"
    assert found[23][0].runs == [] and [tuple(r) for r in found[24][0].runs] == [(0, 8, 1)]  # no-break spaces belong to words
    assert found[2][0].n_words == found[3][0].n_words == found[4][0].n_words == 0 and found[2][0].collapsed == ""
    assert len(found[1]) == 2 and found[1][0].runs == found[1][1].runs == [(0, 270, 9)]
    assert [tuple(r) for r in found[8][0].runs] == [(0, 30000, 1)] and len(found[None]) == 2
    digests = {tuple(r) for r in periods.run_digests(docs(spark, ODD), planted=True).collect() if r.doc_id not in (1, 8)}
    assert digests == {plain_row(*r[:2]) for r in ODD if r[0] not in (1, 8)}
    assert periods.periodic_runs(docs(spark, [])).count() == periods.run_digests(docs(spark, [])).count() == 0


@pytest.mark.parametrize("size", [1, 40, 10_000])
def test_rows_do_not_depend_on_how_texts_are_put_together(spark, monkeypatch, size):
    monkeypatch.setattr(periods, "CHUNK_BYTES", size)
    rows = [(i, "u v w " * (i % 7) + "z " * (i % 5 * 3)) for i in range(60)]
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periods.periodic_runs(docs(spark, rows)).collect()}
    assert got == {i: plain_runs(t.split()) for i, t in rows}


def test_strongest_run_is_exact_and_ties_fall_to_the_first():
    runs = np.array([[0, 9, 2], [20, 9, 2], [40, 13, 3], [60, 4_000_000_000_000_001, 1_000_000_000_000_000]])
    assert periods._strongest(runs) == (0, 9, 2)
    assert periods._strongest(runs[2:]) == (40, 13, 3)
