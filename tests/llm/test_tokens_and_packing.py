import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from fieldbook.llm import encoding, packing, tokenfiles
from fieldbook.llm.encoding import TextEncoder
from helpers import ODD, docs, rows_of

BYTES, WORDS = path("byte_bpe_50k.json"), path("word_bpe_49k.json")
ENCODERS = {p: TextEncoder(p) for p in (BYTES, WORDS)}


def plain(tokenizer, text, end=0):
    return np.array([*Tokenizer.from_file(tokenizer).encode(text or "", add_special_tokens=False).ids, end], "<u4")


@pytest.mark.parametrize("tokenizer", [BYTES, WORDS])
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("ab Z.,'1\n\t é́İßσΣ中😀<|  "), max_size=40), min_size=1, max_size=5))
def test_encoding_by_words_equals_encoding_whole(tokenizer, texts):
    encoder = ENCODERS[tokenizer]
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [encoder.whole(t).tolist() for t in texts]


def test_token_files_round_trip(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    start, expected = 0, []
    for r in sorted(table.collect(), key=lambda r: r.doc_id):
        ids = plain(BYTES, r.text)
        expected.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = tokenfiles.token_round_trip(spark, table, BYTES)
    assert rows_of(found, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)


def test_token_files_of_odd_rows(spark, tmp_path):
    table = docs(spark, ODD)
    folder = f"file://{tmp_path}"
    manifest = tokenfiles.write_token_files(table, folder, BYTES)
    found = tokenfiles.read_token_files(manifest, folder, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((r[0] for r in ODD), key=lambda i: (i is not None, i))
    assert sorted(r.ids for r in found) == sorted(plain(BYTES, r[1]).tolist() for r in ODD)
    assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found]])[:-1].tolist()
    assert tokenfiles.token_round_trip(spark, table.limit(0), BYTES).collect() == []


def check_packing(found, pieces_of, capacity):
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in found)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found if r.doc_id is not None) == sorted(p for p in pieces_of if p[0] is not None)
    return len(by_sequence), -(-total // capacity)


def expected_pieces(rows, capacity):
    out = []
    for i, text in rows:
        ids = plain(WORDS, text)
        out += [(i, k, k * capacity, len(x := ids[k * capacity : (k + 1) * capacity]), zlib.crc32(x.tobytes())) for k in range(-(-len(ids) // capacity))]
    return out


def test_packing_holds_every_piece_once(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    found = packing.pack(table.repartition(5), WORDS).collect()
    used, least = check_packing(found, expected_pieces([(r.doc_id, r.text) for r in table.collect()], 2048), 2048)
    assert used <= least * 1.02 + 1


def test_packing_of_odd_rows_and_sequences(spark):
    packed = packing.pack(docs(spark, ODD), WORDS, capacity=64, keep_ids=True)
    check_packing(packed.collect(), expected_pieces(ODD, 64), 64)
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids
    assert packing.pack(docs(spark, []), WORDS).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_plan_uses_every_length_once_and_few_sequences(counts):
    patterns = packing.plan(counts, 40)
    used = {}
    for items, number in patterns:
        assert sum(k * c for k, c in items) <= 40 and number > 0
        assert sum(c for k, c in items if 3 * k > 40) <= 2
        for k, c in items:
            used[k] = used.get(k, 0) + c * number
    assert used == counts
    total = sum(k * n for k, n in counts.items())
    assert sum(n for _, n in patterns) <= 11 / 9 * max(-(-total // 40), sum(n for k, n in counts.items() if 2 * k > 40)) + 1 + sum(n for k, n in counts.items() if 40 < 3 * k <= 60)


def test_a_worker_loads_a_tokenizer_once(monkeypatch):
    made = []
    monkeypatch.setattr(encoding, "TextEncoder", lambda p: made.append(p) or object())
    monkeypatch.setattr("tokenizers._fieldbook_encoder", None, raising=False)
    first = encoding.encoder_of(BYTES)
    assert encoding.encoder_of(BYTES) is first and made == [BYTES]
    assert encoding.encoder_of(WORDS) is not first and made == [BYTES, WORDS]
