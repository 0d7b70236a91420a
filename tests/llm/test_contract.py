import pytest

import __spark_entry__ as contract

COLUMNS = {
    "op1_quality_classifier": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_language_mixture": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op3_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op4_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op5_benchmark_decontamination": "doc_id bigint, item_id bigint, similarity double",
    "op6_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op7_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op8_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_simhash_near_dedup": "doc_id bigint, fingerprint string, component_id bigint",
    "op11_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    "op12_main_text": "page_id bigint, url string, text string, n_chars bigint",
    "op13_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
}
#: Queries whose rows are not those of documents.
OTHER = ("op5_benchmark_decontamination", "op8_best_fit_packing", "op12_main_text", "op13_hard_negatives")


def test_every_operator_has_a_query():
    names = list(contract.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert "op4_line_dedup" in contract.oracle_sql()


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, sf, name):
    df = contract.queries()[name](spark, sf)
    assert set(COLUMNS[name].split(", ")) <= {f"{c} {t}" for c, t in df.dtypes}
    n = df.count()
    assert n == 200 or name in OTHER and n > 0
