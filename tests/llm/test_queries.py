"""The registered queries: names, and the columns that their contracts ask for."""

import pytest

import __spark_entry__ as E

COLUMNS = {
    "op1_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op2_token_output": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op3_decontaminate": ["doc_id", "item_id"],
    "op4_simhash": ["doc_id", "fingerprint", "component_id"],
    "op5_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op6_mixing": ["doc_id", "probability", "sampled"],
    "op7_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op8_token_count": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op9_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op10_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op11_spelling": ["word", "form", "root", "n", "n_near", "form_n"],
    "op12_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op13_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "pipeline": ["doc_id", "start", "n_tokens", "ids_crc32"],
}
STRINGS = {"base_labels", "labels", "fingerprint", "base_sha256", "spans", "turns_sha256", "loss_sha256", "kept_sha256", "word", "form", "root"}
BOOLEANS = {"over_limit", "base_failed", "kept", "sampled"}
DOUBLES = {"score", "probability", "whitened", "explained", "identity_error"}
INTS = {"component"}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf, name):
    df = E.queries()[name](spark, sf)
    assert df.columns[:len(COLUMNS[name])] == COLUMNS[name] or name == "op6_mixing" and set(COLUMNS[name]) <= set(df.columns)
    kinds = dict(df.dtypes)
    for c in COLUMNS[name]:
        want = "string" if c in STRINGS else "boolean" if c in BOOLEANS else "double" if c in DOUBLES else "int" if c in INTS else "bigint"
        assert kinds[c] == want, c


def test_a_row_for_each_document(spark, sf):
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in COLUMNS:
        if name not in ("op3_decontaminate", "op7_chat_format", "op11_spelling", "op13_whitening", "pipeline"):
            assert E.queries()[name](spark, sf).count() == n, name
