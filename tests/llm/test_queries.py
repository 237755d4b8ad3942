"""Registered queries against SQL, and their contracts' columns."""

import duckdb
import pytest

from tideline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op3_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op4_token_files": "doc_id start n_tokens ids_crc32",
    "op5_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op6_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op8_quality_classifier": "doc_id held_out score predicted",
    "op11_fill_in_middle": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12_html_extraction": "page_id url text n_chars",
    "op13_conversation_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
}
READS = {
    "op3_warc": "pages",
    "op12_html_extraction": "pages",
    "op13_conversation_trie": "conversations",
}


def test_all_numbers():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[name].split()
    table = READS.get(name, "documents")
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    # Nodes of a trie can be fewer than turns; the other queries keep every row.
    assert df.count() >= (0 if name == "op13_conversation_trie" else n)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = sorted(con.execute(ORACLES[name]).fetchall(), key=repr)
    rows = QUERIES[name](spark, SF)
    assert sorted(map(tuple, rows.collect()), key=repr) == expected
