import re

import __spark_entry__ as entry
from motolake.llm import queries

CONTRACT = {
    "op1_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op2_toxicity": "doc_id held_out score predicted",
    "op3_media": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
    "op4_language": "doc_id held_out lang_pred score",
    "op5_html": "page_id url text n_chars",
    "op7_mixing": "doc_id size source_size target taken",
    "op8_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op9_jaccard": "doc_id n_shingles component_id",
    "op10_ann": "query_id rank vec_id score",
}


def test_ten_operators_and_the_pipeline_are_registered():
    found = entry.queries()
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in found if re.match(r"op\d+_", n))
    assert numbers == list(range(1, 11)) and "pipeline" in found
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_results_have_the_contracts_columns(spark, sf_dir):
    for name, columns in CONTRACT.items():
        out = queries.QUERIES[name](spark, sf_dir)
        assert set(columns.split()) <= set(out.columns), name
        assert out.count() > 0, name
