"""The registered queries on the smallest test set: columns, one row per input row, SQL where there is some."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not present")
COLUMNS = {
    "op1_toxicity": ("doc_id held_out score predicted", "documents"),
    "op2_learned_partitions": ("query_id rank vec_id score", None),
    "op3_token_records": ("doc_id start n_tokens ids_crc32", "documents"),
    "op4_url_filter": ("page_id host path rule verdict", "pages"),
    "op5_decontamination": ("doc_id item_id distance start n_windows", None),
    "op6_minhash_near_dedup": ("doc_id n_shingles component_id kept", "documents"),
    "op7_html_extraction": ("page_id url text n_chars", "pages"),
    "op8_language_id": ("doc_id lang text_lang posterior kept", "documents"),
    "op9_packing": ("doc_id start length ids_crc32 doc_tokens sequence_id offset", None),
    "op10_license_scan": ("doc_id digest license notices", "documents"),
    "op11_periodic_runs": ("doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256", "documents"),
    "op12_jaccard_join": ("doc_id n_shingles component_id", "documents"),
    "op13_collocations": ("lang rank phrase a l r n score", None),
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    columns, per_row_of = COLUMNS[name]
    got = contract.queries()[name](spark, str(DATA))
    assert got.columns == columns.split()
    rows = got.collect()
    assert rows
    if per_row_of:
        assert len(rows) == spark.read.parquet(f"{DATA}/{per_row_of}.parquet").count()
    text = contract.oracle_sql().get(name)
    if text:
        connection = duckdb.connect()
        for file in DATA.glob("*.parquet"):
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, connection.execute(text).fetchall()))


def test_all_are_registered():
    assert set(COLUMNS) | {"pipeline"} <= set(contract.queries())
