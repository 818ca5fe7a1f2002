"""Which queries SQL can check, and what checks the others."""

from pathlib import Path

import __spark_entry__ as entry
import corpus_pipeline
import duckdb

from strata.llm.queries import ORACLES, QUERIES

#: Each has a test against a brute-force version, the library it stands for, or accuracy on rows it did not learn from.
WITHOUT_SQL = {
    "op2_suffix_dedup": "test_suffix_dedup.py::test_whole_table",
    "op3_html_extraction": "test_html_text.py::test_extract_matches_generated_pages",
    "op5_language_id": "test_language_id.py::test_held_out_accuracy",
    "op6_packing": "test_packing.py::test_documents_round_trip",
    "op7_decontamination": "test_decontamination.py::test_tables",
    "op8_minhash": "test_minhash.py::test_whole_table_against_brute_force",
    "op13_byte_bpe": "test_byte_bpe.py::test_whole_table_against_the_library",
    "pipeline": "test_pipeline.py::test_all_stages_against_brute_force",
}


def test_every_query_has_sql_or_another_check():
    mine = {**QUERIES, "pipeline": corpus_pipeline.run}
    assert set(mine) - set(ORACLES) == set(WITHOUT_SQL) and set(mine) <= set(entry.queries())
    for name in WITHOUT_SQL.values():
        file, _, test = name.partition("::")
        assert f"def {test}(" in (Path(__file__).parent / file).read_text(), name


def test_sql_runs():
    duck = duckdb.connect()
    for path in Path("/root/testdata/sf0.001").glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    for name, sql in ORACLES.items():
        assert duck.execute(sql).description, name
