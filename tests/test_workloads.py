"""The command line, and that every registered query has the shape its SQL promises."""

import gzip
import json
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from strata.queries import ORACLES, QUERIES, workloads
from strata.__main__ import _connection, parse, run

from .conftest import rows
from .test_gym import first_set

SMALL = "/root/testdata/sf0.001"


def invoices(folder):
    Path(folder).mkdir(parents=True)
    line = {"StoreID": "S", "CustomerCardNo": "c", "TotalAmount": 10.0, "InvoiceLineItems": [{"ItemCode": "a"}]}
    Path(folder, "1.json").write_text(json.dumps(line) + "\n" + json.dumps({**line, "TotalAmount": 5.0}))
    return folder


def test_words_from_the_command_line(spark, folder):
    Path(folder, "in").mkdir(parents=True)
    Path(folder, "in", "a.txt").write_text("a b.a ")
    got = run(spark, ["words", "--input", f"{folder}/in", "--root", f"{folder}/out"])
    assert rows(got) == [("a", 2), ("b", 1)]


@pytest.mark.parametrize("mode", ["complete", "replace", "additive"])
def test_rewards_from_the_command_line(spark, folder, mode):
    args = ["rewards", "--input", invoices(f"{folder}/in"), "--root", f"{folder}/out", "--mode", mode]
    for _ in range(2):
        assert rows(run(spark, args)) == [("c", 15.0, 3.0)]


def test_invoices_and_line_items_from_the_command_line(spark, folder):
    silver = run(spark, ["invoices", "--input", invoices(f"{folder}/in"), "--root", f"{folder}/out"])
    assert silver.count() == 2
    table = "items_" + folder[-8:]
    try:
        got = run(spark, ["line_items", "--input", f"{folder}/in", "--root", f"{folder}/out", "--table", table])
        assert rows(got) == rows(silver)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_trades_from_the_command_line(spark, folder):
    message = '{"CreatedTime": "2024-01-01 00:00:00", "Type": "BUY", "Amount": 2.5}'
    spark.createDataFrame([(message,)], "value string").write.parquet(f"{folder}/in")
    got = run(spark, ["trades", "--input", f"{folder}/in", "--root", f"{folder}/out"])
    assert rows(got.select("TotalBuy", "TotalSell")) == [(2.5, 0.0)]


def test_gym_from_the_command_line_and_views(spark, folder):
    first_set(f"{folder}/in")
    database = "gym_" + folder[-8:]
    got = run(spark, ["gym", "--input", f"{folder}/in", "--root", f"{folder}/out", "--database", database])
    assert got.count() == 1
    assert spark.newSession().sql(f"SELECT * FROM {database}.gym_summary").count() == 1
    names = {t.name for t in spark.catalog.listTables(database)}
    assert {"users", "workout_bpm_summary", "date_lookup", "kafka_multiplex_bz"} <= names
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_arguments():
    for bad in (["words", "--input", "x"], ["line_items", "--input", "x", "--root", "y"], ["other", "--input", "x"],
                ["trades", "--root", "y"], ["consume", "--root", "y"], ["produce", "--servers", "h:1", "--topic", "t", "--root", "y"]):
        with pytest.raises(SystemExit):
            parse(bad)


@pytest.mark.parametrize("workload", ["consume", "ingest_log", "produce"])
def test_log_workloads_reach_for_the_connector(spark, folder, workload):
    """The connector is not here; all that comes before it is."""
    Path(folder).mkdir(parents=True)
    Path(folder, "secret").write_text("word\n")
    args = [workload, "--input", invoices(f"{folder}/in"), "--root", f"{folder}/out", "--servers", "h:1", "--topic", "t",
            "--user", "u", "--password-file", f"{folder}/secret", "--protocol", "SASL_SSL", "--mechanism", "PLAIN"]
    options = _connection(parse(args)).options()
    assert options["kafka.bootstrap.servers"] == "h:1" and "username='u' password='word'" in options["kafka.sasl.jaas.config"]
    with pytest.raises(Exception, match="kafka"):
        run(spark, args)


def test_every_query_has_sql_that_runs():
    duck = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())
    for name, sql in ORACLES.items():
        assert duck.execute(sql).description, name


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["start", "end", "TotalBuy", "TotalSell"] and got.count() > 0


@pytest.mark.parametrize("name", ["word_count_batch", "invoice_line_items", "interval_pairs", "presence", "merge_if_newer"])
def test_queries_agree_with_their_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = entry.queries()[name](spark, SMALL)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.select(*names)) == sorted(result.fetchall(), key=repr)


@pytest.mark.parametrize("name", ["invoice_layers", "invoice_table_stream"])
def test_landed_invoices_are_compressed_and_bounded(spark, monkeypatch, name):
    """As plain text, landed files are most of what these queries write; a compressed file is read by one task."""
    monkeypatch.setattr(workloads, "FILE_INVOICES", 2000)
    got = QUERIES[name](spark, SMALL)
    root = next(p for p in Path(got.inputFiles()[0].removeprefix("file:")).parents if p.name.startswith(name))
    files = [f for f in Path(root, "landing").iterdir() if f.name.startswith("part-")]
    landed = [gzip.decompress(f.read_bytes()) for f in files]
    lines = [x.count(b"\n") for x in landed]
    assert sum(lines) == spark.read.parquet(f"{SMALL}/lineitem.parquet").count() and max(lines) <= 2000 < sum(lines)
    assert sum(f.stat().st_size for f in files) < sum(map(len, landed)) / 4
