"""Staged tables: merge rules, replay, null keys, duplicate keys, change feeds."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.plans.invoices import CONTENT_KEY, message_table
from strata.sinks.catalog import (
    create_view, ensure_database, ensure_tables, merge_into_catalog, overwrite_rows, recreate_table, save_table,
    set_up_once,
)
from strata.sinks import staged
from strata.sinks.staged import SET_ALL, InsertTable, SnapshotTable, StateTable
from strata.sources.files import query_file
from strata.streaming.jobs import Job, append_to_path, await_all

from .conftest import rows

ROW = "k long, v string, n long"


def frame(spark, *data, schema=ROW):
    return spark.createDataFrame(list(data), schema)


# -- insert only ------------------------------------------------------------------------


def test_existing_keys_win(spark, folder):
    t = InsertTable(spark, folder, ROW, ["k"])
    assert rows(t.read()) == []
    assert t.insert_new(frame(spark, (1, "b", 1), (1, "a", 2), (2, "x", 3)), "w", 0, ["v"])
    assert t.insert_new(frame(spark, (2, "y", 9), (3, "z", 4)), "w", 1, ["v"])
    assert rows(t.read()) == [(1, "a", 2), (2, "x", 3), (3, "z", 4)]


def test_insert_replay_and_empty_batches_do_nothing(spark, folder):
    t = InsertTable(spark, folder, ROW, ["k"])
    assert t.insert_new(frame(spark, (1, "a", 1)), "w", 0, ["v"])
    assert not t.insert_new(frame(spark, (9, "other", 1)), "w", 0, ["v"])
    assert not t.insert_new(frame(spark), "w", 1, ["v"])
    assert t.insert_new(frame(spark, (2, "b", 1)), "another writer", 0, ["v"])
    assert rows(t.read()) == [(1, "a", 1), (2, "b", 1)]


def test_insert_null_keys_match_nothing(spark, folder):
    t = InsertTable(spark, folder, ROW, ["k"])
    for batch in range(2):
        t.insert_new(frame(spark, (None, "a", 1), (None, "a", 1)), "w", batch, ["v"])
    assert len(rows(t.read())) == 4


def test_insert_range_column_prunes_the_scan(spark, folder):
    schema = "k long, t timestamp"
    t = InsertTable(spark, folder, schema, ["k", "t"])
    day = [dt.datetime(2024, 1, d) for d in range(1, 29)]
    for batch in range(3):
        t.insert_new(frame(spark, *[(k, d) for k in range(3) for d in day[batch * 9:batch * 9 + 10]], schema=schema),
                     "w", batch, [], range_column="t")
    assert rows(t.read()) == rows(frame(spark, *[(k, d) for k in range(3) for d in day], schema=schema))


def test_insert_staging_left_behind_is_redone(spark, folder):
    t = InsertTable(spark, folder, ROW, ["k"])
    frame(spark, (7, "half", 1)).write.parquet(f"{folder}/_staging/writer=w/batch=0")
    t.insert_new(frame(spark, (1, "a", 1)), "w", 0, ["v"])
    assert rows(t.read()) == [(1, "a", 1)]


# -- updates ----------------------------------------------------------------------------


@pytest.fixture(params=["broadcast", "shuffle"])
def joined_by(request, spark):
    """Both ways the merge can join: a small batch broadcast, a large one shuffled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_update_all(spark, folder, joined_by):
    t = StateTable(spark, folder, ROW, ["k"])
    t.merge(frame(spark, (1, "a", 1), (2, "b", 1)), "w", 0, [(None, SET_ALL)])
    t.merge(frame(spark, (2, None, 2), (3, "c", 2)), "w", 1, [(None, SET_ALL)])
    assert rows(t.read()) == [(1, "a", 1), (2, None, 2), (3, "c", 2)]


def test_clauses_apply_in_order_and_leave_other_columns(spark, folder, joined_by):
    t = StateTable(spark, folder, ROW, ["k"])
    t.merge(frame(spark, (1, "a", 5), (2, "b", 5), (3, "c", 5)), "w", 0, [])
    t.merge(frame(spark, (1, "X", 9), (2, "Y", 5), (3, "Z", 1)), "w", 1,
            [("s.n > t.n", {"n": "s.n + t.n"}), ("s.n = t.n", SET_ALL)])
    assert rows(t.read()) == [(1, "a", 14), (2, "Y", 5), (3, "c", 5)]


def test_null_conditions_do_not_update(spark, folder, joined_by):
    t = StateTable(spark, folder, ROW, ["k"])
    t.merge(frame(spark, (1, "a", None)), "w", 0, [])
    t.merge(frame(spark, (1, "b", 1)), "w", 1, [("t.n < s.n", SET_ALL)])
    assert rows(t.read()) == [(1, "a", None)]


def test_additive_merge_counts_a_replayed_batch_once(spark, folder):
    t = StateTable(spark, folder, ROW, ["k"])
    add = [(None, {"n": "t.n + s.n"})]
    for _ in range(2):
        t.merge(frame(spark, (1, "a", 5)), "w", 0, add)
        t.merge(frame(spark, (1, "a", 7)), "w", 1, add)
    assert rows(t.read()) == [(1, "a", 12)]
    t.merge(frame(spark, (1, "a", 1)), "another writer", 0, add)
    assert rows(t.read()) == [(1, "a", 13)]


def test_duplicate_keys_fail_and_leave_the_table_as_it_was(spark, folder, joined_by):
    t = StateTable(spark, folder, ROW, ["k"])
    t.merge(frame(spark, (1, "a", 1)), "w", 0, [])
    with pytest.raises(PySparkException, match="more than once"):
        t.merge(frame(spark, (1, "b", 1), (1, "c", 1)), "w", 1, [(None, SET_ALL)])
    assert rows(t.read()) == [(1, "a", 1)]
    t.merge(frame(spark, (1, "b", 1)), "w", 1, [(None, SET_ALL)])
    assert rows(t.read()) == [(1, "b", 1)]


def test_update_null_keys_match_nothing(spark, folder, joined_by):
    t = StateTable(spark, folder, ROW, ["k"])
    for batch in range(2):
        t.merge(frame(spark, (None, "a", 1), (None, "a", 1), (1, str(batch), 1)), "w", batch, [(None, SET_ALL)])
    assert rows(t.read()) == [(1, "1", 1)] + [(None, "a", 1)] * 4


def test_a_merge_writes_its_own_keys_only(spark, folder):
    """A batch of n keys adds n rows at most, however large the table; rows that no clause changes add none."""
    t = StateTable(spark, folder, ROW, ["k"])
    t.merge(spark.range(20_000).selectExpr("id AS k", "'a' AS v", "id AS n"), "w", 0, [])
    before = sorted(p for p in Path(folder).rglob("*.parquet"))
    t.merge(frame(spark, *[(k, "b", 10_000) for k in range(9_995, 10_010)], (30_000, "c", 1)), "w", 1, [("s.n > t.n", SET_ALL)])
    written = spark.read.parquet(f"{folder}/data/writer=w/batch=1")
    assert written.count() == 6 and set(before) <= set(Path(folder).rglob("*.parquet"))
    assert rows(t.read().groupBy("v").count()) == [("a", 19_995), ("b", 5), ("c", 1)]


def test_a_range_column_cuts_the_scan_of_a_merge(spark, folder, joined_by):
    schema = "k long, t timestamp, n long"
    t = StateTable(spark, folder, schema, ["k", "t"])
    days = [dt.datetime(2024, 1, d, 12) for d in (1, 2, 3)]
    for batch, day in enumerate(days):
        t.merge(frame(spark, *[(k, day, 0) for k in range(20)], schema=schema), "w", batch, [], range_column="t")
    t.merge(frame(spark, *[(k, days[1], 1) for k in range(20)], schema=schema), "w", 3, [(None, SET_ALL)], range_column="t")
    assert rows(t.read().groupBy("t").agg(F.sum("n"), F.count("*"))) == [(days[0], 0, 20), (days[1], 20, 20), (days[2], 0, 20)]


def test_a_run_that_died_before_its_rename_is_redone(spark, folder):
    t = StateTable(spark, folder, ROW, ["k"])
    t.merge(frame(spark, (1, "a", 1)), "w", 0, [])
    frame(spark, (7, "half", 1)).write.parquet(f"{folder}/_staging/writer=w/batch=1")
    assert rows(t.read()) == [(1, "a", 1)]
    t.merge(frame(spark, (2, "b", 1)), "w", 1, [])
    assert rows(t.read()) == [(1, "a", 1), (2, "b", 1)]


def test_the_feed_holds_what_merges_changed(spark, folder, monkeypatch):
    t = StateTable(spark, f"{folder}/t", ROW, ["k"])
    job = Job("feed", f"{folder}/checkpoint")

    def drain():
        await_all([append_to_path(t.stream(), f"{folder}/feed", job)])
        return rows(spark.read.parquet(f"{folder}/feed"))

    t.merge(frame(spark, (1, "a", 1), (2, "b", 1), (3, "c", 1)), "w", 0, [])
    assert len(drain()) == 3
    t.merge(frame(spark, (2, "B", 2), (4, "d", 2), (3, "zzz", 0)), "w", 1, [("s.n > t.n", SET_ALL)])
    assert drain() == sorted([(1, "a", 1), (2, "b", 1), (3, "c", 1), (2, "B", 2), (4, "d", 2)], key=repr)
    with monkeypatch.context() as m:
        m.setattr(t.fs, "move", lambda source, target: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            t.merge(frame(spark, (9, "dirty", 1)), "w", 2, [])
    assert len(drain()) == 5
    t.merge(frame(spark, (1, "A", 3)), "other", 0, [("s.n > t.n", SET_ALL)])
    assert len(drain()) == 6


def test_two_handles_see_one_table(spark, folder):
    one, two = (StateTable(spark, f"{folder}/t", ROW, ["k"]) for _ in range(2))
    two.merge(frame(spark, *[(k, "a", 1) for k in range(20)]), "w", 0, [])
    one.merge(frame(spark, *[(k, "b", 1) for k in range(20)]), "v", 0, [(None, SET_ALL)])
    assert rows(one.read()) == rows(two.read()) == rows(frame(spark, *[(k, "b", 1) for k in range(20)]))


# -- what a lookup reads ----------------------------------------------------------------


def scanned(df):
    """Rows that the file scans of a query gave to what comes after them."""
    spark, total = df.sparkSession, 0
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        again.collect()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
        for i in range(leaves.size()):
            if "Scan" in leaves.apply(i).nodeName():
                total += leaves.apply(i).metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    return total


@pytest.mark.parametrize("kind", [InsertTable, StateTable])
def test_files_without_the_keys_of_a_batch_are_skipped(spark, folder, kind):
    """Keys are strings without an order in time, so that only their Bloom filters can tell where they are."""
    t = kind(spark, folder, "k string, n long", ["k"])
    load = spark.range(8000).selectExpr("sha2(cast(id AS string), 256) AS k", "id AS n").withColumn("part", F.expr("n % 8")).coalesce(1)
    for batch in range(8):
        part = load.where(F.col("part") == batch).drop("part")
        t.insert_new(part, "w", batch) if kind is InsertTable else t.merge(part, "w", batch, [])
    asked = spark.createDataFrame([(r.k, 0) for r in load.where("n in (3, 11)").collect()], "k string, n long")
    found = t._asked(t._stored(), asked, None, None, None)
    assert found.count() == 2
    assert scanned(t._stored()) == 8000 and scanned(found) <= 2 * 1000 + 2
    many = t._asked(t._stored(), load.where("n % 8 = 5").limit(900), None, None, None)
    assert many.count() == 900 and scanned(many) <= 2000 + 900
    if kind is InsertTable:
        t.insert_new(asked.union(spark.createDataFrame([("new", 1)], "k string, n long")), "w", 8)
        assert t.read().count() == 8001
    else:
        t.merge(asked, "w", 8, [(None, SET_ALL)])
        assert t.read().count() == 8000 and t.read().where("n = 0").count() == 3


def test_messages_are_looked_up_in_their_own_partitions(spark, folder):
    t = message_table(spark, folder)
    log = spark.range(40).selectExpr("string(id) AS key", "'v' AS value", "concat('t', id % 4) AS topic", "id % 2 AS partition", "id AS offset",
                                     "timestamp'2024-01-01' AS timestamp")
    for batch, part in enumerate((log, log.where("topic = 't1'"), log.withColumn("offset", F.col("offset") + 20))):
        t.insert_new(part, "w", batch, range_column="offset")
    assert t.read().count() == 60 and not Path(folder, "data", "writer=w", "batch=1", "topic=t1").exists()
    found = t._asked(t.read(), log.where("topic = 't1'"), "offset", "0", "39")
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "topic" in filters and "t1" in filters and "partition" in filters and found.count() == 10
    with pytest.raises(ValueError):
        InsertTable(spark, f"{folder}-2", ROW, ["k"], parted_by=["v"])


def test_batches_of_many_keys_ask_by_range(spark, folder, monkeypatch):
    monkeypatch.setattr(staged, "ASKED_VALUES", 5)
    t = InsertTable(spark, folder, ROW, ["k"])
    t.insert_new(spark.range(50).selectExpr("id AS k", "'a' AS v", "id AS n"), "w", 0)
    t.insert_new(spark.range(40, 60).selectExpr("id AS k", "'b' AS v", "id AS n"), "w", 1)
    assert rows(t.read().groupBy("v").count()) == [("a", 50), ("b", 10)]


def test_known_keys_in_a_repeated_hour(spark, folder):
    """The hour that a change from summer time repeats has two instants of one spelling."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = InsertTable(spark, folder, "k long, t timestamp", ["k", "t"])
        second = spark.sql("SELECT 1L AS k, timestamp_seconds(1730701800) AS t")  # 2024-11-03 06:30 UTC, 01:30 again
        for batch in range(2):
            t.insert_new(second, "w", batch, range_column="t")
        assert t.read().count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_the_scan_for_known_keys_is_cut_to_the_batch(spark, folder):
    """The bounds reach the file scan as literals, where they skip row groups."""
    t = InsertTable(spark, folder, "k long, t timestamp", ["k", "t"])
    t.insert_new(frame(spark, (1, dt.datetime(2024, 1, 1)), schema="k long, t timestamp"), "w", 0)
    scan = t._within(t.read(), "t", 1704412800_000000, 1704499200_000000)
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,2024-01-05" in text and "LessThanOrEqual(t,2024-01-06" in text


def test_random_merges_against_a_dictionary(spark, folder):
    rng = random.Random(1)
    t, model = StateTable(spark, folder, ROW, ["k"]), {}
    for batch in range(4):
        load = {k: (str(rng.random()), rng.randrange(10)) for k in rng.sample(range(40), 15)}
        for k, (v, n) in load.items():
            if k not in model or n > model[k][1]:
                model[k] = (v, n)
        t.merge(frame(spark, *[(k, v, n) for k, (v, n) in load.items()]), "w", batch, [("s.n > t.n", SET_ALL)])
    assert {r[0]: (r[1], r[2]) for r in t.read().collect()} == model


def test_messages_by_content(spark, folder):
    t = message_table(spark, folder, CONTENT_KEY)
    when = dt.datetime(2024, 1, 1)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.schema)
    t.merge(frame(spark, ("k", "{a}", "t", 0, 1, when), ("k", "{b}", "t", 0, 2, when), schema=schema), "w", 0,
            [(None, SET_ALL)])
    t.merge(frame(spark, ("k", "{a}", "t", 1, 7, when), schema=schema), "w", 1, [(None, SET_ALL)], range_column="timestamp")
    assert rows(t.read().select("value", "partition", "offset")) == [("{a}", 1, 7), ("{b}", 0, 2)]


# -- snapshots --------------------------------------------------------------------------


def test_snapshot_replacement(spark, folder):
    t = SnapshotTable(spark, folder, ROW)
    assert rows(t.read()) == []
    assert t.replace(frame(spark, (1, "a", 1)), "w", 0)
    assert not t.replace(frame(spark, (9, "replayed", 1)), "w", 0)
    assert t.replace(frame(spark, (2, "b", 1)), "w", 1)
    assert rows(t.read()) == [(2, "b", 1)]
    assert t.replace(frame(spark, (3, "c", 1)), "new-writer", 0)
    assert rows(t.read()) == [(3, "c", 1)]
    t.overwrite(frame(spark, (4, "d", 1)))
    assert rows(t.read()) == [(4, "d", 1)]


# -- catalog ----------------------------------------------------------------------------


@pytest.fixture
def database(spark, folder):
    name = "db_" + folder[-8:]
    yield name
    spark.sql("USE default")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_set_up_once(spark, folder, database):
    tables = {"facts": ROW, "dims": "d date, w string"}
    assert set_up_once(spark, database, f"{folder}/db", tables)
    assert not set_up_once(spark, database, f"{folder}/db", tables)
    assert ensure_tables(spark, {**tables, "more": ROW}, database) == ["more"]
    save_table(frame(spark, (1, "a", 1)), f"{database}.facts")
    recreate_table(spark, "facts", ROW, database)
    assert rows(spark.table(f"{database}.facts")) == []


def test_tables_need_their_database(spark):
    with pytest.raises(ValueError):
        ensure_tables(spark, {"t": ROW}, "no_such_database")


def test_partitioned_table(spark, folder, database):
    ensure_database(spark, database, f"{folder}/db")
    ensure_tables(spark, {"messages": "value string, topic string, week_part string"}, database,
                  partitioned={"messages": ["topic", "week_part"]})
    assert spark.catalog.listColumns(f"{database}.messages")[1].isPartition


def test_overwrite_from_a_file_and_a_view(spark, folder, database):
    set_up_once(spark, database, f"{folder}/db", {"dims": "d date, w string"})
    spark.createDataFrame([("weekday", "2024-01-01")], "w string, d string").write.json(f"{folder}/dims")
    for _ in range(2):
        overwrite_rows(query_file(spark, f"{folder}/dims", "w, cast(d AS date) AS d"), f"{database}.dims")
    overwrite_rows(query_file(spark, f"{folder}/dims", schema="d date, w string"), f"{database}.dims")
    create_view(spark.table(f"{database}.dims"), "dims_view")
    assert rows(spark.sql("SELECT * FROM dims_view")) == [(dt.date(2024, 1, 1), "weekday")]


def test_plain_tables_refuse_catalog_merges(spark, folder, database):
    set_up_once(spark, database, f"{folder}/db", {"target": ROW})
    with pytest.raises(PySparkException, match="(?i)merge"):
        merge_into_catalog(frame(spark, (1, "a", 1)), f"{database}.target", ["k"],
                           [("s.n > t.n", {"n": "s.n"}), (None, SET_ALL)])


@pytest.mark.parametrize("kind", [InsertTable, StateTable])
def test_lasting_views_show_what_is_stored(spark, folder, database, kind):
    """Another session reads rows that came after the view was made, and after it read the view before."""
    ensure_database(spark, database, f"{folder}/db")
    spark.catalog.setCurrentDatabase("default")
    t = kind(spark, f"{folder}/t", ROW, ["k"])

    def add(batch, *data):
        t.insert_new(frame(spark, *data), "w", batch) if kind is InsertTable else t.merge(frame(spark, *data), "w", batch, [(None, SET_ALL)])

    add(0, (1, "a", 1), (None, "n", 0))
    t.register(f"{database}.t")
    other = spark.newSession()
    assert rows(other.sql(f"SELECT * FROM {database}.t")) == [(1, "a", 1), (None, "n", 0)]
    add(1, (1, "b", 2), (2, "c", 3))
    add(1, (9, "replayed", 9))
    kept = (1, "a", 1) if kind is InsertTable else (1, "b", 2)
    assert rows(other.table(f"{database}.t")) == rows(t.read()) == [kept, (2, "c", 3), (None, "n", 0)]
    again = kind(spark, f"{folder}/t", ROW, ["k"])  # a later run of the same program
    again.register(f"{database}.t")
    t = again
    add(2, (3, "d", 4))
    assert rows(other.table(f"{database}.t")) == rows(t.read()) and t.read().count() == 4


def test_a_batch_whose_run_died_before_the_catalog_knew_of_it(spark, folder, database, monkeypatch):
    ensure_database(spark, database, f"{folder}/db")
    spark.catalog.setCurrentDatabase("default")
    t = InsertTable(spark, f"{folder}/t", ROW, ["k"])
    t.register(f"{database}.t")
    with monkeypatch.context() as m:
        m.setattr(t, "_announce", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            t.insert_new(frame(spark, (1, "a", 1)), "w", 0)
    assert rows(spark.table(f"{database}.t")) == []
    assert not t.insert_new(frame(spark, (1, "a", 1)), "w", 0)
    assert rows(spark.table(f"{database}.t")) == [(1, "a", 1)]


def test_lasting_views_of_snapshots(spark, folder, database):
    ensure_database(spark, database, f"{folder}/db")
    spark.catalog.setCurrentDatabase("default")
    t = SnapshotTable(spark, f"{folder}/t", ROW)
    t.overwrite(frame(spark, (1, "a", 1)))
    t.register(f"{database}.t")
    other = spark.newSession()
    assert rows(other.table(f"{database}.t")) == [(1, "a", 1)]
    for n in range(2, 5):
        t.overwrite(frame(spark, (n, "b", n), (n + 1, "c", n)))
        assert rows(other.table(f"{database}.t")) == [(n, "b", n), (n + 1, "c", n)]
