"""Streams give what batches give, however the input is cut, and survive restarts."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata.operators.aggregates import reading_stats, reward_points
from strata.operators.joins import containment_join, interval_join
from strata.operators.messages import encode_log
from strata.operators.text import word_count
from strata.plans.invoices import (
    store_decoded, InvoiceFolders, flatten, ingest, rewards_additive, rewards_complete, rewards_replace, rewards_table,
)
from strata.plans.words import COUNTS, batch_word_count, stream_word_count
from strata.schemas import INVOICE, MESSAGE, REGISTERED_USER, TABLES
from strata.queries.registry import in_event_order
from strata.sinks.log import log_sink_options, log_writer
from strata.sinks.staged import InsertTable, SnapshotTable, StateTable
from strata.sources.files import read_text, stream_csv, stream_files, stream_json, stream_parquet
from strata.sources.log import LogConnection, log_source_options, read_log, stream_log
from strata.streaming.jobs import Job, append_to_path, await_all, for_each_batch, insert_new, run_stages, writer_id
from strata.streaming.state import watermarked, without_duplicates

from .conftest import rows

CUTS = [1, 2, 4]


def cut(df, folder, files):
    """The rows in event order as that many files, and a stream that reads one file at a time."""
    data = df.orderBy(df.columns[0]).collect()
    size = -(-len(data) // files)
    for i in range(files):
        part = data[i * size:(i + 1) * size]
        df.sparkSession.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(folder)
    return stream_parquet(df.sparkSession, folder, files_per_trigger=1)


def drained(df, folder, mode="append"):
    await_all([append_to_path(df, f"{folder}/out", Job("q", f"{folder}/checkpoint"))])
    return rows(df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out"))


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def invoices(spark):
    return spark.createDataFrame([(i, str(i % 3), float(i)) for i in range(40)],
                                 "i int, CustomerCardNo string, TotalAmount double")


@pytest.mark.parametrize("files", CUTS)
@pytest.mark.parametrize("kind", ["complete", "replace", "additive"])
def test_rewards(spark, folder, invoices, kind, files):
    stream = cut(invoices, f"{folder}/in", files)
    job = Job("rewards", f"{folder}/checkpoint")
    if kind == "complete":
        table = SnapshotTable(spark, f"{folder}/t", TABLES["customer_rewards"])
        query = rewards_complete(stream, table, job)
    else:
        table = rewards_table(spark, f"{folder}/t")
        query = (rewards_replace if kind == "replace" else rewards_additive)(stream, table, job)
    await_all([query])

    def totals(df):
        return rows(df.select("CustomerCardNo", F.round("TotalAmount", 6), F.round("TotalPoints", 6)))

    assert totals(table.read()) == totals(reward_points(invoices))


@pytest.mark.parametrize("files", CUTS)
def test_word_count(spark, folder, files):
    Path(folder, "text").mkdir(parents=True)
    for i in range(files):
        Path(folder, "text", f"{i}.txt").write_text(f"The cat. the Dog {i}\nsat. ")
    table = SnapshotTable(spark, f"{folder}/t", COUNTS)
    job = Job("words", f"{folder}/checkpoint")
    await_all([stream_word_count(spark, f"{folder}/text", table, job)])
    assert rows(table.read()) == rows(batch_word_count(spark, f"{folder}/text"))
    assert rows(table.read().where("word IN ('cat', 'dog', 'the')")) == [
        ("cat", files), ("dog", files), ("the", 2 * files)]


@pytest.mark.parametrize("files", CUTS)
@pytest.mark.parametrize("spread", [None, 3])
def test_duplicates(spark, folder, files, spread):
    df = spark.createDataFrame([(at(i // 3), i % 2) for i in range(60)], "ts timestamp, k int")
    stream = cut(df.select("ts", "k"), f"{folder}/in", files)
    got = drained(without_duplicates(stream, ["k", "ts"], "ts", spread=spread), folder)
    assert got == rows(df.distinct())


def test_late_copies_are_dropped_and_kept_without_bound(spark, folder):
    # Rows count as late by the watermark of the batch before, so one batch lies in between.
    df = spark.createDataFrame([(1, at(0)), (2, at(1000)), (3, at(1001)), (4, at(10)), (5, at(990))],
                               "i int, ts timestamp")
    got = drained(without_duplicates(cut(df, f"{folder}/a", 5), ["ts"], "ts"), f"{folder}/1")
    assert [r[0] for r in got] == [1, 2, 3, 5]
    got = drained(without_duplicates(cut(df, f"{folder}/b", 5), ["ts"], "ts", lateness=None), f"{folder}/2")
    assert [r[0] for r in got] == [1, 2, 3, 4, 5]


def test_copies_within_the_lateness(spark, folder):
    df = spark.createDataFrame([(1, 7, at(0)), (2, 7, at(20)), (3, 9, at(1000)), (4, 9, at(1010)), (5, 7, at(1020))],
                               "i int, k int, ts timestamp")
    stream = without_duplicates(cut(df, f"{folder}/in", 5), ["k"], "ts", within_lateness=True)
    assert [r[0] for r in drained(stream, folder)] == [1, 3, 5]


@pytest.mark.parametrize("files", CUTS)
def test_interval_join(spark, folder, files):
    starts = spark.createDataFrame([(at(i * 1800), i % 2) for i in range(20)], "start_time timestamp, k int")
    ends = spark.createDataFrame([(at(i * 1700 + 60), i % 2) for i in range(20)], "end_time timestamp, k int")
    expected = rows(interval_join(starts, ends, ["k"]))
    stream = interval_join(
        watermarked(cut(starts, f"{folder}/s", files), "start_time", "1 day"),
        watermarked(cut(ends, f"{folder}/e", files), "end_time", "1 day"), ["k"])
    assert len(expected) > 20 and drained(stream, folder) == expected


@pytest.mark.parametrize("files", CUTS)
def test_containment_join(spark, folder, files):
    points = spark.createDataFrame([(at(i * 600), i % 2) for i in range(60)], "time timestamp, k int")
    spans = spark.createDataFrame([(at(i * 3000), at(i * 3000 + 4000), i % 2) for i in range(12)],
                                  "end_time timestamp, start_time timestamp, k int").select(
        F.col("end_time").alias("start_time"), F.col("start_time").alias("end_time"), "k")
    expected = rows(containment_join(points, spans, ["k"]))
    stream = containment_join(
        watermarked(cut(points, f"{folder}/p", files), "time", "1 day"),
        watermarked(cut(spans, f"{folder}/s", files), "end_time", "1 day"), ["k"])
    assert len(expected) > 20 and drained(stream, folder) == expected


def test_join_state_is_dropped_behind_the_watermark(spark, folder):
    df = spark.createDataFrame([(at(i * 3600), 1) for i in range(200)], "t timestamp, k int")
    starts = watermarked(cut(df, f"{folder}/s", 4).withColumnRenamed("t", "start_time"), "start_time")
    ends = watermarked(cut(df.limit(0).union(df), f"{folder}/e", 4).withColumnRenamed("t", "end_time"), "end_time")
    query = append_to_path(interval_join(starts, ends, ["k"]), f"{folder}/out", Job("q", f"{folder}/checkpoint"))
    await_all([query])
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 30


@pytest.mark.parametrize("files", CUTS)
def test_append_groups_come_out_behind_the_watermark(spark, folder, files):
    df = spark.createDataFrame([(at(i // 4 * 60), i % 2, float(i)) for i in range(40)],
                               "end_time timestamp, k int, heartrate double")
    stream = reading_stats(watermarked(cut(df, f"{folder}/in", files), "end_time"), ["k", "end_time"])
    assert drained(stream, folder) == rows(reading_stats(df.where(F.col("end_time") < at(540)), ["k", "end_time"]))


def test_restart_reads_only_what_is_new(spark, folder):
    table = InsertTable(spark, f"{folder}/t", "k long, n long", ["k"])
    seen = []
    for n in (1, 2):
        spark.range(n * 10).select(F.col("id").alias("k"), F.lit(n).cast("long").alias("n")).write.mode(
            "append").parquet(f"{folder}/in")
        query = insert_new(stream_parquet(spark, f"{folder}/in"), table, Job("q", f"{folder}/checkpoint"), ["n"])
        await_all([query])
        seen.append(sum(p["numInputRows"] for p in query.recentProgress))
    assert seen == [10, 20]
    assert sorted(map(tuple, table.read().collect())) == [(k, 1 + k // 10) for k in range(20)]


def test_a_fresh_checkpoint_is_another_writer(spark, folder):
    """Batch numbers start again with a new checkpoint; the table must not take them for replays."""
    table = rewards_table(spark, f"{folder}/t")
    data = spark.createDataFrame([("a", 1.0)], "CustomerCardNo string, TotalAmount double")
    data.write.parquet(f"{folder}/in")
    for i in range(2):
        await_all([rewards_additive(stream_parquet(spark, f"{folder}/in"), table, Job("r", f"{folder}/c{i}"))])
    assert rows(table.read()) == [("a", 2.0, 0.4)]


def test_a_batch_that_fails_after_its_merge_is_not_merged_again(spark, folder):
    table = StateTable(spark, f"{folder}/t", "k long, n long", ["k"])
    spark.createDataFrame([(1, 5)], "k long, n long").write.parquet(f"{folder}/in")
    add = [(None, {"n": "t.n + s.n"})]
    table.merge(spark.createDataFrame([(1, 100)], "k long, n long"), "before", 0, add)
    crashes = [True]

    def merge(batch, batch_id):
        table.merge(batch, writer_id(batch.sparkSession), batch_id, add)
        if crashes.pop() if crashes else False:
            raise RuntimeError("lost after the merge")

    with pytest.raises(StreamingQueryException):
        await_all([for_each_batch(stream_parquet(spark, f"{folder}/in"), merge, Job("q", f"{folder}/checkpoint"))])
    await_all([for_each_batch(stream_parquet(spark, f"{folder}/in"), merge, Job("q", f"{folder}/checkpoint"))])
    assert rows(table.read()) == [(1, 105)]


def test_a_stateful_query_gets_over_a_batch_its_table_already_holds(spark, folder):
    table = InsertTable(spark, f"{folder}/t", "k int, ts timestamp", ["k", "ts"])
    spark.createDataFrame([(1, at(0)), (1, at(0))], "k int, ts timestamp").write.parquet(f"{folder}/in")
    job = Job("q", f"{folder}/checkpoint")

    def stream():
        return without_duplicates(stream_parquet(spark, f"{folder}/in"), ["k", "ts"], "ts")

    def insert_and_die(batch, batch_id):
        table.insert_new(batch, writer_id(batch.sparkSession), batch_id)
        raise RuntimeError("lost after the insert")

    with pytest.raises(StreamingQueryException):
        await_all([for_each_batch(stream(), insert_and_die, job)])
    assert len(rows(table.read())) == 1
    spark.createDataFrame([(1, at(0)), (2, at(1))], "k int, ts timestamp").write.mode("append").parquet(f"{folder}/in")
    await_all([insert_new(stream(), table, job)])
    await_all([insert_new(stream(), table, job)])
    assert rows(table.read()) == [(1, at(0)), (2, at(1))]


def test_micro_batch_work_is_adaptive_and_the_query_is_not(spark, folder):
    seen = []
    spark.createDataFrame([(1, at(0))], "k int, ts timestamp").write.parquet(f"{folder}/in")
    stream = without_duplicates(stream_parquet(spark, f"{folder}/in"), ["k", "ts"], "ts")

    def look(batch, batch_id):
        batch.count()
        seen.append((batch.sparkSession, batch.sparkSession.conf.get("spark.sql.adaptive.enabled")))

    await_all([for_each_batch(stream, look, Job("q", f"{folder}/checkpoint"))])
    assert {flag for _, flag in seen} == {"true"}
    assert seen[0][0].conf.get("spark.sql.adaptive.enabled") == "false"


def test_one_failure_stops_the_stage(spark, folder):
    spark.range(3).write.parquet(f"{folder}/in")

    def broken(batch, batch_id):
        raise RuntimeError("no")

    def failing():
        return for_each_batch(stream_parquet(spark, f"{folder}/in"), broken, Job("bad", f"{folder}/c1"))

    def endless():
        return append_to_path(stream_parquet(spark, f"{folder}/in"), f"{folder}/out", Job("on", f"{folder}/c2", every="1 second"))

    with pytest.raises(StreamingQueryException):
        run_stages([[failing, endless], [endless]])
    assert not [q for q in spark.streams.active if q.name in ("bad", "on")]


def test_interval_trigger_keeps_running(spark, folder):
    spark.range(3).write.parquet(f"{folder}/in")
    job = Job("live", f"{folder}/checkpoint", every="1 second", pool="silver_p1")
    [query] = run_stages([[lambda: append_to_path(stream_parquet(spark, f"{folder}/in"), f"{folder}/out", job)]], once=False)
    try:
        query.processAllAvailable()
        assert query.isActive and query.name == "live"
    finally:
        query.stop()
    assert spark.read.parquet(f"{folder}/out").count() == 3


# -- files ------------------------------------------------------------------------------


def test_text_records(spark, folder):
    Path(folder).mkdir(parents=True)
    Path(folder, "a.txt").write_text("one two.three\nfour.")
    assert rows(read_text(spark, folder)) == [("one two",), ("three\nfour",)]
    assert rows(word_count(read_text(spark, folder)))[0] == ("one", 1)


def test_csv_skips_blank_lines_and_tells_its_file(spark, folder):
    Path(folder, "in").mkdir(parents=True)
    Path(folder, "in", "a.csv").write_text(
        "user_id,device_id,mac_address,registration_timestamp\n1,2,aa,1.5\n\n\n")
    stream = stream_csv(spark, f"{folder}/in", REGISTERED_USER, files_per_trigger=1)
    [row] = drained(stream.withColumn("has_time", F.col("load_time").isNotNull()).drop("load_time"), folder)
    assert row[:4] == (1, 2, "aa", 1.5) and row[4].endswith("/in/a.csv") and row[5] is True


def test_json_one_file_per_trigger(spark, folder):
    Path(folder, "in").mkdir(parents=True)
    for i in range(3):
        Path(folder, "in", f"{i}.json").write_text(json.dumps({"key": str(i), "offset": i}) + "\n{broken\n")
    query = append_to_path(stream_json(spark, f"{folder}/in", MESSAGE, 1), f"{folder}/out", Job("j", f"{folder}/c"))
    await_all([query])
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == 3
    assert sorted(r[0] or "" for r in spark.read.parquet(f"{folder}/out").select("key").collect()) == ["", "", "", "0", "1", "2"]


def test_batches_bounded_by_bytes(spark, folder):
    Path(folder, "in").mkdir(parents=True)
    for i, size in enumerate((10, 10, 10, 5000, 10, 10)):
        Path(folder, "in", f"{i}.json").write_text(json.dumps({"key": "k" * size}))
    stream = stream_json(spark, f"{folder}/in", MESSAGE, bytes_per_trigger=1000)
    seen = []
    await_all([for_each_batch(stream, lambda batch, _: seen.append(batch.count()), Job("b", f"{folder}/c"))])
    assert sum(seen) == 6 and len(seen) >= 2
    with pytest.raises(ValueError):
        stream_files(spark, "json", f"{folder}/in", MESSAGE, 1, bytes_per_trigger="1g")


def test_archive(spark, folder):
    Path(folder, "in").mkdir(parents=True)
    for i in range(3):
        Path(folder, "in", f"{i}.json").write_text(json.dumps({"key": str(i)}))
    stream = stream_files(spark, "json", f"{folder}/in", MESSAGE, 1, "archive", f"{folder}/archive")
    await_all([append_to_path(stream, f"{folder}/out", Job("a", f"{folder}/checkpoint"))])
    assert spark.read.parquet(f"{folder}/out").count() == 3
    assert len(list(Path(folder, "archive").rglob("*.json"))) == 2
    assert len(list(Path(folder, "in").glob("*.json"))) == 1


def test_clean_source_arguments(spark):
    with pytest.raises(ValueError):
        stream_files(spark, "json", "/x", MESSAGE, clean_source="archive")
    with pytest.raises(ValueError):
        stream_files(spark, "json", "/x", MESSAGE, clean_source="shred")


def test_invoice_layers(spark, folder):
    Path(folder, "in").mkdir(parents=True)
    line = {"InvoiceNumber": "1", "DeliveryAddress": {"City": "C"}, "TotalAmount": 3.0, "InvoiceLineItems": [
        {"ItemCode": "a", "ItemQty": 1, "TotalValue": 1.0}, {"ItemCode": "b", "ItemQty": 1, "TotalValue": 2.0}]}
    Path(folder, "in", "1.json").write_text(json.dumps(line) + "\n" + json.dumps({"InvoiceNumber": "2"}))
    folders = InvoiceFolders(f"{folder}/in", f"{folder}/bronze", f"{folder}/silver", f"{folder}/checkpoints")
    for _ in range(2):
        run_stages([[lambda: ingest(spark, folders)], [lambda: flatten(spark, folders)]])
    bronze = spark.read.schema(f"{INVOICE}, InputFile string").parquet(folders.bronze)
    assert bronze.count() == 2 and bronze.first().InputFile.endswith("/in/1.json")
    assert rows(spark.read.parquet(folders.silver).select("City", "ItemCode")) == [("C", "a"), ("C", "b")]


# -- message log ------------------------------------------------------------------------

CONNECTION = LogConnection("host:9092", "SASL_SSL", "PLAIN", "me", "secret")


def test_log_options():
    assert log_source_options(CONNECTION, "invoices", 10, 1) == {
        "kafka.bootstrap.servers": "host:9092", "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": "org.apache.kafka.common.security.plain.PlainLoginModule required"
                                  " username='me' password='secret';",
        "subscribe": "invoices", "maxOffsetsPerTrigger": "10", "startingTimestamp": "1"}
    assert log_source_options(LogConnection("h"), "t") == {"kafka.bootstrap.servers": "h", "subscribe": "t"}
    assert log_sink_options(LogConnection("h"), "t", "/c") == {
        "kafka.bootstrap.servers": "h", "topic": "t", "checkpointLocation": "/c"}


def test_log_connector_comes_with_the_cluster(spark, folder):
    """Without the connector Spark names it; with it, the same calls work."""
    with pytest.raises(Exception, match="kafka"):
        stream_log(spark, CONNECTION, "invoices")
    with pytest.raises(Exception, match="kafka"):
        read_log(spark, CONNECTION, "invoices")
    spark.range(1).write.parquet(folder)
    writer = log_writer(stream_parquet(spark, folder), "id", CONNECTION, "t", f"{folder}-checkpoint")
    with pytest.raises(Exception, match="kafka"):
        writer.start()


def test_late_rows_are_counted_and_pools_do_not_leak(spark, folder):
    for n, second in enumerate((100, 1000, 10)):
        spark.createDataFrame([(n, second)], "k int, s long").write.mode("append").parquet(f"{folder}/in")
    source = spark.readStream.schema("k int, s long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    timed = source.withColumn("t", F.timestamp_seconds("s"))
    distinct = without_duplicates(timed, ["k", "t"], "t")
    query = append_to_path(distinct, f"{folder}/out", Job("late", f"{folder}/checkpoint", pool="a"))
    assert await_all([query]) == {"late": 1}
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    Job("next", f"{folder}/other").writer(distinct, "append")
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_loads_follow_event_time(spark, folder):
    events = spark.range(1000).select("id", F.timestamp_seconds(F.col("id") * 7919 % 1000).alias("ts"))
    loads = in_event_order(spark, events, f"{folder}/in", "ts")
    seen = []
    query = for_each_batch(loads, lambda rows, _: seen.append(rows.agg(F.min("ts"), F.max("ts"), F.count("*")).first()),
                           Job("loads", f"{folder}/checkpoint"))
    await_all([query])
    assert len(seen) == 4 and sum(r[2] for r in seen) == 1000
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))


def test_decoded_log_is_stored_and_sent_on(spark, folder):
    """Records as a log gives them, binary and with positions, by way of files."""
    sent = spark.createDataFrame([("S1", 5.0, 0), ("S2", None, 1)], "StoreID string, TotalAmount double, n long")
    log = encode_log(sent.drop("n"), "StoreID").select(
        F.col("key").cast("binary"), F.col("value").cast("binary"), F.lit("invoices").alias("topic"), F.lit(0).alias("partition"),
        F.lit(7).cast("long").alias("offset"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"))
    log.write.parquet(f"{folder}/log")
    source = stream_parquet(spark, f"{folder}/log")
    await_all([store_decoded(source, f"{folder}/out", Job("decoded", f"{folder}/checkpoint"))])
    got = spark.read.parquet(f"{folder}/out")
    assert rows(got.select("key", "value.StoreID", "value.TotalAmount", "topic", "offset")) == [
        ("S1", "S1", 5.0, "invoices", 7), ("S2", "S2", None, "invoices", 7)]
