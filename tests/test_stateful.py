"""What queries keep in state: that streams give what batches give, and that state falls behind the watermark."""

import datetime as dt
import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.operators.aggregates import reading_stats
from strata.operators.joins import interval_join, with_device
from strata.operators.messages import bad_rows, decoded_or_not, good_rows, of_topic, where
from strata.plans.trades import stream_trade_updates, totals_table, trade_summary
from strata.plans.workouts import finished_session_stats
from strata.sinks.catalog import ensure_database, save_bucketed
from strata.streaming.jobs import Job, append_to_path, await_all, for_each_batch, late_rows, upsert
from strata.streaming.progress import totals
from strata.streaming.state import watermarked, without_duplicates
from strata.streaming.stateful import first_of_key, greatest_of_key

from .conftest import rows
from .test_streaming import CUTS, at, cut, drained


def state(spark, checkpoint, **options):
    """The rows of a query's state, by Spark's own reader of it."""
    return spark.read.format("statestore").options(**options).load(checkpoint)


# -- state falls behind the watermark ---------------------------------------------------


def test_duplicate_keys_leave_the_state(spark, folder):
    df = spark.createDataFrame([(at(i * 600), i % 3) for i in range(40)], "ts timestamp, k int")
    first = cut(df.where(F.col("ts") < at(12_000)), f"{folder}/in", 1)
    stream = without_duplicates(first, ["k", "ts"], "ts", "1 hour")
    assert len(drained(stream, folder)) == 20
    kept = state(spark, f"{folder}/checkpoint").select("key.ts").collect()
    assert kept and all(r.ts > at(11_400 - 3600) for r in kept)
    df.where(F.col("ts") >= at(12_000)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    assert len(drained(stream, folder)) == 40
    later = [r.ts for r in state(spark, f"{folder}/checkpoint").select("key.ts").collect()]
    assert len(later) < 20 and min(later) > at(23_400 - 3600)


def test_groups_leave_the_state(spark, folder):
    df = spark.createDataFrame([(at(i * 600), at(i // 4 * 2400), float(i)) for i in range(24)],
                               "time timestamp, end_time timestamp, heartrate double")
    stream = cut(df, f"{folder}/in", 3)
    stats = reading_stats(watermarked(stream, "end_time"), ["end_time"])
    got = drained(stats, folder)
    held = [r.end_time for r in state(spark, f"{folder}/checkpoint").select("key.end_time").collect()]
    assert held == [at(12_000)] and at(12_000) not in [r[0] for r in got] and len(got) == 5


def test_join_sides_leave_the_state(spark, folder):
    starts = spark.createDataFrame([(at(i * 7200), i % 2) for i in range(20)], "start_time timestamp, k int")
    ends = spark.createDataFrame([(at(i * 7200 + 60), i % 2) for i in range(20)], "end_time timestamp, k int")
    pairs = interval_join(watermarked(cut(starts, f"{folder}/s", 4), "start_time"),
                          watermarked(cut(ends, f"{folder}/e", 4), "end_time"), ["k"])
    got = drained(pairs, folder)
    assert len(got) == 20
    for side in ("left", "right"):
        held = state(spark, f"{folder}/checkpoint", joinSide=side)
        assert 0 < held.count() <= 8, side


def test_windows_leave_the_state_of_updates(spark, folder):
    """In update mode with a watermark; complete mode would hold every window for good."""
    trades = [(json.dumps({"CreatedTime": str(at(i * 1800)), "Type": "BUY" if i % 2 else "SELL", "Amount": float(i)}), i) for i in range(32)]
    messages = spark.createDataFrame(trades, "value string, i int")
    expected = rows(trade_summary(messages))
    table = totals_table(spark, f"{folder}/t")
    stream = cut(messages.select("i", "value"), f"{folder}/in", 4).select("value")
    query = stream_trade_updates(stream, table, Job("t", f"{folder}/c"))
    assert await_all([query]) == {"t": 0}
    assert rows(table.read()) == expected and len(expected) == 32
    held = state(spark, f"{folder}/c").count()
    assert 0 < held <= 2 and totals(query).peak_state <= 10
    written = spark.read.parquet(f"{folder}/t/data").groupBy("batch").count().collect()
    assert sorted(r["count"] for r in written) == [8, 8, 8, 8]


# -- arbitrary state ---------------------------------------------------------------------


@pytest.mark.parametrize("files", CUTS)
def test_first_of_key(spark, folder, files):
    data = [(i, i % 5 if i % 7 else None, f"d{i}") for i in range(40)]
    df = spark.createDataFrame(data, "i int, k int, d string")
    got = drained(first_of_key(cut(df, f"{folder}/in", files), ["k"], ["i"]), folder)
    first = {}
    for row in data:
        first.setdefault(row[1], row)
    assert got == sorted(first.values(), key=repr)
    seen = state(spark, f"{folder}/checkpoint", stateVarName="seen")
    assert seen.count() == 6


def test_keys_are_forgotten_after_their_time(spark, folder, request):
    df = spark.createDataFrame([(1, 7)], "i int, k int")
    stream = first_of_key(cut(df, f"{folder}/in", 1), ["k"], ["i"], remembered=dt.timedelta(seconds=6))
    no_data = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(no_data, "false")
    request.addfinalizer(lambda: spark.conf.set(no_data, "true"))
    for again in range(2):
        df.write.mode("append").parquet(f"{folder}/in")
        drained(stream, folder)
    assert len(rows(spark.read.parquet(f"{folder}/out"))) == 1
    time.sleep(7)
    df.write.mode("append").parquet(f"{folder}/in")
    assert len(drained(stream, folder)) == 2


@pytest.mark.parametrize("files", CUTS)
def test_greatest_of_key(spark, folder, files):
    data = [(at(i // 6 * 3600), i % 2, at(i * 700 % 9000 + i * 100) if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(data, "login timestamp, k int, logout timestamp")
    stream = greatest_of_key(cut(df, f"{folder}/in", files), ["k", "login"], "login", "logout", kept=dt.timedelta(hours=1))
    seen = []
    query = for_each_batch(stream, lambda rows_, _: seen.extend(map(tuple, rows_.collect())), Job("g", f"{folder}/checkpoint"), "update")
    assert await_all([query]) == {"g": 0}
    last = {}
    for k, login, logout in seen:
        assert last.get((k, login)) is None or logout > last[k, login]
        last[k, login] = logout
    assert sorted((k, login, logout) for (k, login), logout in last.items()) == sorted(
        (tuple(r) for r in df.groupBy("k", "login").agg(F.max("logout")).collect()), key=lambda r: r[:2])
    held = state(spark, f"{folder}/checkpoint", stateVarName="greatest").count()
    assert held < len(last) / 4 < totals(query).peak_state


@pytest.mark.parametrize("files", [1, 3])
def test_greatest_of_many_keys_is_held_in_parts(spark, folder, files):
    """State is called for parts of the keys, not for each of 1,500; keys stay apart by type, null and microsecond."""
    data = [(at(0), i % 1500 if i % 10 else None, dt.datetime(2024, 1, 1, 0, 0, 0, i % 3), -0.0 if i % 2 else 0.0, at(i)) for i in range(3000)]
    df = spark.createDataFrame(data, "login timestamp, k long, t timestamp, z double, logout timestamp")
    stream = greatest_of_key(cut(df, f"{folder}/in", files), ["k", "t", "z", "login"], "login", "logout")
    seen = []
    query = for_each_batch(stream, lambda rows_, _: seen.extend(map(tuple, rows_.collect())), Job("g", f"{folder}/checkpoint"), "update")
    assert await_all([query]) == {"g": 0}
    last = {}
    for k, t, z, login, logout in seen:
        assert (k, t, z) not in last or logout > last[k, t, z]
        last[k, t, z] = logout
    wanted = {(r.k, r.t, r.z): r.m for r in df.groupBy("k", "t", "z").agg(F.max("logout").alias("m")).collect()}
    assert last == wanted and len(wanted) > 1000
    assert state(spark, f"{folder}/checkpoint", stateVarName="greatest").count() <= 256


# -- chained joins -----------------------------------------------------------------------


@pytest.mark.parametrize("files", [1, 3])
def test_finished_sessions_in_one_query(spark, folder, files):
    key = "user_id long, workout_id int, session_id int"
    starts = spark.createDataFrame([(at(i * 3600), i % 3, 1, i) for i in range(12)], f"start_time timestamp, {key}")
    stops = spark.createDataFrame([(at(i * 3600 + 600 * (i % 4 + 1)), i % 3, 1, i) for i in range(12)], f"end_time timestamp, {key}")
    readings = spark.createDataFrame([(at(i * 3600 + m * 300), i % 3 * 10, 100.0 + m) for i in range(12) for m in range(9)],
                                     "time timestamp, device_id long, heartrate double")
    users = spark.createDataFrame([(0, 0), (1, 10)], "user_id long, device_id long")
    expected = rows(finished_session_stats(starts, stops, users, readings))
    late = at(40 * 86_400)
    flush = [spark.createDataFrame([(late, *rest)], df.schema) for df, rest in
             ((starts, (-1, 1, -1)), (stops, (-1, 1, -1)), (readings, (-1, 1.0)))]
    streams = [watermarked(cut(df.union(last), f"{folder}/{n}", files), df.columns[0])
               for n, (df, last) in enumerate(zip((starts, stops, readings), flush))]
    got = drained(finished_session_stats(streams[0], streams[1], users, streams[2]), folder)
    assert len(expected) == 8 and got == expected


# -- progress and pools --------------------------------------------------------------------


def test_late_rows_of_a_long_query_are_all_counted(spark, folder):
    """A query of 150 micro-batches whose late row comes in its third: Spark's own reports keep the last 100."""
    source = f"{folder}/in"
    seconds = [1000, 1001, 10, *range(1002, 1149)]
    for n, second in enumerate(seconds):
        Path(source).mkdir(parents=True, exist_ok=True)
        Path(source, f"{n:04}.json").write_text(json.dumps({"k": n, "s": second}))
    stream = spark.readStream.schema("k int, s long").option("maxFilesPerTrigger", 1).json(source)
    timed = stream.withColumn("t", F.timestamp_seconds("s")).withWatermark("t", "30 seconds")
    narrow = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        query = append_to_path(timed.dropDuplicates(["k", "t"]), f"{folder}/out", Job("long", f"{folder}/checkpoint"))
        assert await_all([query]) == {"long": 1}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", narrow)
    assert len(query.recentProgress) <= 100 < totals(query).batches and totals(query).rows == 150
    assert sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators) == 0
    assert late_rows(query) == 1


def test_pools_share_the_application(spark, folder):
    """Fair scheduling is on before the first job, and each query's batches run in its own pool."""
    assert spark.sparkContext._jsc.sc().getSchedulingMode().toString() == "FAIR"
    spark.range(4).write.parquet(f"{folder}/in")
    pools = {}

    def look(name):
        def seen(batch, _):
            batch.count()
            pools[name] = batch.sparkSession.sparkContext.getLocalProperty("spark.scheduler.pool")
        return for_each_batch(spark.readStream.schema("id long").parquet(f"{folder}/in"), seen, Job(name, f"{folder}/{name}", pool=name))

    await_all([look("bronze"), look("silver")])
    assert pools == {"bronze": "bronze", "silver": "silver"}
    known = spark.sparkContext._jsc.sc().getPoolForName
    assert known("bronze").isDefined() and known("silver").isDefined()


# -- static sides and dead letters ------------------------------------------------------------


def test_a_bucketed_dimension_is_joined_as_it_lies(spark, folder):
    database = "dims_" + folder[-8:]
    current = spark.catalog.currentDatabase()
    ensure_database(spark, database, f"{folder}/db")
    spark.catalog.setCurrentDatabase(current)
    users = spark.range(1000).selectExpr("id AS user_id", "id * 7 AS device_id")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans, got = [], []
    try:
        save_bucketed(users, f"{database}.users", ["user_id"], width)
        spark.range(50).selectExpr("id AS user_id", "1 AS workout_id", "id AS session_id", "now() AS start_time", "now() AS end_time"
                                   ).write.parquet(f"{folder}/in")
        stream = stream_of(spark, f"{folder}/in")

        def look(batch, _):
            joined = with_device(batch, spark.table(f"{database}.users"))
            got.extend(joined.select("user_id", "device_id").collect())
            plans.append(joined._jdf.queryExecution().executedPlan().toString())
        await_all([for_each_batch(stream, look, Job("devices", f"{folder}/c"))])
        plain = with_device(spark.read.parquet(f"{folder}/in"), users)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP DATABASE {database} CASCADE")
    assert sorted(map(tuple, got)) == [(k, k * 7) for k in range(50)]
    assert "SortMergeJoin" in plans[0] and plain.count("Exchange hashpartitioning") == 2
    assert plans[0].split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1


def stream_of(spark, path):
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def test_dead_letters(spark, folder):
    texts = ['{"a": 1, "b": "x"}', '{"a": "one"}', "{broken", "", None, '{"b": null}', "[1]", '{"a": 2, "c": 3}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    split = decoded_or_not(df, "a long, b string")
    good = {r.i: (r.value.a, r.value.b) for r in good_rows(split).collect()}
    bad = {r.i: r.malformed for r in bad_rows(split).collect()}
    assert good == {0: (1, "x"), 5: (None, None), 7: (2, None)}
    assert bad == {1: '{"a": "one"}', 2: "{broken", 3: "", 4: "", 6: "[1]"}


def test_conditions_and_topics(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "topic string, n int")
    assert rows(where(df, "n > 1 AND topic IS NOT NULL")) == rows(of_topic(df, "b")) == [("b", 2)]
    assert rows(where(df, F.col("n") < 0)) == []
