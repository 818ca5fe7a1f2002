"""Streaming forms of the operators, run to the end of the standard tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.aggregates import reading_stats
from strata.operators.joins import containment_join, interval_join, with_device
from strata.operators.messages import bad_rows, decoded_or_not, good_rows
from strata.plans.trades import TOTALS, stream_trade_summary, stream_trade_updates, totals_table
from strata.plans.words import COUNTS, batch_word_count, stream_word_count
from strata.plans.workouts import KEYS, LATER_LOGOUT, finished_session_stats
from strata.queries.batch import (
    CONTAINED, CONTAINMENT_SQL, INTERVAL_SQL, STATS_SQL, TRADE_WINDOW_SQL, WORD_COUNT_SQL, click_starts, lasting,
    other_points, purchase_ends, session_readings, signup_spans, users_of,
)
from strata.queries.registry import (
    events, in_batches, in_event_order, plain_times, query, rounded, run_folder, streaming_session, table, table_stream,
)
from strata.schemas import GYM_LOGIN, MESSAGE, REGISTERED_USER, STORED_MESSAGE, TABLES
from strata.sinks.catalog import ensure_database, save_bucketed
from strata.sinks.staged import SnapshotTable, StateTable
from strata.sources.files import stream_csv, stream_files, stream_json, stream_loaded, with_load_day
from strata.sources.fs import SharedFs
from strata.streaming.jobs import Job, append_to_path, await_all, upsert
from strata.streaming.state import watermarked, without_duplicates
from strata.streaming.stateful import first_of_key, greatest_of_key


def complete(queries) -> None:
    """Wait for streams whose results are to hold every row: one that dropped late rows is an error."""
    if late := {name: n for name, n in await_all(queries).items() if n}:
        raise ValueError(f"rows dropped as late: {late}")


def _land_text(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Documents as text files, each followed by the separator the readers cut at."""
    table(spark, sf_dir, "documents").select("text").write.option("lineSep", ".").text(folder)


@query(WORD_COUNT_SQL)
def word_count_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files to a managed table of counts."""
    folder = run_folder(spark, "word_count_files")
    _land_text(spark, sf_dir, f"{folder}/text")
    database = "words_" + folder[-8:]
    current = spark.catalog.currentDatabase()
    ensure_database(spark, database, f"{folder}/database")
    spark.catalog.setCurrentDatabase(current)
    return batch_word_count(spark, f"{folder}/text", f"{database}.word_counts")


@query(WORD_COUNT_SQL)
def word_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, folder = streaming_session(spark), run_folder(spark, "word_count_stream")
    _land_text(session, sf_dir, f"{folder}/text")
    counts = SnapshotTable(spark, f"{folder}/counts", COUNTS)
    await_all([stream_word_count(session, f"{folder}/text", counts, Job("word_count", f"{folder}/checkpoint"))])
    return counts.read()


@query(TRADE_WINDOW_SQL)
def trade_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade messages in several loads; every load rewrites the totals."""
    session, folder = streaming_session(spark), run_folder(spark, "trade_window_stream")
    messages = trade_messages(in_batches(session, table(session, sf_dir, "events"), f"{folder}/landing"))
    totals = SnapshotTable(spark, f"{folder}/totals", TOTALS)
    await_all([stream_trade_summary(messages, totals, Job("trades", f"{folder}/checkpoint"))])
    return plain_times(rounded(totals.read(), "TotalBuy", "TotalSell"))


def trade_messages(source: DataFrame) -> DataFrame:
    kind = F.when(F.col("event_type") == "purchase", "BUY").when(F.col("event_type") == "click", "SELL")
    return source.select(F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("CreatedTime"),
        kind.otherwise("QUOTE").alias("Type"), F.col("value").alias("Amount"),
        F.lit("B1").alias("BrokerCode"))).alias("value"))


@query(TRADE_WINDOW_SQL)
def trade_window_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade messages in loads that follow event time; every load writes the windows it touched."""
    session, folder = streaming_session(spark), run_folder(spark, "trade_window_updates")
    source = in_event_order(session, table(session, sf_dir, "events"), f"{folder}/landing", "ts")
    totals = totals_table(session, f"{folder}/totals")
    complete([stream_trade_updates(trade_messages(source), totals, Job("trades", f"{folder}/checkpoint"))])
    return plain_times(rounded(totals.read(), "TotalBuy", "TotalSell"))


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def first_of_user_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user, remembered in the query's state without an event time."""
    session, folder = streaming_session(spark), run_folder(spark, "first_of_user_stream")
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # or it would wait for keys to be forgotten
    # Events are numbered in the order of their times.
    loads = in_event_order(session, table(session, sf_dir, "events"), f"{folder}/landing", "ts").select("user_id", "event_id")
    first = first_of_key(loads, ["user_id"], ["event_id"], remembered=dt.timedelta(days=7))
    complete([append_to_path(first, f"{folder}/rows", Job("first", f"{folder}/checkpoint"))])
    return spark.read.parquet(f"{folder}/rows")


@query("""
    SELECT 'mac' || user_id AS mac_address, user_id % 7 AS gym, date_trunc('day', ts) AS login,
           max(ts + to_microseconds(CAST(round(value * 100) AS BIGINT) * 1000000)) AS logout
    FROM events GROUP BY ALL
""")
def greatest_logout_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits whose greatest logout lives in the query's state until the watermark has passed them."""
    session, folder = streaming_session(spark), run_folder(spark, "greatest_logout_stream")
    source = events(in_event_order(session, table(session, sf_dir, "events"), f"{folder}/landing", "ts"))
    visits = source.select(
        F.concat(F.lit("mac"), F.col("user_id").cast("string")).alias("mac_address"), (F.col("user_id") % 7).alias("gym"),
        F.date_trunc("day", "ts").alias("login"), lasting(F.col("ts"), F.col("value"), 1_000_000).alias("logout"))
    grown = greatest_of_key(visits, KEYS["gym_logs"], "login", "logout", kept=dt.timedelta(days=1))
    logs = StateTable(session, f"{folder}/logs", TABLES["gym_logs"], KEYS["gym_logs"])
    complete([upsert(grown, logs, Job("logs", f"{folder}/checkpoint"), LATER_LOGOUT, range_column="login")])
    return plain_times(logs.read())


@query("""
    WITH done AS (
        SELECT user_id, event_id AS session_id, ts AS start_time,
               ts + to_microseconds(CAST(round(value * 100) AS BIGINT) * 600000) AS end_time, value
        FROM events WHERE event_type = 'click'),
    readings AS (
        SELECT user_id, start_time + to_seconds(m * 60) AS s, round(value + m, 4) AS heartrate
        FROM done, (SELECT unnest([0, 7, 20]) AS m))
    SELECT d.user_id, CAST(1 AS INTEGER) AS workout_id, d.session_id, d.end_time, min(r.heartrate) AS min_bpm,
           round(avg(r.heartrate), 8) AS avg_bpm, max(r.heartrate) AS max_bpm, count(*) AS num_recordings
    FROM done d JOIN readings r ON r.user_id = d.user_id AND r.s > d.start_time AND r.s <= d.end_time
    WHERE d.user_id IN (SELECT c_custkey FROM customer)
      AND d.end_time < d.start_time + INTERVAL 3 HOUR AND d.end_time < r.s + INTERVAL 3 HOUR
    GROUP BY d.user_id, d.session_id, d.end_time
""")
def finished_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts, stops and readings to statistics of finished sessions in one query, two joins and a group with state each."""
    session, folder = streaming_session(spark), run_folder(spark, "finished_sessions_stream")
    clicks = events(table(session, sf_dir, "events")).where("event_type = 'click'").select("user_id", "event_id", "ts", "value")
    # A last click of nobody, days later, moves the watermark behind all that was before it.
    beyond = clicks.agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("long").alias("user_id"), F.lit(-1).cast("long").alias("event_id"),
        (F.col("ts") + F.expr("interval 30 days")).alias("ts"), F.lit(1.0).alias("value"))
    landed = in_event_order(session, clicks.union(beyond), f"{folder}/landing", "ts")
    key = [F.col("user_id"), F.lit(1).alias("workout_id"), F.col("event_id").alias("session_id")]
    end = lasting(F.col("ts"), F.col("value"), 600_000)
    starts = watermarked(landed.select(*key, F.col("ts").alias("start_time")), "start_time")
    stops = watermarked(landed.select(*key, end.alias("end_time")), "end_time")
    minute = F.explode(F.array(F.lit(0), F.lit(7), F.lit(20)))
    readings = landed.withColumn("minute", minute).select(
        (F.col("user_id") * 7).alias("device_id"), F.timestamp_micros(F.unix_micros("ts") + F.col("minute") * 60_000_000).alias("time"),
        F.round(F.col("value") + F.col("minute"), 4).alias("heartrate"))
    users = users_of(table(session, sf_dir, "customer"))
    stats = finished_session_stats(starts, stops, users, watermarked(readings, "time"))
    complete([append_to_path(stats, f"{folder}/rows", Job("sessions", f"{folder}/checkpoint"))])
    return plain_times(rounded(spark.read.parquet(f"{folder}/rows"), "avg_bpm", places=8))


@query("SELECT event_id, user_id, user_id * 7 AS device_id FROM events JOIN customer ON user_id = c_custkey")
def bucketed_devices_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their user's device, from a dimension that lies in buckets of the join's key."""
    session, folder = streaming_session(spark), run_folder(spark, "bucketed_devices_stream")
    database = "dimensions_" + folder[-8:]
    current = session.catalog.currentDatabase()
    ensure_database(session, database, f"{folder}/database")
    session.catalog.setCurrentDatabase(current)
    width = int(session.conf.get("spark.sql.shuffle.partitions"))
    save_bucketed(users_of(table(session, sf_dir, "customer")), f"{database}.users", ["user_id"], width)
    rows = in_batches(session, table(session, sf_dir, "events").select("event_id", "user_id"), f"{folder}/landing")
    joined = rows.join(session.table(f"{database}.users"), "user_id").select("event_id", "user_id", "device_id")
    complete([append_to_path(joined, f"{folder}/rows", Job("devices", f"{folder}/checkpoint"))])
    return spark.read.parquet(f"{folder}/rows")


@query("""
    SELECT event_type AS topic, count(*) FILTER (event_type <> 'error') AS good, count(*) FILTER (event_type = 'error') AS bad,
           sum(CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) END)::BIGINT AS total_k,
           max(CASE WHEN event_type = 'error' THEN left(props, 5) END) AS last_bad
    FROM events GROUP BY event_type
""")
def dead_letters_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which one topic's payloads are cut short: one scan stores good and bad rows beside each other."""
    session, folder = streaming_session(spark), run_folder(spark, "dead_letters_stream")
    cut = F.when(F.col("event_type") == "error", F.substring("props", 1, 5)).otherwise(F.col("props"))
    source = in_batches(session, table(session, sf_dir, "events"), f"{folder}/landing")
    decoded = decoded_or_not(source.select(F.col("event_type").alias("topic"), cut.alias("value")), "k bigint")
    split = decoded.withColumn("is_bad", F.col("malformed").isNotNull())
    complete([append_to_path(split, f"{folder}/rows", Job("letters", f"{folder}/checkpoint"), partition_by=["is_bad"])])
    stored = spark.read.parquet(f"{folder}/rows").drop("is_bad")
    good = good_rows(stored).groupBy("topic").agg(F.count("*").alias("good"), F.sum("value.k").alias("total_k"))
    bad = bad_rows(stored).groupBy("topic").agg(F.count("*").alias("bad"), F.max("malformed").alias("last_bad"))
    none = F.lit(0).cast("long")
    return good.join(bad, "topic", "full").select(
        "topic", F.coalesce("good", none).alias("good"), F.coalesce("bad", none).alias("bad"), "total_k", "last_bad")


@query("SELECT DISTINCT user_id, ts FROM events")
def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event three times over, reduced to one."""
    session, folder = streaming_session(spark), run_folder(spark, "dedup_stream")
    loads = in_event_order(session, table(session, sf_dir, "events"), f"{folder}/landing", "ts")
    tripled = events(loads).select(
        "user_id", "ts", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("copy")).drop("copy")
    distinct = without_duplicates(tripled, ["user_id", "ts"], "ts", spread=8)
    complete([append_to_path(distinct, f"{folder}/rows", Job("dedup", f"{folder}/checkpoint"))])
    return plain_times(spark.read.parquet(f"{folder}/rows"))


@query(INTERVAL_SQL)
def interval_pairs_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, folder = streaming_session(spark), run_folder(spark, "interval_pairs_stream")

    landed = in_event_order(session, table(session, sf_dir, "events"), f"{folder}/landing", "ts")

    def side() -> DataFrame:
        return events(landed)

    starts = watermarked(click_starts(side()), "start_time")
    ends = watermarked(purchase_ends(side()), "end_time")
    pairs = interval_join(starts, ends, ["user_id"])
    complete([append_to_path(pairs, f"{folder}/rows", Job("interval", f"{folder}/checkpoint"))])
    return plain_times(spark.read.parquet(f"{folder}/rows"))


@query(CONTAINMENT_SQL)
def contained_points_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, folder = streaming_session(spark), run_folder(spark, "contained_points_stream")
    users = users_of(table(session, sf_dir, "customer"))

    landed = in_event_order(session, table(session, sf_dir, "events"), f"{folder}/landing", "ts")

    def side() -> DataFrame:
        return events(landed)

    spans = watermarked(with_device(signup_spans(side()), users), "end_time")
    points = watermarked(other_points(side()), "time")
    matched = containment_join(points, spans, ["device_id"]).select(*CONTAINED)
    complete([append_to_path(matched, f"{folder}/rows", Job("contained", f"{folder}/checkpoint"))])
    return plain_times(spark.read.parquet(f"{folder}/rows"))


@query(f"""
    WITH stats AS ({STATS_SQL})
    SELECT * FROM stats WHERE end_time <= (SELECT max(end_time) FROM stats) - INTERVAL 30 SECOND
""")
def session_stats_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups are emitted once the watermark has passed them; the newest are still open."""
    session, folder = streaming_session(spark), run_folder(spark, "session_stats_stream")
    landed = in_event_order(session, table(session, sf_dir, "events"), f"{folder}/landing", "ts")
    readings = watermarked(session_readings(events(landed)), "end_time")
    stats = reading_stats(readings, ["user_id", "workout_id", "session_id", "end_time"])
    complete([append_to_path(stats, f"{folder}/rows", Job("stats", f"{folder}/checkpoint"))])
    return plain_times(rounded(spark.read.parquet(f"{folder}/rows"), "avg_bpm", places=8))


@query("""
    SELECT c_custkey AS user_id, c_custkey * 7 AS device_id, 'mac' || c_custkey AS mac_address,
           CAST(c_acctbal AS DOUBLE) AS registration_timestamp, true AS has_lineage
    FROM customer
""")
def landed_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with a header line, one file per trigger at least, with lineage."""
    session, folder = streaming_session(spark), run_folder(spark, "landed_registrations")
    users = users_of(table(session, sf_dir, "customer"), F.col("c_acctbal").alias("registration_timestamp"))
    users.repartition(4).write.option("header", True).csv(f"{folder}/landing")
    return _ingested(spark, session, folder, stream_csv(session, f"{folder}/landing", REGISTERED_USER, bytes_per_trigger=_half(session, f"{folder}/landing")))


@query("""
    SELECT 'mac' || user_id AS mac_address, user_id % 7 AS gym, CAST(floor(epoch(ts)) AS DOUBLE) AS login,
           CAST(floor(epoch(ts)) + 60 AS DOUBLE) AS logout, true AS has_lineage
    FROM events WHERE event_type = 'signup'
""")
def landed_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, folder = streaming_session(spark), run_folder(spark, "landed_logins")
    at = F.unix_seconds(F.col("ts").cast("timestamp")).cast("double")
    logins = table(session, sf_dir, "events").where("event_type = 'signup'").select(
        F.concat(F.lit("mac"), F.col("user_id").cast("string")).alias("mac_address"),
        (F.col("user_id") % 7).alias("gym"), at.alias("login"), (at + 60).alias("logout"))
    logins.repartition(4).write.option("header", True).csv(f"{folder}/landing")
    return _ingested(spark, session, folder, stream_csv(session, f"{folder}/landing", GYM_LOGIN, bytes_per_trigger=_half(session, f"{folder}/landing")))


def envelopes(df: DataFrame) -> DataFrame:
    """Events as message envelopes whose payload is the event itself."""
    return df.select(
        F.col("event_id").cast("string").alias("key"), F.col("props").alias("value"),
        F.col("event_type").alias("topic"), F.col("user_id").alias("partition"),
        F.col("event_id").alias("offset"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"))


ENVELOPE_SQL = """
    SELECT CAST(event_id AS VARCHAR) AS key, props AS value, event_type AS topic, user_id AS partition,
           event_id AS "offset", CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, true AS has_lineage
    FROM events
"""


@query(ENVELOPE_SQL)
def landed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, folder = streaming_session(spark), run_folder(spark, "landed_messages")
    envelopes(table(session, sf_dir, "events")).repartition(4).write.json(f"{folder}/landing")
    return _ingested(spark, session, folder, stream_json(session, f"{folder}/landing", MESSAGE, 2))


@query("""
    SELECT CAST(event_id AS VARCHAR) AS key, event_type AS topic, event_id AS "offset", ts AS load_time
    FROM events WHERE ts >= (SELECT date_trunc('day', min(ts)) + INTERVAL 36 HOUR FROM events)
""")
def loaded_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table of many load days as a stream that starts at noon of the second, without opening the first."""
    session, folder = streaming_session(spark), run_folder(spark, "loaded_since")
    source = events(table(session, sf_dir, "events"))
    stored = source.select(
        F.col("event_id").cast("string").alias("key"), F.col("props").alias("value"), F.col("user_id").alias("partition"),
        F.col("event_id").alias("offset"), F.unix_seconds("ts").alias("timestamp"), F.col("ts").alias("load_time"),
        F.lit("file").alias("source_file"), F.to_date("ts").alias("date"), F.col("event_type").alias("topic"),
        F.lit("weekday").alias("week_part"))
    with_load_day(stored).write.partitionBy("load_day", "topic", "week_part").parquet(f"{folder}/bronze")
    start = source.agg((F.date_trunc("day", F.min("ts")) + F.expr("interval 36 hours")).cast("string")).first()[0]
    rows = stream_loaded(session, f"{folder}/bronze", STORED_MESSAGE, start).select("key", "topic", "offset", "load_time")
    complete([append_to_path(rows, f"{folder}/rows", Job("since", f"{folder}/checkpoint"))])
    return plain_times(spark.read.parquet(f"{folder}/rows"))


def _half(session: SparkSession, folder: str) -> int:
    """Half the bytes of a landing folder, so that it takes at least two micro-batches."""
    return sum(SharedFs(session, folder).sizes(folder)) // 2 + 1


def _ingested(spark: SparkSession, session: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """Run a landing stream to its end; lineage differs per run, so only its presence is told."""
    await_all([append_to_path(rows, f"{folder}/bronze", Job("landing", f"{folder}/checkpoint"))])
    known = F.col("load_time").isNotNull() & F.col("source_file").contains(folder.rsplit("/", 1)[-1])
    stored = spark.read.parquet(f"{folder}/bronze")
    return stored.withColumn("has_lineage", known).drop("load_time", "source_file")


@query(ENVELOPE_SQL.replace(", true AS has_lineage", ""))
def archived_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files move to an archive once read; every row arrives all the same."""
    session, folder = streaming_session(spark), run_folder(spark, "archived_source")
    landing = envelopes(table(session, sf_dir, "events")).withColumn("kind", F.col("topic"))
    landing.write.partitionBy("kind").json(f"{folder}/landing")
    files = len(session.read.schema(MESSAGE).json(f"{folder}/landing").inputFiles())
    rows = stream_files(
        session, "json", f"{folder}/landing/*", MESSAGE, files_per_trigger=-(-files // 2),
        clean_source="archive", archive_to=f"{folder}/archive")
    await_all([append_to_path(rows, f"{folder}/rows", Job("archive", f"{folder}/checkpoint"))])
    return spark.read.parquet(f"{folder}/rows")
