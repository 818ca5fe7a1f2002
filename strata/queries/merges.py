"""Merges of several loads into keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.latest import latest_per_key
from strata.plans.invoices import (
    CONTENT_KEY, POSITION_KEY, ingest_messages, message_table, rewards_additive, rewards_complete,
    rewards_replace, rewards_table,
)
from strata.plans.workouts import LATER_LOGOUT, NEWER_PROFILE
from strata.queries.batch import REWARDS_SQL, invoices_from_orders, log_of
from strata.queries.registry import (
    events, in_batches, plain_times, query, rounded, run_folder, streaming_session, table, text,
)
from strata.schemas import TABLES
from strata.sinks.staged import SET_ALL, InsertTable, SnapshotTable, StateTable
from strata.streaming.jobs import Job, append_to_path, await_all

QUARTERS = [1, 2, 3, 4]
ORDER_ROW = "o_custkey bigint, o_orderkey bigint, o_orderdate timestamp, o_totalprice double"


def _loads(spark: SparkSession, sf_dir: str) -> list[tuple[int, DataFrame]]:
    """The orders as four loads, one for each quarter of the year they were placed in."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return [(q, orders.where(F.quarter("o_orderdate") == q)) for q in QUARTERS]


BY_DATE: list[str | Column] = ["o_orderdate", "o_orderkey"]


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey ORDER BY quarter(o_orderdate), o_orderdate, o_orderkey) AS n FROM orders)
    WHERE n = 1
""")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's first order of the earliest load that has one."""
    first = InsertTable(spark, run_folder(spark, "merge_insert_only"), ORDER_ROW, ["o_custkey"])
    for quarter, load in _loads(spark, sf_dir):
        first.insert_new(load, "loader", quarter, BY_DATE)
    return plain_times(first.read())


@query("SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders")
def merge_insert_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders by their own key and date, every load delivered twice under a new batch number."""
    seen = InsertTable(
        spark, run_folder(spark, "merge_insert_replayed"), ORDER_ROW, ["o_orderkey", "o_orderdate"])
    for quarter, load in _loads(spark, sf_dir):
        seen.insert_new(load, "loader", quarter, ["o_custkey"], range_column="o_orderdate")
        seen.insert_new(load, "loader", quarter + 4, ["o_custkey"], range_column="o_orderdate")
    return plain_times(seen.read())


def _latest_order(spark: SparkSession, sf_dir: str, folder: str) -> StateTable:
    newest = StateTable(spark, folder, ORDER_ROW, ["o_custkey"])
    for quarter, load in _loads(spark, sf_dir):
        newest.merge(
            latest_per_key(load, ["o_custkey"], "o_orderdate", ["o_orderkey"]), "loader", quarter, [(None, SET_ALL)])
    return newest


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey ORDER BY quarter(o_orderdate) DESC, o_orderdate DESC, o_orderkey) AS n FROM orders)
    WHERE n = 1
""")
def merge_update_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's latest order of the last load that has one."""
    return plain_times(_latest_order(spark, sf_dir, run_folder(spark, "merge_update_all")).read())


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey, quarter(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders)
    WHERE n = 1 AND quarter(o_orderdate) > 1
""")
def changes_of_updated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the loads after the first inserted or updated, as a stream of the merged table."""
    session, folder = streaming_session(spark), run_folder(spark, "changes_of_updated_table")
    table_ = _latest_order(session, sf_dir, f"{folder}/table")
    job = Job("changes", f"{folder}/checkpoint")
    await_all([append_to_path(table_.stream(starting_batch=QUARTERS[1]), f"{folder}/rows", job)])
    return plain_times(spark.read.parquet(f"{folder}/rows"))


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey ORDER BY quarter(o_orderdate), o_orderdate, o_orderkey) AS n FROM orders)
    WHERE n = 1 AND quarter(o_orderdate) >= 2
""")
def changes_from_a_batch_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insert-only table as a stream that starts at the second load."""
    session, folder = streaming_session(spark), run_folder(spark, "changes_from_a_batch_on")
    first = InsertTable(session, f"{folder}/table", ORDER_ROW, ["o_custkey"])
    for quarter, load in _loads(session, sf_dir):
        first.insert_new(load, "loader", quarter, BY_DATE)
    job = Job("inserts", f"{folder}/checkpoint")
    await_all([append_to_path(first.stream(starting_batch=2), f"{folder}/rows", job)])
    return plain_times(spark.read.parquet(f"{folder}/rows"))


@query("""
    SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS dob, left(o_orderpriority, 1) AS sex, o_orderstatus AS gender,
           'F' || o_orderkey AS first_name, o_orderpriority AS last_name, o_orderkey || ' Street' AS street_address,
           CASE WHEN o_orderkey % 3 > 0 THEN 'City' || (o_orderkey % 7) END AS city, 'State' || (o_orderkey % 5) AS state,
           '0' || o_orderkey AS zip, o_orderdate AS updated FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, quarter(o_orderdate) DESC, o_orderpriority, o_orderkey) AS n FROM orders)
    WHERE n = 1
""")
def merge_if_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads arrive last quarter first, so only newer rows may replace stored ones."""
    profile = StateTable(spark, run_folder(spark, "merge_if_newer"), TABLES["user_profile"], ["user_id"])
    for i, (_, load) in enumerate(reversed(_loads(spark, sf_dir))):
        newest = latest_per_key(load, ["o_custkey"], "o_orderdate", ["o_orderpriority", "o_orderkey"])
        key = F.col("o_orderkey")
        rows = newest.select(
            F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("dob"), F.substring("o_orderpriority", 1, 1).alias("sex"),
            F.col("o_orderstatus").alias("gender"), F.concat(F.lit("F"), text(key)).alias("first_name"),
            F.col("o_orderpriority").alias("last_name"), F.concat(text(key), F.lit(" Street")).alias("street_address"),
            F.when(key % 3 > 0, F.concat(F.lit("City"), text(key % 7))).alias("city"),
            F.concat(F.lit("State"), text(key % 5)).alias("state"), F.concat(F.lit("0"), text(key)).alias("zip"),
            F.col("o_orderdate").alias("updated"))
        profile.merge(rows, "loader", i, NEWER_PROFILE)
    return plain_times(profile.read())


@query("""
    SELECT 'mac' || o_custkey AS mac_address, length(o_orderpriority) AS gym,
           date_trunc('year', o_orderdate) AS login, max(o_orderdate + INTERVAL 1 DAY) AS logout
    FROM orders GROUP BY ALL
""")
def merge_later_logout(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = StateTable(
        spark, run_folder(spark, "merge_later_logout"), TABLES["gym_logs"], ["mac_address", "gym", "login"])
    for i, (_, load) in enumerate(reversed(_loads(spark, sf_dir))):
        rows = load.groupBy(
            F.concat(F.lit("mac"), F.col("o_custkey").cast("string")).alias("mac_address"),
            F.length("o_orderpriority").cast("long").alias("gym"),
            F.date_trunc("year", "o_orderdate").alias("login"),
        ).agg(F.max(F.col("o_orderdate") + F.expr("interval 1 day")).alias("logout"))
        visits.merge(rows, "loader", i, LATER_LOGOUT, range_column="login")
    return plain_times(visits.read())


def _reward_stream(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, str]:
    session, folder = streaming_session(spark), run_folder(spark, name)
    orders = in_batches(session, table(session, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderkey"),
                        f"{folder}/landing")
    return invoices_from_orders(orders), folder


@query(REWARDS_SQL)
def rewards_complete_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices, folder = _reward_stream(spark, sf_dir, "rewards_complete")
    totals = SnapshotTable(spark, f"{folder}/table", TABLES["customer_rewards"])
    await_all([rewards_complete(invoices, totals, Job("rewards", f"{folder}/checkpoint"))])
    return rounded(totals.read(), "TotalAmount", "TotalPoints")


@query(REWARDS_SQL)
def rewards_replace_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices, folder = _reward_stream(spark, sf_dir, "rewards_replace")
    totals = rewards_table(spark, f"{folder}/table")
    await_all([rewards_replace(invoices, totals, Job("rewards", f"{folder}/checkpoint"))])
    return rounded(totals.read(), "TotalAmount", "TotalPoints")


@query(REWARDS_SQL)
def rewards_additive_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices, folder = _reward_stream(spark, sf_dir, "rewards_additive")
    totals = rewards_table(spark, f"{folder}/table")
    await_all([rewards_additive(invoices, totals, Job("rewards", f"{folder}/checkpoint"))])
    return rounded(totals.read(), "TotalAmount", "TotalPoints")


MESSAGES_SQL = """
    SELECT CAST(event_id AS VARCHAR) AS key, event_type AS topic, CAST(0 AS BIGINT) AS partition,
           event_id AS "offset", TIMESTAMP '2024-01-01' AS timestamp,
           '{"event_id":' || event_id || ',"micros":' || epoch_us(ts) || ',"user_id":' || user_id || ',"value":' || value
               || ',"props":' || to_json(props) || '}' AS value
    FROM events
"""


def _twice_delivered(spark: SparkSession, sf_dir: str, name: str, key: list[str]) -> DataFrame:
    """A log whose records come twice, within and across loads, into a table that keeps each once."""
    session, folder = streaming_session(spark), run_folder(spark, name)
    log = log_of(events(table(session, sf_dir, "events")))
    twice = log.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    stored = message_table(spark, f"{folder}/table", key)
    source = in_batches(session, twice, f"{folder}/landing", loads=2).drop("delivery")
    await_all([ingest_messages(source, stored, Job("ingest", f"{folder}/checkpoint"))])
    return plain_times(stored.read())


@query(MESSAGES_SQL)
def ingest_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _twice_delivered(spark, sf_dir, "ingest_by_position", POSITION_KEY)


@query(MESSAGES_SQL)
def ingest_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _twice_delivered(spark, sf_dir, "ingest_by_content", CONTENT_KEY)
