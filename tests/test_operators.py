"""Operators on small inline inputs, against results worked out by hand or by brute force."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.aggregates import reading_stats, reward_points, split_by_type, trade_totals
from strata.operators.joins import (
    between_join, containment_join, interval_join, presence_report, profile_bins, with_bins,
    with_week_part,
)
from strata.operators.latest import latest_changes, latest_per_key
from strata.operators.messages import (
    actions, decode_log, encode_log, flag_valid, heart_rates, of_topic, profile_changes, valid_only, workout_events,
)
from strata.operators.nested import explode_structs, expand, line_items
from strata.operators.text import word_count
from strata.plans.trades import trade_summary
from strata.schemas import INVOICE

from .conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


# -- words ------------------------------------------------------------------------------


def test_word_count(spark):
    lines = spark.createDataFrame([("The the  cat",), ("a 1 42 Cat\n",), (None,), ("",)], "value string")
    assert rows(word_count(lines)) == [("a", 1), ("cat", 1), ("cat\n", 1), ("the", 2)]


# -- nested records ---------------------------------------------------------------------


def invoice(number, items, address=True):
    return {"InvoiceNumber": number, "StoreID": "S", "DeliveryAddress": {"City": "C", "PinCode": "007"} if address
            else None, "InvoiceLineItems": items}


def item(code, qty):
    return {"ItemCode": code, "ItemDescription": "d", "ItemPrice": 2.0, "ItemQty": qty, "TotalValue": 2.0 * qty}


def test_line_items_drop_invoices_without_items(spark):
    df = spark.createDataFrame([
        invoice("1", [item("a", 1), item("b", 2)]), invoice("2", []), invoice("3", None),
        invoice("4", [item("c", 3)], address=False), invoice("5", [None])], INVOICE)
    got = line_items(df)
    assert got.columns == [
        "InvoiceNumber", "CreatedTime", "StoreID", "PosID", "CustomerType", "PaymentMethod", "DeliveryType", "City",
        "PinCode", "State", "ItemCode", "ItemDescription", "ItemPrice", "ItemQty", "TotalValue"]
    assert rows(got.select("InvoiceNumber", "City", "PinCode", "ItemCode", "TotalValue")) == [
        ("1", "C", "007", "a", 2.0), ("1", "C", "007", "b", 4.0), ("4", None, None, "c", 6.0),
        ("5", "C", "007", None, None)]


def test_line_items_read_only_the_fields_they_need(spark, folder):
    spark.createDataFrame([invoice("1", [item("a", 1)])], INVOICE).write.parquet(folder)
    text = plan(line_items(spark.read.parquet(folder)))
    scanned = text[text.index("ReadSchema"):]
    assert "City" in scanned and "ContactNumber" not in scanned and "CashierID" not in scanned


def test_explode_and_expand(spark):
    df = spark.createDataFrame([(1, [(1, "x"), (2, "y")])], "id int, a array<struct<n: int, s: string>>")
    assert rows(explode_structs(df, "a", ["id"])) == [(1, 1, "x"), (1, 2, "y")]
    assert expand(df.select(F.struct("id").alias("v")), "v").columns == ["id"]


# -- messages ---------------------------------------------------------------------------


def test_log_round_trip(spark):
    df = spark.createDataFrame([(1, "S1"), (2, None)], "n int, store string")
    log = encode_log(df, "store").select(
        F.col("key").cast("binary"), F.col("value").cast("binary"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).alias("offset"), F.current_timestamp().alias("timestamp"))
    got = decode_log(log, "n int, store string").select("key", "value.*")
    assert rows(got) == rows(df.select(F.col("store").alias("key"), "n", "store"))


def test_topics_are_pruned_as_partitions(spark, folder):
    df = spark.createDataFrame([("{}", "bpm"), ("{}", "workout")], "value string, topic string")
    df.write.partitionBy("topic").parquet(folder)
    text = plan(of_topic(spark.read.parquet(folder), "bpm"))
    assert "PartitionFilters: [isnotnull(topic" in text and "(topic" in text.split("PartitionFilters")[1]


def test_payload_shapes(spark):
    df = spark.createDataFrame([
        ("user_info", '{"user_id": 1, "update_type": "new", "timestamp": 1.5, "dob": "02/29/2000", "gender": "F",'
                      ' "address": {"city": "X", "zip": "01234"}}'),
        ("workout", '{"user_id": 1, "workout_id": 2, "timestamp": 3.0, "action": "start", "session_id": 4}'),
        ("bpm", '{"device_id": 9, "time": "2024-01-01T00:00:00Z", "heartrate": 0.0}'),
        ("bpm", '{"device_id": 9, "time": "2024-01-01T00:00:01Z"}')], "topic string, value string")
    profile = profile_changes(df).first()
    assert (profile.dob, profile.city, profile.zip, profile.street_address) == (dt.date(2000, 2, 29), "X", "01234", None)
    assert rows(workout_events(df).select("user_id", F.unix_seconds("time"), "action")) == [(1, 3, "start")]
    assert rows(heart_rates(df).select("heartrate", "valid")) == [(0.0, False), (None, True)]


def test_validity(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.1,), (None,)], "heartrate double")
    assert rows(flag_valid(df)) == [(-1.0, False), (0.0, False), (0.1, True), (None, True)]
    assert rows(valid_only(flag_valid(df)).select("heartrate")) == [(0.1,), (None,)]


def test_actions(spark):
    df = spark.createDataFrame([(1, 1, at(0), "start", 1), (1, 1, at(5), "stop", 1)],
                               "user_id int, workout_id int, time timestamp, action string, session_id int")
    assert rows(actions(df, "stop", "end_time")) == [(1, 1, 1, at(5))]


# -- latest per key ---------------------------------------------------------------------


def test_latest_changes_keep_one_row_on_ties(spark):
    df = spark.createDataFrame([
        (1, 10, "b", "update"), (1, 10, "a", "update"), (1, 5, "z", "new"), (2, 1, "x", "new"), (2, 9, "y", "delete"),
        (3, None, "n", "new")], "id int, at int, v string, update_type string")
    assert rows(latest_changes(df, ["id"], "at")) == [(1, 10, "a"), (2, 1, "x"), (3, None, "n")]


def test_latest_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(latest_per_key(df, ["k"], "id"))
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[shuffle:] and "Partial" in text[shuffle:]


# -- aggregates -------------------------------------------------------------------------


def test_rewards(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 5.0), ("b", None), (None, 1.0)],
                               "CustomerCardNo string, TotalAmount double")
    assert rows(reward_points(df)) == [("a", 15.0, 3.0), ("b", None, None), (None, 1.0, 0.2)]


def test_trade_summary_from_messages(spark):
    message = '{"CreatedTime": "2024-01-01 00:%s", "Type": "%s", "Amount": %s, "BrokerCode": "B"}'
    df = spark.createDataFrame([
        (message % ("00:00", "BUY", 1.5),), (message % ("14:59", "SELL", 2.0),), (message % ("15:00", "BUY", 4.0),),
        (message % ("15:01", "HOLD", 9.0),), ("{broken",)], "value string")
    assert rows(trade_summary(df)) == [(at(0), at(900), 1.5, 2.0), (at(900), at(1800), 4.0, 0.0)]


def test_aggregates_combine_before_the_shuffle(spark):
    df = spark.createDataFrame([(at(0), "BUY", 1.0)], "CreatedTime timestamp, Type string, Amount double")
    for result in (trade_totals(split_by_type(df)), reward_points(df, "Type", "Amount")):
        text = plan(result)
        assert "partial_sum" in text[text.index("Exchange"):]


def test_reading_stats_skip_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (1, None), (2, None)], "k int, heartrate double")
    assert rows(reading_stats(df, ["k"])) == [(1, 2.0, 3.0, 4.0, 2), (2, None, None, None, 0)]


# -- joins ------------------------------------------------------------------------------


def test_week_part_keeps_messages_without_date(spark):
    messages = spark.createDataFrame([(1, 1_704_067_200), (2, 1_704_153_599), (3, 1_704_153_600)], "id int, timestamp long")
    dates = spark.createDataFrame([(dt.date(2024, 1, 1), "weekday", 1)], "date date, week_part string, week int")
    expected = [(1, 1_704_067_200, dt.date(2024, 1, 1), "weekday"), (2, 1_704_153_599, dt.date(2024, 1, 1), "weekday"),
                (3, 1_704_153_600, None, None)]
    assert rows(with_week_part(messages, dates)) == expected


def test_profile_bins_keep_profiles_without_user(spark):
    profiles = spark.createDataFrame([(1, dt.date(2000, 1, 1), "F", "c", "s"), (2, None, "M", "c", "s")],
                                     "user_id int, dob date, gender string, city string, state string")
    users = spark.createDataFrame([(1, 7.0)], "user_id int, registered double")
    got = profile_bins(profiles, users, F.lit("2024-01-01").cast("date"))
    assert rows(got) == [(1, "18-25", "F", "c", "s", 7.0), (2, "invalid age", "M", "c", "s", None)]


def test_stats_without_bin_are_dropped_or_kept(spark):
    stats = spark.createDataFrame([(1, 1, 1, 1.0, 1.0, 1.0, 1), (2, 1, 1, 1.0, 1.0, 1.0, 1)],
                                  "user_id int, workout_id int, session_id int, min_bpm double, avg_bpm double,"
                                  "max_bpm double, num_recordings int")
    bins = spark.createDataFrame([(1, "95+", "F", "c", "s")], "user_id int, age string, gender string, city string, state string")
    assert with_bins(stats, bins).count() == 1
    assert with_bins(stats, bins, "left").count() == 2


HOURS = 3600


def random_times(n, seed, span=40 * HOURS):
    rng = random.Random(seed)
    # Half of the rows share one key, and times fall on slot edges often.
    return [(i, 1 if rng.random() < 0.5 else rng.randint(2, 5),
             rng.randrange(span) // 1800 * 1800 - 10 * HOURS) for i in range(n)]


@pytest.mark.parametrize("spread", [True, False])
def test_interval_join_against_brute_force(spark, spread):
    starts, ends = random_times(60, 1), random_times(60, 2)
    expected = sorted((k, i, j) for (i, k, s), (j, m, e) in itertools.product(starts, ends)
                      if k == m and s <= e < s + 3 * HOURS)
    left = spark.createDataFrame([(k, i, at(s)) for i, k, s in starts], "k int, i int, start_time timestamp")
    right = spark.createDataFrame([(k, j, at(e)) for j, k, e in ends], "k int, j int, end_time timestamp")
    got = interval_join(left, right, ["k"], spread=spread).select("k", "i", "j")
    assert sorted(map(tuple, got.collect())) == expected


def test_interval_join_without_order_pairs_earlier_ends(spark):
    left = spark.createDataFrame([(1, at(100))], "k int, start_time timestamp")
    right = spark.createDataFrame([(1, at(-10**6)), (1, at(100 + 3 * HOURS)), (None, at(100))], "k int, end_time timestamp")
    assert interval_join(left, right, ["k"]).count() == 0
    assert rows(interval_join(left, right, ["k"], require_order=False).select("end_time")) == [(at(-10**6),)]


def test_containment_join_against_brute_force(spark):
    points, begins = random_times(80, 3), random_times(40, 4)
    rng = random.Random(5)
    spans = [(j, k, s, s + rng.randrange(12) * 1800) for j, k, s in begins]
    expected = sorted((k, i, j) for (i, k, t), (j, m, s, e) in itertools.product(points, spans)
                      if k == m and s < t <= e and e < t + 3 * HOURS)
    left = spark.createDataFrame([(k, i, at(t)) for i, k, t in points], "k int, i int, time timestamp")
    right = spark.createDataFrame([(k, j, at(s), at(e)) for j, k, s, e in spans],
                                  "k int, j int, start_time timestamp, end_time timestamp")
    got = containment_join(left, right, ["k"]).select("k", "i", "j")
    assert sorted(map(tuple, got.collect())) == expected


def test_between_join_against_brute_force(spark):
    points, begins = random_times(80, 6), random_times(60, 7)
    rng = random.Random(8)
    lengths = [-1800, 0, 1800, HOURS, 2 * HOURS, 8 * HOURS, 64 * HOURS, 10**9]
    spans = [(j, k, s, s + rng.choice(lengths)) for j, k, s in begins]
    expected = sorted((k, i, j) for (i, k, t), (j, m, s, e) in itertools.product(points, spans)
                      if k == m and s <= t <= e)
    left = spark.createDataFrame([(k, j, at(s), at(e)) for j, k, s, e in spans], "k int, j int, s timestamp, e timestamp")
    right = spark.createDataFrame([(k, i, at(t)) for i, k, t in points], "k int, i int, t timestamp")
    got = between_join(left, right, ["k"], "s", "e", "t").select("k", "i", "j")
    assert sorted(map(tuple, got.collect())) == expected
    assert between_join(left.where("false"), right, ["k"], "s", "e", "t").count() == 0


def test_presence_report(spark):
    logs = spark.createDataFrame([("m", 5, at(0), at(4500)), ("m", 6, at(90_000), at(93_000))],
                                 "mac_address string, gym int, login timestamp, logout timestamp")
    done = spark.createDataFrame([(1, 1, 1, at(0), at(3900)), (1, 1, 2, at(4501), at(5000)), (9, 1, 1, at(0), at(9))],
                                 "user_id int, workout_id int, session_id int, start_time timestamp, end_time timestamp")
    users = spark.createDataFrame([(1, "m")], "user_id int, mac_address string")
    assert rows(presence_report(logs, done, users)) == [(dt.date(2024, 1, 1), 5, "m", 1, 1, 75.0, 65.0)]
