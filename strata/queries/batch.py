"""Static operators over the standard tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.messages import decode_json
from strata.functions.temporal import (
    age_band, age_in_years, epoch_to_timestamp, minutes_between, parse_date, parse_timestamp,
)
from strata.functions.text import split_records
from strata.operators.aggregates import reading_stats, reward_points, split_by_type, trade_totals
from strata.operators.joins import (
    containment_join, interval_join, presence_report, profile_bins, ranked_report, user_bins, with_bins, with_device, with_week_part,
)
from strata.operators.latest import latest_changes
from strata.operators.messages import decode_log, encode_log, flag_valid, of_topic, valid_only, where
from strata.operators.nested import expand, line_items
from strata.operators.text import clean_words, word_count, words_of
from strata.queries.registry import events, plain_times, query, rounded, run_folder, table, text

AS_OF = "2024-06-15"

WORD_COUNT_SQL = """
    SELECT word, count(*) AS count
    FROM (
        SELECT lower(trim(piece)) AS word
        FROM (SELECT unnest(string_split(record, ' ')) AS piece
              FROM (SELECT unnest(string_split(text, '.')) AS record FROM documents)))
    WHERE word IS NOT NULL AND regexp_matches(word, '[a-z]')
    GROUP BY word
"""


def records(documents: DataFrame) -> DataFrame:
    """The documents as a reader with '.' for line separator sees them."""
    return documents.select(F.explode(split_records(F.col("text"), ".")).alias("value"))


@query(WORD_COUNT_SQL)
def word_count_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(records(table(spark, sf_dir, "documents")))


@query("""
    SELECT lang, word, count(*) AS n
    FROM (
        SELECT lang, lower(trim(piece)) AS word
        FROM (SELECT lang, unnest(string_split(text, ' ')) AS piece FROM documents))
    WHERE regexp_matches(word, '[a-z]')
    GROUP BY lang, word
""")
def clean_words_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = words_of(table(spark, sf_dir, "documents"), "text", with_columns=["lang"])
    return clean_words(words).groupBy("lang", "word").agg(F.count("*").alias("n"))


TRADE_WINDOW_SQL = """
    SELECT b AS start, b + INTERVAL 15 MINUTE AS "end",
           round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 4) AS TotalBuy,
           round(sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END), 4) AS TotalSell
    FROM (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS b, event_type, value FROM events)
    GROUP BY b
"""


@query(TRADE_WINDOW_SQL)
def trade_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = split_by_type(events(table(spark, sf_dir, "events")), "event_type", "value", "purchase", "click")
    return plain_times(rounded(trade_totals(trades, "ts"), "TotalBuy", "TotalSell"))


INVOICE_SQL = """
    WITH header AS (
        SELECT CAST(l_orderkey AS VARCHAR) AS InvoiceNumber, epoch_ms(l_shipdate) AS CreatedTime,
               'STR' || l_suppkey AS StoreID, 'POS' || l_linenumber AS PosID, l_linestatus AS CustomerType,
               'CARD' AS PaymentMethod,
               CASE WHEN l_returnflag = 'R' THEN 'TAKEAWAY' ELSE 'HOME-DELIVERY' END AS DeliveryType,
               'City' || (l_suppkey + 1) AS City, '0' || l_suppkey AS PinCode, 'State' || l_linenumber AS State,
               *
        FROM lineitem)
    SELECT InvoiceNumber, CreatedTime, StoreID, PosID, CustomerType, PaymentMethod, DeliveryType,
           City, PinCode, State, 'P' || l_partkey AS ItemCode, 'goods' AS ItemDescription,
           l_extendedprice AS ItemPrice, CAST(l_quantity AS BIGINT) AS ItemQty,
           round(l_extendedprice * l_quantity, 4) AS TotalValue
    FROM header WHERE l_returnflag <> 'R' AND l_discount > 0
    UNION ALL
    SELECT InvoiceNumber, CreatedTime, StoreID, PosID, CustomerType, PaymentMethod, DeliveryType,
           City, PinCode, State, 'T' || l_partkey, 'tax', l_tax, 1, l_tax
    FROM header WHERE l_returnflag <> 'R' AND l_discount > 0 AND l_tax > 0
"""


def invoices_of(lineitem: DataFrame) -> DataFrame:
    """Line items as nested invoices: with goods and tax, goods only, no items, or no item list."""
    goods = F.struct(
        F.concat(F.lit("P"), text("l_partkey")).alias("ItemCode"), F.lit("goods").alias("ItemDescription"),
        F.col("l_extendedprice").alias("ItemPrice"), F.col("l_quantity").cast("long").alias("ItemQty"),
        F.round(F.col("l_extendedprice") * F.col("l_quantity"), 4).alias("TotalValue"))
    tax = F.struct(
        F.concat(F.lit("T"), text("l_partkey")).alias("ItemCode"), F.lit("tax").alias("ItemDescription"),
        F.col("l_tax").alias("ItemPrice"), F.lit(1).cast("long").alias("ItemQty"),
        F.col("l_tax").alias("TotalValue"))
    items = (
        F.when(F.col("l_returnflag") == "R", F.lit(None))
        .when(F.col("l_discount") <= 0, F.filter(F.array(goods), lambda _: F.lit(False)))
        .when(F.col("l_tax") <= 0, F.array(goods)).otherwise(F.array(goods, tax)))
    supplier, line = text("l_suppkey"), text("l_linenumber")
    return lineitem.select(
        text("l_orderkey").alias("InvoiceNumber"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("CreatedTime"),
        F.concat(F.lit("STR"), supplier).alias("StoreID"), F.concat(F.lit("POS"), line).alias("PosID"),
        F.lit("C1").alias("CashierID"), F.col("l_linestatus").alias("CustomerType"),
        text("l_partkey").alias("CustomerCardNo"), F.col("l_extendedprice").alias("TotalAmount"),
        F.lit(2).cast("long").alias("NumberOfItems"), F.lit("CARD").alias("PaymentMethod"),
        F.col("l_extendedprice").alias("TaxableAmount"), F.col("l_tax").alias("CGST"),
        F.col("l_tax").alias("SGST"), F.lit(0.0).alias("CESS"),
        F.when(F.col("l_returnflag") == "R", "TAKEAWAY").otherwise("HOME-DELIVERY").alias("DeliveryType"),
        F.struct(
            F.lit("Street 1").alias("AddressLine"),
            F.concat(F.lit("City"), text(F.col("l_suppkey") + 1)).alias("City"),
            F.lit("0").alias("ContactNumber"), F.concat(F.lit("0"), supplier).alias("PinCode"),
            F.concat(F.lit("State"), line).alias("State")).alias("DeliveryAddress"),
        items.alias("InvoiceLineItems"))


@query(INVOICE_SQL)
def invoice_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_items(invoices_of(table(spark, sf_dir, "lineitem")))


def log_of(df: DataFrame) -> DataFrame:
    """Events as records of a message log: bytes for key and value, one topic per event type."""
    body = df.select(
        "event_type", "event_id", F.struct(
            "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"), "user_id", "value",
            "props").alias("body"))
    return body.select(
        text("event_id").cast("binary").alias("key"), F.to_json("body").cast("binary").alias("value"),
        F.col("event_type").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"))


PAYLOAD = "event_id bigint, micros bigint, user_id bigint, value double, props string"


@query("""
    SELECT CAST(event_id AS VARCHAR) AS key, event_id, ts, user_id, value,
           CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
    FROM events WHERE event_type = 'purchase'
""")
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchases = of_topic(log_of(table(spark, sf_dir, "events")), "purchase")
    decoded = decode_log(purchases, PAYLOAD).select("key", "value.*")
    with_k = decoded.withColumn("k", decode_json(F.col("props"), "k bigint")["k"])
    return plain_times(with_k.select(
        "key", "event_id", F.timestamp_micros("micros").alias("ts"), "user_id", "value", "k"))


@query("""
    SELECT o_orderpriority AS key, o_orderkey, o_custkey, o_totalprice
    FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def envelope_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen orders as keyed JSON messages, and back."""
    urgent = where(table(spark, sf_dir, "orders"), "o_orderpriority = '1-URGENT'")
    sent = encode_log(urgent.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), "o_orderpriority")
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double"
    return expand(sent.select(F.struct("key", decode_json(F.col("value"), schema).alias("v")).alias("m")), "m").select(
        "key", "v.*")


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def parameter_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return where(table(spark, sf_dir, "orders"), "o_orderstatus == 'F' AND o_totalprice > 100000")


def date_lookup_of(days: DataFrame) -> DataFrame:
    """Calendar rows for a column of dates; the part of the week is this library's own choice."""
    d = F.col("date")
    part = F.when(F.dayofweek(d).isin(1, 7), "weekend").otherwise("weekday")
    return days.select(
        "date", F.weekofyear(d).alias("week"), F.year(d).alias("year"), F.month(d).alias("month"),
        F.dayofweek(d).alias("dayofweek"), F.dayofmonth(d).alias("dayofmonth"),
        F.dayofyear(d).alias("dayofyear"), part.alias("week_part"))


@query("""
    SELECT event_id, CASE WHEN dayofweek(ts) <> 3 THEN CAST(ts AS DATE) END AS date,
           CASE WHEN dayofweek(ts) = 3 THEN NULL WHEN dayofweek(ts) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS week_part
    FROM events WHERE event_type = 'view'
""")
def week_part_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with their part of the week, stored by topic and part, read back for one topic."""
    source = table(spark, sf_dir, "events")
    days = source.select(F.to_date("ts").alias("date")).distinct().where(F.dayofweek("date") != 4)
    messages = source.select(
        "event_id", F.col("event_type").alias("topic"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"))
    folder = run_folder(spark, "week_part")
    date_lookup_of(days).write.parquet(f"{folder}/dates")  # made once; its real size then decides about a broadcast
    dated = with_week_part(messages, spark.read.parquet(f"{folder}/dates"))
    dated.write.partitionBy("topic", "week_part").parquet(f"{folder}/messages")
    return of_topic(spark.read.parquet(f"{folder}/messages"), "view").select("event_id", "date", "week_part")


@query("""
    SELECT event_id, heartrate, CASE WHEN heartrate <= 0 THEN false ELSE true END AS valid
    FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN round(value - 20, 4) END AS heartrate FROM events)
""")
def heart_rate_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_valid(heart_rates_of(table(spark, sf_dir, "events")).select("event_id", "heartrate"))


def heart_rates_of(df: DataFrame) -> DataFrame:
    rate = F.when(F.col("event_type") != "error", F.round(F.col("value") - 20, 4))
    return df.withColumn("heartrate", rate)


@query("""
    SELECT user_id, ts AS updated, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id, value) AS n
        FROM events WHERE event_type IN ('signup', 'purchase')) WHERE n = 1
""")
def latest_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "new").when(F.col("event_type") == "purchase", "update")
    changes = events(table(spark, sf_dir, "events")).select(
        "user_id", F.col("ts").alias("updated"), "event_id", "value",
        kind.otherwise("delete").alias("update_type"))
    return plain_times(latest_changes(changes, ["user_id"], "updated"))


def profiles_of(customer: DataFrame) -> DataFrame:
    """Customers with birth dates between 1905 and 2024, some of them unknown."""
    days = F.pmod(F.col("c_custkey") * 7919, F.lit(43_500)).cast("int")
    dob = F.when(F.col("c_mktsegment") != "MACHINERY", F.date_add(F.lit("1905-05-20").cast("date"), days))
    return customer.select(
        F.col("c_custkey").alias("user_id"), dob.alias("dob"), F.col("c_mktsegment").alias("gender"),
        text("c_nationkey").alias("city"), F.right("c_name", F.lit(4)).alias("state"))


PROFILES_SQL = """
    SELECT c_custkey AS user_id, c_mktsegment AS gender, CAST(c_nationkey AS VARCHAR) AS city,
           right(c_name, 4) AS state,
           CASE WHEN c_mktsegment <> 'MACHINERY'
                THEN DATE '1905-05-20' + CAST((c_custkey * 7919) % 43500 AS INTEGER) END AS dob
    FROM customer
"""
BINS_SQL = f"""
    SELECT user_id, CASE WHEN age IS NULL THEN 'invalid age' WHEN age < 18 THEN 'under 18'
                WHEN age < 25 THEN '18-25' WHEN age < 35 THEN '25-35' WHEN age < 45 THEN '35-45'
                WHEN age < 55 THEN '45-55' WHEN age < 65 THEN '55-65' WHEN age < 75 THEN '65-75'
                WHEN age < 85 THEN '75-85' WHEN age < 95 THEN '85-95' ELSE '95+' END AS age, gender, city, state
    FROM (SELECT *, datesub('year', dob, DATE '{AS_OF}') AS age FROM ({PROFILES_SQL}))
"""


def as_of():
    return F.lit(AS_OF).cast("date")


def bins_of(customer: DataFrame) -> DataFrame:
    return user_bins(profiles_of(customer), as_of())


@query(f"""
    SELECT b.*, r.c_acctbal AS registered
    FROM ({BINS_SQL}) b LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) r ON b.user_id = r.c_custkey
""")
def age_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of all profiles, with or without a registration."""
    customer = table(spark, sf_dir, "customer")
    users = where(customer, "c_acctbal > 0").select(
        F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("registered"))
    return profile_bins(profiles_of(customer), users, as_of())


@query(f"""
    SELECT age, count(*) AS n FROM ({BINS_SQL}) GROUP BY age
""")
def age_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = profiles_of(table(spark, sf_dir, "customer"))
    return profiles.groupBy(age_band(age_in_years(F.col("dob"), as_of())).alias("age")).agg(F.count("*").alias("n"))


INTERVAL_SQL = """
    SELECT a.user_id, a.event_id AS start_id, a.ts AS start_time, b.event_id AS end_id, b.ts AS end_time
    FROM events a JOIN events b ON a.user_id = b.user_id
    WHERE a.event_type = 'click' AND b.event_type = 'purchase'
      AND b.ts >= a.ts AND b.ts < a.ts + INTERVAL 3 HOUR
"""


def click_starts(df: DataFrame) -> DataFrame:
    return where(df, "event_type = 'click'").select(
        "user_id", F.col("event_id").alias("start_id"), F.col("ts").alias("start_time"))


def purchase_ends(df: DataFrame) -> DataFrame:
    return where(df, "event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("end_id"), F.col("ts").alias("end_time"))


@query(INTERVAL_SQL)
def interval_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(table(spark, sf_dir, "events"))
    return plain_times(interval_join(click_starts(source), purchase_ends(source), ["user_id"]))


CONTAINMENT_SQL = """
    WITH users AS (SELECT c_custkey AS user_id, c_custkey * 7 AS device_id FROM customer),
    spans AS (
        SELECT u.user_id, u.device_id, 1 AS workout_id, e.event_id AS session_id, e.ts AS start_time,
               e.ts + to_microseconds(CAST(round(e.value * 100) AS BIGINT) * 600000) AS end_time
        FROM events e JOIN users u ON e.user_id = u.user_id WHERE e.event_type = 'signup')
    SELECT p.event_id, p.ts AS time, s.user_id, s.session_id, s.start_time, s.end_time
    FROM events p JOIN spans s ON p.user_id * 7 = s.device_id
    WHERE p.event_type <> 'signup' AND p.ts > s.start_time AND p.ts <= s.end_time
      AND s.end_time < p.ts + INTERVAL 3 HOUR
"""


def users_of(customer: DataFrame, *more: Column) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("user_id"), (F.col("c_custkey") * 7).alias("device_id"),
        F.concat(F.lit("mac"), text("c_custkey")).alias("mac_address"), *more)


def lasting(start, value, micros_per_cent: int):
    """A time as far behind ``start`` as ``value`` says, in whole micros."""
    cents = F.round(value * 100).cast("long")
    return F.timestamp_micros(F.unix_micros(start) + cents * micros_per_cent)


def signup_spans(df: DataFrame) -> DataFrame:
    return where(df, "event_type = 'signup'").select(
        "user_id", F.lit(1).alias("workout_id"), F.col("event_id").alias("session_id"),
        F.col("ts").alias("start_time"), lasting(F.col("ts"), F.col("value"), 600_000).alias("end_time"))


def other_points(df: DataFrame) -> DataFrame:
    return where(df, "event_type <> 'signup'").select(
        (F.col("user_id") * 7).alias("device_id"), "event_id", F.col("ts").alias("time"))


CONTAINED = ["event_id", "time", "user_id", "session_id", "start_time", "end_time"]


@query(CONTAINMENT_SQL)
def contained_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(table(spark, sf_dir, "events"))
    spans = with_device(signup_spans(source), users_of(table(spark, sf_dir, "customer")))
    return plain_times(containment_join(other_points(source), spans, ["device_id"]).select(*CONTAINED))


STATS_SQL = """
    SELECT user_id, 1 AS workout_id, CAST(day(ts) AS INTEGER) AS session_id, time_bucket(INTERVAL 1 DAY, ts) AS end_time,
           min(heartrate) AS min_bpm, round(avg(heartrate), 8) AS avg_bpm, max(heartrate) AS max_bpm,
           count(heartrate) AS num_recordings
    FROM (SELECT *, CASE WHEN event_type <> 'error' THEN round(value - 20, 4) END AS heartrate FROM events)
    WHERE heartrate IS NULL OR heartrate > 0
    GROUP BY user_id, session_id, end_time
"""


def session_readings(df: DataFrame) -> DataFrame:
    return valid_only(flag_valid(heart_rates_of(df))).select(
        "user_id", F.lit(1).alias("workout_id"), F.dayofmonth("ts").alias("session_id"),
        F.date_trunc("day", "ts").alias("end_time"), "heartrate")


@query(f"""
    SELECT s.workout_id, s.session_id, s.user_id, b.age, b.gender, b.city, b.state,
           s.min_bpm, s.avg_bpm, s.max_bpm, s.num_recordings
    FROM ({STATS_SQL}) s JOIN ({BINS_SQL}) b ON s.user_id = b.user_id
""")
def session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = session_readings(events(table(spark, sf_dir, "events")))
    stats = rounded(reading_stats(readings, ["user_id", "workout_id", "session_id", "end_time"]), "avg_bpm", places=8)
    return with_bins(stats, bins_of(table(spark, sf_dir, "customer")))


PRESENCE_SQL = """
    WITH visits AS (
        SELECT 'mac' || user_id AS mac_address, user_id % 7 AS gym, ts AS login,
               ts + to_microseconds(CAST(round(value * 100) AS BIGINT) * 6000000) AS logout
        FROM events WHERE event_type = 'signup'),
    sessions AS (
        SELECT 'mac' || c_custkey AS mac_address, 1 AS workout_id, event_id AS session_id, ts AS start_time,
               ts + to_microseconds(CAST(round(value * 100) AS BIGINT) * 600000) AS end_time
        FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'click')
    SELECT CAST(login AS DATE) AS date, gym, l.mac_address, workout_id, session_id,
           round((CAST(floor(epoch(logout)) AS BIGINT) - CAST(floor(epoch(login)) AS BIGINT)) / 60.0, 2)
               AS minutes_in_gym,
           round((CAST(floor(epoch(end_time)) AS BIGINT) - CAST(floor(epoch(start_time)) AS BIGINT)) / 60.0, 2)
               AS minutes_exercising
    FROM visits l JOIN sessions w ON l.mac_address = w.mac_address AND w.start_time BETWEEN l.login AND l.logout
"""


def presence_visits(source: DataFrame) -> DataFrame:
    return where(source, "event_type = 'signup'").select(
        F.concat(F.lit("mac"), text("user_id")).alias("mac_address"), (F.col("user_id") % 7).alias("gym"),
        F.col("ts").alias("login"), lasting(F.col("ts"), F.col("value"), 6_000_000).alias("logout"))


def presence_sessions(source: DataFrame) -> DataFrame:
    return where(source, "event_type = 'click'").select(
        "user_id", F.lit(1).alias("workout_id"), F.col("event_id").alias("session_id"),
        F.col("ts").alias("start_time"), lasting(F.col("ts"), F.col("value"), 600_000).alias("end_time"))


@query(PRESENCE_SQL)
def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(table(spark, sf_dir, "events"))
    return presence_report(presence_visits(source), presence_sessions(source), users_of(table(spark, sf_dir, "customer")))


@query(f"""
    SELECT *, CAST(row_number() OVER (PARTITION BY date ORDER BY gym, mac_address, session_id, workout_id, minutes_in_gym,
        minutes_exercising) AS INTEGER) AS place FROM ({PRESENCE_SQL})
""")
def presence_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report in its order, told by each row's place on its date."""
    return ranked_report(presence(spark, sf_dir))


REWARDS_SQL = """
    SELECT CAST(o_custkey AS VARCHAR) AS CustomerCardNo, round(sum(o_totalprice), 4) AS TotalAmount,
           round(sum(o_totalprice * 0.2), 4) AS TotalPoints
    FROM orders GROUP BY o_custkey
"""


def invoices_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(text("o_custkey").alias("CustomerCardNo"), F.col("o_totalprice").alias("TotalAmount"))


@query(REWARDS_SQL)
def rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reward_points(invoices_from_orders(table(spark, sf_dir, "orders"))), "TotalAmount", "TotalPoints")


@query("""
    SELECT o_orderkey, o_orderdate AS parsed, CAST(o_orderdate AS DATE) AS day,
           CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS checked_day,
           CAST(o_orderdate AS TIMESTAMP) AS from_epoch, round(o_custkey / 60.0, 2) AS minutes
    FROM orders
""")
def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times through text and epoch seconds and back; unreadable text gives null."""
    at = F.col("o_orderdate").cast("timestamp")
    slashes = F.when(F.col("o_orderstatus") == "O", "no date").otherwise(F.date_format(at, "MM/dd/yyyy"))
    return plain_times(table(spark, sf_dir, "orders").select(
        "o_orderkey", parse_timestamp(F.date_format(at, "yyyy-MM-dd HH:mm:ss")).alias("parsed"),
        F.to_date(at).alias("day"), parse_date(slashes).alias("checked_day"),
        epoch_to_timestamp(F.unix_seconds(at).cast("double")).alias("from_epoch"),
        minutes_between(at, F.timestamp_seconds(F.unix_seconds(at) + F.col("o_custkey"))).alias("minutes")))
