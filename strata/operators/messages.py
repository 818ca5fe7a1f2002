"""Message envelopes: one table or log that carries several topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.messages import decode_json, encode_json
from strata.functions.temporal import epoch_to_timestamp, parse_date
from strata.schemas import HEART_RATE, USER_INFO, WORKOUT


def where(df: DataFrame, condition: str | Column) -> DataFrame:
    """Rows that meet a caller-supplied SQL condition."""
    return df.where(condition)


def of_topic(messages: DataFrame, topic: str) -> DataFrame:
    """Messages of one topic; prunes partitions where the table is partitioned by topic."""
    return messages.where(F.col("topic") == topic)


def payload(messages: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """The decoded payload's fields as columns."""
    return messages.select(decode_json(F.col(column), schema).alias("v")).select("v.*")


_MALFORMED = "_malformed"


def decoded_or_not(messages: DataFrame, schema: str, column: str = "value", reason: str = "malformed") -> DataFrame:
    """The payload's fields in the place of the payload, and the payload itself as ``malformed`` where it is no record of the schema.

    Good and bad rows stay one DataFrame, so that one scan can store both; see ``good_rows`` and ``bad_rows``. A null
    payload is a bad row too, with an empty text.
    """
    parsed = F.from_json(F.col(column).cast("string"), f"{schema}, {_MALFORMED} string", {"columnNameOfCorruptRecord": _MALFORMED})
    rows = messages.withColumn(column, parsed)
    bad = F.when(F.col(column).isNull(), F.lit("")).otherwise(F.col(f"{column}.{_MALFORMED}"))
    return rows.withColumn(reason, bad).withColumn(column, F.col(column).dropFields(_MALFORMED))


def good_rows(decoded: DataFrame, reason: str = "malformed") -> DataFrame:
    return decoded.where(F.col(reason).isNull()).drop(reason)


def bad_rows(decoded: DataFrame, column: str = "value", reason: str = "malformed") -> DataFrame:
    """What came with rows that could not be decoded, and their payload as it was."""
    return decoded.where(F.col(reason).isNotNull()).drop(column)


def decode_log(log: DataFrame, schema: str) -> DataFrame:
    """Log records with text key and decoded value, keeping what identifies a record."""
    return log.select(
        F.col("key").cast("string").alias("key"),
        decode_json(F.col("value"), schema).alias("value"),
        "topic", "partition", "offset", "timestamp",
    )


def text_log(log: DataFrame) -> DataFrame:
    """Log records with key and value as text, undecoded."""
    return log.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", F.col("timestamp").cast("timestamp").alias("timestamp"),
    )


def encode_log(df: DataFrame, key: str) -> DataFrame:
    """Rows as log records: one column as the key, the whole row as JSON value."""
    return df.select(F.expr(key).cast("string").alias("key"), encode_json().alias("value"))


def profile_changes(messages: DataFrame) -> DataFrame:
    """User profile events of the multiplexed table."""
    events = payload(of_topic(messages, "user_info"), USER_INFO)
    return events.select(
        "user_id", parse_date(F.col("dob")).alias("dob"), "sex", "gender", "first_name", "last_name",
        "address.street_address", "address.city", "address.state", "address.zip",
        epoch_to_timestamp(F.col("timestamp")).alias("updated"), "update_type",
    )


def workout_events(messages: DataFrame) -> DataFrame:
    """Start and stop events of the multiplexed table."""
    events = payload(of_topic(messages, "workout"), WORKOUT)
    return events.select(
        "user_id", "workout_id", epoch_to_timestamp(F.col("timestamp")).alias("time"), "action", "session_id",
    )


def heart_rates(messages: DataFrame) -> DataFrame:
    """Heart-rate readings of the multiplexed table, each with its validity."""
    return flag_valid(payload(of_topic(messages, "bpm"), HEART_RATE))


def flag_valid(readings: DataFrame, reading: str = "heartrate") -> DataFrame:
    """Adds ``valid``: false for zero and negative readings, true otherwise (null included)."""
    return readings.withColumn("valid", F.when(F.col(reading) <= 0, False).otherwise(True))


def valid_only(readings: DataFrame) -> DataFrame:
    return readings.where("valid")


def actions(workouts: DataFrame, action: str, time_as: str) -> DataFrame:
    """Events of one action, with their time named by its role."""
    return workouts.where(F.col("action") == action).select(
        "user_id", "workout_id", "session_id", F.col("time").alias(time_as))
