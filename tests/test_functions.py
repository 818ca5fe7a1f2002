import datetime as dt

from pyspark.sql import functions as F

from strata.functions.messages import decode_json, encode_json
from strata.functions.temporal import (
    age_band, age_in_years, epoch_to_timestamp, minutes_between, parse_date, parse_timestamp, time_slot,
)
from strata.functions.text import has_letter, normal_word, split_records, split_words

from .conftest import rows


def one(spark, column, schema="id int", row=(1,)):
    return spark.createDataFrame([row], schema).select(column).first()[0]


def test_words_keep_empty_pieces_and_line_breaks(spark):
    assert one(spark, split_words(F.lit("a  b\nc "))) == ["a", "", "b\nc", ""]
    assert one(spark, split_records(F.lit("a.b..c"))) == ["a", "b", "", "c"]


def test_normal_word_trims_spaces_only(spark):
    assert one(spark, normal_word(F.lit("  AbC\n "))) == "abc\n"
    assert one(spark, has_letter(F.lit("123")))is False
    assert one(spark, has_letter(F.lit(None).cast("string"))) is None


def test_unreadable_times_are_null(spark):
    assert one(spark, parse_timestamp(F.lit("2024-01-02 03:04:05"))) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, parse_timestamp(F.lit("02.01.2024"))) is None
    assert one(spark, parse_date(F.lit("12/31/1999"))) == dt.date(1999, 12, 31)
    assert one(spark, parse_date(F.lit("13/31/1999"))) is None


def test_epoch_seconds_stay_exact(spark):
    micros = F.unix_micros(epoch_to_timestamp(F.lit(1678539087.0)))
    assert one(spark, micros) == 1_678_539_087_000_000
    assert one(spark, F.unix_micros(epoch_to_timestamp(F.lit(1.5)))) == 1_500_000


def test_minutes_between_rounds_to_two_places(spark):
    at = F.timestamp_seconds
    assert one(spark, minutes_between(at(F.lit(0)), at(F.lit(100)))) == 1.67
    assert one(spark, minutes_between(at(F.lit(120)), at(F.lit(0)))) == -2.0


def test_age_bands_at_their_edges(spark):
    expected = {
        -1: "under 18", 0: "under 18", 17: "under 18", 18: "18-25", 24: "18-25", 25: "25-35", 34: "25-35",
        35: "35-45", 44: "35-45", 45: "45-55", 54: "45-55", 55: "55-65", 64: "55-65", 65: "65-75", 74: "65-75",
        75: "75-85", 84: "75-85", 85: "85-95", 94: "85-95", 95: "95+", 120: "95+", None: "invalid age",
    }
    df = spark.createDataFrame([(a,) for a in expected], "age int")
    assert dict(map(tuple, df.select("age", age_band(F.col("age"))).collect())) == expected


def test_ages_on_and_around_birthdays(spark):
    cases = [("2000-02-29", "2023-02-27", 22), ("2000-02-29", "2023-02-28", 23), ("2000-02-29", "2024-02-28", 23),
             ("2000-02-29", "2024-02-29", 24), ("2000-06-15", "2024-06-14", 23), ("2000-06-15", "2024-06-15", 24),
             ("1999-12-31", "2024-01-31", 24), (None, "2024-01-31", None)]
    df = spark.createDataFrame(cases, "dob string, as_of string, age int")
    got = df.select(age_in_years(F.col("dob").cast("date"), F.col("as_of").cast("date")), "age").collect()
    assert [tuple(r) for r in got] == [(c[2], c[2]) for c in cases]


def test_slots_are_exact_before_and_after_the_epoch(spark):
    df = spark.createDataFrame([(-1,), (0,), (3599,), (3600,), (-3600,), (-3601,)], "s long")
    got = df.select(time_slot(F.timestamp_seconds("s"), 3600) / 1_000_000).collect()
    assert [r[0] for r in got] == [-3600, 0, 0, 3600, -3600, -7200]


def test_malformed_json_gives_null_fields(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{broken",), (None,), ('{"a": "x"}',)], "v string")
    got = [r[0] for r in df.select(decode_json(F.col("v"), "a int")["a"]).collect()]
    assert got == [1, None, None, None]


def test_json_round_trip_from_bytes(spark):
    df = spark.createDataFrame([(1, "ä"), (2, None)], "a int, b string")
    sent = df.select(encode_json().cast("binary").alias("v"))
    assert rows(sent.select(decode_json(F.col("v"), "a int, b string").alias("d")).select("d.*")) == rows(df)
