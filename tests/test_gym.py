"""The gym workload over two landing sets, as the two-batch scenario runs it."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.operators.joins import REPORT_ORDER, with_bins
from strata.plans.workouts import Gym
from strata.schemas import STORED_USER
from strata.sources.files import stream_loaded, with_load_day
from strata.streaming.jobs import Job, append_to_path, await_all

from .conftest import rows

T0 = 1_700_000_000  # 2023-11-14 22:13:20 UTC


def message(topic, key, value, ts, offset):
    return json.dumps({
        "key": str(key), "value": json.dumps(value), "topic": topic, "partition": 0, "offset": offset,
        "timestamp": int(ts)})


def info(user, kind, ts, dob, last, city="Town", zip_code="01234"):
    return {"user_id": user, "update_type": kind, "timestamp": ts, "dob": dob, "sex": "F", "gender": "F",
            "first_name": "A", "last_name": last,
            "address": {"street_address": "s", "city": city, "state": "CA", "zip": zip_code}}


def work(user, session, ts, action):
    return {"user_id": user, "workout_id": 1, "timestamp": ts, "action": action, "session_id": session}


def bpm(device, ts, rate):
    time = "1970-01-01T00:00:00Z" if ts is None else _iso(ts)
    return {"device_id": device, "time": time, "heartrate": rate}


def _iso(ts):
    import datetime
    return datetime.datetime.fromtimestamp(ts, datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def land(base, folder, name, lines):
    path = Path(base) / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def first_set(base):
    land(base, "registered_users_bz", "1.csv", [
        "user_id,device_id,mac_address,registration_timestamp",
        f"1,101,aa,{T0}", f"2,102,bb,{T0 + 5}", "", ""])
    land(base, "gym_logins_bz", "1.csv", [
        "mac_address,gym,login,logout", f"aa,5,{T0 + 100},{T0 + 4000}"])
    land(base, "kafka_multiplex_bz", "info1.json", [
        message("user_info", 1, info(1, "new", T0 + 1.0, "02/29/2000", "Old"), T0 + 1, 1),
        message("user_info", 1, info(1, "update", T0 + 60.0, "02/29/2000", "New"), T0 + 60, 2),
        message("user_info", 1, info(1, "delete", T0 + 90.0, "02/29/2000", "Gone"), T0 + 90, 3)])
    land(base, "kafka_multiplex_bz", "work1.json", [
        message("workout", 1, work(1, 1, T0 + 200.0, "start"), T0 + 200, 4),
        message("workout", 1, work(1, 1, T0 + 200.0, "start"), T0 + 200, 5),
        message("workout", 1, work(1, 1, T0 + 3800.0, "stop"), T0 + 3800, 6)])
    land(base, "kafka_multiplex_bz", "bpm1.json", [
        message("bpm", 101, bpm(101, T0 + 200, 90.0), T0 + 200, 7),      # at the start: outside
        message("bpm", 101, bpm(101, T0 + 300, 100.0), T0 + 300, 8),
        message("bpm", 101, bpm(101, T0 + 400, -1.0), T0 + 400, 9),      # invalid
        message("bpm", 101, bpm(101, T0 + 3800, 120.0), T0 + 3800, 10),  # at the end: inside
        message("bpm", 101, bpm(101, T0 + 3900, 130.0), T0 + 3900, 11)])


def second_set(base):
    day = 86_400
    land(base, "registered_users_bz", "2.csv", [
        "user_id,device_id,mac_address,registration_timestamp",
        f"1,999,zz,{T0 + day}", f"3,103,cc,{T0 + day}"])
    land(base, "gym_logins_bz", "2.csv", [
        "mac_address,gym,login,logout",
        f"aa,5,{T0 + 100},{T0 + 5000}",     # same visit, later logout
        f"bb,6,{T0 + day},{T0 + day + 7200}"])
    land(base, "kafka_multiplex_bz", "info2.json", [
        message("user_info", 2, info(2, "new", T0 + day * 1.0, "01/01/1950", "Two", "City", "90210"), T0 + day, 20),
        message("user_info", 1, info(1, "update", T0 + day + 10.0, "02/29/2000", "Newest", "Moved"), T0 + day, 21)])
    land(base, "kafka_multiplex_bz", "work2.json", [
        message("workout", 2, work(2, 1, T0 + day + 100.0, "start"), T0 + day, 22),
        message("workout", 2, work(2, 1, T0 + day + 1900.0, "stop"), T0 + day, 23),
        message("workout", 2, work(2, 2, T0 + day + 3000.0, "start"), T0 + day, 24),
        message("workout", 2, work(2, 2, T0 + day + 3000.0 + 3 * 3600, "stop"), T0 + day, 25)])  # 3 h: too long
    land(base, "kafka_multiplex_bz", "bpm2.json", [
        message("bpm", 102, bpm(102, T0 + day + 500, 80.0), T0 + day, 26),
        message("bpm", 102, bpm(102, T0 + day + 600, 100.0), T0 + day, 27)])


@pytest.fixture(scope="module")
def gym(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("gym")
    landing, dates = str(base / "landing"), base / "dates.json"
    first_set(landing)
    dates.write_text("\n".join(json.dumps(
        {"date": d, "week": 46, "year": 2023, "month": 11, "dayofweek": 3, "dayofmonth": 14, "dayofyear": 318,
         "week_part": p}) for d, p in [("2023-11-14", "weekday"), ("2023-11-18", "weekend")]))
    spark.sql("DROP DATABASE IF EXISTS gym_tests CASCADE")
    gym = Gym(spark, landing, str(base / "tables"), as_of=F.to_date(F.lit("2023-11-14")), database="gym_tests")
    gym.load_dates(str(dates))
    gym.run()
    gym.other = spark.newSession()
    gym.report_first = rows(gym.other.table("gym_tests.gym_summary"))
    gym.after_first = {name: rows(table.read()) for name, table in gym.tables.items()}
    second_set(landing)
    gym.run()
    return gym


def table(gym, name, *columns):
    return rows(gym.tables[name].read().select(*columns))


def test_first_set(gym):
    assert len(gym.after_first["users"]) == 2
    assert len(gym.after_first["workouts"]) == 2
    assert len(gym.after_first["completed_workouts"]) == 1
    assert [r[-1] for r in gym.after_first["workout_bpm"]] == [100.0, 120.0]


def test_users_keep_their_first_registration(gym):
    assert table(gym, "users", "user_id", "device_id") == [(1, 101), (2, 102), (3, 103)]


def test_logout_moves_forward(gym):
    got = table(gym, "gym_logs", "mac_address", F.unix_seconds("logout"))
    assert got == [("aa", T0 + 5000), ("bb", T0 + 86_400 + 7200)]


def test_profiles_hold_the_newest_applicable_change(gym):
    got = table(gym, "user_profile", "user_id", "last_name", "city", "zip")
    assert got == [(1, "Newest", "Moved", "01234"), (2, "Two", "City", "90210")]


def test_bins_follow_profiles(gym):
    assert table(gym, "user_bins", "user_id", "age", "city") == [(1, "18-25", "Moved"), (2, "65-75", "City")]


def test_sessions_of_three_hours_are_not_completed(gym):
    assert table(gym, "completed_workouts", "user_id", "session_id") == [(1, 1), (2, 1)]


def test_summary_holds_sessions_behind_the_watermark(gym):
    got = table(gym, "workout_bpm_summary", "user_id", "age", "city", "min_bpm", "avg_bpm", "max_bpm",
                "num_recordings")
    assert got == [(1, "18-25", "Moved", 100.0, 110.0, 120.0, 2)]


def test_report(gym):
    got = [tuple(r) for r in gym.gym_summary().orderBy(*REPORT_ORDER).collect()]
    assert [(r[1], r[2], r[4], r[5], r[6]) for r in got] == [(5, "aa", 1, 81.67, 60.0), (6, "bb", 1, 120.0, 30.0)]


def test_catalog_views_follow_the_tables(gym):
    """A session that read the views between the two sets reads what the second one added."""
    assert [r[1:3] for r in gym.report_first] == [(5, "aa")]
    assert rows(gym.other.table("gym_tests.gym_summary")) == rows(gym.gym_summary())
    for name, table_ in gym.tables.items():
        assert rows(gym.other.table(f"gym_tests.{name}")) == rows(table_.read()), name
    assert gym.other.table("gym_tests.date_lookup").count() == 2
    assert gym.other.table("gym_tests.kafka_multiplex_bz").count() == 19


def test_a_later_start_opens_its_own_days_only(gym, tmp_path):
    """The history before the start is left out by partition, not row by row."""
    spark = gym.spark
    days = spark.range(6).selectExpr(
        "id AS user_id", "id AS device_id", "'m' AS mac_address", "0D AS registration_timestamp",
        "timestamp'2024-03-01 10:00:00' + make_interval(0, 0, 0, int(id % 3), int(id)) AS load_time", "'f' AS source_file")
    path = str(tmp_path / "bz")
    with_load_day(days).write.partitionBy("load_day").parquet(path)
    since = "2024-03-02 12:00:00"
    query = append_to_path(stream_loaded(spark, path, STORED_USER, since), str(tmp_path / "out"), Job("since", str(tmp_path / "c")))
    await_all([query])
    assert sorted(r.user_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [2, 4, 5]
    filters = query._jsq.explainInternal(True).split("PartitionFilters: [")[1].split("]")[0]
    assert "isnotnull(load_day" in filters and ">= 2024-03-02" in filters


def test_messages_are_partitioned_and_keep_dates_without_a_match(gym):
    stored = gym.spark.read.parquet(f"{gym.root}/kafka_multiplex_bz")
    assert rows(stored.groupBy("topic", "week_part").count()) == rows(gym.spark.createDataFrame([
        ("user_info", "weekday", 3), ("workout", "weekday", 3), ("bpm", "weekday", 5),
        ("user_info", None, 2), ("workout", None, 4), ("bpm", None, 2)], "t string, w string, n long"))


def test_another_run_changes_nothing(gym):
    before = {name: rows(t.read()) for name, t in gym.tables.items()}
    gym.run()
    assert {name: rows(t.read()) for name, t in gym.tables.items()} == before


def test_continuous_mode_over_both_sets(spark, tmp_path):
    """All layers at once, started on empty tables; the outcome is that of running them in turn."""
    landing = str(tmp_path / "landing")
    for name in ("registered_users_bz", "gym_logins_bz", "kafka_multiplex_bz"):
        Path(landing, name).mkdir(parents=True)
    gym = Gym(spark, landing, str(tmp_path / "tables"), every="1 second", as_of=F.to_date(F.lit("2023-11-14")))
    queries = gym.run()
    try:
        for produce in (first_set, second_set):
            produce(landing)
            # A batch goes down the layers one trigger at a time.
            for _ in range(2):
                for query in queries:
                    query.processAllAvailable()
        assert all(q.isActive for q in queries)
    finally:
        for query in queries:
            query.stop()
    assert table(gym, "users", "user_id", "device_id") == [(1, 101), (2, 102), (3, 103)]
    assert table(gym, "user_bins", "user_id", "age", "city") == [(1, "18-25", "Moved"), (2, "65-75", "City")]
    assert table(gym, "completed_workouts", "user_id", "session_id") == [(1, 1), (2, 1)]
    assert len(table(gym, "workout_bpm", "time")) == 4
    got = table(gym, "workout_bpm_summary", "user_id", "min_bpm", "avg_bpm", "max_bpm", "num_recordings")
    assert got == [(1, 100.0, 110.0, 120.0, 2)]


def test_groups_that_leave_the_state_are_not_broadcast(spark, tmp_path, monkeypatch):
    """They leave it in a batch without data, which Catalyst takes for empty."""
    gym, plans = Gym(spark, str(tmp_path / "landing"), str(tmp_path / "tables")), []
    at = "timestamp_seconds({} + id * 60)".format
    gym.tables["workout_bpm"].insert_new(spark.range(50).selectExpr(
        "id AS user_id", "1 AS workout_id", "id AS session_id", f"{at(T0)} AS start_time", f"{at(T0 + 900)} AS end_time",
        f"{at(T0 + 300)} AS time", "60D + id AS heartrate"), "loader", 0)
    gym.tables["user_bins"].merge(spark.range(40).selectExpr(
        "id AS user_id", "'18-25' AS age", "'F' AS gender", "'Town' AS city", "'CA' AS state"), "loader", 0, [])

    def look(stats, bins, how):
        joined = with_bins(stats, bins, how)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr("strata.plans.workouts.with_bins", look)
    await_all([gym.gold_summary()])
    got = table(gym, "workout_bpm_summary", "user_id", "session_id", "age", "avg_bpm", "num_recordings")
    assert got == sorted(((i, i, "18-25", 60.0 + i, 1) for i in range(40)), key=repr)
    assert len(plans) > 1 and not [p for p in plans if "Broadcast" in p]
