"""Gym workouts, from landing files to per-session heart-rate summaries.

Layers hand over through stored tables only. Bronze keeps what arrived, silver holds one row
per key, gold aggregates finished sessions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.temporal import epoch_to_timestamp
from strata.operators.aggregates import reading_stats
from strata.operators.joins import (
    containment_join, interval_join, presence_report, presence_sql, user_bins, with_bins, with_device,
    with_week_part,
)
from strata.operators.latest import latest_changes, latest_per_key
from strata.operators.messages import actions, heart_rates, profile_changes, valid_only, workout_events
from strata.schemas import (
    DATE_LOOKUP, GYM_LOGIN, MESSAGE, REGISTERED_USER, STORED_LOGIN, STORED_MESSAGE, STORED_USER, TABLES,
)
from strata.sinks.catalog import ensure_database, external_table, lasting_view, recover_partitions
from strata.sinks.staged import SET_ALL, InsertTable, SnapshotTable, StateTable
from strata.sources.files import read_json_file, stream_csv, stream_json, stream_loaded, with_load_day
from strata.sources.fs import SharedFs
from strata.streaming.jobs import Job, append_to_path, insert_new, run_stages, upsert
from strata.streaming.state import LATENESS, watermarked, without_duplicates

SESSION = ["user_id", "workout_id", "session_id"]

# Names, and the columns that part the stored files, of the raw tables. A scan that begins
# at a load day reads the folders of that day and later.
BRONZE = {
    "registered_users_bz": (STORED_USER, ["load_day"]),
    "gym_logins_bz": (STORED_LOGIN, ["load_day"]),
    "kafka_multiplex_bz": (STORED_MESSAGE, ["load_day", "topic", "week_part"]),
}

# Keys that identify a row of each table.
KEYS = {
    "users": ["user_id"],
    "gym_logs": ["mac_address", "gym", "login"],
    "user_profile": ["user_id"],
    "user_bins": ["user_id"],
    "workouts": ["user_id", "time"],
    "heart_rate": ["device_id", "time"],
    "completed_workouts": SESSION,
    "session_devices": SESSION,
    "workout_bpm": [*SESSION, "time"],
    "workout_bpm_summary": SESSION,
}
UPDATED_TABLES = {"gym_logs", "user_profile", "user_bins"}

LAYERS = {
    "bronze": list(BRONZE),
    "silver": [name for name in KEYS if name != "workout_bpm_summary"],
    "gold": ["workout_bpm_summary"],
}

LATER_LOGOUT = [("s.logout > t.login AND s.logout > t.logout", {"logout": "s.logout"})]
NEWER_PROFILE = [("t.updated < s.updated", SET_ALL)]


def finished_session_stats(starts: DataFrame, stops: DataFrame, users: DataFrame, readings: DataFrame) -> DataFrame:
    """Statistics of finished sessions, as one query from events to groups: no table is stored between its joins.

    ``starts``, ``stops`` and ``readings`` are batches, or streams with watermarks on their times. The bounds of both
    joins carry the watermark on to the groups, which come out once nothing can be added to them: some hours later than
    with a table in between, each of whose readers has a watermark of its own.
    """
    finished = with_device(interval_join(starts, stops, SESSION), users)
    # The end alone is the event time of what follows.
    spans = finished.withColumn("start_time", F.timestamp_micros(F.unix_micros("start_time")))
    inside = containment_join(readings, spans, ["device_id"]).select(*SESSION, "end_time", "heartrate")
    return reading_stats(inside, [*SESSION, "end_time"])


@dataclass
class Gym:
    """One installation of the workload: where it reads, where it keeps its tables.

    ``lateness`` None accepts rows however late, at the price of state that is never dropped;
    the tables' keys still keep rows unique. ``spread`` is passed on to duplicate removal.
    ``loaded_since`` (a timestamp, for bronze) and ``starting_at`` (a batch number, for
    silver) make queries with fresh checkpoints begin there instead of at the beginning.
    ``database`` names all tables, and the report, in the catalog.
    """

    spark: SparkSession
    landing: str
    root: str
    every: str | None = None
    lateness: str | None = LATENESS
    spread: int | None = None
    files_per_trigger: int | None = None
    as_of: Column | None = None
    bins_join: str = "inner"
    loaded_since: str | None = None
    starting_at: int = 0
    database: str | None = None
    tables: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        for name, keys in KEYS.items():
            at, schema = f"{self.root}/{name}", TABLES[name]
            self.tables[name] = (StateTable if name in UPDATED_TABLES else InsertTable)(self.spark, at, schema, keys)
        # Streams of later layers may start before the layer below has written anything.
        for name in BRONZE:
            SharedFs(self.spark, self.root).mkdirs(f"{self.root}/{name}")
        self.dates = SnapshotTable(self.spark, f"{self.root}/date_lookup", DATE_LOOKUP)
        if self.database:
            self._register(self.database)

    def _register(self, database: str) -> None:
        """Every table by its name, and the report, for any session that shares the catalog."""
        current = self.spark.catalog.currentDatabase()
        ensure_database(self.spark, database)
        self.spark.catalog.setCurrentDatabase(current)
        for name, table in {**self.tables, "date_lookup": self.dates}.items():
            table.register(f"{database}.{name}")
        for name, (schema, parts) in BRONZE.items():
            declared = self.spark.createDataFrame([], schema).schema
            external_table(self.spark, f"{database}.{name}", declared, f"{self.root}/{name}", parts)
        names = [f"{database}.{name}" for name in ("gym_logs", "completed_workouts", "users")]
        lasting_view(self.spark, f"{database}.gym_summary", presence_sql(*names))

    def job(self, name: str) -> Job:
        """Queries of one layer share a scheduler pool, named by the layer."""
        layer = next(layer for layer, names in LAYERS.items() if name in names)
        return Job(name, f"{self.root}/checkpoint/{name}", self.every, layer)

    def load_dates(self, path: str) -> None:
        """Replace the date lookup by the rows of a JSON file."""
        self.dates.overwrite(read_json_file(self.spark, path, DATE_LOOKUP))

    # -- bronze ------------------------------------------------------------------------

    def _ingest_csv(self, name: str, schema: str) -> StreamingQuery:
        rows = stream_csv(self.spark, f"{self.landing}/{name}", schema, self.files_per_trigger)
        return append_to_path(with_load_day(rows), f"{self.root}/{name}", self.job(name), partition_by=BRONZE[name][1])

    def ingest_users(self) -> StreamingQuery:
        return self._ingest_csv("registered_users_bz", REGISTERED_USER)

    def ingest_logins(self) -> StreamingQuery:
        return self._ingest_csv("gym_logins_bz", GYM_LOGIN)

    def ingest_messages(self) -> StreamingQuery:
        """Messages of all topics into one table, partitioned by load day, topic and part of the week."""
        messages = stream_json(self.spark, f"{self.landing}/kafka_multiplex_bz", MESSAGE, self.files_per_trigger)
        dated = with_week_part(messages, self.dates.read())
        name = "kafka_multiplex_bz"
        return append_to_path(with_load_day(dated), f"{self.root}/{name}", self.job(name), partition_by=BRONZE[name][1])

    # -- silver ------------------------------------------------------------------------

    def _bronze(self, name: str) -> DataFrame:
        return stream_loaded(self.spark, f"{self.root}/{name}", BRONZE[name][0], self.loaded_since)

    def _messages(self) -> DataFrame:
        return self._bronze("kafka_multiplex_bz")

    def _stored(self, name: str) -> DataFrame:
        return self.tables[name].stream(self.starting_at)

    def _distinct(self, rows: DataFrame, table: str, event_time: str, keys: list[str] | None = None) -> DataFrame:
        if self.lateness is None:
            return rows  # each batch is reduced to one row per key when it is merged
        return without_duplicates(rows, keys or KEYS[table], event_time, self.lateness, self.spread)

    def silver_users(self) -> StreamingQuery:
        registered = self._bronze("registered_users_bz").select(
            "user_id", "device_id", "mac_address",
            epoch_to_timestamp(F.col("registration_timestamp")).alias("registration_timestamp"))
        # No duplicate state: its keys would have no event time and stay for good, and the
        # table's own key already decides.
        return insert_new(
            registered, self.tables["users"], self.job("users"),
            order=["registration_timestamp", "device_id", "mac_address"])

    def silver_gym_logs(self) -> StreamingQuery:
        """Visits, whose logout moves forward as later records of the visit arrive."""
        visits = self._bronze("gym_logins_bz").select(
            "mac_address", "gym", epoch_to_timestamp(F.col("login")).alias("login"),
            epoch_to_timestamp(F.col("logout")).alias("logout"))

        def last_logout(rows: DataFrame) -> DataFrame:
            return rows.groupBy(*KEYS["gym_logs"]).agg(F.max("logout").alias("logout"))

        return upsert(
            visits, self.tables["gym_logs"], self.job("gym_logs"), LATER_LOGOUT, prepare=last_logout, range_column="login")

    def silver_profiles(self) -> StreamingQuery:
        changes = self._distinct(
            profile_changes(self._messages()), "user_profile", "updated", ["user_id", "updated"])

        def newest(rows: DataFrame) -> DataFrame:
            return latest_changes(rows, KEYS["user_profile"], "updated")

        return upsert(
            changes, self.tables["user_profile"], self.job("user_profile"), NEWER_PROFILE,
            prepare=newest)

    def silver_workouts(self) -> StreamingQuery:
        events = self._distinct(workout_events(self._messages()), "workouts", "time")
        return insert_new(
            events, self.tables["workouts"], self.job("workouts"),
            order=["workout_id", "session_id", "action"], range_column="time")

    def silver_heart_rate(self) -> StreamingQuery:
        readings = self._distinct(heart_rates(self._messages()), "heart_rate", "time")
        return insert_new(
            readings, self.tables["heart_rate"], self.job("heart_rate"),
            order=[F.col("valid").desc(), "heartrate"], range_column="time")

    def silver_bins(self) -> StreamingQuery:
        """Age band and place of every user, following profile changes."""
        profiles = self._stored("user_profile")

        def current(rows: DataFrame) -> DataFrame:
            return user_bins(latest_per_key(rows, KEYS["user_profile"], "updated"), self.as_of)

        return upsert(
            profiles, self.tables["user_bins"], self.job("user_bins"), [(None, SET_ALL)],
            prepare=current)

    def silver_completed(self) -> StreamingQuery:
        """Sessions with both a start and a stop."""
        events = self._stored("workouts")
        starts = watermarked(actions(events, "start", "start_time"), "start_time", self._join_lateness)
        stops = watermarked(actions(self._stored("workouts"), "stop", "end_time"), "end_time",
                            self._join_lateness)
        return insert_new(
            interval_join(starts, stops, SESSION), self.tables["completed_workouts"],
            self.job("completed_workouts"), order=["start_time", "end_time"])

    def silver_devices(self) -> StreamingQuery:
        """Finished sessions with the user's device, by the users registered at that moment.

        A static side joined inside a running stream would keep the users of its start.
        """
        def with_current_devices(rows: DataFrame) -> DataFrame:
            return with_device(rows, self.tables["users"].read())

        return insert_new(
            self._stored("completed_workouts"), self.tables["session_devices"],
            self.job("session_devices"), order=["start_time", "end_time"],
            prepare=with_current_devices)

    def silver_bpm(self) -> StreamingQuery:
        """Valid readings taken during a finished session."""
        sessions = watermarked(self._stored("session_devices"), "end_time", self._join_lateness)
        readings = watermarked(
            valid_only(self._stored("heart_rate")).select("device_id", "time", "heartrate"),
            "time", self._join_lateness)
        return insert_new(
            containment_join(readings, sessions, ["device_id"]), self.tables["workout_bpm"],
            self.job("workout_bpm"), order=["start_time", "end_time", "heartrate"],
            range_column="time")

    # -- gold --------------------------------------------------------------------------

    def gold_summary(self) -> StreamingQuery:
        """Statistics of every session that has ended by the watermark, with the user's bin."""
        readings = watermarked(self._stored("workout_bpm"), "end_time", self._join_lateness)
        stats = reading_stats(readings, [*SESSION, "end_time"])

        def binned(rows: DataFrame) -> DataFrame:
            # Groups come out of state, most of them in a batch without data, which Catalyst takes for empty: left to
            # itself it broadcasts them all. The bins are shuffled and sorted by user in any case.
            return with_bins(rows.hint("merge"), self.tables["user_bins"].read(), self.bins_join)

        return insert_new(
            stats, self.tables["workout_bpm_summary"], self.job("workout_bpm_summary"),
            order=[F.col("num_recordings").desc(), "min_bpm", "max_bpm", "avg_bpm"], prepare=binned)

    @property
    def _join_lateness(self) -> str:
        # Joins and gold groups always need a bound, or they would never finish.
        return self.lateness or "36500 days"

    def gym_summary(self) -> DataFrame:
        """Minutes in the gym and of exercise, over the stored tables."""
        return presence_report(
            self.tables["gym_logs"].read(), self.tables["completed_workouts"].read(), self.tables["users"].read())

    def refresh_bronze(self) -> None:
        """Tell the catalog of raw files' folders; the other tables' folders it learns of with each batch."""
        for name in BRONZE if self.database else ():
            recover_partitions(self.spark, f"{self.database}.{name}")

    # -- running -----------------------------------------------------------------------

    def stages(self) -> list[list[Callable[[], StreamingQuery]]]:
        return [
            [self.ingest_users, self.ingest_logins, self.ingest_messages],
            [self.silver_users, self.silver_gym_logs, self.silver_profiles, self.silver_workouts,
             self.silver_heart_rate],
            [self.silver_bins, self.silver_completed],
            [self.silver_devices],
            [self.silver_bpm],
            [self.gold_summary],
        ]

    def run(self) -> list[StreamingQuery]:
        """All layers; once through if no interval is set, else left running."""
        started = run_stages(self.stages(), once=self.every is None)
        self.refresh_bronze()
        return started
