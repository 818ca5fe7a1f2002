"""Joins on keys, time bounds and containment.

Equality keys alone can put much of the input into one task, and a time condition left as a
residual then compares all pairs of such a key. The time joins below therefore add the time
slot to the equality keys: a hot key is spread over its slots, and only rows of neighbouring
slots meet.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions.temporal import age_band, age_in_years, epoch_to_timestamp, minutes_between, next_slot, time_slot

_SLOT = "_slot"


def matching(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a large static table that a small batch asks for.

    A left join cannot broadcast its left side. Cutting the table down to the batch's keys
    first can, so the table is scanned for the batch but not shuffled.
    """
    return table.join(rows.select(*keys), list(keys), "left_semi")


def with_week_part(messages: DataFrame, dates: DataFrame) -> DataFrame:
    """Adds ``date`` and ``week_part`` of the message time; messages without a match keep nulls."""
    day = F.to_date(epoch_to_timestamp(F.col("timestamp")))
    return messages.join(dates.select("date", "week_part"), day == F.col("date"), "left")


def user_bins(profiles: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Age band and place of every profile."""
    return profiles.select(
        "user_id", age_band(age_in_years(F.col("dob"), as_of)).alias("age"), "gender", "city", "state")


def profile_bins(profiles: DataFrame, users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The bin of every profile, and since when its user is registered: null for profiles without a user."""
    since = users.select("user_id", "registered")
    return user_bins(profiles, as_of).join(since, "user_id", "left")


def with_device(workouts: DataFrame, users: DataFrame) -> DataFrame:
    """Finished workouts of registered users, with the user's device."""
    return workouts.join(users.select("user_id", "device_id"), "user_id").select(
        "user_id", "device_id", "workout_id", "session_id", "start_time", "end_time")


def with_bins(stats: DataFrame, bins: DataFrame, how: str = "inner") -> DataFrame:
    """Session statistics with the user's bin; ``how="left"`` keeps users without one."""
    return stats.join(bins, ["user_id"], how).select(
        "workout_id", "session_id", "user_id", "age", "gender", "city", "state",
        "min_bpm", "avg_bpm", "max_bpm", "num_recordings")


def interval_join(
    starts: DataFrame, ends: DataFrame, keys: Sequence[str],
    start: str = "start_time", end: str = "end_time", within_seconds: int = 3 * 3600,
    require_order: bool = True, spread: bool = True,
) -> DataFrame:
    """Pairs of equal keys whose end comes less than ``within_seconds`` after the start.

    Static or stream to stream; watermark both sides of a stream first, the bounds then let
    Spark drop state. ``require_order=False`` also pairs an end with later starts, at any
    distance, which no slot can bound.
    """
    bound = F.expr(f"interval {within_seconds} seconds")
    left, right = starts.alias("l"), ends.alias("r")
    on = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    on.append(F.col(f"r.{end}") < F.col(f"l.{start}") + bound)
    if require_order:
        on.append(F.col(f"r.{end}") >= F.col(f"l.{start}"))
        if spread:
            first = time_slot(F.col(start), within_seconds)
            slots = F.array(first, next_slot(first, within_seconds))
            left = starts.withColumn(_SLOT, F.explode(slots)).alias("l")
            right = ends.withColumn(_SLOT, time_slot(F.col(end), within_seconds)).alias("r")
            on.append(F.col(f"l.{_SLOT}") == F.col(f"r.{_SLOT}"))
    return left.join(right, reduce(Column.__and__, on)).select(*_both_sides(starts, ends, keys))


def containment_join(
    points: DataFrame, spans: DataFrame, keys: Sequence[str], time: str = "time",
    start: str = "start_time", end: str = "end_time", within_seconds: int = 3 * 3600,
) -> DataFrame:
    """Points of equal keys inside a span: ``start < time <= end`` and ``end < time + bound``.

    Static or stream to stream. The bound means that only the last ``within_seconds`` of a
    span can match, so each span enters at most two slots, however long it is.
    """
    bound = F.expr(f"interval {within_seconds} seconds")
    last = time_slot(F.col(end), within_seconds)
    slots = F.array(last, last - F.lit(within_seconds * 1_000_000))
    left = points.withColumn(_SLOT, time_slot(F.col(time), within_seconds)).alias("l")
    right = spans.withColumn(_SLOT, F.explode(slots)).alias("r")
    on = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, _SLOT]]
    on += [
        F.col(f"l.{time}") > F.col(f"r.{start}"),
        F.col(f"l.{time}") <= F.col(f"r.{end}"),
        F.col(f"r.{end}") < F.col(f"l.{time}") + bound,
    ]
    return left.join(right, reduce(Column.__and__, on)).select(*_both_sides(points, spans, keys))


def _both_sides(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [F.col(f"l.{c}") for c in left.columns] + [F.col(f"r.{c}") for c in right.columns if c not in keys]


# Slot widths of between_join grow by this factor from an hour; ten of them reach past
# the whole range of timestamps.
_WIDTHS = [3600 * 8 ** i for i in range(10)]


def between_join(
    spans: DataFrame, points: DataFrame, keys: Sequence[str], start: str, end: str, time: str,
) -> DataFrame:
    """Points of equal keys with ``start <= time <= end``, for spans of any length. Batch only.

    Every span is filed under the narrowest slot width that is not shorter than the span, where
    it touches at most two slots; points look into each width in use. Only the set of widths in
    use, at most ten numbers, passes through the driver.
    """
    length = F.unix_micros(end) - F.unix_micros(start)
    width = F.lit(_WIDTHS[-1])
    for w in reversed(_WIDTHS[:-1]):
        width = F.when(length < w * 1_000_000, F.lit(w)).otherwise(width)
    sized = spans.where(F.col(end) >= F.col(start)).withColumn("_width", width.cast("long"))
    in_use = sorted(row[0] for row in sized.select("_width").distinct().collect()) or _WIDTHS[:1]

    span_micros = F.col("_width") * 1_000_000
    first = F.unix_micros(start) - F.pmod(F.unix_micros(start), span_micros)
    last = F.unix_micros(end) - F.pmod(F.unix_micros(end), span_micros)
    left = sized.withColumn(_SLOT, F.explode(F.array_distinct(F.array(first, last)))).alias("l")
    at = F.unix_micros(time)
    right = (
        points.withColumn("_width", F.explode(F.array(*[F.lit(w).cast("long") for w in in_use])))
        .withColumn(_SLOT, at - F.pmod(at, span_micros)).alias("r")
    )
    on = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, "_width", _SLOT]]
    on += [F.col(f"r.{time}") >= F.col(f"l.{start}"), F.col(f"r.{time}") <= F.col(f"l.{end}")]
    return left.join(right, reduce(Column.__and__, on)).select(*_both_sides(spans, points, keys))


def presence_report(gym_logs: DataFrame, workouts: DataFrame, users: DataFrame) -> DataFrame:
    """Minutes in the gym and minutes of exercise for every workout begun during a visit.

    The order of the rows is left to the caller.
    """
    sessions = workouts.join(users.select("user_id", "mac_address"), "user_id").select(
        "mac_address", "workout_id", "session_id", "start_time", "end_time")
    visits = gym_logs.select("mac_address", "gym", "login", "logout")
    matched = between_join(visits, sessions, ["mac_address"], "login", "logout", "start_time")
    return matched.select(
        F.to_date("login").alias("date"), "gym", "mac_address", "workout_id", "session_id",
        minutes_between(F.col("login"), F.col("logout")).alias("minutes_in_gym"),
        minutes_between(F.col("start_time"), F.col("end_time")).alias("minutes_exercising"),
    )


def presence_sql(gym_logs: str, workouts: str, users: str) -> str:
    """``presence_report`` as SQL over three tables, for a view that the catalog keeps.

    The widths in use are not known when a view is made, so sessions look into all ten.
    """
    length = "unix_micros(logout) - unix_micros(login)"
    cases = " ".join(f"WHEN {length} < {w * 1_000_000} THEN {w}" for w in _WIDTHS[:-1])
    slot = "unix_micros({0}) - pmod(unix_micros({0}), width * 1000000)".format
    return f"""
        SELECT to_date(l.login) AS date, l.gym, l.mac_address, s.workout_id, s.session_id,
            round((unix_seconds(l.logout) - unix_seconds(l.login)) / 60, 2) AS minutes_in_gym,
            round((unix_seconds(s.end_time) - unix_seconds(s.start_time)) / 60, 2) AS minutes_exercising
        FROM (SELECT *, explode(array_distinct(array({slot("login")}, {slot("logout")}))) AS slot
              FROM (SELECT mac_address, gym, login, logout, CAST(CASE {cases} ELSE {_WIDTHS[-1]} END AS BIGINT) AS width
                    FROM {gym_logs} WHERE logout >= login)) l
        JOIN (SELECT *, {slot("start_time")} AS slot
              FROM (SELECT u.mac_address, w.workout_id, w.session_id, w.start_time, w.end_time,
                        explode(array({", ".join(f"{w}L" for w in _WIDTHS)})) AS width
                    FROM {workouts} w JOIN {users} u ON w.user_id = u.user_id)) s
        ON l.mac_address = s.mac_address AND l.width = s.width AND l.slot = s.slot
        WHERE s.start_time BETWEEN l.login AND l.logout"""


REPORT_ORDER = ["date", "gym", "mac_address", "session_id"]


def ranked_report(report: DataFrame) -> DataFrame:
    """The report with its place in ``REPORT_ORDER`` on each date; ties have places too, by all other columns."""
    others = [c for c in report.columns if c not in REPORT_ORDER]
    by_date = Window.partitionBy("date").orderBy(*REPORT_ORDER[1:], *others)
    return report.withColumn("place", F.row_number().over(by_date))
