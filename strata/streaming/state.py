"""Event-time bounds and duplicate removal on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how far behind the newest event time rows are still accepted.
LATENESS = "30 seconds"


def watermarked(df: DataFrame, event_time: str, lateness: str | None = LATENESS) -> DataFrame:
    """Marks the event time; None leaves the stream unbounded and drops nothing as late."""
    return df.withWatermark(event_time, lateness) if lateness else df


def without_duplicates(
    df: DataFrame, keys: Sequence[str], event_time: str, lateness: str | None = LATENESS,
    spread: int | None = None, within_lateness: bool = False,
) -> DataFrame:
    """One row per key over the life of the stream.

    With ``event_time`` among the keys, state older than the watermark is dropped. Otherwise
    keys are held for good, unless ``within_lateness`` limits the promise to copies that come
    no further apart than the lateness.

    ``spread`` removes copies in two rounds, the first over that many parts of every key, so
    that a key or a row that is copied very often does not land in one task. Each round keeps
    its own state; the result is the same.
    """
    marked = watermarked(df, event_time, lateness)

    def distinct(rows: DataFrame, columns: list[str]) -> DataFrame:
        if within_lateness:
            return rows.dropDuplicatesWithinWatermark(columns)
        return rows.dropDuplicates(columns)

    if spread:
        part = F.pmod(F.spark_partition_id(), F.lit(spread))
        marked = distinct(marked.withColumn("_part", part), [*keys, "_part"]).drop("_part")
    return distinct(marked, list(keys))
