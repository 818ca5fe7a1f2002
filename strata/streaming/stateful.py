"""Rows kept per key with a life of their own: what grouping, joins and duplicate removal cannot express.

The state is Spark's (``transformWithState``): it lives in the query's checkpoint, and keys are spread over its partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from strata.streaming.state import LATENESS, watermarked


class _FirstRow(StatefulProcessor):
    """Gives the first row of a key in the order of its columns, and nothing for as long as the key is remembered."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], ttl_ms: int | None):
        self._columns, self._order, self._ttl = list(columns), list(order), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "seen boolean", self._ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self._seen.exists():
            for _ in rows:  # all rows have to be taken
                pass
            return
        first = min(rows, key=lambda r: tuple((r[c] is None, r[c]) for c in self._order))
        self._seen.update((True,))
        yield Row(**{c: first[c] for c in self._columns})

    def close(self) -> None:
        pass


def first_of_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], remembered: dt.timedelta | None = None) -> DataFrame:
    """The first row of each key over the life of the stream, for keys without an event time. Append mode.

    Of a batch's rows of a new key the first by ``order`` (nulls last) and then by all other columns. A key is forgotten once ``remembered``
    has passed since its row came, by the clock of the query; a copy that comes later is new again, so that a table behind the stream
    should still decide by its own key. None remembers for good. Null keys are keys like any other.

    State that ends by the clock makes Spark run batches without data for as long as a query lives: one that is to end by itself
    (``Job.every`` None) needs ``spark.sql.streaming.noDataMicroBatches.enabled`` off.
    """
    ties = [*order, *[c for c in df.columns if c not in order and c not in keys]]
    ttl = int(remembered / dt.timedelta(milliseconds=1)) if remembered else None
    return df.groupBy(*keys).transformWithState(
        _FirstRow(df.columns, ties, ttl), StructType(df.schema.fields), "Append", "ProcessingTime" if ttl else "None")


# Times as numbers, which compare alike whatever zone a worker reads them in; keys as text that Spark makes of them.
_VALUE, _AT, _ID, _PART = "_value_micros", "_at_millis", "_id", "_part"

#: Parts that the keys of one time are held in. State is read and written for each part, not for each key.
PARTS = 256


class _Greatest(StatefulProcessor):
    """Gives a key's greatest value whenever it grows, and forgets the keys of a time when that is behind the watermark.

    The state of a part of the keys of one time is a list of keys and one of their values: each call for state goes to
    Spark's process and back, which takes far longer than a key's own work.
    """

    def __init__(self, keys: Sequence[str], kept_ms: int):
        self._keys, self._kept = list(keys), kept_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._greatest = handle.getValueState("greatest", "ids array<string>, value array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self._greatest.get()
        known = state is not None
        held = dict(zip(*state)) if known else {}
        grown: dict[str, tuple] = {}
        for row in rows:
            name, value = row[_ID], row[_VALUE]
            if name in held:
                best = held[name]
                if value is None or (best is not None and value <= best):
                    continue
            held[name] = value
            grown[name] = tuple(row[c] for c in self._keys)
            end = row[_AT] + self._kept
        if not grown:
            return
        if not known:
            self._handle.registerTimer(end)
        self._greatest.update((list(held), list(held.values())))
        for name, own in grown.items():
            yield Row(**dict(zip(self._keys, own)), **{_VALUE: held[name]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._greatest.clear()
        return iter(())

    def close(self) -> None:
        pass


def _text(df: DataFrame, column: str) -> Column:
    """A key column such that equal keys, and only those, have equal texts; grouping takes -0.0 for 0.0."""
    kind, value = df.schema[column].dataType, F.col(column)
    if kind.typeName() in ("float", "double"):
        return value + F.lit(0).cast(kind)
    return F.unix_micros(value) if kind.typeName() == "timestamp" else F.hex(value) if kind.typeName() == "binary" else value


def greatest_of_key(
    df: DataFrame, keys: Sequence[str], at: str, value: str, lateness: str = LATENESS, kept: dt.timedelta = dt.timedelta(days=1),
    parts: int = PARTS,
) -> DataFrame:
    """Each key's greatest ``value`` (a time) so far, given anew whenever it grows. Update mode: a later row replaces an earlier one.

    ``at`` names the key column of event time. A key is held until the watermark, which follows the greatest ``at`` by ``lateness``,
    has passed its time by ``kept``; what comes later for it starts anew, so that a merge behind the stream should keep the greater
    value. Rows without an ``at`` are left out, null values never replace others.

    The keys of one time are held in ``parts`` parts, and a batch reads and writes the parts that it has rows of: as many as
    make a part of some thousand keys.
    """
    names = [_text(df, c).alias(f"c{n}") for n, c in enumerate(keys) if c != at]
    named = F.to_json(F.struct(*names), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}) if names else F.lit("")
    timed = df.where(F.col(at).isNotNull()).select(
        *keys, F.unix_micros(value).alias(_VALUE), F.unix_millis(at).alias(_AT), named.alias(_ID))
    timed = timed.withColumn(_PART, F.pmod(F.xxhash64(_ID), F.lit(parts)))
    schema = StructType([*[df.schema[c] for c in keys], StructField(_VALUE, LongType())])
    grown = watermarked(timed, at, lateness).groupBy(at, _PART).transformWithState(
        _Greatest(keys, int(kept / dt.timedelta(milliseconds=1))), schema, "Update", "EventTime")
    return grown.select(*keys, F.timestamp_micros(_VALUE).alias(value))
