"""Tables in plain Parquet folders that grow by whole, renamed-in folders.

A batch is written next to the table and renamed into place, so a reader sees all of it or
none, and a batch that is replayed after a failure finds its folder in place and does nothing.
Nothing that is stored is ever rewritten: a batch of n keys writes n rows at most.
Renames are atomic on HDFS-like and local file systems. Where they are not, use a table
format and ``strata.sinks.catalog.merge_into_catalog``. Every table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.operators.latest import first_per_key, latest_per_key
from strata.operators.merge import SET_ALL, Clause, changed_rows, split_null_keys
from strata.sinks.catalog import add_partition, drop_partition, external_table, lasting_view, recover_partitions
from strata.sources.fs import SharedFs

__all__ = ["SET_ALL", "Clause", "InsertTable", "SnapshotTable", "StateTable"]

#: A batch with up to this many values of a key column asks the stored files for these values, beyond it for their range.
#: A bound on what passes through the driver; the result is the same.
ASKED_VALUES = 1000
_VERSION = "version"
_PUSHED = 10  # values of one IN that a file scan takes as such; longer lists it takes as their range only


class _Staged:
    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.data = f"{self.root}/data"
        self.schema = spark.createDataFrame([], schema).schema
        self.columns = self.schema.names
        self.fs = SharedFs(spark, self.root)
        self.fs.mkdirs(self.data)

    def _publish(self, df: DataFrame, target: str, parted_by: Sequence[str] = (), **options: str) -> None:
        staging = f"{self.root}/_staging/{target.rsplit('/data/', 1)[-1]}"
        df.write.mode("overwrite").options(**options).partitionBy(*parted_by).parquet(staging)
        self.fs.move(staging, target)

    def _conform(self, df: DataFrame) -> DataFrame:
        """The table's columns in the table's order and types."""
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])


def _any_of(column: str, values: Sequence) -> Column:
    """Whether the column has one of the values, as a shallow tree of lists that are each short enough to reach the files."""
    tests = [F.col(column).isin(values[i:i + _PUSHED]) for i in range(0, len(values), _PUSHED)] or [F.lit(False)]
    while len(tests) > 1:
        tests = [reduce(Column.__or__, tests[i:i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


@contextmanager
def _kept(df: DataFrame, keep: bool):
    """Keeps a batch for the few passes of one merge; lost blocks are recomputed."""
    if not keep:
        yield df
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


class SnapshotTable(_Staged):
    """A table whose whole content is replaced by every batch (complete output mode)."""

    registered: str | None = None

    def _versions(self) -> list[tuple[int, str, int]]:
        """Number, writer and batch of every version, oldest first."""
        parts = [name.split("-") for name in self.fs.names(self.data) if name.startswith("v")]
        return sorted((int(v[1:]), writer, int(batch)) for v, writer, batch in parts)

    def replace(self, df: DataFrame, writer: str, batch_id: int) -> bool:
        """Make ``df`` the content, unless it is already this batch's; True if replaced."""
        versions = self._versions()
        number, by, batch = versions[-1] if versions else (-1, "", -1)
        writer = writer.replace("-", "")
        if (by, batch) == (writer, batch_id):
            return False
        target = f"{self.data}/v{number + 1}-{writer}-{batch_id}"
        self._publish(self._conform(df), target)
        if self.registered:
            add_partition(self.spark, self.registered, {_VERSION: number + 1}, target)
        for old in versions[:-1]:  # the one before stays for readers that have just listed it
            if self.registered:
                drop_partition(self.spark, self.registered, {_VERSION: old[0]})
            self.fs.delete(f"{self.data}/v{old[0]}-{old[1]}-{old[2]}")
        return True

    def register(self, name: str) -> None:
        """A lasting view of that name (``database.table``) of the newest version, whichever that is when it is read."""
        table = f"{name}_versions"
        external_table(self.spark, table, StructType([*self.schema, StructField(_VERSION, LongType())]), self.data, [_VERSION])
        for number, writer, batch in self._versions()[-1:]:
            add_partition(self.spark, table, {_VERSION: number}, f"{self.data}/v{number}-{writer}-{batch}")
        self.registered = table
        lasting_view(self.spark, name, f"SELECT {', '.join(self.columns)} FROM {table}"
                                       f" WHERE {_VERSION} = (SELECT max({_VERSION}) FROM {table})")

    def overwrite(self, df: DataFrame) -> None:
        """Make ``df`` the content, as a write of its own outside any stream."""
        self.replace(df, uuid.uuid4().hex, 0)

    def read(self) -> DataFrame:
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        number, writer, batch = versions[-1]
        return self.spark.read.schema(self.schema).parquet(f"{self.data}/v{number}-{writer}-{batch}")


class _Batches(_Staged):
    """What keyed tables share: a folder for each writer's batch, Bloom filters on keys, a place in the catalog."""

    _EXTRA: Sequence[StructField] = ()

    def __init__(self, spark: SparkSession, root: str, schema: str, keys: Sequence[str], parted_by: Sequence[str] = ()):
        """``parted_by`` names key columns of few values, by which each batch's files are parted, too."""
        super().__init__(spark, root, schema)
        self.keys = list(keys)
        self.parted_by = list(parted_by)
        if set(self.parted_by) - set(self.keys):
            raise ValueError(f"parted_by names keys, of {self.keys}, not {self.parted_by}")
        self.registered: str | None = None

    # -- reading -----------------------------------------------------------------------

    def _file_schema(self) -> StructType:
        return StructType([*self.schema, *self._EXTRA])

    def _stored_schema(self) -> StructType:
        return StructType([*self._file_schema(), StructField("writer", StringType()), StructField("batch", LongType())])

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self._stored_schema()).parquet(self.data)

    def stream(self, starting_batch: int = 0, **options: str) -> DataFrame:
        """The rows that batches added as a stream, from a given batch number of each writer on.

        ``starting_batch`` is meant for a fresh checkpoint; whole batch folders are skipped.
        """
        rows = self.spark.readStream.options(**options).schema(self._stored_schema()).parquet(self.data)
        if starting_batch:
            rows = rows.where(F.col("batch") >= starting_batch)
        return rows.select(*self.columns)

    def _asked(self, stored: DataFrame, rows: DataFrame, range_column: str | None, low, high) -> DataFrame:
        """The stored rows with a batch's keys.

        What the batch is known to hold reaches the scan as literals: the range of ``range_column``, and the
        values of partition columns and of the first other key, if they are few. Partitions, statistics and Bloom filters then
        leave out files and row groups without them. The rest is a semi-join, for which a small batch is broadcast and the table never shuffled.
        """
        if range_column and low is not None:
            stored = self._within(stored, range_column, low, high)
        others = [k for k in self.keys if k != range_column and k not in self.parted_by]
        for lookup in [*self.parted_by, *others[:1]]:
            values = [r[0] for r in rows.select(lookup).distinct().limit(ASKED_VALUES + 1).collect()]
            if len(values) <= ASKED_VALUES:
                stored = stored.where(_any_of(lookup, values))
        return stored.join(rows.select(*self.keys), self.keys, "left_semi")

    def _bounds(self, rows: DataFrame, range_column: str | None) -> tuple[int, object, object]:
        """How many rows a batch has, and its range."""
        bounds = [F.count("*").alias("n")]
        if range_column:
            bounds += [self._exact(F.min(range_column), range_column).alias("low"), self._exact(F.max(range_column), range_column).alias("high")]
        facts = rows.agg(*bounds).first()
        return (facts.n, facts.low, facts.high) if range_column else (facts.n, None, None)

    def _exact(self, value: Column, column: str) -> Column:
        """A value of a column as it comes to the driver and back: instants as numbers, as their spelling can be ambiguous."""
        instant = self.schema[column].dataType.typeName() == "timestamp"
        return F.unix_micros(value) if instant else value.cast("string")

    def _within(self, stored: DataFrame, column: str, low: int | str, high: int | str) -> DataFrame:
        kind = self.schema[column].dataType
        low, high = (F.timestamp_micros(F.lit(x)) if kind.typeName() == "timestamp" else F.lit(x).cast(kind) for x in (low, high))
        return stored.where(F.col(column).between(low, high))

    # -- writing -----------------------------------------------------------------------

    def _target(self, writer: str, batch_id: int) -> str:
        return f"{self.data}/writer={writer}/batch={batch_id}"

    def _empty(self) -> bool:
        return not self.fs.names(self.data)

    def _add(self, rows: DataFrame, writer: str, batch_id: int) -> None:
        blooms = {f"parquet.bloom.filter.enabled#{k}": "true" for k in self.keys if k not in self.parted_by}
        self._publish(rows, self._target(writer, batch_id), self.parted_by, **blooms, **{"parquet.bloom.filter.adaptive.enabled": "true"})
        self._announce(writer, batch_id)

    # -- catalog -----------------------------------------------------------------------

    def _announce(self, writer: str, batch_id: int) -> None:
        """Tell the catalog of a batch. Done again when a batch is replayed, as a run may have died before it."""
        if self.registered and self.parted_by:
            recover_partitions(self.spark, self.registered)
        elif self.registered:
            add_partition(self.spark, self.registered, {"writer": writer, "batch": batch_id})

    def register(self, name: str) -> None:
        """A lasting view of that name (``database.table``) over an external table of all batches.

        Batches are partitions of the external table, and each later batch adds its own, so every session that shares the
        catalog reads through the view what is stored at that moment.
        """
        table = f"{name}_batches"
        external_table(self.spark, table, self._stored_schema(), self.data, ["writer", "batch", *self.parted_by])
        self.registered = table
        lasting_view(self.spark, name, self._view_sql(table))

    def _view_sql(self, table: str) -> str:
        return f"SELECT {', '.join(self.columns)} FROM {table}"


class InsertTable(_Batches):
    """A keyed table that only ever gains rows: existing keys win over new ones.

    Its folders are append-only, so streams can read it directly.
    """

    def read(self) -> DataFrame:
        return self._stored().select(*self.columns)

    def insert_new(
        self, source: DataFrame, writer: str, batch_id: int,
        order: Sequence[Column | str] = (), range_column: str | None = None, keep: bool = True,
    ) -> bool:
        """Insert rows whose key is not in the table; of equal new keys the first in order.

        Columns the order leaves out break its ties.

        ``range_column`` names a key column along which the table's files are clustered, such
        as event time: the table scan then skips files outside the batch's range. ``keep`` caches
        the source for its passes; for a large load straight from files, reading it again
        costs less. Returns False if there was nothing to do.
        """
        if self.fs.exists(self._target(writer, batch_id)):
            self._announce(writer, batch_id)
            return False
        with _kept(self._conform(source), keep) as rows:
            n, low, high = self._bounds(rows, range_column)
            if n == 0:
                return False
            keyed, unkeyed = split_null_keys(rows, self.keys)
            ties = [F.col(c).asc_nulls_last() for c in self.columns if c not in self.keys]
            new = first_per_key(keyed, self.keys, [*order, *(ties or self.keys)])
            if not self._empty():
                known = self._asked(self.read().select(*self.keys), keyed, range_column, low, high)
                new = new.join(known, self.keys, "left_anti")
            self._add(new.unionByName(unkeyed), writer, batch_id)
        return True


class StateTable(_Batches):
    """A keyed table with updates, as the states that its rows took.

    A merge appends the new state of each row it inserts or changes, numbered by a version; a reader takes the latest state of
    each key. So a merge never rewrites what is stored, and the folders double as the table's change feed.
    """

    _EXTRA = (StructField(_VERSION, LongType()),)

    def read(self) -> DataFrame:
        return self._latest(self._stored()).select(*self.columns)

    def _latest(self, states: DataFrame) -> DataFrame:
        """One state of each key; rows with a null key match nothing and are all there."""
        keyed, unkeyed = split_null_keys(states, self.keys)
        return latest_per_key(keyed, self.keys, _VERSION, ties=[]).unionByName(unkeyed)

    def _view_sql(self, table: str) -> str:
        columns, keys = ", ".join(self.columns), ", ".join(self.keys)
        missing = " OR ".join(f"{k} IS NULL" for k in self.keys)
        return (
            f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {_VERSION} DESC) AS place"
            f" FROM {table} WHERE NOT ({missing})) WHERE place = 1"
            f" UNION ALL SELECT {columns} FROM {table} WHERE {missing}"
        )

    def merge(
        self, source: DataFrame, writer: str, batch_id: int, matched: Sequence[Clause],
        range_column: str | None = None, keep: bool = True,
    ) -> bool:
        """Update matched rows and insert the others, as ``strata.operators.merge.changed_rows`` says.

        A batch that is empty, or that the table already holds for this writer, changes nothing. ``range_column``
        and ``keep`` are as in ``InsertTable.insert_new``. Returns whether the source was used.
        """
        if self.fs.exists(self._target(writer, batch_id)):
            self._announce(writer, batch_id)
            return False
        with _kept(self._conform(source), keep) as rows:
            n, low, high = self._bounds(rows, range_column)
            if n == 0:
                return False
            stored = None
            if not self._empty():
                keyed, _ = split_null_keys(rows, self.keys)
                stored = self._latest(self._asked(self._stored(), keyed, range_column, low, high)).select(*self.columns)
            states = changed_rows(stored, rows, self.keys, matched)
            self._add(states.withColumn(_VERSION, F.lit(self._next_version()).cast("long")), writer, batch_id)
        return True

    def _next_version(self) -> int:
        """Batches are never removed, so their number grows with each."""
        return sum(len([b for b in self.fs.names(f"{self.data}/{w}") if b.startswith("batch=")]) for w in self.fs.names(self.data))
