"""Streaming writes: one description per query, one way to start each kind of sink."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from strata.sinks.staged import Clause, InsertTable, SnapshotTable, StateTable
from strata.streaming.progress import totals, watch


@dataclass(frozen=True)
class Job:
    """What a streaming query needs besides its rows. Every query has its own checkpoint."""

    name: str
    checkpoint: str
    every: str | None = None  # processing-time interval; None: all that is there, then stop
    pool: str | None = None   # scheduler pool to run in

    def writer(self, df: DataFrame, mode: str) -> DataStreamWriter:
        # Set for each job, to None too: else a job would run in the pool of the one started before it.
        df.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", self.pool)
        watch(df.sparkSession)
        writer = df.writeStream.queryName(self.name).outputMode(mode)
        writer = writer.option("checkpointLocation", self.checkpoint)
        return writer.trigger(processingTime=self.every) if self.every else writer.trigger(availableNow=True)


def writer_id(spark: SparkSession) -> str:
    """Identity of the running query: it lives in the checkpoint, so a restart keeps it."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def append_to_path(df: DataFrame, path: str, job: Job, partition_by: Sequence[str] = ()) -> StreamingQuery:
    writer = job.writer(df, "append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def append_to_table(df: DataFrame, table: str, job: Job, provider: str = "parquet") -> StreamingQuery:
    return job.writer(df, "append").format(provider).toTable(table)


def for_each_batch(
    df: DataFrame, action: Callable[[DataFrame, int], None], job: Job, mode: str = "append",
) -> StreamingQuery:
    """Hand every micro-batch to ``action(rows, batch_id)`` as a static DataFrame."""
    def adaptive(rows: DataFrame, batch_id: int) -> None:
        # Stateful queries run with adaptive execution off, and hand that setting down to what
        # is done with their batches. That work is plain batch work, so it gets it back.
        conf = rows.sparkSession.conf
        before = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "true")
        try:
            action(rows, batch_id)
        finally:
            conf.set("spark.sql.adaptive.enabled", before)
    return job.writer(df, mode).foreachBatch(adaptive).start()


def _settle(written: bool, rows: DataFrame) -> None:
    """A batch that the table already holds still has to run, or the query's state misses it."""
    if not written:
        rows.count()


def replace_snapshot(df: DataFrame, table: SnapshotTable, job: Job) -> StreamingQuery:
    """Complete output: every batch replaces the table."""
    def replace(rows: DataFrame, batch_id: int) -> None:
        _settle(table.replace(rows, writer_id(rows.sparkSession), batch_id), rows)
    return for_each_batch(df, replace, job, "complete")


def insert_new(
    df: DataFrame, table: InsertTable, job: Job, order: Sequence = (), range_column: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows, mode: str = "append", keep: bool = True,
) -> StreamingQuery:
    """Insert each batch's rows whose key is new. ``prepare`` shapes the batch first; static
    tables it joins are read as they stand at that moment.

    What Catalyst knows of a batch's size is the size of its input, not of what state adds to it. A ``prepare`` that joins rows
    that come out of state says how, by a hint, or they may be broadcast however many they are."""
    def insert(rows: DataFrame, batch_id: int) -> None:
        _settle(table.insert_new(prepare(rows), writer_id(rows.sparkSession), batch_id, order, range_column, keep), rows)
    return for_each_batch(df, insert, job, mode)


def upsert(
    df: DataFrame, table: StateTable, job: Job, matched: Sequence[Clause],
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows, mode: str = "update", range_column: str | None = None,
    keep: bool = True,
) -> StreamingQuery:
    """Merge each batch into the table. ``prepare`` shapes the batch first, such as to one row per key.

    ``keep`` caches a batch for its passes, here and in ``insert_new``; for a large first load leave it out."""
    def merge(rows: DataFrame, batch_id: int) -> None:
        _settle(table.merge(prepare(rows), writer_id(rows.sparkSession), batch_id, matched, range_column, keep), rows)
    return for_each_batch(df, merge, job, mode)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query dropped as late, in all its micro-batches."""
    return totals(query).late


def await_all(queries: Iterable[StreamingQuery]) -> dict[str, int]:
    """Wait for the given queries; the first failure stops the others and is raised.

    Returns the rows that each query dropped as late, which are not in its result.
    """
    queries = list(queries)
    try:
        for query in queries:
            query.awaitTermination()
    except Exception:
        for query in queries:
            if query.isActive:
                query.stop()
        raise
    return {query.name: late_rows(query) for query in queries}


Stage = Sequence[Callable[[], StreamingQuery]]


def run_stages(stages: Sequence[Stage], once: bool = True) -> list[StreamingQuery]:
    """Start the queries of each stage together; when run once, a stage ends before the next begins."""
    started: list[StreamingQuery] = []
    for stage in stages:
        running = [start() for start in stage]
        started += running
        if once:
            await_all(running)
    return started
