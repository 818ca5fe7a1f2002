"""Word frequencies of text files, as a batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.operators.text import word_count
from strata.sinks.catalog import save_table
from strata.sinks.staged import SnapshotTable
from strata.sources.files import read_text, stream_text
from strata.streaming.jobs import Job, replace_snapshot

COUNTS = "word string, count bigint"


def batch_word_count(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Counts over all files of a path; saved under a table name if one is given."""
    counts = word_count(read_text(spark, path))
    if table is None:
        return counts
    save_table(counts, table)
    return spark.table(table)


def stream_word_count(spark: SparkSession, path: str, table: SnapshotTable, job: Job) -> StreamingQuery:
    """Counts over all files seen so far, replaced as files arrive."""
    return replace_snapshot(word_count(stream_text(spark, path)), table, job)
