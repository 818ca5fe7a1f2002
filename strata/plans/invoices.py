"""Invoices: line items from nested records, raw message ingest, customer rewards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.aggregates import reward_points
from strata.operators.latest import first_per_key
from strata.operators.messages import decode_log, text_log, where
from strata.operators.nested import line_items
from strata.schemas import INVOICE, TABLES
from strata.sinks.staged import SET_ALL, InsertTable, SnapshotTable, StateTable
from strata.sources.files import stream_files, with_source_file
from strata.sources.log import LogConnection
from strata.sinks.log import log_writer
from strata.streaming.jobs import Job, append_to_path, append_to_table, insert_new, replace_snapshot, upsert

REWARD_KEY = ["CustomerCardNo"]

# What identifies a message. CONTENT_KEY also treats equal messages of a topic as one.
POSITION_KEY = ["topic", "partition", "offset"]
CONTENT_KEY = ["value", "timestamp"]


@dataclass(frozen=True)
class InvoiceFolders:
    landing: str
    bronze: str
    silver: str
    checkpoints: str


def stream_line_items(spark: SparkSession, path: str, table: str, job: Job,
                      files_per_trigger: int | None = None) -> StreamingQuery:
    """Invoice files straight to a table of line items."""
    invoices = stream_files(spark, "json", path, INVOICE, files_per_trigger)
    return append_to_table(line_items(invoices), table, job)


def ingest(spark: SparkSession, folders: InvoiceFolders, every: str | None = None,
           clean_source: str = "off", archive_to: str | None = None,
           files_per_trigger: int | None = None) -> StreamingQuery:
    """Bronze: invoice files as they are, with the file each came from."""
    invoices = with_source_file(stream_files(
        spark, "json", folders.landing, INVOICE, files_per_trigger, clean_source, archive_to))
    job = Job("invoices_bronze", f"{folders.checkpoints}/invoices_bronze", every)
    return append_to_path(invoices, folders.bronze, job)


def stream_bronze(spark: SparkSession, folders: InvoiceFolders) -> DataFrame:
    return spark.readStream.schema(f"{INVOICE}, InputFile string").parquet(folders.bronze)


def flatten(spark: SparkSession, folders: InvoiceFolders, every: str | None = None) -> StreamingQuery:
    """Silver: line items of the bronze rows."""
    job = Job("invoices_silver", f"{folders.checkpoints}/invoices_silver", every)
    return append_to_path(line_items(stream_bronze(spark, folders)), folders.silver, job)


# -- raw message ingest ----------------------------------------------------------------


def message_table(spark: SparkSession, root: str, key: list[str] | None = None) -> InsertTable | StateTable:
    """A table that holds each message once.

    Messages of one position are the same message, so by position nothing is ever updated. By content, a repeated
    message takes the place of the stored one. By position, files are parted by topic and partition, so that a batch looks up
    its own ones only.
    """
    key, schema = key or POSITION_KEY, TABLES["invoice_messages"]
    if key == POSITION_KEY:
        return InsertTable(spark, root, schema, key, parted_by=["topic", "partition"])
    return StateTable(spark, root, schema, key)


def store_decoded(log: DataFrame, path: str, job: Job, schema: str = INVOICE) -> StreamingQuery:
    """Log records with their decoded payload, appended as they come, each as often as it is delivered."""
    return append_to_path(decode_log(log, schema), path, job)


def ingest_messages(log: DataFrame, table: InsertTable | StateTable, job: Job) -> StreamingQuery:
    """Log records into a message table, however often they are delivered."""
    others = [c for c in table.columns if c not in table.keys]
    order = [F.col(c).asc_nulls_last() for c in others]
    if isinstance(table, InsertTable):
        return insert_new(text_log(log), table, job, order, range_column="offset")

    def once(rows: DataFrame) -> DataFrame:
        return first_per_key(rows, table.keys, order)

    time = "timestamp" if "timestamp" in table.keys else None
    return upsert(text_log(log), table, job, [(None, SET_ALL)], prepare=once, mode="append", range_column=time)


def send_invoices(spark: SparkSession, path: str, condition: str, connection: LogConnection,
                  topic: str, checkpoint: str) -> StreamingQuery:
    """Chosen invoices of the landing files to a message log, keyed by store."""
    invoices = where(stream_files(spark, "json", path, INVOICE), condition)
    return log_writer(invoices, "StoreID", connection, topic, checkpoint).start()


# -- customer rewards ------------------------------------------------------------------


def rewards_table(spark: SparkSession, root: str) -> StateTable:
    return StateTable(spark, root, TABLES["customer_rewards"], REWARD_KEY)


def rewards_complete(invoices: DataFrame, table: SnapshotTable, job: Job) -> StreamingQuery:
    """All totals, rewritten by every batch."""
    return replace_snapshot(reward_points(invoices), table, job)


def rewards_replace(invoices: DataFrame, table: StateTable, job: Job) -> StreamingQuery:
    """Totals kept in query state; a batch writes the new totals of the customers it touched."""
    replace = [(None, {"TotalAmount": "s.TotalAmount", "TotalPoints": "s.TotalPoints"})]
    return upsert(reward_points(invoices), table, job, replace)


def rewards_additive(invoices: DataFrame, table: StateTable, job: Job) -> StreamingQuery:
    """Totals kept in the table only: each batch's own sums are added to it, once per batch."""
    add = [(None, {
        "TotalAmount": "coalesce(t.TotalAmount + s.TotalAmount, t.TotalAmount, s.TotalAmount)",
        "TotalPoints": "coalesce(t.TotalPoints + s.TotalPoints, t.TotalPoints, s.TotalPoints)",
    })]
    return upsert(invoices, table, job, add, prepare=reward_points, mode="append")
