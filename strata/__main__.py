"""Run a workload: spark-submit ... -m strata, or python -m strata <workload> --help."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from strata.operators.joins import REPORT_ORDER
from strata.plans.invoices import (
    InvoiceFolders, flatten, ingest, ingest_messages, message_table, rewards_additive, rewards_complete, rewards_replace,
    rewards_table, send_invoices, store_decoded, stream_bronze, stream_line_items,
)
from strata.plans.trades import TOTALS, stream_trade_summary
from strata.plans.words import COUNTS, batch_word_count, stream_word_count
from strata.plans.workouts import Gym
from strata.schemas import TABLES
from strata.session import build_session
from strata.sinks.staged import SnapshotTable
from strata.sources.log import LogConnection, stream_log
from strata.streaming.jobs import Job, await_all, run_stages


def words(spark: SparkSession, args) -> DataFrame:
    if args.table:
        return batch_word_count(spark, args.input, args.table)
    counts = SnapshotTable(spark, f"{args.root}/word_counts", COUNTS)
    await_all([stream_word_count(spark, args.input, counts, _job(args, "word_counts"))])
    return counts.read()


def line_items(spark: SparkSession, args) -> DataFrame:
    await_all([stream_line_items(spark, args.input, args.table, _job(args, "line_items"), args.files_per_trigger)])
    return spark.table(args.table)


def invoices(spark: SparkSession, args) -> DataFrame:
    folders = _invoice_folders(args)
    started = run_stages([
        [lambda: ingest(spark, folders, args.every, args.clean_source, args.archive_to, args.files_per_trigger)],
        [lambda: flatten(spark, folders, args.every)],
    ], once=args.every is None)
    await_all(started)
    return spark.read.parquet(folders.silver)


def rewards(spark: SparkSession, args) -> DataFrame:
    folders = _invoice_folders(args)
    await_all([ingest(spark, folders)])
    bronze, job = stream_bronze(spark, folders), _job(args, f"rewards_{args.mode}")
    root = f"{args.root}/rewards_{args.mode}"
    if args.mode == "complete":
        table = SnapshotTable(spark, root, TABLES["customer_rewards"])
        query = rewards_complete(bronze, table, job)
    else:
        table = rewards_table(spark, root)
        query = (rewards_replace if args.mode == "replace" else rewards_additive)(bronze, table, job)
    await_all([query])
    return table.read()


def consume(spark: SparkSession, args) -> DataFrame:
    """A log topic of invoices, decoded and appended as it comes."""
    log = stream_log(spark, _connection(args), args.topic, args.offsets_per_trigger)
    await_all([store_decoded(log, f"{args.root}/messages", _job(args, "messages"))])
    return spark.read.parquet(f"{args.root}/messages")


def ingest_log(spark: SparkSession, args) -> DataFrame:
    """A log topic as it is, each message once by its position."""
    table = message_table(spark, f"{args.root}/messages_by_position")
    log = stream_log(spark, _connection(args), args.topic, args.offsets_per_trigger)
    await_all([ingest_messages(log, table, _job(args, "messages_by_position"))])
    return table.read()


def produce(spark: SparkSession, args) -> DataFrame:
    """Chosen invoices of the landing files to a log topic."""
    query = send_invoices(spark, args.input, args.where, _connection(args), args.topic, f"{args.root}/checkpoint/produce")
    await_all([query])
    return spark.createDataFrame([(args.topic,)], "topic string")


def trades(spark: SparkSession, args) -> DataFrame:
    messages = spark.readStream.schema("value string").parquet(args.input)
    totals = SnapshotTable(spark, f"{args.root}/trade_summary", TOTALS)
    await_all([stream_trade_summary(messages, totals, _job(args, "trade_summary"))])
    return totals.read()


def gym(spark: SparkSession, args) -> DataFrame:
    plan = Gym(spark, args.input, args.root, every=args.every, files_per_trigger=args.files_per_trigger,
               database=args.database)
    if args.dates:
        plan.load_dates(args.dates)
    await_all(plan.run())
    return plan.gym_summary().orderBy(*REPORT_ORDER)


def _job(args, name: str) -> Job:
    return Job(name, f"{args.root}/checkpoint/{name}", args.every)


def _connection(args) -> LogConnection:
    """The password comes from a file, so that no command line shows it."""
    password = Path(args.password_file).read_text().strip() if args.password_file else None
    return LogConnection(args.servers, args.protocol, args.mechanism, args.user, password)


def _invoice_folders(args) -> InvoiceFolders:
    return InvoiceFolders(
        args.input, f"{args.root}/invoices_bronze", f"{args.root}/invoices_silver", f"{args.root}/checkpoint")


WORKLOADS = {f.__name__: f for f in (words, line_items, invoices, rewards, consume, ingest_log, produce, trades, gym)}
FROM_LOG, WITH_LOG = ("consume", "ingest_log"), ("consume", "ingest_log", "produce")


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="strata", description=__doc__)
    parser.add_argument("workload", choices=WORKLOADS)
    parser.add_argument("--input", help="landing folder, glob or stored messages; needed by all that do not read a log")
    parser.add_argument("--root", help="folder for tables and checkpoints")
    parser.add_argument("--table", help="managed table for the result (words in batch, line_items)")
    parser.add_argument("--every", help="keep running at this interval; default: all there is, once")
    parser.add_argument("--mode", choices=["complete", "replace", "additive"], default="replace", help="rewards")
    parser.add_argument("--database", help="names the tables and the report in the catalog (gym)")
    parser.add_argument("--files-per-trigger", type=int)
    parser.add_argument("--clean-source", choices=["off", "delete", "archive"], default="off", help="invoices")
    parser.add_argument("--archive-to", help="archive folder for --clean-source archive")
    parser.add_argument("--dates", help="JSON date lookup to load first (gym)")
    parser.add_argument("--servers", help="broker addresses (consume, ingest_log, produce)")
    parser.add_argument("--topic", help="log topic (consume, ingest_log, produce)")
    parser.add_argument("--protocol")
    parser.add_argument("--mechanism")
    parser.add_argument("--user")
    parser.add_argument("--password-file", help="file that holds the user's password")
    parser.add_argument("--offsets-per-trigger", type=int)
    parser.add_argument("--where", default="true", help="SQL condition on the invoices to send (produce)")
    args = parser.parse_args(argv)
    if args.input is None and args.workload not in FROM_LOG:
        parser.error("--input is needed")
    if args.workload in WITH_LOG and not (args.servers and args.topic):
        parser.error("--servers and --topic are needed")
    if args.root is None and not (args.workload == "words" and args.table):
        parser.error("--root is needed for all but words into a table")
    if args.workload == "line_items" and not args.table:
        parser.error("line_items needs --table")
    return args


def run(spark: SparkSession, argv: list[str] | None = None) -> DataFrame:
    args = parse(argv)
    return WORKLOADS[args.workload](spark, args)


if __name__ == "__main__":
    run(build_session()).show()
