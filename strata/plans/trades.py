"""Buy and sell totals per quarter of an hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.temporal import parse_timestamp
from strata.operators.aggregates import split_by_type, trade_totals
from strata.operators.messages import payload
from strata.schemas import TRADE
from strata.sinks.staged import SET_ALL, SnapshotTable, StateTable
from strata.streaming.jobs import Job, replace_snapshot, upsert
from strata.streaming.state import LATENESS, watermarked

TOTALS = "start timestamp, end timestamp, TotalBuy double, TotalSell double"


def trades_of(messages: DataFrame) -> DataFrame:
    """Trade payloads with parsed time and their amount split by type."""
    trades = payload(messages, TRADE)
    return split_by_type(trades.withColumn("CreatedTime", parse_timestamp(F.col("CreatedTime"))))


def trade_summary(messages: DataFrame) -> DataFrame:
    return trade_totals(trades_of(messages))


def stream_trade_summary(messages: DataFrame, table: SnapshotTable, job: Job) -> StreamingQuery:
    """All windows, rewritten by every batch; the query's state holds each window for good."""
    return replace_snapshot(trade_summary(messages), table, job)


def totals_table(spark: SparkSession, root: str) -> StateTable:
    return StateTable(spark, root, TOTALS, ["start"])


def stream_trade_updates(messages: DataFrame, table: StateTable, job: Job, lateness: str = LATENESS) -> StreamingQuery:
    """Windows as they change: a batch writes those it touched, and the state lets go of windows behind the watermark.

    A window's new total takes the place of the old one, so that a batch that is run again changes nothing.
    """
    trades = watermarked(trades_of(messages), "CreatedTime", lateness)
    return upsert(trade_totals(trades), table, job, [(None, SET_ALL)], range_column="start")
