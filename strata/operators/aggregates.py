"""Grouped and windowed aggregates. All are algebraic, so tasks pre-aggregate before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: reward points per unit of turnover.
POINTS_PER_UNIT = 0.2


def reward_points(
    invoices: DataFrame, customer: str = "CustomerCardNo", amount: str = "TotalAmount",
) -> DataFrame:
    """Turnover and points per customer."""
    return invoices.groupBy(F.col(customer).alias("CustomerCardNo")).agg(
        F.sum(amount).alias("TotalAmount"),
        F.sum(F.col(amount) * POINTS_PER_UNIT).alias("TotalPoints"),
    )


def split_by_type(
    trades: DataFrame, kind: str = "Type", amount: str = "Amount",
    buy: str = "BUY", sell: str = "SELL",
) -> DataFrame:
    """Adds ``Buy`` and ``Sell``: the amount in the column of its kind, zero in the other."""
    def when_kind(value: str) -> Column:
        return F.when(F.col(kind) == value, F.col(amount)).otherwise(F.lit(0.0))
    return trades.withColumns({"Buy": when_kind(buy), "Sell": when_kind(sell)})


def trade_totals(trades: DataFrame, ts: str = "CreatedTime", width: str = "15 minutes") -> DataFrame:
    """Buy and sell totals per tumbling window. On a stream with a watermark, windows behind it leave the state."""
    totals = trades.groupBy(F.window(ts, width)).agg(
        F.sum("Buy").alias("TotalBuy"), F.sum("Sell").alias("TotalSell"))
    return totals.select("window.start", "window.end", "TotalBuy", "TotalSell")


def reading_stats(
    readings: DataFrame, keys: Sequence[str], reading: str = "heartrate",
) -> DataFrame:
    """Least, mean and greatest reading and the number of non-null readings per key."""
    return readings.groupBy(*keys).agg(
        F.min(reading).alias("min_bpm"), F.avg(reading).alias("avg_bpm"),
        F.max(reading).alias("max_bpm"), F.count(reading).alias("num_recordings"),
    )
