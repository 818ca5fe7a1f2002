"""One row per key, by a declared order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key in the given order. Batch (or inside foreachBatch) only.

    Ranking with a limit of one lets Catalyst cut every task's rows to one per key before
    the shuffle, so a key that holds much of the input still costs one row per task.
    Give an order that leaves no ties: all rows of a key but one are dropped.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[Column | str] | None = None,
) -> DataFrame:
    """The row with the greatest ``by`` of every key; equal times fall to the tie order.

    Without a tie order all other columns decide, so the choice does not depend on row order.
    """
    if ties is None:
        ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys and c != by]
    return first_per_key(df, keys, [F.col(by).desc_nulls_last(), *ties])


# Change types that carry a new state of the row.
CHANGE_TYPES = ["new", "update"]


def latest_changes(changes: DataFrame, keys: Sequence[str], by: str, kind: str = "update_type") -> DataFrame:
    """The newest applicable change of every key, without the change type."""
    applicable = changes.where(F.col(kind).isin(CHANGE_TYPES)).drop(kind)
    return latest_per_key(applicable, keys, by)
