"""Message log as a sink. The connector itself comes with the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from strata.operators.messages import encode_log
from strata.sources.log import LogConnection


def log_writer(
    df: DataFrame, key: str, connection: LogConnection, topic: str, checkpoint: str,
) -> DataStreamWriter:
    """A stream writer that sends every row as a JSON message under the given key."""
    return (
        encode_log(df, key).writeStream.format("kafka")
        .options(**log_sink_options(connection, topic, checkpoint)).outputMode("append")
    )


def log_sink_options(connection: LogConnection, topic: str, checkpoint: str) -> dict[str, str]:
    return {**connection.options(), "topic": topic, "checkpointLocation": checkpoint}
