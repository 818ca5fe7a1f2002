"""Message log as a source. The connector itself comes with the cluster."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class LogConnection:
    """Broker address and, where the broker asks for it, a user; passed in, never looked up."""

    servers: str
    protocol: str | None = None
    mechanism: str | None = None
    user: str | None = None
    password: str | None = None

    # Fixed value: login module class of the client library.
    LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"

    def options(self) -> dict[str, str]:
        found = {"kafka.bootstrap.servers": self.servers}
        if self.protocol:
            found["kafka.security.protocol"] = self.protocol
        if self.mechanism:
            found["kafka.sasl.mechanism"] = self.mechanism
        if self.user is not None:
            found["kafka.sasl.jaas.config"] = (
                f"{self.LOGIN_MODULE} required username='{self.user}' password='{self.password or ''}';")
        return found


def log_source_options(
    connection: LogConnection, topic: str,
    max_offsets_per_trigger: int | None = None, starting_timestamp: int | None = None,
) -> dict[str, str]:
    options = {**connection.options(), "subscribe": topic}
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if starting_timestamp is not None:
        options["startingTimestamp"] = str(starting_timestamp)
    return options


def stream_log(
    spark: SparkSession, connection: LogConnection, topic: str,
    max_offsets_per_trigger: int | None = None, starting_timestamp: int | None = None,
) -> DataFrame:
    options = log_source_options(connection, topic, max_offsets_per_trigger, starting_timestamp)
    return spark.readStream.format("kafka").options(**options).load()


def read_log(spark: SparkSession, connection: LogConnection, topic: str) -> DataFrame:
    """All messages of a topic as a static table."""
    return spark.read.format("kafka").options(**log_source_options(connection, topic)).load()
