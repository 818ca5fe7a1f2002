"""The register of queries and what they share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import run_folder, streaming_session
from strata.sources.files import stream_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function of (spark, folder) under its own name."""
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        QUERIES[fn.__name__] = run
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return run
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return stream_parquet(spark, f"{sf_dir}/{name}.parquet")


def events(df: DataFrame) -> DataFrame:
    """Events with an event time that watermarks accept; stored times carry no zone and are UTC."""
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the stored tables have them."""
    zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def rounded(df: DataFrame, *names: str, places: int = 4) -> DataFrame:
    """Sums and means to a precision that does not depend on the order of addition.

    Four places are one more than sums of the tables' values have. Means need more, or some
    would lie half way between two results, where engines differ.
    """
    return df.withColumns({n: F.round(n, places) for n in names})


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def in_batches(session: SparkSession, df: DataFrame, folder: str, loads: int = 4) -> DataFrame:
    """Land a table in parts and stream it back in about that many micro-batches, at any size."""
    part = F.pmod(F.xxhash64(*df.columns), F.lit(loads))
    df.withColumn("landing_part", part).write.partitionBy("landing_part").parquet(folder)
    files = len(session.read.parquet(folder).inputFiles())
    return stream_parquet(session, folder, files_per_trigger=-(-files // loads)).drop("landing_part")


def in_event_order(session: SparkSession, df: DataFrame, folder: str, at: str, loads: int = 4) -> DataFrame:
    """Land a table in loads that follow one another in event time, and stream it back load by load.

    Each load is as many files as a trigger takes, so micro-batches and loads are the same unless a load has
    fewer rows than files; batches then still follow one another.
    """
    files = max(1, session.sparkContext.defaultParallelism // 2)
    cuts = df.select(F.unix_micros(F.col(at).cast("timestamp")).alias("t")).agg(
        *[F.percentile_approx("t", i / loads) for i in range(1, loads)]).first()
    edges = [None, *[c for c in cuts if c is not None], None]
    time = F.unix_micros(F.col(at).cast("timestamp"))
    for low, high in zip(edges[:-1], edges[1:]):
        part = df.where((time > low if low is not None else F.lit(True)) & (time <= high if high is not None else F.lit(True)))
        part.repartition(files).write.mode("append").parquet(folder)
    return session.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(folder)


__all__ = [
    "ORACLES", "QUERIES", "events", "in_batches", "in_event_order", "plain_times", "query", "rounded", "run_folder",
    "streaming_session", "table", "table_stream", "text",
]
