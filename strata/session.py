"""Session settings and the shared folder that runs write to."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library runs with. None of them depends on the
# size of the machine; widths are derived from the cluster in build_session().
COMMON_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Queries that share an application share its cores by pool (``Job.pool``) instead of first come, first served.
# Read when the context starts, so a session that is only picked up keeps what it was started with.
CONTEXT_CONF = {"spark.scheduler.mode": "FAIR"}

# Keyed state lives in RocksDB (off heap, spills to disk) and uploads change logs
# instead of whole snapshots per batch, so state may outgrow executor memory.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# On a cluster, batch shuffles start with this many tasks per core and AQE coalesces them.
BATCH_TASKS_PER_CORE = 4
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(
    app_name: str = "strata",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a classic session with this library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        **CONTEXT_CONF,
        **COMMON_CONF,
        **STATE_CONF,
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    width = spark.sparkContext.defaultParallelism
    submitted = spark.sparkContext.getConf()
    # A width that was given, here or with spark-submit, is never overridden.
    if "spark.sql.shuffle.partitions" not in settings and not submitted.contains("spark.sql.shuffle.partitions"):
        spark.conf.set("spark.sql.shuffle.partitions", str(width))
        if _INITIAL not in settings and not submitted.contains(_INITIAL):
            spark.conf.set(_INITIAL, str(_batch_width(spark)))
    return spark


def _batch_width(spark: SparkSession) -> int:
    """Partitions a batch shuffle starts with, for AQE to coalesce."""
    context = spark.sparkContext
    per_core = 1 if context.master.startswith("local") else BATCH_TASKS_PER_CORE
    return context.defaultParallelism * per_core


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session set up for stateful queries, leaving the caller's settings alone.

    The number of state partitions is fixed by the first run of a checkpoint, so it
    follows the cluster width unless it is given.
    """
    session = spark.newSession()
    submitted = spark.sparkContext.getConf()
    given = submitted.get("spark.sql.shuffle.partitions")
    width = state_partitions or int(given or spark.sparkContext.defaultParallelism)
    for key, value in {**COMMON_CONF, **STATE_CONF}.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", str(width))
    if not submitted.contains(_INITIAL):
        session.conf.set(_INITIAL, str(max(width, _batch_width(spark))))
    return session


@functools.lru_cache(maxsize=None)
def _local_test_root() -> str:
    return tempfile.mkdtemp(prefix="strata-")


def shared_root(spark: SparkSession) -> str:
    """Folder that driver and executors share, as named by ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_test_root()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared root; no two calls return the same one."""
    return f"{shared_root(spark)}/strata/{name}-{uuid.uuid4().hex}"
