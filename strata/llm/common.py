"""What the operators of this folder share: tables, stage tables in the shared folder, links and components."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import run_folder
from strata.sources.fs import SharedFs

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Ids that a task joins before it passes them on.
HELD_IDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores behind it as it takes to be none of the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


class Stages:
    """Intermediate tables below ``spark.checkpoint.dir``.

    A written table cuts the lineage and outlives lost executors; a lost shuffle is recomputed from it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = run_folder(spark, name)
        self._fs = SharedFs(spark, self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write and read again; the shuffle files behind the table go at once, as nothing needs them any more."""
        path, conf = f"{self.root}/{name}", self.spark.conf
        before = conf.get(_CLEANUP, "false")
        conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            conf.set(_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete stage tables that nothing reads any more."""
        for name in names:
            self._fs.delete(f"{self.root}/{name}")


def shuffle_width(spark: SparkSession, units: int, per_task: int, least: int | None = None) -> int:
    """Tasks for ``units`` of work: as many as the session shuffles with, or more where a task would get too much."""
    floor = least or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, -(-units // per_task))


def _contracted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of a task, a forest at a time: each id with the smallest id that it is joined to so far."""
    parent: dict = {}

    def root(x):
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    def out():
        rows = [(x, root(x)) for x in list(parent)]
        parent.clear()
        return pd.DataFrame([(a, b) for a, b in rows if a != b], columns=["a", "b"], dtype=object)

    for frame in frames:
        for a, b in zip(frame["a"].to_numpy(), frame["b"].to_numpy(), strict=True):
            p, q = root(a), root(b)
            if p != q:
                parent[max(p, q)] = min(p, q)
        if len(parent) > HELD_IDS:
            yield out()
    yield out()


def components(links: DataFrame, stages: Stages, name: str) -> DataFrame:
    """(id, component) of every id in ``links(a, b)``; the component is the smallest id that links reach.

    Tasks first join what their own links join, in bounded memory, which leaves short chains. Then the
    large-star and small-star steps of connected components on MapReduce alternate until every
    id has one link, to an id without one: the number of links never grows, and each round is
    written to the shared folder. Hot ids are no group in one task: the least neighbour is a
    combined aggregate, and it is joined back.
    """
    kind = links.schema["a"].dataType.simpleString()
    current = stages.keep(links.select("a", "b").mapInPandas(_contracted, f"a {kind}, b {kind}").distinct(), f"{name}-0")
    step = 0
    while _chained(current):
        step += 1
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = stages.keep(
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(),
            f"{name}-{step}-large",
        )
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = stages.keep(
            large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(smallest.select("a", F.col("m").alias("b"))).where("a <> b").distinct(),
            f"{name}-{step}",
        )
        stages.drop(f"{name}-{step}-large", f"{name}-{step - 1}")
        current = small
    roots = current.select(F.col("b").alias("id")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots.select("id", F.col("id").alias("component")))


def _chained(links: DataFrame) -> bool:
    """Whether an id has two links to smaller ids, or one and is itself linked to."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("b", F.lit(0), F.lit(1)))
    met = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not met.where("up > 1 or up = 1 and down = 1").isEmpty()
