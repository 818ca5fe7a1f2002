"""Near-duplicate vectors: a range join in each block of a rotated space, and exact cosines of what passes one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Stages, components

#: Blocks that the rotated space is split into.
BLOCKS = 4
#: Vectors of one side of a tile; a tile holds two such sides.
SIDE = 8192
_SUB, _PAIRS = 1024, 50_000
_SLACK = 1e-12


def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix, so that no block holds less of a difference for reasons of the data."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def rotated(vectors: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Unit vectors in the rotated space; each row by the same operations in the same order, whatever rows are beside it."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    squares = np.zeros(len(scaled))
    out = np.zeros_like(scaled)
    for j in range(scaled.shape[1]):
        squares += scaled[:, j] ** 2
        out += scaled[:, j:j + 1] * turn[j]
    return out / np.sqrt(squares)[:, None]


def _edges(dim: int, blocks: int) -> np.ndarray:
    return np.linspace(0, dim, min(blocks, dim) + 1).astype(int)


def _square(diff: np.ndarray) -> np.ndarray:
    out = np.zeros(len(diff))
    for j in range(diff.shape[1]):
        out += diff[:, j] ** 2
    return out


def matched(left: np.ndarray, right: np.ndarray, given: tuple[np.ndarray, np.ndarray], block: int, edges: np.ndarray,
            budget: float, least: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two sides with a cosine of ``least`` or more that this block is the first to pass.

    The block's share of the squared distance decides in single precision with a margin; in double
    precision then the earlier blocks and the cosine, which is that of the vectors as ``given``. With ``same``, both sides are one, and the left index is the smaller.
    """
    share = budget * np.diff(edges) / edges[-1]
    lengths = [np.sqrt(np.einsum("ij,ij->i", x, x)) for x in given]
    at = slice(edges[block], edges[block + 1])
    a32, b32 = left[:, at].astype(np.float32), right[:, at].astype(np.float32)
    a2, b2 = (a32 * a32).sum(axis=1), (b32 * b32).sum(axis=1)
    # One product gives the squared distances: with the squares as two more columns of each side.
    a32 = np.column_stack((-2 * a32, a2, np.ones_like(a2)))
    b32 = np.column_stack((b32, np.ones_like(b2), b2))
    limit = np.float32(share[block] + 1e-5)
    for i in range(0, len(left), _SUB):
        for j in range(i if same else 0, len(right), _SUB):
            near = a32[i:i + _SUB] @ b32[j:j + _SUB].T
            hit = np.flatnonzero(near.min(axis=1) <= limit)  # few rows have any
            x, y = np.nonzero(near[hit] <= limit)
            x, y = hit[x] + i, y + j
            if same:
                x, y = x[x < y], y[x < y]
            for start in range(0, len(x), _PAIRS):
                p, q = x[start:start + _PAIRS], y[start:start + _PAIRS]
                one, two = left[p], right[q]
                diff = one - two
                good = np.ones(len(p), dtype=bool)
                for k in range(block + 1):
                    inside = _square(diff[:, edges[k]:edges[k + 1]]) <= share[k] + _SLACK
                    good &= inside if k == block else ~inside
                good &= np.einsum("ij,ij->i", given[0][p], given[1][q]) / (lengths[0][p] * lengths[1][q]) >= least
                if good.any():
                    yield p[good], q[good]


def _joined(labels: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Merge the labels of linked rows until links have one label at both ends."""
    while True:
        low = np.minimum(labels[p], labels[q])
        if (labels[p] == low).all() and (labels[q] == low).all():
            return
        np.minimum.at(labels, labels[p], low)
        np.minimum.at(labels, labels[q], low)
        np.minimum.at(labels, p, low)
        np.minimum.at(labels, q, low)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def near_vectors(vectors: DataFrame, least: float = 0.9, blocks: int = BLOCKS, side: int = SIDE,
                 vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, n_links, component_id, kept) for every row: vectors linked by a cosine of ``least`` or more.

    Null, empty and zero vectors and those with null or non-finite components link with nothing, nor do vectors of
    different lengths or rows without a key. ``component_id`` is the smallest key that links reach. Rows
    that repeat a key are one vector (the smallest of theirs) and get its result. Other columns are not used.

    Unit vectors are rotated and split into blocks. Of a pair within the squared distance 2 - 2 * least, some block
    holds no more than its share of it, so the union of the blocks' range joins has every pair; one
    counts where its first such block finds it. Within a block, vectors are filed into slabs of the
    leading coordinate as wide as the block's radius: only equal and neighbouring slabs meet. Slabs are cut
    into sides of bounded size by a hash of the key, so no tile grows with a slab or a group of copies.
    A tile gives one row for each of its vectors, not for each pair: the number of links and the tile's component.
    Equal vectors are one class with a weight.
    """
    spark = vectors.sparkSession
    stages = Stages(spark, "embeddings")
    budget = 2 - 2 * least
    own = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    usable = own.where(
        "id is not null and size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(vec, x -> x <> 0)"
    )
    usable = usable.groupBy("id").agg(F.min("vec").alias("vec"))
    usable = stages.keep(usable.withColumns({"one": F.xxhash64("vec"), "two": F.xxhash64(F.lit(1), "vec")}), "usable")
    classes = stages.keep(usable.groupBy("one", "two").agg(F.min("id").alias("rep"), F.count("*").alias("weight")), "classes")
    members = stages.keep(usable.join(classes, ["one", "two"]), "members")
    reps = members.where("id = rep").select("id", "weight", "vec", F.size("vec").alias("dim"))
    dims = [r[0] for r in reps.select("dim").distinct().orderBy("dim").collect()]  # lengths of vectors, not vectors
    turns = {dim: rotation(dim) for dim in dims}
    kind = vectors.schema[key].dataType.simpleString()

    def filed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, group in frame.groupby("dim"):
                raw = np.stack(group["vec"].to_numpy()).astype(float)
                turned = rotated(raw, turns[dim])
                edges = _edges(dim, blocks)
                for block in range(len(edges) - 1):
                    width = np.sqrt(budget * (edges[block + 1] - edges[block]) / dim) * (1 + 1e-9)
                    yield pd.DataFrame({
                        "id": group["id"], "weight": group["weight"], "dim": dim, "block": block,
                        "slab": np.floor(turned[:, edges[block]] / width).astype(np.int32),
                    })

    slabs = stages.keep(
        reps.mapInPandas(filed, f"id {kind}, weight bigint, dim int, block int, slab int"), "slabs"
    )
    # At most 2 / width slabs for each block and length of vectors.
    sides = slabs.groupBy("dim", "block", "slab").agg(F.ceil(F.count("*") / F.lit(side)).cast("int").alias("sides"))
    sides = stages.keep(sides, "sides")
    placed = slabs.join(F.broadcast(sides), ["dim", "block", "slab"]).withColumn(
        "part", F.pmod(F.xxhash64("id"), "sides").cast("int")
    )
    other = sides.select("dim", "block", F.col("slab").alias("slab2"), F.col("sides").alias("sides2"))
    near = (F.col("p.dim") == F.col("o.dim")) & (F.col("p.block") == F.col("o.block")) & (F.abs(F.col("slab") - F.col("slab2")) <= 1)
    tiles = (
        placed.alias("p").join(F.broadcast(other).alias("o"), near)
        .select("p.dim", "p.block", "id", "weight", F.struct("slab", "part").alias("mine"), "slab2",
                F.explode(F.sequence(F.lit(0), F.col("sides2") - 1)).alias("part2"))
        .withColumn("theirs", F.struct(F.col("slab2").alias("slab"), F.col("part2").alias("part")))
        .select("dim", "block", "id", "weight", F.least("mine", "theirs").alias("low"), F.greatest("mine", "theirs").alias("high"),
                (F.col("mine") > F.col("theirs")).alias("right"))
        .join(reps.select("id", "vec"), "id")
        .select("id", "weight", "dim", "block", "right", "vec",
                F.concat_ws(":", "low.slab", "low.part", "high.slab", "high.part").alias("tile"))
    )

    def linked(frame: pd.DataFrame) -> pd.DataFrame:
        dim, block = int(frame["dim"].iloc[0]), int(frame["block"].iloc[0])
        frame = frame.sort_values("id", ignore_index=True)
        raw = np.stack(frame["vec"].to_numpy()).astype(float)
        turned = rotated(raw, turns[dim])
        raw /= np.exp2(np.floor(np.log2(np.abs(raw).max(axis=1, keepdims=True))))  # by powers of two, which is exact
        right = frame["right"].to_numpy()
        ids, weights = frame["id"].to_numpy(), frame["weight"].to_numpy()
        sides_of = frame["tile"].iloc[0].split(":")
        same = sides_of[:2] == sides_of[2:]
        one = np.arange(len(frame)) if same else np.flatnonzero(~right)
        two = one if same else np.flatnonzero(right)
        counts, labels = np.zeros(len(frame), dtype=np.int64), np.arange(len(frame))
        for p, q in matched(turned[one], turned[two], (raw[one], raw[two]), block, _edges(dim, blocks), budget, least, same):
            p, q = one[p], two[q]
            np.add.at(counts, p, weights[q])
            np.add.at(counts, q, weights[p])
            _joined(labels, p, q)
        at = np.flatnonzero(counts)
        return pd.DataFrame({"id": ids[at], "n": counts[at], "least": ids[labels[at]]})

    found = stages.keep(
        tiles.groupBy("dim", "block", "tile").applyInPandas(linked, f"id {kind}, n bigint, least {kind}"), "found"
    )
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")), stages, "groups")
    judged = counts.join(groups, "id", "left").select(F.col("id").alias("rep"), "n", "component")
    result = members.select("id", "rep", "weight").join(judged, "rep", "left").select(
        F.col("id").alias("member"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"),
        F.coalesce("component", "rep").alias("component"),
    )
    out = own.select("id").join(result, F.expr("id = member"), "left")
    whole = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), whole.alias("component_id"),
        F.coalesce(whole == F.col("id"), F.lit(True)).alias("kept"),
    )
