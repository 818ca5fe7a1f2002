"""Codes for vectors: each part is told by its nearest of a few codebook entries, found through cells of a coarse grid."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Stages, shuffle_width

PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Components become whole numbers at this scale.
SCALE = 4096.0
#: Side of a grid cell, in whole-number units.
CELL = 512
#: Cells of a part that a task remembers.
REMEMBERED = 1 << 15
#: Magnitudes below this keep squared distances of up to 4,096 components within 64 bits.
_PLAIN = 1 << 24
_MOST = (1 << 63) - 1

Codebook = list[list[int]]


@dataclass(frozen=True)
class Codes:
    """``rows``: the key, what was carried, ``code`` (a byte for each part) and ``error``; and the final codebooks."""

    rows: DataFrame
    codebooks: list[Codebook]

    def digest(self) -> str:
        """SHA-256 of all entries' components, by part, entry and position."""
        return hashlib.sha256(",".join(str(x) for book in self.codebooks for entry in book for x in entry).encode()).hexdigest()


def usable(vector: str) -> Column:
    """Neither null nor with a null or non-finite component."""
    plain = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & plain


class Cells:
    """For one part position: which entries can be nearest to a point, remembered for each cell of a grid.

    In a cell, an entry is out if another one's greatest distance from the cell is below its least. What is left is
    evaluated exactly, so that the grid changes no result.
    """

    def __init__(self, book: np.ndarray, side: int = CELL):
        self.book, self.side = book, side
        self.known: dict[int, tuple[bytes, np.ndarray]] = {}
        self.by = np.random.default_rng(len(book)).integers(1, 1 << 62, size=book.shape[1], dtype=np.int64) | 1

    def _candidates(self, cells: np.ndarray) -> np.ndarray:
        low = (cells * self.side)[:, None, :]
        below, above = low - self.book[None], self.book[None] - (low + self.side - 1)
        least = np.maximum(np.maximum(below, above), 0)
        most = np.maximum(np.abs(below), np.abs(above))
        least, most = (least * least).sum(axis=2), (most * most).sum(axis=2)
        return least <= most.min(axis=1, keepdims=True)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each point; ties go to the lower entry."""
        cells = points // self.side
        hashes = (cells * self.by).sum(axis=1)
        unique, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        spelled = [cells[i].tobytes() for i in first]
        new = [i for i, h in enumerate(unique.tolist()) if self.known.get(h, (None,))[0] != spelled[i]]
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = list(range(len(unique)))
            for i, row in zip(new, self._candidates(cells[first[new]]), strict=True):
                self.known[int(unique[i])] = (spelled[i], row)
        allowed = np.stack([self.known[h][1] for h in unique.tolist()])[at]
        allowed[(cells != cells[first[at]]).any(axis=1)] = True  # two cells of one hash: every entry is evaluated
        rows, entries = np.nonzero(allowed)
        gap = points[rows] - self.book[entries]
        distance = (gap * gap).sum(axis=1)
        counts = allowed.sum(axis=1)
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        best = np.minimum.reduceat(distance, starts)
        ties = np.where(distance == np.repeat(best, counts), entries, len(self.book))
        return np.minimum.reduceat(ties, starts), best


def _wide(points: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """The same for components of any size, in whole numbers without a bound."""
    entries, distances = [], []
    for point in points.tolist():
        found = [sum((x - y) ** 2 for x, y in zip(point, entry, strict=True)) for entry in book]
        distances.append(min(found))
        entries.append(found.index(distances[-1]))
    return np.array(entries, dtype=np.int64), np.array(distances, dtype=object)


def _coder(books: list[Codebook], side: int):
    """A function of whole vectors (a matrix): the entries and the squared distances, a column for each part."""
    small = all(abs(x) < _PLAIN for book in books for entry in book for x in entry)
    grids = [Cells(np.array(book, dtype=np.int64).reshape(len(book), -1), side) for book in books] if small else []

    def code(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = vectors.shape[1] // len(books)
        plain = small and (not vectors.size or (vectors.max() < _PLAIN and vectors.min() > -_PLAIN))
        found = []
        for p, book in enumerate(books):
            part = vectors[:, p * width:(p + 1) * width]
            found.append(grids[p].nearest(part) if plain and width else _wide(part, book))
        return tuple(np.stack(x, axis=1) for x in zip(*found, strict=True))

    return code


def _matrix(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1) if rows else np.zeros((0, 0), dtype=np.int64)


def _refined(whole: DataFrame, books: list[Codebook], side: int) -> list[Codebook]:
    """One round: each entry becomes the mean of the parts nearest to it, rounded down. Tasks add up first."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, parts, entries = _coder(books, side), len(books), len(books[0])
        width = len(books[0][0])
        counts = np.zeros((parts, entries), dtype=np.int64)
        totals = [[[0] * width for _ in range(entries)] for _ in range(parts)]
        for batch in batches:
            vectors = _matrix(batch.column("x"), batch.num_rows)
            if not len(vectors):
                continue
            met, _ = code(vectors)
            wide = vectors.size and max(abs(int(vectors.max())), abs(int(vectors.min()))) >= 1 << 40
            held = vectors.astype(object) if wide else vectors
            for p in range(parts):
                for e in np.unique(met[:, p]).tolist():
                    of = met[:, p] == e
                    counts[p, e] += int(of.sum())
                    some = held[of, p * width:(p + 1) * width].sum(axis=0)
                    totals[p][e] = [a + int(b) for a, b in zip(totals[p][e], some, strict=True)]
        rows = [(p, e, d, int(counts[p, e]), Decimal(totals[p][e][d]))
                for p in range(parts) for e in range(entries) if counts[p, e] for d in range(width)]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "entry", "place", "n", "total"])

    some = whole.select("x").mapInArrow(added, "part int, entry int, place int, n bigint, total decimal(38,0)")
    means = some.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    out = [[list(entry) for entry in book] for book in books]
    for r in means.collect():  # a row for each component of the codebooks
        out[r.part][r.entry][r.place] = int(r.total) // r.n
    return out


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", carry: Sequence[str] = (), parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE, side: int = CELL) -> Codes:
    """Codes of all usable vectors, and the codebooks they come from.

    Components become ``floor(scale * x)``, within the range of a long. Vectors are cut into ``parts`` equal parts; each part
    position has a codebook that starts as that part of the vectors with the ``entries`` smallest keys and is refined
    in ``rounds`` rounds over all vectors. ``error`` adds up the squared distances to the chosen entries; one that
    no long can hold is given as the greatest long.

    Left out are vectors that are null, hold null or non-finite components, or have another length than the first usable one (in
    key order). A length that ``parts`` doesn't divide raises ValueError. A null key is coded, but begins a codebook only
    after all others; equal keys are taken in the order of their vectors. Fewer vectors than ``entries`` make smaller
    codebooks, no usable vector gives no rows. Only the key, the vector and the columns of ``carry`` are used.

    Whole vectors are written once; each round reads them, and only codebooks and their sums reach the driver.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has a byte for each part: entries are 1 to 256")
    stages = Stages(vectors.sparkSession, "vector-codes")
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    rows = vectors.where(usable(vector)).select(F.col(key).alias("id"), F.struct(*carry).alias("carried") if carry else F.lit(0).alias("carried"),
                                                whole.alias("x"))
    rows = stages.keep(rows, "whole")
    order = [F.asc_nulls_last("id"), F.asc("x")]
    first = rows.orderBy(*order).select("x").limit(1).collect()
    size = len(first[0].x) if first else 0
    if size % parts:
        raise ValueError(f"{size} components are no {parts} equal parts")
    rows = rows.where(F.size("x") == size)
    width = size // parts
    seeds = [r.x for r in rows.orderBy(*order).select("x").limit(entries).collect()]
    books = [[x[p * width:(p + 1) * width] for x in seeds] for p in range(parts)]
    for _ in range(rounds if width and seeds else 0):
        books = _refined(rows, books, side)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _coder(books, side) if seeds else None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), batch.num_rows)
            met, far = code(x) if width else (np.zeros((len(x), parts), dtype=np.int64), np.zeros((len(x), 1), dtype=np.int64))
            error = [min(sum(map(int, row)), _MOST) for row in far] if far.dtype == object else far.sum(axis=1).tolist()
            spelled = [row.tobytes() for row in met.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("carried"), pa.array(spelled, pa.binary()), pa.array(error, pa.int64())],
                ["id", "carried", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = rows.mapInArrow(coded, f"id {kinds['id']}, carried {kinds['carried']}, code binary, error bigint")
    out = out.select(F.col("id").alias(key), *[F.col("carried")[c].alias(c) for c in carry], "code", "error")
    return Codes(out, books)


def with_total(rows: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows with an equal ``by``, nulls being equal; greater than a long: the greatest long.

    Tasks add up before the shuffle. Values of ``by`` that more than one of as many rows as there are tasks have are fewer than
    tasks, so they are broadcast; the others are joined by shuffle, where none of them can fill a task.
    """
    free = [f"{c}_{n}" for n, c in enumerate(("by", "total", "count"))]
    width = shuffle_width(rows.sparkSession, 1, 1)
    totals = rows.groupBy(F.col(by).alias(free[0])).agg(
        F.sum(F.col(value).cast("decimal(38,0)")).alias(free[1]), F.count("*").alias(free[2]))
    everything = rows.count()
    hot = totals.where(F.col(free[2]) * width > everything)  # fewer than width rows
    total = F.least(F.col(free[1]), F.lit(Decimal(_MOST))).cast("bigint").alias(name)
    columns = [F.col(c) for c in rows.columns]
    same = F.col(by).eqNullSafe(F.col(free[0]))
    large = rows.join(F.broadcast(hot), same).select(*columns, total)
    rest = rows.join(F.broadcast(hot), same, "left_anti").join(totals, same).select(*columns, total)
    return large.union(rest)
