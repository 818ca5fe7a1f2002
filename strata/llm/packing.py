"""Training sequences of fixed length by non-negative least squares over the histogram of piece lengths."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import Stages

WINDOW = 2048
#: Third lengths that are tried with each first length.
FAN = 8
#: Steps of the solver.
STEPS = 400

PLAN = "length int, first bigint, beyond bigint, sequence bigint, uses int, offset int"
_encoders: dict[tuple[str, str], object] = {}
_whole: dict[str, object] = {}


def encoder(ranks: str, pattern: str):
    """A byte-level BPE encoder from a file of ``base64-token rank`` lines, one for each process.

    It gives the ids that the same vocabulary gives in ``tokenizers`` with the strings of special tokens as
    ordinary text, but it raises ValueError on white space of about 1,000,000 characters (see ``ids_of``).
    """
    import tiktoken

    if (ranks, pattern) not in _encoders:
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encoders[ranks, pattern] = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _encoders[ranks, pattern]


def tokenizer(vocabulary: str):
    """The ``tokenizers`` library's encoder from its JSON file, one for each process, without special tokens."""
    from tokenizers import Tokenizer

    if vocabulary not in _whole:
        _whole[vocabulary] = Tokenizer.from_file(vocabulary)
        _whole[vocabulary].encode_special_tokens = True
    return _whole[vocabulary]


def ids_of(ranks: str, pattern: str) -> Callable[[str], np.ndarray]:
    """Ids of a text of any length.

    What the encoder's pattern engine can't split goes to ``tokenizers``, whose JSON file stands beside the ranks.
    """
    encode = encoder(ranks, pattern).encode_to_numpy

    def ids(text: str) -> np.ndarray:
        try:
            return encode(text, disallowed_special=())
        except ValueError:
            other = tokenizer(str(Path(ranks).with_suffix(".json")))
            return np.array(other.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    return ids


def cut(docs: DataFrame, ranks: str, pattern: str, end_id: int = 1, window: int = WINDOW,
        text: str = "text", key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents: whole windows and, at the end, what is left.

    One row per piece: the key, ``start``, ``length``, ``ids_crc32`` (of the ids as little-endian
    unsigned 32-bit numbers), ``doc_tokens``, with ``keep_ids`` the ``ids`` themselves, and where it
    stands: ``part`` (the task) and ``place`` among the task's pieces of that length. A null text
    is empty; every document ends with ``end_id`` and so has a piece. Repeated rows are each cut.
    """
    kind = docs.schema[key].dataType
    columns = ["key", "start", "length", "ids_crc32", "doc_tokens", "part", "place"] + ["ids"] * keep_ids
    schema = "key string, start bigint, length int, ids_crc32 bigint, doc_tokens bigint, part int, place bigint"

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = ids_of(ranks, pattern)
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, dtype=np.int64)
        for frame in frames:
            rows = []
            for name, words in zip(frame["key"], frame["text"], strict=True):
                ids = np.append(encode(words or ""), end_id).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window]
                    n = len(piece)
                    rows.append((name, start, n, zlib.crc32(piece.tobytes()), len(ids), part, int(seen[n]))
                                + ((piece.astype(np.int64),) if keep_ids else ()))
                    seen[n] += 1
            yield pd.DataFrame(rows, columns=columns, dtype=object).astype({c: "int64" for c in columns[1:7]})

    # Keys travel as texts: pandas would make doubles of whole numbers with nulls among them.
    small = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return small.mapInPandas(pieces, schema + ", ids array<bigint>" * keep_ids).withColumn("key", F.col("key").cast(kind))


def combinations(counts: np.ndarray, window: int = WINDOW, fan: int = FAN) -> np.ndarray:
    """Pairs and triples of lengths that occur and fill a window, as sorted rows with 0 for a missing third."""
    present = np.flatnonzero(counts[:window])
    present = present[present > 0]
    held = counts > 0
    held[0] = True
    rows = [np.stack([present, window - present, np.zeros_like(present)], axis=1)]
    for i in range(fan):
        left = window - present
        second = np.maximum(1, left * (2 * i + 1) // (4 * fan))
        rows.append(np.stack([present, second, left - second], axis=1))
    found = np.concatenate(rows)
    found = found[(found >= 0).all(axis=1) & held[found].all(axis=1) & ((found > 0).sum(axis=1) > 1)]
    return np.unique(np.sort(found, axis=1), axis=0) if len(found) else np.zeros((0, 3), dtype=np.int64)


def solve(lengths: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative repeats x of the combinations for which ``A x`` is closest to the histogram.

    Accelerated projected gradient; A has the number of pieces of each length in each combination.
    """
    size, wanted = len(counts), counts.astype(float)
    wanted[0] = 0.0

    def spread(x):
        out = np.bincount(lengths.ravel(), weights=np.repeat(x, lengths.shape[1]), minlength=size)
        out[0] = 0.0
        return out

    def gather(r):
        return r[lengths].sum(axis=1)

    bound = np.ones(len(lengths))
    for _ in range(20):
        bound = gather(spread(bound))
        scale = np.linalg.norm(bound)
        bound /= max(scale, 1e-300)
    step = 1.0 / (1.05 * max(scale, 1e-300))
    x = ahead = np.zeros(len(lengths))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, ahead - step * gather(spread(ahead) - wanted))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(counts: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Where pieces go, from the number of pieces of each length alone.

    Rows (length, first, beyond, sequence, uses, offset): of the pieces with that length, those with
    numbers from ``first`` to ``beyond`` go, ``uses`` to a sequence and one behind the other from
    ``offset``, to the sequences from ``sequence`` on. As many rows as the window allows, however
    large the corpus. Repeats are rounded down to what the histogram holds; what is left is packed
    greedily, longest first, many equal sequences at a time.
    """
    left = counts.astype(np.int64).copy()
    used = np.zeros_like(left)
    rows, sequence = [], 0

    def put(parts, times):
        nonlocal sequence
        offset = 0
        for length, uses in parts:
            rows.append((int(length), int(used[length]), int(used[length] + uses * times), sequence, int(uses), offset))
            used[length] += uses * times
            left[length] -= uses * times
            offset += length * uses
        sequence += int(times)

    if left[window]:
        put([(window, 1)], left[window])
    lengths = combinations(left, window)
    if len(lengths):
        repeats = np.floor(solve(lengths, left) + 0.5).astype(np.int64)
        for i in np.argsort(-repeats, kind="stable"):
            if not repeats[i]:
                break
            parts = list(zip(*np.unique(lengths[i][lengths[i] > 0], return_counts=True), strict=True))
            times = min(int(repeats[i]), *(int(left[length] // uses) for length, uses in parts))
            if times:
                put([(int(a), int(b)) for a, b in parts], times)
    while left.any():
        parts, space, below = [], window, window
        while space:
            some = np.flatnonzero(left[:min(space, below) + 1])
            if not len(some):
                break
            length = int(some[-1])
            uses = int(min(left[length], space // length))
            parts.append((length, uses))
            space -= length * uses
            below = length - 1
        put(parts, min(int(left[length] // uses) for length, uses in parts))
    return rows


def pack(docs: DataFrame, ranks: str, pattern: str, end_id: int = 1, window: int = WINDOW,
         text: str = "text", key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens; one row per piece.

    Columns: the key, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``
    (and ``ids``). Every token lies in one piece, and pieces fill a sequence from 0 without gaps.
    No documents give no rows; other columns of the input are not used.

    Each text is encoded once, without a shuffle of texts. Only pieces, (task, length) counts and a
    plan of bounded size travel; a length that a third of all pieces share is no group, as its
    pieces are numbered by task.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "packing")
    pieces = stages.keep(cut(docs, ranks, pattern, end_id, window, text, key, keep_ids), "pieces")
    counts = stages.keep(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    histogram = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most one row for each length
        histogram[length] = n
    rows = spark.createDataFrame(plan(histogram, window), PLAN)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = pieces.join(bases, ["length", "part"]).withColumn("number", F.col("place") + F.col("base"))
    # The plan has a few rows for each length, whatever the input.
    placed = numbered.join(F.broadcast(rows.withColumnRenamed("length", "__length")), (
        (F.col("length") == F.col("__length")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("beyond"))
    ))
    at = F.col("number") - F.col("first")
    return placed.select(
        F.col("key").alias(key), "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.floor(at / F.col("uses"))).cast("bigint").alias("sequence_id"),
        (F.col("offset") + at % F.col("uses") * F.col("length")).cast("bigint").alias("offset"),
        *["ids"] * keep_ids,
    )
