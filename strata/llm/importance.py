"""Importance resampling towards a target: hashed n-gram counts of a corpus and of what it is to be like."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import Stages, shuffle_width

BUCKETS = 10_000
#: What words are made of, once A-Z are lower-cased: digits, a-z and all that is not ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Stands between the texts of a batch; in no word.
SENTINEL = b"\n"
#: Bytes of text that are joined to one, unless a single text is longer.
JOINED = 8 << 20
#: Rows that a range of the ranking is meant for.
RANGE_ROWS = 2_000_000


def features(texts: Sequence[bytes], longest: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every run of 1 to ``longest`` consecutive words, and how many words each text has.

    All texts are joined with a sentinel between them, so that one pass of the pattern finds all words. The text that
    a word is in comes from its place; runs that begin in one text and end in another are masked. A
    run's hash goes on from that of the run without its last word.
    """
    ends = np.cumsum([len(x) + len(SENTINEL) for x in texts])
    words, places = [], []
    for m in WORD.finditer(SENTINEL.join(texts).lower()):
        words.append(m[0])
        places.append(m.start())
    of = np.searchsorted(ends, np.array(places, dtype=np.int64), side="right")
    held, found = list(map(zlib.crc32, words)), []
    for n in range(longest):
        if n:
            held = [zlib.crc32(w, zlib.crc32(b" ", h)) for h, w in zip(held[:-1], words[n:], strict=True)]
        size = max(len(words) - n, 0)
        inside = of[:size] == of[n:]
        found.append((of[:size][inside], (np.array(held[:size], dtype=np.uint32) % np.uint32(buckets)).astype(np.int64)[inside]))
    return *(np.concatenate(x) for x in zip(*found, strict=True)), np.bincount(of, minlength=len(texts))


def _batches(texts: Sequence[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts in order, as UTF-8 and a bounded number of bytes at a time, with the number of the first."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "replace")
        if held and size + len(raw) > JOINED:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. Tasks count first; a row for each bucket reaches the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, some in _batches(batch.column("text").to_pylist()):
                counts += np.bincount(features(some, longest, buckets)[1], minlength=buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(counts[met])], ["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    some = docs.select(F.col(text).alias("text")).mapInArrow(counted, "bucket int, n bigint")
    for bucket, n in some.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's logarithm of target share over source share, each count and one more, in whole thousandths."""
    buckets = len(source)
    s_all, t_all = float(source.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (s_all + buckets) / ((float(s) + 1) * (t_all + buckets))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ], dtype=np.int64)


def noise(key: object, seed: int) -> int:
    """A draw from the Gumbel distribution in thousandths, fixed by seed and key; a null key counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int, text: str = "text", key: str = "doc_id", longest: int = 1) -> DataFrame:
    """(key, n_words, n_features, weight, score) of every row; a null text has no words and a weight of 0."""
    kind, names = docs.schema[key].dataType.simpleString(), [key, "n_words", "n_features", "weight", "score"]

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, size, weight = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for first, some in _batches(batch.column("text").to_pylist()):
                of, bucket, n = features(some, longest, len(gain))
                span = slice(first, first + len(some))
                words[span], size[span] = n, np.bincount(of, minlength=len(some))
                np.add.at(weight, first + of, gain[bucket])
            drawn = np.array([noise(k, seed) for k in batch.column("key").to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *map(pa.array, (words, size, weight, weight + drawn))], names)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        weighed, f"`{key}` {kind}, n_words bigint, n_features bigint, weight bigint, score bigint")


def ranked(rows: DataFrame, drawn: int, key: str, stages: Stages) -> DataFrame:
    """Adds ``rank`` (1, 2, ...) to the ``drawn`` rows with the highest scores, ties to the smaller key; null to others.

    Rows are range-partitioned by that order and numbered within their range, so that no task sorts them all. Equal rows
    of a task travel as one with a count, so that a key that very many rows share is spread like any other.
    """
    names = rows.columns
    order = [F.desc("score"), F.asc_nulls_last(key), *[F.asc(c) for c in names if c not in (key, "score")], F.asc("part")]
    groups = rows.withColumn("part", F.spark_partition_id()).groupBy(*names, "part").agg(F.count("*").alias("copies"))
    width = shuffle_width(rows.sparkSession, rows.count(), RANGE_ROWS)
    # Written, so that each later read sees the same ranges.
    ranged = stages.keep(
        groups.repartitionByRange(width, *order).withColumn("range", F.spark_partition_id()), "ranged")
    before, bases = 0, []
    for of, n in ranged.groupBy("range").agg(F.sum("copies")).orderBy("range").collect():  # a row for each range
        bases.append((of, before))
        before += n
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    base = F.broadcast(rows.sparkSession.createDataFrame(bases, "range int, base bigint"))
    placed = ranged.join(base, "range").withColumn("first", F.col("base") + F.coalesce(F.sum("copies").over(inside), F.lit(0)) + 1)
    each = placed.withColumn("rank", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)))
    return each.select(*names, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1,
             buckets: int = BUCKETS, seed: int = 2024, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of every row of ``docs``.

    Words are runs of digits, letters and all that is not ASCII, with A-Z lower-cased; features are runs of 1 to ``longest``
    words, repeats counted. A document's weight is the sum of its features' gains (see ``gains``), from the counts of
    all documents and of all ``target`` texts; its score adds Gumbel noise that seed and key fix, so that the highest
    scores are a sample without replacement by weight. Of the documents with ``least_words`` words or more,
    ``percent`` of a hundred are drawn (rounded down) and ranked.

    Null texts are empty: no features, a weight of 0, never drawn if ``least_words`` is over 0. A null key draws the noise of an
    empty one and comes last among equal scores. Rows that repeat a key share its noise, each is ranked for itself. An empty
    target gives each feature the gain of its rarity alone, no documents give no rows. Other columns are not used.
    """
    stages = Stages(docs.sparkSession, "importance")
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets))
    rows = stages.keep(scored(docs, gain, seed, text, key, longest), "scored")
    asked = rows.where(F.col("n_words") >= least_words)
    out = ranked(asked, asked.count() * percent // 100, key, stages)
    return out.union(rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint")))
