"""Languages by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_names

UNKNOWN = "und"

#: Lengths of n-grams, and buckets that they are hashed into.
ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
#: Added to each count.
SMOOTHING = 0.5
#: Languages that a model may have; more labels are an error, so that the broadcast matrix stays below 256 MB.
MOST_LANGUAGES = 2000
#: Characters that are hashed at a time.
CHUNK = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = np.zeros(0x110000, dtype=bool)
_LETTERS_READY = False


def _letters() -> np.ndarray:
    """Which code points are letters; filled at the first use in a process."""
    global _LETTERS_READY
    if not _LETTERS_READY:
        _LETTERS[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _LETTERS_READY = True
    return _LETTERS


@dataclass(frozen=True)
class Model:
    """Log probabilities: one row for each bucket, one column for each language."""

    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_likelihood: np.ndarray


def _codes(text: str) -> np.ndarray:
    """Code points in lower case; everything that is no letter is one space, and so are both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = np.where(_letters()[codes], codes, np.uint32(32))
    codes = np.concatenate(([np.uint32(32)], codes, [np.uint32(32)]))
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    return codes[keep]


def _hashed(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of each order in an array of code points."""
    wide = codes.astype(np.uint64)
    for order in ORDERS:
        if len(wide) < order:
            continue
        mixed = np.zeros(len(wide) - order + 1, dtype=np.uint64)
        for i in range(order):
            mixed = (mixed + wide[i:len(wide) - order + 1 + i] + np.uint64(order)) * _MIX
            mixed ^= mixed >> np.uint64(29)
        yield ((mixed * _MIX) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def counts_of(text: str) -> np.ndarray:
    """How often each bucket occurs in a whole text, in pieces of bounded memory."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    codes = _codes(text)
    most = max(ORDERS) - 1
    for start in range(0, len(codes), CHUNK):
        piece = codes[start:start + CHUNK + most]
        for buckets in _hashed(piece):
            # An n-gram belongs to the piece that it starts in.
            total += np.bincount(buckets[:CHUNK], minlength=BUCKETS)
    return total


def counts_together(texts: list[str]) -> np.ndarray:
    """The sum of the counts of some texts, none of whose n-grams reaches into another."""
    codes = [_codes(t) for t in texts]
    owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    total = np.zeros(BUCKETS, dtype=np.int64)
    for buckets in _hashed(np.concatenate(codes)):
        order = len(owner) - len(buckets) + 1
        total += np.bincount(buckets[owner[:len(buckets)] == owner[order - 1:]], minlength=BUCKETS)
    return total


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bucket counts and texts of each language in a task: rows that grow with languages, not with texts."""
    sums: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}
    for frame in frames:
        for lang, group in frame.groupby("lang", sort=False)["text"]:
            held = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            texts[lang] = texts.get(lang, 0) + len(group)
            waiting, size = [], 0
            for text in group:
                if len(text) > CHUNK:
                    held += counts_of(text)
                    continue
                waiting.append(text)
                size += len(text)
                if size >= CHUNK:
                    held += counts_together(waiting)
                    waiting, size = [], 0
            if waiting:
                held += counts_together(waiting)
    for lang, held in sums.items():
        at = np.flatnonzero(held)
        yield pd.DataFrame({
            "lang": lang, "bucket": np.append(at, -1).astype(np.int32), "n": np.append(held[at], texts[lang]),
        })


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from all rows whose text and language are not null.

    Each task adds up its own counts, and only (language, bucket) sums are shuffled. The driver gets the
    finished matrix, at most ``MOST_LANGUAGES * BUCKETS`` numbers whatever the corpus. No rows give a
    model without languages. Texts without letters count as spaces only.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    counts = rows.mapInPandas(_counted, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    known = [r[0] for r in rows.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    place = {name: i for i, name in enumerate(known)}
    table = np.zeros((BUCKETS, len(known)))
    texts = np.zeros(len(known))
    found = counts.toPandas()
    columns = found["lang"].map(place).to_numpy(dtype=np.int64)
    buckets, numbers = found["bucket"].to_numpy(), found["n"].to_numpy(dtype=float)
    whole = buckets < 0
    texts[columns[whole]] = numbers[whole]
    table[buckets[~whole], columns[~whole]] = numbers[~whole]
    if not known:
        return Model((), texts, table)
    smoothed = table + SMOOTHING
    return Model(tuple(known), np.log(texts / texts.sum()), np.log(smoothed / smoothed.sum(axis=0)))


def classify(model: Model, text: str | None) -> tuple[str, float]:
    """The most probable language and its posterior probability; ties go to the first name."""
    if not text or not model.languages:
        return UNKNOWN, 0.0
    codes = _codes(text)
    if not (codes != 32).any():
        return UNKNOWN, 0.0
    scores = model.log_prior.copy()
    most = max(ORDERS) - 1
    for start in range(0, len(codes), CHUNK):
        for buckets in _hashed(codes[start:start + CHUNK + most]):
            counts = np.bincount(buckets[:CHUNK], minlength=BUCKETS)
            at = np.flatnonzero(counts)
            scores += counts[at] @ model.log_likelihood[at]
    best = int(np.argmax(scores))
    return model.languages[best], float(1.0 / np.exp(scores - scores[best]).sum())


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) to every row, from its whole text.

    ``und`` with score 0 if the text is null, empty or has no letter, or nothing was learned. Only
    the text is an input. Columns with the two names are replaced, all others and repeated rows stay.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang:string,score:double>")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = held.value
        for texts in batches:
            yield pd.DataFrame([classify(known, t) for t in texts], columns=["lang", "score"])

    own = [c for c in docs.columns if c not in ("lang_pred", "score")]
    [both] = free_names(docs, "judged")
    return docs.withColumn(both, judged(F.col(text))).select(
        *own, F.col(f"{both}.lang").alias("lang_pred"), F.col(f"{both}.score").alias("score")
    )


def held_out(key: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from training: CRC-32 of the key as text, modulo ``folds``."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(False))
