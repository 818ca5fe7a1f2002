"""Benchmark items in documents: q-gram lemma in diagonal bands, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.rolling import grams as grams_of

#: Characters of a q-gram, and edits that are allowed for each character of an item.
Q = 8
EDIT_RATE = 0.1
#: Characters of items that are broadcast at a time; more items take further passes over the documents.
BLOCK_CHARS = 8 << 20
#: Characters of documents that are looked at together.
CHUNK = 1 << 20
_SLOTS = 22

FOUND = "item bigint, edits int, start bigint, end bigint"
_tables: dict[str, np.ndarray] = {}


def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower case (where that is one code point), and whether it is a letter or digit."""
    if not _tables:
        points = [chr(c) for c in range(0x110000)]
        low = [p.lower() for p in points]
        _tables["lower"] = np.array([ord(x) if len(x) == 1 else ord(p) for x, p in zip(low, points, strict=True)], dtype=np.uint32)
        _tables["word"] = np.array([p.isalnum() for p in points])
        _tables["word"][0] = True  # parts documents
    return _tables["lower"], _tables["word"]


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with one space for each run of other than letters and digits, and where each was."""
    lower, word = _characters()
    codes = lower[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
    inside = word[codes]
    codes = np.where(inside, codes, np.uint32(32))
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    at = np.flatnonzero(keep)
    return codes[at], at


def item_codes(text: str | None) -> np.ndarray:
    codes = normal((text or "").replace("\0", " "))[0]
    return codes[:-1] if len(codes) and codes[-1] == 32 else codes


@dataclass(frozen=True)
class Index:
    """Items of one block: their codes, edit budgets and least counts, and their q-grams in order with item and offset."""

    ids: np.ndarray
    codes: list[np.ndarray]
    budget: np.ndarray
    least: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    offset: np.ndarray
    slots: np.ndarray
    crowd: int
    short: list[int]


def index_of(items: list[tuple[int, str]], q: int = Q, rate: float = EDIT_RATE) -> Index:
    """Index the items. An item of n characters may have k = min(n * rate, (n - q) / q) edits and shares n - q + 1 - k * q q-grams.

    Items shorter than q are looked for as they are; empty ones match nothing.
    """
    codes = [item_codes(t) for _, t in items]
    sizes = np.array([len(c) for c in codes], dtype=np.int64)
    budget = np.maximum(np.minimum((sizes * rate + 1e-9).astype(np.int64), (sizes - q) // q), 0)
    least = sizes - q + 1 - budget * q
    hashed = [grams_of(c, q) for c in codes]
    grams = np.concatenate(hashed) if hashed else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(items)), [len(h) for h in hashed])
    offset = np.concatenate([np.arange(len(h)) for h in hashed]) if hashed else np.zeros(0, dtype=np.int64)
    order = np.argsort(grams, kind="stable")
    values, first = np.unique(grams[order], return_index=True)
    # Slots are the leading bits, so the q-grams of one are neighbours in the sorted array.
    places = (values >> np.uint64(64 - _SLOTS)).astype(np.int64)
    slots = np.full(1 << _SLOTS, -1, dtype=np.int32)
    slots[places[::-1]] = np.arange(len(values), dtype=np.int32)[::-1]
    crowd = int(np.bincount(places).max()) if len(values) else 0
    return Index(
        np.array([i for i, _ in items], dtype=object), codes, budget, least, values, np.append(first, len(grams)),
        owner[order], offset[order], slots, crowd, [i for i, n in enumerate(sizes) if 0 < n < q],
    )


def _found(item: np.ndarray, region: np.ndarray) -> int:
    """Where the item first stands in the region as it is, or -1."""
    wanted, data, at = item.astype("<u4").tobytes(), region.astype("<u4").tobytes(), 0
    while (at := data.find(wanted, at)) >= 0 and at % 4:
        at += 1
    return at // 4 if at >= 0 else -1


def align(item: np.ndarray, region: np.ndarray, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place for an item in a region, if within the budget.

    Only diagonals that the region leaves an alignment of that budget are computed; ties go to the earliest start.
    """
    n, m = len(item), len(region)
    if n <= m and (at := _found(item, region)) >= 0:
        return 0, at, at + n
    band = max(m - n + budget, 0) + budget + 1
    far = np.int64(1) << 40
    unit = np.int64(1) << 20
    shift = np.arange(band) - budget  # column minus row
    steps = np.arange(band, dtype=np.int64) * unit
    cost = np.where((shift >= 0) & (shift <= m), shift.astype(np.int64), far)
    padded = np.concatenate((np.full(budget + 1, -1, dtype=np.int64), region.astype(np.int64), np.full(band + n, -2, dtype=np.int64)))
    for i in range(1, n + 1):
        seen = padded[i:i + band]  # the region's character before column i + shift
        new = cost + np.where(seen == int(item[i - 1]), 0, unit)
        new[:-1] = np.minimum(new[:-1], cost[1:] + unit)
        new = np.minimum.accumulate(new - steps) + steps
        new[(shift + i < 0) | (shift + i > m)] = far
        cost = new
        if i % 8 == 0 and cost.min() >> 20 > budget:
            return None
    best = int(np.argmin(cost))
    edits = int(cost[best] >> 20)
    if edits > budget:
        return None
    return edits, int(cost[best] & (unit - 1)), int(n + shift[best])


def _candidates(index: Index, codes: np.ndarray, docs: np.ndarray, q: int):
    """(document, item, lowest diagonal) of bands that hold enough q-grams."""
    grams = grams_of(codes, q)
    where = index.slots[grams >> np.uint64(64 - _SLOTS)]
    at = np.flatnonzero(where >= 0)
    if not len(at):
        return
    where, wanted = where[at], grams[at]
    for _ in range(index.crowd - 1):
        where += (index.grams[where] < wanted) & (where + 1 < len(index.grams))
    good = index.grams[where] == wanted
    at, where = at[good], where[good]
    counts = index.first[where + 1] - index.first[where]
    places = np.repeat(index.first[where] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    position, item = np.repeat(at, counts), index.owner[places]
    step = index.budget[item] + 1
    # Bands of two steps begin at each step: any k + 1 neighbouring diagonals lie in one of them.
    offset = index.offset[places]
    shift = int(index.offset.max()) + 2 * int(index.budget.max()) + 2
    band = (position - offset + shift) // step
    width = len(codes) + shift + 1
    key = (docs[position] * len(index.ids) + item) * width
    both = np.concatenate([key + band, key + band - 1])
    # Most bands hold a few chance hits: those that share a slot with too few others are out before anything is sorted.
    slot = (both.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)
    enough = np.bincount(slot.astype(np.int64), minlength=1 << _SLOTS)[slot] >= np.tile(index.least[item], 2)
    both, offset = both[enough], np.tile(offset, 2)[enough]
    order = np.argsort(both)
    both, offset = both[order], offset[order]
    new = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, dtype=np.int64)
    ends = np.append(new[1:], len(both))
    item_of = both[new] // width % len(index.ids)
    for i in np.flatnonzero(ends - new >= index.least[item_of]):
        item = int(item_of[i])
        # A q-gram of the item counts once, however often the document has it there.
        if len(np.unique(offset[new[i]:ends[i]])) >= index.least[item]:
            low = int(both[new[i]] % width) * (int(index.budget[item]) + 1) - shift
            yield int(both[new[i]] // width) // len(index.ids), item, low


def search(index: Index, texts: list[str], q: int = Q) -> list[tuple[int, int, int, int, int]]:
    """(number of the text, item id, edits, start, end) of the best place of each item that a text holds; characters of the text."""
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    codes, origin = normal("\0".join(t.replace("\0", " ") for t in texts) + "\0")
    doc_of = np.searchsorted(bounds, origin, side="right") - 1
    edges = np.searchsorted(origin, bounds)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}

    def keep(doc, item, edits, start, end):
        """Positions count in ``codes``; the first place wins among equals."""
        found = (edits, int(origin[start] - bounds[doc]), int(origin[end - 1] - bounds[doc]) + 1 if end > start else 0)
        best[doc, item] = min(best.get((doc, item), found), found)

    for doc, item, low in _candidates(index, codes, doc_of, q):
        k, n = int(index.budget[item]), len(index.codes[item])
        start = max(int(edges[doc]), low - k)
        end = min(int(edges[doc + 1]) - 1, low + 2 * (k + 1) + n + k)
        place = align(index.codes[item], codes[start:end], k)
        if place:
            keep(doc, item, place[0], start + place[1], start + place[2])
    for item in index.short:
        wanted, n = index.codes[item], len(index.codes[item])
        hit = np.ones(max(len(codes) - n + 1, 0), dtype=bool)
        for i, c in enumerate(wanted):
            hit &= codes[i:len(codes) - n + 1 + i] == c
        for at in np.flatnonzero(hit):
            keep(int(doc_of[at]), item, 0, int(at), int(at) + n)
    return [(doc, index.ids[item], *found) for (doc, item), found in sorted(best.items())]


def gram_size(n: int, q: int = Q, rate: float = EDIT_RATE) -> int:
    """The q-grams that an item of n characters is looked for by: shorter ones if its edits could break all of ``q``."""
    return max(min(q, n // (int(n * rate + 1e-9) + 1)), 1)


def _blocks(items: DataFrame, most: int, q: int, rate: float) -> Iterator[tuple[int, list[tuple[int | None, str]]]]:
    """Items of one size of q-grams, as many as a pass may have. Only items below five q-grams have other sizes than ``q``."""
    blocks: dict[int, list[tuple[int | None, str]]] = {}
    sizes: dict[int, int] = {}
    for row in items.toLocalIterator():
        own = gram_size(len(item_codes(row[1])), q, rate)
        if own in blocks and sizes[own] + len(row[1] or "") > most:
            yield own, blocks.pop(own)
            del sizes[own]
        blocks.setdefault(own, []).append((row[0], row[1]))
        sizes[own] = sizes.get(own, 0) + len(row[1] or "")
    yield from blocks.items()


def leaks(docs: DataFrame, items: DataFrame, q: int = Q, rate: float = EDIT_RATE, text: str = "text", key: str = "doc_id",
          item_text: str = "text", item_key: str = "item_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(key, item, edits, start, end) for each document and each item that it holds within ``rate`` edits a character.

    Letters and digits count, in lower case, and one space for anything between them. Positions are
    those of the best place (fewest edits, then first) in the document's characters, end exclusive. Null and empty texts and
    items match nothing; an item without a key is searched like any other and told as null; repeated rows each give theirs; other
    columns are not used. Whole texts are searched.

    The items are a stated query set: blocks of bounded size are broadcast, one pass over the
    documents for each, without a shuffle. Items so short that their edits could break every q-gram have
    shorter ones, and passes of their own.
    """
    kind = docs.schema[key].dataType
    spark = docs.sparkSession
    # Keys travel as texts: pandas would make doubles of whole numbers with nulls among them.
    small = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).where("text is not null")

    def passed(q: int, block: list[tuple[int | None, str]]) -> DataFrame:
        held = spark.sparkContext.broadcast(index_of(block, q, rate))

        def searched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            columns = ["key", "item", "edits", "start", "end"]
            for frame in frames:
                names, texts, size, rows = [], [], 0, []
                for name, words in zip(frame["key"], frame["text"], strict=True):
                    names.append(name)
                    texts.append(words)
                    size += len(words)
                    if size >= CHUNK:
                        rows += [(names[r[0]], *r[1:]) for r in search(held.value, texts, q)]
                        names, texts, size = [], [], 0
                if texts:
                    rows += [(names[r[0]], *r[1:]) for r in search(held.value, texts, q)]
                yield pd.DataFrame(rows, columns=columns, dtype=object)

        return small.mapInPandas(searched, f"key string, {FOUND}")

    rows = items.select(F.col(item_key).cast("bigint").alias("item"), F.col(item_text).alias("text")).orderBy("item", "text")
    passes = [passed(*block) for block in _blocks(rows, block_chars, q, rate)]
    if not passes:
        passes = [small.select("key", *[F.lit(0).alias(c.split()[0]).cast(c.split()[1]) for c in FOUND.split(", ")]).limit(0)]
    return reduce(DataFrame.unionByName, passes).select(F.col("key").cast(kind).alias(key), *[c.split()[0] for c in FOUND.split(", ")])
