"""Byte strings that repeat across documents, by induced sorting of suffixes with their common prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Stages, shuffle_width
from strata.llm.rolling import grams, sliding

#: Bytes of a string that counts as repeated.
MATCH = 50
#: Bytes by which sample suffixes are named.
NAME = 16
#: Bytes of text for each group of documents and each range of names.
UNIT_BYTES = 8 << 20
#: Bytes that arrays are made of at a time, and sample suffixes that a task holds before it passes them on.
CHUNK = 1 << 21
HELD = 1 << 21

#: Groups of documents from which on a name is hot: its strings are then compared one by one, and not by surroundings.
#: Below that, a name in every third document of its groups has some 80 MB of surroundings.
HOT_GROUPS = 1024

_END = 0xFF  # occurs in no UTF-8 text
#: Kinds of rows: names with the surroundings of their samples, hot names, and strings around those.
NAMES, HOT, STRINGS = 0, 1, 2
_LAST = np.iinfo(np.int64).max


def samples(codes: np.ndarray, match: int = MATCH, name: int = NAME) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the sample suffixes and the hashes that name them.

    Of the name-long strings in each match-long string, those with the least hash are samples: two
    places with the same string have a sample at the same distance. Strings across an end do not count.
    """
    if len(codes) < match:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    hashes, width = grams(codes, name), match - name + 1
    low = np.where(whole(codes, match), sliding(hashes, width, np.minimum), np.uint64(0))
    pad = np.zeros(width - 1, dtype=np.uint64)
    at = np.flatnonzero(sliding(np.concatenate((pad, low, pad)), width, np.maximum) == hashes)
    return at, hashes[at]


def whole(codes: np.ndarray, match: int) -> np.ndarray:
    """Whether the string that starts at each place holds no end."""
    ends = np.concatenate(([0], np.cumsum(codes == _END, dtype=np.int32)))
    return ends[match:] == ends[:-match]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts with an end after each, and where each starts; the last number is the length."""
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return np.frombuffer(b"\xff".join((*texts, b"")), dtype=np.uint8), starts


def _chunks(keys: np.ndarray, texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Whole documents, about ``CHUNK`` bytes of them at a time."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK or i + 1 == len(texts):
            yield keys[start:i + 1], texts[start:i + 1]
            start, size = i + 1, 0


def surroundings(codes: np.ndarray, at: np.ndarray, reach: int, size: int) -> np.ndarray:
    """The ``size`` bytes from ``reach`` before each place, with ends for all outside its own document.

    What lies beyond the document is no part of them: groups of documents are read more than once, and their rows may come in
    another order each time.
    """
    padded = np.concatenate((np.full(reach, _END, np.uint8), codes, np.full(size, _END, np.uint8)))
    rows = np.lib.stride_tricks.sliding_window_view(padded, size)[at]
    cut = np.flatnonzero(~whole(padded, size)[at])
    outside = rows[cut] == _END
    outside[:, :reach] = np.logical_or.accumulate(outside[:, :reach][:, ::-1], axis=1)[:, ::-1]
    outside[:, reach:] = np.logical_or.accumulate(outside[:, reach:], axis=1)
    rows[cut] = np.where(outside, np.uint8(_END), rows[cut])
    return rows


def _labels(rows: np.ndarray) -> np.ndarray:
    """A hash of each row of bytes."""
    out = np.zeros(len(rows), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(rows.shape[1]):
            out = (out + rows[:, j] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def induced(rows: np.ndarray, docs: np.ndarray, match: int = MATCH, name: int = NAME) -> np.ndarray:
    """For each sample, bit o says that the string from o bytes before it is in a document with a smaller number.

    ``rows`` holds the bytes around each sample, ``match - name`` before it. Samples are sorted by the ``match`` bytes
    that they start, with the common prefix of neighbours. The suffixes one byte further left are then in order by that
    byte and the order so far; the common prefix of two new neighbours is one more than the least between
    them in the old order, if their bytes agree. Equal strings are neighbours with a common prefix of ``match``.
    """
    reach, n = match - name, len(rows)
    bits = np.zeros(n, dtype=np.uint64)
    if not n:
        return bits
    words = np.zeros((n, -(-match // 8) * 8), dtype=np.uint8)
    words[:, :match] = rows[:, reach:reach + match]
    order = np.lexsort(words.view(">u8").T[::-1])
    own = words[order, :match]
    differ = own[1:] != own[:-1]
    common = np.zeros(n, dtype=np.int16)  # with the neighbour before
    common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), match)
    ends = np.concatenate((np.zeros((n, 1), np.int16), np.cumsum(rows == _END, axis=1, dtype=np.int16)), axis=1)
    for o in range(reach + 1):
        if o:
            byte = rows[order, reach - o]
            step = np.argsort(byte, kind="stable")
            sorted_byte = byte[step]
            new = np.zeros(n, dtype=np.int16)
            same = np.flatnonzero(sorted_byte[1:] == sorted_byte[:-1]) + 1
            if len(same):
                spans = np.stack([step[same - 1] + 1, step[same] + 1], axis=1).ravel()
                # A span may end with the array, and reduceat wants an index within it.
                between = np.minimum.reduceat(np.append(common, np.int16(0)), spans)[::2]
                new[same] = np.minimum(1 + between, match)
            order, common = order[step], new
        first = np.flatnonzero(common < match)
        least = np.repeat(np.minimum.reduceat(docs[order], first), np.diff(np.append(first, n)))
        found = order[(least < docs[order])]
        found = found[ends[found, reach - o + match] == ends[found, reach - o]]
        bits[found] |= np.uint64(1) << np.uint64(o)
    return bits


def strings(codes: np.ndarray, at: np.ndarray, match: int = MATCH, name: int = NAME) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all match-long strings that hold one of the given names at its place."""
    starts = (at[:, None] - np.arange(match - name + 1)).ravel()
    starts = np.unique(starts[(starts >= 0) & (starts <= len(codes) - match)])
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    starts = starts[whole(codes, match)[starts]]
    return starts, grams(codes, match)[starts]


def _packed(name: str, groups: np.ndarray, **columns: np.ndarray) -> pd.DataFrame:
    """One row for each group, with its part of every column as bytes."""
    order = np.argsort(groups, kind="stable")
    values, first = np.unique(groups[order], return_index=True)
    cuts = np.append(first, len(groups))
    out = {name: values.astype(np.int64)}
    for column, data in columns.items():
        data = data[order]
        out[column] = [data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pd.DataFrame(out)


def _unpacked(column: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=kind)


def repeated(docs: DataFrame, match: int = MATCH, text: str = "text", key: str = "doc_id", unit_bytes: int = UNIT_BYTES,
             hot_groups: int = HOT_GROUPS) -> DataFrame:
    """(key, n_bytes, spans, kept) for each row: without the bytes that an earlier document has.

    A byte goes if some ``match`` bytes around it, all within the document, also start in a
    document with a smaller key; all are judged on the input. ``spans`` are the
    maximal removed runs (start, end) in bytes of UTF-8, ``kept`` is what is left, joined. Null texts are empty;
    shorter texts stay whole. Rows that repeat a key do not count against each other; a null key comes after all others.
    Keys are whole numbers. Other columns are not used. Texts are read whole, without a limit to their length.

    Suffixes are not sorted all over: a sample of them is, about one in seventeen, chosen by
    content, and only where its name occurs in two documents. Names travel once for each group of
    documents; samples whose surroundings are equal in a group of documents travel as one, so that a
    text or passage that a third of all documents hold costs a row for each group. Around a hot name,
    such as one in a short line of many documents, surroundings differ: there the strings themselves travel, by
    hash, once for each group of documents, and are spread over all ranges. Spark's sorted and
    spilled shuffle files bring samples together by ranges of names; each range is sorted and induced on its own
    (see ``induced``), and the result goes back to the groups of documents it came from.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "suffixes")
    reach, size = match - NAME, 2 * match - NAME
    # Keys travel as texts: pandas would make doubles of whole numbers with nulls among them.
    own = docs.select(F.col(key).cast("bigint").cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))
    total = own.agg(F.coalesce(F.sum(F.length("bytes") + 1), F.lit(0))).first()[0]
    units = shuffle_width(spark, total, unit_bytes)
    grouped = own.withColumn("unit", F.pmod(F.xxhash64("id"), F.lit(units)))

    def ranges(names: np.ndarray) -> np.ndarray:
        return (names >> np.uint64(32)) % np.uint64(units)

    def coded(names: np.ndarray) -> np.ndarray:
        """A name as its range has it."""
        return (ranges(names) << np.uint64(32)) | (names & np.uint64(0xFFFFFFFF))

    def named(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Names of a task's samples, once for each group of documents, and whether two documents there have them."""
        held: list[tuple[np.ndarray, ...]] = []

        def out():
            names, where, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((where, names))
            names, where, ids = names[order], where[order], ids[order]
            first = np.flatnonzero(np.concatenate(([True], (names[1:] != names[:-1]) | (where[1:] != where[:-1]))))
            many = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
            names, where = names[first], where[first]
            held.clear()
            return _packed("range", ranges(names), names=names.astype(np.uint32), units=where.astype(np.uint32), many=many)

        count = 0
        for frame in frames:
            numbers = np.stack([frame["unit"].to_numpy(), np.arange(count, count + len(frame))], axis=1)
            count += len(frame)
            for rows, texts in _chunks(numbers, list(frame["bytes"])):
                codes, starts = joined(texts)
                at, names = samples(codes, match)
                row = rows[np.searchsorted(starts, at, side="right") - 1]
                held.append((names, row[:, 0], row[:, 1]))
                if sum(len(x[0]) for x in held) >= HELD:
                    yield out()
        if held:
            yield out()

    def shared(frame: pd.DataFrame) -> pd.DataFrame:
        """Names of a range that two documents have, for each group of documents with one of them."""
        names, where = _unpacked(frame["names"], np.uint32), _unpacked(frame["units"], np.uint32)
        many = _unpacked(frame["many"], bool)
        order = np.argsort(names, kind="stable")
        names, where, many = names[order], where[order], many[order]
        first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
        counts = np.diff(np.append(first, len(names)))
        good = np.repeat((counts > 1) | np.logical_or.reduceat(many, first), counts)
        names, where = names[good], where[good]
        codes = (np.uint64(frame["range"].iloc[0]) << np.uint64(32)) | names
        hot = np.repeat(counts >= hot_groups, counts)[good]
        return pd.concat([
            _packed("unit", where[of], one=codes[of]).assign(kind=kind) for kind, of in ((NAMES, ~hot), (HOT, hot))
        ]).assign(two=b"")

    def sampled(docs_of: pd.DataFrame, names_of: pd.DataFrame) -> pd.DataFrame:
        """Surroundings of the shared samples of a group of documents, once each, with the smallest document."""
        shared_names, hot_names = (np.unique(_unpacked(names_of["one"][names_of["kind"] == k], np.uint64)) for k in (NAMES, HOT))
        rows, ids = [np.zeros((0, size), np.uint8)], [np.zeros(0, np.int64)]
        singles, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for numbers, texts in _chunks(_ids(docs_of), list(docs_of["bytes"])):
            codes, starts = joined(texts)
            at, names = samples(codes, match)
            names = coded(names)
            begins, hashes = strings(codes, at[np.isin(names, hot_names)], match)
            singles.append(hashes)
            owners.append(numbers[np.searchsorted(starts, begins, side="right") - 1])
            at = at[np.isin(names, shared_names)]
            rows.append(surroundings(codes, at, reach, size))
            ids.append(numbers[np.searchsorted(starts, at, side="right") - 1])
        rows, ids = np.concatenate(rows), np.concatenate(ids)
        labels = _labels(rows)
        order = np.lexsort((ids, labels))
        first = order[np.concatenate(([True], labels[order][1:] != labels[order][:-1]))] if len(order) else order
        middle = grams(rows[first, reach:reach + NAME].ravel(), NAME)[::NAME] if len(first) else np.zeros(0, np.uint64)
        out = _packed("range", ranges(middle), rows=rows[first], ids=ids[first]).assign(kind=NAMES, many=b"")
        if len(hot_names):
            singles, owners = np.concatenate(singles), np.concatenate(owners)
            values, place = np.unique(singles, return_inverse=True)
            low, high = np.full(len(values), _LAST), np.full(len(values), np.iinfo(np.int64).min)
            np.minimum.at(low, place, owners)
            np.maximum.at(high, place, owners)
            spread = _packed("range", ranges(values), rows=values, ids=low, many=low < high).assign(kind=HOT)
            out = pd.concat([out, spread])
        return out.assign(unit=np.int64(docs_of["unit"].iloc[0]) if len(docs_of) else -1)

    def judged(frame: pd.DataFrame) -> pd.DataFrame:
        """For each group of documents the samples with strings that an earlier document has, and such strings themselves."""
        spread, frame = frame[frame["kind"] == HOT], frame[frame["kind"] == NAMES]
        rows = _unpacked(frame["rows"], np.uint8).reshape(-1, size)
        ids = _unpacked(frame["ids"], np.int64)
        where = np.repeat(frame["unit"].to_numpy(), [len(x) // 8 for x in frame["ids"]])
        bits = induced(rows, ids, match)
        at = np.flatnonzero(bits)
        out = _packed("unit", where[at], one=_labels(rows[at]), two=bits[at]).assign(kind=NAMES)
        hashes, ids = _unpacked(spread["rows"], np.uint64), _unpacked(spread["ids"], np.int64)
        many = _unpacked(spread["many"], bool)
        where = np.repeat(spread["unit"].to_numpy(), [len(x) // 8 for x in spread["ids"]])
        values, place = np.unique(hashes, return_inverse=True)
        least = np.full(len(values), _LAST)
        np.minimum.at(least, place, ids)
        told = (least[place] < ids) | many
        strings_of = _packed("unit", where[told], one=hashes[told], two=least[place][told]).assign(kind=STRINGS)
        return pd.concat([out, strings_of])

    def removed(docs_of: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        """Spans and what is left of each document of a group."""
        kinds = {k: found[found["kind"] == k] for k in (NAMES, HOT, STRINGS)}
        known, order = np.unique(_unpacked(kinds[NAMES]["one"], np.uint64), return_index=True)
        bits_of = _unpacked(kinds[NAMES]["two"], np.uint64)[order]
        hot_names = np.unique(_unpacked(kinds[HOT]["one"], np.uint64))
        known_strings, order = np.unique(_unpacked(kinds[STRINGS]["one"], np.uint64), return_index=True)
        first_of = _unpacked(kinds[STRINGS]["two"], np.int64)[order]
        parts = list(_chunks(_ids(docs_of), list(docs_of["bytes"])))
        seen = []
        for numbers, texts in parts:
            codes, starts = joined(texts)
            at, names = samples(codes, match)
            begins, hashes = strings(codes, at[np.isin(coded(names), hot_names)], match)
            if len(known_strings):
                where = np.minimum(np.searchsorted(known_strings, hashes), len(known_strings) - 1)
                owner = numbers[np.searchsorted(starts, begins, side="right") - 1]
                begins = begins[(known_strings[where] == hashes) & (first_of[where] < owner)]
            else:
                begins = begins[:0]
            owner = numbers[np.searchsorted(starts, at, side="right") - 1]
            seen.append((at, owner, _labels(surroundings(codes, at, reach, size)), begins))
        every = np.concatenate([x[2] for x in seen]) if seen else np.zeros(0, np.uint64)
        owner = np.concatenate([x[1] for x in seen]) if seen else np.zeros(0, np.int64)
        values, place = np.unique(every, return_inverse=True)
        least = np.full(len(values), _LAST)
        np.minimum.at(least, place, owner)
        spans_of, kept_of, start = [], [], 0
        for (numbers, texts), (at, own_ids, labels, begins) in zip(parts, seen, strict=True):
            codes, starts = joined(texts)
            first = place[start:start + len(at)]
            start += len(at)
            bits = np.zeros(len(at), dtype=np.uint64)
            if len(known):
                where = np.minimum(np.searchsorted(known, labels), len(known) - 1)
                bits = np.where(known[where] == labels, bits_of[where], np.uint64(0))
            # Where a smaller document of the group has the same surroundings, all strings in them repeat.
            bits = np.where(own_ids > least[first], np.uint64((1 << (reach + 1)) - 1), bits)
            marks = np.zeros(len(codes) + 1, dtype=np.int8)
            for o in range(reach + 1):
                marks[np.maximum(at[(bits >> np.uint64(o)) & np.uint64(1) == 1] - o, -1)] = 1
            marks[begins] = 1
            marks[-1] = 0
            if len(codes) >= match:
                marks[:len(codes) - match + 1] &= whole(codes, match)
                marks[len(codes) - match + 1:] = 0
            else:
                marks[:] = 0
            sums = np.concatenate((np.zeros(match, np.int32), np.cumsum(marks[:-1], dtype=np.int32)))
            gone = sums[match:] > sums[:-match]
            edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
            begins, ends = edges[::2], edges[1::2]
            cut = np.searchsorted(begins, starts)
            for i, t in enumerate(texts):
                own_spans = [(int(a - starts[i]), int(b - starts[i])) for a, b in zip(
                    begins[cut[i]:cut[i + 1]], ends[cut[i]:cut[i + 1]], strict=True)]
                spans_of.append([{"start": a, "end": b} for a, b in own_spans])
                left = [0, *(b for _, b in own_spans)]
                right = [*(a for a, _ in own_spans), len(t)]
                kept_of.append(b"".join(t[a:b] for a, b in zip(left, right, strict=True)) if own_spans else t)
        return pd.DataFrame({
            "id": docs_of["id"], "n_bytes": [len(t) for t in docs_of["bytes"]], "spans": spans_of, "kept": kept_of,
        })

    by_range = grouped.mapInPandas(named, "range bigint, names binary, units binary, many binary")
    told = "unit bigint, kind int, one binary, two binary"
    names = stages.keep(by_range.groupBy("range").applyInPandas(shared, told), "names")
    texts = grouped.groupBy("unit")
    around = texts.cogroup(names.groupBy("unit")).applyInPandas(
        sampled, "range bigint, rows binary, ids binary, kind int, many binary, unit bigint")
    found = stages.keep(around.groupBy("range").applyInPandas(judged, told), "found")
    found = found.unionByName(names.where(F.col("kind") == HOT))
    return grouped.groupBy("unit").cogroup(found.groupBy("unit")).applyInPandas(
        removed, "id string, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    ).select(F.col("id").cast("bigint").alias(key), "n_bytes", "spans", "kept")


def _ids(docs_of: pd.DataFrame) -> np.ndarray:
    ids = docs_of["id"]
    return np.array([_LAST if i is None else int(i) for i in ids], dtype=np.int64)
