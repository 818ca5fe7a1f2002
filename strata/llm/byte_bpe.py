"""Byte-level BPE: long texts are encoded in overlapping chunks that are stitched where their words agree."""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType
from pyspark.sql.window import Window

from strata.llm.common import Stages
from strata.llm.packing import encoder

#: Code points from one chunk's start to the next, and how many of the next one's a chunk also holds.
CHUNK = 1 << 16
OVERLAP = 1 << 10
#: Code points before a chunk's end that its end may have changed the words of: a match looks no further ahead.
MARGIN = 4
_RUN = 1 << 33  # rows that one task may number
_ROWS = 256  # rows of a batch that are worked on, and handed on, at a time
_tables: dict[str, list[bytes]] = {}


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def token_bytes(ranks: str) -> list[bytes]:
    """The bytes of each id, from a file of ``base64-token rank`` lines; once for each process."""
    if ranks not in _tables:
        with open(ranks, "rb") as lines:
            found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
        _tables[ranks] = [found.get(i, b"") for i in range(max(found) + 1)]
    return _tables[ranks]


def encoded(text: str, ranks: str, pattern: str) -> np.ndarray:
    """The ids of a text, as ``tiktoken`` gives them without special tokens.

    Its pattern engine refuses white space of about 1,000,000 characters. Such a text is cut into the pattern's matches
    by ``regex``, and each is encoded by itself, which is what the pattern asks for.
    """
    bpe = encoder(ranks, pattern)
    try:
        return bpe.encode_to_numpy(text, disallowed_special=())
    except ValueError:
        out = []
        for match in regex.finditer(pattern, text):
            out += bpe._encode_single_piece(match.group())
        return np.array(out, dtype=np.uint32)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int64).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def _told_apart(before: str, after: str) -> bool:
    """Whether any word ends between two characters, whatever is left and right of them.

    No match holds a letter or digit followed by another kind of character. Characters without a category are left
    out, as engines of other Unicode versions may know them.
    """
    a, b = unicodedata.category(before), unicodedata.category(after)
    return a[0] in "LN" and b[0] != a[0] and b != "Cn"


def word_starts(text: str, pattern: str, low: int, high: int) -> list[int]:
    """Where words start in [low, high) if the text is cut from its beginning, at clear ends of a word only."""
    return [
        m.start() for m in regex.finditer(pattern, text)
        if low <= m.start() < high and m.start() and _told_apart(text[m.start() - 1], text[m.start()])
    ]


def _chunks(docs: DataFrame, text: str, key: str, chunk: int, overlap: int) -> DataFrame:
    """(row, key, at, chunks, text) for each chunk of each text; ``row`` numbers the rows."""
    kind = docs.schema[key].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() * _RUN
        for batch in _slices(batches):
            for i, whole in enumerate(batch.column("text").to_pylist()):
                parts = range(0, len(whole), chunk)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row] * len(parts), pa.int64()), batch.column("key").take(pa.array([i] * len(parts), pa.int64())),
                    pa.array(range(len(parts)), pa.int64()), pa.array([len(parts)] * len(parts), pa.int64()),
                    pa.array([whole[at:at + chunk + overlap] for at in parts], pa.string()),
                ], ["row", "key", "at", "chunks", "text"])
                row += 1

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        cut, f"row bigint, key {kind.simpleString()}, at bigint, chunks bigint, text string")


def _seams(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(row, at, head, tail): word starts of each chunk where the one before it, and where the next one, also has text."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for at, text in zip(batch.column("at").to_pylist(), batch.column("text").to_pylist(), strict=True):
                starts = [at * chunk + i for i in word_starts(text, pattern, 0, max(len(text) - MARGIN, 0))]
                heads.append([i for i in starts if i < at * chunk + overlap])
                tails.append([i for i in starts if i >= (at + 1) * chunk])
            places = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("at"), pa.array(heads, places), pa.array(tails, places)],
                ["row", "at", "head", "tail"])

    return chunks.mapInArrow(found, "row bigint, at bigint, head array<bigint>, tail array<bigint>")


def _long(docs: DataFrame, ranks: str, pattern: str, text: str, key: str, chunk: int, overlap: int, stages: Stages) -> DataFrame:
    chunks = stages.keep(_chunks(docs, text, key, chunk, overlap), "chunks")
    spread = chunks.select("row", "at", "text").repartition("row", "at")
    seams = stages.keep(_seams(spread, pattern, chunk, overlap), "seams")
    # Chunks agree from the first word start that both have; the cut before it is the left one's, behind it the right one's.
    left = seams.select("row", (F.col("at") + 1).alias("at"), "tail")
    met = seams.select("row", "at", "head").join(left, ["row", "at"], "left").select(
        "row", "at", F.when(F.col("at") == 0, F.lit(0).cast("bigint")).otherwise(F.array_min(F.array_intersect("head", "tail"))).alias("start"))
    # A chunk that never agrees with the one before it goes on with it. Only three numbers of each chunk are sorted here.
    by_row = Window.partitionBy("row").orderBy("at")
    spans = met.withColumn("run", F.max(F.when(F.col("start").isNotNull(), F.col("at"))).over(by_row)).withColumn(
        "stop", F.min("start").over(by_row.rowsBetween(1, Window.unboundedFollowing)))
    placed = chunks.join(stages.keep(spans.select("row", "at", "run", "start", "stop"), "spans"), ["row", "at"])
    own = F.when(F.col("at") == F.col("run"), F.col("start")).otherwise(F.col("at") * chunk)
    part = F.struct("at", (own - F.col("at") * chunk).alias("begin"), (F.col("stop") - F.col("at") * chunk).alias("beyond"), "text")
    runs = placed.groupBy("row", "run").agg(F.first("key").alias("key"), F.array_sort(F.collect_list(part)).alias("parts"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column("parts").to_pylist():
                # All but the last part of a run end where the next one starts.
                cut = [p["text"][p["begin"]:(chunk if p is not parts[-1] else p["beyond"])] for p in parts]
                out.append(encoded("".join(cut), ranks, pattern))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("run"), batch.column("key"), _lists(out)],
                ["row", "run", "key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    ids = runs.mapInArrow(encode, f"row bigint, run bigint, key {kind}, ids array<int>")
    ordered = ids.groupBy("row").agg(
        F.first("key").alias(key), F.array_sort(F.collect_list(F.struct("run", "ids"))).alias("all"))
    return ordered.select(key, F.flatten(F.transform("all", lambda x: x["ids"])).alias("ids"))


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", key: str = "doc_id",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, ids) of every row: its whole text encoded by the ranks, each match of the pattern by itself.

    A null or empty text has no ids, special strings are ordinary text. Repeated rows and null keys are rows like any
    other, other columns are not used, and no rows give none.

    A text of one chunk is encoded where it is read. Longer ones become chunks of ``chunk`` code points that hold
    ``overlap`` more of what follows; tasks cut the chunks into words, and two neighbours are joined at the first word start
    both have in their overlap, which is a word start of the whole text. The pieces between these places are encoded in
    parallel and put together in order. Chunks without such a place, such as those of one endless word,
    are encoded as one piece, as a word can't be encoded in parts.
    """
    if not MARGIN < overlap <= chunk:
        raise ValueError(f"overlap has to be over {MARGIN} and at most chunk")
    long = F.coalesce(F.length(text) > chunk, F.lit(False))
    kind = docs.schema[key].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids = [encoded(x or "", ranks, pattern) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), _lists(ids)], [key, "ids"])

    short = docs.where(~long).select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        whole, f"`{key}` {kind}, ids array<int>")
    return short.union(_long(docs.where(long), ranks, pattern, text, key, chunk, overlap, Stages(docs.sparkSession, "byte-bpe")))


def decode(ids: DataFrame, ranks: str, column: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the bytes that each row's ids stand for, one behind the other; null ids have none.

    Bytes, not text: ids may end within a character. Ids that the ranks lack raise IndexError.
    """
    schema = StructType([*ids.schema, StructField(name, BinaryType())])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(ranks)
        for batch in _slices(batches):
            held = batch.column(column)
            values, ends = held.flatten().to_numpy(), pc.fill_null(pc.list_value_length(held), 0).to_numpy().cumsum().tolist()
            # One row's ids at a time are Python numbers.
            found = [b"".join([table[i] for i in values[a:b].tolist()]) for a, b in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, name])

    return ids.mapInArrow(joined, schema)
