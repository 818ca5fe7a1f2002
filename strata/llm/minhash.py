"""Near-duplicate documents: MinHash signatures, an inverted join on their coordinates, links confirmed on whole sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Stages, components
from strata.llm.shingles import mixed, shingle_set

#: Coordinates of a signature.
COORDINATES = 64
#: How probable it may be that signatures of two documents just at the threshold match too rarely.
MISS = 1e-7
_CHUNK = 4096


def least_matches(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Most matches m such that documents at the threshold have fewer with probability ``miss`` at most."""
    p, below = percent / 100, 0.0
    for m in range(coordinates + 1):
        below += math.comb(coordinates, m) * p**m * (1 - p) ** (coordinates - m)
        if below > miss:
            return max(m, 1)
    return coordinates


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The least 32-bit hash of the set under each of the hash functions."""
    by = mixed(np.arange(1, coordinates + 1, dtype=np.uint64)) | np.uint64(1)
    low = np.full(coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), _CHUNK):
        np.minimum(low, (by[:, None] * shingles[None, start:start + _CHUNK]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, words: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(id, mark, n_shingles, two sums that tell the set, signature) of each row; the signature is null for an empty set.

    The mark is a hash of the text: with the id, it finds the text again.
    """
    kind = docs.schema[key].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for words_of in batch.column("text").to_pylist():
                found = shingle_set(words_of, words)
                if len(found):
                    one, two = int(found.sum(dtype=np.uint64)), int(mixed(found).sum(dtype=np.uint64))
                    rows.append((len(found), _signed(one), _signed(two), signature(found).view(np.int32)))
                else:
                    rows.append((0, 0, 0, None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 4, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"), *columns], ["id", "mark", "n_shingles", "one", "two", "signature"])

    return docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text")).mapInArrow(
        signed, f"id {kind}, mark bigint, n_shingles bigint, one bigint, two bigint, signature array<int>"
    )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _posted(reps: DataFrame, stages: Stages, least: int) -> DataFrame:
    """(token, id, n, score) for the prefix of each signature: its K - T + 1 rarest coordinate values.

    Two signatures that match in T of K coordinates share a token in these prefixes, as both are in the same order.
    Tokens that one document alone has come first in that order and post nothing. The score is how often others
    have the document's tokens: the largest in a group of copies is nearest to what they are copies of.
    """
    tokens = reps.select("id", F.col("n_shingles").alias("n"), F.posexplode("signature").alias("at", "value")).select(
        "id", "n", (F.col("at").cast("bigint") * (1 << 32) + F.col("value")).alias("token")
    )
    shared = stages.keep(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "shared")
    ranked = tokens.join(shared, "token").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("all"))
    prefix = F.lit(COORDINATES - least + 1)
    room = F.greatest(prefix - (F.lit(COORDINATES) - F.size("all")), F.lit(0))
    score = F.aggregate("all", F.lit(0).cast("bigint"), lambda s, x: s + x["df"])
    return stages.keep(
        ranked.select("id", "n", score.alias("score"), F.explode(F.slice("all", F.lit(1), room)).alias("x"))
        .select("id", "n", "score", F.col("x.token").alias("token")), "prefix"
    )


def _with_signatures(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    a, b = (reps.select(F.col("id").alias(c), F.col("signature").alias(f"s{c}")) for c in "ab")
    return pairs.join(a, "a").join(b, "b")


def _matching(pairs: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """The pairs whose signatures match in ``least`` coordinates, with their ``matches``: the rest of the count, from the signatures."""
    equal = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return _with_signatures(pairs, reps).select(*pairs.columns, equal.alias("matches")).where(F.col("matches") >= least)


def _compared(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, na, nb, linked, delta) of each pair, from the whole texts.

    Linked: 100 * intersection >= percent * union. The delta holds the shingles that a has and b lacks, and, inverted,
    those that b has and a lacks.
    """
    kind = texts.schema["id"].dataType.simpleString()

    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for frame in frames:
            rows = []
            for a, b, one, two in zip(frame["a"], frame["b"], frame["ta"], frame["tb"], strict=True):
                if b not in held:
                    if len(held) >= 16:
                        held.clear()
                    held[b] = shingle_set(two, words)
                x, y = shingle_set(one, words), held[b]
                more = np.setdiff1d(x, y, assume_unique=True)
                both = len(x) - len(more)
                less = ~np.setdiff1d(y, x, assume_unique=True)
                delta = np.concatenate((more, less)).view(np.int64)
                rows.append((a, b, len(x), len(y), 100 * both >= percent * (len(x) + len(y) - both), delta))
            yield pd.DataFrame(rows, columns=["a", "b", "na", "nb", "linked", "delta"], dtype=object)

    a, b = (texts.select(F.col("id").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInPandas(
        compared, f"a {kind}, b {kind}, na bigint, nb bigint, linked boolean, delta array<bigint>")


def _by_delta(compared: DataFrame, near: DataFrame, percent: int, stages: Stages) -> DataFrame:
    """Pairs (a, b) of documents compared with the same third one, of which one at least is not linked to it.

    The difference of two sets is that of their deltas. So deltas of x and y elements of similar documents have at least
    m = (x + y - r * (na + nb)) / 2 elements in common, where r = (100 - percent) / (100 + percent), and m is
    over 0 if a document of the two is not linked. With all deltas in one order, rarest first, the first
    common element is then among the first x - m + 1 and y - m + 1. The edits of unrelated copies are
    rare, so a group of copies does not meet itself.
    """
    # As a table of its own, so that the join can split a third document that very many were compared with.
    open_groups = stages.keep(compared.where("not linked").select("b").distinct(), "open-groups")
    deltas = (
        compared.join(open_groups, "b", "left_semi")
        .join(near.withColumnRenamed("id", "a"), "a", "left").withColumn("component", F.coalesce("component", "a"))
    )
    entries = deltas.select("b", "a", "na", "linked", "component", F.size("delta").alias("size"), F.explode("delta").alias("e"))
    df = entries.groupBy("b", "e").agg(F.count("*").alias("df")).where("df > 1")
    # Elements that no other document of the group has come first and meet nothing.
    ranked = (
        entries.join(df, ["b", "e"]).groupBy("b", "a", "na", "linked", "component", "size")
        .agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("all"))
        .select("b", "a", "na", "linked", "component", "size", F.size("all").alias("met"), F.posexplode("all").alias("at", "x"))
        .select("b", F.col("x.e").alias("e"), "a", "na", "linked", "component", "size",
                (F.col("at") + F.col("size") - F.col("met")).alias("rank"))
    )
    one = ranked.where("not linked").select("b", "e", *[F.col(c).alias(f"{c}1") for c in ("a", "na", "component", "size", "rank")])
    two = ranked.select("b", "e", *[F.col(c).alias(f"{c}2") for c in ("a", "na", "linked", "component", "size", "rank")])
    ratio = F.lit((100 - percent) / (100 + percent))
    least = F.ceil((F.col("size1") + F.col("size2") - ratio * (F.col("na1") + F.col("na2")) - F.lit(1e-9)) / 2)
    near_enough = (
        (least <= F.least("size1", "size2")) & (F.col("rank1") <= F.col("size1") - least) & (F.col("rank2") <= F.col("size2") - least)
    )
    # Two documents that are not linked to the third would meet from both sides.
    once = F.col("linked2") | (F.col("a1") > F.col("a2"))
    return (
        one.join(two, ["b", "e"]).where(near_enough & once & F.expr("component1 <> component2"))
        .select(F.greatest("a1", "a2").alias("a"), F.least("a1", "a2").alias("b")).distinct()
    )


def _by_tokens(star: DataFrame, near: DataFrame, reps: DataFrame, least: int, met: int, stages: Stages) -> DataFrame:
    """Pairs (a, b) of documents that had the same first one in a list, of which one at least matches it in under ``met`` coordinates.

    Where both have the first one's values, they have no more matches than either has with it: least(m, n). The rest of
    what a link needs, t = ``least`` - least(m, n), which is over 0, has to come from values that the first one has not. With those
    in one order, rarest of the group first, the first common value is then among the first 64 - m - t + 1 and 64 - n - t + 1. Values
    that come from a copy's own edits are rare, so a group of copies does not meet itself.
    """
    apart = (
        star.join(near.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left")
        .join(near.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left")
        .select("a", "b", "n", "matches", F.coalesce("ca", "a").alias("component"), F.coalesce("cb", "b").alias("firsts"))
    )
    open_groups = stages.keep(
        apart.groupBy("b").agg(F.min(F.least("component", "firsts")).alias("low"), F.max(F.greatest("component", "firsts")).alias("high"),
                               F.min("matches").alias("fewest"))
        .where((F.col("low") < F.col("high")) & (F.col("fewest") < met)).select("b"), "open-stars")
    # The most matches with the first one that count, in a pair with a document that was not met.
    low = F.least(F.col("matches"), F.lit(met - 1))
    group = stages.keep(
        apart.join(open_groups, "b", "left_semi").where(F.lit(COORDINATES) - F.col("matches") >= F.lit(least) - low)
        .select("a", "b", "n", "matches", "component"), "stars")
    other = F.filter(
        F.transform("sa", lambda v, i: F.when(v != F.element_at("sb", i + 1), i.cast("bigint") * (1 << 32) + v)), lambda x: x.isNotNull())
    entries = _with_signatures(group, reps).select("b", "a", "n", "matches", "component", F.explode(other).alias("e"))
    df = entries.groupBy("b", "e").agg(F.count("*").alias("df")).where("df > 1")
    posted = (
        entries.join(df, ["b", "e"]).groupBy("b", "a", "n", "matches", "component")
        .agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("all"))
        .select("b", "a", "n", "matches", "component", F.size("all").alias("shared"), F.posexplode("all").alias("at", "x"))
        # Values that no other document of the group has come first and meet nothing.
        .select("b", F.col("x.e").alias("e"), "a", "n", "matches", "component",
                (F.col("at") + (F.lit(COORDINATES) - F.col("matches")) - F.col("shared")).alias("rank"))
        .where(F.col("rank") <= F.lit(COORDINATES) - F.col("matches") - F.lit(least) + low)
    )
    posted = stages.keep(posted, "posted")
    names = ("a", "n", "matches", "component", "rank")
    one = posted.where(F.col("matches") < met).select("b", "e", *[F.col(c).alias(f"{c}1") for c in names])
    two = posted.select("b", "e", *[F.col(c).alias(f"{c}2") for c in names])
    need = F.lit(least) - F.least("matches1", "matches2")
    near_enough = (
        (F.col("rank1") <= F.lit(COORDINATES) - F.col("matches1") - need) & (F.col("rank2") <= F.lit(COORDINATES) - F.col("matches2") - need)
    )
    # Two documents that were not met would find one another from both sides.
    once = (F.col("matches2") >= met) | (F.col("a1") > F.col("a2"))
    return (
        one.join(two, ["b", "e"]).where(near_enough & once & F.expr("component1 <> component2"))
        .select(F.greatest("a1", "a2").alias("a"), F.least("a1", "a2").alias("b"), "n1", "n2").distinct()
    )


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row: documents joined by links of that similarity.

    A document's set is its distinct shingles of ``words`` words (A-Z lower-cased, ASCII white
    space between words); with fewer words, the whole sequence. Null, empty and word-free texts have an empty set and no
    links. ``component_id`` is the smallest key that links reach, ``kept`` whether it is the row's own. Rows are linked by
    their sets, so of rows that repeat a key each has the component of its own text, which may be kept for several. A null
    key is its own component and kept. Other columns are not used.

    Documents with equal sets are one class, with a number of its own, and meet as sums only. Of each class one signature is
    posted under its rarest coordinate values (see ``_posted``). Each is first paired with the most typical of every
    list it is in, so that a large group costs its size and not its square, and matches are counted. Those that match it in
    two thirds of what a link needs are compared with it on the whole texts. What that leaves apart is found, across
    components, by how documents differ from the one they had in common: by the shingles of those that were compared with it
    (see ``_by_delta``), by the coordinate values of the others (see ``_by_tokens``). These pairs
    too are dropped if they match in fewer coordinates than the threshold, and confirmed on
    the whole texts. Links within a component are not needed for the result.
    """
    stages = Stages(docs.sparkSession, "minhash")
    least = least_matches(percent)
    met = max(least * 2 // 3, 1)
    signed = stages.keep(signatures(docs, words, text, key), "signed")
    real = signed.where("n_shingles > 0 and id is not null")
    # Numbered once and written, so that all later reads see the same numbers.
    classes = stages.keep(
        real.groupBy("one", "two", "n_shingles").agg(F.min(F.struct("id", "mark")).alias("least"), F.first("signature").alias("signature"))
        .withColumn("class", F.monotonically_increasing_id()), "classes")
    reps = classes.select(F.col("class").alias("id"), "n_shingles", "signature")
    prefix = _posted(reps, stages, least)
    wanted = classes.select("class", F.col("least.id").alias("id"), F.col("least.mark").alias("mark")).join(
        prefix.select(F.col("id").alias("class")), "class", "left_semi")
    texts = stages.keep(
        docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text")).join(wanted, ["id", "mark"])
        .select(F.col("class").alias("id"), "text").dropDuplicates(["id"]), "texts"
    )
    first = (
        prefix.groupBy("token").agg(F.min(F.struct((-F.col("score")).alias("rank"), "id")).alias("first"))
        .select("token", F.col("first.id").alias("b"))
    )
    star = prefix.select("token", F.col("id").alias("a"), "n").join(first, "token").where("a <> b").select("a", "b", "n").distinct()
    star = stages.keep(_matching(star, reps, 0), "star")
    # Deltas are exact at any distance, so more is compared here than can be linked.
    compared = stages.keep(_compared(star.where(F.col("matches") >= met).select("a", "b"), texts, words, percent), "compared")
    links = compared.where("linked").select("a", "b")
    near = stages.keep(components(links, stages, "near"), "near")

    alike = (F.col("n1") * 100 >= F.col("n2") * percent) & (F.col("n2") * 100 >= F.col("n1") * percent)
    rest = _by_tokens(star, near, reps, least, met, stages).where(alike).select("a", "b")
    rest = rest.union(_by_delta(compared, near, percent, stages)).distinct()
    rest = stages.keep(_matching(rest, reps, least), "rest")
    more = stages.keep(_compared(rest.select("a", "b"), texts, words, percent).where("linked").select("a", "b"), "rest-links")
    found = near if more.isEmpty() else stages.keep(components(links.union(more), stages, "all"), "found")

    placed = classes.join(found.withColumnRenamed("id", "class"), "class", "left").select(
        "one", "two", "n_shingles", F.coalesce("component", "class").alias("component"), F.col("least.id").alias("least"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(smallest, "component").select("one", "two", "n_shingles", "component_id")
    linked = real.select("id", "n_shingles", "one", "two").join(named, ["one", "two", "n_shingles"]).select("id", "n_shingles", "component_id")
    alone = signed.where("n_shingles = 0 or id is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    return linked.union(alone).select(
        F.col("id").alias(key), "n_shingles", "component_id",
        F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"),
    )
