import random
import time

import numpy as np
import pytest

from strata.llm import suffix_dedup as s


def brute(docs, match=50):
    """(n_bytes, spans, kept) by a table of all strings with their smallest document."""
    raw = [(k, (t or "").encode()) for k, t in docs]
    order = {k: (k is None, k or 0) for k, _ in raw}
    first = {}
    for k, b in raw:
        for i in range(len(b) - match + 1):
            w = b[i:i + match]
            first[w] = min(first.get(w, order[k]), order[k])
    out = []
    for k, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - match + 1):
            if first[b[i:i + match]] < order[k]:
                gone[i:i + match] = b"\1" * match
        spans, at = [], 0
        while (at := gone.find(1, at)) >= 0:
            end = gone.find(0, at) if 0 in gone[at:] else len(b)
            spans.append((at, end))
            at = end
        out.append((k, len(b), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, [tuple(x) for x in r.spans], bytes(r.kept)) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_against_all_strings(spark, seed, monkeypatch):
    monkeypatch.setattr(s, "CHUNK", 700)
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abé \n", k=n)) for n in (20, 49, 50, 51, 52, 60, 130, 400)] + ["a" * 90, "ab" * 60, "\0" * 55]
    docs = [(k, "".join(rng.choice([rng.choice(pool), "".join(rng.choices("abcdefgh", k=rng.randrange(40)))])
                        for _ in range(rng.randrange(8)))) for k in rng.sample(range(-50, 900), 60)]
    docs += [(docs[0][0], docs[1][1]), (1000, None), (1001, ""), (None, docs[2][1]), (None, docs[2][1]), (1002, pool[-1] * 60)]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, unit string, id int").repartition(3)
    assert result(s.repeated(df, unit_bytes=3000)) == brute(docs)
    # All names in at least three, or two, groups of documents as hot ones.
    assert result(s.repeated(df, unit_bytes=3000, hot_groups=3 - seed)) == brute(docs)


def test_rows_in_another_order_at_each_pass(spark):
    """Shuffled rows come as their blocks arrive: what is said of a document must not depend on the rows beside it."""
    rng = random.Random(5)
    pool = ["".join(rng.choices("abcdefgh", k=n)) for n in (50, 60, 75, 90)]
    docs = [(k, rng.choice(pool) + "".join(rng.choices("ijklm", k=k % 4))) for k in range(80)]

    def shuffled(frames):
        for frame in frames:
            yield frame.sample(frac=1, random_state=time.time_ns() % 2 ** 32)

    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).mapInPandas(shuffled, "doc_id long, text string")
    assert result(s.repeated(df, unit_bytes=1000)) == brute(docs)
    assert result(s.repeated(df, unit_bytes=1000, hot_groups=2)) == brute(docs)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert result(s.repeated(docs)) == brute([tuple(r) for r in docs.collect()])


def test_no_rows(spark):
    assert s.repeated(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_common_prefixes_are_induced():
    """Each order and its common prefixes are those of sorting the strings themselves: seen by what counts as equal."""
    rng = np.random.default_rng(3)
    rows = rng.integers(97, 99, (400, 84)).astype(np.uint8)
    rows[100:300, 10:70] = rows[0, 10:70]
    docs = rng.permutation(400).astype(np.int64)
    bits = s.induced(rows, docs)
    for o in range(35):
        strings = [bytes(r[34 - o:84 - o]) for r in rows]
        least = {}
        for w, d in zip(strings, docs, strict=True):
            least[w] = min(least.get(w, d), d)
        assert [bool(b >> o & 1) for b in map(int, bits)] == [least[w] < d for w, d in zip(strings, docs, strict=True)]


def test_large_keys_beside_nulls(spark):
    text = "a passage that is long enough to be removed from all documents but one, and some more"
    rows = [(9007199254740993, text), (9007199254740995, "before " + text), (None, text + " after")]
    got = {r.doc_id: len(r.spans) for r in s.repeated(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert got == {9007199254740993: 0, 9007199254740995: 1, None: 1}
