import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, longest):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    """Counter by counter, one document at a time."""
    def bucket(gram):
        return zlib.crc32(gram.encode()) % buckets
    s = Counter(bucket(g) for _, t in docs for g in grams(t, longest)[1])
    t = Counter(bucket(g) for x in target for g in grams(x, longest)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for key, text in docs:
        words, found = grams(text, longest)
        weight = sum(gain[bucket(g)] for g in found)
        rows.append([key, len(words), len(found), weight, weight + importance.noise(key, seed), None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1], r[2], r[3]))
    for rank, row in enumerate(able[:len(able) * percent // 100]):
        row[5] = rank + 1
    return sorted(map(tuple, rows), key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_whole_table_against_brute_force(spark, longest):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = importance.resample(docs.repartition(3), target, longest=longest)
    assert result(got) == brute([tuple(r) for r in docs.collect()], [r.text for r in target.collect()], longest)


def test_features_of_a_batch_are_those_of_its_texts():
    texts = ["a b c", "", "D", "x-y\x00é 9é", " ", "ein Wort", "a b"]
    of, bucket, words = importance.features([t.encode() for t in texts], 3, 997)
    got = Counter(zip(of.tolist(), bucket.tolist()))
    assert got == Counter((i, zlib.crc32(g.encode()) % 997) for i, t in enumerate(texts) for g in grams(t, 3)[1])
    assert words.tolist() == [len(grams(t, 1)[0]) for t in texts]
    assert [len(x) for x in importance.features([], 2)] == [0, 0, 0] and len(importance.features([b"- -"], 3)[0]) == 0


def test_batches_are_bounded(monkeypatch):
    monkeypatch.setattr(importance, "JOINED", 10)
    got = list(importance._batches(["abcdef", "ghijkl", None, "x" * 50, "y", ""]))
    assert [(a, len(b)) for a, b in got] == [(0, 1), (1, 2), (3, 1), (4, 2)]


def test_odd_rows_ties_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(importance, "RANGE_ROWS", 7)
    long = "one two three four five six seven eight nine ten " * 2
    docs = [(i, long + (" extra" if i % 3 else "")) for i in range(40)] + [(5, long)] * 30 + [(None, long)] * 25
    docs += [(900, None), (901, ""), (902, "?!"), (903, "short"), (9007199254740993, long.upper()), (None, None), (904, "word " * 60_000)]
    df = spark.createDataFrame([(k, t, 7, "y") for k, t in docs], "doc_id long, text string, rank int, part string").repartition(4)
    target = spark.createDataFrame([("one two three", 1), (None, 2)], "text string, n int")
    assert result(importance.resample(df, target, percent=60)) == brute(docs, ["one two three", None], percent=60)
    assert result(importance.resample(df, target.limit(0), percent=100)) == brute(docs, [], percent=100)
    assert importance.resample(df.limit(0), target).collect() == []


def test_gains_follow_the_shares():
    gain = importance.gains(np.array([10, 0, 5]), np.array([0, 0, 20]))
    assert gain[2] > 0 > gain[0] and gain[1] == math.floor(1000 * math.log(1 * 18 / 23))
