import random

import numpy as np
import pytest

from strata.llm import decontamination as d


def plain(text):
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def brute(item, text, budget):
    """Fewest edits between an item and any part of a text, by the full table; None beyond the budget."""
    a, b = plain(item), plain(text)
    row = [0] * (len(b) + 1)
    for i, c in enumerate(a, 1):
        new = [i]
        for j, e in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != e)))
        row = new
    return min(row) if a and min(row) <= budget else None


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.34:
            out[at] = rng.choice("xyz")
        elif kind < 0.67:
            del out[at]
        else:
            out.insert(at, rng.choice("xyz"))
    return "".join(out)


@pytest.mark.parametrize("seed", range(3))
def test_against_full_alignment(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcde", k=rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.choice([1, 3, 12, 30]))) for i in range(12)] + [(50, ""), (51, "!?")]
    texts = []
    for i in range(30):
        _, item = items[rng.randrange(12)]
        texts.append(f"{prose(rng.randrange(0, 30))}. {edited(rng, item.upper(), rng.randrange(0, max(2, len(item) // 7)))}, {prose(8)}")
    texts += ["", "a", "\0", items[3][1], items[4][1].replace(" ", " -- ")]
    index = d.index_of(items)
    found = {(doc, item): edits for doc, item, edits, _, _ in d.search(index, texts)}
    wanted = {}
    for doc, text in enumerate(texts):
        for n, (item, words) in enumerate(items):
            if (edits := brute(words, text, int(index.budget[n]))) is not None:
                wanted[doc, item] = edits
    assert found == wanted and len({e for e in found.values()}) > 2


def test_places():
    item = "The quick brown fox jumps over the lazy dog near the river bank"
    text = "é — Before it: the  QUICK brown fox; jumps over the lazy dog near teh river bank!! After."
    ((doc, _, edits, start, end),) = d.search(d.index_of([(7, item)]), [text])
    assert edits == 2 and text[start:end] == "the  QUICK brown fox; jumps over the lazy dog near teh river bank"


def test_alignment_stays_in_the_region():
    a = np.array([1, 2, 3, 4, 5, 6])
    assert d.align(a, np.array([9, 1, 2, 3, 4, 5, 6, 9]), 1) == (0, 1, 7)
    assert d.align(a, np.array([2, 3, 4, 5, 6]), 1) == (1, 0, 5)
    assert d.align(a, np.array([9, 9]), 1) is None


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    found = d.leaks(docs, items).collect()
    texts = {k: plain(t) for k, t in docs.select("doc_id", "text").collect()}
    exact = {(k, i) for i, t in items.collect() for k, text in texts.items() if plain(t) in text}
    assert {(r.doc_id, r.item) for r in found if r.edits == 0} == exact and exact
    split = d.leaks(docs.repartition(3), items, block_chars=900).collect()
    assert sorted(map(tuple, split)) == sorted(map(tuple, found))


def test_rows(spark):
    docs = spark.createDataFrame([(1, "some words to be found here", 1), (1, "some words to be found here", 2), (None, "x", 3), (2, None, 4)],
                                 "doc_id long, text string, item int")
    items = spark.createDataFrame([(1, "Words, to be found"), (2, None), (None, "some words")], "item_id int, text string")
    assert sorted(map(tuple, d.leaks(docs, items).collect()), key=str) == [(1, 1, 0, 5, 22)] * 2 + [(1, None, 0, 0, 10)] * 2
    assert d.leaks(docs, items.limit(0)).collect() == [] and d.leaks(docs.limit(0), items).collect() == []


def test_short_items_have_their_edits(spark):
    """One edit in ten characters, also where edits could break every q-gram of eight characters."""
    for n in range(1, 60):
        q, k = d.gram_size(n), int(n * d.EDIT_RATE + 1e-9)
        assert n - q + 1 - k * q >= 1 and (q == d.Q or n < 40), n
    words = "quickbrownfoxjumpsoverthelazydogandmore"
    items = [(i, words[:n]) for i, n in enumerate((7, 10, 14, 20, 23, 30, 31, 39))]
    docs = []
    for i, item in items:
        k = int(len(item) * d.EDIT_RATE + 1e-9)
        for edits in range(k + 2):
            text = list(item)
            for e in range(edits):
                text[(2 * e + 1) * len(item) // (2 * edits)] = "0"
            docs.append((100 * i + edits, "." + "".join(text) + "."))
    found = {(r.doc_id, r.item, r.edits) for r in d.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")).collect()}
    for i, item in items:
        k = int(len(item) * d.EDIT_RATE + 1e-9)
        assert {e for doc, n, e in found if n == i and doc // 100 == i} == set(range(k + 1)), item


def test_large_keys_beside_nulls(spark):
    docs = spark.createDataFrame([(9007199254740993, "words to be found"), (None, "words to be found")], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(9007199254740995, "words to be found"), (None, "nothing of this")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item) for r in d.leaks(docs, items).collect()), key=str)
    assert got == [(9007199254740993, 9007199254740995), (None, 9007199254740995)]
