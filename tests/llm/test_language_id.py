import math
from collections import Counter

import pytest

from strata.llm import language_id as li


def plain_counts(text):
    """Bucket counts by one n-gram at a time."""
    codes = [int(c) for c in li._codes(text)]
    out = Counter()
    for order in li.ORDERS:
        for i in range(len(codes) - order + 1):
            x = 0
            for c in codes[i:i + order]:
                x = (x + c + order) * int(li._MIX) % (1 << 64)
                x ^= x >> 29
            out[(x * int(li._MIX) % (1 << 64)) >> 49] += 1
    return out


def plain_model(rows):
    known = sorted({lang for _, lang in rows if lang is not None})
    texts = {k: [t for t, lang in rows if lang == k and t is not None] for k in known}
    counts = {k: sum((plain_counts(t) for t in v), Counter()) for k, v in texts.items()}
    n = sum(map(len, texts.values()))

    def scores(text):
        seen = plain_counts(text)
        return [math.log(len(texts[k]) / n) + sum(
            m * math.log((counts[k][b] + li.SMOOTHING) / (sum(counts[k].values()) + li.SMOOTHING * li.BUCKETS))
            for b, m in seen.items()) for k in known]
    return known, scores


def test_against_plain_bayes(spark):
    rows = [(r.text[:300], r.lang) for r in
            spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(40).collect()]
    known, scores = plain_model(rows)
    model = li.train(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    assert list(model.languages) == known
    for text in ["the and of", "est un des", "Ü", rows[0][0], rows[7][0]]:
        wanted = scores(text)
        best = max(wanted)
        assert li.classify(model, text)[0] == known[wanted.index(best)]
        assert li.classify(model, text)[1] == pytest.approx(1 / sum(math.exp(s - best) for s in wanted), rel=1e-6)


def test_pieces_of_long_texts(monkeypatch):
    text = "Straße été 12 naïve—word " * 400
    whole = li.counts_of(text)
    monkeypatch.setattr(li, "CHUNK", 97)
    assert (li.counts_of(text) == whole).all() and whole.sum() == sum(plain_counts(text).values())


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.withColumn("held_out", li.held_out())
    model = li.train(docs.where("not held_out"))
    right, n = li.predict(docs.where("held_out"), model).selectExpr("avg(int(lang = lang_pred))", "count(*)").first()
    assert n > 200 and right > 0.98


def test_rows(spark):
    df = spark.createDataFrame([(1, "abc", "en", 5), (1, "abc", "en", 5), (2, None, None, 1), (None, "", "de", 2), (3, "1 2 3!", "en", 0)],
                               "doc_id long, text string, lang string, score int")
    model = li.train(df)
    assert model.languages == ("de", "en")
    got = sorted((str(r.doc_id), r.lang_pred, 0 < r.score <= 1) for r in li.predict(df, model).collect())
    assert got == [("1", "en", True), ("1", "en", True), ("2", "und", False), ("3", "und", False), ("None", "und", False)]
    assert li.predict(df, model).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    nothing = li.train(df.limit(0))
    assert nothing.languages == () and li.classify(nothing, "abc") == ("und", 0.0)
    assert li.predict(df.limit(0), model).collect() == []


def test_names_of_other_columns(spark):
    df = spark.createDataFrame([(1, "abc", "en", "mine")], "doc_id long, text string, lang string, judged string")
    assert li.predict(df, li.train(df)).select("judged", "lang_pred").collect() == [("mine", "en")]
