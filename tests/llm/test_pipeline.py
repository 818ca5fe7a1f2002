import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm import language_id

from .test_decontamination import plain
from .test_minhash import brute as near
from .test_packing import check
from .test_secret_scan import brute as secrets

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_all_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = language_id.train(docs.where(~language_id.held_out()))
    kept = {k: t for k, t in rows.items() if language_id.classify(model, t)[0] != "und"}
    groups = near(list(kept.items()), 5, 80)
    kept = {k: t for k, t in kept.items() if groups[k][2]}
    items = [plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaking = {k for k, t in kept.items() if any(i in plain(t) for i in items)}
    kept = {k: t for k, t in kept.items() if k not in leaking}
    kept = {k: t for k, t in kept.items() if not secrets(t)}
    assert leaking and len(kept) < len(rows)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    check(corpus_pipeline.run(spark, FOLDER).collect(), list(kept.items()), tokenizer, 2048)


@pytest.mark.parametrize("rows", [[], [
    (1, "the words of a text", "en", "a", 1), (1, "the words of a text", "en", "a", 1), (None, "the words of a text", None, None, None),
    (2, None, "en", None, 0), (3, "", None, "b", None), (4, "?!", "en", "c", 2), (5, "words password=abcdefghij", "en", "d", 5),
]])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")], name
        docs = spark.createDataFrame(docs.collect(), SCHEMA)
    left = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    assert left == ([(1, "the words of a text")] if rows else [])
    assert len(corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()) == len(left)


def test_rows_are_judged_by_their_own_texts(spark):
    item, other = (r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").where("length(text) > 80").take(2))
    one, two, three = ("".join(f"{w}{i} " for i in range(60)) for w in ("north", "south", "west"))
    rows = [(1, one, 10), (1, two, 11), (1, None, 12), (2, one, 13), (None, one, 14), (None, three, 15), (None, three, 16),
            (3, f"some words {item} and more", 17), (3, "clean words of a repeated id", 18),
            (None, f"other words {other} and so on", 19), (None, "clean words without an id", 20)]
    docs = spark.createDataFrame([(k, t, "en", "a", 1, n) for k, t, n in rows], SCHEMA + ", row long")
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    left = {r.row for r in kept.collect()}
    assert {10, 11, 12, 17, 18, 19, 20} <= left and not left & {13, 14} and len(left & {15, 16}) == 1 and len(left) == 8
    clean = corpus_pipeline.decontaminate(spark, docs, FOLDER)
    assert clean.columns == docs.columns
    assert sorted(r.row for r in clean.collect()) == [10, 11, 12, 13, 14, 15, 16, 18, 20]
