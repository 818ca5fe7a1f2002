import random

import public_tokenizers
import pytest
import tiktoken

from strata.llm import byte_bpe
from strata.llm.packing import encoder

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, ids string, row long"


def plain(text):
    return encoder(RANKS, PATTERN).encode_ordinary(text or "")


def result(df):
    done = byte_bpe.decode(df, RANKS)
    return [(r.doc_id, list(r.ids), bytes(r.decoded)) for r in done.collect()]


def want(docs):
    return [(k, plain(t), (t or "").encode()) for k, t in docs]


def test_whole_table_against_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = result(byte_bpe.encode(docs, RANKS, PATTERN, chunk=4096, overlap=256))
    assert sorted(got) == sorted(want([tuple(r) for r in docs.collect()]))


@pytest.mark.parametrize("overlap", [16, 64])
def test_chunks_of_odd_texts(spark, overlap):
    rng = random.Random(overlap)
    alphabet = ["a", "bc", " ", "  ", "\n", "'", "'s", "'l", "l", "1", "23", "!", "é", "語", "。", "🙂", "́", "՘", "\x1c", "\x00", "　"]
    docs = [(i, "".join(rng.choices(alphabet, k=rng.choice([5, 300, 2000])))) for i in range(40)]
    docs += [(100, "a" * 5000), (101, " " * 5000), (102, "語" * 3000 + "。" + "x"), (103, "x<|endoftext|> " * 300), (104, None), (105, ""),
             (106, "ab " * 21 + "z"), (107, "!" * 1000 + "\n" * 1000 + "'" * 1000), (None, "word " * 500), (None, None)]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], SCHEMA).repartition(3)
    got = result(byte_bpe.encode(df, RANKS, PATTERN, chunk=64, overlap=overlap))
    assert sorted(got, key=str) == sorted(want(docs), key=str)


def test_chunks_are_stitched(spark):
    """A long text becomes many pieces, so that its encoding is parallel; endless words become one."""
    df = spark.createDataFrame([(1, "one two " * 4000), (2, "x" * 32000)], "doc_id long, text string")
    chunks = byte_bpe._chunks(df, "text", "doc_id", 1000, 100).collect()
    seams = {(r.row, r.at): r for r in byte_bpe._seams(spark.createDataFrame(chunks), PATTERN, 1000, 100).collect()}
    rows = sorted({r.row for r in chunks}, key=lambda r: next(c.key for c in chunks if c.row == r))
    assert all(set(seams[rows[0], at].tail) & set(seams[rows[0], at + 1].head) for at in range(31))
    assert not any(seams[rows[1], at].tail for at in range(31))


def test_repeated_rows_large_ids_and_no_rows(spark):
    docs = [(9007199254740993, "some text " * 50), (9007199254740993, "some text " * 50), (None, "other " * 60), (9007199254740995, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = result(byte_bpe.encode(df, RANKS, PATTERN, chunk=100, overlap=50))
    assert sorted(got, key=str) == sorted(want(docs), key=str)
    assert result(byte_bpe.encode(df.limit(0), RANKS, PATTERN)) == []


def test_white_space_that_the_engine_refuses(spark):
    text = "a" + " " * 1_100_000 + "b"
    with pytest.raises(ValueError):
        encoder(RANKS, PATTERN).encode_to_numpy(text, disallowed_special=())
    got = result(byte_bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), RANKS, PATTERN))
    bpe = encoder(RANKS, PATTERN)
    assert got[0][1] == [*plain("a"), *bpe._encode_single_piece(" " * 1_099_999), *plain(" b")] and got[0][2] == text.encode()


def test_decode_ends_within_a_character(spark):
    ids = plain("🙂")
    assert len(ids) > 1 and isinstance(encoder(RANKS, PATTERN), tiktoken.Encoding)
    df = spark.createDataFrame([(1, ids[:1]), (2, None), (3, []), (4, ids)], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(df, RANKS).collect()}
    whole = "🙂".encode()
    assert got[4] == whole and got[2] == got[3] == b"" and 0 < len(got[1]) < 4 and whole.startswith(got[1])
