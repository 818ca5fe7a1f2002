import math

import numpy as np
import pytest

from strata.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int"


def brute(vectors, parts=8, entries=16, rounds=6, scale=4096):
    """Plain loops over whole numbers."""
    rows = [(k, [math.floor(scale * x) for x in v], label) for k, v, label in vectors
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(rows[0][1]) // parts
    out, books, errors = [[] for _ in rows], [], [0] * len(rows)
    for p in range(parts):
        own = [v[p * width:(p + 1) * width] for _, v, _ in rows]
        book = [list(x) for x in own[:entries]]

        def nearest():
            far = [[sum((a - b) ** 2 for a, b in zip(x, e)) for e in book] for x in own]
            return [(min(f), f.index(min(f))) for f in far]
        for _ in range(rounds):
            met = [e for _, e in nearest()]
            for e in range(len(book)):
                if some := [x for x, n in zip(own, met) if n == e]:
                    book[e] = [sum(c) // len(some) for c in zip(*some)]
        for i, (far, e) in enumerate(nearest()):
            out[i].append(e)
            errors[i] += far
        books.append(book)
    return sorted(((k, bytes(c), min(e, 2**63 - 1)) for (k, _, _), c, e in zip(rows, out, errors)), key=str), books


def result(codes):
    return sorted(((r.vec_id, bytes(r.code), r.error) for r in codes.rows.collect()), key=str)


def test_whole_table_against_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    codes = vector_codes.compress(table.repartition(3))
    want, books = brute([(r.vec_id, r.embedding, r.label) for r in table.collect()])
    assert result(codes) == want and codes.codebooks == books


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).astype("float32").tolist(), i % 3) for i in range(50)]
    rows += [(3, rows[7][1], None), (3, rows[7][1], None), (None, rows[9][1], None), (9007199254740993, rows[4][1], 1),
             (60, None, 1), (61, [None] + [1.0] * 15, 1), (62, [float("nan")] * 16, 1), (63, [float("inf")] + [0.0] * 15, 1),
             (64, [0.0] * 16, 1), (65, [-0.0] * 16, 1), (66, [1e6] * 16, 2), (67, [-1e7] * 16, 2)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA).repartition(4)
    codes = vector_codes.compress(df, carry=["label"], parts=4, entries=5, rounds=3)
    want, books = brute(rows, 4, 5, 3)
    assert result(codes) == want and codes.codebooks == books
    labels = {(r.vec_id, bytes(r.code)): r.label for r in codes.rows.collect()}
    assert labels[9007199254740993, next(c for k, c, _ in want if k == 9007199254740993)] == 1
    few = vector_codes.compress(df.where("vec_id in (1, 2)"), parts=4)
    assert all(len(book) == 2 for book in few.codebooks) and len(few.rows.collect()) == 2
    none = vector_codes.compress(df.where("vec_id in (60, 61, 62, 63)"))
    assert none.rows.collect() == [] and none.digest() == vector_codes.Codes(none.rows, [[]]).digest()


def test_lengths(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, [1.0, 2.5])], "vec_id long, embedding array<float>")
    assert sorted(r.vec_id for r in vector_codes.compress(df, parts=2).rows.collect()) == [1, 3]
    with pytest.raises(ValueError):
        vector_codes.compress(df, parts=3)
    empty = spark.createDataFrame([(1, []), (2, [])], "vec_id long, embedding array<float>")
    assert [(bytes(r.code), r.error) for r in vector_codes.compress(empty).rows.collect()] == [(bytes(8), 0)] * 2


@pytest.mark.parametrize("side", [1, 64, 4096])
def test_cells_change_nothing(side, monkeypatch):
    rng = np.random.default_rng(side)
    book = rng.integers(-300, 300, size=(16, 4))
    book[5] = book[2]
    monkeypatch.setattr(vector_codes, "REMEMBERED", 40)
    cells = vector_codes.Cells(book, side)
    for _ in range(4):
        points = rng.integers(-400, 400, size=(500, 4))
        far = ((points[:, None] - book[None]) ** 2).sum(axis=2)
        entry, best = cells.nearest(points)
        assert (entry == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
        cells.by[:] = 0  # all cells share a hash
    assert len(vector_codes.Cells(book, 64)._candidates(np.zeros((1, 4), dtype=np.int64)).nonzero()[0]) < 16


def test_totals_of_hot_null_and_rare_labels(spark):
    rows = [(i, None if i % 3 == 0 else i % 50, i) for i in range(300)] + [(300, 7, 2**63 - 1), (301, 7, 2**63 - 1)]
    df = spark.createDataFrame(rows, "vec_id long, label int, error long")
    got = {r.vec_id: r.all for r in vector_codes.with_total(df, "label", "error", "all").collect()}
    assert len(got) == 302
    for k, label, _ in rows:
        assert got[k] == min(sum(e for _, x, e in rows if x == label), 2**63 - 1)
