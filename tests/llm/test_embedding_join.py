import time

import numpy as np
import pytest

from strata.llm import embedding_join as e


def brute(rows, least):
    """Links by all cosines, components by repeated minima."""
    good = {k: np.array(v, dtype=float) for k, v in rows if v is not None and len(v) and None not in v
            and np.isfinite(v).all() and np.any(v)}
    links = {k: [m for m in good if m != k and len(good[m]) == len(good[k])
                 and good[k] @ good[m] / np.linalg.norm(good[k]) / np.linalg.norm(good[m]) >= least] for k in good}
    low = {k: k for k, _ in rows}
    for _ in rows:
        low = {k: min([low[k], *(low[m] for m in links.get(k, ()))]) for k in low}
    return {k: (len(links.get(k, ())), low[k], low[k] == k) for k, _ in rows}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("dim,blocks,side,spread", [(3, 4, 10, 0.3), (16, 4, 16, 0.1), (64, 8, 40, 0.045)])
def test_against_all_pairs(spark, dim, blocks, side, spread):
    r = np.random.default_rng(dim)
    centres = r.standard_normal((12, dim))
    vectors = np.concatenate([c + r.standard_normal((n, dim)) * spread * np.linalg.norm(c) for c, n in
                              zip(centres, [40, 20, 8, 4, 3, 2, 1, 1, 1, 1, 1, 1], strict=True)])
    vectors = np.concatenate([vectors, vectors[:5], vectors[5:9] * 1e-3, -vectors[:3]]).astype(np.float32)
    rows = [(int(k), [float(x) for x in v]) for k, v in zip(r.permutation(len(vectors)), vectors, strict=True)]
    rows += [(900, None), (901, []), (902, [0.0] * dim), (903, [float("nan")] * dim), (904, [None] + [1.0] * (dim - 1)),
             (905, [float("inf")] + [1.0] * (dim - 1)), (906, [1.0] * (dim + 1)), (907, [2.0] * (dim + 1))]
    df = spark.createDataFrame([(k, v, "x", k) for k, v in rows], "vec_id long, embedding array<float>, label string, id long")
    assert result(e.near_vectors(df, blocks=blocks, side=side)) == brute(rows, 0.9)


def test_each_pair_is_found_in_one_block():
    r = np.random.default_rng(1)
    raw = r.standard_normal((60, 32))
    raw = np.concatenate([raw, raw + r.standard_normal(raw.shape) * 0.3])
    turned = e.rotated(raw, e.rotation(32))
    edges, seen = e._edges(32, 4), []
    for block in range(4):
        for p, q in e.matched(turned, turned, (raw, raw), block, edges, 0.2, 0.9, True):
            seen += zip(p.tolist(), q.tolist(), strict=True)
    unit = raw / np.linalg.norm(raw, axis=1)[:, None]
    wanted = {(i, j) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.9, 1)), strict=True)}
    assert len(seen) == len(set(seen)) and set(seen) == wanted and len(wanted) > 20


def test_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, e.near_vectors(df).collect()), key=str) == sorted(
        [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)], key=str)
    assert e.near_vectors(df.limit(0)).collect() == []


def test_pairs_just_at_the_threshold(spark):
    """Cosines of exactly 0.9, whose rotated vectors are some last bits off."""
    rows = []
    for i in range(60):
        one, two = [0.0] * 64, [0.0] * 64
        a, b, c, f = (int(x) for x in np.random.default_rng(i).permutation(64)[:4])
        one[a] = 10.0
        two[a], two[b], two[c], two[f] = 9.0, 3.0, 3.0, 1.0
        size = 1000.0 ** (i % 3) * (1 if i % 2 else -1)
        rows += [(2 * i, [x * size for x in one]), (2 * i + 1, [x * size for x in two])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = dict(rows)
    got = result(e.near_vectors(df))
    for k in range(0, 120, 2):
        a, b = np.array(good[k]), np.array(good[k + 1])
        assert (a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.9 and got[k + 1][0] >= 1 and got[k][1] == got[k + 1][1]


def test_a_tile_costs_little_more_than_its_product():
    """Tiles are where the work grows fastest: a distance is a product's number and one comparison, not several passes."""
    rng = np.random.default_rng(2)
    raw = [rng.standard_normal((3000, 64)) for _ in range(2)]
    turned, edges = [e.rotated(x, e.rotation(64)) for x in raw], np.array([0, 16, 32, 48, 64])

    def passes():
        a, b = (x[:, :16].astype(np.float32) for x in turned)
        a2, b2 = (a * a).sum(axis=1), (b * b).sum(axis=1)
        for i in range(0, 3000, 1024):
            for j in range(0, 3000, 1024):
                np.nonzero(a2[i:i + 1024, None] + b2[None, j:j + 1024] - 2 * (a[i:i + 1024] @ b[j:j + 1024].T) <= 0.05)

    def least(work):
        times = []
        for _ in range(5):
            start = time.perf_counter()
            work()
            times.append(time.perf_counter() - start)
        return min(times)

    assert least(lambda: list(e.matched(*turned, raw, 0, edges, 0.2, 0.9, False))) < 0.7 * least(passes)
