import random

import pytest

from strata.llm import common


def brute(links):
    low = {x: x for pair in links for x in pair}
    for _ in low:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return low


@pytest.mark.parametrize("held,parts", [(1_000_000, 1), (3, 5)])
def test_components(spark, monkeypatch, held, parts):
    monkeypatch.setattr(common, "HELD_IDS", held)
    rng = random.Random(parts)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 150)]
    some = [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(50)]
    links = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in chain + star + some if a != b]
    rng.shuffle(links)
    df = spark.createDataFrame(links * 2, "a long, b long").repartition(parts)
    found = common.components(df, common.Stages(spark, "test"), "c").collect()
    assert len(found) == len({r.id for r in found})
    assert {r.id: r.component for r in found} == brute(links)


def test_no_links(spark):
    df = spark.createDataFrame([], "a long, b long")
    assert common.components(df, common.Stages(spark, "test"), "c").collect() == []
