import random

import pytest

from tidewatch.llm import components


def brute(links):
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("limit", [1_000_000, 40])
def test_components(spark, monkeypatch, limit):
    """Paths, stars, random graphs and lone nodes, in one task and in several
    (where a long path does not shrink and the star steps take over)."""
    monkeypatch.setattr(components, "TASK_LINKS", limit)
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(500, i) for i in range(501, 560)]
    some = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    links = path + star + some + [(7000, 7000)] + path[:5]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(6)
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert got == brute(links)
    assert components.connected_components(df.limit(0)).collect() == []
