import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from tests.llm.sqlcheck import same_as_sql
from tidewatch.llm import lexical_search
from tidewatch.llm.lexical_search import NO_ID, Portion

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    held = [(NO_ID if i is None else i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, tokens = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n // tokens
            score = sum(floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text))
            if score > 0:
                scored.append((-score, i))
        out += [(item, r, None if i == NO_ID else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def test_query_against_sql(spark):
    same_as_sql(spark, SF, "op11_lexical_search")


@pytest.mark.parametrize("k,portion,block", [(1, 200, 4 << 20), (3, 200, 60), (10, 4 << 20, 4 << 20), (1000, 100, 4 << 20)])
def test_odd_rows(spark, monkeypatch, k, portion, block):
    """Ties, repeats, nulls, unspaced scripts, frequent and rare terms; small
    portions and item blocks."""
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", block)
    rng = random.Random(k)
    vocabulary = ["the"] * 30 + ["a1", "É", "é", "日本", "Rare", "x-y", "THE"] + [f"w{i}" for i in range(60)]
    docs = [(rng.choice([None, *range(400)]), " ".join(rng.choices(vocabulary, k=rng.randint(0, 12)))) for _ in range(300)]
    docs += [(500, None), (501, ""), (502, ".,;"), (503, "w1 " * 50_000), (504, "rare"), (504, "rare"), (505, "rare the\x00the")]
    items = [(1, "the rare w1 w1"), (1, "the rare w1 w1"), (1, "É 日本 w5"), (2, None), (3, ""), (4, "unseen"), (None, "w2 the"), (5, "the")]
    items += [(10 + j, " ".join(rng.choices(vocabulary, k=9))) for j in range(20)]
    d = spark.createDataFrame([(*r, "z") for r in docs], "doc_id long, text string, rank string")
    q = spark.createDataFrame([(*r, "z") for r in items], "item_id long, text string, score string")
    monkeypatch.setattr(lexical_search, "PORTION_BYTES", portion)
    got = [tuple(r) for r in lexical_search.search(d, q, k=k).collect()]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(brute(docs, items, k), key=key)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    q = spark.createDataFrame([("i", "a")], "item_id string, text string")
    assert lexical_search.search(d.limit(0), q).collect() == []
    assert lexical_search.search(d, q.limit(0)).collect() == []
    assert [tuple(r) for r in lexical_search.search(d, q).collect()][0][:3] == ("i", 1, 1)


def test_accumulators_are_limited():
    """Once the bound of the remaining terms is below the kth partial score,
    a frequent term makes no accumulators but updates those there are."""
    part = Portion.__new__(Portion)
    part.ids = np.arange(100)
    part.place = np.concatenate([np.arange(5), np.arange(100)]).astype(np.int32)
    part.gain = np.concatenate([np.full(5, 50), np.full(100, 3)])
    part.first, part.slot, part.most = np.array([0, 5, 105]), np.array([0, 1]), np.array([50, 3])
    part.total, part.open = np.zeros(100, np.int64), np.zeros(100, bool)
    score, ids = part.search(np.array([0, 1]), np.array([1, 1]), 5, 0)
    assert (sorted(ids), set(score)) == ([0, 1, 2, 3, 4], {53})
    score, ids = part.search(np.array([0, 1]), np.array([1, 1]), 6, 0)
    assert len(ids) == 100
    assert not part.total.any() and not part.open.any()
    score, ids = part.search(np.array([1]), np.array([1]), 6, 4)
    assert len(ids) == 0
