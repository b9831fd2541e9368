import random
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tidewatch.llm import arrays as A, jaccard_join, queries

SF = "/root/testdata/sf0.001"


def check(df, rows, **args):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(df, **args).collect()}
    assert got == brute.jaccard_components(rows, args["k"], args["num"], args["den"])
    return got


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op8_jaccard_join"](spark, SF).collect()}
    assert got == brute.jaccard_components(rows, 3, 90, 100)
    assert any(d != c for d, (_, c) in got.items())


def copies(seed, base_words, copies_of, edits):
    """Texts with random edits, whose similarities straddle the bounds."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(3000)
    rows = []
    for n in base_words:
        base = [word() for _ in range(n)]
        for _ in range(copies_of):
            t = list(base)
            for _ in range(rng.randrange(edits + 1)):
                t[rng.randrange(len(t))] = word()
            if rng.random() < 0.3:
                t = t[: rng.randrange(max(1, int(n * 0.8)), n + 1)]
            rows.append((len(rows) * 7 % 100003, " ".join(t)))
    return rows


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80)])
@pytest.mark.parametrize("family,here", [(200, 4), (6, 1)])
def test_edited_copies(spark, monkeypatch, k, num, family, here):
    """Large families in blocks, and hardly any shingle that is not common."""
    monkeypatch.setattr(jaccard_join, "FAMILY", family)
    monkeypatch.setattr(jaccard_join, "COMMON_HERE", here)
    rows = copies(k, [1, 2, 3, 5, 8, 12, 20, 40, 90, 200, 400], 25, 6)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = check(df, rows, k=k, num=num, den=100)
    assert len({c for _, c in got.values()}) > 20


def test_large_unlinked_family_ends(spark, monkeypatch):
    """Texts that share a passage but do not link, in blocks of few pivots:
    every round takes new ones until none is left."""
    for name, value in (("FAMILY", 20), ("FIRST_BLOCK", 4), ("LARGEST_BLOCK", 4), ("COMMON", 0)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(3)
    shared = [f"s{i}" for i in range(40)]
    rows = [(i, " ".join(shared + [f"w{rng.randrange(10**6)}" for _ in range(8)])) for i in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, k=3, num=90, den=100)


def test_region_links_are_all_pairs():
    rng = np.random.default_rng(1)
    base = [rng.choice(500, 60, replace=False) for _ in range(6)]
    sets = []
    for b in base:
        for _ in range(15):
            s = b.copy()
            at = rng.choice(60, rng.integers(0, 9), replace=False)
            s[at] = rng.integers(500, 10000, len(at))
            sets.append(np.unique(s).astype(np.uint64))
    for num in (60, 80, 90):
        want = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
                if 100 * len(np.intersect1d(sets[i], sets[j])) >= num * len(np.union1d(sets[i], sets[j]))]
        assert jaccard_join.region_links(sets, num, 100) == want and want


def test_odd_rows(spark):
    rows = [(1, "a b c d", 1), (1, "a b c d", 1), (2, "A b\tc  D", 2), (3, None, 3), (4, "", 4), (5, " \n", 5),
            (6, "a", 6), (7, "a", 7), (8, "a b", 8), (None, "a b c d", 9), (None, "a", 9), (9, "x " * 20000, 1), (10, "x x x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles long")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.components(df, 3, 90, 100).collect()),
                 key=lambda r: (r[0] or 0, r[1]))
    assert got == [(None, 1, None), (None, 2, None), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5),
                   (6, 1, 6), (7, 1, 6), (8, 1, 8), (9, 1, 9), (10, 1, 9)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, id string")
    assert jaccard_join.components(df).collect() == []


def test_keep_one_keeps_different_texts_of_a_doc_id(spark):
    text = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(40)]
    rows = [(7, t, 1) for t in text] + [(7, text[0], 2), (9, text[3], 1), (3, text[5], 1), (8, "other words " * 20, 1),
                                        (None, text[0], 1), (7, None, 1), (9, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, x int").repartition(6)
    got = [jaccard_join.keep_one(d).collect() for d in (df, df.repartition(3))]
    assert sorted(map(tuple, got[0]), key=repr) == sorted(map(tuple, got[1]), key=repr)
    kept = [(r.doc_id, r.text) for r in got[0]]
    want = [(7, t) for t in text if t != text[5]] + [(3, text[5]), (8, "other words " * 20), (None, text[0]), (7, None), (9, "")]
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_keep_one_keeps_columns_of_any_name(spark):
    """With and without repeated ids, as each has a plan of its own."""
    text = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(3)]
    for rows in ([(1, text[0]), (1, text[1]), (2, text[0]), (3, text[2])], [(1, text[0]), (2, text[0]), (3, text[2])]):
        df = spark.createDataFrame([(d, t, d * 10, "r", "o", -1, 0.5) for d, t in rows],
                                   "doc_id long, text string, `__row` long, row string, row_ string, component_id int, `__kept` double")
        got = jaccard_join.keep_one(df)
        assert got.columns == df.columns
        want = [r for r in map(tuple, df.collect()) if r[:2] != (2, text[0])]
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_stars_of_a_shard_in_ranges_of_bounded_memory(monkeypatch):
    """Same stars whatever the ranges; besides a shard's unpacked signatures
    and ids (16 bytes each) only a range of them is held."""
    def shard(rng, rows, size, values, ids):
        pool = rng.integers(0, 2**64, values, dtype=np.uint64)
        held = [(np.sort(rng.choice(pool, size)), rng.integers(-9, ids, size)) for _ in range(rows)]
        table = pa.Table.from_pylist([{"size": size, "sigs": A.pack_sorted(s), "ids": A.pack(d)} for s, d in held])
        return table, np.concatenate([s for s, _ in held]), np.concatenate([d for _, d in held])

    rng = np.random.default_rng(5)
    for args in ((1, 1, 1, 9), (6, 5, 12, 90), (9, 40, 700, 5000)):
        table, s, d = shard(rng, *args)
        least = {}
        for x, i in zip(s.tolist(), d.tolist()):
            least[x] = min(i, least.get(x, i))
        links = [(i, least[x]) for x, i in zip(s.tolist(), d.tolist()) if i != least[x]]
        want = jaccard_join.roots(*np.array(links, np.int64).reshape(-1, 2).T)
        for size in (100_000, 50, 3):
            monkeypatch.setattr(jaccard_join, "RANGE", size)
            assert [x.tolist() for x in jaccard_join._stars(table)] == [x.tolist() for x in want]
    monkeypatch.undo()
    table, s, _ = shard(rng, 25, 40_000, 2_000_000, 100_000)
    tracemalloc.start()
    jaccard_join._stars(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(s), peak / len(s)


def test_blocks_share_bands_and_hashes_are_looked_up_once(monkeypatch):
    """Signatures do not depend on how large the block's largest set is; the
    listed hashes are met once a block, not once a band."""
    text = " ".join(f"w{i % 37}x{i}" for i in range(300))
    blocks = [[text, "a b c d e f", None], [text, "a b c d e f", "b " + text]]
    common = np.sort(jaccard_join.Shingles(pa.array([text]), 5).value[::3])
    calls = []
    holds = jaccard_join._holds
    monkeypatch.setattr(jaccard_join, "_holds", lambda *a: calls.append(1) or holds(*a))
    jaccard_join.bands.cache_clear()
    first = []
    for b in blocks:
        sh = jaccard_join.Shingles(pa.array(b), 5)
        assert [(np.diff(sh.set(i)) > 0).all() for i in range(3)] == [True] * 3      # unsigned, ascending
        s, d = sh.signatures(80, 100, common)
        first.append([sorted(s[d == i].tolist()) for i in (0, 1)])
    assert first[0] == first[1] and len(calls) == 2 and jaccard_join.bands.cache_info().misses == 1


def test_listed_hashes():
    rng = np.random.default_rng(2)
    v = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    for listed in (np.zeros(0, np.uint64), np.sort(v[:1]), np.sort(np.concatenate([v[:900], rng.integers(0, 2**64, 800, dtype=np.uint64)])),
                   np.array([0, 2**64 - 1], np.uint64)):
        assert (jaccard_join._holds(listed, v) == np.isin(v, listed)).all()
        assert jaccard_join._holds(listed, listed).all() and not len(jaccard_join._holds(listed, v[:0]))
