import random
from itertools import combinations

import duckdb
import pyarrow as pa
import pytest
import regex

from tidewatch.llm import decontaminate as D
from tidewatch.llm import queries

SF = "/root/testdata/sf0.001"


def tokens(t):
    """By regular expression: a character of an unspaced script, or a run of others."""
    own = "".join(f"{chr(a)}-{chr(b)}" for a, b in D.UNSPACED)
    t = "".join(c.lower() if c < "\x80" else c for c in t or "")
    return regex.findall(rf"(?V1)[[{own}]--[\p{{P}}\p{{Z}}]]|[[a-z0-9\x80-\U0010ffff]--[\p{{P}}\p{{Z}}\u200b{own}]]+", t)


def brute(doc, item, window=20):
    """Whether some alignment has a window with few enough differing tokens."""
    a, b = tokens(doc), tokens(item)
    w = min(window, len(b))
    if not w:
        return False
    for shift in range(-len(b) + w, len(a) - w + 1):
        same = [0 <= j + shift < len(a) and a[j + shift] == b[j] for j in range(len(b))]
        for s in range(len(b) - w + 1):
            if 0 <= s + shift and s + w + shift <= len(a) and sum(same[s:s + w]) >= w - max(0, (w - 5) // 5):
                return True
    return False


@pytest.mark.parametrize("w", range(5, 21))
def test_masks_are_lossless(w):
    for gone in combinations(range(w), D.allowed(w)):
        assert any(not any(o + i in gone for i, c in enumerate(m) if c == "1")
                   for m in D.masks_for(w) for o in range(w - len(m) + 1))


def test_query_against_brute_force(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    got = {r.doc_id: r for r in queries.QUERIES["op3_decontaminate"](spark, SF).collect()}
    assert len(got) == len(docs)
    # plain pairs that share no token pair of the item cannot reach the bound
    want = {}
    for d, t in docs:
        pairs = set(zip(tokens(t), tokens(t)[1:]))
        want[d] = [i for i, x in items
                   if sum(p in pairs for p in zip(tokens(x), tokens(x)[1:])) >= 4 and brute(t, x)]
    assert {d: r.item_ids for d, r in got.items()} == want
    assert all(r.contaminated == bool(r.item_ids) and r.n_items == len(r.item_ids) for r in got.values())
    assert sum(map(bool, want.values())) > 2


def test_substitutions_and_odd_rows(spark):
    rng = random.Random(5)
    word = lambda: "w%d" % rng.randrange(400)
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([4, 5, 6, 9, 14, 15, 19, 20, 33, 60])]
    rows = [(900, None), (901, ""), (None, items[5][1]), (902, "x " * 30000 + items[8][1].upper() + ". x!")]
    for i, t in items:
        for edits in range(7):
            w = t.split()
            for j in rng.sample(range(len(w)), min(edits, len(w))):
                w[j] = word()
            around = [word() for _ in range(15)]
            rows.append((len(rows), " ".join(around[:7] + w + around[7:])))
    rows += [rows[-1]]
    bench = spark.createDataFrame(items + [(77, None), (78, ""), (8, items[8][1])], "item_id long, text string")
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, matches int")
    got = sorted(((r.doc_id, r.text, sorted({m.item_id for m in r.matches})) for r in D.find_items(df, bench).collect()), key=repr)
    want = sorted(((d, t, [i for i, x in items if brute(t, x)]) for d, t in rows), key=repr)
    assert got == want and sum(bool(w[2]) for w in want) > 20
    kept = D.clean(df, bench)
    assert kept.columns == ["doc_id", "text"] or kept.columns == df.columns
    assert kept.count() == sum(not w[2] for w in want)
    hit = [m for r in D.find_items(df, bench).collect() if r.doc_id == 902 for m in r.matches]
    assert {(m.start, m.end, m.equal) for m in hit} == {(30000, 30033, 33)}


def test_tokens_of_other_scripts():
    texts = ["", "Ab1-\u00e9t\u00e9\u2014x\u00a0y", "\u4f60\u597d\uff0cworld\u3002\u518d\u89c1", "\u0e2a\u0e27\u0e31 a", "\U00020000\U00020001z\U0001f600", "\u00abna\u00efve\u00bb\u200bq\u00d7"]
    w = D._tokens(pa.array(texts))
    raw = [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.end)]
    assert [raw[a:b] for a, b in zip(w.first[:-1], w.first[1:])] == [tokens(t) for t in texts]
    assert tokens(texts[2]) == ["\u4f60", "\u597d", "world", "\u518d", "\u89c1"]


def test_short_items_and_unspaced_scripts(spark):
    chinese = "\u5929\u5730\u7384\u9ec4\u5b87\u5b99\u6d2a\u8352\u65e5\u6708\u76c8\u6603\u8fb0\u5bbf\u5217\u5f20\u5bd2\u6765\u6691\u5f80\u79cb\u6536\u51ac\u85cf"
    items = [(1, "forty two"), (2, "Forty-Two!"), (3, chinese), (4, "\u5929\u5730"), (5, "42"), (6, "a b c d"), (7, "..."), (8, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["the answer is forty, two and no more forty two", "forty times two", "\u201c" + chinese + "\u201d \u3002", "x" + chinese[:9] + "\u4e00" + chinese[10:] + "y",
             "a b c e a b c", "d a b\u2014c d", "forty", "42", "a b c " * 5000 + "d", "", None, "two forty", "... !"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: {m.item_id: (m.start, m.end, m.equal) for m in r.matches} for r in D.find_items(df, bench).collect()}
    assert {d: sorted(m) for d, m in got.items()} == {d: [i for i, x in items if brute(t, x)] for d, t in enumerate(texts)}
    assert got[0] == {1: (3, 5, 2), 2: (3, 5, 2)} and sorted(got[2]) == [3, 4] and sorted(got[3]) == [3, 4] and got[11] == {}
    assert got[8] == {6: (14997, 15001, 4)}


def test_several_blocks_and_empty(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_BYTES", 200)
    items = [(i, " ".join(f"t{i}x{j}" for j in range(30))) for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(i, "a " + t) for i, t in items] + [(99, "b c d e f g h")], "doc_id long, text string")
    got = {r.doc_id: [m.item_id for m in r.matches] for r in D.find_items(df, bench).collect()}
    assert got == {i: [i] for i in range(12)} | {99: []}
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.clean(df, none).count() == 13
    assert D.find_items(df.limit(0), bench).collect() == []
