import hashlib
import random

import duckdb
import pytest

from tests.llm import brute
from tidewatch.llm import queries, substring_dedup, suffix_dedup

SF = "/root/testdata/sf0.001"
CASES = [("op10_substring_dedup", 20), ("op1_suffix_dedup", 50)]


@pytest.mark.parametrize("name,n", CASES)
def test_query_against_brute_force(spark, name, n):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    want = brute.repeats(rows, n)
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, SF).collect()}
    assert len(got) == len(rows)
    assert sum(w[0] - len(w[1]) for w in want.values()) > 0
    for i, (doc, _) in enumerate(rows):
        count, kept, gone = want[i]
        assert (got[doc].n_words, got[doc].n_removed) == (count, len(gone))
        assert got[doc].kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()
        assert [j for s in got[doc].spans for j in range(s.start, s.end)] == gone


@pytest.mark.parametrize("op", [substring_dedup, suffix_dedup])
@pytest.mark.parametrize("n", [1, 2, 6])
def test_odd_rows(spark, op, n):
    rng = random.Random(n)
    text = lambda k: " ".join(rng.choice("abcd") for _ in range(k))
    one = text(40)
    rows = [(1, one, "x"), (2, None, None), (3, "", "x"), (None, text(30), "x"),
            (4, " \t a  b\n", "x"), (1, one, "y"), (5, "é " * 300, "x"),
            (6, "a " * 5000, "x"), (6, "a " * 5000, "x"), (7, "a b c d", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string").withColumnRenamed("spans", "chunk")
    got = op.remove_repeats(df, window=n).collect()
    want = brute.repeats(rows, n)
    assert df.columns + ["n_words", "n_removed", "spans"] == list(got[0].asDict())
    key = lambda x: (x[0] or -1, x[1], x[2], x[3])
    assert sorted([(r.doc_id, r.n_words, r.n_removed, " ".join(brute.words(r.text))) for r in got], key=key) == \
        sorted([(rows[i][0], w[0], len(w[2]), " ".join(w[1])) for i, w in want.items()], key=key)
    assert [r.text for r in got if r.doc_id == 2] == [None]
    assert [r.text for r in got if r.doc_id == 4 and not r.n_removed] in ([], [" \t a  b\n"])


@pytest.mark.parametrize("op", [substring_dedup, suffix_dedup])
def test_empty_table(spark, op):
    df = spark.createDataFrame([], "doc_id long, text string, n_words string")
    assert op.remove_repeats(df).collect() == []
