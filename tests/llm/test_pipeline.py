import duckdb
import pandas as pd

import corpus_pipeline as P
from tests.llm import brute
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_decontaminate import tokens
from tidewatch.llm.sql import mixing_sql

SF = "/root/testdata/sf0.001"


def test_against_brute_force(spark):
    docs = duckdb.sql(f"select * from '{SF}/documents.parquet'").df()
    items = duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()
    docs = docs[[any(c.isalpha() for c in t or "") for t in docs.text]]
    comp = brute.jaccard_components(list(zip(docs.doc_id, docs.text)), 5, 80, 100)
    docs = docs[[comp[d][1] == d for d in docs.doc_id]].reset_index(drop=True)
    cut = brute.repeats(list(zip(docs.doc_id, docs.text)), 20)
    docs["text"] = [" ".join(cut[i][1]) if cut[i][2] else t for i, t in enumerate(docs.text)]
    docs["n_chars"] = [len(t) if cut[i][2] else n for i, (t, n) in enumerate(zip(docs.text, docs.n_chars))]
    docs = docs[[bool(cut[i][1]) for i in range(len(docs))]]
    pairs = {d: set(zip(tokens(t), tokens(t)[1:])) for d, t in zip(docs.doc_id, docs.text)}
    docs = docs[[not any(sum(p in pairs[d] for p in zip(tokens(x), tokens(x)[1:])) >= 4 and leaks(t, x) for x, in items)
                 for d, t in zip(docs.doc_id, docs.text)]]
    con = duckdb.connect()
    con.register("documents", docs)
    want = con.execute(mixing_sql(**P.MIX)).df().merge(docs[["doc_id", "text", "n_chars"]], on="doc_id")
    got = P.run(spark, SF).toPandas()
    assert list(got.columns) == ["doc_id", "text", "lang", "source", "n_chars", "domain", "n_tokens", "epoch"]
    order = ["doc_id", "epoch"]
    pd.testing.assert_frame_equal(got.sort_values(order).reset_index(drop=True),
                                  want.sort_values(order)[got.columns].reset_index(drop=True), check_dtype=False)
    assert 0 < len(docs) < 200


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, "one two three four five six", "en", "src1", 27, "x", 1.0), (1, "one two three four five six", "en", "src1", 27, "x", 1.0),
            (None, "null id with some words", None, None, None, None, None), (2, None, "en", "src2", 0, None, 2.0),
            (3, "", "de", "src3", 0, None, 2.0), (4, "123", "de", "src3", 3, None, 2.0), (5, "wort " * 30000, "de", "src3", 3, None, 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string, score double")
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[:len(docs.columns)] == docs.columns
        none = stage(spark, docs.limit(0), SF)
        assert none.columns == out.columns and none.collect() == []
        if name != P.STAGES[-1][0]:
            docs = P.stored(out, "t")
    got = docs.collect()
    assert sorted({r.doc_id or 0 for r in got}) == [0, 1, 5]
    assert {r.spans for r in got if r.doc_id == 1} == {"x"}
    assert {r.text for r in got if r.doc_id == 5} == {"wort"}
