import random

import duckdb
import pandas as pd
import pytest

from tidewatch.llm import mixing, queries
from tidewatch.llm.sql import mixing_sql

SF = "/root/testdata/sf0.01"
DDL = "doc_id long, text string, lang string, source string"
ORDER = ["doc_id", "epoch", "origin"]


def table(seed=1, n=300):
    """Sources of very different size, one of them with a third of the rows."""
    rng = random.Random(seed)
    rows = [(None, "null id here", "en", "src1"), (1, None, "en", "src1"), (2, "", "de", "src2"), (3, " \n", None, None),
            (4, "a b c", None, "src2"), (5, "a b c d e", "en", None), (6, "w " * 5000, "fr", "other"), (6, "w " * 5000, "fr", "other")]
    for i in range(10, n):
        source = "src7" if i % 3 == 0 else f"src{rng.randrange(12)}"
        rows.append((i, "w " * rng.randrange(40), rng.choice(["en", "en", "en", "de", "fr"]), source))
    return rows


@pytest.mark.parametrize("args", [
    {"share": (1, 2), "max_epochs": 1, "seed": 0, "weights": {}},
    {"share": (1, 1), "max_epochs": 3, "seed": 5, "weights": {"domain": {"d0": 5, "other": 0}, "language": {"en": 1, "de": 9}, "origin": {"src3": 0}}},
    {"share": (9, 1), "max_epochs": 2, "seed": 5, "weights": {"domain": {"d1": 3}}},
    {"share": (0, 1), "max_epochs": 2, "seed": 5, "weights": {}},
])
def test_against_sql(spark, args):
    rows = table()
    df = spark.createDataFrame([(*r, 1.5) for r in rows], DDL + ", epoch double").repartition(5)
    out = mixing.mix(df, **args)
    assert out.columns == ["doc_id", "text", "lang", "source", "domain", "n_tokens", "epoch"]
    got = out.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch").toPandas()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]).astype({"doc_id": "Int64"}))
    want = con.execute(mixing_sql(**args)).df()
    key = lambda d: sorted(map(repr, d.astype(object).where(d.notna(), None).itertuples(index=False, name=None)))
    norm = lambda d: d.assign(doc_id=d.doc_id.astype("float"), n_tokens=d.n_tokens.astype(int), epoch=d.epoch.astype(int))
    assert key(norm(got)) == key(norm(want))


def test_budgets_follow_the_weights(spark):
    """Siblings share by weight, shortages go to siblings before ancestors."""
    leaves = [("a", "en", "x", 1000), ("a", "en", "y", 10), ("a", "de", "z", 1000), ("b", "en", "w", 30), ("c", "en", "v", 0)]
    df = spark.createDataFrame(leaves, "domain string, language string, origin string, tokens long")
    from pyspark.sql import functions as F
    got = {r.origin: r.budget for r in mixing.budgets(df, F.lit(400).cast("long"), {"language": {"en": 3}}, 1).collect()}
    # b and c cannot use their thirds: a gets 370, split 3 : 1; y's shortage goes to x alone
    assert got == {"w": 30, "v": 0, "z": 92, "y": 10, "x": 267}


def test_prefix_fits_the_budget(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = queries.QUERIES["op7_mixing"](spark, SF).toPandas()
    tokens = docs.select(mixing.n_words(docs.text).alias("n")).groupBy().sum().first()[0]
    assert 0.9 * tokens < out.n_tokens.sum() <= tokens
    assert out.epoch.between(1, 3).all() and not out.duplicated(["doc_id", "epoch"]).any()
    # all earlier epochs of a source are whole
    for _, own in out.groupby(["domain", "lang", "source"]):
        sizes = own.groupby("epoch").doc_id.nunique()
        assert (sizes.iloc[:-1] == sizes.iloc[0]).all() or len(sizes) == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], DDL)
    assert mixing.mix(df).collect() == []
