import itertools
import zlib

import duckdb
import numpy as np

from tidewatch.llm import language_id as L
from tidewatch.llm import queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = dict(duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())
    got = queries.QUERIES["op9_language_id"](spark, SF).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 100 and np.mean([r.lang_pred == rows[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 5, 3, 0, 4, 2]
    first = np.concatenate(([0], np.cumsum(sizes)))
    score = rng.normal(size=(first[-1], 3)) * 2
    got = L.viterbi(score, first, 1.5)

    def value(s, path):
        return sum(s[i, p] for i, p in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))

    for a, b in zip(first, first[1:]):
        if b > a:
            best = max(value(score[a:b], p) for p in itertools.product(range(3), repeat=b - a))
            assert abs(value(score[a:b], got[a:b]) - best) < 1e-9


def model(spark):
    rows = [("the quick brown fox jumps over the lazy dog and then there was nothing", "en"),
            ("der schnelle braune fuchs springt und dann kam nichts mehr über die brücke", "de"),
            ("быстрая лиса прыгает через собаку", "ru"), (None, "en"), ("x", None)]
    return L.learn(spark.createDataFrame(rows * 3, "text string, lang string"))


def test_mixed_text_and_odd_rows(spark):
    m = model(spark)
    assert m.langs == ["de", "en", "ru"]
    mixed = "the quick brown fox jumps over 12 der schnelle braune fuchs springt über die brücke. лиса прыгает"
    rows = [(1, mixed), (2, None), (3, ""), (4, "123 ... !"), (5, "the dog"), (5, "the dog"), (None, "лиса"),
            (6, "über " * 40000), (7, "漢字かな ελληνικά")]
    df = spark.createDataFrame([(d, t, "zz") for d, t in rows], "doc_id long, text string, score string")
    got = {(r.doc_id, r.text): r for r in L.identify(df, m).collect()}
    assert [(s.lang, mixed[s.start:s.end]) for s in got[1, mixed].spans] == [
        ("en", "the quick brown fox jumps over"), ("de", "der schnelle braune fuchs springt über die brücke"), ("ru", "лиса прыгает")]
    for key in ((2, None), (3, ""), (4, "123 ... !")):
        assert (got[key].lang_pred, got[key].score, got[key].spans) == ("und", 0.0, [])
    assert got[5, "the dog"].lang_pred == "en" and got[None, "лиса"].lang_pred == "ru"
    assert got[6, "über " * 40000].lang_pred == "de"
    assert got[7, rows[-1][1]].lang_pred in m.langs
    assert L.identify(df, m).count() == len(rows)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string, lang string")
    m = L.learn(none)
    assert L.identify(none, model(spark)).collect() == []
    df = spark.createDataFrame([("abc",)], "text string")
    assert [(r.lang_pred, r.score) for r in L.identify(df, m).collect()] == [("und", 0.0)]


def test_more_languages_than_a_model_holds(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 4)
    rows = [(f"l{i:02d}", " ".join(chr(97 + i) * 3 + chr(97 + (i + j) % 26) for j in range(5 + i))) for i in range(12)]
    df = spark.createDataFrame(rows + [("l00", None), (None, "zzz")], "lang string, text string")
    model = L.learn(df)
    assert model.langs == ["l08", "l09", "l10", "l11"] and model.left_out == 8
    got = {r.text: r.lang_pred for r in L.identify(df.select("text"), model).collect()}
    assert all(got[t] == n for n, t in rows if n in model.langs) and set(got.values()) <= {*model.langs, "und"}
    assert L.learn(df.where("lang > 'l08'")).left_out == 0
