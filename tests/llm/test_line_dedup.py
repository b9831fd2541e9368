import random

import duckdb
import pytest

from tests.llm.sqlcheck import same_as_sql
from tidewatch.llm import line_dedup
from tidewatch.llm.frames import Scratch
from tidewatch.llm.line_dedup import NO_ID, Runs

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def brute(rows, chars, docs):
    """[(kept text or None, lines, dropped)] of (id, text) rows."""
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))

    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= chars:
                held.setdefault(key(line), set()).add(NO_ID if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < docs or max(held[key(x)]) == (NO_ID if i is None else i)]
        out.append((None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_query_against_sql(spark):
    same_as_sql(spark, SF, "op13_line_dedup")


@pytest.mark.parametrize("batches", [1, 3, 9])
def test_odd_rows(spark, batches):
    rng = random.Random(batches)
    lines = ["Same line", "\x0b same LINE\t", "É same", "é same", "", " ", "日本語の行", "x" * 50, "\xa0same line", "same line\r"]
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, "", "\n", "\n".join(rng.choices(lines, k=rng.randint(1, 6)))]), str(j))
            for j in range(60)]
    rows += [(99, "\n".join(["same line", "long " * 200_000] * 2), "long"), (99, "same line", "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, `rest` string").withColumnRenamed("rest", "gone")
    got = line_dedup.drop_lines(df, min_chars=3, min_docs=3, batches=batches)
    assert got.columns == ["doc_id", "text", "gone", "n_lines", "n_dropped"]
    want = {r[2]: (r[0], *b) for r, b in zip(rows, brute([r[:2] for r in rows], 3, 3))}
    assert {r.gone: (r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()} == want
    assert any(w[3] for w in want.values())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_lines string")
    assert line_dedup.drop_lines(df).collect() == []


def test_runs_hold_a_key_once(spark):
    """Every key has one entry among the levels, and full levels are compacted."""
    with Scratch(spark) as scratch, Runs(spark, scratch, fanout=2) as runs:
        for b in range(5):
            runs.add(spark.range(b * 10, b * 10 + 30).selectExpr("unhex(lpad(hex(id % 60), 16, '0')) AS key", f"id * 100 + {b} AS id"))
        levels = [len(x) for x in runs.levels]
        held = [r.key for level in runs.levels for t in level for r in spark.table(t).collect()]
        counts = {bytes(r.key): r.docs for r in runs.counts().collect()}
        plan = spark.table(runs.levels[0][0]).join(spark.table(runs.levels[-1][0]).hint("merge"), "key", "left_anti")
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert levels == [1, 0, 1]
    assert len(held) == len(set(held)) == 60
    want = duckdb.sql("select k, count(*) from (select unnest(range(b * 10, b * 10 + 30)) % 60 k from range(5) t(b)) group by k").fetchall()
    assert counts == {k.to_bytes(8, "big"): n for k, n in want}
