import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import license_scan as S
from tidewatch.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return S.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_query_against_planted_lines(spark):
    lines = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
             "This work is licensed under the GNU General Public License, version 3.": "GPL", "Licensed under CC BY-NC 4.0.": "CC-BY-NC"}
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    want = {d: sorted({f for x, f in lines.items() if x in t.split("\n")}) for d, t in rows}
    got = {r.doc_id: r for r in queries.QUERIES["op2_license_scan"](spark, SF).collect()}
    assert len(got) == len(rows) and sum(map(bool, want.values())) > 20
    assert {d for d in want if not set(want[d]) <= set(got[d].families)} == set()
    text = dict(rows)
    extra = {(d, f) for d in want for f in set(got[d].families) - set(want[d])}
    assert {f for d, f in extra if "rights reserved" in text[d].lower()} <= {"Proprietary"}
    assert sum("rights reserved" not in text[d].lower() for d, _ in extra) <= 0.002 * len(rows)
    assert all(r.n_licences == len(r.licences) for r in got.values())


def test_logits_are_sums_of_gram_weights(model):
    text = ["one two three\nfour " + "five six " * 200, "", "Released under the MIT License."]
    p = S.Paragraphs(pa.array(text))
    z = p.logits(model.weights, model.bias)
    for i in range(len(p.start)):
        at, n = p.counts(i)
        assert np.allclose(z[i], n @ model.weights[at] + model.bias, atol=1e-4)
    assert set(p.text) == {0, 2} and (p.end - p.start <= S.LONG).all()
    covered = {j for a, b in zip(p.start, p.end) for j in range(a, b)}
    assert covered == set(range(len(p.words)))


def test_families_and_odd_rows(spark, model):
    rows = [(i, "some words before it\n" + S.TEMPLATES[f][0] + "\nand after") for i, f in enumerate(S.FAMILIES)]
    rows += [(100, None), (101, ""), (102, " \n\n"), (103, "plain words that grant nothing at all"), (None, S.TEMPLATES["MIT"][0]),
             (104, "word " * 50000 + S.TEMPLATES["BSD"][3] + " word" * 70), (105, S.TEMPLATES["MIT"][0]), (105, S.TEMPLATES["MIT"][0])]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, licences int")
    out = S.scan(df, model)
    assert out.columns == ["doc_id", "text", "licences"]
    got = [(r.doc_id, [x.family for x in r.licences]) for r in out.collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert sum(by[i] == [f] for i, f in enumerate(S.FAMILIES)) >= len(S.FAMILIES) - 1
    odd = spark.createDataFrame([("Licensed under the Grand Widget Public License, version 9.",)], "text string")
    assert [x.family for r in S.scan(odd, model).collect() for x in r.licences] == [S.UNKNOWN]
    assert all(by[i] == [] for i in (100, 101, 102, 103))
    assert by[None] == ["MIT"] and [g for g in got if g[0] == 105] == [(105, ["MIT"])] * 2 and "BSD" in by[104]
    assert S.scan(df.limit(0), model).collect() == []


def test_training_on_an_empty_table(spark):
    none = spark.createDataFrame([], "text string")
    m = S.train(none)
    p = S.Paragraphs(pa.array(["Released under the MIT License."]))
    assert m.classes[int(m.probabilities(p)[0].argmax())] == "MIT"


def test_short_notices_inside_long_lines(spark, model):
    """One-sentence grants in the middle of prose without line breaks."""
    prose = [w for (t,) in duckdb.sql(f"select text from '{SF}/documents.parquet' order by doc_id limit 60").fetchall()
             for w in t.split() if not any(x in t.lower() for x in ("licen", "copyright", "rights reserved"))]
    notices = [("MIT", "Released under the MIT License."), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
               ("BSD", "Licensed under the BSD 3-Clause License."), ("GPL", "Licensed under the GPL v3."), ("CC-BY", "Licensed under CC BY 4.0.")]
    rows = [(f, " ".join(prose[97 * i:97 * i + 70 + i] + [t] + prose[97 * i + 1000:97 * i + 1075]))
            for i in range(20) for f, t in [notices[i % 5]]]
    got = S.scan(spark.createDataFrame(rows, "want string, text string").coalesce(1), model).collect()
    hits = sum(r.want in {x.family for x in r.licences} for r in got)
    assert len(prose) > 3000 and hits >= 18, hits
    assert all(len([x for x in r.licences if x.family == r.want]) <= 1 for r in got)
    plain = [(" ".join(prose[50 * i:50 * i + 150]),) for i in range(40)]
    assert sum(bool(r.licences) for r in S.scan(spark.createDataFrame(plain, "text string").coalesce(1), model).collect()) <= 2


def test_body_paragraphs_of_every_family(spark, model):
    """Paragraphs of the licences' bodies, alone on their line, are found."""
    rows = [(f, f"intro line\n{t}\nlast line") for f, texts in S.BODIES.items() for t in texts]
    got = S.scan(spark.createDataFrame(rows, "want string, text string").coalesce(1), model).collect()
    missed = [(r.want, [x.family for x in r.licences], r.text[:60]) for r in got if r.want not in {x.family for x in r.licences}]
    assert not missed, missed
    # as projects wrap them: upper and lower case, comment marks
    wrapped = [(f, "# " + t.lower().replace(", ", ",  ")) for f, t in rows]
    got = S.scan(spark.createDataFrame([(f, t.replace("\n", " ")) for f, t in wrapped], "want string, text string").coalesce(1), model).collect()
    assert sum(r.want in {x.family for x in r.licences} for r in got) >= len(rows) - 2


def test_spdx_tags(spark, model):
    cases = {"// SPDX-License-Identifier: Apache-2.0": ["Apache-2.0"], "SPDX-License-Identifier: (MIT OR GPL-2.0+)": ["GPL", "MIT"],
             "/* spdx-license-identifier:\tGPL-2.0-only WITH Classpath-exception-2.0 */": ["GPL"], "SPDX-License-Identifier: LicenseRef-Grand": [S.UNKNOWN],
             "SPDX-License-Identifier: NONE": [], "SPDX-License-Identifier: ": [], "SPDX-License-Identifier": [], "SPDX-License-Identifier: MIT-0": [S.UNKNOWN],
             "SPDX-License-Identifier: BSD-3-Clause\nSPDX-License-Identifier: ISC.": ["BSD", "ISC"], "SPDX-License-Identifier: CC-BY-NC-SA-4.0": ["CC-BY-NC"]}
    got = {r.text: r.licences for r in S.scan(spark.createDataFrame([(t,) for t in cases], "text string").coalesce(1), model).collect()}
    for text, want in cases.items():
        exact = [x for x in got[text] if x.probability == 1.0 and x.similarity == 1.0]
        assert sorted({x.family for x in exact}) == want, (text, got[text])
    tag = "one two\nthree SPDX-License-Identifier: LGPL-2.1-or-later four"
    row = S.scan(spark.createDataFrame([(tag,)], "text string"), model).first()
    assert [(x.family, x.start, x.end) for x in row.licences] == [("LGPL", 3, 11)]
    # a tag at the end of one text and an identifier at the start of the next do not meet
    p = S.Paragraphs(pa.array(["x SPDX-License-Identifier:", " MIT", None, "SPDX-License-Identifier: MIT"]))
    assert [[x["family"] for x in found] for found in S._declared(p, 4)] == [[], [], [], ["MIT"]]
