import re

from sylvan.llm import license_scan as L
from sylvan.llm.queries import op1_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(t)
    at, labels = [], set()
    for phrase, label in L.BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), sorted(labels)


def test_parser_orders_operators():
    assert L.parse("MIT OR Apache-2.0 AND ISC".split())[0] == ["MIT", "Apache-2.0", "ISC", "and", "or"]
    assert L.parse("( MIT OR ISC ) AND GPL-2.0 WITH X".split())[0] == ["MIT", "ISC", "or", "GPL-2.0", "X", "with", "and"]
    assert L.parse("MIT OR".split()) == (["MIT"], 1)
    assert L.parse("( MIT".split()) == ([], 0)
    assert L.parse("MIT ISC".split()) == (["MIT"], 1)
    assert L.parse([]) == ([], 0)
    assert L.evaluate(["MIT", "GPL-2.0", "or"]) == 1.0 and L.evaluate(["MIT", "GPL-2.0", "and"]) == 0.4
    assert L.evaluate(["GPL-2.0", "Classpath", "with"]) == 0.7


def test_base_against_brute_force(sample, docs, rows):
    for df, want in ((sample, [(r.doc_id, r.text) for r in sample.collect()]), (docs, [(i, t) for i, t, _ in rows])):
        got = [(r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in L.license_scan(df).collect()]
        assert sorted(got, key=repr) == sorted([(i, brute(t)) for i, t in want], key=repr)


def test_labels_and_score(spark, docs, empty):
    got = {r.doc_id: r for r in L.license_scan(docs).collect()}
    r = got[9]
    assert r.labels == ["apache-2.0", "cc-by", "gpl-2.0+", "mit", "reserved"]
    assert r.expressions == ["( MIT OR GPL-2.0+ ) AND Apache-2.0"] and r.score == 1.0 and r.terms == 1.0
    assert got[2].labels == [] and got[2].score == 0.0 and got[2].first_word is None
    assert all(0 <= r.score <= 1 for r in got.values())
    assert L.license_scan(empty).count() == 0
    texts = ["Licensed under the MIT.", "licensed under a bridge", "Licensed under GNU General  Public-License", "all rights all rights reserved cc-by cc by"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r for r in sorted(L.license_scan(df).collect(), key=lambda r: r.doc_id)]
    assert [r.labels for r in got] == [["mit"], [], ["gpl"], ["cc-by", "reserved"]]
    assert (got[3].n_base, got[3].first_word, got[3].last_word) == (3, 2, 7)


def test_query_columns(spark):
    df = op1_license_scan(spark, "/root/testdata/sf0.001")
    assert df.count() == 200
    assert [f.dataType.simpleString() for f in df.schema][:8] == ["bigint"] * 5 + ["string", "string", "double"]


def test_wrapped_expressions_and_other_identifiers():
    auto = L._automaton()
    want = {
        "Licensed under\nMIT OR Apache-2.0": ["MIT OR Apache-2.0"],
        "SPDX-License-Identifier: (MIT OR\n Apache-2.0)": ["( MIT OR Apache-2.0 )"],
        " * Licensed under the\r\n * MIT": ["MIT"],
        "# SPDX-License-Identifier: GPL-2.0 WITH\n# Classpath-exception-2.0\n# More": ["GPL-2.0 WITH Classpath-exception-2.0"],
        "SPDX-License-Identifier:\n// MIT\n// AND more": ["MIT"],
        "SPDX-License-Identifier:\n\nSome prose": [],
        "Licensed under\na bridge": [],
        "licensed under EUPL-1.2": ["EUPL-1.2"],
        "released under the CC-BY-SA-3.0": ["CC-BY-SA-3.0"],
        "licensed under LGPL-2.1-or-later.": ["LGPL-2.1-or-later"],
        "available under Sleepycat-9.1": ["Sleepycat-9.1"],
        "available under COVID-19": [],
    }
    assert {text: L.scan(text.encode(), auto)["expressions"] for text in want} == want


def test_time_grows_with_the_text():
    import time

    auto = L._automaton()
    for unit in ("licensed under (a ", "MIT OR ", "SPDX-License-Identifier: (MIT OR ", "licensed under ((((", "released under MIT AND "):
        took = []
        for n in (100_000, 200_000):
            text = ("licensed under " + unit * (n // len(unit))).encode()
            begun = time.process_time()
            L.scan(text, auto)
            took.append(time.process_time() - begun)
        assert took[1] < 3 * took[0] + 0.05 and took[1] < 3, (unit, took)


def test_an_expression_ends_with_its_sentence():
    auto = L._automaton()
    found = lambda t: L.scan(t.encode(), auto)["expressions"]
    assert found("Licensed under MIT. The rest is prose.") == ["MIT"]
    assert found("licensed under (MIT licensed under Apache-2.0") == ["Apache-2.0"]
    # the grammar takes any word as an operand; two in a row end the expression
    assert found("licensed under MIT OR licensed under ISC") == ["MIT OR licensed", "ISC"]
