import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sylvan.llm import mixing as M
from sylvan.llm import repetition as R
from sylvan.llm.queries import op7_source_mix
from sylvan.llm.sql import SQL
from sylvan.sources.tables import TABLES
from tests.llm.conftest import by_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    n, chars = len(words), sum(map(len, words))

    def cover(k, later_only):
        seen, times, hit = set(), Counter(tuple(words[i : i + k]) for i in range(n - k + 1)), set()
        for i in range(n - k + 1):
            g = tuple(words[i : i + k])
            if (g in seen) if later_only else times[g] > 1:
                hit.update(range(i, i + k))
            seen.add(g)
        return hit

    lines, seen, dup, dup_chars = text.split("\n"), set(), 0, 0
    for line in lines:
        if WORD.search(line):
            if line in seen:
                dup += 1
                dup_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    repeat = len(cover(5, False))
    shares = [sum(len(words[i]) for i in cover(k, True)) for k in R.NGRAMS]
    failed = n < 10 or 100 * repeat > 20 * n
    bad = any(100 * s > lim * chars for s, lim in zip(shares, R.NGRAMS.values(), strict=True)) or 100 * dup_chars > 30 * chars
    return (n, chars, len(re.findall(r"[#*$%&|<>]", text)), dup, repeat, failed, not failed and not bad, dup_chars, shares)


COLS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "dup_line_chars", "dup_ngram_chars")


def test_measures_against_brute_force(sample, docs, rows, empty):
    want = sorted((r.doc_id, *brute(r.text)) for r in sample.collect())
    assert by_id(R.quality_rules(sample), *COLS) == want
    assert any(r[7] for r in want) and any(not r[7] for r in want)
    got = [tuple(r[c] for c in COLS) for r in R.quality_rules(docs).collect()]
    assert sorted(got, key=repr) == sorted([(i, *brute(t)) for i, t, _ in rows], key=repr)
    assert R.quality_rules(empty).count() == 0
    kept = R.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t, _ in rows if brute(t)[6])


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total = 1.5 * sum(sizes.values())
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    while open_ and total > 0:
        left = total - sum(2.0 * sizes[s] for s in sizes if s not in open_)
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * share > 2 * sizes[s]}
        for s in open_:
            target[s] = weight[s] * share
        for s in sizes:
            if s not in open_:
                target[s] = 2.0 * sizes[s]
        if not over:
            return target
        open_ -= over
    return {s: 2.0 * n if s not in open_ else target[s] for s, n in sizes.items()}


def test_targets_against_brute_force(spark, docs, rows, empty):
    sets = [
        {"a": 10, "b": 1000, "c": 3, None: 500, "é": 7, "z": 0},
        {"a": 0, None: 0},
        {"only": 12},
        {f"s{i}": (i * 7919) % 1000 for i in range(60)},
    ]
    for sizes in sets:
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r for r in M.source_targets(df).collect()}
        want = brute_targets(sizes)
        assert {s: r.target for s, r in got.items()} == pytest.approx(want)
        assert sum(r.target for r in got.values()) == pytest.approx(1.5 * sum(sizes.values()))
        assert all(r.target <= 2 * sizes[s] for s, r in got.items())
    assert M.source_targets(empty.select("source", F.lit(1).alias("size"))).count() == 0
    assert M.mix(empty).count() == 0 and M.mix_plan(empty).count() == 0


def test_mix_rows(docs, rows):
    plan = M.mix_plan(docs).collect()
    assert len(plan) == len(rows)
    want = brute_targets({s: sum(len(WORD.findall(t or "")) for _, t, x in rows if x == s) for _, _, s in rows})
    assert all(r.target == pytest.approx(want[r.source]) for r in plan)
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    copies = defaultdict(int)
    for r in plan:
        copies[r.doc_id, r.source] += r.copies
    got = Counter((r.doc_id, r.source) for r in mixed.collect())
    assert got == Counter({k: n for k, n in copies.items() if n})


def test_mix_query(spark):
    sf = "/root/testdata/sf0.01"
    first = op7_source_mix(spark, sf)
    rows = first.collect()
    again = op7_source_mix(spark, sf).collect()
    assert sorted(rows) == sorted(again)
    assert all(r.taken <= 2 * r["size"] for r in rows)
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[docs[r.doc_id]] += r.taken
        target[docs[r.doc_id]] = r.target
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.05)
    plan = first._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_twins(spark, name):
    import duckdb

    from sylvan.llm.queries import QUERIES
    from tools.oracle_check import _rows

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    r = con.execute(SQL[name])
    cols = [c[0] for c in r.description]
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, [tuple(x) for x in df.collect()]) == _rows(cols, r.fetchall())
