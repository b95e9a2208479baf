import re
from itertools import permutations

import duckdb

from sylvan.llm import filter_audit as A
from sylvan.llm.queries import op12_filter_audit
from sylvan.llm.sql import SQL
from tests.llm.conftest import by_id

COLS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(rows):
    """Failed filters of each (doc_id, text), one by one."""
    lowest = {}
    for i, t in rows:
        if i is not None:
            lowest[t or ""] = min(i, lowest.get(t or "", i))
    out = []
    for i, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if i is not None and lowest.get(t, i) < i:
            fails.add("E")
        out.append(fails)
    return out


def brute(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails = failures([(i, t) for i, t, _ in docs])
    out = []
    for part in sorted({s or "" for _, _, s in docs}):
        mine = [(i, f) for (i, _, s), f in zip(docs, fails, strict=True) if (s or "") == part]
        removed_in_all = dict.fromkeys("ABCDE", 0)
        rows = []
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                removed_in_all[x] += len(gone)
                redundant = sum(x in f for _, f in mine) - len(gone)
                only = sum(f == {x} for _, f in mine)
                rows.append((part, order, step, len(left), len(gone), redundant, only, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), x))
        out += [(*r[:-1], removed_in_all[r[-1]]) for r in rows]
    return sorted(out)


def test_query_against_brute_force_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    want = brute(docs, labels)
    assert by_id(op12_filter_audit(spark, sf), *COLS) == want
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = con.execute(f"SELECT {', '.join(COLS)} FROM ({SQL['op12_filter_audit']})").fetchall()
    assert sorted(got) == want


def test_odd_rows_and_many_copies(spark, docs, rows, empty, monkeypatch):
    labels = [(1, 1, 0), (1, 0, 1), (5, 1, None), (None, 1, 1), (99, 1, 1)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert by_id(A.audit(docs, lab), *COLS) == brute(rows, labels)
    assert A.audit(empty, lab).count() == 0
    assert by_id(A.audit(docs, lab.filter("1 = 0")), *COLS) == brute(rows, [])
    monkeypatch.setattr(A, "COPIES_PER_SALT", 3)  # a hot text is dealt over many salts
    hot = [(i, "same text" if i % 3 else f"text {i // 2}", "s") for i in range(120)] + rows
    more = spark.createDataFrame(hot, "doc_id long, text string, source string").repartition(5)
    assert by_id(A.audit(more, lab), *COLS) == brute(hot, labels)
