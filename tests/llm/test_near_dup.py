import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sylvan.llm import simhash as S
from sylvan.llm.queries import op9_simhash
from tests.llm.conftest import by_id


def brute_fp(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """Smallest id reachable; fps: list of (id, fingerprint), ids may be None or repeat."""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    x = np.array([f for _, f in fps], np.uint64)
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 4):
            parent[root(int(j))] = root(i)
    low = defaultdict(list)
    for i, (d, _) in enumerate(fps):
        if d is not None:
            low[root(i)].append(d)
    return [min(low[root(i)], default=None) for i in range(len(fps))]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    fps = [(i, brute_fp(t)) for i, t in docs]
    want = sorted((i, f"{f:016x}", c) for (i, f), c in zip(fps, brute_components(fps), strict=True))
    assert by_id(op9_simhash(spark, sf), "doc_id", "fingerprint", "component_id") == want
    assert len({c for _, _, c in want}) < len(want)


def test_odd_rows(docs, rows, empty):
    fps = [(i, brute_fp(t)) for i, t, _ in rows]
    want = [(i, f, c) for (i, f), c in zip(fps, brute_components(fps), strict=True)]
    got = [(r.doc_id, r.fp % 2**64, r.component_id) for r in S.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert S.near_duplicates(empty).count() == 0
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted({c for _, _, c in want if c})
    assert S.keep_one(empty).count() == 0


def _balls(n, seed):
    """Random fingerprints, chains and dense balls of near ones."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 2**63, n, dtype=np.uint64).tolist()
    for c in x[: n // 20]:
        v = c
        for _ in range(12):  # a chain: far ends differ in many bits
            for b in rng.choice(64, 4, replace=False):
                v ^= 1 << int(b)
            x.append(v)
    centre = x[0]
    for _ in range(n // 2):
        v = centre
        for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
            v ^= 1 << int(b)
        x.append(v)
    return np.unique(np.array(x, np.uint64))


def test_trie_join_loses_no_link(spark, monkeypatch):
    x = _balls(3000, 3)
    want = brute_components([(int(f), int(f)) for f in x.view(np.int64)] and [(i, int(f)) for i, f in enumerate(x)])
    monkeypatch.setattr(S, "GROUP_ROWS", 128)  # many groups, so that neighbour prefixes count
    fps = spark.createDataFrame([(int(f),) for f in x.view(np.int64)], "fp long")
    assert S.prefix_bits(fps) > 3
    cc = {r.v: r.root for r in S.components(S.fingerprint_links(fps)).collect()}
    label = [cc.get(int(f), int(f)) for f in x.view(np.int64)]
    assert len(set(zip(label, want, strict=True))) == len(set(label)) == len(set(want))


def test_hot_group_emits_stars(spark):
    x = _balls(2000, 5)
    fps = spark.createDataFrame([(int(f),) for f in x.view(np.int64)], "fp long")
    links = S.fingerprint_links(fps)
    assert links.count() <= 3 * len(x) * (1 + S.prefix_bits(fps))  # no more rows than members of groups


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r.v: r.root for r in S.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 301)}
    assert S.components(edges.filter("a < 0")).count() == 0
