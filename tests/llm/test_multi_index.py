import math

import numpy as np
import pytest

from sylvan.llm import multi_index as M
from sylvan.llm.queries import op13_embedding_dedup
from tests.llm.conftest import by_id

COLS = ("vec_id", "n_links", "component_id", "kept")


def brute(rows):
    """rows: (vec_id, list or None). All pairs by their cosines."""
    n = len(rows)
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = [0] * n
    for length in {len(v) for (_, v), o in zip(rows, ok, strict=True) if o}:
        at = [i for i in range(n) if ok[i] and len(rows[i][1]) == length]
        x = np.array([rows[i][1] for i in at], np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for k, i in enumerate(at):
            for j in np.flatnonzero(x @ x[k] >= 0.9).tolist():
                if j != k:
                    links[i] += 1
                    parent[root(at[j])] = root(i)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = low.get(root(i)) if ok[i] else d
        out.append((d, links[i], c, d == c))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, digest int").repartition(4)


def f32(x):
    return [float(v) for v in np.asarray(x, np.float32)]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert by_id(op13_embedding_dedup(spark, sf), *COLS) == brute(rows)


def clusters(seed, n, d=24):
    """Tight and loose groups, exact and scaled copies, lone vectors."""
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        c = rng.normal(size=d)
        c /= np.linalg.norm(c)
        size, spread = int(rng.integers(1, 60)), float(rng.choice([0.0, 0.02, 0.08, 0.12]))
        for _ in range(size):
            v = c + spread * rng.normal(size=d)
            out.append(f32(v * rng.choice([1.0, 0.5, 3.0])))
    return [(i, v) for i, v in enumerate(out[:n])]


def test_groups_of_all_widths(spark, monkeypatch):
    rows = clusters(1, 1500)
    want = brute(rows)
    assert sum(r[1] for r in want) > 5000 and len({r[2] for r in want}) > 60
    got = by_id(M.near_duplicates(frame(spark, rows)), *COLS)
    total = sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))  # no false link
    assert sum(r[1] for r in got) >= M.TARGET_RECALL * total
    # balls, blocks of hot groups, many regions: no link may be lost or counted twice
    monkeypatch.setattr(M, "DENSE", 8)
    monkeypatch.setattr(M, "BLOCK_ROWS", 16)
    monkeypatch.setattr(M, "REGION_ROWS", 50)
    again = by_id(M.near_duplicates(frame(spark, rows)), *COLS)
    assert all(g[1] <= w[1] for g, w in zip(again, want, strict=True))
    assert sum(r[1] for r in again) >= M.TARGET_RECALL * total


def test_one_hot_group(spark, monkeypatch):
    """A third of all rows are near copies, another part exact ones: found by balls, none lost."""
    monkeypatch.setattr(M, "DENSE", 32)
    rng = np.random.default_rng(4)
    c, e = rng.normal(size=(2, 16))
    rows = [f32(c + 0.05 * rng.normal(size=16)) for _ in range(500)] + [f32(e)] * 300
    rows += [f32(rng.normal(size=16)) for _ in range(700)]
    rows = [(i, v) for i, v in enumerate(rows)]
    assert by_id(M.near_duplicates(frame(spark, rows)), *COLS) == brute(rows)


def test_odd_rows(spark):
    v = [0.1 * i + 0.3 for i in range(8)]
    rows = [
        (1, f32(v)), (2, f32(np.array(v) * 1e30)), (3, None), (4, []), (5, [0.0] * 8), (6, [1.0, None] * 4), (7, [math.nan] * 8),
        (8, [math.inf] + [1.0] * 7), (None, f32(v)), (None, None), (1, f32(v)), (9, f32(v[:7])), (10, [-x for x in f32(v)]),
        (11, [1.0]), (12, [-2.0]), (13, [5.0]), (14, f32(np.ones(5000))), (15, [-0.0, 1.0]), (16, [0.0, 1.0]),
    ]
    assert by_id(M.near_duplicates(frame(spark, rows)), *COLS) == brute(rows)
    assert M.near_duplicates(frame(spark, rows).filter("1 = 0")).count() == 0
    lone = [(None, f32(v)), (None, f32(v))]
    assert by_id(M.near_duplicates(frame(spark, lone)), *COLS) == [(None, 1, None, True)] * 2


def test_multi_sequence_is_the_full_order():
    rng = np.random.default_rng(2)
    x, books = rng.normal(size=(50, 6)), (rng.normal(size=(7, 3)), rng.normal(size=(5, 3)))
    for t in (1, 4, 16):
        i, j = M.multi_sequence(x, books, t)
        far = ((x[:, None, :3] - books[0]) ** 2).sum(2)[:, :, None] + ((x[:, None, 3:] - books[1]) ** 2).sum(2)[:, None, :]
        want = np.sort(far.reshape(50, -1), axis=1)[:, :t]
        got = np.take_along_axis(far.reshape(50, -1), i * 5 + j, 1)
        assert np.allclose(got, want)


def test_recall_is_fitted_on_the_hardest_links():
    rng = np.random.default_rng(5)
    x = M.units(rng.normal(size=(4096, 64)))
    index = M.fit(x, 100_000)
    assert index.visits in M.VISITS and len(index.books[0]) >= 32
    own, other = M.regions(x[:1000], index), M.regions(M.turned(x[:1000]), index)
    met = np.mean([len(np.intersect1d(a, b)) > 0 for a, b in zip(own, other, strict=True)])
    assert met >= 0.99
    assert pytest.approx((M.turned(x) * x).sum(1).mean(), abs=1e-9) == 0.9
