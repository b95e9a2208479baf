"""Embedding near-dedup: pairs at a cosine of ``MIN_COSINE`` or more, by an inverted multi-index.

The two halves of a vector have a codebook each (k-means on a bounded sample); their product is a
grid of cells. The multi-sequence traversal lists a vector's cells from the nearest on. Every
vector is entered in as many of its nearest cells as the target recall asks for, and two vectors are
compared if they share one: the number of visits is fitted on sampled vectors turned by exactly the
threshold's angle, the hardest links there are. If no number in ``VISITS`` reaches ``TARGET_RECALL``,
the grid is made coarser. Neighbouring cells form a region, the unit that Spark shuffles; each pair
found is verified by its cosine in double precision and counted in the first region it shares.

Crowds of near copies: exact copies are one vector with a weight. Where the sample is dense, a
*ball* gathers all vectors within half the threshold's angle of a sampled leader: any two of them
link, so they are counted without meeting. Balls are compared only with vectors close enough to
reach one of their members. Regions and balls above ``BLOCK_ROWS`` are dealt out as pairs of blocks.

Links of a block leave it as sums and as stars, never as pairs; the stars are merged by min-label
rounds. The sample holds about ``SAMPLE_ROWS`` vectors (chosen by digest, so reruns agree); all rows
are indexed.

A vector that is null, empty, zero, or holds a null or non-finite component links with nothing: 0
links, a component of its own. Vectors of different lengths never link; each length has an index of
its own. Repeated rows and ids are vectors of their own. A null id is kept and names a component only
if no member has an id. ``kept`` compares null-safe; of equal ids all are kept. Cosines equal to the
threshold link. Long vectors are handled whole. Extra columns are not read, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm.common import T_to_arrow, pick
from sylvan.llm.simhash import _merge, components
from sylvan.operators.features import maybe_broadcast
from sylvan.session import write_table

MIN_COSINE = 0.9
TARGET_RECALL = 0.995
VISITS = (1, 2, 4, 8, 16, 32, 64)
SAMPLE_ROWS = 16_384
#: Sampled vectors around a leader (of ``SAMPLE_ROWS``) that make a ball.
DENSE = 64
#: Vectors that a region should hold, and rows of a block of a hot one.
REGION_ROWS = 2048
BLOCK_ROWS = 4096
_CHUNK = 512
_SEED = 7
_EPS = 1e-9


def units(raw: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths, in double precision (scaled first: no overflow)."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True, initial=1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Stored vectors of one length as rows."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


# ---- the index ---------------------------------------------------------------------------


@dataclass
class Index:
    """Codebooks of both halves, cells visited, second-half cells of a region, leaders of the balls."""

    books: tuple[np.ndarray, np.ndarray]
    visits: int
    band: int
    leaders: np.ndarray


def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres, ordered along their main axis so that neighbours have near numbers."""
    rng = np.random.default_rng(_SEED)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds if k > 1 else 1):
        at = _square_distances(x, c).argmin(1)
        n = np.bincount(at, minlength=k)
        total = np.stack([np.bincount(at, x[:, j], k) for j in range(x.shape[1])], 1) if x.shape[1] else np.zeros((k, 0))
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    if k > 1 and x.shape[1]:
        axis = np.linalg.svd(c - c.mean(0), full_matrices=False)[2][0]
        c = c[np.argsort(c @ axis, kind="stable")]
    return c


def _square_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Up to the square of x itself."""
    return (c * c).sum(1) - 2 * x @ c.T


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (x.shape[1] + 1) // 2
    return x[:, :cut], x[:, cut:]


def multi_sequence(x: np.ndarray, books, visits: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``visits`` nearest cells (first, second code) of each row.

    A cell of ranks (a, b) is behind all cells of smaller ranks, so the nearest T cells lie on the
    staircase ``(a + 1) * (b + 1) <= T`` of the two sorted code lists."""
    codes, far = [], []
    for half, book in zip(_halves(x), books, strict=True):
        d = _square_distances(half, book)
        order = np.argsort(d, axis=1, kind="stable")[:, :visits]
        codes.append(order)
        far.append(np.take_along_axis(d, order, 1))
    stairs = [(a, b) for a in range(codes[0].shape[1]) for b in range(codes[1].shape[1]) if (a + 1) * (b + 1) <= visits]
    a, b = np.array(stairs).T
    near = np.argsort(far[0][:, a] + far[1][:, b], axis=1, kind="stable")[:, :visits]
    return np.take_along_axis(codes[0], a[near], 1), np.take_along_axis(codes[1], b[near], 1)


def turned(x: np.ndarray) -> np.ndarray:
    """Each row turned by the threshold's angle: every second one at random, the others towards another row."""
    rng = np.random.default_rng(_SEED)
    to = rng.normal(size=x.shape)
    to[::2] = np.roll(x, 1, axis=0)[::2]
    side = to - (to * x).sum(1, keepdims=True) * x
    n = np.linalg.norm(side, axis=1, keepdims=True)
    side = np.where(n > _EPS, side / np.maximum(n, _EPS), 0.0)
    return MIN_COSINE * x + np.sqrt(1 - MIN_COSINE**2) * side


def fitted_visits(x: np.ndarray, books) -> int | None:
    """Fewest visits at which the target share of turned rows shares a cell with its origin."""
    x = x[:2048]
    k = len(books[1])
    own, other = (i * k + j for i, j in (multi_sequence(y, books, VISITS[-1]) for y in (x, turned(x))))
    for t in VISITS:
        met = (own[:, :t, None] == other[:, None, :t]).any((1, 2))
        if met.mean() >= TARGET_RECALL:
            return t
    return None


def leaders(x: np.ndarray) -> np.ndarray:
    """Sampled vectors with ``DENSE`` or more others (not yet covered) within half the angle."""
    half = float(np.cos(np.arccos(MIN_COSINE) / 2)) + _EPS
    x32 = x.astype(np.float32)
    near = np.concatenate([(x32[i : i + _CHUNK] @ x32.T >= half).sum(1) for i in range(0, len(x), _CHUNK)])
    covered = np.zeros(len(x), bool)
    out = []
    for i in np.argsort(-near, kind="stable"):
        if near[i] < DENSE:
            break
        if covered[i]:
            continue
        mine = (x @ x[i] >= half) & ~covered
        if mine.sum() >= DENSE:
            covered |= mine
            out.append(x[i])
    return np.array(out).reshape(-1, x.shape[1])


def fit(x: np.ndarray, n: int) -> Index:
    """The index of ``n`` vectors of one length, from sampled units ``x``."""
    k = max(1, min(1 << max(0, int(np.log2(max(1.0, n / 8)) / 2 + 0.5)), len(x) // 16))
    parts = _halves(x)
    while True:
        books = tuple(k_means(p, k if p.shape[1] else 1) for p in parts)
        visits = fitted_visits(x, books) if k > 1 else 1
        if visits:
            break
        k //= 2
    k2 = len(books[1])
    rows_of_code = n * max(1.0, visits / 4) / len(books[0])
    band = int(max(1, min(k2, k2 * REGION_ROWS / max(1.0, rows_of_code))))
    return Index(books, visits, band, leaders(x))


def regions(x: np.ndarray, index: Index) -> list[np.ndarray]:
    """The distinct regions of each row's visited cells, ascending."""
    i, j = multi_sequence(x, index.books, index.visits)
    per = -(-len(index.books[1]) // index.band)
    return [np.unique(r) for r in i * per + j // index.band]


# ---- Spark side --------------------------------------------------------------------------


def stored_vectors(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """``vec_id, digest, vec``: the components' bytes (null where a vector cannot link) and their type."""
    element = df.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    rows = pick(df, vec_id=id_col, v=vector_col)
    rows = rows.select("vec_id", F.col("v").cast(T.ArrayType(T.FloatType() if kind == "<f4" else T.DoubleType())).alias("v"))
    schema = T.StructType([rows.schema["vec_id"]]).add("digest", "binary").add("vec", "binary")
    arrow = T_to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.values.to_numpy(zero_copy_only=False).astype(kind) + np.array(0, kind)  # null: NaN; no -0.0
            ends = np.asarray(lists.offsets)
            there = np.asarray(lists.is_valid())
            vecs = []
            for a, b, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), there.tolist(), strict=True):
                v = flat[a:b]
                vecs.append(v.tobytes() if ok and np.isfinite(v).all() and v.any() else None)
            keys = [None if v is None else hashlib.blake2b(v, digest_size=16).digest() for v in vecs]
            cols = [batch.column(0).cast(arrow.field(0).type), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return rows.mapInArrow(run, schema), kind


def fit_all(distinct: DataFrame, kind: str, n: int) -> dict[int, Index]:
    """An index for each vector length (in bytes) that the sample of about ``SAMPLE_ROWS`` rows holds."""
    share = min(1.0, SAMPLE_ROWS / max(1, n))
    chosen = distinct.filter(F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < int(share * (1 << 30)))
    by_length: dict[int, list[bytes]] = {}
    for digest, vec in sorted(chosen.select("digest", "vec").collect()):
        by_length.setdefault(len(vec), []).append(bytes(vec))
    width = np.dtype(kind).itemsize
    made = {}
    for length, vecs in by_length.items():
        x = units(np.frombuffer(b"".join(vecs), kind).reshape(len(vecs), length // width))
        made[length] = fit(x, int(len(vecs) / share))
    return made


def placed(distinct: DataFrame, kind: str, indexes: dict[int, Index]) -> DataFrame:
    """``digest, vec, w, ball, near, regions``: a vector's ball (or null), other balls that it may
    reach, and its regions (members of a ball have none). Numbers of a ball hold the length too."""
    schema = T.StructType().add("digest", "binary").add("vec", "binary").add("w", "long").add("ball", "long")
    schema = schema.add("near", T.ArrayType(T.LongType())).add("regions", T.ArrayType(T.LongType()))
    arrow = T_to_arrow(schema)
    angle = float(np.arccos(MIN_COSINE))
    within, reach = np.cos(angle / 2) + _EPS, np.cos(1.5 * angle) - _EPS

    def of_length(rows: pa.RecordBatch, length: int) -> pa.RecordBatch:
        x = units(matrix(rows.column(1), kind))
        index = indexes.get(length)
        n = len(x)
        balls, near, areas = [None] * n, [[]] * n, [[0]] * n  # a length outside the sample: one region
        if index:
            areas = [r.tolist() for r in regions(x, index)]
        if index and len(index.leaders):
            cos = x @ index.leaders.T
            best = cos.argmax(1)
            for i, m in enumerate(best.tolist()):
                close = [(length << 20) + int(b) for b in np.flatnonzero(cos[i] >= reach)]
                if cos[i, m] >= within:
                    balls[i] = (length << 20) + m
                    close.remove(balls[i])
                    areas[i] = []
                near[i] = close
        cols = [rows.column(0), rows.column(1), rows.column(2), balls, near, [[(length << 32) + r for r in a] for a in areas]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) if isinstance(c, list) else c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column(1).to_pylist()], np.int64)
            for length in np.unique(lengths).tolist():
                yield of_length(batch.take(pa.array(np.flatnonzero(lengths == length))), length)

    return distinct.select("digest", "vec", "w").mapInArrow(run, schema)


def meetings(rows: DataFrame) -> DataFrame:
    """Who meets whom: ``kind, g, h, p, q, side`` with the rows' columns.

    ``c``: vectors of a region g, all with all. ``s``: single vectors (side 1) with a ball g they may
    reach. ``b``: members of two balls g < h that may reach the other. Hot groups become pairs (p, q)
    of blocks of either side; within a region p <= q. Groups that lack a side are left out."""
    node = F.coalesce(F.col("ball_digest"), F.col("digest")).alias("node")
    base = rows.select("digest", "vec", "w", "regions", "ball", "near", node)
    none = F.lit(None).cast("bigint")

    def entry(kind: str, g, h, side):
        return F.struct(F.lit(kind).alias("kind"), g.cast("bigint").alias("g"), h.cast("bigint").alias("h"), side.cast("int").alias("side"))

    single = F.concat(
        F.transform("regions", lambda r: entry("c", r, F.lit(0), F.lit(0))),
        F.transform("near", lambda b: entry("s", b, F.lit(0), F.lit(1))),
    )
    member = F.concat(
        F.array(entry("s", F.coalesce("ball", none), F.lit(0), F.lit(2))),
        F.transform("near", lambda b: entry("b", F.least("ball", b), F.greatest("ball", b), F.when(F.col("ball") < b, 1).otherwise(2))),
    )
    keyed = base.withColumn("at", F.explode(F.when(F.col("ball").isNull(), single).otherwise(member)))
    keyed = keyed.select("digest", "vec", "w", "regions", "node", "at.*")
    size = keyed.groupBy("kind", "g", "h").agg(
        *[F.count(F.when(F.col("side") == s, 1)).alias(f"n{s}") for s in (0, 1, 2)]
    )
    lacking = "n0 = 1 or (n0 = 0 and (n1 = 0 or n2 = 0))"
    odd = size.filter(f"{lacking} or greatest(n0, n1, n2) > {BLOCK_ROWS}")
    blocks = [F.greatest(F.ceil(F.col(f"n{s}") / BLOCK_ROWS), F.lit(1)).cast("int").alias(f"b{s}") for s in (0, 1, 2)]
    odd = odd.select(F.col("kind").alias("_k"), F.col("g").alias("_g"), F.col("h").alias("_h"), F.expr(lacking).alias("idle"), *blocks)
    odd = write_table(odd, "imi-groups")
    odd = maybe_broadcast(odd, odd.count())
    same = (F.col("kind") == F.col("_k")) & (F.col("g") == F.col("_g")) & (F.col("h") == F.col("_h"))
    met = keyed.join(odd, same, "left").filter("not coalesce(idle, false)")
    n0, n1, n2 = (F.coalesce(f"b{s}", F.lit(1)) for s in (0, 1, 2))
    mine = F.pmod(F.xxhash64("digest"), F.when(F.col("side") == 0, n0).when(F.col("side") == 1, n1).otherwise(n2)).cast("int")
    met = met.withColumn("mine", mine).withColumn("others", F.when(F.col("side") == 0, n0).when(F.col("side") == 1, n2).otherwise(n1))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    region = F.col("side") == 0
    first = F.when(region, F.least("mine", "other")).when(F.col("side") == 1, F.col("mine")).otherwise(F.col("other"))
    second = F.when(region, F.greatest("mine", "other")).when(F.col("side") == 1, F.col("other")).otherwise(F.col("mine"))
    side = F.when(~region, F.col("side")).when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    return met.select("kind", "g", "h", first.alias("p"), second.alias("q"), side.cast("int").alias("side"), "digest", "vec", "w", "regions", "node")


def _earlier(of: list[list[int]], g: int) -> np.ndarray:
    """One row for each vector, one column for each region before g: whether it is entered there."""
    names = {r: i for i, r in enumerate(sorted({r for rs in of for r in rs if r < g}))}
    hot = np.zeros((len(of), len(names)), np.float32)
    for i, rs in enumerate(of):
        for r in rs:
            if r < g:
                hot[i, names[r]] = 1
    return hot


def block_links(kind: str, g: int, side: np.ndarray, x: np.ndarray, w: np.ndarray, of: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Linked weight of each row, and its component (an index) within the block."""
    left, right = (np.flatnonzero(side == 0),) * 2 if (side == 0).any() else (np.flatnonzero(side == s) for s in (1, 2))
    links, parent = np.zeros(len(x), np.int64), np.arange(len(x))
    earlier = None
    for a in range(0, len(left), _CHUNK):
        rows = left[a : a + _CHUNK]
        hit = x[rows] @ x[right].T >= MIN_COSINE
        if left is right:
            hit[np.arange(len(rows)), a + np.arange(len(rows))] = False
        if kind == "c" and hit.any():
            earlier = _earlier(of, g) if earlier is None else earlier
            if earlier.shape[1]:  # a pair belongs to the first region that both are entered in
                hit &= earlier[rows] @ earlier[right].T < 0.5
        if not hit.any():
            continue
        links[rows] += hit @ w[right]
        if left is not right:
            links[right] += w[rows] @ hit
        i, j = np.nonzero(hit)
        _merge(parent, rows[i], right[j])
    return links, parent


def verified(met: DataFrame, kind: str) -> DataFrame:
    """``digest, links, node, root``: each row's links in a block, and its star."""
    schema = T.StructType().add("digest", "binary").add("links", "long").add("node", "binary").add("root", "binary")
    arrow = T_to_arrow(schema)

    def run(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).combine_chunks() for n in ("side", "vec", "w", "digest", "node")}
        name, g = table.column("kind")[0].as_py(), table.column("g")[0].as_py()
        x = units(matrix(col["vec"], kind))
        links, parent = block_links(name, g, np.asarray(col["side"]), x, np.asarray(col["w"]), table.column("regions").to_pylist())
        at = pa.array(np.flatnonzero(links))
        nodes = col["node"].take(at), col["node"].take(pa.array(parent[np.asarray(at)]))
        return pa.Table.from_arrays([col["digest"].take(at), pa.array(links[np.asarray(at)]), *nodes], schema=arrow)

    return met.groupBy("kind", "g", "h", "p", "q").applyInArrow(run, schema)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df``."""
    rows, kind = stored_vectors(df, id_col, vector_col)
    rows = write_table(rows, "imi-rows")
    distinct = rows.filter("digest is not null").groupBy("digest").agg(
        F.first("vec").alias("vec"), F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("low")
    )
    distinct = write_table(distinct, "imi-distinct")
    indexes = fit_all(distinct, kind, distinct.count())
    where = write_table(placed(distinct, kind, indexes), "imi-placed")

    # a ball's weight, and the digest that stands for it (at most SAMPLE_ROWS / DENSE balls for each length)
    balls = where.filter("ball is not null").groupBy(F.col("ball").alias("_ball")).agg(
        F.sum("w").alias("ball_w"), F.min("digest").alias("ball_digest")
    )
    balls = write_table(balls, "imi-balls")
    where = where.join(maybe_broadcast(balls, balls.count()), F.col("ball") == F.col("_ball"), "left")

    stars = write_table(verified(meetings(where), kind), "imi-links")
    links = stars.groupBy("digest").agg(F.sum("links").alias("links"))
    cc = components(stars.select(F.col("node").alias("a"), F.col("root").alias("b")))
    cc = write_table(cc, "imi-components")

    low = distinct.select(F.col("digest").alias("_digest"), "low")
    members = where.select("digest", "w", F.coalesce("ball_w", "w").alias("ball_w"), F.coalesce("ball_digest", "digest").alias("node"))
    members = members.join(links, "digest", "left").join(low, F.col("digest") == F.col("_digest"))
    members = members.join(cc, F.col("node") == F.col("v"), "left")
    total = F.col("ball_w") - 1 + F.coalesce("links", F.lit(0))
    named = write_table(members.select("digest", total.alias("n_links"), "low", F.coalesce("root", "node").alias("root")), "imi-named")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of_vector = named.join(lowest, "root").select(F.col("digest").alias("_digest"), "n_links", "component_id")
    out = rows.select("vec_id", "digest").join(of_vector, F.col("digest") == F.col("_digest"), "left")
    linked = F.col("n_links").isNotNull()
    component = F.when(linked, F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
