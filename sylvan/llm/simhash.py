"""SimHash near-dedup: fingerprints in numpy, linked by a binary-trie self-join.

Fingerprints: XXH64 (seed 42) of every word shingle; a bit is 1 if it is set in over half of
the hashes. Links: pairs of distinct fingerprints at ``MAX_BITS`` or fewer differing bits.

The join walks a binary trie of the fingerprints with itself: it takes pairs of nodes down
together, adds a difference where their branches part, and drops a pair once its differences
exceed the budget. Such a walk stays narrow only if the budget is small near the root, so it
is run three times, each time with another third of the bits (22, 21, 21) on top: a pair with
at most 4 differences has at most 1 in one of the thirds. The trie's upper levels are dealt
out by Spark: a group is one prefix of the leading third, and each fingerprint also goes to
the groups of the prefixes that differ from its own in one bit (to the smaller of both only).
Within a group each component is reported as a star (one row per member), never as all its
pairs; the stars are merged by min-label rounds over written tables.

Texts without words have fingerprint zero and link like any other. Copies share one
fingerprint and are expanded only by the last join. A null text counts as empty; a null id is
kept, but never names a component unless the whole component has no id; rows with equal ids
are rows of their own. Very long texts are fingerprinted whole. Extra columns keep their values, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm.common import T_to_arrow, free_name, map_text, pick
from sylvan.session import write_table

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Bits on top in each of the three walks, and the differences allowed there.
THIRDS = (22, 21, 21)
TOP_BUDGET = MAX_BITS // len(THIRDS)
#: Fingerprints of an own prefix that a group should hold (sets the prefix length).
GROUP_ROWS = 4096
#: Node pairs expanded at a time within a group, and rows of a leaf product.
CHUNK = 1 << 17
LEAF_PAIRS = 64

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    from xxhash import xxh64_intdigest

    words = text.translate(_FOLD).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    last = ends[k - 1 :].tolist()
    first = [0, *(ends[: len(words) - k] + 1).tolist()]
    hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in zip(first, last, strict=True)], np.uint64)
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long)."""

    def per_slice(texts: list[bytes]) -> dict[str, list]:
        got = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return {"fp": got.view(np.int64).tolist()}

    return map_text(pick(df, doc_id=id_col, text=text_col), per_slice, [("fp", T.LongType())])


# ---- the walk within one group -----------------------------------------------------------


def _rotate(x: np.ndarray, r: int) -> np.ndarray:
    """The bits of walk ``r`` on top."""
    s = sum(THIRDS[:r])
    return x if not s else (x << np.uint64(s)) | (x >> np.uint64(64 - s))


def _merge(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the components of the index pairs; ``parent`` ends up flat (each entry its root)."""
    while len(i):
        a, b = parent[i], parent[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def trie_links(x: np.ndarray, roots: list[tuple[int, int, int, int, int]], depth: int, top: int,
               max_bits: int = MAX_BITS, top_budget: int = TOP_BUDGET) -> np.ndarray:
    """Component roots (indices) of the sorted distinct values ``x``.

    ``roots``: pairs of trie nodes to start from, as index ranges ``(lo, hi, lo, hi, errors)``
    of equal ``depth``-bit prefixes; a node with itself gives each pair within it once. Up to
    depth ``top`` a pair may differ in ``top_budget`` bits, in all in ``max_bits``. Chunks of
    node pairs wait on a stack, so memory is bounded by the trie's depth. Node pairs whose
    members already form one component are skipped.
    """
    parent = np.arange(len(x))
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, np.array(roots, np.int64).reshape(-1, 5))]
    while stack:
        d, f = stack.pop()
        if len(f) > CHUNK:
            stack.append((d, f[CHUNK:]))
            f = f[:CHUNK]
        al, ah, bl, bh, err = f.T
        size = (ah - al) * (bh - bl)
        whole = _one_component(parent, al, ah, bl, bh)
        small = ~whole & ((size <= LEAF_PAIRS) | (d >= 64))
        if small.any():
            _leaves(x, parent, f[small], top, max_bits, top_budget)
        f = f[~small & ~whole]
        if not len(f):
            continue
        if d not in ones:
            bit = (x >> np.uint64(63 - d)).astype(np.int64) & 1
            ones[d] = np.concatenate(([0], np.cumsum(bit)))
        c = ones[d]
        al, ah, bl, bh, err = f.T
        am, bm = ah - (c[ah] - c[al]), bh - (c[bh] - c[bl])
        self_ = al == bl
        parts = [
            np.stack([al, am, bl, bm, err], 1),
            np.stack([am, ah, bm, bh, err], 1),
            np.stack([al, am, bm, bh, err + 1], 1),
            np.stack([am, ah, bl, bm, err + 1], 1)[~self_],  # a node with itself: once is enough
        ]
        g = np.concatenate(parts)
        budget = top_budget if d < top else max_bits
        g = g[(g[:, 0] < g[:, 1]) & (g[:, 2] < g[:, 3]) & (g[:, 4] <= budget)]
        if len(g):
            stack.append((d + 1, g))
    return parent


def _one_component(parent, al, ah, bl, bh) -> np.ndarray:
    """Node pairs that are a single value with itself, or two runs of one component."""
    own = (al == bl) & (ah - al == 1)
    steps = np.concatenate(([0], np.cumsum(parent[1:] != parent[:-1])))  # component changes before each index
    flat = (steps[ah - 1] == steps[al]) & (steps[bh - 1] == steps[bl])
    return own | (flat & (parent[al] == parent[bl]))


def _leaves(x, parent, f, top, max_bits, top_budget) -> None:
    """Compares all values of small node pairs bit by bit."""
    al, ah, bl, bh, _ = f.T
    nb = bh - bl
    size = (ah - al) * nb
    at = np.repeat(np.cumsum(size) - size, size)
    k = np.arange(len(at)) - at
    nb = np.repeat(nb, size)
    i, j = np.repeat(al, size) + k // nb, np.repeat(bl, size) + k % nb
    diff = x[i] ^ x[j]
    near = (np.bitwise_count(diff) <= max_bits) & (np.bitwise_count(diff >> np.uint64(64 - top)) <= top_budget) & (i != j)
    _merge(parent, i[near], j[near])


def group_links(fps: np.ndarray, walk: int, prefix: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links ``(member, centre)`` among the fingerprints sent to one group."""
    x = np.unique(_rotate(np.ascontiguousarray(fps).view(np.uint64), walk))
    top = THIRDS[walk]
    lo_of = lambda p: int(np.searchsorted(x, np.uint64(p << (64 - bits)))) if bits else 0
    hi_of = lambda p: int(np.searchsorted(x, np.uint64(((p + 1) << (64 - bits)) - 1), "right")) if bits else len(x)
    own = (lo_of(prefix), hi_of(prefix))
    roots = [(*own, *own, 0)]
    for b in range(bits):
        other = prefix ^ (1 << b)
        if other > prefix and TOP_BUDGET:
            roots.append((*own, lo_of(other), hi_of(other), 1))
    roots = [r for r in roots if r[0] < r[1] and r[2] < r[3]]
    parent = trie_links(x, roots, bits, top)
    back = _rotate(x, 0) if not walk else (x >> np.uint64(sum(THIRDS[:walk]))) | (x << np.uint64(64 - sum(THIRDS[:walk])))
    member = parent != np.arange(len(x))
    return back[member].view(np.int64), back[parent[member]].view(np.int64)


def _prefix(walk: int, bits: int):
    s = sum(THIRDS[:walk])
    x = F.col("fp") if not s else F.shiftleft("fp", s).bitwiseOR(F.shiftrightunsigned("fp", 64 - s))
    return F.shiftrightunsigned(x, 64 - bits) if bits else F.lit(0).cast("bigint")


def prefix_bits(fps: DataFrame) -> int:
    """Prefix length at which the fullest prefix holds about ``GROUP_ROWS`` fingerprints (near
    copies crowd together), at most the length of a third."""
    bits = 0
    while bits < min(THIRDS):
        walks = F.array(*[F.struct(F.lit(w).alias("w"), _prefix(w, bits).alias("p")) for w in range(len(THIRDS))])
        sizes = fps.select(F.explode(walks).alias("g")).groupBy("g").count()
        most = sizes.agg(F.max("count")).first()[0] or 0
        if most <= 2 * GROUP_ROWS:
            break
        bits = min(min(THIRDS), bits + max(1, int(np.log2(most / GROUP_ROWS))))
    return bits


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """``a, b``: links that connect exactly the components of the distinct fingerprints ``fp``."""
    bits = prefix_bits(fps)
    rotated = []
    for walk in range(len(THIRDS)):
        own = _prefix(walk, bits)
        flips = [own.bitwiseXOR(F.lit(1 << b)) for b in range(bits)]
        # a pair of neighbour prefixes belongs to the group of the smaller one
        groups = F.array_compact(F.array(own, *[F.when(f < own, f) for f in flips]))
        rotated.append(F.struct(F.lit(walk).alias("walk"), groups.alias("prefixes")))
    walks = fps.select("fp", F.explode(F.array(*rotated)).alias("w"))
    dealt = walks.select("fp", F.col("w.walk").alias("walk"), F.explode("w.prefixes").alias("prefix"))

    schema = T.StructType().add("a", "long").add("b", "long")
    arrow = T_to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, members in _groups(batches):
            a, b = group_links(members, int(key[0]), int(key[1]), bits)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=arrow)

    # the rows of a group are neighbours in one partition; a group alone is held at a time
    sorted_ = dealt.repartition("walk", "prefix").sortWithinPartitions("walk", "prefix")
    return sorted_.select("walk", "prefix", "fp").mapInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """Runs of equal (walk, prefix) with two fingerprints or more."""
    key, held = None, []
    for batch in batches:
        walk, prefix, fp = (np.asarray(batch.column(c)) for c in range(3))
        if not len(fp):
            continue
        cuts = np.flatnonzero((walk[1:] != walk[:-1]) | (prefix[1:] != prefix[:-1])) + 1
        begins, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fp)]))
        first = (walk[0], prefix[0])
        if key is not None and key != first:
            if sum(map(len, held)) > 1:
                yield key, np.concatenate(held)
            held = []
        # the last run may go on in the next batch; runs of one row have no pair
        whole = [(b, e) for b, e in zip(begins[:-1].tolist(), ends[:-1].tolist(), strict=True) if e - b > 1 or b == 0]
        for b, e in whole:
            members = np.concatenate([*held, fp[b:e]]) if b == 0 else fp[b:e]
            if b == 0:
                held = []
            if len(members) > 1:
                yield (walk[b], prefix[b]), members
        key = (walk[-1], prefix[-1])
        held.append(fp[begins[-1] :])
    if sum(map(len, held)) > 1:
        yield key, np.concatenate(held)


def components(links: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of ``links (a, b)``; the root is the component's smallest vertex.

    Each round replaces an edge by edges to smaller neighbours (large-star, then small-star), so
    chains halve; it ends when every edge goes from a vertex to its root. A round is two
    aggregates and two joins over a written table. Degrees are combined before the shuffle.
    """
    edges = write_table(_down(links).distinct(), "cc-edges")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = write_table(_down(large).distinct(), "cc-large")
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(low, F.col("a") == F.col("u"))
        small = small.select("b", "m").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = _down(small.union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        new = write_table(small.distinct(), "cc-edges")
        # done when every vertex has one edge and no root has one
        two = new.groupBy("a").count().filter("count > 1").limit(1).count()
        chain = two or new.join(new.select(F.col("a").alias("u")), F.col("b") == F.col("u"), "left_semi").limit(1).count()
        if not chain:
            return new.select(F.col("a").alias("v"), F.col("b").alias("root"))
        edges = new


def _down(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller vertex, without loops."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id that links reach, the row's own included."""
    docs = write_table(fingerprints(df, id_col, text_col), "simhash")
    distinct = write_table(docs.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    cc = write_table(components(fingerprint_links(distinct.select("fp"))), "simhash-cc")
    named = distinct.join(cc, distinct["fp"] == cc["v"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of_fp = named.join(lowest, "root").select("fp", "component_id")
    return docs.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of each component: the one with the smallest id (null ids last, ties
    by the text's digest; of rows equal in both, any one)."""
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    place = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("doc_id"), digest.alias("digest"))
    rows = df.select(place.alias("place"), F.col(text_col).alias("text"))
    found = write_table(near_duplicates(rows, "place", "text"), "simhash-rows")
    hits = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id")
    first = write_table(hits.distinct(), "simhash-kept")
    name = free_name(df, "sh_place")
    first = first.select(F.col("doc_id").alias("sh_kept"))
    marked = df.withColumn(name, place)
    kept = marked.join(first.hint("shuffle_hash"), marked[name] == first["sh_kept"], "left_semi")
    if hits.count() > first.count():  # rows equal in id and text
        kept = kept.dropDuplicates([name])
    return kept.select(*df.columns)
