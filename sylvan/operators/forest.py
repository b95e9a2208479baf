"""Level-wise growth of a one-vs-rest forest of binary term-split trees.

State (all DataFrames, nothing per row on the driver):

* ``rows`` (doc_id, label, terms, at)   one row per training row: its vocabulary terms as numbers, and
  where it sits in every tree, as an array (``operators.state``);
* ``frontier`` (tree, node, path, depth, n, k, path_terms)   one row per open node; ``node`` is its number
  within the level, ``path`` its path string.

Per level: close nodes by depth / entropy (T4, T4b), one statistics aggregation for all
trees and nodes, score by rule, best split per node, then the state moves to ``path+'L'``
(term present) or ``path+'R'`` (absent) by an expression over the rows. The rows are rewritten only
when the expression chain has ``CHAIN_STEPS`` levels, or when few of them are still under way; in between a
level reads them once. Terms, nodes and trees are numbers throughout (K1) and are named at the end.
Written tables are deleted when the next one replaces them, and all of them when the growth ends or
fails. Node-level tables are broadcast only when count x row width fits a byte budget (else a shuffle
join, with AQE's skew split for hot nodes).

Paths are strings over {L, R} (root = ''): depth is not bounded by 64 bits and
the lexicographic order of paths is the pre-order of the tree.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.functions import entropy as E
from sylvan.functions.text import STOP_ENTROPY
from sylvan.operators import state as S
from sylvan.operators.dictionary import as_sets, decode, dictionary, encode
from sylvan.operators.features import maybe_broadcast
from sylvan.operators.ordered import dense_index
from sylvan.operators.splits import best_splits, level_stats, root_stats, scored_candidates, with_absent_terms
from sylvan.session import Scratch, drop_scratch, shuffle_partitions, table_scope, write_table

log = logging.getLogger("sylvan.forest")

NODE_COLUMNS = ["tree", "node", "depth", "term", "score", "n", "k", "is_leaf", "label"]
# The rows are rewritten for the active ones only once those are fewer than this
# share of the rows they hold, so the per-level scan shrinks with the frontier ...
COMPACT_SHARE = 0.5
# ... or when this many steps are chained.
CHAIN_STEPS = 4
# Node-level tables get one partition per this many rows (they are unions of small parts;
# without a repartition their partition count would double every level).
NODE_ROWS_PER_PARTITION = 200_000


def node_row_bytes(depth: int) -> int:
    """Upper estimate of a node-level row: keys, counts, score, plus the path's terms."""
    return 128 + 32 * depth


def node_partitions(spark: SparkSession, rows: int) -> int:
    return max(1, min(shuffle_partitions(spark), -(-rows // NODE_ROWS_PER_PARTITION)))


_NODE = ["tree", "node", "path", "depth"]


def _leaf_rows(df: DataFrame) -> DataFrame:
    """Leaf node rows (with the split-only columns empty) for closed frontier nodes."""
    none = F.lit(None)
    return df.select(
        *_NODE, none.cast("int").alias("term"), none.cast("double").alias("score"), "n", "k", F.lit(True).alias("is_leaf"),
        none.cast("bigint").alias("n1"), none.cast("bigint").alias("k1"), "path_terms",
    )


def decide_level(
    frontier: DataFrame,
    stats_of: Callable[[DataFrame], DataFrame],
    frontier_rows: int,
    rule: str,
    vocab_size: int,
    max_depth: int,
    stop_entropy: float,
    level: int = 0,
) -> DataFrame:
    """Node rows (decision or leaf) for every frontier node of one level (all at depth ``level``).

    ``stats_of(open_nodes)`` gives the term statistics; they are read once, for the best split
    and the candidate count alike.
    """
    # T4 (depth, entropy) and, for mr, T4b (at most one attribute left)
    stop = closes("n", "k", "depth", rule, vocab_size, max_depth, stop_entropy)
    fr = frontier.withColumn("_stop", stop)
    closed = _leaf_rows(fr.filter("_stop"))
    # frontier rows carry the path's terms: width grows with depth
    width = node_row_bytes(level)
    open_nodes = maybe_broadcast(fr.filter(~F.col("_stop")).drop("_stop"), frontier_rows, width)

    cands = scored_candidates(stats_of(open_nodes), open_nodes, rule, ["node"])
    best = maybe_broadcast(best_splits(cands, ["node"]), frontier_rows, width)

    j = open_nodes.join(best, "node", "left")
    if rule == "c45":
        splits_ok = F.col("term").isNotNull()
    else:
        j = with_absent_terms(j, vocab_size)
        # the winner must have both sides; a pseudo or one-sided winner ends the branch
        splits_ok = (
            F.col("term").isNotNull() & (F.col("pseudo") == 0) & E.mr_has_both_sides("n", "k", "n1", "k1")
        )
    j = j.withColumn("_split", F.coalesce(splits_ok, F.lit(False)))
    of_split = [F.when(F.col("_split"), F.col(c)).alias(c) for c in ("term", "score", "n1", "k1")]
    term, score, n1, k1 = of_split
    decided = j.select(*_NODE, term, score, "n", "k", (~F.col("_split")).alias("is_leaf"), n1, k1, "path_terms")
    return closed.unionByName(decided)


def children(splits: DataFrame) -> DataFrame:
    """The next frontier, child counts handed down from the split statistics. The split with
    number ``s`` has the children 2s (term present) and 2s + 1."""
    path = F.concat("path_terms", F.array("term"))

    def side(letter: str, at: int, n, k) -> DataFrame:
        return splits.select(
            "tree", (2 * F.col("s") + at).cast("bigint").alias("node"), F.concat("path", F.lit(letter)).alias("path"),
            (F.col("depth") + 1).alias("depth"), n.alias("n"), k.alias("k"), path.alias("path_terms"),
        )

    right = (F.col("n") - F.col("n1"), F.col("k") - F.col("k1"))
    return side("L", 0, F.col("n1"), F.col("k1")).unionByName(side("R", 1, *right))


def closes(n, k, depth, rule: str, vocab_size: int, max_depth: int, stop_entropy: float):
    """T4 / T4b as a predicate on a node's (n, k, depth): the node becomes a leaf.

    ``n`` and ``k`` are column names (the entropy expression is then reused across levels).
    """
    d = F.col(depth) if isinstance(depth, str) else depth
    stop = (d >= max_depth) | E.is_pure_enough(k, n, stop_entropy)
    if rule == "mr":
        stop = stop | (F.lit(vocab_size) - d <= 1)
    return stop


def number_terms(
    terms: DataFrame, parts: int | None = None, vocab: DataFrame | None = None, vocab_size: int | None = None
) -> tuple[DataFrame, DataFrame, int]:
    """``doc_id, label, terms`` with the terms as numbers (written), the dictionary and its size.

    Numbers follow the terms' order, so ties between terms are decided alike. ``vocab``: a table of ``vocab_size``
    rows that holds every ``term``, where the caller has one. Ids are unique, so each row's terms are coded where
    they are; a dictionary above the broadcast budget is joined, and the rows are gathered again."""
    if vocab is None:
        words = dictionary(terms.select(F.explode("terms").alias("term")), "term", "term_id")
    else:
        words = dictionary(vocab, "term", "term_id", parts=node_partitions(terms.sparkSession, vocab_size))
    n = words.count()
    sets = as_sets(terms.select("doc_id", "label", F.coalesce("terms", F.array().cast("array<string>")).alias("terms")), "terms", words, "term", n, numbered=True)
    if sets is not None:
        return write_table(sets.repartition(parts) if parts else sets, "rows"), words, n
    each = terms.select("doc_id", "label", F.explode_outer("terms").alias("term"))
    each = encode(each, words, "term", "term_id", n)
    each = each.repartition(parts or shuffle_partitions(terms.sparkSession), "doc_id")
    sets = each.groupBy("doc_id", "label").agg(F.array_sort(F.collect_list(F.col("term_id").cast("int"))).alias("terms"))
    return write_table(sets, "rows"), words, n


def grow_forest(
    spark: SparkSession,
    terms: DataFrame,
    base: DataFrame,
    labels: Sequence[str],
    vocab_size: int,
    rule: str = "c45",
    max_depth: int = 20,
    stop_entropy: float = STOP_ENTROPY,
    buckets: int | None = None,
    vocab: DataFrame | None = None,
) -> DataFrame:
    """Grow one tree per label, all trees in the same jobs.

    ``terms``: (doc_id, [label,] terms) of the training rows, ids unique; ``base``: (doc_id, label);
    ``buckets``: partitions of the rows (as they come; after a join the session's shuffle partitions);
    ``vocab``: a table with every ``term`` (and no more than ``vocab_size``), so that none is looked for in the rows.
    Returns the node table ``tree, node, depth, term, score, n, k, is_leaf, label``.
    Driver work per level: the split nodes' numbers (a count, for levels above ``LITERAL_NODES``).
    """
    if rule not in ("c45", "mr"):
        raise ValueError(f"unknown rule {rule!r}")
    labels = list(labels)
    with table_scope(spark) as scope:
        labelled = terms if "label" in terms.columns else terms.join(base.select("doc_id", "label"), "doc_id")
        rows, words, n_words = number_terms(labelled.select("doc_id", "label", "terms"), buckets, vocab, vocab_size)
        sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("c"))
        n_all = rows.count()
        if n_all == 0:
            raise ValueError("empty training set")
        nodes, n_nodes = _grow(spark, rows, sizes, n_all, labels, vocab_size, rule, max_depth, stop_entropy)
        # the numbers get their names back
        named = decode(nodes.withColumnRenamed("term", "term_id"), words, "term_id", "term", n_words)
        tree = F.get(S.lit_array(labels, "string"), F.col("tree"))
        named = named.withColumn("tree", tree).drop("node").withColumnRenamed("path", "node")
        label = F.when(F.col("is_leaf"), E.majority_label("n", "k", F.col("tree")))
        out = named.withColumn("label", label).select(*NODE_COLUMNS)
        return scope.result(out.repartition(node_partitions(spark, n_nodes)), "forest-nodes")


def _grow(spark, rows, sizes, n_all, labels, vocab_size, rule, max_depth, stop_entropy) -> tuple[DataFrame, int]:
    """The node rows of all levels (numbers throughout) and their count."""
    held: list[Scratch] = []  # the written rows in use
    root = F.array_position(S.lit_array(labels, "string"), F.col("tree")) - 1
    # trees whose class has no row still get a root (k = 0)
    lab = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "tree int, label string")
    frontier = lab.join(sizes, "label", "left").select(
        "tree",
        F.col("tree").cast("bigint").alias("node"),
        F.lit("").alias("path"),
        F.lit(0).alias("depth"),
        F.lit(n_all).cast("bigint").alias("n"),
        F.coalesce("c", F.lit(0)).cast("bigint").alias("k"),
        F.array().cast("array<int>").alias("path_terms"),
    )
    frontier_rows = len(labels)
    roots = root_stats(rows, labels).select(root.alias("node"), "term", "n1", "k1")
    active = rows.withColumn("at", S.start(labels, F.col("label")))
    rows_held, chained = n_all, 0
    levels: list[DataFrame] = []
    total = depth = 0
    closes_only = max_depth <= 0  # the next level only closes nodes (no statistics needed)
    while frontier_rows > 0:
        t0 = time.time()
        total += frontier_rows
        if closes_only:
            level = _leaf_rows(frontier)
        else:
            stats = roots if depth == 0 else level_stats(active)
            level = decide_level(frontier, lambda _: stats, frontier_rows, rule, vocab_size, max_depth, stop_entropy, level=depth)  # noqa: B023
        nodes = write_table(level.coalesce(node_partitions(spark, frontier_rows)), f"nodes{depth}")
        levels.append(nodes)
        # which children stay open is known now, from the split counts
        splits = open_splits(nodes, depth + 1, rule, vocab_size, max_depth, stop_entropy)
        small = frontier_rows <= S.LITERAL_NODES
        if small:
            numbered, step, n_split, routed = _numbered(splits, frontier_rows)
        else:
            numbered = write_table(dense_index(splits, "node", "s", start=0), f"splits{depth}")
            routed_here = F.when(F.col("open_l"), F.col("n1")).otherwise(0) + F.when(F.col("open_r"), F.col("n0")).otherwise(0)
            got = numbered.agg(F.count(F.lit(1)).alias("c"), F.sum(routed_here).alias("r")).first()
            n_split, routed = int(got["c"]), int(got["r"] or 0)
        log.info("level %d: frontier %d, splits %d, %.2fs", depth, frontier_rows, n_split, time.time() - t0)
        if n_split == 0:
            break
        frontier = children(numbered)
        frontier_rows = 2 * n_split
        depth += 1
        closes_only = routed == 0
        if closes_only:
            continue  # every child closes at once: no rows to move
        if small:
            active = active.withColumn("at", S.under_way(S.advance(F.col("at"), F.col("terms"), step, "int")))
        else:
            left = F.when(F.col("open_l"), 2 * F.col("s")).otherwise(S.GONE).alias("with_term")
            right = F.when(F.col("open_r"), 2 * F.col("s") + 1).otherwise(S.GONE).alias("without")
            active = S.advance_by_join(active, numbered.select("node", "term", left, right))
        chained += 1
        if not small or chained >= CHAIN_STEPS or routed < COMPACT_SHARE * rows_held:
            old, held = held, []
            active = write_table(active.filter(F.size("at") > 0).select("doc_id", "terms", "at"), f"state{depth}", held)
            drop_scratch(spark, old)
            rows_held, chained = min(rows_held, routed), 0
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out, total


def _numbered(splits: DataFrame, frontier_rows: int) -> tuple[DataFrame, S.Step, int, int]:
    """The splits with their numbers ``s`` in the order of their nodes, the step they make, their count
    and how many (row, tree) pairs go on: one small collect of numbers."""
    got = splits.select("node", "term", "open_l", "open_r", "n1", "n0").collect()
    step = S.Step([None] * frontier_rows, [S.GONE] * frontier_rows, [S.GONE] * frontier_rows)
    at, routed = [None] * frontier_rows, 0
    for s, r in enumerate(sorted(got, key=lambda r: r.node)):
        at[r.node], step.terms[r.node] = s, r.term
        step.with_term[r.node] = 2 * s if r.open_l else S.GONE
        step.without[r.node] = 2 * s + 1 if r.open_r else S.GONE
        routed += (r.n1 if r.open_l else 0) + (r.n0 if r.open_r else 0)
    numbered = splits.withColumn("s", F.get(S.lit_array(at, "bigint"), F.col("node").cast("int")))
    return numbered, step, len(got), routed


def open_splits(nodes: DataFrame, child: int, rule: str, vocab_size: int, max_depth: int, stop_entropy: float) -> DataFrame:
    """The split nodes of a level with their children's counts and whether each child stays open."""
    sides = nodes.filter(~F.col("is_leaf")).select(
        *_NODE, "term", "n", "k", "n1", "k1", "path_terms",
        (F.col("n") - F.col("n1")).alias("n0"), (F.col("k") - F.col("k1")).alias("k0"),
    )
    stays = [(~closes(n, k, F.lit(child), rule, vocab_size, max_depth, stop_entropy)).alias(o)
             for n, k, o in (("n1", "k1", "open_l"), ("n0", "k0", "open_r"))]
    return sides.select("*", *stays)


def tree_rules(nodes: DataFrame) -> DataFrame:
    """Pre-order text rendering, one line per node, indent ``'| '`` per level."""
    text = F.coalesce(F.col("term"), F.col("label"))
    return nodes.select("tree", "node", F.concat(F.repeat(F.lit("| "), F.col("depth")), text).alias("line"))
