"""Scoring: walk every tree for every row, resolve the votes, measure accuracy.

The walk is an expression over the row's state array, level by level against constant
arrays of the nodes: no join, one row per document throughout. Forests above the budget walk by a
chain of joins, one per tree level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.functions.text import OTHER
from sylvan.operators import state as S
from sylvan.operators.features import maybe_broadcast, trees_column


def tree_predict(
    nodes: DataFrame, docs: DataFrame, labels: Sequence[str], terms_col: str = "terms", keep: Sequence[str] = ()
) -> DataFrame:
    """E1 for all trees: ``(doc_id, *keep, tree, pred)``.

    ``docs`` has ``doc_id`` and a term array (test rows are not cut to the vocabulary;
    membership is all the walk asks). A row that meets a leaf takes its label along.
    """
    counts = {r["depth"]: r["c"] for r in nodes.groupBy("depth").agg(F.count(F.lit(1)).alias("c")).collect()}  # one row per level
    if sum(counts.values()) > S.LITERAL_NODES:
        return predict_by_joins(nodes, docs, labels, counts, terms_col, keep)
    steps, _, names = level_steps(nodes, labels)
    at = walk(S.start(labels), F.coalesce(F.col(terms_col), F.array().cast("array<string>")), steps)
    rows = docs.select("doc_id", *keep, F.posexplode(at).alias("_tree", "_code"))
    # a code that is not final: a node that the table lacks
    pred = F.get(S.lit_array(names, "string"), (-1 - F.col("_code")).cast("int"))
    tree = F.get(S.lit_array(labels, "string"), F.col("_tree"))
    return rows.select("doc_id", *keep, tree.alias("tree"), F.coalesce(pred, F.lit(OTHER)).alias("pred"))


def level_steps(nodes: DataFrame, labels: Sequence[str], upto: int | None = None) -> tuple[list[S.Step], list[list[tuple[str, str]]], list[str]]:
    """A forest of at most ``LITERAL_NODES`` nodes as steps, the (tree, path) of each level's numbers, and
    the leaf labels: label i has the final code ``-1 - i``."""
    got = nodes.select("tree", "node", "depth", "term", "is_leaf", "label").collect()
    names = sorted({r.label for r in got if r.is_leaf and r.label is not None} | {OTHER})
    code = {x: -1 - i for i, x in enumerate(names)}
    by_depth: dict[int, dict] = {}
    for r in got:
        by_depth.setdefault(r.depth, {})[r.tree, r.node] = r
    place = [[(t, "") for t in labels]]  # the roots, one per tree
    steps = []
    for d in range(len(by_depth) if upto is None else upto):
        here, nxt = by_depth.get(d, {}), []
        step = S.Step()
        for tree, path in place[-1]:
            r = here.get((tree, path))
            if r is None or r.is_leaf:
                final = code[r.label if r is not None and r.label is not None else OTHER]
                to = (final, final)
            else:
                to = (len(nxt), len(nxt) + 1)
                nxt += [(tree, path + "L"), (tree, path + "R")]
            step.terms.append(None if r is None else r.term)
            step.with_term.append(to[0])
            step.without.append(to[1])
        steps.append(step)
        place.append(nxt)
    return steps, place, names


def walk(at, terms, steps: Sequence[S.Step], element: str = "string"):
    """The state after the steps."""
    for step in steps:
        at = S.advance(at, terms, step, element)
    return at


def route(nodes: DataFrame, rows: DataFrame, labels: Sequence[str], levels: int) -> DataFrame:
    """``doc_id, tree, node``: where the rows of inner nodes sit after ``levels`` levels (rows that ended
    in a leaf before are left out)."""
    steps, place, _ = level_steps(nodes, labels, levels)
    at = walk(S.start(labels), F.col("terms"), steps)
    here = rows.select("doc_id", F.explode(S.under_way(at)).alias("_code"))
    number = F.shiftright("_code", 1).cast("int")
    name = lambda k: F.get(S.lit_array([p[k] for p in place[-1]], "string"), number)
    return here.select("doc_id", name(0).alias("tree"), name(1).alias("node"))


def predict_by_joins(
    nodes: DataFrame, docs: DataFrame, labels: Sequence[str], counts: dict[int, int], terms_col: str, keep: Sequence[str]
) -> DataFrame:
    """``tree_predict`` for forests of any size: step d joins the nodes of depth d only."""
    nodes = nodes.select("tree", "node", "depth", "term", "is_leaf", F.col("label").alias("_leaf"))
    state = docs.select(
        "doc_id",
        *keep,
        F.coalesce(F.col(terms_col), F.array().cast("array<string>")).alias("_terms"),
        trees_column(labels).alias("tree"),
        F.lit("").alias("node"),
        F.lit(None).cast("string").alias("pred"),
    )
    for d in sorted(counts):
        table = maybe_broadcast(nodes.filter(F.col("depth") == d).drop("depth"), counts[d], 96 + d)
        j = state.join(table, ["tree", "node"], "left")
        side = F.when(F.array_contains("_terms", F.col("term")), F.lit("L")).otherwise(F.lit("R"))
        state = j.select(
            "doc_id",
            *keep,
            "_terms",
            "tree",
            F.when(F.col("is_leaf") | F.col("is_leaf").isNull(), F.col("node")).otherwise(F.concat("node", side)).alias("node"),
            F.coalesce("pred", F.when(F.col("is_leaf"), F.col("_leaf"))).alias("pred"),
        )
    return state.select("doc_id", *keep, "tree", F.coalesce("pred", F.lit(OTHER)).alias("pred"))


def forest_vote(preds: DataFrame, sizes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One label per row (``doc_id, *keep, pred``).

    No tree claims its class -> the largest class overall; one -> it; several ->
    the largest class among the claimants. Size ties -> the smaller label.
    ``sizes`` (label, n_train) has one row per tree.
    """
    s = maybe_broadcast(sizes.select(F.col("label").alias("tree"), "n_train"), sizes.count())
    j = preds.join(s, "tree")
    key = F.struct((-F.col("n_train")).alias("neg"), F.col("tree").alias("label"))
    agg = j.groupBy("doc_id", *keep).agg(
        F.min(F.when(F.col("pred") != F.lit(OTHER), key)).alias("v"), F.min(key).alias("g")
    )
    return agg.select("doc_id", *keep, F.coalesce(F.col("v.label"), F.col("g.label")).alias("pred"))


def accuracy(voted: DataFrame) -> DataFrame:
    """``n_test, n_correct, accuracy`` of ``(label, pred)`` rows as a one-row DataFrame."""
    hit = F.when(F.col("pred") == F.col("label"), 1).otherwise(0)
    return voted.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.sum(hit).cast("bigint").alias("n_correct"),
        F.round(F.avg(hit.cast("double")), 6).alias("accuracy"),
    )
