"""Per-node term statistics, the two scoring rules and the best split per node.

One statistics job serves every tree and every open node of a level: the keys
are ``(node, term)`` and partial aggregation combines hot terms map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.functions import entropy as E
from sylvan.operators.features import trees_column

NODE_KEYS = ["tree", "node"]
_TERM_BITS = 31  # of a (node, term) number


def root_stats(terms: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Statistics of all root nodes: ``(tree, node, term, n1, k1)``.

    At the root every tree holds every row, so rows are counted once by (label, term); the
    small result is then spread over the trees.
    """
    counts = terms.select("label", F.explode("terms").alias("term")).groupBy("label", "term").agg(F.count(F.lit(1)).alias("c"))
    return spread_over_trees(counts, labels)


def spread_over_trees(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``(label, term, c)`` to ``(tree, node, term, n1, k1)``: n1 over all labels, k1 of the tree's."""
    per_term = counts.groupBy("term").agg(
        F.sum("c").alias("n1"), F.map_from_entries(F.collect_list(F.struct("label", "c"))).alias("by_label")
    )
    fan = per_term.select("term", "n1", "by_label", trees_column(labels).alias("tree"))
    k1 = F.coalesce(F.try_element_at("by_label", F.col("tree")), F.lit(0)).cast("bigint")
    return fan.select("tree", F.lit("").alias("node"), "term", "n1", k1.alias("k1"))


def level_stats(rows: DataFrame) -> DataFrame:
    """A6 + A7 (+ J1) below the root: ``(node, term, n1, k1)`` of the rows' ``terms`` (numbers) and states ``at``.

    Each row's words are exploded once and meet the row's own codes; what is shuffled, after the
    partial (map-side) phase, is one number per (node, term)."""
    each = rows.select(F.explode("terms").alias("term"), "at").select("term", F.explode("at").alias("code"))
    y = F.col("code").bitwiseAND(F.lit(1).cast("bigint"))
    key = F.shiftleft(F.shiftright("code", 1), _TERM_BITS).bitwiseOR(F.col("term").cast("bigint"))
    sums = each.select(key.alias("key"), y.alias("y")).groupBy("key").agg(F.count(F.lit(1)).alias("n1"), F.sum("y").alias("k1"))
    term = F.col("key").bitwiseAND(F.lit((1 << _TERM_BITS) - 1)).cast("int")
    return sums.select(F.shiftright("key", _TERM_BITS).alias("node"), term.alias("term"), "n1", "k1")


def scored_candidates(stats: DataFrame, open_nodes: DataFrame, rule: str, keys: Sequence[str] = NODE_KEYS) -> DataFrame:
    """Every term with a statistics row, with its ``score`` under ``rule`` ('c45' or 'mr'; NULL:
    no candidate). Columns: keys, term, n1, k1, n, k, score, pseudo (0)."""
    j = stats.join(open_nodes.select(*keys, "n", "k", "path_terms"), list(keys))
    if rule == "c45":
        out = j.withColumn("score", E.score_c45("n", "k", "n1", "k1")).withColumn("pseudo", F.lit(0))
        # the textbook rule needs both sides non-empty and a strictly positive gain ratio
        return out.filter(F.col("score").isNotNull() & (E.rank_score(F.col("score")) > 0)).drop("path_terms")
    if rule != "mr":
        raise ValueError(f"unknown rule {rule!r}")
    # T5: a term used on the path was dropped from the subtree's columns
    j = j.filter(~F.array_contains("path_terms", F.col("term"))).drop("path_terms")
    return j.withColumn("score", E.score_mr("n", "k", "n1", "k1")).withColumn("pseudo", F.lit(0))


def _rank(pseudo: Column, term: Column, n1: Column, k1: Column, score: Column) -> Column:
    """Order: higher score (rounded to ``RANK_DIGITS``) first, then real terms before the
    pseudo-candidate, then the smaller term."""
    return F.struct(
        (-E.rank_score(score)).alias("neg"), pseudo.alias("pseudo"), term.alias("term"),
        n1.alias("n1"), k1.alias("k1"), score.alias("score"),
    )


_SPLIT = ["term", "n1", "k1", "score", "pseudo"]


def best_splits(cands: DataFrame, keys: Sequence[str] = NODE_KEYS) -> DataFrame:
    """The best candidate per node and ``n_present``, its number of statistics rows.

    ``min(struct)`` and a count in one aggregate with a partial (map-side) phase: a hot node
    never sends all its candidates to one task.
    """
    key = _rank(*[F.col(c) for c in ("pseudo", "term", "n1", "k1", "score")])
    best = cands.groupBy(*keys).agg(
        F.min(F.when(F.col("score").isNotNull(), key)).alias("b"), F.count(F.lit(1)).alias("n_present")
    )
    return best.select(*keys, *[F.col(f"b.{c}").alias(c) for c in _SPLIT], "n_present")


def with_absent_terms(nodes: DataFrame, vocab_size: int) -> DataFrame:
    """The mr rule's absent terms, on node rows left-joined with their best split.

    Vocabulary terms in no row of the node have no statistics row; they all score like
    (n1 = 0, k1 = 0), so one pseudo-candidate stands for them where any exists.
    """
    zero = F.lit(0).cast("bigint")
    columns = nodes.withColumn("_zero", zero)
    score = E.score_mr("n", "k", "_zero", "_zero")
    absent = F.lit(vocab_size) - F.size("path_terms") - F.coalesce("n_present", F.lit(0)) > 0
    pseudo = _rank(F.lit(1), F.lit(None).cast(nodes.schema["term"].dataType), zero, zero, score)
    real = _rank(*[F.col(c) for c in ("pseudo", "term", "n1", "k1", "score")])
    best = F.least(F.when(F.col("score").isNotNull(), real), F.when(absent & score.isNotNull(), pseudo))
    kept = [c for c in nodes.columns if c not in _SPLIT]
    return columns.select(*kept, best.alias("_b")).select(*kept, *[F.col(f"_b.{c}").alias(c) for c in _SPLIT])


def top_splits(cands: DataFrame, k: int = 5) -> DataFrame:
    """The k best candidates per node with their rank (inspection view).

    The window is partitioned by node; candidate rows per node are bounded by the
    vocabulary size, and the rank order is the one ``best_splits`` uses.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*NODE_KEYS).orderBy(
        (-E.rank_score(F.col("score"))).asc(), F.col("pseudo").asc(), F.col("term").asc_nulls_last()
    )
    cands = cands.filter(F.col("score").isNotNull())
    return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
