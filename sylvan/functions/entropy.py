"""Entropy, gain ratio and the two split-scoring rules as Column expressions.

Notation for a node with ``n`` rows, ``k`` of the tree's category; a term present in
``n1`` rows (``k1`` of the category); ``n0 = n - n1``, ``k0 = k - k1``.
All divisions are guarded (ANSI mode raises on ``x / 0``).
"""

from __future__ import annotations

import functools
import weakref

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from sylvan.functions.text import OTHER, STOP_ENTROPY

# Scores are ranked on this many digits so that Spark and SQL engines tie alike.
RANK_DIGITS = 12
# Scores are reported with this many digits.
OUT_DIGITS = 6


# per Spark context, dropped with it
_CACHE: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _cached(fn):
    """Reuse a built expression when every argument is a column name or a constant.

    The score expressions take hundreds of JVM calls to build; as unresolved
    expressions over column names they can be shared by every level's plan.
    """

    @functools.wraps(fn)
    def wrapper(*args):
        context = SparkContext._active_spark_context
        if context is None or not all(isinstance(a, (str, int, float)) for a in args):
            return fn(*args)
        built = _CACHE.setdefault(context, {})
        key = (fn.__name__, args)
        if key not in built:
            built[key] = fn(*args)
        return built[key]

    return wrapper


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def xlog2x(x) -> Column:
    """L(x) = x * log2(x), with L(0) = 0. Entropies in count form use only L."""
    x = _d(x)
    return F.when(x > 0, x * F.log2(x)).otherwise(F.lit(0.0))


def _sum_l(*terms) -> Column:
    """Sum of signed L(.) terms: each item is (sign, column)."""
    out = None
    for sign, c in terms:
        part = xlog2x(c) if sign > 0 else -xlog2x(c)
        out = part if out is None else out + part
    return out


def info_side(nv, kv, n) -> Column:
    """Weighted entropy of one side, nv/n * H(kv, nv) = (L(nv) - L(kv) - L(nv-kv)) / n."""
    nv, kv, n = _d(nv), _d(kv), _d(n)
    num = _sum_l((1, nv), (-1, kv), (-1, nv - kv))
    return F.when(n != 0, num / n).otherwise(F.lit(0.0))


@_cached
def binary_entropy(k, n) -> Column:
    """M1-M3: entropy of a node with k category rows out of n (0 for n = 0), in count form."""
    return info_side(n, k, n)


@_cached
def gain_ratio(n, k, n1, k1) -> Column:
    """M4: C4.5 gain ratio of a binary term split (NULL when one side is empty).

    (H(k,n) - info) / splitInfo with every entropy in count form:
    numerator   L(n) - L(k) - L(n-k) - [L(n1) - L(k1) - L(n1-k1)] - [L(n0) - L(k0) - L(n0-k0)]
    denominator L(n) - L(n1) - L(n0)        (the common factor 1/n cancels)
    """
    n, k, n1, k1 = _d(n), _d(k), _d(n1), _d(k1)
    n0, k0 = n - n1, k - k1
    num = _sum_l((1, n), (-1, k), (-1, n - k), (-1, n1), (1, k1), (1, n1 - k1), (-1, n0), (1, k0), (1, n0 - k0))
    den = _sum_l((1, n), (-1, n1), (-1, n0))
    return F.when((n1 > 0) & (n0 > 0) & (den > 0), num / den)


@_cached
def score_c45(n, k, n1, k1) -> Column:
    """Textbook rule: candidate iff both sides non-empty; the score is the gain ratio."""
    return gain_ratio(n, k, n1, k1)


@_cached
def score_mr(n, k, n1, k1) -> Column:
    """The map-reduce rule.

    A side v in {0,1} only has a statistics row when it holds at least one row of
    another class (n_v - k_v > 0). Both sides present -> gain ratio; exactly one ->
    that side's info n_v/n * H(k_v, n_v), compared as if it were a gain ratio;
    none -> not a candidate (NULL).
    """
    n, k, n1, k1 = _d(n), _d(k), _d(n1), _d(k1)
    n0, k0 = n - n1, k - k1
    has1 = (n1 - k1) > 0
    has0 = (n0 - k0) > 0
    return (
        F.when(has1 & has0, gain_ratio(n, k, n1, k1))
        .when(has1, info_side(n1, k1, n))
        .when(has0, info_side(n0, k0, n))
    )


@_cached
def mr_has_both_sides(n, k, n1, k1) -> Column:
    n, k, n1, k1 = _d(n), _d(k), _d(n1), _d(k1)
    return ((n1 - k1) > 0) & ((n - n1 - (k - k1)) > 0)


def majority_label(n, k, tree) -> Column:
    """M5: the tree's category iff k > n/2, else 'Other' (a tie gives 'Other')."""
    return F.when(_d(k) * 2 > _d(n), tree if isinstance(tree, Column) else F.col(tree)).otherwise(F.lit(OTHER))


@_cached
def is_pure_enough(k, n, threshold: float = STOP_ENTROPY) -> Column:
    """T4 entropy part: stop when H(k, n) <= threshold."""
    return binary_entropy(k, n) <= threshold


def rank_score(score: Column) -> Column:
    return F.round(score, RANK_DIGITS)


def out_score(score: Column) -> Column:
    return F.round(score, OUT_DIGITS)
