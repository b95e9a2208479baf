"""Scores, leaf labels, stops, vote resolution and accuracy on hand cases."""

import math

from pyspark.sql import functions as F

from sylvan.functions import entropy as E


def _val(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_entropy_and_majority(spark):
    assert _val(spark, E.binary_entropy(F.lit(0), F.lit(10))) == 0.0
    assert abs(_val(spark, E.binary_entropy(F.lit(5), F.lit(10))) - 1.0) < 1e-12
    assert _val(spark, E.binary_entropy(F.lit(0), F.lit(0))) == 0.0
    # k = n/2 -> Other; k > n/2 -> the category
    assert _val(spark, E.majority_label(F.lit(10), F.lit(5), F.lit("A"))) == "Other"
    assert _val(spark, E.majority_label(F.lit(10), F.lit(6), F.lit("A"))) == "A"
    # entropy just below / above the 0.2 stop (k/n = 1/36 -> 0.183, 1/30 -> 0.211)
    assert _val(spark, E.is_pure_enough(F.lit(1), F.lit(36)))
    assert not _val(spark, E.is_pure_enough(F.lit(1), F.lit(30)))


def test_gain_ratio_matches_textbook_formula(spark):
    def textbook(n, k, n1, k1):
        def h(r):
            return -r * math.log2(r) if r > 0 else 0.0

        def ent(k, n):
            return h(k / n) + h((n - k) / n)

        n0, k0 = n - n1, k - k1
        info = n1 / n * ent(k1, n1) + n0 / n * ent(k0, n0)
        return (ent(k, n) - info) / (h(n1 / n) + h(n0 / n))

    cases = [(100, 30, 40, 25), (50, 10, 10, 10), (9, 4, 3, 0), (1000, 1, 999, 1)]
    for n, k, n1, k1 in cases:
        got = _val(spark, E.gain_ratio(F.lit(n), F.lit(k), F.lit(n1), F.lit(k1)))
        assert abs(got - textbook(n, k, n1, k1)) < 1e-12
    assert _val(spark, E.gain_ratio(F.lit(10), F.lit(3), F.lit(0), F.lit(0))) is None
    assert _val(spark, E.gain_ratio(F.lit(10), F.lit(3), F.lit(10), F.lit(3))) is None


def test_mr_rule_sides(spark):
    def mr(n, k, n1, k1):
        return _val(spark, E.score_mr(F.lit(n), F.lit(k), F.lit(n1), F.lit(k1)))

    h = _val(spark, E.binary_entropy(F.lit(3), F.lit(10)))
    assert abs(mr(10, 3, 0, 0) - h) < 1e-12  # word absent in the node: only side 0 -> H(k, n)
    assert abs(mr(10, 3, 10, 3) - h) < 1e-12  # word present in every row: only side 1
    # word only in category rows: side 1 has no Other row -> only side 0 scores
    only0 = 7 / 10 * _val(spark, E.binary_entropy(F.lit(1), F.lit(7)))
    assert abs(mr(10, 3, 3, 2) - only0) > 0  # two-sided sanity
    assert abs(mr(10, 3, 2, 2) - 8 / 10 * _val(spark, E.binary_entropy(F.lit(1), F.lit(8)))) < 1e-12
    # word only in Other rows: both sides have Other rows -> the gain ratio
    assert abs(mr(10, 3, 4, 0) - _val(spark, E.gain_ratio(F.lit(10), F.lit(3), F.lit(4), F.lit(0)))) < 1e-12
    assert only0 > 0


def test_tie_goes_to_smaller_word(spark):
    from sylvan.operators.splits import best_splits

    cands = spark.createDataFrame(
        [("A", "", "zeta", 5, 5, 10, 5, 0.5, 0), ("A", "", "alpha", 5, 5, 10, 5, 0.5, 0)],
        "tree string, node string, term string, n1 long, k1 long, n long, k long, score double, pseudo int",
    )
    assert best_splits(cands).first().term == "alpha"


def test_votes(spark):
    from sylvan.operators.score import accuracy, forest_vote

    sizes = spark.createDataFrame([("A", 10), ("B", 10), ("C", 3), ("D", 0)], "label string, n_train long")
    preds = spark.createDataFrame(
        [
            # doc 1: no tree claims -> largest class overall, tie A/B -> A
            (1, "A", "Other"), (1, "B", "Other"), (1, "C", "Other"), (1, "D", "Other"),
            # doc 2: one claim -> it, even if small
            (2, "A", "Other"), (2, "B", "Other"), (2, "C", "C"), (2, "D", "Other"),
            # doc 3: several claims -> the largest claimant
            (3, "A", "Other"), (3, "B", "B"), (3, "C", "C"), (3, "D", "Other"),
            # doc 4: claim by an empty class against a bigger one
            (4, "A", "Other"), (4, "B", "Other"), (4, "C", "C"), (4, "D", "D"),
        ],
        "doc_id long, tree string, pred string",
    )
    voted = {r.doc_id: r.pred for r in forest_vote(preds, sizes).collect()}
    assert voted == {1: "A", 2: "C", 3: "B", 4: "C"}
    truth = spark.createDataFrame([(1, "A"), (2, "C"), (3, "B"), (4, "C")], "doc_id long, label string")
    with_truth = lambda t: forest_vote(preds.join(t, "doc_id"), sizes, keep=["label"])
    acc = accuracy(with_truth(truth)).first()
    assert (acc.n_test, acc.n_correct, acc.accuracy) == (4, 4, 1.0)
    wrong = spark.createDataFrame([(1, "B"), (2, "A")], "doc_id long, label string")
    assert accuracy(with_truth(wrong)).first().accuracy == 0.0
