"""Forest hand cases on tiny tables: identical-column tie, one attribute left, pure roots."""

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, label string, terms array<string>"


def _grow(spark, rows, labels, rule, depth=5):
    from sylvan.operators.forest import grow_forest

    df = spark.createDataFrame(rows, SCHEMA)
    vocab = sorted({t for _, _, ts in rows for t in ts})
    nodes = grow_forest(spark, df.select("doc_id", "terms"), df.select("doc_id", "label"), labels, len(vocab), rule, depth)
    return {(r.tree, r.node): r for r in nodes.collect()}


def test_identical_columns_tie_to_smaller_word(spark):
    # "beta" and "alpha" appear in exactly the same rows: equal scores, the smaller word wins
    rows = [(i, "A" if i < 6 else "B", (["beta", "alpha"] if i < 5 else []) + (["z"] if i % 2 else [])) for i in range(12)]
    got = _grow(spark, rows, ["A", "B"], "c45")
    assert got[("A", "")].term == "alpha"
    assert got[("B", "")].term == "alpha"


def test_mr_one_attribute_left_stops(spark):
    # vocabulary of two words: the root may split, its children have one attribute left -> leaves
    rows = [(i, "A" if i < 5 else "B", (["x"] if i < 4 or i == 7 else []) + (["y"] if i % 3 == 0 else [])) for i in range(10)]
    got = _grow(spark, rows, ["A", "B"], "mr")
    assert any(r.depth == 1 for r in got.values())  # some root did split
    for (tree, node), r in got.items():
        if r.depth >= 1:
            assert r.is_leaf, (tree, node)


def test_pure_and_empty_classes_give_single_leaves(spark):
    rows = [(i, "A", ["w"] if i % 2 else ["v"]) for i in range(6)]
    got = _grow(spark, rows, ["A", "C"], "c45")
    # class A holds every row: entropy 0 -> leaf "A"; class C has no row -> leaf "Other"
    assert got[("A", "")].is_leaf and got[("A", "")].label == "A"
    assert got[("C", "")].is_leaf and got[("C", "")].label == "Other" and got[("C", "")].k == 0


def test_half_split_node_is_other(spark):
    # k = n/2 at a node that must stop (depth limit 0): majority is a tie -> 'Other'
    rows = [(i, "A" if i < 3 else "B", ["w"]) for i in range(6)]
    got = _grow(spark, rows, ["A"], "c45", depth=0)
    assert got[("A", "")].label == "Other" and got[("A", "")].n == 6 and got[("A", "")].k == 3
