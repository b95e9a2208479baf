"""Physical-plan properties the design relies on at scale (read from ``explain``)."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_auto_broadcast(spark):
    old_b = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_a = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_b)
    spark.conf.set("spark.sql.adaptive.enabled", old_a)


@pytest.fixture()
def rows(spark):
    """Rows with numbered terms, labels and the state at the roots of two trees; the step of level 0."""
    from sylvan.operators import state as S
    from sylvan.session import write_table

    label = F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("label")
    terms = F.when(F.col("id") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))).alias("terms")
    made = write_table(spark.range(200).select(F.col("id").alias("doc_id"), label, terms), "t_rows")
    at = made.withColumn("at", S.start(["a", "b"], F.col("label")))
    return at, S.Step([0, 0], [0, 2], [1, S.GONE])


def test_level_statistics_shuffle_numbers_once(spark, no_auto_broadcast, rows):
    from sylvan.operators.splits import level_stats

    at, _ = rows
    stats = level_stats(at)
    plan = _plan(stats)
    assert plan.count("Generate explode(terms") == 1 and plan.count("Generate") == 2  # words once, then the row's own codes
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
    assert dict(stats.dtypes) == {"node": "bigint", "term": "int", "n1": "bigint", "k1": "bigint"}
    got = {(r.node, r.term): (r.n1, r.k1) for r in stats.collect()}
    assert got == {(0, 0): (100, 34), (0, 1): (200, 67), (1, 0): (100, 66), (1, 1): (200, 133)}


def test_steps_are_expressions(spark, no_auto_broadcast, rows):
    from sylvan.operators import state as S

    at, step = rows
    moved = at
    for _ in range(3):
        moved = moved.withColumn("at", S.under_way(S.advance(F.col("at"), F.col("terms"), step, "int")))
    plan = _plan(moved)
    assert "Join" not in plan and "Exchange" not in plan and "Generate" not in plan and plan.count("Project") == 1
    once = at.withColumn("at", S.under_way(S.advance(F.col("at"), F.col("terms"), step, "int"))).collect()
    for r in once:
        y = [int(r.label == "a"), int(r.label == "b")]
        want = [0 + y[0], 4 + y[1]] if 0 in r.terms else [2 + y[0]]
        assert r.at == want
    table = spark.createDataFrame([(0, 0, 0, 1), (1, 0, 2, -1)], "node long, term int, with_term long, without long")
    by_join = S.advance_by_join(at, table)
    assert {r.doc_id: sorted(r.at) for r in by_join.collect()} == {r.doc_id: r.at for r in once}


def test_one_explode_for_a_level_of_the_mr_rule(spark, no_auto_broadcast, rows):
    from sylvan.operators.splits import best_splits, level_stats, scored_candidates, with_absent_terms

    one = F.lit(1).cast("bigint")
    opened = spark.createDataFrame([(0,), (1,)], "node long").select("node", one.alias("n"), one.alias("k"), F.array(F.lit(1)).alias("path_terms"))
    best = best_splits(scored_candidates(level_stats(rows[0]), opened, "mr", ["node"]), ["node"])
    plan = _plan(with_absent_terms(opened.join(F.broadcast(best), "node", "left"), 5))
    assert plan.count("Generate explode(terms") == 1


def test_root_statistics_hold_no_row_per_tree(spark, no_auto_broadcast, rows):
    from sylvan.operators.splits import root_stats

    plan = _plan(root_stats(rows[0], ["a", "b"]))
    # from the bottom: words, the two aggregates, then the trees
    assert plan.index("Generate explode([a,b])") < plan.index("HashAggregate") < plan.rindex("Generate explode(terms")


def test_the_walk_has_one_row_per_document(spark, no_auto_broadcast):
    from sylvan.operators.score import tree_predict

    nodes = spark.createDataFrame(
        [("a", "", 0, "w", False, None), ("a", "L", 1, None, True, "a"), ("a", "R", 1, "v", False, None),
         ("a", "RL", 2, None, True, "a"), ("a", "RR", 2, None, True, "Other"), ("b", "", 0, None, True, "Other")],
        "tree string, node string, depth int, term string, is_leaf boolean, label string",
    )
    docs = spark.createDataFrame([(1, ["w"]), (2, ["v", "x"]), (3, []), (4, None)], "doc_id long, terms array<string>")
    walked = tree_predict(nodes, docs, ["a", "b", "c"])
    plan = _plan(walked)
    assert "Join" not in plan and "Exchange" not in plan and plan.count("Generate") == 1
    got = sorted(tuple(r) for r in walked.collect())
    assert got == sorted((i, t, "a" if t == "a" and i < 3 else "Other") for i in (1, 2, 3, 4) for t in "abc")


def test_bucketed_tables_join_without_an_exchange(spark, no_auto_broadcast):
    from sylvan.session import drop_scratch, write_bucketed

    a, one = write_bucketed(spark.range(100).toDF("doc_id"), "t_a", buckets=4)
    b, two = write_bucketed(spark.range(50).toDF("doc_id"), "t_b", buckets=4)
    assert "Exchange" not in _plan(a.join(b, "doc_id")) and a.join(b, "doc_id").count() == 50
    drop_scratch(spark, [one, two])


def test_growth_leaves_no_row_tables_behind(spark, monkeypatch):
    import os

    from sylvan.operators import forest as W
    from sylvan.session import checkpoint_dir

    def left():
        at = checkpoint_dir(spark).removeprefix("file:")
        return {x for x in os.listdir(at) if x.split("-")[1] != "forest"} - before

    rows = spark.range(60).select(
        F.col("id").alias("doc_id"), (F.col("id") * 5 % 17 % 3).cast("string").alias("label"),
        F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.concat(F.lit("w"), (F.col("id") * i % 11).cast("string"))).alias("terms"),
    )
    before: set = set()
    before = left()
    nodes = W.grow_forest(spark, rows, rows, ["0", "1", "2"], 11, "c45", 5)
    assert nodes.filter("depth > 1").count() > 0 and not left()
    monkeypatch.setattr(W.S, "advance", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        W.grow_forest(spark, rows, rows, ["0", "1", "2"], 11, "c45", 5)
    assert not left()


def test_cleaning_moves_the_text_once(spark, no_auto_broadcast):
    from sylvan.operators.clean import clean
    from sylvan.sources.tables import labelled_text

    plan = _plan(clean(labelled_text(spark, SF001, "lang"), ["de", "en", "es", "fr"], drop_accented=False))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(row_key" in line]
    assert len(exchanges) == 2  # the rows (with text) and the kept keys, both by row key
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("Sort [row_key") == 2  # + the groups' smallest ids
    assert "partial_min" in plan  # dedupe combines copies map-side


def test_top_k_is_limited_before_the_shuffle(spark, no_auto_broadcast):
    from sylvan.operators.splits import top_splits

    cands = spark.range(1000).select(
        (F.col("id") % 3).cast("string").alias("tree"), (F.col("id") % 2).cast("string").alias("node"),
        F.col("id").cast("string").alias("term"), F.rand(1).alias("score"), F.lit(0).alias("pseudo"),
    )
    plan = _plan(top_splits(cands, 5))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_best_split_aggregates_map_side(spark, no_auto_broadcast):
    from sylvan.operators.splits import best_splits

    cands = spark.range(1000).select(
        (F.col("id") % 3).cast("string").alias("tree"), (F.col("id") % 2).cast("string").alias("node"),
        F.col("id").cast("string").alias("term"),
        F.lit(1).cast("bigint").alias("n1"), F.lit(0).cast("bigint").alias("k1"), F.rand(1).alias("score"),
        F.lit(0).alias("pseudo"),
    )
    plan = _plan(best_splits(cands))
    assert "partial_min" in plan
