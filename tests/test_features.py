"""Postings, vocabulary cut, training base, split, dense views and dense index."""

import re

import pytest
from pyspark.sql import functions as F

from sylvan.operators import features as X
from sylvan.session import write_table

TOK = "doc_id bigint, label string, tokens array<string>"


def _posts(spark, rows):
    return X.postings(spark.createDataFrame(rows, TOK))


def test_repeated_word_counts_once_and_empty_rows_leave(spark):
    rows = [
        (1, "A", ["x", "x", "y"]),
        (2, "A", ["y"]),
        (3, "B", []),  # no word at all -> not a training row
        (4, "B", ["rare"]),  # only rare words -> stays as an all-zero row
    ]
    p = _posts(spark, rows)
    assert sorted((r.doc_id, r.term) for r in p.collect()) == [(1, "x"), (1, "y"), (2, "y"), (4, "rare")]
    base = X.doc_base(p)
    assert sorted(r.doc_id for r in base.collect()) == [1, 2, 4]
    vocab = X.vocabulary(p, 2)
    assert [(r.term, r.df) for r in vocab.collect()] == [("y", 2)]
    terms = {r.doc_id: r.terms for r in X.doc_terms(p, vocab).collect()}
    assert terms == {1: ["y"], 2: ["y"], 4: []}


def test_min_df_boundary(spark):
    rows = [(i, "A", ["n"] + (["m"] if i < 3 else [])) for i in range(4)]  # n: df 4, m: df 3
    p = _posts(spark, rows)
    assert sorted(r.term for r in X.vocabulary(p, 4).collect()) == ["n"]
    assert sorted(r.term for r in X.vocabulary(p, 3).collect()) == ["m", "n"]


def test_split_is_partition_independent(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    a = {r.doc_id for r in X.with_split(df.repartition(1)).filter("is_train").collect()}
    b = {r.doc_id for r in X.with_split(df.repartition(13)).filter("is_train").collect()}
    assert a == b
    assert 1500 < len(a) < 1700


def test_class_sizes_keep_empty_classes(spark):
    base = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "doc_id bigint, label string")
    got = {r.label: r.n_train for r in X.class_sizes(spark, base, ["A", "B", "C"]).collect()}
    assert got == {"A": 2, "B": 1, "C": 0}


def test_pivot_unpivot_roundtrip(spark):
    p = _posts(spark, [(1, "A", ["x", "y"]), (2, "B", ["y", "z"])])
    wide = X.term_pivot(p, ["x", "y", "w"])
    got = {r.doc_id: (r.x, r.y, r.w) for r in wide.collect()}
    assert got == {1: (1, 1, 0), 2: (0, 1, 0)}
    long = X.term_unpivot(wide, ["x", "y", "w"])
    assert long.count() == 6
    assert long.filter(F.col("value") == 1).count() == 3


def test_dense_index_matches_row_number(spark):
    df = spark.range(0, 5000, 7).withColumnRenamed("id", "doc_id").repartition(5)
    got = X.dense_index(df, "doc_id", "idx", start=1).collect()
    assert sorted((r.doc_id, r.idx) for r in got) == [(d, i + 1) for i, d in enumerate(range(0, 5000, 7))]


def test_dense_index_per_group_with_a_hot_group(spark):
    from pyspark.sql import Window

    # group "g0" holds most rows and spans several range partitions
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 == 0, "g1").otherwise("g0").alias("grp"), (F.col("id") * 7 % 3001).alias("doc_id")
    )
    got = X.dense_index(df, "doc_id", "idx", start=1, partition_col="grp")
    want = df.withColumn("idx", F.row_number().over(Window.partitionBy("grp").orderBy("doc_id")))
    assert sorted(tuple(r) for r in got.select("grp", "doc_id", "idx").collect()) == sorted(
        tuple(r) for r in want.select("grp", "doc_id", "idx").collect()
    )


def test_random_split_is_a_partition_of_the_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    train, test = X.random_split(df)
    a, b = {r.doc_id for r in train.collect()}, {r.doc_id for r in test.collect()}
    assert not (a & b) and len(a | b) == 1000 and 700 < len(a) < 900


def _aggregates(df):
    """The aggregates of the physical plan, the one nearest to the scan last."""
    return re.findall(r"(\w+)Aggregate\(", df._jdf.queryExecution().executedPlan().toString())


def test_base_rows_come_out_of_a_hash_aggregate(spark):
    rows = [(1, "A", "x"), (1, "A", "y"), (2, "B", "x"), (None, "A", "x"), (None, "A", "z"), (3, "A", "x"), (3, "B", "y")]
    posts = write_table(spark.createDataFrame(rows, "doc_id bigint, label string, term string"), "posts")
    base = X.doc_base(posts)
    assert _aggregates(base)[-1] == "Hash"  # the postings are not sorted
    got = {r.doc_id: r.label for r in base.collect()}
    assert base.count() == 4 and got[1] == "A" and got[2] == "B" and got[None] == "A" and got[3] in ("A", "B")


def test_stems_of_rows_with_unique_ids_merge_without_a_sort(spark):
    rows = [(1, "A", ["run", "runs", "running", "the"]), (2, "B", ["runs", "cats", "cat"]), (3, "B", [])]
    toks = write_table(spark.createDataFrame(rows, TOK), "toks")
    got = X.postings(toks, stem=True, stop_words=True, unique_ids=True)
    assert "Sort" not in _aggregates(got) and _aggregates(got)
    want = X.postings(toks, stem=True, stop_words=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) == [(1, "A", "run"), (2, "B", "cat"), (2, "B", "run")]


def _odd_rows(spark):
    made = [(1, "a", ["w", "é", "w", "x"]), (2, "b", ["zz", "the", " "]), (3, "a", []), (4, None, ["x", None, "w"]), (5, "b", None), (6, "b", [" "]), (7, "a", ["the"])]
    return spark.createDataFrame(made, "doc_id long, label string, tokens array<string>")


def test_term_sets_are_made_where_the_rows_are(spark, monkeypatch):
    from sylvan.operators import dictionary as D

    for stop in (False, True):
        rows = _odd_rows(spark)
        posts = X.postings(rows, stop_words=stop)
        vocab = spark.createDataFrame([("x",), ("w",), ("é",), ("the",)], "term string")
        sets = X.doc_terms(posts, vocab, 4, X.rows_with_words(rows, stop))
        plan = sets._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan and "Generate" not in plan
        want = {(r.doc_id, r.label, tuple(r.terms)) for r in X.doc_terms(posts, vocab).collect()}
        if stop:  # a stop word of the vocabulary is no word of these rows
            vocab, want = vocab.filter("term <> 'the'"), {(i, c, tuple(t for t in ts if t != "the")) for i, c, ts in want}
            sets = X.doc_terms(posts, vocab, 3, X.rows_with_words(rows, stop))
        assert {(r.doc_id, r.label, tuple(r.terms)) for r in sets.collect()} == want
        assert (1, "a", ("w", "x", "é")) in want and {i for i, _, _ in want} == ({1, 2, 4} if stop else {1, 2, 4, 7})
    monkeypatch.setattr(D, "MAX_BROADCAST_BYTES", 10)  # above the budget: joined
    joined = X.doc_terms(posts, vocab, 3, X.rows_with_words(rows, True))
    assert {(r.doc_id, r.label, tuple(r.terms)) for r in joined.collect()} == want


def test_rows_are_numbered_without_gathering_them(spark, monkeypatch):
    from sylvan.operators import dictionary as D
    from sylvan.operators import forest as W

    rows = spark.createDataFrame([(1, "a", ["x", "w"]), (2, "b", []), (3, None, ["é"]), (4, "a", None)], "doc_id long, label string, terms array<string>")
    vocab = spark.createDataFrame([("é",), ("x",), ("w",), ("v",)], "term string")
    plans, write = [], W.write_table
    monkeypatch.setattr(W, "write_table", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, *a))
    got, words, n = W.number_terms(rows, None, vocab, 4)
    assert "Join" not in plans[0] and "Exchange" not in plans[0]
    assert n == 4 and {r.term: r.term_id for r in words.collect()} == {"v": 0, "w": 1, "x": 2, "é": 3}
    want = {1: [1, 2], 2: [], 3: [3], 4: []}
    assert {r.doc_id: r.terms for r in got.collect()} == want and got.schema["terms"].dataType.simpleString() == "array<int>"
    monkeypatch.setattr(D, "MAX_BROADCAST_BYTES", 10)
    assert {r.doc_id: r.terms for r in W.number_terms(rows, 3, vocab, 4)[0].collect()} == want


@pytest.mark.parametrize("most", [0, 1, 4, 9, 1000])
def test_stems_of_frequent_and_rare_words(spark, monkeypatch, most):
    """Whichever part of the stem map is broadcast, every word gets its stem once."""
    rows = [(i, "a", ["running", "dogs"] + (["cats"] if i % 2 else []) + (["happy", "runs", ""] if i % 5 == 0 else []) + [f"w{'abcdefgh'[i % 8]}s"]) for i in range(40)]
    toks = spark.createDataFrame(rows, TOK).repartition(3)
    want = sorted(map(tuple, X.postings(toks, stem=True, unique_ids=True).collect()))
    assert {t for _, _, t in want} >= {"run", "dog", "cat", "happi", "wa"}
    monkeypatch.setattr(X, "MAX_BROADCAST_BYTES", most * X.STEM_ROW_BYTES)
    posts = X.postings(toks, stem=True, unique_ids=True)
    assert sorted(map(tuple, posts.collect())) == want
    assert ("LeftAnti" in posts._jdf.queryExecution().toString()) == (most in (4, 9))
