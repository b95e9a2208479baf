"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables in full (no id subsets, no row caps). Integer
outputs are ``bigint``, scores are rounded to 6 digits, arrays are rendered as
space-joined strings, so the DuckDB twins in ``sql_queries`` compare value for value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.functions import entropy as E
from sylvan.functions import text as T
from sylvan.operators import clean as C
from sylvan.operators import dictionary as D
from sylvan.operators import features as X
from sylvan.operators import matrix as M
from sylvan.operators import splits as S
from sylvan.operators.forest import tree_rules as render_rules
from sylvan.operators.score import route
from sylvan.plans import pipeline as P
from sylvan.sources import files as IO
from sylvan.session import write_table
from sylvan.sources.tables import PROFILES, labelled_text, read_table

LANG = "lang"
MIN_DF = 50


def _big(c: str) -> Column:
    return F.col(c).cast("bigint").alias(c)


def _filtered(spark: SparkSession, sf: str, profile: str = LANG) -> DataFrame:
    return C.filter_labels(labelled_text(spark, sf, profile), PROFILES[profile].labels)


def _cleaned(spark: SparkSession, sf: str, profile: str = LANG, stop_words: bool = False) -> DataFrame:
    return P.cleaned_tokens(spark, sf, profile, stop_words=stop_words)


def _split_tokens(spark, sf, profile=LANG):
    return X.with_split(_cleaned(spark, sf, profile))


def _train_postings(spark, sf, profile=LANG):
    return X.postings(X.train_part(_cleaned(spark, sf, profile)))


# ---- cleaning --------------------------------------------------------------------------


def clean_topic_filter(spark, sf):
    return _filtered(spark, sf).select("doc_id", "label")


def clean_no_alpha(spark, sf):
    return _filtered(spark, sf).filter(T.no_letter(F.col("text"))).select("doc_id", "label")


def clean_topic_subset(spark, sf):
    """F1 with a strict subset of the labels: the other rows go."""
    return C.filter_labels(labelled_text(spark, sf, LANG), ["en", "fr"]).select("doc_id", "label")


def _some_without_letters(spark, sf):
    """The labelled rows, those of label ``es`` with their ASCII letters taken out: rows for F2 to catch."""
    bare = F.when(F.col("label") == "es", F.regexp_replace("text", "[a-zA-Z]", "")).otherwise(F.col("text"))
    return _filtered(spark, sf).withColumn("text", bare)


def clean_no_alpha_caught(spark, sf):
    return _some_without_letters(spark, sf).filter(T.no_letter(F.col("text"))).select("doc_id", "label")


def clean_rejects_caught(spark, sf):
    """S1 with both halves at work (a row in both is listed twice, as by the union)."""
    return C.reject_sets(_some_without_letters(spark, sf), drop_accented=True).select("doc_id", "label")


def clean_accented(spark, sf):
    return _filtered(spark, sf).filter(T.has_accent(F.col("text"))).select("doc_id", "label")


def clean_rejects(spark, sf):
    return C.reject_sets(_filtered(spark, sf), drop_accented=True).select("doc_id", "label")


def clean_except(spark, sf):
    # the literal reference order with the accent filter on: filter, reject, EXCEPT DISTINCT
    return C.clean(labelled_text(spark, sf, LANG), PROFILES[LANG].labels, drop_accented=True).select("doc_id", "label")


def clean_row_identity(spark, sf):
    """S2 + X1 on ids that are null (every seventh) or shared by two documents: one row per (text,
    label), each with a key of its own and in exactly one part."""
    raw = labelled_text(spark, sf, LANG)
    shared = F.when(F.col("doc_id") % 7 == 3, F.lit(None)).otherwise(F.floor(F.col("doc_id") / 2)).cast("bigint")
    c = C.clean(raw.withColumn("doc_id", shared), PROFILES[LANG].labels, drop_accented=False, with_key=True)
    named = X.with_split(c.withColumn("own_id", F.col("doc_id")).transform(C.named_by_key))
    return named.select("own_id", "label", F.md5("text").alias("text_md5"), F.col("doc_id").alias("row_key"), "is_train")


def clean_text(spark, sf):
    c = C.clean(labelled_text(spark, sf, LANG), PROFILES[LANG].labels, drop_accented=False)
    return c.select("doc_id", "label", T.clean_text(F.col("text")).alias("clean_text"))


def tokenize(spark, sf):
    t = _cleaned(spark, sf)
    return t.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


def remove_stop_words(spark, sf):
    t = _cleaned(spark, sf).withColumn("tokens", T.remove_stop_words(F.col("tokens")))
    return t.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


def token_stages(spark, sf):
    t = _cleaned(spark, sf, stop_words=True)
    return t.select("doc_id", "label", F.array_join("tokens", " ").alias("tokens"))


def _stemmed_tokens(spark, sf, stop_before_stem):
    t = P.cleaned_tokens(spark, sf, LANG, stop_words=True, stem=True, stop_before_stem=stop_before_stem)
    return t.select("doc_id", "label", F.array_join("tokens", " ").alias("tokens"))


def token_stages_stemmed(spark, sf):
    """T1f: stemmed tokens in order, stop words dropped after stemming."""
    return _stemmed_tokens(spark, sf, stop_before_stem=False)


def token_stages_stop_first(spark, sf):
    """T1f with stop words dropped before stemming."""
    return _stemmed_tokens(spark, sf, stop_before_stem=True)


# ---- split, postings, vocabulary ---------------------------------------------------------


def train_test_split(spark, sf):
    return _split_tokens(spark, sf).select("doc_id", "is_train")


def doc_index(spark, sf):
    rows = _cleaned(spark, sf).select("doc_id", "label", F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))
    return X.dense_index(rows, "doc_id", "idx", start=1)


def label_index(spark, sf):
    labels = _cleaned(spark, sf).select("label").distinct()
    return X.dense_index(labels, "label", "label_index", start=0)


def postings(spark, sf):
    return _train_postings(spark, sf).select("doc_id", "label", "term")


def vocabulary(spark, sf):
    return X.vocabulary(_train_postings(spark, sf), MIN_DF).select("term", _big("df"))


def postings_in_vocab(spark, sf):
    p = write_table(_train_postings(spark, sf), "postings")
    return X.postings_in_vocab(p, X.vocabulary(p, MIN_DF)).select("doc_id", "term")


def doc_terms(spark, sf):
    """The whole sentence x word matrix in sparse form: every row with its vocabulary words."""
    p = write_table(_train_postings(spark, sf), "postings")
    t = X.doc_terms(p, X.vocabulary(p, MIN_DF))
    return t.select("doc_id", "label", F.array_join("terms", " ").alias("terms"))


def class_sizes(spark, sf):
    base = X.doc_base(_train_postings(spark, sf))
    return X.class_sizes(spark, base, sorted(PROFILES[LANG].labels))


def one_vs_rest(spark, sf):
    base = X.doc_base(_train_postings(spark, sf))
    return X.one_vs_rest(base, sorted(PROFILES[LANG].labels))


def matrix_summary(spark, sf):
    p = write_table(_train_postings(spark, sf), "postings")
    v = X.vocabulary(p, MIN_DF)
    base = X.doc_base(p).agg(F.count(F.lit(1)).alias("n_docs"))
    terms = v.agg(F.count(F.lit(1)).alias("n_terms"))
    cells = X.postings_in_vocab(p, v).agg(F.count(F.lit(1)).alias("n_postings"))
    # three one-row aggregates side by side as scalar subqueries
    return base.select(
        _big("n_docs"), terms.scalar().cast("bigint").alias("n_terms"), cells.scalar().cast("bigint").alias("n_postings")
    )


def _matrix(spark, sf):
    p = write_table(_train_postings(spark, sf), "postings")
    return M.blocked_matrix(p, write_table(X.vocabulary(p, MIN_DF), "vocabulary"))


def term_pivot(spark, sf):
    """A2 + P7: the whole dense matrix, one row per document and block of words."""
    blocks = M.dense_blocks(_matrix(spark, sf), text=True)
    return blocks.select("doc_id", "label", _big("block"), "vals")


def term_unpivot(spark, sf):
    """Documents x vocabulary, zeros included."""
    m = _matrix(spark, sf)
    return M.unpivot(M.dense_blocks(m, by_block=True), m).select("doc_id", "label", "term", _big("value"))


def label_codes(spark, sf):
    """K1 on rows, in both directions: each row's label coded by the label dictionary, and decoded."""
    rows = write_table(_cleaned(spark, sf).select("doc_id", "label"), "labelled")
    names = D.dictionary(rows, "label", "label_index")
    coded = D.encode(rows, names, "label", "label_index")
    back = D.decode(coded.select("doc_id", "label_index"), names, "label_index", "label")
    return back.select("doc_id", "label_index", F.col("label").alias("decoded_label"))


# ---- root statistics and scores ------------------------------------------------------------


def _root(spark, sf):
    """Root node of every tree: ``(tree, n, k)`` and the term statistics at the root.

    The training postings feed several branches of this plan, so they are written once
    (shared checkpoint folder) instead of re-running the regex cleaning per branch.
    Returns ``(root, stats)``; ``stats`` has ``tree, term, n1, k1, n, k``.
    """
    p = write_table(_train_postings(spark, sf), "root_postings")
    v = X.vocabulary(p, MIN_DF)
    labels = sorted(PROFILES[LANG].labels)
    base = X.doc_base(p)
    sizes = X.class_sizes(spark, base, labels)
    n_all = base.agg(F.count(F.lit(1))).scalar()
    root = sizes.select(F.col("label").alias("tree"), n_all.cast("bigint").alias("n"), F.col("n_train").alias("k"))
    piv = X.postings_in_vocab(p, v)
    counts = piv.groupBy("label", "term").agg(F.count(F.lit(1)).alias("c"))
    stats = S.spread_over_trees(counts, labels).drop("node")
    return root, stats.join(X.maybe_broadcast(root, len(labels)), "tree")


def entropy(spark, sf):
    root, _ = _root(spark, sf)
    return root.select("tree", "n", "k", E.out_score(E.binary_entropy("k", "n")).alias("entropy"))


def leaf_label(spark, sf):
    root, _ = _root(spark, sf)
    return root.select("tree", "n", "k", E.majority_label("n", "k", F.col("tree")).alias("label"))


def split_stats(spark, sf):
    _, st = _root(spark, sf)
    return st.select("tree", "term", "n", "k", "n1", "k1")


def gain_ratio(spark, sf):
    _, st = _root(spark, sf)
    return st.select(
        "tree",
        "term",
        E.out_score(E.score_c45("n", "k", "n1", "k1")).alias("score_c45"),
        E.out_score(E.score_mr("n", "k", "n1", "k1")).alias("score_mr"),
    )


def _root_cands(spark, sf):
    root, st = _root(spark, sf)
    nodes = root.select("tree", F.lit("").alias("node"), "n", "k", F.array().cast("array<string>").alias("path_terms"))
    nodes = X.maybe_broadcast(nodes, len(PROFILES[LANG].labels))
    return S.scored_candidates(st.select("tree", F.lit("").alias("node"), "term", "n1", "k1"), nodes, "c45")


def best_split(spark, sf):
    b = S.best_splits(_root_cands(spark, sf))
    return b.select("tree", "term", E.out_score(F.col("score")).alias("score"))


def top_splits(spark, sf):
    t = S.top_splits(_root_cands(spark, sf), 5)
    return t.select("tree", F.col("rank").cast("bigint").alias("rank"), "term", E.out_score(F.col("score")).alias("score"))


# ---- forests -----------------------------------------------------------------------------


def _nodes_out(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        "tree", "node", _big("depth"), "term", E.out_score(F.col("score")).alias("score"), _big("n"), _big("k"), "is_leaf", "label"
    )


def _forest(spark, sf, rule, depth, profile=LANG, min_df=MIN_DF, trees=None, stem=False, stop_words=False):
    feats = P.prepare(spark, sf, profile, min_df, stem=stem, stop_words=stop_words)
    return feats, P.train(spark, feats, rule=rule, max_depth=depth, trees=trees)


def forest_c45_depth2(spark, sf):
    return _nodes_out(_forest(spark, sf, "c45", 2)[1])


def forest_mr_depth3(spark, sf):
    return _nodes_out(_forest(spark, sf, "mr", 3)[1])


def tree_c45_depth3(spark, sf):
    return _nodes_out(_forest(spark, sf, "c45", 3, profile="quality", min_df=10, trees=["1"])[1])


def tree_mr_depth3(spark, sf):
    return _nodes_out(_forest(spark, sf, "mr", 3, profile="role", min_df=10, trees=["user"])[1])


def forest_toxic_c45_depth3(spark, sf):
    return _nodes_out(_forest(spark, sf, "c45", 3, profile="toxic", min_df=10)[1])


def node_stats(spark, sf):
    nodes = _forest(spark, sf, "c45", 3)[1]
    return nodes.select(
        "tree", "node", _big("n"), _big("k"), E.out_score(E.binary_entropy("k", "n")).alias("entropy"), "is_leaf"
    )


def tree_rules(spark, sf):
    return render_rules(_forest(spark, sf, "c45", 3)[1])


def route_level(spark, sf):
    """Where every training row sits in every tree after the root split (level 1)."""
    feats, nodes = _forest(spark, sf, "c45", 1)
    return route(nodes, feats.terms, feats.labels, 1)


def route_two_levels(spark, sf):
    """Where every training row sits after two levels."""
    feats, nodes = _forest(spark, sf, "c45", 2)
    return route(nodes, feats.terms, feats.labels, 2)


def _scored(spark, sf):
    feats, nodes = _forest(spark, sf, "c45", 3)
    return P.evaluate(spark, feats, nodes)


def tree_predict(spark, sf):
    return _scored(spark, sf)[0]


def forest_predict(spark, sf):
    return _scored(spark, sf)[1]


def accuracy(spark, sf):
    return _scored(spark, sf)[2]


def stem_vocabulary(spark, sf):
    """Every distinct training word of the profile and its stem."""
    from sylvan.functions.stem import stem_table

    words = _train_postings(spark, sf).select("term").distinct()
    return stem_table(words)


def forest_c45_stemmed_depth2(spark, sf):
    """The reference's token pipeline (stem, then drop stop words) feeding a c45 forest."""
    return _nodes_out(_forest(spark, sf, "c45", 2, stem=True, stop_words=True)[1])


def accuracy_mr_stemmed(spark, sf):
    """The reference's defaults end to end: stemmed tokens, stop words, rule mr, vote, accuracy."""
    feats, nodes = _forest(spark, sf, "mr", 3, stem=True, stop_words=True)
    return P.evaluate(spark, feats, nodes, stem=True, stop_words=True)[2]


def job_compute_then_load(spark, sf):
    """IO7: the job with its switches: compute and store, then a second run that loads
    the prepared tables and the forest from the store (mr rule, depth 3, stemming)."""
    from sylvan.plans.job import JobParams, run_job
    from sylvan.session import scratch_path

    store = scratch_path(spark, "job")
    params = JobParams(min_df=MIN_DF, rule="mr", max_depth=3, stem=True, stop_words=True)
    run_job(spark, sf, store, LANG, params, compute_features=True, compute_forest=True).collect()
    return run_job(spark, sf, store, LANG, params, compute_features=False, compute_forest=False)


def _defaults(spark, sf):
    """The classic job's own parameters: min_df 200, rule mr, depth 20, stemmed, stop words out."""
    from sylvan.plans.job import JobParams

    p = JobParams()
    return _forest(spark, sf, p.rule, p.max_depth, min_df=p.min_df, stem=p.stem, stop_words=p.stop_words)


def forest_job_defaults(spark, sf):
    return _nodes_out(_defaults(spark, sf)[1])


def accuracy_job_defaults(spark, sf):
    feats, nodes = _defaults(spark, sf)
    return P.evaluate(spark, feats, nodes, stem=True, stop_words=True)[2]


def forest_role_c45_depth8(spark, sf):
    return _nodes_out(_forest(spark, sf, "c45", 8, profile="role", min_df=10)[1])


def job_from_csv(spark, sf):
    """IO1 + IO7: the documents written as a CSV with the user's own column names, and the job run
    on that file (JSON store, rule mr, depth 3, stemming)."""
    from sylvan.plans.job import JobParams, run_file_job
    from sylvan.session import scratch_path

    path, store = scratch_path(spark, "user-csv"), scratch_path(spark, "job")
    own = labelled_text(spark, sf, LANG).select(F.col("text").alias("Text"), F.col("doc_id").alias("Number"), F.col("label").alias("Topic"))
    IO.write(own, path, "csv", quoteAll="true", compression="gzip")
    params = JobParams(min_df=MIN_DF, rule="mr", max_depth=3, stem=True, stop_words=True, store_format="json")
    return run_file_job(
        spark, path, store, "csv", "Text", "Topic", "Number", sorted(PROFILES[LANG].labels), PROFILES[LANG].drop_accented,
        params, {"multiLine": "true"}, "bigint",
    )


def job_toxic_store(spark, sf):
    """IO5 + IO7 with number-like labels (0, 1): the job on the ``toxic`` profile computes and stores,
    then a second run scores with the loaded features and forest (c45, depth 3)."""
    from sylvan.plans.job import JobParams, run_job
    from sylvan.session import scratch_path

    store = scratch_path(spark, "job")
    params = JobParams(min_df=10, rule="c45", max_depth=3, stem=False, stop_words=False)
    run_job(spark, sf, store, "toxic", params)
    return run_job(spark, sf, store, "toxic", params, compute_features=False, compute_forest=False)


def forest_store_roundtrip(spark, sf):
    nodes = _forest(spark, sf, "c45", 2)[1]
    back = IO.load_forest(spark, IO.save_forest(nodes, "c45"), "c45")
    return back.select("rule", "tree", "node", _big("depth"), "term", E.out_score(F.col("score")).alias("score"), "is_leaf", "label")


# ---- files -------------------------------------------------------------------------------


def io_csv_roundtrip(spark, sf):
    c = C.clean(labelled_text(spark, sf, LANG), PROFILES[LANG].labels, drop_accented=False)
    back = IO.csv_roundtrip(c.select("doc_id", "label", "text"))
    return back.select("doc_id", "label", F.md5("text").alias("text_md5"))


def io_json_roundtrip(spark, sf):
    test = X.test_part(_cleaned(spark, sf))
    back = IO.json_roundtrip(test.select("doc_id", "label", "tokens"))
    return back.select("doc_id", "label", F.array_join("tokens", " ").alias("tokens"))


def io_json_inferred(spark, sf):
    """IO2: JSON lines whose columns (and types) differ from line to line, read with the inferred and
    stored schema. The first read finds it, the second takes it from beside the data."""
    from sylvan.session import scratch_path

    d = read_table(spark, sf, "documents")
    line = (
        F.when(F.col("lang") == "en", F.to_json(F.struct("doc_id", F.col("n_chars").alias("n"), "lang")))
        .when(F.col("lang") == "fr", F.to_json(F.struct("doc_id", (F.col("n_chars") / 2).alias("n"), F.struct("source").alias("extra"))))
        .when(F.col("lang") == "de", F.to_json(F.struct("doc_id", F.array("source", "lang").alias("tags"))))
        .otherwise(F.to_json(F.struct("doc_id", F.length("lang").alias("lang"))))
    )
    path = scratch_path(spark, "own-json")
    d.select(line.alias("value")).write.text(path)
    IO.read_json_inferred(spark, path)
    t = IO.read_json_inferred(spark, path)
    tags = F.array_join("tags", ",").alias("tags")
    return t.select("doc_id", F.col("n").cast("double").alias("n"), "lang", F.col("extra.source").alias("source"), tags)


QUERIES = {
    f.__name__: f
    for f in [
        clean_topic_filter, clean_no_alpha, clean_accented, clean_rejects, clean_except, clean_text,
        tokenize, remove_stop_words, token_stages, train_test_split, doc_index, label_index,
        postings, vocabulary, postings_in_vocab, class_sizes, one_vs_rest, matrix_summary,
        term_pivot, term_unpivot, entropy, leaf_label, split_stats, gain_ratio, best_split, top_splits,
        forest_c45_depth2, forest_mr_depth3, tree_c45_depth3, tree_mr_depth3, forest_toxic_c45_depth3,
        node_stats, tree_rules, route_level, tree_predict, forest_predict, accuracy,
        forest_store_roundtrip, io_csv_roundtrip, io_json_roundtrip,
        stem_vocabulary, forest_c45_stemmed_depth2, accuracy_mr_stemmed, job_compute_then_load,
        clean_topic_subset, clean_no_alpha_caught, clean_rejects_caught, token_stages_stemmed, token_stages_stop_first,
        doc_terms, route_two_levels, forest_job_defaults, accuracy_job_defaults, forest_role_c45_depth8, job_from_csv,
        job_toxic_store, clean_row_identity, label_codes, io_json_inferred,
    ]
}
