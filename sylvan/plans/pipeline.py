"""End-to-end plans over the driver tables: prepare -> train -> evaluate.

Each function takes ``(spark, sf_dir, ...)`` and returns DataFrames; the only
driver-side values are the label list, the vocabulary size and per-level counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.operators import features as X
from sylvan.operators.clean import clean_tokens
from sylvan.operators.forest import grow_forest
from sylvan.operators.score import accuracy, forest_vote, tree_predict
from sylvan.sources.tables import PROFILES, labelled_text

# Parameters of the registered queries (fixed; never tuned per data size).
DEFAULT_PROFILE = "lang"
DEFAULT_MIN_DF = 50


def cleaned_tokens(
    spark: SparkSession,
    sf_dir: str,
    profile: str = DEFAULT_PROFILE,
    stop_words: bool = False,
    stem: bool = False,
    stop_before_stem: bool = False,
) -> DataFrame:
    """``doc_id, label, tokens`` of a profile after F1, F2/F3, S2 and T1b (T1c, T1e on request)."""
    p = PROFILES[profile]
    raw = labelled_text(spark, sf_dir, profile)
    return clean_tokens(raw, p.labels, p.drop_accented, stop_words, stem, stop_before_stem)


def prepare_table(
    raw: DataFrame,
    labels: Sequence[str] | None = None,
    drop_accented: bool = True,
    min_df: int = DEFAULT_MIN_DF,
    stem: bool = False,
    stop_words: bool = False,
    stop_before_stem: bool = False,
) -> X.Features:
    """Features of any table with ``doc_id, text, label`` (labels None: all that occur). Ids may be
    null or repeat; rows are then named by their row key."""
    toks = clean_tokens(raw, labels, drop_accented, with_key=True)
    names = X.tree_labels(raw.sparkSession, toks, labels)
    return X.build_features(
        raw.sparkSession, toks, names, min_df, stem=stem, stop_words=stop_words, stop_before_stem=stop_before_stem
    )


def prepare(
    spark: SparkSession,
    sf_dir: str,
    profile: str = DEFAULT_PROFILE,
    min_df: int = DEFAULT_MIN_DF,
    stem: bool = False,
    stop_words: bool = False,
    stop_before_stem: bool = False,
) -> X.Features:
    p = PROFILES[profile]
    raw = labelled_text(spark, sf_dir, profile)
    return prepare_table(raw, p.labels, p.drop_accented, min_df, stem, stop_words, stop_before_stem)


def train(
    spark: SparkSession,
    feats: X.Features,
    rule: str = "c45",
    max_depth: int = 20,
    trees: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """The node table of the forest (``trees`` restricts the forest to some labels)."""
    labels = list(trees) if trees is not None else feats.labels
    return grow_forest(
        spark, feats.terms, feats.base, labels, feats.vocab_size, rule=rule, max_depth=max_depth, buckets=buckets, vocab=feats.vocab
    )


def test_terms(feats: X.Features, stem: bool = False, stop_words: bool = False, stop_before_stem: bool = False) -> DataFrame:
    """``doc_id, label, terms`` of the test rows: their distinct words, treated like training."""
    posts = X.postings(feats.test_docs, stem=stem, stop_words=stop_words, stop_before_stem=stop_before_stem)
    if not (stem or stop_words):
        return feats.test_docs.select("doc_id", "label", F.array_distinct("tokens").alias("terms"))
    sets = posts.groupBy("doc_id").agg(F.collect_set("term").alias("terms"))
    return feats.test_docs.select("doc_id", "label").join(sets, "doc_id", "left")


def evaluate(
    spark: SparkSession,
    feats: X.Features,
    nodes: DataFrame,
    stem: bool = False,
    stop_words: bool = False,
    stop_before_stem: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(per-tree predictions, voted predictions, accuracy) on the test rows."""
    docs = test_terms(feats, stem, stop_words, stop_before_stem)
    preds = tree_predict(nodes, docs, feats.labels, keep=["label"])
    voted = forest_vote(preds, feats.sizes, keep=["label"])
    return preds.drop("label"), voted.drop("label"), accuracy(voted)
