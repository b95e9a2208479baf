"""The whole classification job with its load-or-compute switches (IO7).

``run_table_job`` takes any table with ``doc_id, text, label``; ``run_file_job`` a CSV, JSON or
Parquet path with column names; ``run_job`` one of the driver profiles. The job prepares or
reloads the features, grows or reloads the forest, then scores the test rows. Prepared tables
(in the chosen format) and the forest (parquet) live under one store folder, ``features`` and
``forest/<rule>``, as versions with a manifest (``sources.store``). What follows reads the stored
tables, in a computing run as in a loading one; a loading run asks for the same parameters.
Defaults are the classic job's: minimum word occurrences 200, the map-reduce rule, depth 20,
and stemming with stop-word removal.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sylvan.operators import features as X
from sylvan.plans import pipeline as P
from sylvan.session import table_scope
from sylvan.sources.files import load_forest, read_labelled, save_forest
from sylvan.sources.store import StoreError, TableStore
from sylvan.sources.tables import PROFILES, labelled_text


@dataclass(frozen=True)
class JobParams:
    min_df: int = 200
    rule: str = "mr"
    max_depth: int = 20
    stem: bool = True
    stop_words: bool = True
    stop_before_stem: bool = False
    store_format: str = "parquet"  # or "json"


def _tables(feats: X.Features) -> dict[str, DataFrame]:
    return {
        "train": feats.train_docs, "test": feats.test_docs, "postings": feats.posts,
        "vocab": feats.vocab, "terms": feats.terms, "sizes": feats.sizes,
    }


def save_features(feats: X.Features, store: str, fmt: str = "parquet", params: dict | None = None) -> None:
    """The prepared tables as one version of ``store/features``: readers see all of them or none."""
    info = {"kind": "features", "params": params or {}, "labels": feats.labels, "vocab_size": feats.vocab_size}
    _features_store(feats.posts.sparkSession, store).commit(_tables(feats), info, fmt)


def load_features(spark: SparkSession, store: str, id_type: str | None = None, params: dict | None = None) -> X.Features:
    """The saved features, table by table, with the stored schemas; label list and vocabulary size
    come from the manifest. ``id_type`` and ``params``, where given, must be those stored."""
    at = _features_store(spark, store)
    version = at.latest()
    stored = version.schema("terms")["doc_id"].dataType.simpleString()
    if id_type is not None and id_type != stored:
        raise StoreError(f"the stored ids are {stored}, not {id_type}")
    if params is not None and params != version.info["params"]:
        raise StoreError(f"the features were prepared with {version.info['params']}, not {params}")
    t = {name: at.read(name, version) for name in version.tables}
    return X.Features(
        labels=list(version.info["labels"]),
        train_docs=t["train"],
        test_docs=t["test"],
        posts=t["postings"],
        base=t["terms"].select("doc_id", "label"),
        vocab=t["vocab"],
        vocab_size=version.info["vocab_size"],
        terms=t["terms"],
        sizes=t["sizes"],
    )


def _features_store(spark: SparkSession, store: str) -> TableStore:
    return TableStore(spark, f"{store.rstrip('/')}/features")


def run_table_job(
    raw: DataFrame,
    store: str,
    labels: Sequence[str] | None = None,
    drop_accented: bool = True,
    params: JobParams = JobParams(),
    compute_features: bool = True,
    compute_forest: bool = True,
) -> DataFrame:
    """Accuracy of the job (one row). With ``compute_*`` off, the stored tables are used."""
    spark = raw.sparkSession
    how = {"stem": params.stem, "stop_words": params.stop_words, "stop_before_stem": params.stop_before_stem}
    prepared = {"min_df": params.min_df, "drop_accented": drop_accented, **how}
    forest_path = f"{store.rstrip('/')}/forest"
    with table_scope(spark):  # every table on the way goes when the job ends or fails
        if compute_features:
            with table_scope(spark):  # the prepared tables go as soon as they are stored
                made = P.prepare_table(raw, labels, drop_accented, params.min_df, **how)
                save_features(made, store, params.store_format, prepared)
        feats = load_features(spark, store, params=prepared)
        if compute_forest:
            nodes = P.train(spark, feats, rule=params.rule, max_depth=params.max_depth)
            save_forest(nodes, params.rule, forest_path, {**prepared, "max_depth": params.max_depth}, feats.labels)
        nodes = load_forest(spark, forest_path, rule=params.rule)
        accuracy = P.evaluate(spark, feats, nodes.drop("rule"), **how)[2]
        return spark.createDataFrame(accuracy.collect(), accuracy.schema)  # one row


def run_file_job(
    spark: SparkSession,
    path: str,
    store: str,
    fmt: str = "csv",
    text_col: str = "text",
    label_col: str = "label",
    id_col: str | None = None,
    labels: Sequence[str] | None = None,
    drop_accented: bool = True,
    params: JobParams = JobParams(),
    read_options: dict | None = None,
    id_type: str | None = None,
    **switches,
) -> DataFrame:
    """``run_table_job`` on a file of the user's own."""
    raw = read_labelled(spark, path, fmt, text_col, label_col, id_col, id_type, **(read_options or {}))
    return run_table_job(raw, store, labels, drop_accented, params, **switches)


def run_job(
    spark: SparkSession,
    sf_dir: str,
    store: str,
    profile: str = P.DEFAULT_PROFILE,
    params: JobParams = JobParams(),
    compute_features: bool = True,
    compute_forest: bool = True,
) -> DataFrame:
    """``run_table_job`` on a profile of the driver tables."""
    p = PROFILES[profile]
    raw = labelled_text(spark, sf_dir, profile)
    return run_table_job(raw, store, p.labels, p.drop_accented, params, compute_features, compute_forest)
