"""Cleaning: label filter, reject sets, EXCEPT-DISTINCT dedupe, token arrays.

Input and output are DataFrames with ``doc_id, text, label``; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.functions import text as T
from sylvan.session import shuffle_partitions, write_table


def filter_labels(df: DataFrame, labels: Sequence[str] | None, label: str = "label") -> DataFrame:
    """keep rows whose label is in the allowed set; a NULL label is dropped."""
    c = F.col(label)
    return df.filter(c.isin(list(labels))) if labels is not None else df.filter(c.isNotNull())


def reject_predicate(text: Column, drop_accented: bool = True) -> Column:
    """F2 OR F3 as one predicate; NULL text is never rejected (as with the set form)."""
    pred = T.no_letter(text)
    if drop_accented:
        pred = pred | T.has_accent(text)
    return F.coalesce(pred, F.lit(False))


def reject_sets(df: DataFrame, drop_accented: bool = True, text: str = "text") -> DataFrame:
    """S1 in its literal form: the no-letter rows united by name with the accented rows."""
    no_alpha = df.filter(T.no_letter(F.col(text)))
    if not drop_accented:
        return no_alpha
    return no_alpha.unionByName(df.filter(T.has_accent(F.col(text))))


#: Column that the cleaning adds on request: the row key, a name for rows whose ids are null or repeat.
ROW_KEY = "row_key"


def row_key(doc_id: Column, digest: Column, label: Column) -> Column:
    """The identity of a row, null-safe: a digest of its id, its text's digest and its label."""

    def part(tag: str, c: Column) -> Column:
        return F.coalesce(F.concat(F.lit(tag), c), F.lit("-"))

    return F.sha2(F.concat_ws("|", part("t", digest), part("i", doc_id.cast("string")), part("l", label)), 256)


def dedupe_text_label(df: DataFrame, text: str = "text", label: str = "label", doc_id: str = "doc_id") -> DataFrame:
    """S2's EXCEPT DISTINCT: one row per (text, label), the one with the smallest id (an id before
    none). Adds ``row_key``; no two rows share one.

    Skew-safe: the group key is a 256-bit hash of the text plus the label, and the
    aggregate is ``min(doc_id)`` (partial aggregation combines a hot group map-side);
    only ids are shuffled for it. The rows meet the kept keys in a semi-join on the row key, so
    ids may be null or repeat. NULL texts form one group per label, as set semantics
    treat NULLs as equal.
    """
    digest = F.sha2(F.col(text), 256)
    keep = df.groupBy(digest.alias("_h"), F.col(label)).agg(F.min(doc_id).alias(doc_id))
    keep = keep.select(row_key(F.col(doc_id), F.col("_h"), F.col(label)).alias(ROW_KEY))
    # a sort-merge semi-join (it spills): the rows move once, hash-partitioned by their key, so
    # the regex work after it is spread over all tasks
    rows = df.withColumn(ROW_KEY, row_key(F.col(doc_id), digest, F.col(label)))
    # rows equal in all three are neighbours by now: the aggregate streams along that order
    return rows.join(keep.hint("merge"), ROW_KEY, "left_semi").dropDuplicates([ROW_KEY])


def clean(
    df: DataFrame,
    labels: Sequence[str] | None = None,
    drop_accented: bool = True,
    dedupe: bool = True,
    with_key: bool = False,
) -> DataFrame:
    """F1 -> (F2|F3 rejected) -> S2 dedupe. Returns ``doc_id, text, label``, on request with ``row_key``
    (needs the dedupe).

    The kept rows are hash-partitioned once: the regex cleaning that
    follows runs spread over all tasks whatever the input's file/row-group layout;
    the dedupe semi-join provides that exchange; without dedupe an explicit one does.
    """
    out = filter_labels(df, labels)
    out = out.filter(~reject_predicate(F.col("text"), drop_accented))
    if dedupe:
        out = dedupe_text_label(out)
    else:
        out = out.repartition(shuffle_partitions(df.sparkSession), "doc_id")
    return out.select("doc_id", "text", "label", *([ROW_KEY] if with_key else []))


def stem_tokens(df: DataFrame) -> DataFrame:
    """T1c on token arrays: every token replaced by its stem, order and repeats kept.

    The rows are read three times (for the words, their places and the other columns), so they are
    written first and cleaned once. The distinct words are stemmed once (written), the map is joined
    back per occurrence (by broadcast where its counted rows fit the budget; else hot words: AQE's
    skew split), and the arrays are rebuilt per row.
    """
    from sylvan.functions.stem import stem_table
    from sylvan.operators.features import STEM_ROW_BYTES, maybe_broadcast

    df = write_table(df, "tokens")
    words = df.select("doc_id", F.posexplode("tokens").alias("_pos", "term"))
    stems = write_table(stem_table(words.select("term").distinct()), "stems")
    mapped = words.join(maybe_broadcast(stems, stems.count(), STEM_ROW_BYTES), "term")
    placed = mapped.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("_pos", "stem"))).alias("_at"))
    none = F.array().cast("array<string>")
    return df.drop("tokens").join(placed, "doc_id", "left").withColumn("tokens", F.coalesce(F.col("_at.stem"), none)).drop("_at")


def with_tokens(df: DataFrame, stop_words: bool = False, stem: bool = False, stop_before_stem: bool = False) -> DataFrame:
    """T1f: adds ``tokens array<string>`` (P2, P3, lower, T1b), stemmed (T1c) and without stop
    words (T1e) on request; stop words go after stemming unless ``stop_before_stem``."""
    out = df.withColumn("tokens", T.tokenize(F.col("text")))
    drop = T.remove_stop_words(F.col("tokens"))
    if stop_words and (not stem or stop_before_stem):
        out = out.withColumn("tokens", drop)
    if stem:
        out = stem_tokens(out)
        if stop_words and not stop_before_stem:
            out = out.withColumn("tokens", drop)
    return out


def clean_tokens(
    df: DataFrame,
    labels: Sequence[str] | None = None,
    drop_accented: bool = True,
    stop_words: bool = False,
    stem: bool = False,
    stop_before_stem: bool = False,
    with_key: bool = False,
) -> DataFrame:
    """The whole cleaning as one composition (``doc_id, label, tokens``, on request ``row_key``)."""
    out = with_tokens(clean(df, labels, drop_accented, with_key=with_key), stop_words, stem, stop_before_stem)
    return out.select("doc_id", "label", "tokens", *([ROW_KEY] if with_key else []))


def named_by_key(df: DataFrame) -> DataFrame:
    """Cleaned rows under their row key as the id (a string), so that no two share one."""
    return df.withColumn("doc_id", F.col(ROW_KEY)).drop(ROW_KEY)


def ids_are_unique(df: DataFrame) -> bool:
    """Whether every row has an id of its own (one narrow aggregate; read it from a written table)."""
    odd = df.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("doc_id is null or n > 1")
    return not odd.limit(1).count()
