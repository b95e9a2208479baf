"""Split, postings, vocabulary, class sizes and the per-document term sets.

The sentence x word matrix of the classic layout is kept *long*: a posting row
``(doc_id, label, term)`` means "word present", its absence means 0. Dense views
(pivot / unpivot) exist only for an explicit, caller-given word list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.functions import text as T
from sylvan.operators.clean import ROW_KEY, ids_are_unique, named_by_key
from sylvan.operators.ordered import dense_index  # noqa: F401
from sylvan.session import MAX_BROADCAST_BYTES, free_shuffles, shuffle_partitions, write_table

#: A row of a stem map: a word and its stem.
STEM_ROW_BYTES = 96


def with_split(df: DataFrame, share: float = T.TRAIN_SHARE, seed: int = T.SPLIT_SEED) -> DataFrame:
    """Adds ``is_train`` from a hash of the id (partitioning-independent)."""
    return df.withColumn("is_train", T.is_train(F.col("doc_id"), share, seed))


def train_part(df: DataFrame) -> DataFrame:
    return with_split(df).filter("is_train").drop("is_train")


def test_part(df: DataFrame) -> DataFrame:
    return with_split(df).filter(~F.col("is_train")).drop("is_train")


def postings(
    tokens_df: DataFrame, stem: bool = False, stop_words: bool = False, stop_before_stem: bool = False, unique_ids: bool = False
) -> DataFrame:
    """P5 + G1 + A1 + F4: one ``(doc_id, label, term)`` row per distinct non-blank word.

    ``array_distinct`` before ``explode`` removes in-document repeats without a shuffle.
    With ``stem=True`` the distinct words are stemmed once (T1c) and joined back; stop
    words are then removed after stemming (T1e), unless ``stop_before_stem``. ``unique_ids``: the caller
    knows that no two rows share an id; equal stems of a row are then merged by a hash aggregate
    over rows dealt by id, where an id with several labels needs a sort to keep one of them.
    """
    words = tokens_df.select("doc_id", "label", F.explode(F.array_distinct("tokens")).alias("term"))
    words = words.filter(~T.is_blank(F.col("term")))
    if stop_words and (stop_before_stem or not stem):
        words = words.filter(~F.col("term").isin(T.SPARK_ENGLISH_STOP_WORDS))
    if not stem:
        return words
    from sylvan.functions.stem import stem_table

    # The stem map (one row per distinct word) is written once: filters above it (the stop
    # words) then cannot be pushed into the step chain, which would inline every step.
    counted = words.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    stems = write_table(stem_table(counted, keep=("df",)), "stems")
    free_shuffles(words.sparkSession)
    out = _with_stems(words, stems).select("doc_id", "label", F.col("stem").alias("term"))
    if stop_words and not stop_before_stem:
        out = out.filter(~F.col("term").isin(T.SPARK_ENGLISH_STOP_WORDS))
    if unique_ids:
        return out.repartition(shuffle_partitions(out.sparkSession), "doc_id").distinct()
    return out.dropDuplicates(["doc_id", "term"])


def _with_stems(words: DataFrame, stems: DataFrame) -> DataFrame:
    """``words`` with their ``stem``. The stem map is broadcast when its counted rows fit the budget; otherwise
    its most frequent words are (two halves of the budget), which most rows have, and only the rows of the others
    are shuffled, in a join whose hot terms AQE's skew-join splits."""
    most, rows = MAX_BROADCAST_BYTES // STEM_ROW_BYTES, stems.count()
    if rows <= most:
        return words.join(F.broadcast(stems.drop("df")), "term")
    digits = F.length(F.bin("df")).alias("digits")
    found = {r.digits: r.n for r in stems.groupBy(digits).agg(F.count(F.lit(1)).alias("n")).collect()}  # 64 rows at most
    least, held = None, 0
    for d in sorted(found, reverse=True):
        if (held := held + found[d]) > most // 2:
            break
        least = 1 << (d - 1)
    if least is None:
        return words.join(stems.drop("df"), "term")
    often = stems.filter(F.col("df") >= least)
    others = words.join(F.broadcast(often.select("term")), "term", "left_anti")
    rare = others.join(stems.filter(F.col("df") < least).drop("df"), "term")
    return words.join(F.broadcast(often.drop("df")), "term").unionByName(rare)


def doc_base(posts: DataFrame) -> DataFrame:
    """Training rows that keep at least one word before the vocabulary cut (A4 base).

    The postings meet a hash aggregate first, whose map holds a task's documents; only the rows that come
    out of it are gathered for one label per id (the one with most words). The postings are never sorted."""
    of_row = posts.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("_n"))
    return of_row.groupBy("doc_id").agg(F.max_by("label", "_n").alias("label"))


def vocabulary(posts: DataFrame, min_df: int) -> DataFrame:
    """A3 + F5: document frequency per term, kept when ``df >= min_df``."""
    return posts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df)


def maybe_broadcast(df: DataFrame, rows: int, row_bytes: int = 64) -> DataFrame:
    """Broadcast hint only when ``rows`` (a checked count) x ``row_bytes`` fits the budget."""
    return F.broadcast(df) if rows * row_bytes <= MAX_BROADCAST_BYTES else df


def postings_in_vocab(posts: DataFrame, vocab: DataFrame, vocab_rows: int | None = None) -> DataFrame:
    """Postings of vocabulary terms (semi-join, no collect of the word list)."""
    v = vocab.select("term")
    if vocab_rows is not None:
        v = maybe_broadcast(v, vocab_rows)
    return posts.join(v, "term", "left_semi")


def rows_with_words(tokens_df: DataFrame, stop_words: bool = False) -> DataFrame:
    """The rows that have a posting (unstemmed), with their tokens as ``terms``."""

    def counts(t: Column) -> Column:
        word = ~T.is_blank(t)
        return word & ~t.isin(T.SPARK_ENGLISH_STOP_WORDS) if stop_words else word

    return tokens_df.filter(F.exists("tokens", counts)).select("doc_id", "label", F.col("tokens").alias("terms"))


def doc_terms(
    posts: DataFrame, vocab: DataFrame, vocab_rows: int | None = None, rows: DataFrame | None = None
) -> DataFrame:
    """``(doc_id, label, terms)``: sorted vocabulary terms of every row that has a word.

    One aggregation by ``doc_id`` gives the base rows (A4) and their term sets. Rows whose
    words are all rare stay with an empty array (they are all-zero rows of the dense matrix
    and still count in every node).

    ``rows`` (``rows_with_words`` of the same postings, ids unique): the vocabulary then meets each row's words
    where they are, if it fits the broadcast budget; the postings are neither joined nor gathered.
    """
    if rows is not None:
        from sylvan.operators.dictionary import as_sets

        sets = as_sets(rows, "terms", vocab, "term", vocab.count() if vocab_rows is None else vocab_rows, numbered=False)
        if sets is not None:
            return sets
    v = vocab.select(F.col("term").alias("_v"))
    if vocab_rows is not None:
        v = maybe_broadcast(v, vocab_rows)
    kept = F.collect_list("_v")  # of terms outside the vocabulary: null, left out
    flagged = posts.join(v, F.col("term") == F.col("_v"), "left")
    return flagged.groupBy("doc_id", "label").agg(F.array_sort(kept).alias("terms"))


def tree_labels(spark: SparkSession, cleaned: DataFrame, labels: Sequence[str] | None) -> list[str]:
    """The one-vs-rest tree list: the allowed labels, else the distinct labels (one string per
    tree that is to be grown; the only thing besides counts that the driver holds)."""
    if labels is not None:
        return sorted(set(labels))
    return sorted(r[0] for r in cleaned.select("label").distinct().collect())


def labels_frame(spark: SparkSession, labels: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(x,) for x in labels], "label string")


def class_sizes(spark: SparkSession, base: DataFrame, labels: Sequence[str]) -> DataFrame:
    """A5: training rows per label, zero for labels without rows (outer join)."""
    counts = maybe_broadcast(base.groupBy("label").agg(F.count(F.lit(1)).alias("n_train")), len(labels))
    return (
        labels_frame(spark, labels)
        .join(counts, "label", "left")
        .select("label", F.coalesce("n_train", F.lit(0)).cast("bigint").alias("n_train"))
    )


def trees_column(labels: Sequence[str]) -> Column:
    """Generator column over the tree list (one-vs-rest fan-out without a join)."""
    return F.explode(F.array(*[F.lit(x) for x in labels]))


def one_vs_rest(base: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``(doc_id, tree, ovr_label)`` with the category or ``'Other'``."""
    return base.select("doc_id", "label", trees_column(labels).alias("tree")).select(
        "doc_id",
        "tree",
        F.when(F.col("label") == F.col("tree"), F.col("tree")).otherwise(F.lit(T.OTHER)).alias("ovr_label"),
    )


def term_pivot(posts: DataFrame, words: Sequence[str]) -> DataFrame:
    """A2 + P7: dense 0/1 view over an explicit word list (one column per word)."""
    words = list(words)
    keep = posts.filter(F.col("term").isin(words))
    base = doc_base(posts)
    wide = keep.groupBy("doc_id").pivot("term", words).count()
    out = base.join(wide, "doc_id", "left")
    return out.select("doc_id", "label", *[F.coalesce(F.col(w), F.lit(0)).cast("bigint").alias(w) for w in words])


def term_unpivot(wide: DataFrame, words: Sequence[str]) -> DataFrame:
    """The dense row back to ``(doc_id, label, term, value)``, zeros included."""
    return wide.unpivot(["doc_id", "label"], list(words), "term", "value")


def random_split(df: DataFrame, share: float = T.TRAIN_SHARE, seed: int = T.SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """X1 in its literal form: Spark's ``randomSplit`` (result depends on the partitioning;
    ``with_split`` is the partition-independent default)."""
    train, test = df.randomSplit([share, 1.0 - share], seed=seed)
    return train, test


@dataclass
class Features:
    """Everything the forest needs, built lazily except for two small counts."""

    labels: list[str]
    train_docs: DataFrame  # doc_id, label, tokens
    test_docs: DataFrame  # doc_id, label, tokens
    posts: DataFrame  # doc_id, label, term   (training, before the vocabulary cut)
    base: DataFrame  # doc_id, label         (training rows with >= 1 word)
    vocab: DataFrame  # term, df
    vocab_size: int
    terms: DataFrame  # doc_id, label, terms  (vocabulary terms, all base rows)
    sizes: DataFrame  # label, n_train


def build_features(
    spark: SparkSession,
    tokens_df: DataFrame,
    labels: Sequence[str],
    min_df: int,
    stem: bool = False,
    stop_words: bool = False,
    split: bool = True,
    stop_before_stem: bool = False,
) -> Features:
    """From cleaned token rows to the training inputs of the forest.

    The cleaned token rows are written once (shared checkpoint folder): the regex cleaning then
    runs a single time, and the base rows, vocabulary, term sets and test rows all read the written
    table. Postings that need a join (stems) are written too; others are an explode of the tokens. With a ``row_key``
    column, rows whose ids are null or repeat are named by it (all rows, so ids have one type).
    """
    marked = write_table(tokens_df, "tokens", compression="zstd")  # the largest of the tables, kept to the end
    free_shuffles(spark)  # the texts
    unique_ids = ROW_KEY in marked.columns
    if unique_ids:
        # ids that are null or repeat cannot name rows: their keys then do
        marked = marked.drop(ROW_KEY) if ids_are_unique(marked) else named_by_key(marked)
    marked = with_split(marked) if split else marked.withColumn("is_train", F.lit(True))
    train = marked.filter("is_train").drop("is_train")
    test = marked.filter(~F.col("is_train")).drop("is_train") if split else train
    posts = postings(train, stem, stop_words, stop_before_stem, unique_ids)
    rows = None
    if stem or not unique_ids:
        posts = write_table(posts, "postings", compression="zstd")
        free_shuffles(spark)
    else:
        rows = rows_with_words(train, stop_words)
    vocab = write_table(vocabulary(posts, min_df), "vocabulary")
    vocab_size = vocab.count()
    terms = write_table(doc_terms(posts, vocab, vocab_size, rows), "terms")
    base = terms.select("doc_id", "label")
    return Features(
        labels=list(labels),
        train_docs=train,
        test_docs=test,
        posts=posts,
        base=base,
        vocab=vocab,
        vocab_size=vocab_size,
        terms=terms,
        sizes=write_table(class_sizes(spark, base, labels), "sizes"),
    )
