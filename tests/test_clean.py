"""Hand cases for cleaning and tokenizing (label filter, rejects, EXCEPT DISTINCT, symbols)."""

from pyspark.sql import functions as F

from sylvan.functions import text as T
from sylvan.operators import clean as C
from sylvan.operators.clean import clean, reject_sets, with_tokens

SCHEMA = "doc_id bigint, text string, label string"


def _ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_duplicates_nulls_and_labels(spark):
    rows = [
        (1, "Hello world", "A"),
        (2, "Hello world", "A"),  # exact duplicate of 1 -> collapses to the smaller id
        (3, "Hello world", "B"),  # same text, other label -> stays
        (4, None, "A"),  # NULL text survives the reject sets
        (5, None, "A"),  # ... and collapses with 4
        (6, "Some text", None),  # NULL label dropped
        (7, "Some text", "Z"),  # label outside the list dropped
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _ids(clean(df, ["A", "B"], drop_accented=True)) == [1, 3, 4]


def test_reject_sets(spark):
    rows = [
        (1, "1234 !!", "A"),  # no letter -> rejected
        (2, "café au lait", "A"),  # lower-case accent -> rejected when the filter is on
        (3, "ÉCOLE", "A"),  # upper-case accent only -> kept (letters removed later)
        (4, "mañana straße", "A"),  # n-tilde / sharp s are not in the class -> kept
        (5, "plain words", "A"),
        (6, "", "A"),  # no letter
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _ids(clean(df, ["A"], drop_accented=True)) == [3, 4, 5]
    assert _ids(clean(df, ["A"], drop_accented=False)) == [2, 3, 4, 5]
    assert _ids(reject_sets(df, drop_accented=True)) == [1, 2, 6]


def test_symbols_deleted_not_spaced(spark):
    rows = [
        (1, "well-known don't", "A"),
        (2, "tabs\tand\nnew  lines", "A"),
        (3, "   Leading and trailing   ", "A"),
        (4, "ÉÉÉ 123 x", "A"),  # becomes "x"
        (5, "ÉÉÉ!!! a", "A"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.tokens for r in with_tokens(clean(df, ["A"], drop_accented=False)).collect()}
    assert got[1] == ["wellknown", "dont"]
    assert got[2] == ["tabs", "and", "new", "lines"]
    assert got[3] == ["leading", "and", "trailing"]
    assert got[4] == ["x"]
    assert got[5] == ["a"]


def test_text_that_becomes_empty(spark):
    df = spark.createDataFrame([(1, "ÉÉÉ a", "A"), (2, "Ü!", "A")], SCHEMA)
    # "Ü!" has no ASCII letter -> rejected; make one that has a letter only inside a symbol run
    got = with_tokens(clean(df, ["A"], drop_accented=False)).collect()
    assert [r.doc_id for r in got] == [1]
    empty = spark.createDataFrame([(9, None, "A")], SCHEMA)
    t = with_tokens(clean(empty, ["A"])).collect()[0]
    assert t.tokens == []


def test_stop_words_keep_order_and_duplicates(spark):
    from sylvan.functions.text import SPARK_ENGLISH_STOP_WORDS, remove_stop_words

    df = spark.createDataFrame([(["the", "cat", "and", "the", "cat"],)], "tokens array<string>")
    assert df.select(remove_stop_words(F.col("tokens")).alias("t")).first().t == ["cat", "cat"]
    from pyspark.ml.feature import StopWordsRemover

    assert SPARK_ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_null_and_repeated_ids_follow_except_distinct(spark):
    from sylvan.operators import features as X
    from sylvan.operators.clean import ids_are_unique, named_by_key

    rows = [
        (None, "only here", "A"),
        (None, "only there", "A"),
        (None, "only here", "A"),  # equal in all: one stays
        (1, "abc def", "A"),
        (2, "abc def", "A"),  # a copy of 1
        (2, "ghi", "A"),  # shares its id with a copy that went
        (3, "xyz", "A"),
        (3, "uvw", "A"),  # an id of two rows
        (3, "xyz", "B"),
        (None, "xyz", "B"),  # an id comes before none
        (4, None, "A"),
        (None, None, "A"),
        (5, "", "B"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = clean(df, ["A", "B"], with_key=True)
    seen = sorted([(r.doc_id, r.text, r.label) for r in got.collect()], key=repr)
    want = [(None, "only here", "A"), (None, "only there", "A"), (1, "abc def", "A"), (2, "ghi", "A"), (3, "xyz", "A"),
            (3, "uvw", "A"), (3, "xyz", "B"), (4, None, "A")]
    assert seen == sorted(want, key=repr)  # the empty text has no letter
    assert not ids_are_unique(got) and ids_are_unique(named_by_key(got))
    parts = X.with_split(named_by_key(got)).groupBy("is_train").count().collect()
    assert sum(r["count"] for r in parts) == len(want) and all(r.is_train is not None for r in parts)


def test_features_of_rows_without_usable_ids(spark):
    from sylvan.plans import pipeline as P

    words = ["red", "blue", "green", "grey", "pink"]
    rows = [(i, f"{words[i % 5]} {words[i // 5 % 5]} {words[i // 25 % 5]} x{'abcde'[i // 125]}", "A" if i % 5 < 2 else "B") for i in range(400)]
    plain = spark.createDataFrame(rows, SCHEMA)
    found = []
    for change in ("doc_id", "cast(null as bigint)", "doc_id % 3"):
        feats = P.prepare_table(plain.withColumn("doc_id", F.expr(change)), ["A", "B"], min_df=2)
        n = feats.base.count() + feats.test_docs.count()
        assert n == len({r[1:] for r in rows}) and feats.terms.select("doc_id").distinct().count() == feats.base.count()
        found.append(feats.base.schema["doc_id"].dataType.simpleString())
    assert found == ["bigint", "string", "string"]


def test_symbols_are_matched_as_an_intersection(spark):
    """The negated class with a class inside is matched several times more slowly."""
    odd = "".join(map(chr, [*range(1, 0x250), 0x85, 0xA0, 0x1680, 0x2028, 0x212A, 0x3000, 0x4E2D, 0x1F600]))
    df = spark.createDataFrame([(odd,), (None,), ("",), ("a-b\tc\x0bd e!",)], "text string")
    col = T.strip_symbols(F.col("text"))
    assert "&&" in str(col) and T.SYMBOL_CLASS not in str(col)
    for got, was in df.select(col, F.regexp_replace("text", T.SYMBOL_CLASS, "")).collect():
        assert got == was


def test_stemming_reads_rows_that_are_cleaned_once(spark):
    rows = [(1, "Running cats, running!", "A"), (2, "", "A"), (3, None, "B"), (4, "the cats", "B")]
    df = C.with_tokens(spark.createDataFrame(rows, "doc_id bigint, text string, label string"), stem=True)
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id: list(r.tokens) for r in df.collect()} == {1: ["run", "cat", "run"], 2: [], 3: [], 4: ["the", "cat"]}
