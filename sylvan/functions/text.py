"""Column expressions for cleaning and tokenizing text (all JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's for equal results) ------------------
# Rows containing any of these lower-case accented letters are rejected as non-English.
ACCENT_CLASS = "[àáâãäåçèéêëìíîïòóôõöùúûü]"
# A text needs at least one ASCII letter.
LETTER_CLASS = "[a-zA-Z]"
# Every char that is neither an ASCII letter nor whitespace is deleted (not replaced).
SYMBOL_CLASS = "[^a-zA-Z\\s]"
# Whitespace runs collapse to one space.
SPACE_RUN = "\\s+"
# Seed and training share of the 80/20 split.
SPLIT_SEED = 160343280324
TRAIN_SHARE = 0.8
# Majority threshold and early-stop entropy.
STOP_ENTROPY = 0.2
OTHER = "Other"
# ------------------------------------------------------------------------------------

# Spark ML's default English stop-word list (pyspark.ml.feature.StopWordsRemover,
# loadDefaultStopWords("english")), written out so the SQL twin can inline it.
SPARK_ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom this "
    "that these those am is are was were be been being have has had having do does did doing a an "
    "the and but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll "
    "they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't "
    "wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's "
    "there's what's when's where's who's why's would"
).split()


def no_letter(text: Column) -> Column:
    """text without any ASCII letter (NULL text -> NULL, i.e. not rejected)."""
    return ~text.rlike(LETTER_CLASS)


def has_accent(text: Column) -> Column:
    """text with a listed lower-case accented letter."""
    return text.rlike(ACCENT_CLASS)


# SYMBOL_CLASS as an intersection: the same chars, but Java matches it several times faster than the
# negated class with a class inside (measured; why was not looked into).
_SYMBOLS = "[\\S&&[^a-zA-Z]]+"


def strip_symbols(text: Column) -> Column:
    """Delete every char that is neither a letter nor whitespace."""
    return F.regexp_replace(text, _SYMBOLS, "")


def collapse_spaces(text: Column) -> Column:
    """Collapse whitespace runs to one space (no trim)."""
    return F.regexp_replace(text, SPACE_RUN, " ")


def clean_text(text: Column) -> Column:
    """P2 + P3, lower-cased and trimmed: the string the tokenizer sees."""
    return F.trim(F.lower(collapse_spaces(strip_symbols(text))))


def tokenize(text: Column) -> Column:
    """T1b on the cleaned text: split on the single spaces, no empty tokens.

    NULL text gives an empty array (the row then has no word).
    """
    parts = F.split(clean_text(text), " ")
    return F.coalesce(F.filter(parts, lambda t: t != ""), F.array().cast("array<string>"))


def is_blank(word: Column) -> Column:
    """blank word."""
    return F.trim(word) == ""


def remove_stop_words(tokens: Column, stop_words: list[str] | None = None) -> Column:
    """T1e: drop stop words from a token array, keeping order and duplicates.

    Equal to ``StopWordsRemover`` on the lower-cased tokens that ``tokenize`` gives; the list
    is looked up as a hash set.
    """
    words = stop_words if stop_words is not None else SPARK_ENGLISH_STOP_WORDS
    return F.filter(tokens, lambda t: ~t.isin(words))


def split_bucket(doc_id: Column, seed: int = SPLIT_SEED) -> Column:
    """Deterministic 0..99 bucket of an id: first 32 bits of md5('seed:id').

    Independent of partitioning (``randomSplit`` is not), and reproducible in SQL.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def is_train(doc_id: Column, share: float = TRAIN_SHARE, seed: int = SPLIT_SEED) -> Column:
    return split_bucket(doc_id, seed) < int(round(share * 100))
