"""English stemming (T1c): Porter's algorithm (1980) as built-in Column expressions.

The measure conditions are regular expressions over the word (consonant / vowel classes
with the ``y`` rule folded in); each step is one CASE over its suffix list, with the
longest matching suffix chosen by a lazy stem group. Words shorter than 3 letters are
left alone; a leading ``y`` counts as a consonant. No UDF: the whole chain stays in the
JVM, and it runs once per *distinct* word (``stem_table``), not per occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: the algorithm's classes and suffix tables --------------------------
CONS = "[^aeiou]"  # a consonant (y included; the sequences below refine it)
VOWEL = "[aeiouy]"
CONS_SEQ = CONS + "[^aeiouy]*"
VOWEL_SEQ = VOWEL + "[aeiou]*"
M_GT0 = f"^({CONS_SEQ})?{VOWEL_SEQ}{CONS_SEQ}"
M_EQ1 = f"^({CONS_SEQ})?{VOWEL_SEQ}{CONS_SEQ}({VOWEL_SEQ})?$"
M_GT1 = f"^({CONS_SEQ})?{VOWEL_SEQ}{CONS_SEQ}{VOWEL_SEQ}{CONS_SEQ}"
HAS_VOWEL = f"^({CONS_SEQ})?{VOWEL}"
CVC = f"^{CONS_SEQ}{VOWEL}[^aeiouwxy]$"
# a doubled consonant other than l, s, z (spelled out: no back-references)
DOUBLE_END = "(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$"

STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "logi": "log",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]
# -----------------------------------------------------------------------------------------


def _split(w: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(w, pattern, group)


def _drop_last(w: Column) -> Column:
    return F.regexp_replace(w, ".$", "")


def step1a(w: Column) -> Column:
    return (
        F.when(w.rlike("^(.+?)(ss|i)es$"), F.regexp_replace(w, "^(.+?)(ss|i)es$", "$1$2"))
        .when(w.rlike("^(.+?)([^s])s$"), F.regexp_replace(w, "^(.+?)([^s])s$", "$1$2"))
        .otherwise(w)
    )


def step1b(w: Column) -> Column:
    eed = "^(.+?)eed$"
    eding = "^(.+?)(ed|ing)$"
    stem = _split(w, eding, 1)
    tidy = (
        F.when(stem.rlike("(at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(stem.rlike(DOUBLE_END), _drop_last(stem))
        .when(stem.rlike(CVC), F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )
    return (
        F.when(w.rlike(eed), F.when(_split(w, eed, 1).rlike(M_GT0), _drop_last(w)).otherwise(w))
        .when(w.rlike(eding) & stem.rlike(HAS_VOWEL), tidy)
        .otherwise(w)
    )


def step1c(w: Column) -> Column:
    pat = "^(.+?)y$"
    stem = _split(w, pat, 1)
    return F.when(w.rlike(pat) & stem.rlike(HAS_VOWEL), F.concat(stem, F.lit("i"))).otherwise(w)


def _suffix_step(w: Column, table: dict[str, str], condition: str) -> Column:
    pat = "^(.+?)(" + "|".join(table) + ")$"
    stem, suffix = _split(w, pat, 1), _split(w, pat, 2)
    repl = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.when(w.rlike(pat) & stem.rlike(condition), F.concat(stem, F.element_at(repl, suffix))).otherwise(w)


def step2(w: Column) -> Column:
    return _suffix_step(w, STEP2, M_GT0)


def step3(w: Column) -> Column:
    return _suffix_step(w, STEP3, M_GT0)


def step4(w: Column) -> Column:
    pat = "^(.+?)(" + "|".join(STEP4) + ")$"
    pat_ion = "^(.+?)(s|t)(ion)$"
    stem = _split(w, pat, 1)
    stem_ion = F.concat(_split(w, pat_ion, 1), _split(w, pat_ion, 2))
    return (
        F.when(w.rlike(pat), F.when(stem.rlike(M_GT1), stem).otherwise(w))
        .when(w.rlike(pat_ion) & stem_ion.rlike(M_GT1), stem_ion)
        .otherwise(w)
    )


def step5(w: Column) -> Column:
    pat = "^(.+?)e$"
    stem = _split(w, pat, 1)
    drop_e = stem.rlike(M_GT1) | (stem.rlike(M_EQ1) & ~stem.rlike(CVC))
    return F.when(w.rlike(pat) & drop_e, stem).otherwise(w)


def step5b(w: Column) -> Column:
    return F.when(w.rlike("ll$") & w.rlike(M_GT1), _drop_last(w)).otherwise(w)


STEPS = [step1a, step1b, step1c, step2, step3, step4, step5, step5b]


def stem_table(words: DataFrame, col: str = "term", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(term, stem)`` for a table of distinct lower-case words, with the columns of ``keep`` before ``stem``.

    Each step is its own projection column; Spark keeps the projections apart because
    the regular expressions are not cheap to duplicate, so the plan stays linear.
    """
    cur = "_s0"
    df = words.select(F.col(col).alias(col), *keep, F.regexp_replace(F.col(col), "^y", "Y").alias(cur))
    for i, step in enumerate(STEPS, start=1):
        nxt = f"_s{i}"
        df = df.select(col, *keep, step(F.col(cur)).alias(nxt))
        cur = nxt
    return df.select(col, *keep, F.when(F.length(col) < 3, F.col(col)).otherwise(F.lower(F.col(cur))).alias("stem"))
