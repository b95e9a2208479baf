"""Filter interaction audit: what each filter removes, in every order of the filters.

A filter is a failure condition; a document's failures are a bit mask. Conditions of the text
alone are expressions. ``E`` (identical to an earlier document) is an existential self-join: a
left-semi join on hash, exact text and a smaller id. Its ids are united with the other failures
and summed up to one mask for each document. Masks are then counted per part, and everything
about every order is arithmetic on those counts (at most 32 for each part).

Only documents whose hash recurs take part in the self-join. The right side is one row per
distinct text, the smallest id; a text with many copies is dealt over salts, about
``COPIES_PER_SALT`` copies each, and its one row is repeated as often.

A null text counts as empty. A null source and the empty one are one part (''). A row without
an id is never a later copy and has no label; rows with equal ids are documents of their own
(neither is a later copy of the other). A document is good or toxic if any label row of its id
says so. No words: A holds, B does not (0 < 0). Very long texts are handled whole, as a row.
Extra columns, whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import pick
from sylvan.operators.features import maybe_broadcast
from sylvan.session import write_table

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
SYMBOLS = r"[#$%&*|]"
COPIES_PER_SALT = 1000

_BLANKS = r"[\x20\x09-\x0D]+"
_LATER = 1 << FILTERS.index("E")
_MASKS = 1 << len(FILTERS)
#: Orders of all filters in which one filter comes first among m failed ones: 5! / m.
_FIRST_OF = {m: 120 // m for m in range(1, len(FILTERS) + 1)}


def text_failures(text: Column) -> Column:
    """The mask of the conditions that the text alone decides (A to D)."""
    words = F.filter(F.split(text, _BLANKS), lambda w: w != "")

    def of(w: Column) -> Column:
        capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
        fails = [
            F.size(w) < MIN_WORDS,
            100 * F.size(F.array_distinct(w)) < DISTINCT_PERCENT * F.size(w),
            100 * capitals.cast("bigint") > CAPITAL_PERCENT * F.length(text),
            text.rlike(SYMBOLS),
        ]
        bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(fails)]
        return bits[0] + bits[1] + bits[2] + bits[3]

    return F.transform(F.array(words), of)[0]  # the words are split once


def later_copies(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """E: ``doc_id, part, hash`` of the documents whose text a smaller id has too.

    ``docs`` has ``doc_id, part, hash, text``, ``hashes`` the same without texts (written)."""
    recurring = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    salts = F.ceil(F.col("copies") / COPIES_PER_SALT).cast("int")
    recurring = write_table(recurring.select(F.col("hash").alias("_hash"), salts.alias("salts")), "audit-recurring")
    recurring = maybe_broadcast(recurring, recurring.count())
    rows = docs.join(recurring, F.col("hash") == F.col("_hash")).filter("doc_id is not null").drop("_hash")
    # one row per text (copies are combined before the shuffle), repeated for each salt
    first = rows.groupBy("hash", "text", "salts").agg(F.min("doc_id").alias("first_id"))
    first = first.select(
        F.col("hash").alias("_hash"), F.col("text").alias("_text"), "first_id",
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("_salt"),
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    earlier = (
        (F.col("hash") == F.col("_hash"))
        & (F.col("salt") == F.col("_salt"))
        & (F.col("text") == F.col("_text"))
        & (F.col("first_id") < F.col("doc_id"))
    )
    return salted.join(first, earlier, "left_semi").select("doc_id", "part", "hash")


def failure_masks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``doc_id, part, mask, n``: how many documents of an id and part fail in just that way."""
    docs = pick(df, doc_id=id_col, text=text_col, part=part_col)
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", F.coalesce("part", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("hash"), text.alias("text"))
    flags = write_table(docs.select("doc_id", "part", "hash", text_failures(F.col("text")).alias("mask")), "audit-flags")
    later = later_copies(docs, flags.select("doc_id", "part", "hash"))
    failed = flags.select("doc_id", "part", "hash", "mask", F.lit(1).alias("n")).unionByName(
        later.select("doc_id", "part", "hash", F.lit(_LATER).alias("mask"), F.lit(0).alias("n"))
    )
    # rows equal in id, part and text fail alike
    whole = failed.groupBy("doc_id", "part", "hash").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))
    return whole.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, good ones and toxic ones of each mask."""
    marks = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    named = masks.filter("doc_id is not null").join(marks.filter("doc_id is not null"), "doc_id", "left")
    zero = F.lit(None).cast("int")
    rows = named.select("part", "mask", "n", "good", "toxic").unionByName(
        masks.filter("doc_id is null").select("part", "mask", "n", zero.alias("good"), zero.alias("toxic"))
    )
    sums = [F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), *sums)


def orders() -> list[str]:
    return ["".join(p) for p in permutations(FILTERS)]


def audit_orders(counts: DataFrame) -> DataFrame:
    """One row per part, order and step, from ``part, mask, n, good, toxic``.

    A part's counts become arrays by mask; each order and step then sums the masks it concerns."""
    at = lambda c: [F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)) for m in range(_MASKS)]
    parts = counts.groupBy("part").agg(*[F.array(*at(c)).alias(c) for c in ("n", "good", "toxic")])
    rows = parts.withColumn("filter_order", F.explode(F.lit(orders()))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    flag = lambda i: F.expr(f"shiftleft(1, ascii(substring(filter_order, {i}, 1)) - {ord(FILTERS[0])})")
    earlier = F.lit(0)
    for i in range(1, len(FILTERS)):
        earlier = earlier + F.when(F.col("step") > i, flag(i)).otherwise(0)
    rows = rows.select("*", earlier.alias("before"), flag("step").alias("bit"))
    masks = F.array(*[F.lit(m) for m in range(_MASKS)])
    before, bit = F.col("before"), F.col("bit")

    def total(values: str, keep) -> Column:
        parts_ = F.transform(F.filter(masks, keep), lambda m: F.col(values)[m])
        return F.aggregate(parts_, F.lit(0).cast("bigint"), lambda a, x: a + x)

    fails = lambda m: m.bitwiseAND(bit) != 0
    gone = lambda m: m.bitwiseAND(before) != 0
    here = lambda m: fails(m) & ~gone(m)
    times = F.array(F.lit(0), *[F.lit(_FIRST_OF[m]) for m in sorted(_FIRST_OF)])
    shares = F.transform(F.filter(masks, fails), lambda m: F.col("n")[m] * times[F.bit_count(m)])
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        F.col("n")[bit].alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        F.aggregate(shares, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of all five filters over whole ``docs`` (doc_id, text, source), with ``labels``
    (doc_id, quality, toxic)."""
    lab = pick(labels, doc_id="doc_id", quality="quality", toxic="toxic")
    return audit_orders(write_table(mask_counts(failure_masks(docs), lab), "audit-masks"))
