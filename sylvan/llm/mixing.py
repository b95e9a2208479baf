"""Mixing sources to target weights. DataFrame expressions only.

Sizes are summed per source, targets derived by water-filling (share by weight, stop at
``MAX_RATE`` times the source, reshare the excess), and each document is taken floor(rate)
times plus once more with probability equal to the fraction, drawn from a hash of its id.

A null text has size 0; a null source is a source of its own, last in order. A document
without an id draws from its text's digest. Repeated rows draw alike. Without any word all
targets are 0 and nothing is taken. Equal shares of the water-filling are ties without effect. Very long texts
count whole. Extra columns keep their values, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import free_name, pick
from sylvan.operators.features import maybe_broadcast
from sylvan.operators.ordered import dense_index
from sylvan.session import write_table

WEIGHTS = (3, 1, 2)  # by the source's place in code-point order, repeating
TOTAL_SHARE = 1.5  # of all sizes
MAX_RATE = 2  # a target is at most this many times its source
SEED = "mix-42"
_DIGITS = 13  # hex digits of the draw: 52 bits, exact in a double


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the document alone."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))
    head = F.substring(F.md5(F.concat(F.lit(seed + "|"), key)), 1, _DIGITS)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(float(16**_DIGITS))


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target, rate`` from ``(source, size)`` rows.

    The sources' table stays distributed. Each round of the water-filling is one aggregate
    over it: the driver holds the level (target per unit of weight), nothing per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # null sources sort first in Spark: ordered by (is null, name) they come last
    flagged = totals.select(F.struct(F.col("source").isNull().alias("none"), "source").alias("place"), "source", "source_size")
    placed = dense_index(flagged, "place", "at", start=0)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("at") % len(WEIGHTS) + 1).cast("int"))
    table = write_table(placed.select("source", "source_size", weight.cast("double").alias("weight")), "mix-sources")
    cap = F.lit(float(MAX_RATE)) * F.col("source_size")
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= cap
        got = table.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, cap).otherwise(0.0)).alias("stopped"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not got["open"]:
            break
        new = (TOTAL_SHARE * got["all"] - got["stopped"]) / got["open"]
        if level is not None and new <= level:
            break
        level = new
    target = F.least(F.col("weight") * F.lit(level or 0.0), cap)
    out = table.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return out.select("source", "source_size", "target", rate.alias("rate"))


def with_copies(df: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", seed: str = SEED, copies_col: str = "mix_copies") -> DataFrame:
    """``df`` plus ``copies_col``, a new column: how often the mix takes each row.

    The targets hold one row per source; they are broadcast when that count is small, else
    joined by a shuffle whose hot sources AQE splits.
    """
    if copies_col.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the table has a column {copies_col!r} of its own")
    of, rate_of = free_name(df, "mix_source"), free_name(df, "mix_rate")
    small = targets.select(F.col("source").alias(of), F.col("rate").alias(rate_of))
    small = maybe_broadcast(small, targets.count(), 256)
    joined = df.join(small, df[source_col].eqNullSafe(small[of]), "left")
    rate = F.col(rate_of)
    extra = F.when(draw(df[id_col], df[text_col], seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn(copies_col, (F.floor(rate) + extra).cast("int")).drop(of, rate_of)


def mix_plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, rate, copies``."""
    docs = pick(df, doc_id=id_col, text=text_col, source=source_col)
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text")).alias("u"))
    sized = write_table(sized, "mix-sizes")
    targets = write_table(source_targets(sized), "mix-targets")
    small = targets.withColumnRenamed("source", "target_source")
    small = maybe_broadcast(small, targets.count(), 256)
    rows = sized.join(small, F.col("source").eqNullSafe(F.col("target_source")))
    whole = F.floor("rate")
    copies = whole + F.when(F.col("u") < F.col("rate") - whole, 1).otherwise(0)
    return rows.select("doc_id", "source", "size", "source_size", "target", "rate", copies.cast("bigint").alias("copies"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed rows of ``df``: each repeated as often as its source's rate and its draw say."""
    sizes = df.select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
    targets = write_table(source_targets(sizes), "mix-targets")
    copies, number = free_name(df, "mix_copies"), free_name(df, "mix_number")
    out = with_copies(df, targets, id_col, text_col, source_col, copies_col=copies).filter(F.col(copies) > 0)
    numbered = out.withColumn(number, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return numbered.select(*df.columns)
