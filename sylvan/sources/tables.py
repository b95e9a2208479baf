"""Driver tables and the labelled-text views built on them.

A labelled-text view has the columns ``doc_id, text, label`` (label as string).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class Profile:
    """Which table supplies text, label and id, and how it is cleaned."""

    name: str
    drop_accented: bool
    labels: tuple[str, ...] | None  # allowed label set (F1); None = every non-NULL label


PROFILES = {
    "lang": Profile("lang", drop_accented=False, labels=("de", "en", "es", "fr")),
    "toxic": Profile("toxic", drop_accented=True, labels=("0", "1")),
    "quality": Profile("quality", drop_accented=True, labels=("0", "1")),
    "role": Profile("role", drop_accented=False, labels=("assistant", "system", "user")),
}


def labelled_text(spark: SparkSession, sf_dir: str, profile: str) -> DataFrame:
    """The raw labelled rows of a profile: ``doc_id, text, label``."""
    if profile == "lang":
        d = read_table(spark, sf_dir, "documents")
        return d.select("doc_id", "text", F.col("lang").alias("label"))
    if profile in ("toxic", "quality"):
        d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
        lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col(profile).cast("string").alias("label"))
        return d.join(lab, "doc_id", "inner")
    if profile == "role":
        c = read_table(spark, sf_dir, "conversations")
        # composite key (conv_id, turn) as one exact string id
        doc_id = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
        return c.select(doc_id.alias("doc_id"), "text", F.col("role").alias("label"))
    raise ValueError(f"unknown profile {profile!r}")
