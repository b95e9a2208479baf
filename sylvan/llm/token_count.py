"""Token counts with a digest cache.

The cache is a Parquet table ``(version, digest, n_tokens)``. ``version`` digests the tokenizer
file, the library version and the options; ``digest`` digests the normalised content (runs of
ASCII blanks become one space, ends trimmed: the tokenizer drops white space, so the count is
the same). Documents are joined to the stored counts by digest; only digests without a count
are encoded, one representative document each, and their counts are appended.

A null text counts as empty: 0 bytes, 0 tokens. Repeated rows share one digest and are encoded
once. A null id stays null. An empty table appends nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm.common import map_text, pick
from sylvan.llm.wordbpe import word_counts
from sylvan.session import write_table

CACHE_SCHEMA = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)


def tokenizer_version(path: str) -> str:
    """Digest of everything the counts depend on: the file, the library and the options."""
    import tokenizers

    with open(path, "rb") as f:
        body = hashlib.sha256(f.read()).hexdigest()
    return hashlib.sha256(f"{body} tokenizers-{tokenizers.__version__} no-special".encode()).hexdigest()


def content_digest(text) -> F.Column:
    """Digest of the normalised content. Only white space is folded, and only such white space
    as the tokenizer drops; case and combining marks are left to the tokenizer."""
    folded = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\r]+", " "))
    return F.unhex(F.sha2(folded, 256))


def read_cache(spark, cache_dir: str) -> DataFrame:
    """The stored counts; an absent cache is an empty one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_dir)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    if not there:
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache_dir)


def token_counts(
    df: DataFrame, tokenizer_path: str, cache_dir: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens``; new counts are appended to the cache.

    Texts move once: each distinct miss is found on (digest, row) pairs, and the representatives
    pick their text up in a hash join whose small side is built. A hot digest (a third of all
    rows) is combined before the shuffle, and its rows join one count (AQE splits them).
    """
    spark = df.sparkSession
    version = tokenizer_version(tokenizer_path)
    # A row is known by id and digest: ids may be null or repeat.
    docs = pick(df, doc_id=id_col, text=text_col)
    digested = docs.select("doc_id", content_digest(F.col("text")).alias("digest"), "text")
    keyed = write_table(
        digested.select("doc_id", "digest", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")),
        "token-digests",
    )
    stored = read_cache(spark, cache_dir).filter(F.col("version") == version)
    # (a concurrent writer may have added the same count twice)
    stored = write_table(stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-cache")
    misses = keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).join(stored, "digest", "left_anti")
    same = digested["digest"].eqNullSafe(misses["digest"]) & digested["doc_id"].eqNullSafe(misses["doc_id"])
    texts = digested.join(misses.hint("shuffle_hash"), same, "left_semi").select("digest", "text")

    def per_slice(batch: list[bytes]) -> dict[str, list]:
        count = word_counts(tokenizer_path).count
        return {"n_tokens": [count(t) for t in batch]}

    counted = map_text(texts, per_slice, [("n_tokens", T.LongType())], keep=("digest",))
    new = write_table(counted.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-misses")
    new.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache_dir)
    counts = stored.unionByName(new)
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
