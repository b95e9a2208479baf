"""The registered query of each operator: its contract's columns over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm import align, dac, filter_audit, fixity, license_scan, merkle, mixing, multi_index, repetition, simhash, token_count, unigram, wrapper
from sylvan.session import scratch_path, write_table
from sylvan.sources.tables import read_table

MAX_TOKENS = 2048
END_ID = 2


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_license_scan(spark, sf) -> DataFrame:
    got = license_scan.license_scan(read_table(spark, sf, "documents"))
    joined = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    more = [F.array_join("expressions", "; ").alias("expressions"), "terms"]
    return got.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score", *more)


def op2_token_count(spark, sf) -> DataFrame:
    """With a cache of its own, so that each call counts every distinct content itself."""
    cache = scratch_path(spark, "token-cache")
    got = token_count.token_counts(read_table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"), cache)
    return got.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))


def op3_merkle_fingerprint(spark, sf) -> DataFrame:
    return merkle.compare_with_successor(read_table(spark, sf, "documents"))


def op4_html_extract(spark, sf) -> DataFrame:
    return wrapper.extract(read_table(spark, sf, "pages"))


def op5_quality_rules(spark, sf) -> DataFrame:
    got = repetition.quality_rules(read_table(spark, sf, "documents"))
    shares = [F.col("dup_ngram_chars")[i].alias(f"dup_chars_{n}") for i, n in enumerate(repetition.NGRAMS)]
    return got.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "dup_line_chars", *shares,
    )


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with fixed damage: pages whose id leaves 13 modulo 97 have their middle character
    changed, those that leave 5 modulo 389 are lost."""
    middle = (F.length("html") / 2).cast("int")
    flipped = F.concat(F.substring("html", F.lit(1), middle), F.lit("~"), F.substring("html", middle + 2, F.length("html")))
    hit = F.pmod("page_id", F.lit(97)) == 13
    return pages.withColumn("html", F.when(hit, flipped).otherwise(F.col("html")))


def op6_warc_fixity(spark, sf) -> DataFrame:
    """Audits a damaged replica of the archive of all pages; one row per record, with its place and
    where its range begins, and whether the descent found that the replicas differ in that range.
    Both are segment files of their own, read and hashed; lost records move all that follows them."""
    segments = fixity.write_segments(read_table(spark, sf, "pages"))
    lost = F.coalesce(F.pmod("page_id", F.lit(389)) == 5, F.lit(False))
    copied = fixity.copy_segments(segments, lambda pages: damaged(pages).filter(~lost))
    archive = write_table(fixity.read_archive(segments), "warc-a")
    replica = write_table(fixity.read_archive(copied), "warc-b")
    ranges, _ = fixity.descend(archive, replica)
    found = fixity.audit_records(archive, replica, ranges).filter("pos is not null").select(F.col("pos").alias("found_pos"), "status")
    rows = archive.select("*", *fixity.in_range()).join(ranges.withColumn("differs", F.lit(True)), ["name", "sub"], "left")
    rows = rows.join(found, F.col("pos") == F.col("found_pos"), "left")
    segment = F.floor(F.col("pos") / fixity.SEGMENT_BYTES).cast("bigint")
    return rows.select(
        "page_id",
        "url",
        segment.alias("segment"),
        (F.col("pos") - segment * fixity.SEGMENT_BYTES).alias("offset"),
        "length",
        F.col("digest").alias("sha256"),
        F.coalesce("status", F.lit("ok")).alias("status"),
        (F.col("start") + F.col("sub") * fixity.RANGE_BYTES).alias("range_start"),
        F.coalesce("differs", F.lit(False)).alias("range_differs"),
    )


def op7_source_mix(spark, sf) -> DataFrame:
    plan = mixing.mix_plan(read_table(spark, sf, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken, "copies")


def op8_sentencepiece(spark, sf) -> DataFrame:
    got = unigram.encode(read_table(spark, sf, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return got.select("doc_id", "n_tokens", "n_byte_tokens", "score", "ids", "round_trip")


def op9_simhash(spark, sf) -> DataFrame:
    got = simhash.near_duplicates(read_table(spark, sf, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_token_codes(spark, sf) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    path = scratch_path(spark, "dac")
    dac.write_codes(docs, path, tokenizer_path("byte_bpe_50k.json"), END_ID)
    return dac.read_documents(spark, path, docs.schema["doc_id"].dataType)


def op11_token_align(spark, sf) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return align.alignment(read_table(spark, sf, "documents"), *paths)


def op12_filter_audit(spark, sf) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def op13_embedding_dedup(spark, sf) -> DataFrame:
    return multi_index.near_duplicates(read_table(spark, sf, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_token_count, op3_merkle_fingerprint, op4_html_extract, op5_quality_rules,
        op6_warc_fixity, op7_source_mix, op8_sentencepiece, op9_simhash, op10_token_codes,
        op11_token_align, op12_filter_audit, op13_embedding_dedup,
    )
}
