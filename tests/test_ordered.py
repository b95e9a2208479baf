"""Global order helpers: whole rows, several files, ties of partitions, wrap-around."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sylvan.operators import ordered as O
from sylvan.session import write_table


def _rows(spark, n, parts):
    base = spark.range(n).select((F.col("id") * 7919 % n).alias("doc_id"), F.md5(F.col("id").cast("string")).alias("payload"))
    return write_table(base.repartition(parts), "test-rows")


def test_dense_index_keeps_whole_rows(spark):
    df = _rows(spark, 500_000, 11)
    got = O.dense_index(df, "doc_id", "idx", start=1)
    assert got.columns == ["doc_id", "payload", "idx"]
    assert got.count() == 500_000
    assert got.filter(F.col("idx") != F.col("doc_id") + 1).count() == 0
    assert got.select("idx").distinct().count() == 500_000


def test_dense_index_per_group_with_payload(spark):
    df = _rows(spark, 60_000, 7).withColumn("grp", F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("string")).otherwise("hot"))
    got = O.dense_index(df, "doc_id", "idx", start=0, partition_col="grp")
    want = df.withColumn("want", F.row_number().over(Window.partitionBy("grp").orderBy("doc_id")) - 1)
    joined = got.join(want.select("doc_id", "want"), "doc_id")
    assert joined.count() == 60_000 and joined.filter(F.col("idx") != F.col("want")).count() == 0


def test_running_sums_and_next(spark):
    df = _rows(spark, 20_000, 5)
    ranged = O.write_ranged(df, ["doc_id"])
    sums = O.running_sums(ranged, {"start": F.col("doc_id")})
    assert sums.filter(F.col("start") != (F.col("doc_id") * (F.col("doc_id") - 1) / 2).cast("bigint")).count() == 0
    nxt = O.with_next(ranged, ["doc_id", "payload"])
    assert nxt.filter(F.col("next_doc_id") != (F.col("doc_id") + 1) % 20_000).count() == 0


def test_empty_and_single(spark):
    df = _rows(spark, 1, 3)
    assert [r.next_doc_id for r in O.with_next(O.write_ranged(df, ["doc_id"]), ["doc_id"]).collect()] == [0]
    none = df.filter("doc_id < 0")
    assert O.dense_index(none, "doc_id").count() == 0
    assert O.running_sums(O.write_ranged(none, ["doc_id"]), {"s": F.col("doc_id")}).count() == 0
