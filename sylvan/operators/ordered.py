"""Global order without a single-partition window: dense numbers, running sums, next key.

Every function range-partitions its input by the sort keys and **writes** it once (shared
folder, partition number and in-partition position stored as columns). Spark samples the
range borders anew for every exchange, so deriving counts from one exchange and rows from
another mixes two partitionings; the written files give one for all readers. What is
combined across partitions is one row per partition (and group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvan.session import shuffle_partitions, write_table

PID, POS = "_ord_pid", "_ord_pos"
_POS_BITS = 33  # monotonically_increasing_id: partition number above, position below


def write_ranged(df: DataFrame, keys: Sequence[str], name: str = "ranged", parts: int | None = None, **options: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys``, written, with ``_ord_pid`` and ``_ord_pos``."""
    n = parts or shuffle_partitions(df.sparkSession)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    mid = F.monotonically_increasing_id()
    tagged = ranged.withColumn(POS, mid)
    tagged = tagged.withColumn(PID, F.shiftright(POS, _POS_BITS)).withColumn(
        POS, F.col(POS).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    )
    return write_table(tagged, name, **options)


def dense_index(
    df: DataFrame, order_col: str, name: str = "idx", start: int = 1, partition_col: str | None = None, parts: int | None = None
) -> DataFrame:
    """``row_number() OVER ([PARTITION BY partition_col] ORDER BY order_col) - 1 + start``.

    Whole rows are kept. A hot group spans many range partitions and is never gathered into
    one task. Rows with equal keys get consecutive numbers in an unspecified order.
    """
    keys = ([partition_col] if partition_col else []) + [order_col]
    ranged = write_ranged(df, keys, "dense-index", parts)
    group = F.col(partition_col) if partition_col else F.lit(0)
    tagged = ranged.withColumn("_ord_grp", group)
    counts = tagged.groupBy(PID, "_ord_grp").agg(F.count(F.lit(1)).alias("_ord_cnt"), F.min(POS).alias("_ord_first"))
    before = Window.partitionBy("_ord_grp").orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(PID).alias("_ord_p"),
        F.col("_ord_grp").alias("_ord_g"),
        "_ord_first",
        F.coalesce(F.sum("_ord_cnt").over(before), F.lit(0)).alias("_ord_off"),
    )
    if partition_col is None:
        offsets = F.broadcast(offsets)  # one row per partition
    same = (F.col(PID) == F.col("_ord_p")) & F.col("_ord_grp").eqNullSafe(F.col("_ord_g"))
    out = tagged.join(offsets, same).withColumn(
        name, (F.col("_ord_off") + F.col(POS) - F.col("_ord_first") + F.lit(start)).cast("bigint")
    )
    return out.drop(PID, POS, "_ord_p", "_ord_g", "_ord_grp", "_ord_off", "_ord_first")


def running_sums(ranged: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Adds, for each ``name: expression``, the sum over all earlier rows of a ``write_ranged`` frame.

    One window per written partition (a bounded range of rows), plus the totals of the
    partitions before it: one row per partition, broadcast.
    """
    rows = ranged.select("*", *[e.alias(f"_ord_v_{k}") for k, e in sums.items()])
    totals = rows.groupBy(F.col(PID).alias("_ord_p")).agg(*[F.sum(f"_ord_v_{k}").alias(f"_ord_t_{k}") for k in sums])
    before = Window.orderBy("_ord_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select(
        "_ord_p", *[F.coalesce(F.sum(f"_ord_t_{k}").over(before), F.lit(0)).alias(f"_ord_o_{k}") for k in sums]
    )
    inside = Window.partitionBy(PID).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(F.broadcast(offsets), F.col(PID) == F.col("_ord_p"))
    for k in sums:
        out = out.withColumn(
            k, (F.col(f"_ord_o_{k}") + F.coalesce(F.sum(f"_ord_v_{k}").over(inside), F.lit(0))).cast("bigint")
        )
    return out.drop("_ord_p", *[f"_ord_o_{k}" for k in sums], *[f"_ord_v_{k}" for k in sums])


def with_next(ranged: DataFrame, cols: Sequence[str], prefix: str = "next_") -> DataFrame:
    """Adds ``next_<col>``: the columns of the following row of a ``write_ranged`` frame.

    The last row of a partition takes the first row of the next non-empty one; the very last
    row takes the very first.
    """
    row = F.struct(*cols)
    inside = Window.partitionBy(PID).orderBy(POS)
    firsts = ranged.groupBy(F.col(PID).alias("_ord_p")).agg(F.min_by(row, F.col(POS)).alias("_ord_first"))
    along = Window.orderBy("_ord_p")  # one row per partition
    wrap = F.first("_ord_first").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("_ord_p", F.coalesce(F.lead("_ord_first").over(along), wrap).alias("_ord_over"))
    out = ranged.withColumn("_ord_lead", F.lead(row).over(inside))
    out = out.join(F.broadcast(firsts), F.col(PID) == F.col("_ord_p"))
    nxt = F.coalesce("_ord_lead", "_ord_over")
    out = out.withColumn("_ord_nxt", nxt)
    return out.select("*", *[F.col("_ord_nxt")[c].alias(f"{prefix}{c}") for c in cols]).drop(
        "_ord_lead", "_ord_over", "_ord_nxt", "_ord_p"
    )
