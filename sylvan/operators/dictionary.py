"""Dictionaries: dense numbers for the distinct values of a column, and rows coded by them (K1).

Numbers follow the values' order, so comparing codes is comparing values. A dictionary is an
ordinary table; it is joined by broadcast when its checked size is small, else by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from sylvan.operators.features import maybe_broadcast
from sylvan.operators.ordered import dense_index
from sylvan.session import MAX_BROADCAST_BYTES, write_table

_ENTRY_BYTES = 64


def dictionary(df: DataFrame, value: str, code: str, start: int = 0, parts: int | None = None) -> DataFrame:
    """``value, code``: the distinct values (null is none) numbered from ``start`` in ascending order."""
    values = df.select(value).filter(F.col(value).isNotNull()).distinct()
    return write_table(dense_index(values, value, code, start=start, parts=parts), "dictionary")


def as_sets(df: DataFrame, column: str, values: DataFrame, value: str, rows: int, numbered: bool) -> DataFrame | None:
    """``df`` with the strings of its array ``column`` as the sorted set of those that ``values`` has: themselves, or
    (``numbered``) their places in ascending order from 0. ``values``: ``rows`` distinct strings. None above the
    broadcast budget (checked): its caller then joins.

    The sets are made where the rows are, by Arrow over batches: an explode, a join and a sort to gather
    the arrays again are not needed. What is broadcast are the values, as for a broadcast join."""
    size = values.agg(F.sum(F.octet_length(value)).alias("b"), F.count(F.lit(1)).alias("c")).first()
    if max((size["b"] or 0) + 4 * rows, rows * _ENTRY_BYTES) > MAX_BROADCAST_BYTES or size["c"] != rows:
        return None
    words = df.sparkSession.sparkContext.broadcast(sorted(r[0] for r in values.select(value).collect()))
    made = StructField(column, ArrayType(IntegerType() if numbered else StringType()))
    schema = StructType([made if f.name == column else f for f in df.schema.fields])
    return df.mapInArrow(_sets_of(words, column, numbered), schema)


def _sets_of(words, column: str, numbered: bool):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        known = pa.array(words.value, pa.string())
        n = max(len(known), 1)
        for b in batches:
            lists = b.column(column)
            at = pc.index_in(lists.flatten().cast(pa.string()), value_set=known)
            held = at.is_valid()
            row = pc.list_parent_indices(lists).filter(held).to_numpy().astype(np.int64)
            key = np.sort(pc.unique(pa.array(row * n + at.filter(held).to_numpy())).to_numpy())
            ends = np.searchsorted(key, np.arange(len(lists) + 1, dtype=np.int64) * n).astype(np.int32)
            items = pa.array((key % n).astype(np.int32))
            sets = pa.ListArray.from_arrays(pa.array(ends), items if numbered else known.take(items))
            yield pa.RecordBatch.from_arrays([sets if c == column else b.column(c) for c in b.schema.names], names=b.schema.names)

    return run


def encode(df: DataFrame, table: DataFrame, value: str, code: str, rows: int | None = None) -> DataFrame:
    """``df`` with the code of its ``value`` column (null for a value that the table lacks)."""
    t = table.select(F.col(value).alias("_dict_value"), F.col(code).alias(code))
    t = maybe_broadcast(t, table.count() if rows is None else rows, _ENTRY_BYTES)
    return df.join(t, F.col(value) == F.col("_dict_value"), "left").drop("_dict_value")


def decode(df: DataFrame, table: DataFrame, code: str, value: str, rows: int | None = None) -> DataFrame:
    """``df`` with the ``value`` that its ``code`` column stands for (null for a code that the table lacks)."""
    t = table.select(F.col(code).alias("_dict_code"), F.col(value).alias(value))
    t = maybe_broadcast(t, table.count() if rows is None else rows, _ENTRY_BYTES)
    return df.join(t, F.col(code) == F.col("_dict_code"), "left").drop("_dict_code")
