"""Shared helpers: column selection, Arrow batch loops, schemas."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Text bytes that one Python step holds as objects at a time (documents are never cut: one
#: longer text is a slice of its own).
SLICE_BYTES = 8 << 20


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under the operator's own names (extra columns cannot clash)."""
    return df.select(*[df[c].alias(name) for name, c in cols.items()])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive pieces of about ``limit`` text bytes, so memory stays bounded."""
    sizes = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
    start, total = 0, 0
    for i, n in enumerate(pc.binary_length(sizes).to_pylist()):
        total += n or 0
        if total > limit and i > start:
            yield batch.slice(start, i - start)
            start, total = i, n or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def text_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in col.cast(pa.large_binary()).to_pylist()]


def map_text(
    df: DataFrame,
    per_slice: Callable[[list[bytes]], dict[str, list]],
    fields: list[tuple[str, T.DataType]],
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One pass over the rows: the ``keep`` columns and what ``per_slice`` returns for the texts."""
    schema = T.StructType([df.schema[k] for k in keep] + [T.StructField(n, t) for n, t in fields])
    arrow = T_to_arrow(schema)
    names = [n for n, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, text):
                got = per_slice(text_bytes(part, text))
                cols = [part.column(part.schema.get_field_index(k)) for k in keep]
                cols = [c.cast(arrow.field(i).type) for i, c in enumerate(cols)]
                cols += [pa.array(got[n], arrow.field(n).type) for n in names]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return df.select(*keep, text).mapInArrow(run, schema)


def T_to_arrow(schema: T.StructType) -> pa.Schema:
    """Arrow schema of a Spark schema."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
