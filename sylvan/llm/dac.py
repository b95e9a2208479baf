"""Token-id output in directly addressable codes.

A code splits each id into chunks of ``CHUNK_BITS`` bits, lowest first, one level per chunk.
Every level has the chunks of those ids that reach it and a continuation bitmap; the rank of
an id's bit in that bitmap is its place on the next level. A rank directory holds the number
of ones before every ``RANK_BITS`` bits, so any id is read by one look per level, without
decoding its block.

Files are Parquet rows, one code of up to ``BLOCK_IDS`` ids (or one longer document) each, in
ascending document order: partition, then block number. Spark writes them, so they lie
wherever Spark's file systems do.

Null and empty texts are the end id alone. Null ids come first; rows with equal ids follow
each other (by text digest; equal rows in any order). An empty table writes no code.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm.common import T_to_arrow, pick, slices, text_bytes
from sylvan.llm.wordbpe import word_ids
from sylvan.operators.ordered import running_sums, write_ranged
from sylvan.session import shuffle_partitions

CHUNK_BITS = 8
RANK_BITS = 512
BLOCK_IDS = 1 << 16
MAGIC = b"DAC1"


def pack(ids: np.ndarray) -> bytes:
    """The code of an id array: header, then per level its length, chunks, bitmap, rank directory."""
    levels = []
    v = ids.astype(np.uint32)
    while True:
        more = v >> CHUNK_BITS > 0
        chunks = (v & ((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        bitmap = np.packbits(more, bitorder="little")
        per = np.add.reduceat(np.bitwise_count(bitmap), np.arange(0, len(bitmap), RANK_BITS // 8)) if len(bitmap) else bitmap
        ranks = (np.cumsum(per, dtype=np.uint32) - per).astype("<u4")
        levels.append(struct.pack("<I", len(v)) + chunks.tobytes() + bitmap.tobytes() + ranks.tobytes())
        v = v[more] >> CHUNK_BITS
        if not len(v):
            return MAGIC + struct.pack("<IB", len(ids), len(levels)) + b"".join(levels)


class Code:
    """Reader of one code."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a directly addressable code")
        self.n, n_levels = struct.unpack_from("<IB", raw, 4)
        at = 9
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<I", raw, at)
            chunks = np.frombuffer(raw, np.uint8, n, at + 4)
            n_map = (n + 7) // 8
            bitmap = np.frombuffer(raw, np.uint8, n_map, at + 4 + n)
            n_ranks = -(-n_map // (RANK_BITS // 8))
            ranks = np.frombuffer(raw, "<u4", n_ranks, at + 4 + n + n_map)
            self.levels.append((chunks, bitmap, ranks))
            at += 4 + n + n_map + 4 * n_ranks

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """Any id, by one chunk and at most one rank per level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level, (chunks, bitmap, ranks) in enumerate(self.levels):
            out |= int(chunks[i]) << (CHUNK_BITS * level)
            byte, bit = divmod(i, 8)
            if not bitmap[byte] >> bit & 1:
                break
            block = i // RANK_BITS
            inside = bitmap[block * RANK_BITS // 8 : byte]
            i = int(ranks[block]) + int(np.bitwise_count(inside).sum()) + int(bitmap[byte] & ((1 << bit) - 1)).bit_count()
        return out

    def all(self) -> np.ndarray:
        """Every id, level by level from the top one down."""
        above = np.zeros(0, np.uint32)
        for chunks, bitmap, _ in reversed(self.levels):
            v = chunks.astype(np.uint32)
            more = np.unpackbits(bitmap, count=len(v), bitorder="little").astype(bool)
            v[more] |= above << CHUNK_BITS
            above = v
        return above


def write_codes(df: DataFrame, path: str, tokenizer_path: str, end_id: int,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes the texts and writes their codes under ``path``. Texts are shuffled once, by ranges
    of the id; a range is encoded as it streams by, one block in memory at a time."""
    docs = pick(df, doc_id=id_col, text=text_col)
    tie = F.xxhash64("text")
    ranged = docs.withColumn("tie", tie).repartitionByRange(shuffle_partitions(df.sparkSession), "doc_id", "tie")
    ranged = ranged.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("block", T.LongType()),
            T.StructField("n_ids", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("doc_sizes", T.ArrayType(T.LongType())),
            T.StructField("code", T.BinaryType()),
        ]
    )
    arrow = T_to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_ids(tokenizer_path)
        end = np.array([end_id], enc.code).tobytes()
        part = TaskContext.get().partitionId()
        ids: list = []
        packed: list[bytes] = []
        total = block = 0

        def flush() -> pa.RecordBatch:
            sizes = [len(p) // np.dtype(enc.code).itemsize for p in packed]
            code = pack(np.frombuffer(b"".join(packed), enc.code))
            row = [[part], [block], [sum(sizes)], [ids], [sizes], [code]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, arrow, strict=True)], schema=arrow)

        for whole in batches:
            for piece in slices(whole, "text"):
                for doc_id, text in zip(piece.column(0).to_pylist(), text_bytes(piece, "text"), strict=True):
                    ids.append(doc_id)
                    packed.append(enc.encode(text.decode("utf-8", "replace")) + end)
                    total += len(packed[-1])
                    if total >= BLOCK_IDS * np.dtype(enc.code).itemsize:
                        yield flush()
                        ids, packed, total, block = [], [], 0, block + 1
        if packed:
            yield flush()

    ranged.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)


def read_documents(spark, path: str, id_type: T.DataType) -> DataFrame:
    """One row per written document: ``doc_id, start, n_tokens, ids_crc32`` from the codes alone.

    ``start`` counts all ids of earlier documents: a running sum over the blocks (distributed),
    plus the place within the block.
    """
    sizes = T.ArrayType(T.LongType())
    schema = T.StructType().add("part", "integer").add("block", "long").add("n_ids", "long")
    schema = schema.add("doc_ids", T.ArrayType(id_type)).add("doc_sizes", sizes).add("code", "binary")
    files = spark.read.schema(schema).parquet(path)
    ranged = write_ranged(files.select("part", "block", "n_ids"), ["part", "block"], "dac-blocks")
    starts = running_sums(ranged, {"before": F.col("n_ids")}).select("part", "block", "before")

    out = T.StructType().add("part", "integer").add("block", "long").add("doc_id", id_type).add("inside", "long")
    out = out.add("n_tokens", "long").add("ids_crc32", "long")
    arrow = T_to_arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                part, block, doc_ids, sizes, raw = (batch.column(c)[r].as_py() for c in range(5))
                flat = Code(raw).all().astype("<u4")
                ends = np.cumsum(sizes)
                begins = ends - sizes
                crcs = [zlib.crc32(flat[a:b]) for a, b in zip(begins, ends, strict=True)]
                n = len(doc_ids)
                cols = [[part] * n, [block] * n, doc_ids, begins, sizes, crcs]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    docs = files.select("part", "block", "doc_ids", "doc_sizes", "code").mapInArrow(run, out)
    joined = docs.join(starts, ["part", "block"])
    return joined.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


