"""Cross-tokenizer alignment: the tokens of two tokenizers of one text, by merge-path partitioning.

A text is encoded by a byte-level BPE file (A, of a space and the text) and by a SentencePiece
file (B, which adds the space itself). Each token covers a range of bytes. Byte offsets where
tokens of both end cut the text into groups; the two tokens that end there are a link.

The ends of A and of B are two ascending lists. ``merge_path`` divides their merging into pieces
of equal work: a binary search along each diagonal of the merge grid finds how many ends of
either list lie before it. A piece then looks at its own ends alone and emits the ends that both
have; a pair of equal ends that a border separates is stitched afterwards. The texts of a batch are
laid one after another, so long and short ones share pieces alike (a text's own end is a common
end, hence no group crosses texts).

Links are counted over the corpus for each pair of ids (combined in each document first); a
document's sums come from a join of its distinct pairs with those counts.

A text that is null or empty, or whose bytes one tokenizer does not give back (normalised or
unknown characters), has no tokens: all numbers 0, groups ''. Repeated rows and ids are rows of
their own and all count; null ids are kept. Very long texts are encoded whole. Ties: all ids that
share the highest count of a B id are best. Extra columns are not read, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm.common import T_to_arrow, pick, slices, text_bytes
from sylvan.llm.wordbpe import Memo, WordIds
from sylvan.llm.wordbpe import _byte_alphabet as byte_alphabet
from sylvan.operators.features import maybe_broadcast
from sylvan.session import write_table

#: Ends (of both lists together) that a piece of the merge holds.
PIECE_ENDS = 4096
#: Text bytes encoded and merged at a time.
BATCH_BYTES = 1 << 20
_MARK = "▁"
#: A pair of ids as one number: A's id above, B's below.
_B_BITS = 20


# ---- merge path --------------------------------------------------------------------------


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE_ENDS) -> tuple[np.ndarray, np.ndarray]:
    """How many elements of ascending ``a`` and ``b`` lie before each border between pieces.

    Border k is the diagonal ``i + j = k * piece`` of the merge grid; ``i`` is found by binary search
    (all diagonals at once; equal elements of ``a`` come first)."""
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, piece), total)
    lo, hi = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        first = np.zeros(len(d), bool)
        first[open_] = a[mid[open_]] <= b[(d - 1 - mid)[open_]]
        lo = np.where(open_ & first, mid + 1, lo)
        hi = np.where(open_ & ~first, mid, hi)
    return lo, d - lo


def merge_piece(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` (ascending, no repeats) of the elements that both have."""
    at = np.searchsorted(b, a)
    inside = at < len(b)
    hit = np.flatnonzero(inside)
    hit = hit[b[at[hit]] == a[hit]]
    return hit, at[hit]


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE_ENDS) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of all common elements: the pieces' own, and those that a border parts."""
    i, j = merge_path(a, b, piece)
    found = []
    for k in range(len(i) - 1):
        x, y = merge_piece(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]])
        found.append((x + i[k], y + j[k]))
        # the last end of A before a border may equal the first end of B after it
        if 0 < i[k + 1] and j[k + 1] < len(b) and a[i[k + 1] - 1] == b[j[k + 1]]:
            found.append((i[k + 1 : k + 2] - 1, j[k + 1 : k + 2]))
    if not found:
        return i[:0], i[:0]
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


# ---- the two tokenizers ------------------------------------------------------------------


class PlainIds(WordIds):
    """Ids of a byte-level BPE file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tok.encode_special_tokens = True
        back = {c: b for b, c in byte_alphabet().items()}
        special = set(self.tok.get_added_tokens_decoder())
        vocab = {i: t for t, i in self.tok.get_vocab().items()}
        size = max(vocab, default=-1) + 1
        self.bytes = [b"" if i in special else bytes(back[c] for c in vocab.get(i, "")) for i in range(size)]

    def spaced(self, text: str) -> bytes:
        """Ids of a space and the text (packed)."""
        chunks = text.split(" ")
        if "" in chunks or any(map(str.isspace, chunks)):
            return self.whole(" " + text)
        return b"".join(map(self.__getitem__, chunks))


class PieceIds(Memo):
    """Ids of a SentencePiece BPE file. Where no piece has the space mark behind another character,
    no merge crosses a single space: such texts are encoded chunk by chunk, the chunks memoised."""

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(n)]
        self.code = "H" if n <= 1 << 16 else "I"
        self.by_chunk = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        self.bytes = [self._bytes(i, p) for i, p in enumerate(pieces)]

    def _bytes(self, i: int, piece: str) -> bytes:
        if self.sp.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_unused(i):
            return b""
        return piece.replace(_MARK, " ").encode()

    def whole(self, text: str) -> bytes:
        return array(self.code, self.sp.encode(text)).tobytes()

    solve = whole

    def spaced(self, text: str) -> bytes:
        chunks = text.split(" ")
        if not self.by_chunk or "" in chunks or _MARK in text:
            return self.whole(text)
        return b"".join(map(self.__getitem__, chunks))


@cache
def tokenizer_a(path: str) -> PlainIds:
    """The worker's own instance; it outlives a task."""
    return PlainIds(path)


@cache
def tokenizer_b(path: str) -> PieceIds:
    """The worker's own instance; it outlives a task."""
    return PieceIds(path)


# ---- documents ---------------------------------------------------------------------------


class Aligner:
    """Aligns batches of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = tokenizer_a(path_a), tokenizer_b(path_b)
        self.len_a = np.fromiter(map(len, self.a.bytes), np.int64, len(self.a.bytes))
        self.len_b = np.fromiter(map(len, self.b.bytes), np.int64, len(self.b.bytes))
        # an id with the sign behind it: within its side of a group, and at that side's end
        self.words = [s for i in range(len(self.a.bytes)) for s in (f"{i},", f"{i}|")]
        self.offset = len(self.words)
        self.words += [s for i in range(len(self.b.bytes)) for s in (f"{i},", f"{i};")]

    def encode(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and B, or none where the bytes differ from a space and the text."""
        none = np.zeros(0, np.int64)
        text = raw.decode("utf-8", "replace")
        if not text:
            return none, none
        a, b = (np.frombuffer(t.spaced(text), t.code).astype(np.int64) for t in (self.a, self.b))
        want = b" " + raw
        if self.len_a[a].sum() != len(want) or self.len_b[b].sum() != len(want) or not self.len_a[a].all() or not self.len_b[b].all():
            return none, none
        if any(b"".join(map(t.bytes.__getitem__, ids.tolist())) != want for t, ids in ((self.a, a), (self.b, b))):
            return none, none
        return a, b

    def align(self, texts: list[bytes]) -> list[tuple]:
        """For each text: ``n_a, n_b, n_groups, n_links, groups_sha256``, distinct pairs and how often each."""
        ids = [self.encode(t) for t in texts]
        counts_a, counts_b = (np.array([len(x[s]) for x in ids], np.int64) for s in (0, 1))
        a, b = (np.concatenate([x[s] for x in ids]) if ids else np.zeros(0, np.int64) for s in (0, 1))
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        ia, ib = common_ends(ends_a, ends_b)
        pairs = (a[ia] << _B_BITS) | b[ib]
        # group-major order of all tokens, A's before B's in each group
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[ia] = last_b[ib] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        starts_b = np.concatenate(([0], ib + 1))  # tokens of B in earlier groups
        starts_a = np.concatenate(([0], ia + 1))
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + starts_b[group_a]] = 2 * a + last_a
        code[np.arange(len(b)) + starts_a[group_b + 1]] = self.offset + 2 * b + last_b
        words = code.tolist()
        to_a, to_b = np.cumsum(counts_a), np.cumsum(counts_b)
        link_to = np.searchsorted(ia, to_a)  # links of this and the earlier texts
        out = []
        at = at_link = 0
        for i in range(len(texts)):
            n_a, n_b = int(counts_a[i]), int(counts_b[i])
            to, to_link = int(to_a[i] + to_b[i]), int(link_to[i])
            if n_a:
                line = "".join(map(self.words.__getitem__, words[at:to]))[:-1]
                digest = hashlib.sha256(line.encode()).hexdigest()
            else:
                digest = ""
            own, times = np.unique(pairs[at_link:to_link], return_counts=True)
            n = to_link - at_link
            out.append((n_a, n_b, n, n, digest, own, times))
            at, at_link = to, to_link
        return out


ROW_FIELDS = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()), ("groups_sha256", T.StringType())]


def aligned(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the ``ROW_FIELDS``, ``pairs`` (distinct linked pairs of ids) and ``times``
    (how often each)."""
    docs = pick(df, doc_id=id_col, text=text_col)
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, t) for n, t in ROW_FIELDS]])
    schema = schema.add("pairs", T.ArrayType(T.LongType())).add("times", T.ArrayType(T.IntegerType()))
    arrow = T_to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for whole in batches:
            aligner = aligner or Aligner(path_a, path_b)
            for part in slices(whole, "text", BATCH_BYTES):
                got = aligner.align(text_bytes(part, "text"))
                cols = [part.column(0).cast(arrow.field(0).type)]
                cols += [pa.array([r[k] for r in got], arrow.field(k + 1).type) for k in range(len(ROW_FIELDS))]
                sizes = np.concatenate(([0], np.cumsum([len(r[5]) for r in got]))).astype(np.int32)
                for k, f in ((5, "pairs"), (6, "times")):
                    kind = arrow.field(f).type
                    flat = np.concatenate([r[k] for r in got])
                    cols.append(pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat, kind.value_type, safe=False)).cast(kind))
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return docs.mapInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, total, best``: links of each id pair in the corpus, and whether no other A id is linked
    more often with its B id."""
    each = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    totals = write_table(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("total")), "align-pairs")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << _B_BITS) - 1))
    most = totals.groupBy(b_id.alias("b_id")).agg(F.max("total").alias("most"))
    named = totals.withColumn("b_id", b_id).join(most, "b_id")
    return named.select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def alignment(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``aligned`` with ``n_best`` (links whose pair is its B id's most frequent one) and ``count_sum``
    (over the links, their pair's count).

    The counts have one row per pair that occurs; they are broadcast when their checked size is
    small, else joined by a shuffle whose hot pairs AQE splits. A document's pairs lie in one task,
    so its sums are combined before they are shuffled."""
    rows = aligned(df, path_a, path_b, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    rows = write_table(rows, "align-rows", compression="zstd")
    counts = write_table(pair_counts(rows), "align-counts")
    counts = maybe_broadcast(counts, counts.count(), 40)
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    each = each.select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")).join(counts, "pair")
    times = F.col("times").cast("bigint")
    sums = each.groupBy("row").agg(
        F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"), F.sum(times * F.col("total")).alias("count_sum")
    )
    whole = rows.drop("pairs", "times").join(sums, "row", "left")
    zero = F.lit(0).cast("bigint")
    return whole.select(
        "doc_id", *[n for n, _ in ROW_FIELDS], F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum")
    )
