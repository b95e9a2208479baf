"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The trie holds the UTF-8 bytes of the pieces in two integer arrays: a node's child for byte c
is ``base[node] + c + 1`` where ``check`` names the node. Viterbi runs over the bytes of a
segment; a character without a piece costs ``UNKNOWN_PENALTY`` below the worst score and is
written as byte pieces. The white-space marker is kept as a plain space inside (pieces are
translated once), a space is put before the text, and decoding takes it off again.

If no piece holds a space after another character (checked on load), the best path of a text is
that of its segments ``spaces + word``, each of which is solved once per worker (bounded memo);
with any other vocabulary the text is one segment.

Null and empty texts give no tokens and decode to ''. Texts of any length are encoded whole.
Repeated rows each get their own result; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from array import array
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sylvan.llm.common import map_text, pick

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
#: Memoised segments per worker, and the longest one that is kept.
MEMO_LIMIT, MEMO_BYTES = 400_000, 64
#: Segments solved at once.
BATCH = 1 << 13


@dataclass
class Vocabulary:
    """Pieces as bytes (marker as space; a byte piece is its byte), scores, and what they are."""

    pieces: list[bytes]
    scores: list[float]
    normal: list[bool]  # in the trie
    byte_ids: list[int]  # id of each byte piece, or -1 throughout
    unknown: int


def load_vocabulary(path: str, scores: str = "zipf") -> Vocabulary:
    """Reads a ``.model`` file. ``scores="stored"``: log scores as they are (a unigram model).
    ``"zipf"``: for a BPE model, whose stored scores are merge ranks -r and no probabilities,
    the log probability 1/((r + 2) H) of Zipf's law at that rank (pieces stored as unreachable,
    the bare markers, rank last: a unigram path may need them)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    harmonic = math.log(n) + 0.5772156649
    pieces, out, normal, byte_ids = [], [], [], [-1] * 256
    for i in range(n):
        s, score = sp.id_to_piece(i), sp.get_score(i)
        special = sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        if sp.is_byte(i):
            b = int(s[3:5], 16)
            byte_ids[b] = i
            pieces.append(bytes([b]))
        else:
            pieces.append(b"" if special else s.replace(MARKER, " ").encode())
        if scores == "zipf" and not special:
            score = -math.log((2 - max(score, -n)) * harmonic)
        out.append(float(score))
        normal.append(not special)
    return Vocabulary(pieces, out, normal, byte_ids, max(0, sp.unk_id()))


@dataclass
class DoubleArray:
    base: array
    check: array
    value: array  # piece id at a node, or -1


def build(keys: list[tuple[bytes, int]]) -> DoubleArray:
    """Double-array trie of distinct keys, breadth first; a base is searched from where the last
    one of a similar fan-out was found."""
    keys = sorted(keys)
    size = max(1 << 12, 8 * sum(len(k) for k, _ in keys) + 4096)
    base, check, value = (np.full(size, x, np.int32) for x in (0, -1, -1))
    free = np.ones(size, bool)
    free[0] = False
    check[0] = 0
    queue = [(0, 0, len(keys), 0)]
    used = 1
    since = [1] * 10  # by size class of the fan-out: where the last search ended
    for node, lo, hi, depth in queue:
        while lo < hi and len(keys[lo][0]) == depth:
            value[node] = keys[lo][1]
            lo += 1
        if lo == hi:
            continue
        starts, codes = [], []
        for i in range(lo, hi):
            c = keys[i][0][depth] + 1
            if not codes or codes[-1] != c:
                codes.append(c)
                starts.append(i)
        offsets = np.array(codes)
        kind = len(codes).bit_length()
        b = since[kind]
        while True:
            fits = free[np.arange(b, b + 64)[:, None] + offsets].all(1)
            if fits.any():
                b += int(fits.argmax())
                break
            b += 64
        since[kind] = base[node] = b
        free[b + offsets] = False
        check[b + offsets] = node
        used = max(used, b + codes[-1] + 1)
        for c, s, e in zip(codes, starts, [*starts[1:], hi], strict=True):
            queue.append((b + c, s, e, depth + 1))
    end = used + 257
    return DoubleArray(*(array("i", x[:end].tolist()) for x in (base, check, value)))


class Encoder(dict):
    """Encodes texts; as a dict, the memo of segments (bytes to packed ids)."""

    def __init__(self, vocabulary: Vocabulary, trie: DoubleArray | None = None):
        v = self.vocabulary = vocabulary
        trie = trie or build_trie(v)
        self.base, self.check, self.value = (list(x) for x in (trie.base, trie.check, trie.value))
        self.np_base, self.np_check, self.np_value = (np.array(x, np.int32) for x in (trie.base, trie.check, trie.value))
        self.np_scores = np.array(v.scores)
        self.code = "H" if len(v.pieces) <= 1 << 16 else "I"
        usual = [s for s, n in zip(v.scores, v.normal, strict=True) if n and s > -1e8]
        self.unknown = min(usual, default=0.0) - UNKNOWN_PENALTY
        crossing = any(b" " in p.lstrip(b" ") for p, n in zip(v.pieces, v.normal, strict=True) if n)
        self.segments = re.compile(rb"(?s).+" if crossing else rb" +[^ ]*").findall

    def viterbi(self, seg: bytes) -> list[int]:
        """Ids of the best path. Among equal scores the path whose last piece begins first."""
        base, check, value, scores = self.base, self.check, self.value, self.vocabulary.scores
        n = len(seg)
        best = [-math.inf] * (n + 1)
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        best[0] = 0.0
        i = 0
        while i < n:
            lead = seg[i]
            end = min(n, i + (1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4))
            here, node, single = best[i], 0, False
            for j in range(i, n):
                child = base[node] + seg[j] + 1
                if check[child] != node:
                    break
                node = child
                piece = value[node]
                if piece >= 0:
                    score = here + scores[piece]
                    if j + 1 == end:
                        single = True
                    if score > best[j + 1]:
                        best[j + 1] = score
                        back[j + 1] = (i, piece)
            if not single and here + self.unknown > best[end]:
                best[end] = here + self.unknown
                back[end] = (i, -1)
            i = end
        path: list[int] = []
        byte_ids, at = self.vocabulary.byte_ids, n
        while at:
            start, piece = back[at]
            if piece >= 0:
                path.append(piece)
            elif byte_ids[0] < 0:
                path.append(self.vocabulary.unknown)
            else:
                path.extend(byte_ids[b] for b in reversed(seg[start:at]))
            at = start
        return path[::-1]

    def viterbi_many(self, segs: list[bytes]) -> list[bytes]:
        """Packed ids of each segment: ``viterbi`` for all of them at once, one start byte and one
        trie step at a time over the whole batch (segments of similar length together)."""
        out: list[bytes] = [b""] * len(segs)
        order = sorted(range(len(segs)), key=lambda k: len(segs[k]))
        for lo in range(0, len(order), BATCH):
            part = order[lo : lo + BATCH]
            for k, ids in zip(part, self._batch([segs[k] for k in part]), strict=True):
                out[k] = ids
        return out

    def _batch(self, segs: list[bytes]) -> list[bytes]:
        n, width = len(segs), max(map(len, segs))
        lens = np.fromiter(map(len, segs), np.int64, n)
        text = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in segs), np.uint8).reshape(n, width).astype(np.int32)
        char = np.where(text < 0x80, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        origin = np.zeros((n, width + 1), np.int32)
        chosen = np.full((n, width + 1), -1, np.int32)
        for i in range(width):
            rows = np.flatnonzero((lens > i) & ((text[:, i] & 0xC0) != 0x80))
            here, end = best[rows, i], np.minimum(i + char[rows, i], lens[rows])
            single = np.zeros(len(rows), bool)
            alive, node = np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for j in range(i, width):
                child = self.np_base[node] + text[rows[alive], j] + 1
                ok = (self.np_check[child] == node) & (lens[rows[alive]] > j)
                alive, node = alive[ok], child[ok]
                if not len(alive):
                    break
                piece = self.np_value[node]
                hit = piece >= 0
                at, got = alive[hit], piece[hit]
                single[at[end[at] == j + 1]] = True
                score = here[at] + self.np_scores[got]
                better = score > best[rows[at], j + 1]
                r = rows[at[better]]
                best[r, j + 1], origin[r, j + 1], chosen[r, j + 1] = score[better], i, got[better]
            lost = np.flatnonzero(~single)
            score = here[lost] + self.unknown
            better = score > best[rows[lost], end[lost]]
            r, e = rows[lost[better]], end[lost[better]]
            best[r, e], origin[r, e], chosen[r, e] = score[better], i, -1
        at, rows, steps = lens.copy(), np.arange(n), []
        unknown = np.zeros(n, bool)
        while len(rows):
            got = chosen[rows, at[rows]]
            unknown[rows[got < 0]] = True
            steps.append((rows, got))
            at[rows] = origin[rows, at[rows]]
            rows = rows[at[rows] > 0]
        # steps run from the last piece to the first
        row = np.concatenate([r for r, _ in steps[::-1]])
        flat = np.concatenate([g for _, g in steps[::-1]])[np.argsort(row, kind="stable")].astype(self.code)
        ends = np.cumsum(np.bincount(row, minlength=n)) * flat.itemsize
        raw, begin, out = flat.tobytes(), 0, []
        for k, end in enumerate(ends.tolist()):
            out.append(array(self.code, self.viterbi(segs[k])).tobytes() if unknown[k] else raw[begin:end])
            begin = end
        return out

    def learn(self, segments: set[bytes]) -> None:
        """Solves the segments that the memo lacks."""
        missing = [s for s in segments if s not in self and len(s) <= MEMO_BYTES]
        if len(self) + len(missing) > MEMO_LIMIT:
            self.clear()
            missing = [s for s in segments if len(s) <= MEMO_BYTES]
        if missing:
            self.update(zip(missing, self.viterbi_many(missing), strict=True))

    def __missing__(self, seg: bytes) -> bytes:
        return array(self.code, self.viterbi(seg)).tobytes()

    def encode_many(self, texts: list[bytes]) -> list[np.ndarray]:
        marker = MARKER.encode()
        split = [self.segments(b" " + t.replace(marker, b" ")) if t else [] for t in texts]
        self.learn(set().union(*split))
        return [np.frombuffer(b"".join(map(self.__getitem__, s)), self.code) for s in split]

    def encode(self, text: bytes) -> np.ndarray:
        return self.encode_many([text])[0]

    def decode(self, ids) -> str:
        """Text of the ids: byte pieces join to characters (an invalid run becomes U+FFFD)."""
        line = b"".join(map(self.vocabulary.pieces.__getitem__, ids))
        return line.removeprefix(b" ").decode("utf-8", "replace")


def build_trie(v: Vocabulary) -> DoubleArray:
    return build([(p, i) for i, (p, n) in enumerate(zip(v.pieces, v.normal, strict=True)) if n])


FIELDS = [
    ("n_tokens", T.LongType()),
    ("n_byte_tokens", T.LongType()),
    ("score", T.DoubleType()),
    ("ids", T.ArrayType(T.IntegerType())),
    ("round_trip", T.BooleanType()),
]


def encode(df: DataFrame, model_path: str, scores: str = "zipf", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ids of the best path, their score, how many are byte pieces, and
    whether decoding gives the text back (the marker character itself decodes to a space). A
    map-only pass; trie and scores (bounded by the vocabulary file) go out with the task."""
    vocabulary = load_vocabulary(model_path, scores)
    trie = build_trie(vocabulary)
    made: list[tuple] = []

    def per_slice(texts: list[bytes]) -> dict[str, list]:
        if not made:
            is_byte = np.zeros(len(vocabulary.pieces), bool)
            is_byte[[i for i in vocabulary.byte_ids if i >= 0]] = True
            made.append((Encoder(vocabulary, trie), np.array(vocabulary.scores), is_byte))
        enc, score_of, is_byte = made[0]
        ids = enc.encode_many(texts)
        back = [enc.decode(x.tolist()) for x in ids]
        marker = MARKER.encode()
        same = [b.encode() == (t.replace(marker, b" ") if marker in t else t) for b, t in zip(back, texts, strict=True)]
        return {
            "n_tokens": [len(x) for x in ids],
            "n_byte_tokens": [int(is_byte[x].sum()) for x in ids],
            "score": [float(score_of[x].sum()) for x in ids],
            "ids": [x.astype(np.int32) for x in ids],
            "round_trip": same,
        }

    return map_text(pick(df, doc_id=id_col, text=text_col), per_slice, FIELDS)


def decode(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from arrays of ids; a null array decodes to ''."""
    import pyarrow as pa

    vocabulary = load_vocabulary(model_path)
    pieces = vocabulary.pieces
    src = pick(df, doc_id=id_col, ids=ids_col)
    schema = T.StructType([src.schema["doc_id"], T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            lines = [b"".join(map(pieces.__getitem__, x or ())) for x in batch.column(1).to_pylist()]
            texts = [x.removeprefix(b" ").decode("utf-8", "replace") for x in lines]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return src.mapInArrow(run, schema)
