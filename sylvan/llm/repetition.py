"""Quality rules: repetition coverage by rolling hashes in numpy.

For each n of ``NGRAMS`` a polynomial hash rolls over the document's word hashes (64 bits);
sorted, equal hashes show repeated n-grams. A character counts as duplicated when its word
lies in an n-gram equal to an *earlier* one of the same document. Lines count likewise. A
document is rejected when a share exceeds its limit.

A null or empty text has no words: all counts 0, ``base_failed`` true, not kept. Repeated rows
each get their own result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sylvan.llm.common import map_text, pick, slices, text_bytes

MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20  # of the words, in windows found twice or more
#: Most characters (percent of all word characters) in n-grams that repeat an earlier one.
NGRAMS = {5: 20, 6: 19, 7: 18, 8: 17, 9: 16, 10: 15}
#: Most characters (percent of all word characters) in lines equal to an earlier line.
DUP_LINE_CHARS = 30

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash
_SYMBOLS = b"#*$%&|<>"
_TAIL = bytes(range(0x80, 0xC0))  # UTF-8 bytes that do not begin a code point


def n_code_points(b: bytes) -> int:
    return len(b) if b.isascii() else len(b.translate(None, _TAIL))


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of ``n`` words."""
    if len(h) < n:
        return h[:0]
    out = h[: len(h) - n + 1].copy()
    with np.errstate(over="ignore"):
        for i in range(1, n):
            out *= _BASE
            out += h[i : len(h) - n + 1 + i]
    return out


def repeats(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows found twice or more, and of those equal to an earlier one."""
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return order[:0], order[:0]
    later = order[1:][same]
    return np.union1d(later, order[:-1][same]), later


def covered(starts: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Which words lie in the windows of ``n`` words at ``starts``."""
    edge = np.zeros(n_words + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(text: bytes) -> dict:
    words = text.split()
    n = len(words)
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    if text.isascii():
        chars = np.fromiter(map(len, words), np.int64, n)
    else:
        chars = np.fromiter(map(n_code_points, words), np.int64, n)
    word_chars = int(chars.sum())
    seen: set[bytes] = set()
    n_dup_lines = dup_line_chars = 0
    for line in text.split(b"\n"):
        if not line or line.isspace():
            continue
        if line in seen:
            n_dup_lines += 1
            dup_line_chars += n_code_points(b"".join(line.split()))
        else:
            seen.add(line)
    shares: dict[int, int] = {}
    n_repeat_words, quiet = 0, False
    for k in sorted({REPEAT_WINDOW, *NGRAMS}):
        if quiet:  # an n-gram that repeats holds shorter ones that repeat
            shares[k] = 0
            continue
        both, later = repeats(rolling(hashes, k))
        quiet = not len(later)
        shares[k] = 0 if quiet else int(chars[covered(later, k, n)].sum())
        if k == REPEAT_WINDOW and len(both):
            n_repeat_words = int(covered(both, k, n).sum())
    base_failed = n < MIN_WORDS or 100 * n_repeat_words > REPEAT_PERCENT * n
    failed = (
        any(100 * shares[k] > limit * word_chars for k, limit in NGRAMS.items())
        or 100 * dup_line_chars > DUP_LINE_CHARS * word_chars
    )
    return {
        "n_words": n,
        "word_chars": word_chars,
        "n_symbols": len(text) - len(text.translate(None, _SYMBOLS)),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words,
        "base_failed": base_failed,
        "kept": not (base_failed or failed),
        "dup_line_chars": dup_line_chars,
        "dup_ngram_chars": [shares[k] for k in NGRAMS],
    }


FIELDS = [
    ("n_words", T.LongType()),
    ("word_chars", T.LongType()),
    ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()),
    ("base_failed", T.BooleanType()),
    ("kept", T.BooleanType()),
    ("dup_line_chars", T.LongType()),
    ("dup_ngram_chars", T.ArrayType(T.LongType())),
]


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its counts, the duplicated characters per n of ``NGRAMS`` and
    the verdict. A map-only pass."""

    def per_slice(texts: list[bytes]) -> dict[str, list]:
        rows = [measure(t) for t in texts]
        return {n: [r[n] for r in rows] for n, _ in FIELDS}

    return map_text(pick(df, doc_id=id_col, text=text_col), per_slice, FIELDS)


def keep_good(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that pass, with all their columns, in one map-only pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, text_col):
                yield part.filter(pa.array([measure(t)["kept"] for t in text_bytes(part, text_col)], pa.bool_()))

    return df.mapInArrow(run, df.schema)
