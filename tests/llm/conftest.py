import os

import pytest

pytest.importorskip("sylvan.llm")
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, fp long, k string, tree string, digest string, "
    "n_words int, component_id string, score double, size string, host string, part int, copies int, root int"
)


@pytest.fixture(scope="session")
def rows():
    """Nulls everywhere, empty and long texts, repeated rows and ids, odd characters."""
    long = " ".join(f"word{i % 5000} Über{i}," for i in range(60_000))
    texts = [
        (1, "The quick brown fox jumps over the lazy dog and runs far away from here today.", "a"),
        (2, None, "a"),
        (3, "", None),
        (4, long, "b"),
        (5, "The quick brown fox jumps over the lazy dog and runs far away from here today.", "a"),
        (5, "The quick brown fox jumps over the lazy dog and runs far away from here today.", "a"),
        (6, "  \t\n ", "c"),
        (None, "a row without an id\n\nand a second section\nwith two lines", "c"),
        (None, None, None),
        (7, "x" * 5000, "d"),
        (8, "日本語 \U0001f600 é \x0b\x0c\x1c nul\x00 ﬁ İ <|endoftext|> ▁", "é"),
        (9, "All rights reserved. CC-BY\nSPDX-License-Identifier: (MIT OR GPL-2.0+) AND Apache-2.0", "d"),
        (10, "spam spam spam spam spam spam spam spam spam spam spam spam spam spam spam spam", "d"),
    ]
    return texts


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with extra columns whose names clash with internal ones."""
    full = [(i, t, None, s, None, 1, "k", "t", "d", 2, "c", 0.5, "s", "h", 3, 4, 5) for i, t, s in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.filter("1 = 0")


@pytest.fixture(scope="session")
def sample(spark):
    """The small documents table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def by_id(df, *cols):
    """Rows as sorted tuples (None first)."""
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))
