import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sylvan.llm import align as A
from sylvan.llm.queries import op11_token_align, tokenizer_path
from tests.llm.conftest import by_id

COLS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def paths():
    return tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


class Plain:
    """The libraries on whole texts, ends compared one by one."""

    def __init__(self, paths):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(paths[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        more = [x for x in range(256) if x not in own]
        self.byte = {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(more)}

    def one(self, text):
        if not text:
            return [], [], [], ""
        want = b" " + text.encode()
        a = self.a.encode(" " + text, add_special_tokens=False)
        a_bytes = [bytes(self.byte[c] for c in t) for t in a.tokens]
        ids, b = a.ids, self.b.encode(text)
        b_bytes = []
        for i in b:
            p = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            return [], [], [], ""
        ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        both = sorted(set(ends_a) & set(ends_b))
        links, parts, at = [], [], (0, 0)
        for e in both:
            i, j = ends_a.index(e, at[0]) + 1, ends_b.index(e, at[1]) + 1
            parts.append(",".join(map(str, ids[at[0] : i])) + "|" + ",".join(map(str, b[at[1] : j])))
            links.append((ids[i - 1], b[j - 1]))
            at = i, j
        return ids, b, links, hashlib.sha256(";".join(parts).encode()).hexdigest()

    def table(self, rows):
        done = [(i, *self.one(t)) for i, t in rows]
        counts = Counter(p for _, _, _, links, _ in done for p in links)
        best = {}
        for (_, b), n in counts.items():
            best[b] = max(best.get(b, 0), n)
        out = []
        for i, a, b, links, digest in done:
            hits = sum(counts[p] == best[p[1]] for p in links)
            out.append((i, len(a), len(b), len(links), len(links), hits, sum(counts[p] for p in links), digest))
        return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def test_query_against_the_libraries(spark, paths):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = Plain(paths).table(rows)
    assert by_id(op11_token_align(spark, sf), *COLS) == want
    assert sum(r[5] < r[4] for r in want) > 10 and sum(r[3] < r[2] for r in want) > 10


def test_odd_rows(docs, rows, empty, paths):
    want = Plain(paths).table([(i, t) for i, t, _ in rows])
    assert by_id(A.alignment(docs, *paths), *COLS) == want
    assert A.alignment(empty, *paths).count() == 0


_made = {}


def cached(make, paths):
    if make.__name__ not in _made:
        _made[make.__name__] = make(*paths)
    return _made[make.__name__]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab \n\t .,<|>é日▁\x00", "  ", " the", "<|endoftext|>", "<s>", "́", " ", "word"]), max_size=12).map("".join))
def test_any_text(text):
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    made = cached(A.Aligner, paths)
    n_a, n_b, n_groups, n_links, digest, _, _ = made.align([b"", text.encode(), b"x"])[1]
    a, b, links, want = cached(lambda *p: Plain(p), paths).one(text)
    assert (n_a, n_b, n_groups, n_links, digest) == (len(a), len(b), len(links), len(links), want)


def test_merge_path_pieces():
    rng = random.Random(3)
    for _ in range(200):
        a = np.array(sorted(rng.sample(range(60), rng.randint(0, 40))), np.int64)
        b = np.array(sorted(rng.sample(range(60), rng.randint(0, 40))), np.int64)
        for piece in (1, 2, 3, 7, 1000):
            i, j = A.merge_path(a, b, piece)
            # equal work, and what lies before a border is what a merge takes first
            assert (np.diff(i + j)[:-1] == piece).all() and (i[-1], j[-1]) == (len(a), len(b))
            merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                assert sum(s == 0 for _, s in merged[: x + y]) == x
            x, y = A.common_ends(a, b, piece)
            assert a[x].tolist() == b[y].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
