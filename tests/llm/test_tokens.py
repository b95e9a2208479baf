import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sylvan.llm import dac, token_count, unigram, wordbpe
from sylvan.llm.queries import op2_token_count, op8_sentencepiece, op10_token_codes, tokenizer_path
from sylvan.session import scratch_path

ODD = st.text(st.one_of(st.sampled_from(list(" \t\n\x0b\x0c\r\x1c'’.,!<|>▁éÉßİﬁ́̌A1aZ\xa0 日😀")), st.characters(exclude_categories=["Cs"])))


@pytest.fixture(scope="module")
def counts():
    return wordbpe.WordCounts(tokenizer_path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def word_ids():
    return wordbpe.WordIds(tokenizer_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    return unigram.Encoder(unigram.load_vocabulary(tokenizer_path("piece_bpe_32k.model")))


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_words_equal_the_whole_text(counts, word_ids, text):
    assert counts.count(text.encode()) == len(counts.tok.encode(text, add_special_tokens=False))
    got = np.frombuffer(word_ids.encode(text), word_ids.code).tolist()
    assert got == word_ids.tok.encode(text, add_special_tokens=False).ids


LINES = st.lists(st.sampled_from(["Word", "été", "it", "s", "'", ".", "!?", "\n", "\n", " ", "\t", "<", "|", "12", "日"])).map("".join)


@settings(max_examples=300, deadline=None)
@given(LINES)
def test_line_ends_part_words(word_ids, text):
    got = np.frombuffer(word_ids.encode(text), word_ids.code).tolist()
    assert got == word_ids.tok.encode(text, add_special_tokens=False).ids


def test_words_equal_the_library_on_documents(counts, word_ids, sample, rows):
    texts = [r.text for r in sample.collect()] + [t or "" for _, t, _ in rows] + [
        "it's <|endoftext|> don't", "J̌ A̸", " x  y ", "a<|startoftext|>b", "x\n y", "x \n\n y", "12 3a",
        "one two.\nThree four,\nfive!\nsix", "a b\t\nc d'\ns e\n\nf g\n", "\na b\r\nc é.\nÉtat",
    ]
    for t, a, b in zip(texts, counts.tok.encode_batch(texts, add_special_tokens=False), word_ids.tok.encode_batch(texts, add_special_tokens=False), strict=True):
        assert counts.count(t.encode()) == len(a.ids)
        assert np.frombuffer(word_ids.encode(t), word_ids.code).tolist() == b.ids


def test_cache_is_filled_once(spark, docs, rows, empty, counts):
    path, cache = tokenizer_path("word_bpe_49k.json"), scratch_path(spark, "cache")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in token_count.token_counts(docs, path, cache).collect()), key=repr)
    want = [(i, len((t or "").encode()), len(counts.tok.encode(t or "", add_special_tokens=False))) for i, t, _ in rows]
    assert got == sorted(want, key=repr)
    stored = spark.read.parquet(cache)
    n = stored.count()
    assert n == stored.select("digest").distinct().count() == 8  # null, empty and blank texts share one digest, ids 1 and 5 another
    token_count.token_counts(docs, path, cache)
    assert spark.read.parquet(cache).count() == n  # all found
    more = spark.createDataFrame([(99, "a new text")], "doc_id long, text string")
    assert token_count.token_counts(more, path, cache).count() == 1 and spark.read.parquet(cache).count() == n + 1
    assert token_count.token_counts(empty, path, scratch_path(spark, "cache")).count() == 0


def test_token_count_query(spark, counts):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op2_token_count(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(counts.tok.encode(texts[r.doc_id], add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
def test_codes_give_every_id_back(ids):
    code = dac.Code(dac.pack(np.array(ids, np.uint32)))
    assert code.all().tolist() == ids and len(code) == len(ids)
    assert [code[i] for i in range(len(ids))] == ids
    with pytest.raises(IndexError):
        code[len(ids)]


def _brute_codes(texts, word_ids):
    start = 0
    for doc_id, text in texts:
        ids = np.array([*word_ids.tok.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        yield doc_id, start, len(ids), zlib.crc32(ids.tobytes())
        start += len(ids)


def test_codes_query(spark, word_ids):
    sf = "/root/testdata/sf0.001"
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in op10_token_codes(spark, sf).collect())
    assert got == list(_brute_codes(texts, word_ids))


def test_codes_of_odd_rows(spark, docs, rows, empty, word_ids):
    path = scratch_path(spark, "dac")
    dac.write_codes(docs, path, tokenizer_path("byte_bpe_50k.json"), 2)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in dac.read_documents(spark, path, docs.schema["doc_id"].dataType).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([i for i, _, _ in rows], key=lambda i: (i is not None, i))
    texts = sorted(((i, t) for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    want = list(_brute_codes(texts, word_ids))
    assert sorted((r[2:] for r in got)) == sorted(r[2:] for r in want)
    assert [r for r in got if r[0]] == [r for r in want if r[0]]
    path = scratch_path(spark, "dac")
    dac.write_codes(empty, path, tokenizer_path("byte_bpe_50k.json"), 2)
    assert dac.read_documents(spark, path, docs.schema["doc_id"].dataType).count() == 0


def _best(vocabulary, text):
    """Brute force: best score over all segmentations, by pieces in a plain dictionary."""
    score = {p: s for p, s, n in zip(vocabulary.pieces, vocabulary.scores, vocabulary.normal, strict=True) if n}
    unknown = min(score.values()) - unigram.UNKNOWN_PENALTY
    best = {0: 0.0}
    for end in range(1, len(text) + 1):
        options = [best[s] + score[text[s:end].encode()] for s in range(max(0, end - 16), end) if text[s:end].encode() in score]
        if text[end - 1].encode() not in score:
            options.append(best[end - 1] + unknown)
        best[end] = max(options)
    return best[len(text)]


@settings(max_examples=200, deadline=None)
@given(ODD)
def test_viterbi_is_optimal_and_round_trips(encoder, text):
    text = text.replace("▁", " ")
    ids = encoder.encode(text.encode()).tolist()
    assert encoder.decode(ids) == text
    v = encoder.vocabulary
    is_byte = set(v.byte_ids)
    total, run = 0.0, 0
    out = b"".join(v.pieces[i] for i in ids)
    assert out == ((b" " + text.encode()) if text else b"")
    # bytes of one unknown character cost the penalty once
    for i in ids:
        if i in is_byte:
            if run == 0:
                total += encoder.unknown
                b = v.pieces[i][0]
                run = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            run -= 1
        else:
            total += v.scores[i]
    if text:
        assert total == pytest.approx(_best(v, " " + text))


def test_batch_equals_single_and_library(encoder, sample, tmp_path):
    import sentencepiece

    segs = sorted({s for r in sample.collect() for s in encoder.segments(b" " + r.text.encode())})[:20_000]
    want = [unigram.array(encoder.code, encoder.viterbi(s)).tobytes() for s in segs]
    assert encoder.viterbi_many(segs) == want
    # the library's own unigram model over the same pieces and stored scores
    raw = _as_unigram(open(tokenizer_path("piece_bpe_32k.model"), "rb").read())
    path = tmp_path / "unigram.model"
    path.write_bytes(raw)
    lib = sentencepiece.SentencePieceProcessor(model_file=str(path))
    own = unigram.Encoder(unigram.load_vocabulary(str(path), "stored"))
    # (it adds 32-bit floats: a piece at -1e9 or an unknown character blurs all that follows, so
    # lines with one are left out, and lines are short enough for exact sums)
    v = own.vocabulary
    same = n = 0
    for t in [line for r in sample.collect() for line in r.text.split("\n") if 0 < len(line) < 150]:
        a = own.encode(t.encode()).tolist()
        if any(v.scores[i] < -1e8 or i in v.byte_ids for i in a):
            continue
        b = lib.nbest_encode_as_ids(t, 2)[0]  # the best path of its lattice
        assert sum(v.scores[i] for i in a) == sum(v.scores[i] for i in b)
        same += a == b
        n += 1
    assert n > 200 and same >= 0.95 * n  # equal scores may have several paths


def _as_unigram(raw: bytes) -> bytes:
    """The model file with its type set to unigram (field 3 of the trainer's message, field 2)."""
    out, at = b"", 0

    def varint(b, i):
        n = s = 0
        while True:
            n |= (b[i] & 127) << s
            s += 7
            i += 1
            if not b[i - 1] & 128:
                return n, i

    while at < len(raw):
        key, i = varint(raw, at)
        assert key & 7 == 2
        n, i = varint(raw, i)
        if key >> 3 == 2:
            body = raw[i : i + n] + bytes([3 << 3, 1])  # a later value of a field replaces the earlier one
            size, m = b"", len(body)
            while m > 127:
                size += bytes([m & 127 | 128])
                m >>= 7
            out += raw[at : at + 1] + size + bytes([m]) + body
        else:
            out += raw[at : i + n]
        at = i + n
    return out


def test_sentencepiece_rows(spark, docs, rows, empty):
    path = tokenizer_path("piece_bpe_32k.model")
    got = unigram.encode(docs, path)
    assert got.count() == len(rows) and got.filter("not round_trip").count() == 0
    assert got.filter("n_tokens = 0").count() == 3
    back = unigram.decode(got, path)
    want = sorted((repr((i, (t or "").replace("▁", " "))) for i, t, _ in rows))
    assert sorted(repr((r.doc_id, r.text)) for r in back.collect()) == want
    assert unigram.encode(empty, path).count() == 0
    assert op8_sentencepiece(spark, "/root/testdata/sf0.001").filter("not round_trip").count() == 0


def test_double_array_finds_every_piece_and_nothing_else(encoder):
    base, check, value = encoder.base, encoder.check, encoder.value

    def find(key):
        node = 0
        for c in key:
            child = base[node] + c + 1
            if check[child] != node:
                return -1
            node = child
        return value[node]

    v = encoder.vocabulary
    known = {p: i for i, (p, n) in enumerate(zip(v.pieces, v.normal, strict=True)) if n}
    assert all(find(p) == i for p, i in known.items())
    assert all(find(p + b"\xff") == -1 for p in known)
