from collections import Counter

import corpus_pipeline as P
from sylvan.llm import unigram
from sylvan.llm.queries import tokenizer_path
from tests.llm.test_near_dup import brute_components, brute_fp
from tests.llm.test_quality_mix import WORD, brute, brute_targets


def test_run_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    good = [d for d in docs if brute(d[1])[6]]
    fps = [(i, brute_fp(t)) for i, t, _ in good]
    single = [d for d, c in zip(good, brute_components(fps), strict=True) if d[0] == c]
    assert len(single) < len(good) < len(docs)
    sizes = Counter()
    for _, t, s in single:
        sizes[s] += len(WORD.findall(t))
    target = brute_targets(dict(sizes))
    got = P.run(spark, sf).collect()
    times = Counter(r.doc_id for r in got)
    for i, _, s in single:
        rate = target[s] / sizes[s]
        assert int(rate) <= times.pop(i, 0) <= int(rate) + (rate > int(rate))
    assert not times
    enc = unigram.Encoder(unigram.load_vocabulary(tokenizer_path("piece_bpe_32k.model")))
    text = {i: t for i, t, _ in docs}
    assert all(r.round_trip and enc.decode(r.ids) == text[r.doc_id] for r in got)


def test_stages_keep_columns_and_take_odd_tables(spark, docs, empty):
    from sylvan.session import write_table

    for df in (docs, empty):
        at = df
        for name, stage in P.STAGES[:-1]:
            at = write_table(stage(spark, at, "/nowhere"), f"test-{name}")
            assert at.columns == df.columns
        assert P.STAGES[-1][1](spark, at, "/nowhere").count() == at.count()


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like the operators' own, in either case, come through with their values."""
    from sylvan.llm import mixing, simhash

    names = ["mix_copies", "mix_source", "mix_rate", "mix_number", "sh_place", "sh_kept", "_mix_source", "_sh_place", "MIX_COPIES_"]
    rows = [(i, f"a text of its own with the number {i} and more words {i * 7}", "s", *[100 * k + i for k in range(len(names))]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` long" for n in names))
    for stage in (simhash.keep_one, mixing.mix):
        got = stage(df)
        assert got.columns == df.columns
        assert {tuple(r) for r in got.collect()} <= set(rows) and got.count() > 0
