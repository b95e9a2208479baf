"""The store of table versions: whole or not at all, schemas as written, owned scratch tables."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001


def _plain(path):
    return path.removeprefix("file:")


@pytest.fixture()
def store(spark):
    from sylvan.session import scratch_path
    from sylvan.sources.store import TableStore

    return TableStore(spark, scratch_path(spark, "store-test"))


ODD = ["01", "1", "1.0", "2024-01-01", "", " ", "null", "a/b=c", "é%2F", "true", "NaN"]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_values_come_back_unchanged(spark, store, fmt):
    from sylvan.sources.store import folder_key

    rows = [(i, x, [x, None], None if i % 2 else x) for i, x in enumerate(ODD)]
    df = spark.createDataFrame(rows, "n int, label string, words array<string>, other string")
    df = df.withColumn("folder", folder_key(F.col("label")))
    store.commit({"t": df}, {"labels": ODD}, fmt, {"t": ["folder"]})
    back = store.read("t", check=True)
    assert back.schema["label"].dataType.simpleString() == "string"
    assert sorted(map(repr, back.drop("folder").collect())) == sorted(map(repr, df.drop("folder").collect()))
    assert store.latest().info["labels"] == ODD


def test_a_half_written_version_is_not_read(spark, store):
    from sylvan.sources.store import StoreError

    with pytest.raises(StoreError):
        store.latest()
    one = spark.range(3).toDF("n")
    spark.range(5).write.parquet(f"{store.path}/00000000-dead/t")  # a writer that ended before its manifest
    with pytest.raises(StoreError):
        store.read("t")
    store.commit({"t": one}, {})
    # the next writer fails half-way: the version before it stays in force
    bad = spark.range(2).select(F.raise_error(F.lit("lost")).cast("long").alias("n"))
    with pytest.raises(Exception, match="lost"):
        store.commit({"t": spark.range(9).toDF("n"), "u": bad}, {})
    assert store.read("t", check=True).count() == 3
    with pytest.raises(StoreError):
        store.read("u")


def test_a_damaged_version_is_refused(spark, store):
    from sylvan.sources.store import StoreError

    v = store.commit({"t": spark.range(100).repartition(4).toDF("n")}, {})
    folder = f"{_plain(store.path)}/{v.name}/t"
    victim = next(f for f in os.listdir(folder) if f.startswith("part-"))
    os.rename(f"{folder}/{victim}", f"{folder}/_hidden")
    with pytest.raises(StoreError, match="rows"):
        store.read("t", check=True)


def test_versions_replace_each_other_and_old_ones_go(spark, store):
    first = store.commit({"t": spark.range(1).toDF("n")}, {"v": 0})
    held = store.read("t", first)
    for v in range(1, 4):
        # a version may be computed from the one before
        store.commit({"t": store.read("t").union(spark.range(1).toDF("n"))}, {"v": v})
        if v == 1:
            assert held.count() == 1  # a reader under way keeps its version
    assert store.latest().info == {"v": 3} and store.read("t").count() == 4
    assert len([x for x in os.listdir(_plain(store.path)) if x.startswith("0000")]) == 2


def test_two_rules_in_one_forest_store(spark):
    from sylvan.session import scratch_path
    from sylvan.sources.files import load_forest, save_forest
    from sylvan.sources.store import StoreError

    path = scratch_path(spark, "store-test")
    with pytest.raises(StoreError):
        load_forest(spark, path, "mr")
    with pytest.raises(StoreError):
        load_forest(spark, path)
    node = ("x", "", 0, None, None, 2, 1, True, "Other")
    nodes = spark.createDataFrame([node], "tree string, node string, depth int, term string, score double, n long, k long, is_leaf boolean, label string")
    save_forest(nodes, "c45", path)
    save_forest(nodes.withColumn("n", F.lit(7).cast("long")), "mr", path)
    assert {(r.rule, r.n) for r in load_forest(spark, path).collect()} == {("c45", 2), ("mr", 7)}
    assert [r.rule for r in load_forest(spark, path, "mr").collect()] == ["mr"]
    with pytest.raises(ValueError):
        save_forest(nodes, "../x", path)


def _scratch(spark):
    from sylvan.session import checkpoint_dir

    return {x for x in os.listdir(_plain(checkpoint_dir(spark)))}


def test_a_job_leaves_no_scratch_tables(spark, monkeypatch):
    from sylvan.plans import job as J
    from sylvan.session import scratch_path

    store = scratch_path(spark, "job-test")
    params = J.JobParams(min_df=10, rule="c45", max_depth=1, stop_words=False)
    before = _scratch(spark)
    got = J.run_job(spark, SF001, store, "lang", params)
    assert got.first().n_test > 0 and _scratch(spark) == before | {store.rsplit("/", 1)[1]}
    before = _scratch(spark)
    monkeypatch.setattr(J.P, "evaluate", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        J.run_job(spark, SF001, store, "lang", params)
    assert _scratch(spark) == before


def test_scopes_nest_and_free_caches(spark):
    from sylvan.session import table_scope, write_table

    before = _scratch(spark)
    with table_scope(spark) as outer:
        kept = write_table(spark.range(4).toDF("n"), "outer")
        with table_scope(spark):
            assert write_table(spark.range(3).toDF("n"), "inner").count() == 3
        assert len(_scratch(spark) - before) == 1 and kept.count() == 4
        held = outer.cache(kept.filter("n > 1"))
        assert held.count() == 2 and held.is_cached
    assert _scratch(spark) == before and not held.is_cached


def test_parameters_of_a_loading_run_must_match(spark):
    from sylvan.plans.job import JobParams, load_features, run_job
    from sylvan.session import scratch_path
    from sylvan.sources.store import StoreError

    store = scratch_path(spark, "job-test")
    run_job(spark, SF001, store, "lang", JobParams(min_df=10, max_depth=0, stem=False))
    with pytest.raises(StoreError, match="prepared with"):
        run_job(spark, SF001, store, "lang", JobParams(min_df=10, max_depth=0, stem=True), compute_features=False)
    with pytest.raises(StoreError, match="ids are bigint"):
        load_features(spark, store, id_type="string")


def test_inferred_json_schema_is_stored_and_renewed(spark, monkeypatch):
    from sylvan.session import scratch_path
    from sylvan.sources import files as IO

    path = scratch_path(spark, "json-test")
    lines = ['{"a": 1, "b": "x"}', '{"a": 2.5, "c": {"d": [1, 2]}}', '{"b": 7}', '{"e": null}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    got = IO.read_json_inferred(spark, path)
    assert got.schema.simpleString() == "struct<a:double,b:string,c:struct<d:array<bigint>>,e:string>"
    assert sorted((r.a, r.b) for r in got.filter("a is not null").collect()) == [(1.0, "x"), (2.5, None)]
    reader = type(spark.read)
    inferred = []
    plain = reader.json

    def watched(self, *a, **k):
        inferred.append(a)
        return plain(self, *a, **k)

    monkeypatch.setattr(reader, "json", watched)
    again = IO.read_json_inferred(spark, path)
    assert again.schema == got.schema and len(inferred) == 1 and again.count() == 4  # one scan, none to infer
    spark.createDataFrame([('{"z": true}',)], "value string").write.mode("append").text(path)
    assert "z" in IO.read_json_inferred(spark, path).columns and len(inferred) == 3
