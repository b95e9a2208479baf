"""File sources and sinks: CSV / JSON-lines / Parquet with explicit schemas, and the forest store.

Scans take an explicit schema; JSON of unknown schema is inferred once and the schema stored. Written tables go to
a fresh folder under the session's shared checkpoint folder unless a path is given.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.session import scratch_path
from sylvan.sources.store import StoreError, TableStore, folder_key

RULES = ("c45", "mr")  # the split rules whose forests a store holds

LABELLED_CSV_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
TOKENS_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("tokens", T.ArrayType(T.StringType())),
    ]
)
NODE_SCHEMA = T.StructType(
    [
        T.StructField("tree", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("term", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField("k", T.LongType()),
        T.StructField("is_leaf", T.BooleanType()),
        T.StructField("label", T.StringType()),
    ]
)

# CSV dialect: header line, RFC-4180 quoting (quote doubled inside quoted fields), one record per
# line, so that large files are split. Texts with line ends need ``multiLine=True`` (a file is
# then read by one task).
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType = LABELLED_CSV_SCHEMA, **options) -> DataFrame:
    """IO1: header CSV with an explicit schema (columns are taken by position)."""
    return spark.read.options(**{**CSV_OPTIONS, **options}).schema(schema).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType = TOKENS_SCHEMA) -> DataFrame:
    """IO2 / IO3: JSON lines with an explicit schema (token arrays included)."""
    return spark.read.schema(schema).json(path)


SIDECAR = "_schema.json"  # Spark's readers skip names that begin with an underscore


def read_json_inferred(spark: SparkSession, path: str) -> DataFrame:
    """IO2: JSON lines of unknown schema under a folder, columns differing from line to line.

    One distributed pass over all lines finds the schema (columns of any line, types wide enough for
    all of them); it is stored beside the data together with the files' names and sizes. Later
    scans take it from there, as long as the files are the same, and read with an explicit schema."""
    folder = path.rstrip("/")
    files = _listing(spark, folder)
    stored = _read_text(spark, f"{folder}/{SIDECAR}")
    said = json.loads(stored) if stored else {}
    if said.get("files") == files:
        schema = T.StructType.fromJson(said["schema"])
    else:
        schema = spark.read.option("samplingRatio", "1.0").json(folder).schema
        _write_text(spark, f"{folder}/{SIDECAR}", json.dumps({"files": files, "schema": schema.jsonValue()}))
    return spark.read.schema(schema).json(folder)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _listing(spark: SparkSession, folder: str) -> str:
    """A digest of the data files' names and sizes."""
    fs, at = _fs(spark, folder)
    names = sorted(f"{s.getPath().getName()} {s.getLen()}" for s in fs.listStatus(at) if s.getPath().getName()[0] not in "_.")
    return hashlib.sha256("\n".join(names).encode()).hexdigest()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small file; a reader sees the old one, none, or the new one whole."""
    fs, draft = _fs(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    _, at = _fs(spark, path)
    fs.delete(at, False)
    fs.rename(draft, at)


def write(df: DataFrame, path: str, fmt: str = "parquet", **options) -> str:
    """IO4: overwrite a folder with the frame in ``fmt`` (parquet, json or csv)."""
    opts = dict(CSV_OPTIONS) if fmt == "csv" else {}
    opts.update(options)
    df.write.mode("overwrite").format(fmt).options(**opts).save(path)
    return path


def csv_roundtrip(df: DataFrame) -> DataFrame:
    path = write(df, scratch_path(df.sparkSession, "csv"), "csv")
    return read_csv(df.sparkSession, path, LABELLED_CSV_SCHEMA, multiLine=True)


def read_labelled(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    text_col: str = "text",
    label_col: str = "label",
    id_col: str | None = None,
    id_type: str | None = None,
    **options,
) -> DataFrame:
    """A user's own table (csv, json or parquet) as ``doc_id, text, label``.

    CSV columns are found by the header's names and read as strings; ``id_type`` casts the id
    (ids are compared: of equal rows the smallest stays). Without an id column a row's id is the
    digest of its text and label, so equal rows share one.
    """
    if fmt == "csv":
        names = spark.read.options(**{**CSV_OPTIONS, **options}).csv(path).columns  # the header only
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = read_csv(spark, path, schema, **options)
    elif fmt == "json":
        cols = [c for c in (id_col, text_col, label_col) if c]
        df = read_json(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in cols]))
    else:
        df = spark.read.options(**options).format(fmt).load(path)
    text, label = F.col(text_col).cast("string"), F.col(label_col).cast("string")
    none = F.lit("\0")
    doc_id = F.col(id_col) if id_col else F.sha2(F.concat_ws("\1", F.coalesce(label, none), F.coalesce(text, none)), 256)
    if id_type:
        doc_id = doc_id.cast(id_type)
    return df.select(doc_id.alias("doc_id"), text.alias("text"), label.alias("label"))


def json_roundtrip(df: DataFrame) -> DataFrame:
    path = write(df, scratch_path(df.sparkSession, "json"), "json")
    return read_json(df.sparkSession, path, TOKENS_SCHEMA)


def save_forest(
    nodes: DataFrame, rule: str, path: str | None = None, params: dict | None = None, labels: Sequence[str] | None = None
) -> str:
    """IO5: the node table of a forest, one folder per tree, as a version of the rule's store.

    The tree's label is a column of the data (its folder is named by a digest), so any label
    comes back as it was. The manifest holds the rule, the parameters and the label list, which
    is one string per tree (taken from the nodes where it is not given)."""
    spark = nodes.sparkSession
    path = path or scratch_path(spark, "forest")
    out = nodes.select(*[F.col(f.name).cast(f.dataType) for f in NODE_SCHEMA.fields], F.lit(rule).alias("rule"))
    if labels is None:
        labels = [r.tree for r in nodes.select("tree").distinct().collect()]
    info = {"kind": "forest", "rule": rule, "params": params or {}, "labels": sorted(labels)}
    out = out.withColumn("folder", folder_key(F.col("tree")))
    _forest_store(spark, path, rule).commit({"nodes": out}, info, partition_by={"nodes": ["folder"]})
    return path


def load_forest(spark: SparkSession, path: str, rule: str | None = None, trees: list[str] | None = None) -> DataFrame:
    """IO5 read side: the newest whole version of a rule's forest (of every rule in ``RULES`` that
    the store has). A filter on trees prunes their folders. Raises ``StoreError`` where no version
    is whole."""
    found = []
    for r in [rule] if rule is not None else RULES:
        store = _forest_store(spark, path, r)
        try:
            found.append(store.read("nodes", check=True))
        except StoreError:
            if rule is not None or (r == RULES[-1] and not found):
                raise
    df = found[0]
    for other in found[1:]:
        df = df.unionByName(other)
    if trees is not None:
        keys = [f"k{hashlib.md5(t.encode()).hexdigest()}" for t in trees]
        df = df.filter(F.col("folder").isin(keys) & F.col("tree").isin(list(trees)))
    return df.drop("folder")


def forest_info(spark: SparkSession, path: str, rule: str) -> dict:
    """What the manifest says about a rule's forest: ``rule, params, labels``."""
    return _forest_store(spark, path, rule).latest().info


def _forest_store(spark: SparkSession, path: str, rule: str) -> TableStore:
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    return TableStore(spark, f"{path.rstrip('/')}/{rule}")
