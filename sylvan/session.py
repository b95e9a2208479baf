"""Session helpers: local session for tests/bench, checkpoint folder, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


#: The innermost open ``table_scope``.
_SCOPE: ContextVar[TableScope | None] = ContextVar("sylvan_scope", default=None)


def get_spark(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sylvan") -> SparkSession:
    """Local session used by tests and bench. On a cluster the caller builds its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Order: the folder already set on the context, then ``spark.checkpoint.dir``.
    Only a local-mode session (tests) may fall back to a fresh temporary folder;
    a cluster session without a shared folder is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sylvan-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables; inside a
    ``table_scope`` that scope owns it."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/sylvan-{name}-{uuid.uuid4().hex[:12]}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.items.append(Scratch(path))
    return path


class TableScope:
    """Owns what is written or cached while it is open (IO8), whichever function writes it."""

    def __init__(self, spark: SparkSession, parent: TableScope | None = None):
        self.spark, self.parent = spark, parent
        self.items: list[Scratch] = []
        self.cached: list[DataFrame] = []

    def cache(self, df: DataFrame) -> DataFrame:
        """``df`` held in executor memory and disk until the scope ends."""
        self.cached.append(df.persist())
        return self.cached[-1]

    def result(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """``df`` written for the scope around this one (or for the caller), so that it outlives this one."""
        token = _SCOPE.set(self.parent)
        try:
            return write_table(df, name, **options)
        finally:
            _SCOPE.reset(token)

    def close(self) -> None:
        while self.cached:
            self.cached.pop().unpersist()
        drop_scratch(self.spark, self.items)


@contextmanager
def table_scope(spark: SparkSession) -> Iterator[TableScope]:
    """A scope for written tables: when the block ends, normally or by an error, their files and
    cached copies are freed. Results must have been read, or written elsewhere, by then. Scopes
    nest: each frees its own."""
    scope = TableScope(spark, _SCOPE.get())
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        scope.close()


def write_table(df: DataFrame, name: str, registry: list[Scratch] | None = None, **options: str) -> DataFrame:
    """Cut lineage by writing parquet to a fresh folder of the shared checkpoint folder.

    One job (a reliable ``checkpoint`` needs a second pass or a cache), columnar and
    compressed; read back with the known schema, so no inference job. With a ``registry``
    the caller deletes the files by ``drop_scratch``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    if registry is not None:
        registry.append(Scratch(path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Has the shuffle files of ended jobs deleted. Spark does so when the driver's garbage is collected, which an
    idle driver may put off until the executors' disks are full."""
    spark._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# Broadcast bound: a side is broadcast only when its checked row count times an upper
# estimate of its row width stays under this budget; otherwise it is a shuffle join
# (with AQE's skew split for hot keys).
MAX_BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Scratch:
    """A written intermediate table: its files, and its catalog entry when it is bucketed."""

    path: str
    table: str | None = None


def drop_scratch(spark: SparkSession, items: list[Scratch]) -> None:
    """Deletes intermediate tables, files and catalog entries alike, and empties the list.

    The files go through Hadoop's file-system API, so any shared store works.
    """
    while items:
        item = items.pop()
        if item.table:
            spark.sql(f"DROP TABLE IF EXISTS {item.table}")
        path = spark._jvm.org.apache.hadoop.fs.Path(item.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_bucketed(
    df: DataFrame, name: str, key: str = "doc_id", buckets: int | None = None, prepartitioned: bool = False
) -> tuple[DataFrame, Scratch]:
    """Write ``df`` as a parquet table bucketed by ``key`` in the shared folder and read it back.

    Two such tables with the same bucket count join on ``key`` without an exchange on
    either side, level after level; the written files also cut the lineage.
    ``prepartitioned``: the rows already come out of a join of such tables (partitioned
    by ``key`` into ``buckets``), so each task writes one bucket and no shuffle is added.
    Bucketing lives in the session catalog; the second value is for ``drop_scratch``.
    """
    spark = df.sparkSession
    n = buckets or shuffle_partitions(spark)
    path = scratch_path(spark, name)
    table = f"sylvan_{name}_{path.rsplit('-', 1)[1]}"
    rows = df if prepartitioned else df.repartition(n, key)
    rows.write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(table)
    return spark.table(table), Scratch(path, table)
