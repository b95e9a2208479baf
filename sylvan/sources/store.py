"""A store of named tables whose versions become visible whole.

A version is a folder of tables and a manifest (JSON): the format, each table's schema and row
count, and what the writer says about them (rule, parameters, labels). The manifest is written last
and renamed into place, so a version without one is a half-written one and is never read; a writer
that dies leaves the version before it in force. Readers take the schema from the manifest: no
inference, and values that look like numbers or dates stay what they were. Files go through Hadoop's
file-system API, so any shared folder works.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = "_manifest-"
#: Text formats are packed: as plain text a table takes several times the space. A packed file is read by one task, as
#: large as a writing task made it.
_PACKED = {"json": {"compression": "gzip"}, "csv": {"compression": "gzip"}}


class StoreError(ValueError):
    """The store holds no whole version, or not the one that is asked for."""


@dataclass(frozen=True)
class Version:
    """A committed version: its folder's name, what was said at commit, and its tables."""

    name: str
    info: dict
    fmt: str
    tables: dict

    def schema(self, table: str) -> T.StructType:
        return T.StructType.fromJson(self.tables[table]["schema"])


class TableStore:
    """Versions of a set of tables under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _manifests(self) -> list[str]:
        """File names of the committed manifests, the oldest first."""
        fs, at = self._fs(f"{self.path}/{_MANIFEST}*.json")
        return sorted(s.getPath().getName() for s in (fs.globStatus(at) or ()))

    def _read(self, name: str) -> str:
        fs, at = self._fs(f"{self.path}/{name}")
        stream = fs.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def latest(self) -> Version:
        """The newest whole version."""
        found = self._manifests()
        if not found:
            raise StoreError(f"{self.path} holds no whole version (no manifest): nothing was stored, or the writer did not end")
        said = json.loads(self._read(found[-1]))
        return Version(said["version"], said["info"], said["format"], said["tables"])

    def commit(
        self, tables: Mapping[str, DataFrame], info: dict, fmt: str = "parquet", partition_by: Mapping[str, Sequence[str]] | None = None
    ) -> Version:
        """Writes the tables as a new version and makes it the one that is read.

        The version before it stays for readers under way; older ones are deleted."""
        before = self._manifests()
        number = int(before[-1][len(_MANIFEST) :].split("-")[0]) + 1 if before else 0
        name = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        said = {}
        for table, df in tables.items():
            path, parts = f"{self.path}/{name}/{table}", list((partition_by or {}).get(table, ()))
            df.write.options(**_PACKED.get(fmt, {})).format(fmt).partitionBy(*parts).save(path)
            schema = T.StructType([f for f in df.schema if f.name not in parts] + [df.schema[p] for p in parts])
            rows = self.spark.read.schema(schema).format(fmt).load(path).count()
            said[table] = {"schema": schema.jsonValue(), "rows": rows}
        self._publish(name, {"version": name, "format": fmt, "info": info, "tables": said})
        self._drop(before[:-1], {m[len(_MANIFEST) : -len(".json")] for m in before[-1:]} | {name})
        return self.latest()

    def _publish(self, name: str, said: dict) -> None:
        fs, draft = self._fs(f"{self.path}/.draft-{name}.json")
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps(said, ensure_ascii=False).encode()))
        stream.close()
        _, final = self._fs(f"{self.path}/{_MANIFEST}{name}.json")
        if not fs.rename(draft, final):
            raise StoreError(f"the manifest of {name} could not be put in place under {self.path}")

    def _drop(self, manifests: list[str], keep: set[str]) -> None:
        """Deletes manifests first, then what no kept version owns of them (a half-written version too, if it is older)."""
        for m in manifests:
            name = m[len(_MANIFEST) : -len(".json")]
            if name in keep:
                continue
            for path in (f"{self.path}/{m}", f"{self.path}/{name}"):
                fs, at = self._fs(path)
                fs.delete(at, True)

    def read(self, table: str, version: Version | None = None, check: bool = False) -> DataFrame:
        """A table of a version (the newest). With ``check`` its rows are counted against the manifest."""
        v = version or self.latest()
        if table not in v.tables:
            raise StoreError(f"{self.path} has no table {table!r} in version {v.name}")
        df = self.spark.read.schema(v.schema(table)).format(v.fmt).load(f"{self.path}/{v.name}/{table}")
        if check and (rows := df.count()) != v.tables[table]["rows"]:
            raise StoreError(f"{self.path}/{v.name}/{table} has {rows} rows, its manifest says {v.tables[table]['rows']}")
        return df


def folder_key(label):
    """The folder name of a label: a digest, so that any string (empty, number-like) is a safe one."""
    return F.concat(F.lit("k"), F.md5(label))
