"""Tables as Parquet folders on shared storage.

Two shapes. A *versioned* table is rewritten whole: each version is its own folder,
and the newest folder Spark marked as complete is the current one, so readers never
see half a write and a crashed write is simply not current. A *daily* table is
partitioned by a date and only the days a batch touches are replaced: they are written
to the folder of a new load, and a small manifest, which says for every day which load
holds it, makes them current at once. A write that stops half-way changes nothing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

_VERSION = re.compile(r"^version-(\d+)$")
_MANIFEST = re.compile(r"^manifest-(\d+)\.json$")
_LOAD = "load_nb"


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- files -------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _is_file(self, *parts: str) -> bool:
        path = self._path(*parts)
        return self._fs(path).exists(path)

    def folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def holds(self, name: str) -> bool:
        """Whether the folder of ``name`` exists, whatever shape it has."""
        return self._is_file(name)

    # -- versioned tables --------------------------------------------------

    def versions(self, name: str) -> list[int]:
        """Complete versions, oldest first."""
        path = self._path(name)
        fs = self._fs(path)
        if not fs.exists(path):
            return []
        found = []
        for status in fs.listStatus(path):
            hit = _VERSION.match(status.getPath().getName())
            if hit and self._is_file(name, status.getPath().getName(), "_SUCCESS"):
                found.append(int(hit.group(1)))
        return sorted(found)

    def exists(self, name: str) -> bool:
        return bool(self.versions(name)) or self._manifest(name)[0] > 0

    def read(self, name: str, before: int | None = None) -> DataFrame | None:
        """Current content; ``before`` limits to versions below a number. None if there is none."""
        known = [v for v in self.versions(name) if before is None or v < before]
        if known:
            return self.spark.read.parquet(f"{self.folder(name)}/version-{known[-1]:08d}")
        return self._read_days(name) if before is None else None

    def replace(self, name: str, df: DataFrame, version: int | None = None) -> DataFrame:
        """Write a new version and return it as read back.

        With ``version`` the write is repeatable: a version that is complete is left
        alone, so a replayed batch changes nothing.
        """
        known = self.versions(name)
        if version is None:
            version = (known[-1] if known else 0) + 1
        target = f"{self.folder(name)}/version-{version:08d}"
        if version not in known:
            df.write.mode("overwrite").parquet(target)
        return self.spark.read.parquet(target)

    # -- daily tables ------------------------------------------------------

    def _manifest(self, name: str) -> tuple[int, dict]:
        """Number and content of the newest manifest: its schema, and the load of every day's folder."""
        path = self._path(name)
        fs = self._fs(path)
        numbers = [int(m.group(1)) for f in (fs.listStatus(path) if fs.exists(path) else [])
                   if (m := _MANIFEST.match(f.getPath().getName()))]
        if not numbers:
            return 0, {"days": {}}
        newest = max(numbers)
        text = self.spark.read.text(f"{self.folder(name)}/manifest-{newest:08d}.json", wholetext=True).first()[0]
        return newest, json.loads(text)

    def _publish(self, name: str, number: int, content: dict) -> None:
        """Write a manifest aside and rename it, which is one step of the file system."""
        aside, final = self._path(name, f".manifest-{number:08d}.tmp"), self._path(name, f"manifest-{number:08d}.json")
        fs = self._fs(aside)
        stream = fs.create(aside, True)
        try:
            stream.write(bytearray(json.dumps(content), "utf-8"))
        finally:
            stream.close()
        if not fs.rename(aside, final):
            raise RuntimeError(f"{name}: another writer published load {number}")

    def _read_days(self, name: str, wanted: set[str] | None = None) -> DataFrame | None:
        number, content = self._manifest(name)
        if not number:
            return None
        schema = T.StructType.fromJson(content["schema"])
        paths = [f"{self.folder(name)}/loads/{_LOAD}={load}/{folder}" for folder, load in sorted(content["days"].items())
                 if wanted is None or folder in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema.add(_LOAD, T.IntegerType()))
        return reader.option("basePath", f"{self.folder(name)}/loads").parquet(*paths).drop(_LOAD)

    def overwrite_days(self, name: str, df: DataFrame, day: str, days: Sequence | None = None) -> DataFrame:
        """Replace the days ``df`` holds, and those of ``days`` that it holds no more.

        The rebalance step sizes files evenly and splits a day that is much larger than
        the rest. The schema is kept in the manifest: files written before a column
        or metadata field appeared read it as NULL without a scan of all footers.
        """
        from ..operators.merge import union_type

        number, content = self._manifest(name)
        columns = [c for c in df.columns if c != day] + [day]
        schema = df.select(*columns).schema
        if number:
            schema = union_type(T.StructType.fromJson(content["schema"]), schema)
            names = [f.name for f in schema.fields if f.name != day] + [day]
            schema = T.StructType([schema[n] for n in names])
        target = f"{self.folder(name)}/loads/{_LOAD}={number + 1}"
        df.select(*columns).hint("rebalance", day).write.mode("overwrite").partitionBy(day).parquet(target)
        path = self._path(name, "loads", f"{_LOAD}={number + 1}")
        written = [f.getPath().getName() for f in self._fs(path).listStatus(path) if f.isDirectory()]
        emptied = {f"{day}={d}" for d in days or () if d is not None}
        held = {k: v for k, v in content["days"].items() if k not in emptied}
        held |= {folder: number + 1 for folder in written if not folder.startswith("_")}
        open_ = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
        self._publish(name, number + 1, {"schema": open_.jsonValue(), "days": held})
        return self.read(name)

    def next_load(self, name: str) -> int:
        """The number of the load that ``overwrite_days`` writes next."""
        return self._manifest(name)[0] + 1

    def days(self, name: str, day: str, wanted: Sequence) -> DataFrame | None:
        """The stored rows of some days; only their folders are read."""
        return self._read_days(name, {f"{day}={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in wanted})


def touched_days(df: DataFrame, day: str) -> list:
    """Distinct days of a batch: one folder of the table each, so the list is as long as the
    table has folders."""
    return [r[0] for r in df.select(day).distinct().collect()]
