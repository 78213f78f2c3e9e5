"""A keyed table on shared storage that is written in versions: deltas, compacted snapshots, one manifest that names what is live.

A commit writes its rows first and then one small manifest file, renamed into place (atomic on HDFS
and local disks; an object store needs a committer that gives the same). A reader opens the newest
manifest and reads just the files it names, so it sees one whole version however many commits run beside it.
What no kept manifest names is deleted, so the number of files stays bounded.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Folder:
    """The few calls of a Hadoop file system that a table needs, made from the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write_once(self, name: str, text: str) -> bool:
        """True if this call put the file there whole; False if one of that name was there before."""
        part = self._at(f"{name}.{uuid.uuid4().hex}.tmp")
        self._fs.mkdirs(part.getParent())
        stream = self._fs.create(part)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._fs.exists(self._at(name)) and self._fs.rename(part, self._at(name)):
            return True
        self._fs.delete(part, False)
        return False

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class VersionedTable:
    """Rows by key under ``path``. ``merge`` turns the rows of all live parts into one row a key, in the same columns.

    One writer at a time (a streaming query's driver). Versions are whole numbers that grow, as micro-batch
    ids do; a version that was committed already, as of a replayed batch, is left as it is.
    After ``compact_every`` deltas a commit merges them with the snapshot; the manifests of the last ``keep`` versions, and
    so the files that their readers may still be reading, stay.
    """

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], compact_every: int = 20, keep: int = 3):
        self.spark, self.merge, self.compact_every, self.keep = spark, merge, max(1, compact_every), max(1, keep)
        self.folder = Folder(spark, path)

    def versions(self) -> list[int]:
        return sorted(int(n[2:-5]) for n in self.folder.names("manifests") if n.startswith("v-") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict | None:
        """``{"version", "parts", "info"}`` of a kept version, the newest if none is given; None before the first commit."""
        known = self.versions()
        if not known:
            return None
        return json.loads(self.folder.read(f"manifests/v-{(known[-1] if version is None else version):020d}.json"))

    def _parts(self, names: list[str]) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.folder.path}/data/{n}" for n in names))

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table as of a kept version (the newest if none is given); None before the first commit."""
        live = self.manifest(version)
        return self.merge(self._parts(live["parts"])) if live and live["parts"] else None

    def commit(self, version: int, delta: DataFrame | None, info: dict | None = None) -> bool:
        """Add ``delta`` as ``version``; False (and nothing changed) if that version or a later one is there."""
        live = self.manifest() or {"version": -1, "parts": []}
        if version <= live["version"]:
            return False
        parts = list(live["parts"])
        if delta is not None:
            name = f"{version:020d}-{uuid.uuid4().hex}"
            delta.write.parquet(f"{self.folder.path}/data/{name}")
            parts.append(name)
        if len(parts) > self.compact_every:
            name = f"{version:020d}-{uuid.uuid4().hex}-all"
            self.merge(self._parts(parts)).write.parquet(f"{self.folder.path}/data/{name}")
            parts = [name]
        text = json.dumps({"version": version, "parts": parts, "info": info or {}})
        if not self.folder.write_once(f"manifests/v-{version:020d}.json", text):
            return False
        self._retain()
        return True

    def _retain(self) -> None:
        """Deletes manifests before the last ``keep`` and the data that the kept ones don't name, files of broken commits included."""
        known = self.versions()
        kept = known[-self.keep:]
        named = {n for v in kept for n in self.manifest(v)["parts"]}
        for v in known[:-self.keep]:
            self.folder.delete(f"manifests/v-{v:020d}.json")
        for n in self.folder.names("data"):
            if n not in named and int(n.split("-")[0]) <= kept[-1]:
                self.folder.delete(f"data/{n}")
