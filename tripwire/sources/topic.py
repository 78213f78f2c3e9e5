"""A topic as a folder: partitions, offsets, committed batches; a Python data source for streams.

``spark.readStream.format("folder_topic")`` and ``writeStream.format("folder_topic")`` on a folder of any file system
that pyarrow opens (``file:``, ``hdfs:``, ``s3:``, ``gs:``)::

    <path>/data/<writer>/<batch>-<random>/<partition>-<task>.jsonl     records, as the tasks wrote them
    <path>/log/<number>.json                                           commits: which files, from which offset on

A record is visible once its commit file is there, so a killed writer leaves no half batch, and a batch that is
written again by a restarted query commits once. One query writes a topic at a time; any number read it.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage

NAME = "folder_topic"
SCHEMA = "partition int, offset long, timestamp long, key string, value string"


def partition_of(key: str | None, partitions: int) -> int:
    """Partition of a key: the first 8 hex digits of its md5, modulo their number; 0 without a key."""
    return 0 if key is None else int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % partitions


def _fs(path: str):
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path.rstrip("/")
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/").rstrip("/")
    return fs.FileSystem.from_uri(path.rstrip("/"))


def _list(store, folder: str) -> list[str]:
    from pyarrow import fs
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if f.path.endswith(".json"))


def _read(store, path: str) -> bytes:
    with store.open_input_stream(path) as f:
        return f.read()


def commits(path: str) -> list[dict]:
    """The log's entries in order: writer, batch, files (partition, first offset, records, path)."""
    store, root = _fs(path)
    return [json.loads(_read(store, p)) for p in _list(store, f"{root}/log")]


def ends(log: list[dict], partitions: int) -> dict[str, int]:
    """Offset after the last record of each partition."""
    out = {str(p): 0 for p in range(partitions)}
    for entry in log:
        for f in entry["files"]:
            out[str(f["partition"])] = max(out.get(str(f["partition"]), 0), f["first"] + f["records"])
    return out


@dataclass
class Stretch(InputPartition):
    """Records of one partition from ``start`` up to ``end``, and the files that hold them."""
    partition: int
    start: int
    end: int
    files: list[dict]


def _stretches(log: list[dict], start: dict, end: dict) -> list[Stretch]:
    out = []
    for p, upto in sorted(end.items(), key=lambda x: int(x[0])):
        since = start.get(p, 0)
        files = [f for entry in log for f in entry["files"] if str(f["partition"]) == p and f["first"] < upto and f["first"] + f["records"] > since]
        if files:
            out.append(Stretch(int(p), since, upto, files))
    return out


def _records(path: str, part: Stretch) -> Iterator[tuple]:
    store, root = _fs(path)
    for f in part.files:
        with store.open_input_stream(f"{root}/{f['path']}") as stream:
            rest, offset = b"", f["first"]
            while chunk := stream.read(1 << 20):
                *lines, rest = (rest + chunk).split(b"\n")
                for line in lines:
                    if part.start <= offset < part.end:
                        at, key, value = json.loads(line)
                        yield part.partition, offset, at, key, value
                    offset += 1


class _BatchReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.n = options["path"], int(options.get("partitions", 1))

    def partitions(self):
        log = commits(self.path)
        return _stretches(log, {}, ends(log, self.n)) or [Stretch(0, 0, 0, [])]

    def read(self, partition):
        return _records(self.path, partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are the next offset of each partition. ``startingOffsets``: ``earliest`` (default) or ``latest``, for a new query."""

    def __init__(self, options):
        self.path, self.n = options["path"], int(options.get("partitions", 1))
        self.starting = options.get("startingOffsets", "earliest")
        if self.starting not in ("earliest", "latest"):
            raise ValueError("startingOffsets is earliest or latest")

    def initialOffset(self):
        return ends(commits(self.path) if self.starting == "latest" else [], self.n)

    def latestOffset(self):
        return ends(commits(self.path), self.n)

    def partitions(self, start, end):
        return _stretches(commits(self.path), start, end) or [Stretch(0, 0, 0, [])]

    def read(self, partition):
        return _records(self.path, partition)


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class _StreamWriter(DataSourceStreamWriter):
    """Writes (key, value) records, by a hash of the key, to the topic's partitions."""

    def __init__(self, schema, options):
        self.path, self.n = options["path"], int(options.get("partitions", 1))
        self.writer = options.get("writer", "default")
        self.key, self.value = (schema.fieldNames().index(c) if c in schema.fieldNames() else None for c in ("key", "value"))
        if self.value is None:
            raise ValueError("a topic takes rows with a value (and a key)")

    def write(self, iterator):
        store, root = _fs(self.path)
        folder, open_files = f"data/{self.writer}/{uuid.uuid4().hex}", {}
        store.create_dir(f"{root}/{folder}", recursive=True)
        now = int(time.time() * 1000)
        try:
            for row in iterator:
                key = None if self.key is None or row[self.key] is None else str(row[self.key])
                p = partition_of(key, self.n)
                if p not in open_files:
                    name = f"{folder}/{p}.jsonl"
                    open_files[p] = [store.open_output_stream(f"{root}/{name}"), {"partition": p, "records": 0, "path": name}]
                open_files[p][0].write(json.dumps([now, key, row[self.value]]).encode() + b"\n")
                open_files[p][1]["records"] += 1
        finally:
            for stream, _ in open_files.values():
                stream.close()
        return Written([f for _, f in open_files.values()])

    def commit(self, messages, batchId):
        store, root = _fs(self.path)
        log = commits(self.path)
        if any(e["writer"] == self.writer and e["batch"] >= batchId for e in log):
            return self.abort(messages, batchId)  # this batch was committed before the query was restarted
        at, files = ends(log, self.n), []
        for f in (f for m in messages if m for f in m.files):
            files.append({**f, "first": at[str(f["partition"])]})
            at[str(f["partition"])] += f["records"]
        store.create_dir(f"{root}/log", recursive=True)
        part = f"{root}/log/.{uuid.uuid4().hex}.tmp"
        with store.open_output_stream(part) as f:
            f.write(json.dumps({"writer": self.writer, "batch": batchId, "files": files}).encode())
        store.move(part, f"{root}/log/{len(log):020d}.json")

    def abort(self, messages, batchId):
        store, root = _fs(self.path)
        for f in (f for m in messages if m for f in m.files):
            store.delete_file(f"{root}/{f['path']}")


class FolderTopic(DataSource):
    """Options: ``path``, ``partitions`` (their number, fixed for a topic), ``startingOffsets``, ``writer`` (name of a writing query)."""

    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _BatchReader(self.options)

    def streamReader(self, schema):
        return _StreamReader(self.options)

    def streamWriter(self, schema, overwrite):
        return _StreamWriter(schema, self.options)


def register(spark: SparkSession) -> str:
    """Make the format known to the session; its name."""
    spark.dataSource.register(FolderTopic)
    return NAME
