"""Snapshots of files as gzip-compressed tar shards: a Python data source that writes and reads them.

A snapshot is a folder below ``path``: shards, each one gzip stream that plain tar opens, and a manifest, written last,
with the sha256, bytes and members of each shard. ``latest.json`` beside the snapshots names the newest. Tasks stream
their members into a staging folder; only the commit moves shards to their place, so a write that dies leaves no manifest
and no snapshot. Paths may be on any store that pyarrow reaches.
"""

from __future__ import annotations

import hashlib
import io
import json
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage

SCHEMA = "snapshot string, shard string, path string, content binary"


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _text(files, path: str) -> str | None:
    from pyarrow import fs

    if files.get_file_info(path).type == fs.FileType.NotFound:
        return None
    with files.open_input_stream(path) as f:
        return f.read().decode()


class _Hashed(io.RawIOBase):
    """A stream that tells its sha256 and size."""

    def __init__(self, out) -> None:
        self.out, self.digest, self.bytes = out, hashlib.sha256(), 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.digest.update(data)
        self.bytes += len(data)
        self.out.write(bytes(data))
        return len(data)


@dataclass
class Shard(WriterCommitMessage):
    name: str
    sha256: str
    bytes: int
    files: int
    content_bytes: int


@dataclass
class ShardOf(InputPartition):
    snapshot: str
    shard: str


class TarArchive(DataSource):
    """``df.write.format("tar_archive").option("path", p).option("snapshot", name)`` with columns path and content; reads as snapshot, shard, path, content."""

    @classmethod
    def name(cls) -> str:
        return "tar_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        names = [f.name for f in schema.fields]
        return ArchiveWriter(self.options["path"], self.options["snapshot"], names.index("path"), names.index("content"), overwrite)


class ArchiveWriter(DataSourceWriter):
    def __init__(self, path: str, snapshot: str, path_at: int, content_at: int, overwrite: bool) -> None:
        self.path, self.snapshot, self.at, self.overwrite = path.rstrip("/"), snapshot, (path_at, content_at), overwrite
        self.staging = f"{self.path}/.staging-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Shard:
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"shard-{task.partitionId():05d}-{task.taskAttemptId()}.tar.gz"
        files, folder = _store(self.staging)
        files.create_dir(folder, recursive=True)
        n = total = 0
        with files.open_output_stream(f"{folder}/{name}", compression=None) as raw:
            out = _Hashed(raw)
            with tarfile.open(fileobj=out, mode="w|gz") as tar:
                for row in rows:
                    path, content = row[self.at[0]], bytes(row[self.at[1]] or b"")
                    member = tarfile.TarInfo(path.lstrip("/"))
                    member.size = len(content)
                    tar.addfile(member, io.BytesIO(content))
                    n, total = n + 1, total + len(content)
        return Shard(name, out.digest.hexdigest(), out.bytes, n, total)

    def commit(self, messages: list) -> None:
        files, root = _store(self.path)
        target, staged = f"{root}/{self.snapshot}", _store(self.staging)[1]
        if _text(files, f"{target}/manifest.json") is not None and not self.overwrite:
            self.abort(messages)
            raise FileExistsError(f"snapshot {self.snapshot} is there already")
        files.create_dir(target, recursive=True)
        shards = sorted((m for m in messages if m is not None and m.files), key=lambda m: m.name)
        for m in shards:
            files.move(f"{staged}/{m.name}", f"{target}/{m.name}")
        made = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
        manifest = {"created_at": made, "file_count": sum(m.files for m in shards), "content_bytes": sum(m.content_bytes for m in shards), "shards": [{"filename": m.name, "bytes": m.bytes, "sha256": m.sha256, "file_count": m.files} for m in shards]}
        for place, value in ((f"{target}/manifest.json", manifest), (f"{root}/latest.json", {"snapshot": self.snapshot, "created_at": made})):
            with files.open_output_stream(place) as f:
                f.write((json.dumps(value, indent=2, sort_keys=True) + "\n").encode())
        self._clear(files, staged)

    def abort(self, messages: list) -> None:
        files, _ = _store(self.path)
        self._clear(files, _store(self.staging)[1])

    @staticmethod
    def _clear(files, folder: str) -> None:
        from pyarrow import fs

        if files.get_file_info(folder).type != fs.FileType.NotFound:
            files.delete_dir(folder)


class ArchiveReader(DataSourceReader):
    """One partition a shard. A filter on snapshot prunes shards before anything is opened; a prefix of path skips members unread. Load anew for each query: Spark keeps the filters that it has pushed with the frame that was loaded."""

    def __init__(self, path: str) -> None:
        self.path, self.snapshots, self.prefixes = path.rstrip("/"), None, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("snapshot",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.snapshots = values if self.snapshots is None else self.snapshots & values
            elif isinstance(f, StringStartsWith) and f.attribute == ("path",):
                self.prefixes.append(f.value)
            else:
                yield f

    def partitions(self) -> list[ShardOf]:
        from pyarrow import fs

        files, root = _store(self.path)
        found = [i.base_name for i in files.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.type == fs.FileType.Directory]
        out = []
        for snapshot in sorted(found if self.snapshots is None else self.snapshots & set(found)):
            manifest = _text(files, f"{root}/{snapshot}/manifest.json")
            out += [ShardOf(snapshot, s["filename"]) for s in json.loads(manifest)["shards"]] if manifest else []
        return out or [ShardOf("", "")]

    def read(self, partition: ShardOf) -> Iterator[tuple]:
        if not partition.shard:
            return
        files, root = _store(self.path)
        with files.open_input_stream(f"{root}/{partition.snapshot}/{partition.shard}", compression=None) as raw, tarfile.open(fileobj=raw, mode="r|gz") as tar:
            for member in tar:
                if member.isfile() and all(member.name.startswith(p) for p in self.prefixes):
                    yield partition.snapshot, partition.shard, member.name, tar.extractfile(member).read()


def latest(path: str) -> str | None:
    """The newest snapshot below ``path``, or None."""
    files, root = _store(path.rstrip("/"))
    text = _text(files, f"{root}/latest.json")
    return json.loads(text)["snapshot"] if text else None
