"""Numbered gzip shards: ``<name>-0000i-of-0000N.ndjson.gz``, written by tasks and named at the commit.

The number of shards is known only when all tasks are done, so a task writes files of its own under a hidden folder and
the commit moves those of the attempts that count. A failed job leaves no shard, and what an earlier export has left
stays until the new shards are complete.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.session import share_code

#: Bytes of text after which a task begins another shard.
SHARD_BYTES = 256 << 20
HIDDEN = "_writing"


def _store(folder: str):
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))


@dataclass
class Shards(WriterCommitMessage):
    partition: int
    files: list[str]


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, name: str, suffix: str, shard_bytes: int, job: str):
        self.folder, self.name, self.suffix, self.shard_bytes, self.job = folder, name, suffix, shard_bytes, job

    def write(self, batches: Iterator[pa.RecordBatch]) -> Shards:
        from pyspark import TaskContext

        store, root = _store(self.folder)
        place = f"{root}/{HIDDEN}/{self.job}"
        store.create_dir(place, recursive=True)
        files, out, sink, size = [], None, None, 0
        for batch in batches:
            for line in batch.column(0).to_pylist():
                if out is None or size >= self.shard_bytes:
                    if out is not None:
                        out.close()
                        sink.close()
                    files.append(uuid.uuid4().hex)
                    sink, size = store.open_output_stream(f"{place}/{files[-1]}", compression=None), 0
                    out = gzip.GzipFile(fileobj=sink, mode="wb", mtime=0, compresslevel=6)
                text = (line or "").encode() + b"\n"
                out.write(text)
                size += len(text)
        if out is not None:
            out.close()
            sink.close()
        return Shards(TaskContext.get().partitionId(), files)

    def commit(self, messages: list) -> None:
        store, root = _store(self.folder)
        store.create_dir(root, recursive=True)
        from pyarrow import fs

        old = [f.path for f in store.get_file_info(fs.FileSelector(root)) if f.is_file and f.base_name.endswith(self.suffix)]
        written = [f for m in sorted((m for m in messages if m), key=lambda m: m.partition) for f in m.files]
        named = [f"{root}/{self.name}-{i:05d}-of-{len(written):05d}{self.suffix}" for i in range(len(written))]
        for path in set(old) - set(named):
            store.delete_file(path)
        for file, path in zip(written, named):
            store.move(f"{root}/{HIDDEN}/{self.job}/{file}", path)
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        store, root = _store(self.folder)
        from pyarrow import fs

        if store.get_file_info(f"{root}/{HIDDEN}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/{HIDDEN}")


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "numbered_shards"

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        if [f.dataType.simpleString() for f in schema.fields] != ["string"]:
            raise ValueError("shards hold one column of text")
        if not overwrite:
            raise ValueError("shards are numbered as a whole and cannot be appended to")
        given = self.options
        return ShardWriter(given["path"], given["shard_name"], given.get("suffix", ".ndjson.gz"), int(given.get("shard_bytes", SHARD_BYTES)), uuid.uuid4().hex)


def write_shards(lines: DataFrame, folder: str, name: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Replace the shards of ``folder`` by the lines' own, in the order of their partitions.

    The store is any that ``pyarrow.fs`` knows. Lines longer than a shard are one by themselves; a null line is empty.
    """
    share_code(lines.sparkSession)
    lines.sparkSession.dataSource.register(ShardSource)
    lines.write.format("numbered_shards").mode("overwrite").option("shard_name", name).option("shard_bytes", shard_bytes).save(folder)
