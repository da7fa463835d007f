"""Documents as single files with sidecars beside them, as a Spark data source.

    spark.dataSource.register(DocumentFiles)
    objects.write.format("document_files").mode("append").save(root)
    spark.read.format("document_files").load(root)

Rows are ``(key, body, sidecar)``. The file of a key lies under ``root`` in one of
``SHARDS`` folders (by a hash of the key), its sidecar, if any, beside it with
``.metadata.json`` after its name. A task writes each file under a name of its
own and renames it into place, the sidecar before the object: an object is never
seen without its sidecar, and a repeated task puts the same files in the same
places. A null sidecar removes one that an earlier write left.

A reader's partitions are the folders, dealt into even ranges; a task lists its
own folders and pairs each object with its sidecar while it reads, so neither the
listing nor a join of the two passes through the driver.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SHARDS, READ_PARTITIONS = 64, 16
SIDECAR = ".metadata.json"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path that a URI (or a plain path) names."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def place(key: str) -> str:
    """Folder and file name of a key; slashes, control characters and what
    marks hidden files are escaped."""
    name = re.sub(r"^[._]|[%/\\\x00-\x1f]", lambda m: f"%{ord(m[0]):02X}", key)
    return f"{zlib.crc32(key.encode()) % SHARDS:02d}/{name}"


class Folders(InputPartition):
    """Shard folders that one task reads."""

    def __init__(self, shards: list[int]):
        super().__init__(shards)


class FileReader(DataSourceReader):
    def __init__(self, path: str, prefix: str):
        self.path, self.prefix = path, prefix

    def partitions(self) -> list[Folders]:
        return [Folders(list(range(i, SHARDS, READ_PARTITIONS))) for i in range(READ_PARTITIONS)]

    def read(self, partition: Folders) -> Iterator[tuple]:
        store, root = opened(self.path)

        def text(name: str) -> str:
            with store.open_input_stream(name) as f:
                return f.read().decode()
        for shard in partition.value:
            found = store.get_file_info(fs.FileSelector(f"{root}/{shard:02d}", allow_not_found=True))
            names = {f.base_name for f in found if f.type == fs.FileType.File and not f.base_name.startswith("_")}
            for name in sorted(names):
                key = unquote(name)
                if name.endswith(SIDECAR) or not key.startswith(self.prefix):
                    continue
                beside = text(f"{root}/{shard:02d}/{name}{SIDECAR}") if name + SIDECAR in names else None
                yield key, text(f"{root}/{shard:02d}/{name}"), beside


class FileWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        store, root = opened(self.path)
        task = uuid.uuid4().hex

        def put(name: str, text: str) -> None:
            folder = name.partition("/")[0]
            store.create_dir(f"{root}/{folder}", recursive=True)
            aside = f"{root}/{folder}/_{task}"
            with store.open_output_stream(aside) as f:
                f.write(text.encode())
            store.move(aside, f"{root}/{name}")
        for row in rows:
            name = place(row["key"])
            if row["sidecar"] is not None:
                put(name + SIDECAR, row["sidecar"])
            elif store.get_file_info(f"{root}/{name}{SIDECAR}").type == fs.FileType.File:
                store.delete_file(f"{root}/{name}{SIDECAR}")
            put(name, row["body"])
        return WriterCommitMessage()

    def commit(self, messages) -> None:
        store, root = opened(self.path)
        store.create_dir(root, recursive=True)
        store.open_output_stream(f"{root}/_SUCCESS").close()

    def abort(self, messages) -> None:
        """Files in place stay: the next run writes them again."""


class DocumentFiles(DataSource):
    """``document_files``: options ``path`` and, to read, ``prefix`` of keys."""

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def schema(self) -> str:
        return "key string, body string, sidecar string"

    def reader(self, schema) -> FileReader:
        return FileReader(self.options["path"], self.options.get("prefix", ""))

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"])
