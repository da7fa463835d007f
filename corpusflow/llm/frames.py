"""Token-id files of independent zstandard frames with a seek table.

File layout (all integers little-endian):

* data frames: each the ids (unsigned 32-bit) of some consecutive documents,
  about ``frame_ids`` of them; a document that is longer has a frame alone;
* one index frame: per document its doc_id (64-bit, least value for null),
  its number of ids (64-bit) and its data frame (32-bit), as three arrays;
* a skippable frame with the seek table of the zstandard seekable format:
  per frame its compressed size, decompressed size and the low 32 bits of the
  XXH64 checksum of its content, then the number of frames, a descriptor byte
  and the magic number. Any zstandard decoder can read such a file.

``write`` gives one file per range of doc_id, so files in name order hold the
documents in ascending doc_id order; files are written under a temporary name
and renamed, so a repeated or speculative task leaves the same file. ``read``
opens each file, reads the seek table from its end, and decompresses only the
frames of the documents asked for, checking their checksums.

Cases: a null id column is a document without ids; null doc_id sorts first;
rows of equal doc_id are all kept, in any order, over as many files as their
share needs; an empty table gives no files and no rows; extra columns are
ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import partitions, ship_package

#: Ids a data frame holds (256 KiB before compression).
FRAME_IDS = 1 << 16
#: Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, CHECKSUM_FLAG = 0x184D2A5E, 0x8F92EAB1, 0x80
NULL_ID = -(1 << 63)
FILE_SCHEMA = "file string, bucket int, n_docs long, n_ids long"


def checksum(data: bytes) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = 1):
        import zstandard
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.out, self.frame_bytes = out, 4 * frame_ids
        self.table: list[tuple[int, int, int]] = []
        self.open: list[bytes] = []
        self.size = 0
        self.docs: list[tuple[int, int, int]] = []
        self.n_ids = 0

    def frame(self, data: bytes) -> None:
        packed = self.zstd.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data), checksum(data)))

    def flush(self) -> None:
        if self.size:
            self.frame(b"".join(self.open))
            self.open, self.size = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > self.frame_bytes:
            self.flush()
        self.docs.append((NULL_ID if doc_id is None else doc_id, len(ids) // 4, len(self.table)))
        self.n_ids += len(ids) // 4
        self.open.append(ids)
        self.size += len(ids)

    def finish(self) -> None:
        self.flush()
        docs = np.array(self.docs, dtype=np.int64).reshape(-1, 3)
        self.frame(docs[:, 0].astype("<i8").tobytes() + docs[:, 1].astype("<i8").tobytes()
                   + docs[:, 2].astype("<u4").tobytes())
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)


class FrameReader:
    """Random access to one file; counts the frames it decompressed."""

    def __init__(self, f):
        import zstandard
        self.f, self.zstd = f, zstandard.ZstdDecompressor()
        f.seek(0, 2)
        end = f.tell()
        f.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a seekable frame file with checksums")
        f.seek(end - 9 - 12 * n)
        self.table = np.frombuffer(f.read(12 * n), dtype="<u4").reshape(n, 3)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0].astype(np.int64))])
        self.read_frames = 0
        index = self.frame(n - 1)
        k = len(index) // 20
        self.doc_ids = np.frombuffer(index, "<i8", k)
        self.n_ids = np.frombuffer(index, "<i8", k, 8 * k)
        self.frames = np.frombuffer(index, "<u4", k, 16 * k)
        self.starts = np.concatenate([[0], np.cumsum(self.n_ids)])

    def frame(self, i: int) -> bytes:
        packed, size, check = (int(x) for x in self.table[i])
        self.f.seek(int(self.at[i]))
        data = self.zstd.decompress(self.f.read(packed), max_output_size=max(size, 1))
        if len(data) != size or checksum(data) != check:
            raise ValueError(f"frame {i} is damaged")
        self.read_frames += 1
        return data

    def documents(self, wanted: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
        """``(position, ids)`` of the documents at these positions (all: None),
        decompressing each frame that holds one of them once."""
        places = np.arange(len(self.doc_ids)) if wanted is None else np.sort(wanted)
        held, data, first = -1, b"", 0
        for p in places.tolist():
            size = int(self.n_ids[p])
            if not size:
                yield p, b""
                continue
            if self.frames[p] != held:
                held = int(self.frames[p])
                data = self.frame(held)
                first = int(self.starts[np.searchsorted(self.frames, held)])
            at = 4 * (int(self.starts[p]) - first)
            yield p, data[at:at + 4 * size]


def filesystem(uri: str):
    """File system and path of a folder URI, on any machine."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def buckets(df: DataFrame, key: str, n: int, accuracy: int = 10_000) -> list[int]:
    """Ascending inner bounds of about equal ranges of a long column; a value
    that holds several ranges' share is listed as often."""
    q = [i / n for i in range(1, n)]
    if not q:
        return []
    got = df.agg(F.percentile_approx(key, q, accuracy)).first()[0]
    return sorted(got or [])


@dataclass
class Files:
    """Written files: ``listing`` has one row per file (FILE_SCHEMA)."""
    folder: str
    listing: DataFrame


def write(docs: DataFrame, doc_id: str = "doc_id", ids: str = "ids", folder: str | None = None,
          bounds: list[int] | None = None, frame_ids: int = FRAME_IDS) -> Files:
    """Write the documents in ascending ``doc_id`` order, one file per range
    between ``bounds`` (by default equal ranges, as many as the session's
    shuffle partitions). The listing is written beside the files."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or scratch_path(spark, "id-files")
    n = partitions(spark)
    if bounds is None:
        bounds = buckets(docs.select(F.coalesce(doc_id, F.lit(NULL_ID)).alias("id")), "id", n)
    # bounds at or below the id; the rows of an id that is a bound several times
    # are dealt over as many ranges
    edges = F.from_json(F.lit(str(list(bounds))), "array<long>")
    key = F.coalesce(F.col(doc_id), F.lit(NULL_ID))
    share = F.greatest(F.size(F.filter(edges, lambda e: e == key)), F.lit(1))
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), share)
    bucket = (F.size(F.filter(edges, lambda e: e <= key)) - share + 1 + dealt).cast("int")

    def write_files(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import uuid
        files, path = filesystem(folder)
        held = name = part = stream = writer = None
        done = []

        def close():
            writer.finish()
            stream.close()
            files.move(part, f"{path}/{name}")
            done.append((name, held, len(writer.docs), writer.n_ids))

        for batch in rows:
            for b, i, x in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if b != held:
                    if writer:
                        close()
                    held, name = b, f"ids-{b:08d}.zst"
                    part = f"{path}/.{name}.{os.getpid()}-{uuid.uuid4().hex[:8]}"
                    files.create_dir(path, recursive=True)
                    stream = files.open_output_stream(part)
                    writer = FrameWriter(stream, frame_ids)
                writer.add(i, x or b"")
        if writer:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*done, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                ["file", "bucket", "n_docs", "n_ids"])

    ordered = (docs.select(bucket.alias("bucket"), F.col(doc_id).cast("long").alias("doc_id"),
                           F.col(ids).alias("ids"))
               .repartition(n, "bucket").sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(),
                                                              F.crc32("ids"), "ids"))
    listing = folder + "/_listing"
    ordered.mapInArrow(write_files, FILE_SCHEMA).write.parquet(listing)
    return Files(folder, spark.read.schema(FILE_SCHEMA).parquet(listing))


def placed(files: Files) -> DataFrame:
    """The listing with ``file_start``: ids of all files before each (one row
    per file, as many as the write had ranges)."""
    w = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return files.listing.withColumn("file_start", F.coalesce(F.sum("n_ids").over(w), F.lit(0)))


def read(files: Files, digest: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document, from the files;
    with ``digest`` the ids' unsigned crc32 (``ids_crc32``) instead of ids."""
    folder = files.folder
    out = ("ids_crc32", "long", pa.int64()) if digest else ("ids", "binary", pa.binary())

    def read_files(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        for batch in rows:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{path}/{row['file']}") as f:
                    r = FrameReader(f)
                    got, size = [], 0
                    last = len(r.doc_ids) - 1
                    for p, data in r.documents():
                        got.append((None if r.doc_ids[p] == NULL_ID else int(r.doc_ids[p]),
                                    row["file_start"] + int(r.starts[p]), len(data) // 4,
                                    zlib.crc32(data) if digest else data))
                        size += 64 if digest else 64 + len(data)
                        if size > 1 << 23 or p == last:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t) for c, t in zip(zip(*got, strict=True), (
                                    pa.int64(), pa.int64(), pa.int64(), out[2]), strict=True)],
                                ["doc_id", "start", "n_tokens", out[0]])
                            got, size = [], 0

    spread = placed(files).repartition(partitions(files.listing.sparkSession), "bucket")
    return spread.mapInArrow(read_files, f"doc_id long, start long, n_tokens long, {out[0]} {out[1]}")


def lookup(files: Files, doc_ids: DataFrame) -> DataFrame:
    """``(doc_id, ids)`` of the documents whose id is in the one column of
    ``doc_ids``; only the frames holding them are decompressed. Wanted ids go
    to files by the files' own id ranges, read from their index frames."""
    folder = files.folder

    def index_rows(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        for batch in rows:
            for name in batch.column(0).to_pylist():
                with fs.open_input_file(f"{path}/{name}") as f:
                    r = FrameReader(f)
                    ids = pa.array(r.doc_ids, mask=r.doc_ids == NULL_ID)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(ids)), ids, pa.array(np.arange(len(ids)))],
                        ["file", "doc_id", "place"])

    def fetch(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        for batch in rows:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{path}/{row['file']}") as f:
                    r = FrameReader(f)
                    for p, data in r.documents(np.array(row["places"])):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([int(r.doc_ids[p])]), pa.array([data], pa.binary())], ["doc_id", "ids"])

    n = partitions(files.listing.sparkSession)
    index = files.listing.select("file").repartition(n, "file").mapInArrow(
        index_rows, "file string, doc_id long, place long")
    want = doc_ids.select(F.col(doc_ids.columns[0]).cast("long").alias("doc_id")).distinct()
    hits = index.join(want, "doc_id").groupBy("file").agg(F.collect_list("place").alias("places"))
    return hits.mapInArrow(fetch, "doc_id long, ids binary")
