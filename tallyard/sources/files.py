"""Files as streams of chunks: listed, hashed, counted and copied in tasks, in bounded memory, whatever their size.

The driver never sees a path: folders are listed by tasks, and each file is then read by the task that it is dealt to.
Paths may be local (on a local master) or of any store that Arrow's file systems reach (file, hdfs, s3, gs).
"""

from __future__ import annotations

import fnmatch
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a task holds of a file.
CHUNK = 4 << 20

_FILE = "path string, is_dir boolean, bytes long"


def _listing(rows: DataFrame, recursive: bool) -> DataFrame:
    """The entries below each folder of (path), hidden ones (of a name with _ or . in front) left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for folder in b.column("path").to_pylist():
                fs, inner = pafs.FileSystem.from_uri(folder)
                prefix = folder.rstrip("/")[: len(folder.rstrip("/")) - len(inner.rstrip("/"))]
                found = []
                for info in fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True, recursive=recursive)):
                    below = info.path[len(inner.rstrip("/")) + 1 :].split("/")
                    if not any(part[:1] in "_." for part in below):
                        found.append((prefix + info.path, info.type == pafs.FileType.Directory, info.size or 0))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True) if found else ([], [], []), (pa.string(), pa.bool_(), pa.int64()), strict=True)], names=["path", "is_dir", "bytes"])

    return rows.mapInArrow(run, _FILE)


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, folder (the last part of its folder's path), name and bytes of all files below a folder whose name matches.

    The folder itself is listed by one task; each folder in it, with all below, by a task of its own.
    """
    top = _listing(spark.createDataFrame([(folder,)], "path string"), False)
    deeper = _listing(top.where("is_dir").select("path").repartition(spark.sparkContext.defaultParallelism, "path"), True)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    match = name.rlike(fnmatch.translate(pattern).replace("(?s:", "(?s)(?:").replace(r"\Z", "$").replace(r"\z", "$"))
    files = top.unionByName(deeper).where("NOT is_dir").where(match)
    return files.select("path", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), name.alias("name"), "bytes")


def _chunks(path: str, size: int) -> Iterator[bytes]:
    fs, inner = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(inner) as stream:
        while chunk := stream.read(size):
            yield chunk


def digests(files: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """file_hash (SHA-256), bytes, lines (line feeds) and blank (nothing but white space) of each file, by path.

    Every file is read once, chunk by chunk, by the task that has its row; rows are dealt by path.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                digest, size, lines, blank = hashlib.sha256(), 0, 0, True
                for chunk in _chunks(path, chunk_bytes):
                    digest.update(chunk)
                    size += len(chunk)
                    lines += chunk.count(b"\n")
                    blank = blank and not chunk.strip()
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([digest.hexdigest()]), pa.array([size]), pa.array([lines]), pa.array([blank])], names=["path", "file_hash", "bytes", "lines", "blank"])

    dealt = files.select("path").repartition(files.sparkSession.sparkContext.defaultParallelism, "path")
    return dealt.mapInArrow(run, "path string, file_hash string, bytes long, lines long, blank boolean")


def contents(files: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """path, part (from 0) and content of each file, in parts of at most ``chunk_bytes``; an empty file has one empty part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                part = -1
                for part, chunk in enumerate(_chunks(path, chunk_bytes)):  # noqa: B007
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([part], pa.int64()), pa.array([chunk], pa.binary())], names=["path", "part", "content"])
                if part < 0:
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([0], pa.int64()), pa.array([b""], pa.binary())], names=["path", "part", "content"])

    dealt = files.select("path").repartition(files.sparkSession.sparkContext.defaultParallelism, "path")
    return dealt.mapInArrow(run, "path string, part long, content binary")
