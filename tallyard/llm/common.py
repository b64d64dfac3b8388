"""Shared pieces: shared scratch tables, and words of whole text columns as flat numpy arrays."""

from __future__ import annotations

import atexit
import hashlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: str | None = None
_for_exit: set[int] = set()

#: Bytes of text that a task turns into arrays at once; a single longer text is taken whole.
SLICE_BYTES = 2 << 20


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``); where it is unset, a temporary one, on a local master only."""
    global _own_dir
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return "file://" + _own_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below :func:`scratch_dir` that Hadoop's file system removes when the driver ends."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: one evaluation, short lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Removes tables that :func:`materialize` wrote, once all that is made of them is written itself."""
    for df in frames:
        remove_path(df.sparkSession, df.scratch)


def remove_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def one_row_per_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text: rows without an id left out; of rows that repeat an id, the smallest text that isn't null."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    repeated = rows.groupBy("doc_id").count().where("count > 1").limit(1).count()
    return rows.groupBy("doc_id").agg(F.min("text").alias("text")) if repeated else rows


def numbered_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """The rows with a long of their own in the order of id (null last) and text; and the name of that column.

    It is the id itself where no row lacks or repeats one. Otherwise the rows are sorted and written with their numbers.
    """
    key = "row"
    while key in docs.columns:
        key += "_"
    ids = docs.groupBy(F.col(id_col).cast("long").alias("id")).count()
    if ids.where("id IS NULL OR count > 1").isEmpty():
        return docs.withColumn(key, F.col(id_col).cast("long")), key
    ordered = docs.orderBy(F.col(id_col).cast("long").asc_nulls_last(), F.col(text_col).asc_nulls_last())
    return materialize(ordered.withColumn(key, F.monotonically_increasing_id()), "numbered-rows"), key


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about SLICE_BYTES of text each, so that a task's arrays stay bounded."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
            yield batch.slice(at, to - at)
            at, done = to, int(ends[to - 1])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and n + 1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    first = int(offsets[0])
    size = int(offsets[-1]) - first
    raw = np.frombuffer(data, np.uint8, size, first) if size else np.zeros(0, np.uint8)
    return raw, offsets - first


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GOLDEN = 0x9E3779B97F4A7C15
_SEEDS = (0x2545F4914F6CDD1D, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the result."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def lanes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each raw[starts[k]:ends[k]] as 64-bit numbers, the last one filled up with zeros; and how many each has."""
    counts = (ends - starts + 7) >> 3
    at = ranges(starts, counts, 8)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    values = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))[at]
    left = np.repeat(ends, counts) - at
    short = np.flatnonzero(left < 8)
    values[short] &= (np.uint64(1) << (left[short].astype(np.uint64) << np.uint64(3))) - np.uint64(1)
    return values, counts


def lane_hashes(values: np.ndarray, counts: np.ndarray, sizes: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each span's lanes: each lane is mixed with its place before they are added up.

    Spans of the same size up to eight bytes never share one.
    """
    if not len(counts):
        return np.zeros(0, np.uint64)
    heads = np.cumsum(counts) - counts
    place = mix(np.arange(int(counts.max()), dtype=np.uint64) * np.uint64(_GOLDEN) + np.uint64(_SEEDS[which]))
    mixed = mix(values ^ place[np.arange(len(values)) - np.repeat(heads, counts)])
    return mix(np.add.reduceat(mixed, heads) + sizes.astype(np.uint64) * np.uint64(_GOLDEN) + np.uint64(which))


class Rows:
    """Growing list of number lists, stored flat."""

    def __init__(self, kind: type = np.int64) -> None:
        self.flat, self.ends, self.n = np.zeros(1 << 16, kind), np.zeros(1 << 14, np.int64), 0

    def __len__(self) -> int:
        return self.n

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        used = int(self.ends[self.n])
        while len(self.flat) < used + len(values):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.ends) <= self.n + len(sizes):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[used : used + len(values)] = values
        self.ends[self.n + 1 : self.n + 1 + len(sizes)] = used + np.cumsum(sizes)
        self.n += len(sizes)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers in these rows, one row after another, and how many each has."""
        starts = self.ends[rows]
        sizes = self.ends[rows + 1] - starts
        return self.flat[ranges(starts, sizes)], sizes


class WordNumbers:
    """Numbers words from 0 in the order they come: two have the same number if and only if their bytes are the same.

    Hashes only find the word to compare with; words whose hash an unlike word has taken are told apart in a dict.
    """

    def __init__(self) -> None:
        self.hashes, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted by hash
        self.lanes, self.sizes = Rows(np.uint64), Rows()
        self.unlike: dict[bytes, int] = {}

    def __len__(self) -> int:
        return len(self.lanes)

    def of(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word raw[starts[k]:ends[k]]; and where new words stand, in the order of their numbers."""
        values, counts = lanes(raw, starts, ends)
        sizes = ends - starts
        codes, distinct = pd.factorize(self._hash(values, counts, sizes))
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == distinct if len(self.hashes) else np.zeros(len(distinct), bool)
        numbers = np.empty(len(distinct), np.int64)
        numbers[known] = self.number[at[known]]
        fresh = np.flatnonzero(~known)
        one = np.empty(len(distinct), np.int64)
        one[codes[::-1]] = np.arange(len(codes))[::-1]  # the first place where each occurs
        new = one[fresh]
        heads = np.cumsum(counts) - counts
        if len(fresh):
            numbers[fresh] = len(self) + np.arange(len(fresh))
            self.lanes.add(values[ranges(heads[new], counts[new])], counts[new])
            self.sizes.add(sizes[new], np.ones(len(new), np.int64))
            order = np.argsort(distinct[fresh])
            place = np.searchsorted(self.hashes, distinct[fresh][order])
            self.hashes = np.insert(self.hashes, place, distinct[fresh][order])
            self.number = np.insert(self.number, place, numbers[fresh][order])
        found = numbers[codes]
        alike = self.sizes.flat[found] == sizes
        have, _ = self.lanes.take(found[alike])
        differs = have != (values if alike.all() else values[np.repeat(alike, counts)])
        if differs.any():
            owner = np.repeat(np.flatnonzero(alike), counts[alike])
            alike[owner[differs]] = False
        if not alike.all():
            more = []
            for k in np.flatnonzero(~alike).tolist():
                word = raw[starts[k] : ends[k]].tobytes()
                if word not in self.unlike:
                    self.unlike[word] = len(self)
                    self.lanes.add(values[heads[k] : heads[k] + counts[k]], counts[k : k + 1])
                    self.sizes.add(sizes[k : k + 1], np.ones(1, np.int64))
                    more.append(k)
                found[k] = self.unlike[word]
            new = np.concatenate([new, np.array(more, np.int64)])
        return found, new

    @staticmethod
    def _hash(values: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return lane_hashes(values, counts, sizes)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a slice of texts.

    raw: all bytes; starts, ends: of each word, in bytes; first: n_docs + 1 offsets of the documents' words.
    """

    def __init__(self, column: pa.Array, lower: bool = False, breaks: np.ndarray | None = None):
        raw, offsets = utf8(column)
        self.raw = _LOWER[raw] if lower else raw
        n_docs = len(offsets) - 1
        ink = ~(_SPACE if breaks is None else breaks)[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        before = np.empty_like(ink)
        before[:1] = False
        before[1:] = ink[:-1]
        self.starts = np.flatnonzero(ink & (~before | edge[:-1]))
        after = np.empty_like(ink)
        after[-1:] = False
        after[:-1] = ink[1:]
        self.ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets) if n_docs else np.zeros(1, np.int64)
        self.counts = np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes; which: 0 or 1, two independent ones."""
        return lane_hashes(*lanes(self.raw, self.starts, self.ends), self.ends - self.starts, which)


class WordKeys:
    """Two 64-bit numbers of each word, from a keyed 128-bit digest (BLAKE2b) of its bytes.

    Digests are made once for each distinct word, which is found by its bytes. Words that share a number can't be
    constructed without the key, so what is made of them needs no further comparison. Forgets words when there are many.
    """

    MOST_WORDS, MOST_LANES = 300_000, 2_000_000

    def __init__(self, key: bytes):
        self.key = key
        self.clear()

    def clear(self) -> None:
        self.book, self.digests = WordNumbers(), Rows(np.uint64)

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        if len(self.book) > self.MOST_WORDS or self.book.lanes.ends[len(self.book)] > self.MOST_LANES:
            self.clear()
        number, new = self.book.of(words.raw, words.starts, words.ends)
        raw, key, digest = words.raw.tobytes(), self.key, hashlib.blake2b
        spans = zip(words.starts[new].tolist(), words.ends[new].tolist(), strict=True)
        made = np.frombuffer(b"".join([digest(raw[a:z], digest_size=16, key=key).digest() for a, z in spans]), np.uint64)
        self.digests.add(made, np.full(len(new), 2, np.int64))
        return self.digests.flat[2 * number], self.digests.flat[2 * number + 1]


def single_spaced(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes in which one space stands between two words, and where words start and end there."""
    starts, ends = words.starts, words.ends
    gap = starts[1:] - ends[:-1]
    if ((gap == 0) | ((gap == 1) & (words.raw[ends[:-1]] == 32))).all():
        return words.raw, starts, ends
    sizes = ends - starts
    to = np.cumsum(sizes + 1) - sizes - 1
    raw = np.full(int((sizes + 1).sum()), 32, np.uint8)
    raw[ranges(to, sizes)] = words.raw[ranges(starts, sizes)]
    return raw, to, to + sizes


def gram_hashes(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """The hash of each run of n consecutive entries of h, by start; len(h) - n + 1 of them."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    r = np.uint64(0xD6E8FEB86659FD93)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out ^= h[j : len(h) - n + 1 + j]
        out *= r
        out ^= out >> np.uint64(32)
    return mix(out + np.uint64((salt + n) * _GOLDEN % (1 << 64)))


def ranges(starts: np.ndarray, counts: np.ndarray, step: int = 1) -> np.ndarray:
    """Concatenated s, s + step, ... of c numbers for each pair (s, c)."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - step * (np.cumsum(counts) - counts), counts)
    return np.arange(0, total * step, step, dtype=np.int64) + shift
