"""Packing token sequences: best-fit decreasing with segment-tree search, and sum-of-squares packing.

Documents are tokenized in the tasks that read them and cut into pieces of at most one sequence. Pieces are dealt
by hash into packing groups whose number follows the bytes of the input, so every group stays about the same size
whatever the input; each group is packed by one task. A hot source or a group of copies is spread over all groups.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import codec, default_vocabulary
from .common import text_slices

CAPACITY = 1024
END_ID = 2
#: Bytes of text for each packing group: about 10 million tokens, 10,000 sequences.
GROUP_BYTES = 24 << 20
#: The same where a group holds the ids themselves, and so both matrices of its sequences.
MATRIX_GROUP_BYTES = 6 << 20


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: one, or full ones behind a first piece that may be shorter."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    starts = ([0] if head else []) + list(range(head, n, capacity))
    return [(s, (head if head and s == 0 else capacity)) for s in starts]


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenizes every whole text (null: empty), ends it with ``end_id`` and cuts it losslessly.

    Returns doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit).
    """
    path = vocabulary or default_vocabulary()
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in text_slices(batches):
            doc, piece, start, length, crc, raw = [], [], [], [], [], []
            flat, offsets = bpe.encode_column(b.column("text"))
            flat, last = flat.astype("<u4").tobytes(), int(end_id).to_bytes(4, "little")
            for k, i in enumerate(b.column("doc_id").cast(pa.int64()).to_pylist()):
                ids = flat[4 * offsets[k] : 4 * offsets[k + 1]] + last
                for p, (s, n) in enumerate(cuts(len(ids) // 4, capacity)):
                    part = ids[4 * s : 4 * (s + n)]
                    doc.append(i)
                    piece.append(p)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    raw.append(part)
            columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64())]
            if with_ids:
                columns.append(pa.array(raw, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int, literal: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest first, by sum-of-squares packing.

    counts[g] is how many open bins have gap g. Of the bins that an item of size s fits into, it goes into one whose
    gap g makes the sum of the squared counts smallest (one bin fewer has gap g, one more has g - s); on a tie, the
    smallest such gap. A new bin is opened only if no open one has room, which keeps the sequences few; a bin that
    becomes full counts no more. literal: a new bin counts among the choices, and is opened where it alone makes the
    sum smallest.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    counts = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    n_bins, never = 0, np.iinfo(np.int64).max
    for i in order.tolist():
        s = int(lengths[i])
        if s >= capacity:
            bins[i], offsets[i] = n_bins, 0
            n_bins += 1
            continue
        here = counts[s:capacity]
        change = np.where(here > 0, 2 * (counts[: capacity - s] - here) + 2, never)
        change[0] -= here[0] > 0  # the bin becomes full
        best = int(change.argmin())
        if change[best] < never and not (literal and 2 * counts[capacity - s] + 1 < change[best]):
            gap = s + best
            b = open_bins[gap].pop()
            counts[gap] -= 1
        else:
            gap, b = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            open_bins[gap - s].append(b)
            counts[gap - s] += 1
    return bins, offsets


class CapacityTree:
    """Segment tree over gaps 0..capacity: how many open bins each range holds; finds the smallest gap of at least s."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)

    def add(self, gap: int, n: int) -> None:
        i = gap + self.size
        while i:
            self.tree[i] += n
            i >>= 1

    def at_least(self, s: int) -> int | None:
        tree, i = self.tree, s + self.size
        if tree[i]:
            return s
        while i > 1:  # up, until a right neighbour holds a bin; then down to its smallest gap
            if not i & 1 and tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if tree[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest first, each into the open bin that it fills best."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree = CapacityTree(capacity)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    n_bins = 0
    for i in order.tolist():
        s = int(lengths[i])
        gap = tree.at_least(s) if s < capacity else None
        if gap is None:
            gap, b = capacity, n_bins
            n_bins += 1
        else:
            b = open_bins[gap].pop()
            tree.add(gap, -1)
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            open_bins[gap - s].append(b)
            tree.add(gap - s, 1)
    return bins, offsets


def group_count(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> int:
    """How many packing groups the bytes of all texts ask for."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(1, math.ceil(size / group_bytes))


def _grouped(parts: DataFrame, groups: int) -> DataFrame:
    # doc_id and piece spread long documents, copies and hot sources alike
    return parts.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int")).groupBy("g")


def _in_order(t: pa.Table) -> pa.Table:
    """Pieces in a fixed order, those without an id last; ids stay in Arrow, where a null changes no other value."""
    return t.combine_chunks().sort_by([(c, "ascending") for c in ("doc_id", "piece", "start", "length", "ids_crc32")])


def pack_pieces(docs: DataFrame, method: Callable = sum_of_squares, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Packs all documents into sequences of at most ``capacity`` tokens; one row per piece.

    Null and empty texts are one end token; texts of any length are cut, never shortened; repeated rows are packed as
    often as they come, and rows without an id like any other; other columns are ignored; an empty table gives an
    empty result. sequence_id is group * 2**40 + bin; offsets are gapless from 0 in each sequence.
    """
    groups = group_count(docs, group_bytes)

    def pack(t: pa.Table) -> pa.Table:
        t = _in_order(t)
        bins, offsets = method(t["length"].to_numpy().astype(np.int64), capacity)
        t = t.set_column(t.schema.get_field_index("length"), "length", t["length"].cast(pa.int64()))
        placed = t.append_column("sequence_id", pa.array((t["g"][0].as_py() << 40) + bins)).append_column("offset", pa.array(offsets))
        return placed.select(["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return _grouped(pieces(docs, vocabulary, capacity, end_id), groups).applyInArrow(pack, schema)


def packed_sequences(docs: DataFrame, method: Callable = best_fit_decreasing, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, group_bytes: int = MATRIX_GROUP_BYTES) -> DataFrame:
    """Packed training rows, one per sequence: the real output of the packer.

    sequence_id; ids (binary: capacity little-endian unsigned 32-bit ids, zero behind n_tokens), n_tokens;
    doc_ids, pieces, starts of its segments in order; cu_seqlens (cumulative segment lengths from 0);
    positions (binary like ids: token positions that restart at 0 with each segment). Overlong documents are cut
    losslessly: doc_ids, pieces and starts say where each segment belongs. Null and empty texts are one end token;
    rows that repeat or lack an id are packed like any other (a null among doc_ids); other columns are ignored; an
    empty table gives an empty result.
    """
    groups = group_count(docs, group_bytes)

    def pack(t: pa.Table) -> pa.Table:
        t = _in_order(t)
        lengths = t["length"].to_numpy().astype(np.int64)
        bins, offsets = method(lengths, capacity)
        order = np.lexsort((offsets, bins))
        t, lengths, bins = t.take(pa.array(order)), lengths[order], bins[order]
        heads = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        ends = np.append(heads[1:], len(bins))
        parts = t["ids"].to_pylist()
        ids, positions, sums, used = [], [], [], []
        for a, z in zip(heads.tolist(), ends.tolist(), strict=True):
            sizes = lengths[a:z]
            to = np.cumsum(sizes)
            row = b"".join(parts[a:z])
            ids.append(row + bytes(4 * capacity - len(row)))
            position = np.zeros(capacity, "<u4")
            position[: to[-1]] = np.arange(to[-1]) - np.repeat(to - sizes, sizes)
            positions.append(position.tobytes())
            sums.append([0, *to.tolist()])
            used.append(int(to[-1]))
        segments = pa.array(np.append(heads, len(bins)), pa.int32())
        lists = [pa.ListArray.from_arrays(segments, t[c].combine_chunks()) for c in ("doc_id", "piece", "start")]
        number = pa.array((t["g"][0].as_py() << 40) + np.arange(len(heads)))
        columns = [number, pa.array(ids, pa.binary()), pa.array(used, pa.int32()), *lists, pa.array(sums, pa.list_(pa.int32())), pa.array(positions, pa.binary())]
        return pa.table(columns, names=["sequence_id", "ids", "n_tokens", "doc_ids", "pieces", "starts", "cu_seqlens", "positions"])

    schema = "sequence_id long, ids binary, n_tokens int, doc_ids array<long>, pieces array<int>, starts array<long>, cu_seqlens array<int>, positions binary"
    return _grouped(pieces(docs, vocabulary, capacity, end_id, with_ids=True), groups).applyInArrow(pack, schema)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Writes packed_sequences() as Parquet: id matrices row by row, cumulative segment lengths and position resets."""
    packed_sequences(docs, **options).write.mode("overwrite").parquet(path)


def op2_token_matrix(spark, sf_dir: str) -> DataFrame:
    """Digests of the packed rows: everything but the two matrices themselves, of which the checksums stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return packed_sequences(docs).select(
        "sequence_id", "n_tokens", "doc_ids", "pieces", "starts", "cu_seqlens",
        F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"),
    )


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
