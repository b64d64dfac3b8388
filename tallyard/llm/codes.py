"""Vector code compression: product codes of exact integer arithmetic, found by slice-and-intersect bitmasks.

A vector becomes integers, is cut into parts, and each part is replaced by the number of the nearest entry of its
codebook, of at most 64 entries. To find the nearest ones of many parts at once:

1. Every dimension keeps its entries' coordinates sorted, and for each place a 64-bit mask of the entries before it.
2. With a radius, a part selects a range of each dimension: the masks at its ends differ by the entries inside. The
   AND of all dimensions is the set of entries in the cube around the part.
3. Distances of these candidates are computed exactly. If the nearest lies within the radius, no entry outside of the
   cube can be nearer or as near. Otherwise its distance is the next radius, and without a candidate twice the radius.

The codebooks follow rounds of assignment and exact means: tasks add up the parts of each entry, Spark adds up the
tasks, and only the codebooks (64 vectors of each length) are held by the driver and shipped to tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Integers beyond this could make a sum of squares too large for 64 bits.
MOST = 1 << 28
#: Parts that are looked up at once.
CHUNK = 8192


class Slices:
    """A codebook (entries x dimensions, at most 64 entries) as sorted coordinates with masks of the entries before."""

    def __init__(self, book: np.ndarray):
        self.book = book
        order = np.argsort(book, axis=0, kind="stable")
        self.sorted = [np.ascontiguousarray(book[order[:, j], j]) for j in range(book.shape[1])]
        bits = np.uint64(1) << order.astype(np.uint64)
        self.before = [np.concatenate([np.zeros(1, np.uint64), np.bitwise_or.accumulate(bits[:, j])]) for j in range(book.shape[1])]
        # half of the entries have their nearest neighbour within this distance
        apart = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(apart, np.iinfo(np.int64).max)
        self.radius = int(np.sqrt(float(np.median(apart.min(axis=1))))) + 1 if len(book) > 1 else 1

    def within(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each part, the mask of entries whose every coordinate is at most its radius away."""
        mask = np.full(len(parts), ~np.uint64(0))
        for j, (line, before) in enumerate(zip(self.sorted, self.before, strict=True)):
            low = np.searchsorted(line, parts[:, j] - radius, side="left")
            high = np.searchsorted(line, parts[:, j] + radius, side="right")
            mask &= before[high] ^ before[low]
        return mask

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part (of equally near ones the first), and its squared distance."""
        code, best = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        if not parts.shape[1]:
            return code, best
        left, radius = np.arange(len(parts)), np.full(len(parts), self.radius, np.int64)
        while len(left):
            mask = self.within(parts[left], radius)
            some = np.flatnonzero(mask)
            radius[mask == 0] *= 2
            again = mask == 0
            if len(some):
                inside = np.unpackbits(mask[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                row, entry = np.nonzero(inside)
                far = ((parts[left[some]][row] - self.book[entry]) ** 2).sum(axis=1)
                heads = np.searchsorted(row, np.arange(len(some)))
                least = np.minimum.reduceat(far, heads)
                hits = np.flatnonzero(far == least[row])  # in the order of entries
                first = hits[np.searchsorted(row[hits], np.arange(len(some)))]
                at = left[some]
                code[at], best[at] = entry[first], least
                wide = least > radius[some] ** 2
                radius[some[wide]] = np.ceil(np.sqrt(least[wide].astype(np.float64))).astype(np.int64) + 1
                again[some[wide]] = True
            left, radius = left[again], radius[again]
        return code, best


def integers(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of ``width`` components as integers, filled up with zeros to a multiple of the number of parts."""
    flat = np.floor(SCALE * column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    if len(flat) and np.abs(flat).max() > MOST:
        raise ValueError(f"components beyond {MOST // SCALE} can't be coded in 64 bits")
    rows = flat.astype(np.int64).reshape(len(column), width)
    return np.pad(rows, ((0, 0), (0, -width % PARTS)))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each length in the batch: the length, its rows, and their vectors as integers, some at a time."""
    lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
    for width in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == width)
        for k in range(0, len(rows), CHUNK):
            some = rows[k : k + CHUNK]
            yield width, some, integers(batch.column("v").take(pa.array(some)), width)


def kept_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, v (of doubles) of the rows whose vector isn't null and has only finite components."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embeddings.where(F.col("embedding").isNotNull() & finite).select("vec_id", "label", v.alias("v"))


def _cut(books: dict[int, np.ndarray]) -> dict[int, list[Slices]]:
    return {width: [Slices(part) for part in book] for width, book in books.items()}


def first_books(vectors: DataFrame) -> dict[int, np.ndarray]:
    """By length of vector, the parts of the vectors of the 64 smallest ids: parts x entries x dimensions."""
    order = Window.partitionBy(F.size("v")).orderBy(F.col("vec_id").asc_nulls_last(), "v")
    first = vectors.withColumn("place", F.row_number().over(order)).where(F.col("place") <= ENTRIES).select("place", "v").toArrow()
    books = {}
    for width, rows, values in _by_length(first.sort_by("place").combine_chunks().to_batches()[0]) if first.num_rows else ():
        books[width] = values.reshape(len(rows), PARTS, -1).transpose(1, 0, 2).copy()
    return books


def next_books(vectors: DataFrame, books: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Each entry as the floor of the mean of the parts that are nearest to it; entries without parts stay."""
    shipped = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = _cut(shipped.value)
        sums = {w: np.zeros(book.shape, np.int64) for w, book in shipped.value.items()}
        counts = {w: np.zeros(book.shape[:2], np.int64) for w, book in shipped.value.items()}
        for b in batches:
            for width, rows, values in _by_length(b):
                parts = values.reshape(len(rows), PARTS, -1)
                for p in range(PARTS):
                    code, _ = slices[width][p].nearest(parts[:, p])
                    order = np.argsort(code, kind="stable")
                    used, heads = np.unique(code[order], return_index=True)
                    sums[width][p, used] += np.add.reduceat(parts[order, p], heads, axis=0)
                    counts[width][p, used] += np.diff(np.append(heads, len(code)))
        for width, n in counts.items():
            p, e = np.nonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(p), width, np.int32)), pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(n[p, e]), pa.array(list(sums[width][p, e]), pa.list_(pa.int64()))],
                names=["width", "part", "entry", "n", "sums"],
            )

    partial = vectors.select("v").mapInArrow(run, "width int, part int, entry int, n long, sums array<long>")
    flat = partial.select("width", "part", "entry", "n", F.posexplode_outer("sums").alias("at", "s")).groupBy("width", "part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    new = {w: book.copy() for w, book in books.items()}
    for width, part, entry, at, n, s in flat.collect():  # as many rows as the codebooks have components
        if at is not None:
            new[width][part, entry, at] = s // n
    shipped.unpersist()
    return new


def book_digest(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def assigned(vectors: DataFrame, books: dict[int, np.ndarray]) -> DataFrame:
    """vec_id, label, code, error and codebooks_sha256 of each vector."""
    shipped = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = _cut(shipped.value)
        digests = {w: book_digest(book) for w, book in shipped.value.items()}
        for b in batches:
            for width, rows, values in _by_length(b):
                parts = values.reshape(len(rows), PARTS, -1)
                codes, error = np.zeros((len(rows), PARTS), np.uint8), np.zeros(len(rows), np.int64)
                for p in range(PARTS):
                    code, far = slices[width][p].nearest(parts[:, p])
                    codes[:, p] = code
                    error += far
                text = codes.tobytes().hex()
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(at), b.column("label").take(at), pa.array([text[k : k + 2 * PARTS] for k in range(0, len(text), 2 * PARTS)]), pa.array(error), pa.array([digests[width]] * len(rows), pa.string())],
                    names=["vec_id", "label", "code", "error", "codebooks_sha256"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return vectors.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long, codebooks_sha256 string")


def compress(embeddings: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each vector.

    Vectors that are null or hold null or non-finite components are left out. Vectors of each length are coded apart,
    with codebooks of their own; where 16 doesn't divide the length, zeros fill it up (to no component: every code is 0).
    The codebooks start from the vectors of the 64 smallest ids (null last; of equal ids the smaller vector), fewer if
    there are fewer. Rows that repeat an id, or lack one, are coded each; other columns are ignored; an empty table gives an
    empty result. label_error adds up the errors of equal labels (nulls together), of all lengths. A component beyond
    about a million is refused with an error.
    """
    vectors = kept_vectors(embeddings)
    books = first_books(vectors)
    for _ in range(rounds):
        books = next_books(vectors, books)
    coded = materialize(assigned(vectors, books), "codes")
    of_label = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("same"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
