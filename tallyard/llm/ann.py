"""Approximate nearest neighbours by score-aware (anisotropic) four-bit quantisation with exact reranking.

Smallest Euclidean distance is turned into maximum inner product: a vector x becomes (x, -|x|^2 / 2), a query q
becomes (q, 1). Pairs of components are quantised to 16 centres each; codes and centres are fitted to a loss that
weighs the residual's part along the vector more than the part across it, since that is what changes high inner
products. A search adds up table entries of the codes, two four-bit codes a byte, and reranks the best by their
exact distances. Equal vectors are one entry of the index, with the smallest of their ids; every row is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Bound of the sample that the centres are fitted on, chosen by a hash of the id.
SAMPLE = 8192
#: Entries of the index, and queries, that meet in a task; entries of a block that are reranked exactly.
BLOCK, QUERIES, RERANK = 16384, 1024, 384
PAIR = 2
FOUND = "query_id long, vec_id long, score double"


@dataclass
class Codebook:
    mean: np.ndarray  # (dim,)
    scale: float  # of the last component
    centres: np.ndarray  # (parts, 16, PAIR)
    eta: float  # weight of the parallel residual against the orthogonal

    def augment(self, x: np.ndarray) -> np.ndarray:
        x = x - self.mean
        last = -0.5 * (x * x).sum(axis=1, keepdims=True) / self.scale
        out = np.concatenate([x, last], axis=1)
        return np.pad(out, ((0, 0), (0, -out.shape[1] % PAIR)))

    def augment_queries(self, q: np.ndarray) -> np.ndarray:
        out = np.concatenate([q - self.mean, np.full((len(q), 1), self.scale)], axis=1)
        return np.pad(out, ((0, 0), (0, -out.shape[1] % PAIR)))

    def encode(self, x: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """Four-bit codes (rows, parts) of augmented vectors: coordinate descent on the score-aware loss."""
        parts = x.reshape(len(x), -1, PAIR)
        along = parts / np.maximum(np.linalg.norm(x, axis=1), 1e-12)[:, None, None]
        codes = np.stack([((parts[:, m, None, :] - self.centres[m]) ** 2).sum(axis=2).argmin(axis=1) for m in range(parts.shape[1])], axis=1)
        residual = parts - self.centres[np.arange(parts.shape[1]), codes]
        parallel = (residual * along).sum(axis=2)
        total = parallel.sum(axis=1)
        for _ in range(sweeps):
            for m in range(parts.shape[1]):
                left = parts[:, m, None, :] - self.centres[m]
                here = (left * along[:, m, None, :]).sum(axis=2)
                others = total - parallel[:, m]
                cost = (left * left).sum(axis=2) + (self.eta - 1) * (others[:, None] + here) ** 2
                codes[:, m] = cost.argmin(axis=1)
                parallel[:, m] = np.take_along_axis(here, codes[:, m, None], axis=1)[:, 0]
                total = others + parallel[:, m]
        return codes.astype(np.uint8)


def fit_codebook(sample: np.ndarray, threshold: float = 0.2, rounds: int = 6, seed: int = 3) -> Codebook:
    """Centres for vectors (rows, dim); threshold: the cosine from which inner products count (sets the weight)."""
    rng = np.random.default_rng(seed)
    sample = np.asarray(sample, np.float64)
    dim = sample.shape[1]
    mean = sample.mean(axis=0)
    half = 0.5 * ((sample - mean) ** 2).sum(axis=1)
    scale = max(float(half.std()), 1e-9) / max(float(sample.std()), 1e-9)
    book = Codebook(mean, scale, np.zeros((-(-(dim + 1) // PAIR), 16, PAIR)), max(1.0, dim * threshold**2 / (1 - threshold**2)))
    x = book.augment(sample)
    parts = x.reshape(len(x), -1, PAIR)
    for m in range(parts.shape[1]):  # plain k-means to begin with
        centres = parts[rng.choice(len(x), 16, replace=len(x) < 16), m]
        for _ in range(8):
            near = ((parts[:, m, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
            n = np.bincount(near, minlength=16)
            for a in range(PAIR):
                total = np.bincount(near, weights=parts[:, m, a], minlength=16)
                centres[:, a] = np.where(n > 0, total / np.maximum(n, 1), centres[:, a])
        book.centres[m] = centres
    along = parts / np.maximum(np.linalg.norm(x, axis=1), 1e-12)[:, None, None]
    extra = book.eta - 1
    for _ in range(rounds):
        codes = book.encode(x, sweeps=1)
        parallel = ((parts - book.centres[np.arange(parts.shape[1]), codes]) * along).sum(axis=2)
        total = parallel.sum(axis=1)
        for m in range(parts.shape[1]):  # each centre: weighted least squares, the other parts being fixed
            u, code = along[:, m], codes[:, m]
            target = parts[:, m] + extra * u * (total - parallel[:, m] + (parts[:, m] * u).sum(axis=1))[:, None]
            n = np.bincount(code, minlength=16)
            left = np.zeros((16, PAIR, PAIR))
            right = np.zeros((16, PAIR))
            for a in range(PAIR):
                right[:, a] = np.bincount(code, weights=target[:, a], minlength=16)
                for b in range(PAIR):
                    left[:, a, b] = extra * np.bincount(code, weights=u[:, a] * u[:, b], minlength=16) + (a == b) * n
            used = n > 0
            book.centres[m][used] = np.linalg.solve(left[used] + 1e-9 * np.eye(PAIR), right[used][:, :, None])[:, :, 0]
            now = ((parts[:, m] - book.centres[m][code]) * u).sum(axis=1)
            total += now - parallel[:, m]
            parallel[:, m] = now
    return book


def pack_codes(codes: np.ndarray) -> np.ndarray:
    """Two four-bit codes a byte."""
    codes = np.pad(codes, ((0, 0), (0, codes.shape[1] % 2)))
    return codes[:, ::2] | (codes[:, 1::2] << 4)


def scan(book: Codebook, packed: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Approximate inner products (queries, rows) from tables of the codes."""
    q = book.augment_queries(queries).reshape(len(queries), -1, PAIR)
    tables = np.einsum("qma,mca->qmc", q, book.centres).astype(np.float32)
    if tables.shape[1] % 2:
        tables = np.pad(tables, ((0, 0), (0, 1), (0, 0)))
    both = (tables[:, ::2, None, :] + tables[:, 1::2, :, None]).reshape(len(queries), -1, 256)
    out = np.zeros((len(queries), len(packed)), np.float32)
    for m in range(packed.shape[1]):
        out += np.take(both[:, m], packed[:, m], axis=1)
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v of the vectors that take part: not null or zero, all components finite."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & v.isNotNull() & fine).dropDuplicates(["id", "v"])


def index_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: v, and ids, the k + 1 smallest that share it (a search for k can need no others)."""
    part = F.pmod(F.xxhash64("id"), F.lit(64))
    some = vectors.withColumn("r", F.row_number().over(Window.partitionBy("v", part).orderBy("id"))).where(F.col("r") <= k + 1)
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    return some.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def nearest(vectors: DataFrame, query_where, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", rerank: int = RERANK) -> DataFrame:
    """The k nearest rows of each row for which the condition ``query_where`` on column ``id`` holds, itself left out.

    Returns query_id, rank (from 1), vec_id and score (Euclidean distance in double precision), nearest first, ties
    to the smaller id. Rows that don't take part (see :func:`usable`) neither ask nor are found; exact repeats of a
    row count once; with fewer than k others, all are returned; an empty table gives an empty result. Vectors of
    different lengths have no distance: each length is searched by itself, with centres of its own.
    """
    rows = materialize(usable(vectors, id_col, vector_col), "vectors")
    found = rows.sparkSession.createDataFrame([], FOUND)
    for (length,) in rows.groupBy(F.size("v").alias("n")).count().orderBy("n").select("n").toLocalIterator():
        part = rows.where(F.size("v") == length)
        queries = part.where(query_where)
        if not queries.isEmpty():
            found = found.unionByName(_search(part, queries, k, rerank))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, queries: DataFrame, k: int, rerank: int) -> DataFrame:
    """Candidates (query_id, vec_id, score) among vectors of one length: the k best of each block of the index."""
    index = materialize(index_vectors(rows, k), "distinct-vectors")
    n = index.count()
    n_queries = queries.count()
    sample = index.orderBy(F.xxhash64("v"), F.col("ids")[0]).limit(SAMPLE).select("v").toArrow()["v"].to_pylist()
    book = fit_codebook(np.array(sample))
    blocks, chunks = max(1, -(-n // BLOCK)), max(1, -(-n_queries // QUERIES))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        wide = lambda t: t["v"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        x, q = wide(left), wide(right)
        packed = np.frombuffer(b"".join(left["code"].to_pylist()), np.uint8).reshape(len(x), -1)
        lists = left["ids"].combine_chunks()
        at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        names = right["id"].to_numpy()
        out_q, out_v, out_s = [], [], []
        for a in range(0, len(q), 64):
            rough = scan(book, packed, q[a : a + 64])
            best = np.argpartition(-rough, rerank, axis=1)[:, :rerank] if len(x) > rerank else np.tile(np.arange(len(x)), (len(rough), 1))
            for k_, rows_ in enumerate(best):
                d = np.sqrt(np.cumsum((x[rows_] - q[a + k_]) ** 2, axis=1)[:, -1])  # summed from left to right
                sizes = at[rows_ + 1] - at[rows_]
                ids = np.concatenate([flat[at[r] : at[r + 1]] for r in rows_])
                score = np.repeat(d, sizes)
                other = ids != names[a + k_]
                ids, score = ids[other], score[other]
                order = np.lexsort((ids, score))[:k]
                out_q.append(np.full(len(order), names[a + k_]))
                out_v.append(ids[order])
                out_s.append(score[order])
        return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("v").flatten().to_numpy().reshape(b.num_rows, -1)
            codes = pack_codes(book.encode(book.augment(x)))
            yield pa.RecordBatch.from_arrays([b.column("v"), b.column("ids"), pa.array([c.tobytes() for c in codes], pa.binary())], names=["v", "ids", "code"])

    coded = materialize(index.mapInArrow(encode, "v array<double>, ids array<long>, code binary"), "coded-vectors")
    left = coded.withColumn("block", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(blocks)).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = queries.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(search, FOUND)


def op4_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0)


