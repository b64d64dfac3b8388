"""The k documents of the highest inner product with a query among those it may see, without scoring all of them.

1. Documents lie in cells around a few of them (pivots), by the nearest one. A cell's distance from its pivot bounds
   every score in it: q.d = q.c + q.(d - c) <= q.c + |q| r. Lengths without a pivot have a cell around zero, where
   that is q.d <= |q| |d|.
2. A query takes the cells that its principal has documents in by their bound, best first, until they hold k of them,
   and scores these: its k-th hit is a floor that no worse document can pass.
3. Of the other cells only those whose bound reaches the floor are scored. Nothing else can be a hit, so the result is
   that of scoring everything.

Documents and queries meet in blocks of a bounded size, so that neither a principal nor a cell is ever in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import written

#: Pivots at most: they are held by the driver and shipped to tasks.
PIVOTS = 256


def _finite(vector: str) -> Column:
    return F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def pivots_of(vectors: DataFrame, most: int = PIVOTS) -> dict[int, np.ndarray]:
    """By length, some of the vectors (doc_id, vector), by a hash of their ids: about the square root of their number."""
    some = min(most, isqrt(vectors.count()) + 1)
    rows = vectors.select("doc_id", "vector").orderBy(F.xxhash64("doc_id"), "doc_id").limit(some).collect()
    found: dict[int, list] = {}
    for _, v in rows:
        found.setdefault(len(v), []).append(v)
    return {n: np.array(vs, float).reshape(len(vs), n) for n, vs in found.items()}


def in_cells(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds cell (the nearest pivot's number; -1: none of that length), and far, the distance from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("vector")
            lengths = v.value_lengths().to_numpy(zero_copy_only=False)
            cell, far = np.full(b.num_rows, -1, np.int32), np.zeros(b.num_rows)
            for n in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == n)
                d = _matrix(v.take(pa.array(rows)), n)
                if n in pivots and n:
                    c = pivots[n]
                    cell[rows] = np.argmin((c * c).sum(axis=1) - 2 * (d @ c.T), axis=1)
                    d = d - c[cell[rows]]
                far[rows] = np.sqrt((d * d).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(far)], names=[*b.schema.names, "cell", "far"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(run, f"{fields}, cell int, far double")


def _planned(queries: DataFrame, pivots: dict[int, np.ndarray], k: int) -> DataFrame:
    """Adds first (the cells that are scored at once), and of the others rest and bounds.

    queries: query_id, principal, query, cells (array of cell, n, far of the query's length).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, rest, bounds = [], [], []
            for query, cells in zip(b.column("query"), b.column("cells"), strict=True):  # one at a time: as Python objects, the cells of a batch would fill gigabytes
                q = query.values.to_numpy(zero_copy_only=False)
                ids, n, far = (cells.values.field(x).to_numpy(zero_copy_only=False) for x in ("cell", "n", "far"))
                size = float(np.sqrt((q * q).sum()))
                centre, away = np.zeros(len(ids)), np.zeros(len(ids))
                at = ids >= 0
                if at.any():
                    c = pivots[len(q)][ids[at]]
                    centre[at], away[at] = c @ q, np.sqrt((c * c).sum(axis=1))
                bound = centre + size * far + 1e-9 * size * (away + far)  # what rounding may take away
                order = np.lexsort((ids, -bound))
                needed = int(np.searchsorted(np.cumsum(n[order]), k)) + 1
                first.append(ids[order[:needed]])
                rest.append(ids[order[needed:]])
                bounds.append(bound[order[needed:]])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("query_id", "principal", "query")), pa.array(first, pa.list_(pa.int32())), pa.array(rest, pa.list_(pa.int32())), pa.array(bounds, pa.list_(pa.float64()))],
                names=["query_id", "principal", "query", "first", "rest", "bounds"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in queries.schema if f.name != "cells")
    return queries.mapInArrow(run, f"{fields}, first array<int>, rest array<int>, bounds array<double>")


def _scored(asks: DataFrame, docs: DataFrame, parts: DataFrame, k: int, queries_block: int) -> DataFrame:
    """query_id, doc_id, score of each query's k best in every block of the cells it asks (query_id, principal, query, cell)."""
    query_id, doc_id = asks.schema["query_id"].dataType.simpleString(), docs.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for qs, ds in zip(b.column("queries"), b.column("docs"), strict=True):
                qs, ds = qs.values, ds.values
                qv, dv = qs.field("query"), ds.field("vector")
                width = len(qv[0].as_py())
                q, d = _matrix(qv, width), _matrix(dv, width)
                score = np.zeros((len(q), len(d)))
                for j in range(width):  # from left to right, as one would by hand
                    score += q[:, j : j + 1] * d[None, :, j]
                ids = ds.field("doc_id").to_pylist()
                asked, found, scores = [], [], []
                for i, name in enumerate(qs.field("query_id").to_pylist()):
                    line = score[i]
                    least = np.partition(line, len(line) - k)[len(line) - k] if len(line) > k else -np.inf
                    best = sorted((-line[j], ids[j]) for j in np.flatnonzero(line >= least).tolist())[:k]
                    asked += [name] * len(best)
                    found += [x for _, x in best]
                    scores += [-float(s) for s, _ in best]
                yield pa.RecordBatch.from_arrays([pa.array(asked, qs.field("query_id").type), pa.array(found, ds.field("doc_id").type), pa.array(scores, pa.float64())], names=["query_id", "doc_id", "score"])

    where = ["principal", "width", "cell"]
    asks = asks.withColumn("width", F.size("query"))
    many = asks.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / queries_block).cast("int").alias("n_queries"))
    askers = asks.join(many, where).withColumn("turn", F.pmod(F.xxhash64("query_id"), F.col("n_queries")))
    askers = askers.groupBy(*where, "turn").agg(F.collect_list(F.struct("query_id", "query")).alias("queries")).join(parts, where)
    askers = askers.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = askers.join(docs, [*where, "part"]).select("queries", "docs")
    return pairs.mapInArrow(run, f"query_id {query_id}, doc_id {doc_id}, score double")


def _best(hits: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def nearest_granted(vectors: DataFrame, grants: DataFrame, queries: DataFrame, k: int, docs_block: int = 2048, queries_block: int = 128, most_pivots: int = PIVOTS) -> tuple[DataFrame, DataFrame]:
    """(hits, work): query_id, doc_id, score, rank; and of each query the documents granted and those that were scored."""
    usable = vectors.select("doc_id", F.col("vector").cast("array<double>").alias("vector")).where(F.col("vector").isNotNull()).where(_finite("vector"))
    asked = queries.select("query_id", "principal", F.col("query").cast("array<double>").alias("query")).where("query IS NOT NULL AND size(query) > 0").where(_finite("query"))
    pivots = pivots_of(usable, most_pivots)
    held = in_cells(usable, pivots).join(grants.join(asked.select("principal").distinct(), "principal", "left_semi").distinct(), "doc_id").withColumn("width", F.size("vector"))
    held = written(held, "granted-in-cells")
    where = ["principal", "width", "cell"]
    stats = written(held.groupBy(*where).agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")), "cells")
    parts = stats.select(*where, F.ceil(F.col("n") / docs_block).cast("int").alias("parts"))
    docs = held.join(parts, where).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    docs = docs.groupBy(*where, "part").agg(F.collect_list(F.struct("doc_id", "vector")).alias("docs"))
    # at most PIVOTS cells a principal and length
    known = stats.groupBy("principal", "width").agg(F.collect_list(F.struct("cell", "n", "far")).alias("cells"))
    plan = asked.withColumn("width", F.size("query")).join(known, ["principal", "width"]).select("query_id", "principal", "query", "cells")
    plan = written(_planned(plan, pivots, k), "search-plan")
    near = written(_best(_scored(plan.withColumn("cell", F.explode("first")).select("query_id", "principal", "query", "cell"), docs, parts, k, queries_block), k), "first-hits")
    floor = near.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    more = plan.join(floor, "query_id", "left").select("query_id", "principal", "query", "floor", F.explode(F.arrays_zip("rest", "bounds")).alias("x"))
    more = more.where(F.col("floor").isNull() | (F.col("x.bounds") >= F.col("floor"))).select("query_id", "principal", "query", F.col("x.rest").alias("cell"))
    more = written(more, "cells-left")
    hits = _best(near.select("query_id", "doc_id", "score").unionByName(_scored(more, docs, parts, k, queries_block)), k)
    cells = plan.select("query_id", "principal", F.size("query").alias("width"), F.explode("first").alias("cell")).unionByName(more.select("query_id", "principal", F.size("query").alias("width"), "cell"))
    work = cells.join(stats, where).groupBy("query_id").agg(F.sum("n").alias("scored"))
    granted = asked.withColumn("width", F.size("query")).join(stats.groupBy("principal", "width").agg(F.sum("n").alias("granted")), ["principal", "width"]).select("query_id", "granted")
    return hits.select("query_id", "doc_id", "score", "rank"), granted.join(work, "query_id")
