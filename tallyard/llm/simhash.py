"""SimHash near-duplicates: 64-bit fingerprints, compared bit-sliced within buckets of shared bits.

1. A fingerprint has the bits that over half of the hashes of a text's shingles have. Documents of one fingerprint are
   one from here on, so copies cost nothing.
2. The bits are cut into radius + 1 blocks: two fingerprints that differ in at most ``radius`` bits agree in one of
   them. Fingerprints that agree in a block are a bucket. A bucket above ``bucket`` fingerprints is cut further in the
   same way, by blocks of the bits it doesn't share yet, so that no pair within the radius is lost and no bucket
   stays large: n bits that aren't shared leave at most 2**n fingerprints.
3. In a task, the fingerprints of a bucket stand vertically, 64 in a word for each bit (bit planes). A fingerprint
   meets a word by XOR, plane by plane; carry-save counters add up the differing bits of all 64 at once, and words of
   which every fingerprint exceeds the radius are abandoned.
4. Links are kept as stars within a task, and connected components join them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, discard, materialize, one_row_per_id, ranges, single_spaced, text_slices
from .components import connected_components

RADIUS, SHINGLE, SEED = 2, 3, 42
#: Fingerprints of a bucket that isn't cut further; bits not shared from which on none is.
BUCKET, FEW_BITS = 1024, 10
#: Rows of buckets that a task is meant to hold, and pairs of a fingerprint and a word that are compared at once.
TASK_ROWS, CHUNK = 100_000, 1 << 15
#: Hashes whose bits are counted at once; planes after which words are looked through for those to abandon.
HASHES, EVERY = 1 << 16, 6


def fingerprints_of(column: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text; zero for one without words."""
    words = Words(column, lower=True)
    raw, begin, end = single_spaced(words)
    raw = raw.tobytes()
    n = np.where(words.counts > 0, np.maximum(words.counts - shingle + 1, 1), 0)
    at = ranges(words.first[:-1], n)
    doc = np.repeat(np.arange(len(n)), n)
    last = np.minimum(at + shingle, words.first[1:][doc]) - 1
    starts, ends = begin[at], end[last]
    counts = np.zeros((len(n), 64), np.int64)
    hashed = xxhash.xxh64_intdigest
    for k in range(0, len(at), HASHES):
        spans = zip(starts[k : k + HASHES].tolist(), ends[k : k + HASHES].tolist(), strict=True)
        h = np.array([hashed(raw[a:z], seed) for a, z in spans], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        owner, heads = np.unique(doc[k : k + HASHES], return_index=True)
        counts[owner] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    bits = (2 * counts > n[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def read_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(fingerprints_of(b.column("text"), shingle).view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def masks_below(mask: int, radius: int) -> list[int]:
    """The mask with each of radius + 1 blocks of the bits that it lacks."""
    lacks = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(lacks) * k // (radius + 1) for k in range(radius + 2)]
    return [mask | sum(1 << b for b in lacks[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True) if z > a]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _buckets(firsts: DataFrame, radius: int, bucket: int) -> DataFrame:
    """mask, value, fp, doc_id: fingerprints that share the bits of a mask, of value, with at least one other."""
    spark, done = firsts.sparkSession, []
    rows, masks = firsts.withColumn("mask", F.lit(0).cast("long")), [0]
    for turn in range(64):
        below = {m: masks_below(m, radius) for m in masks}
        steps = spark.createDataFrame([(_signed(m), [_signed(x) for x in xs]) for m, xs in below.items()], "mask long, masks array<long>")
        rows = rows.join(F.broadcast(steps), "mask").select("fp", "doc_id", F.explode("masks").alias("mask"))  # at most 3 ** turn fixed rows
        rows = rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        rows = materialize(rows.join(sizes, ["mask", "value"]), f"buckets-{turn}")
        small = (F.col("c") <= bucket) | (64 - F.bit_count("mask") <= FEW_BITS)
        done.append(rows.where(small).select("mask", "value", "fp", "doc_id"))
        rows = rows.where(~small).select("fp", "doc_id", "mask")
        masks = [r[0] % (1 << 64) for r in rows.select("mask").distinct().collect()]  # of the few masks there are
        if not masks:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def near_pairs(fps: np.ndarray, bucket: np.ndarray, mask: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of fingerprints of one bucket that differ in at most ``radius`` bits, in portions.

    fps: fingerprints, by bucket; bucket: of each, its bucket's number; all of a bucket share the bits of ``mask``.
    """
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.append(heads, len(fps)))
    n_words = (sizes + 63) >> 6
    first_word = np.cumsum(n_words) - n_words
    place = np.arange(len(fps)) - np.repeat(heads, sizes)
    word, bit = np.repeat(first_word, sizes) + (place >> 6), (place & 63).astype(np.uint64)
    total = int(n_words.sum())
    start = np.zeros(total, np.int64)
    start[word[bit == 0]] = np.flatnonzero(bit == 0)  # where each word's first fingerprint stands
    edges = np.flatnonzero(bit == 0)
    valid = np.bitwise_or.reduceat(np.uint64(1) << bit, edges)
    free = [b for b in range(64) if not mask >> b & 1]
    planes = [np.bitwise_or.reduceat(((fps >> np.uint64(b)) & np.uint64(1)) << bit, edges) for b in free]
    ones = ~np.uint64(0)
    asks = np.repeat(first_word + n_words, sizes) - word  # words from its own on
    last = np.cumsum(asks)
    at = 0
    while at < len(fps):
        to = max(at + 1, int(np.searchsorted(last, (last[at - 1] if at else 0) + CHUNK, side="right")))
        q, w = np.repeat(np.arange(at, to), asks[at:to]), ranges(word[at:to], asks[at:to])
        alive = valid[w]
        # counters start so that they overflow at radius + 1
        width = (radius + 1).bit_length()
        begin = (1 << width) - 1 - radius
        counter = [np.full(len(q), ones if begin >> k & 1 else np.uint64(0)) for k in range(width)]
        for k, b in enumerate(free):
            carry = planes[k][w] ^ np.where((fps[q] >> np.uint64(b)) & np.uint64(1), ones, np.uint64(0))
            for c in range(width):
                counter[c], carry = counter[c] ^ carry, counter[c] & carry
            alive &= ~carry
            if k % EVERY == EVERY - 1:
                stay = np.flatnonzero(alive)
                if len(stay) < len(q):
                    q, w, alive = q[stay], w[stay], alive[stay]
                    counter = [c[stay] for c in counter]
        row, found = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        i, j = q[row], start[w[row]] + found
        apart = i < j
        yield i[apart], j[apart]
        at = to


def roots_of(n: int, i: np.ndarray, j: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest place that each of n places is connected to; label: from what is connected already."""
    label = np.arange(n) if label is None else label
    while len(i):
        a, b = label[i], label[j]
        differs = a != b
        if not differs.any():
            break
        i, j, a, b = i[differs], j[differs], a[differs], b[differs]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label


def _stars(buckets: DataFrame, radius: int) -> DataFrame:
    """a, b: documents that are connected by links of a bucket, each to the first of those it is connected to."""
    tasks = 1 + buckets.count() // TASK_ROWS

    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        masks, values = (t[c].to_numpy() for c in ("mask", "value"))
        fps, ids = t["fp"].to_numpy().view(np.uint64), t["doc_id"].to_numpy()
        new = np.concatenate([[True], (masks[1:] != masks[:-1]) | (values[1:] != values[:-1])])
        bucket = np.cumsum(new)
        label = np.arange(len(fps))
        cuts = np.append(np.flatnonzero(np.concatenate([[True], masks[1:] != masks[:-1]])), len(masks))
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            for i, j in near_pairs(fps[a:z], bucket[a:z], int(masks[a]) % (1 << 64), radius):
                label = roots_of(len(fps), i + a, j + a, label)
        linked = np.flatnonzero(label != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[label[linked]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            if sum(x.num_rows for x in held) < 4 * BUCKET:
                continue
            # whole buckets only: what belongs to the last one waits
            m, v = b.column("mask").to_numpy(), b.column("value").to_numpy()
            cut = np.flatnonzero((m != m[-1]) | (v != v[-1]))
            if len(cut):
                at = int(cut[-1]) + 1
                yield solve([*held[:-1], b.slice(0, at)])
                held = [b.slice(at)]
        if held:
            yield solve(held)

    return buckets.repartition(tasks, "mask", "value").sortWithinPartitions("mask", "value").select("mask", "value", "fp", "doc_id").mapInArrow(run, "a long, b long")


def near_components(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id: the smallest doc_id reachable, itself included.

    Documents link if their fingerprints differ in at most ``radius`` bits. Null, empty and wordless texts have the
    fingerprint zero and link like any other; a text of fewer words than a shingle is one shingle. Rows without an id
    are left out; an id that repeats counts once, with its smallest text; texts are whole; other columns are ignored; an
    empty table gives an empty result.
    """
    read = materialize(read_fingerprints(one_row_per_id(docs), shingle), "fingerprints")
    firsts = materialize(read.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "first-of-fingerprints")
    stars = materialize(_stars(_buckets(firsts, radius, bucket), radius), "stars")
    roots = connected_components(stars)
    discard(stars)
    whole = firsts.join(roots, F.col("doc_id") == F.col("node"), "left").select("fp", F.coalesce("root", "doc_id").alias("component_id"))
    return read.join(whole, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op13_simhash(spark, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
