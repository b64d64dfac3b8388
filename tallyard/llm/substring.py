"""Substring deduplication with a log-structured index of fingerprints.

A batch of documents is deduplicated against all that the index has taken in before, and within itself, for windows
of ``window`` words (20):

1. Every document of the batch is read once. Equal texts are reduced to the first of them. In each window one run of
   ``gram`` words (8) is selected, that of the smallest hash: equal windows select equal runs, so a repeated window
   always repeats a selected fingerprint, and there is only one fingerprint for some seven words.
2. The fingerprints of the batch are merge-joined with the sorted, immutable runs of the index (bucketed by
   fingerprint, so the runs aren't shuffled). Those found there, or twice in the batch, are repeated.
3. Only windows of repeated fingerprints are verified, by a 128-bit cryptographic digest of their words: with each
   other, with the digests of windows that earlier batches repeated (runs too), and with the windows of the one
   earlier document that held a fingerprint alone until now, whose text the index keeps. History isn't read again
   otherwise, and the result is exact, not a sketch.
4. Documents with repeated windows lose the words these cover. The batch's fingerprints and digests become new runs;
   when there are too many, they are compacted into one.

A table without history is cut into batches by id that pass through an index of their own. Copies and hot passages
never meet as pairs: all steps group by fingerprint or digest, and keep one row per occurrence.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, discard, gram_hashes, materialize, mix, numbered_rows, one_row_per_id, ranges, remove_path, scratch_path, single_spaced, text_slices

WINDOW, GRAM = 20, 8
#: What a bucket of a run is meant to hold: rows (of texts, words). More make more buckets than there are shuffle partitions.
BUCKET = {"fps": 4_000_000, "windows": 4_000_000, "texts": 50_000_000}


class FingerprintIndex:
    """Log-structured index of windows seen, kept in a folder that all executors share; opened anew, it goes on.

    Sorted immutable runs, bucketed by their first column and compacted when there are more than max_runs (of texts,
    max_texts) of a kind:
    fps (fp, doc_id: the only holder so far, null once the fingerprint repeats), windows (digest of each distinct window
    of repeated fingerprints) and texts (of each document taken in, but copies). The newest ``state-*`` table lists
    the runs that count, so that a batch that fails leaves the index as it was.
    """

    KINDS = {"fps": "fp long, doc_id long", "windows": "digest binary", "texts": "doc_id long, text string"}

    def __init__(self, spark: SparkSession, path: str, max_runs: int = 4, max_texts: int = 16):
        self.spark, self.path = spark, path.rstrip("/")
        self.most = {"fps": max_runs, "windows": max_runs, "texts": max_texts}
        self.tag = f"index_{uuid.uuid4().hex[:12]}"
        self.runs: dict[str, list[str]] = {k: [] for k in self.KINDS}
        self.buckets: dict[str, int] = {}
        self.sizes: dict[str, int] = {}
        where = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        done = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/state-*/_SUCCESS"))
        self.state = max((int(f.getPath().getParent().getName()[6:]) for f in done or []), default=0)
        if self.state:
            for kind, run, n, size in spark.read.parquet(f"{self.path}/state-{self.state}").orderBy("place").select("kind", "run", "buckets", "size").collect():
                first = self.KINDS[kind].split()[0]
                spark.sql(f"CREATE TABLE {self.tag}_{run} ({self.KINDS[kind].replace('long', 'bigint')}) USING parquet CLUSTERED BY ({first}) SORTED BY ({first}) INTO {n} BUCKETS LOCATION '{self.path}/{run}'")
                self.runs[kind].append(run)
                self.buckets[run], self.sizes[run] = n, size

    def tables(self, kind: str) -> list[DataFrame]:
        return [self.spark.table(f"{self.tag}_{run}") for run in self.runs[kind]]

    def write(self, kind: str, rows: DataFrame, size: int) -> str:
        """Writes a run of at most so many rows (of texts, words); it counts once :meth:`commit` has named it."""
        run, first = f"{kind}_{uuid.uuid4().hex[:12]}", self.KINDS[kind].split()[0]
        n = self.buckets[run] = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET[kind]))
        self.sizes[run] = size
        rows.repartition(n, first).write.bucketBy(n, first).sortBy(first).option("path", f"{self.path}/{run}").format("parquet").saveAsTable(f"{self.tag}_{run}")
        return run

    def commit(self, new: dict[str, str]) -> None:
        """Takes in the new runs, compacts kinds that have too many, and only then removes what isn't needed."""
        old = []
        for kind, run in new.items():
            self.runs[kind].append(run)
            if len(self.runs[kind]) > self.most[kind]:
                every = reduce(DataFrame.unionByName, self.tables(kind))
                if kind == "fps":  # once repeated, always repeated
                    every = every.groupBy("fp").agg(F.when(F.count("doc_id") == F.count(F.lit(1)), F.min("doc_id")).alias("doc_id"))
                elif kind == "windows":
                    every = every.distinct()
                merged = self.write(kind, every, sum(self.sizes[r] for r in self.runs[kind]))
                old += self.runs[kind]
                self.runs[kind] = [merged]
        rows = [(k, r, self.buckets[r], self.sizes[r]) for k, runs in self.runs.items() for r in runs]
        self.state += 1
        named = self.spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "place int, kind string, run string, buckets int, size long")
        named.coalesce(1).write.parquet(f"{self.path}/state-{self.state}")
        remove_path(self.spark, f"{self.path}/state-{self.state - 1}")
        for run in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tag}_{run}")
            remove_path(self.spark, f"{self.path}/{run}")

    def close(self) -> None:
        """Takes the runs out of the session's catalog; their files stay."""
        for run in self.buckets:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tag}_{run}")


def _selected(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window within one document: its first word, and the fingerprint of the run of words it selects.

    Returns starts, the place of the selected run of each, and the fingerprints of all runs by place.
    """
    h = words.hashes()
    fps = gram_hashes(h, gram)
    starts = ranges(words.first[:-1], np.maximum(words.counts - window + 1, 0))
    if not len(starts):
        return starts, starts, fps
    span = window - gram + 1
    # smallest of `span` neighbours, of equal ones the first: by doubling
    best, reach = np.arange(len(fps)), 1
    while reach < span:
        step = min(reach, span - reach)
        other = np.append(best[step:], np.repeat(best[-1], step))
        best = np.where(fps[other] < fps[best], other, best)
        reach += step
    return starts, best[starts], fps


def read_fingerprints(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, kept_sha256 of all its words, text_key, fps (distinct selected
    fingerprints) and twice (of each, whether it is selected at more than one place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            words = Words(b.column("text"))
            starts, places, fps = _selected(words, window, gram)
            doc = np.repeat(np.arange(b.num_rows), np.maximum(words.counts - window + 1, 0))
            # distinct places, then distinct fingerprints of each document
            new = np.concatenate([[True], places[1:] != places[:-1]]) if len(places) else np.zeros(0, bool)
            new[1:] |= doc[1:] != doc[:-1]
            fp, doc = fps[places[new]], doc[new]
            order = np.lexsort((fp, doc))
            fp, doc = fp[order], doc[order]
            head = np.concatenate([[True], (fp[1:] != fp[:-1]) | (doc[1:] != doc[:-1])]) if len(fp) else np.zeros(0, bool)
            again = np.zeros(len(fp), bool)
            again[:-1] = ~head[1:]
            first = np.flatnonzero(head)
            twice = again[first]
            fp, doc = fp[first], doc[first]
            ends = lambda x: pa.array(np.concatenate([[0], np.cumsum(np.bincount(x, minlength=b.num_rows))]), pa.int32())
            sha, key = [], []
            raw = words.raw.tobytes()
            spans = words.starts.tolist(), words.ends.tolist()
            for i in range(b.num_rows):
                a, z = int(words.first[i]), int(words.first[i + 1])
                digest = hashlib.sha256(b" ".join(raw[spans[0][a] : spans[1][z - 1]].split()) if z > a else b"")
                sha.append(digest.hexdigest())
                key.append(digest.digest()[:16])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id").cast(pa.int64()), pa.array(words.counts, pa.int64()), pa.array(sha, pa.string()), pa.array(key, pa.binary()),
                    pa.ListArray.from_arrays(ends(doc), pa.array(fp.view(np.int64), pa.int64())),
                    pa.ListArray.from_arrays(ends(doc), pa.array(twice)),
                ],
                names=["doc_id", "n_words", "kept_sha256", "text_key", "fps", "twice"],
            )

    schema = "doc_id long, n_words long, kept_sha256 string, text_key binary, fps array<long>, twice array<boolean>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _windows(hit_docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Windows whose selected fingerprint is in the document's ``hits``: digest (of the words), doc_id, start, later.

    later: an equal window stands earlier within the same slice of rows, so that this one repeats for certain. Its
    digest is then arbitrary: of a hot passage, only one window a slice has to meet the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            words = Words(b.column("text"))
            starts, places, fps = _selected(words, window, gram)
            doc = np.repeat(np.arange(b.num_rows), np.maximum(words.counts - window + 1, 0))
            hits = b.column("hits")
            owner = np.repeat(np.arange(b.num_rows), hits.value_lengths().to_numpy(zero_copy_only=False))
            salt = lambda d: mix(d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            wanted = hits.flatten().to_numpy().view(np.uint64) ^ salt(owner)
            chosen = np.flatnonzero(np.isin(fps[places] ^ salt(doc), wanted))
            at, doc = starts[chosen], doc[chosen]
            ids = b.column("doc_id").cast(pa.int64()).to_numpy()
            raw, begin, end = single_spaced(words)
            raw, digest = raw.tobytes(), hashlib.blake2b
            spans = zip(begin[at].tolist(), end[at + window - 1].tolist(), strict=True)
            d = np.frombuffer(b"".join([digest(raw[a:z], digest_size=16).digest() for a, z in spans]), np.uint64).reshape(-1, 2).copy()
            order = np.lexsort((at, ids[doc], d[:, 1], d[:, 0]))
            later = np.zeros(len(at), bool)
            later[order[1:]] = (d[order[1:]] == d[order[:-1]]).all(axis=1)
            d[later, 0] = mix(d[later, 0] + np.arange(1, int(later.sum()) + 1).astype(np.uint64) ^ ids[doc[later]].astype(np.uint64))
            digests = pa.Array.from_buffers(pa.binary(), len(d), [None, pa.py_buffer(np.arange(0, 16 * len(d) + 1, 16, dtype=np.int32)), pa.py_buffer(d.tobytes())])
            yield pa.RecordBatch.from_arrays([digests, pa.array(ids[doc], pa.int64()), pa.array(at - words.first[doc], pa.int32()), pa.array(later)], names=["digest", "doc_id", "start", "later"])

    return hit_docs.select("doc_id", "text", "hits").mapInArrow(run, "digest binary, doc_id long, start int, later boolean")


def _cut(marked: DataFrame, window: int) -> DataFrame:
    """Takes the words covered by the windows ``starts`` out of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, kept, sha = [], [], []
            for text, starts in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("starts"), strict=True):
                words = (text or b"").split()
                cover = np.zeros(len(words) + 1, np.int64)
                at = starts.values.to_numpy()
                np.add.at(cover, at, 1)
                np.add.at(cover, at + window, -1)
                keep = np.cumsum(cover)[:-1] == 0
                rest = b" ".join([words[k] for k in np.flatnonzero(keep)])
                removed.append(int((~keep).sum()))
                kept.append(rest.decode("utf-8"))
                sha.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], names=["doc_id", "n_removed", "kept_sha256", "kept"])

    return marked.select("doc_id", "text", "starts").mapInArrow(run, "doc_id long, n_removed long, kept_sha256 string, kept string")


def repeated_windows(index: FingerprintIndex, docs: DataFrame, window: int = WINDOW, gram: int = GRAM, keep: bool = True) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Finds all windows of a batch that repeat one of the index or an earlier one of the batch.

    Returns the documents (doc_id, n_words, kept_sha256, rep: first document of the batch with the same words) and, for
    first documents with repeated windows, their texts and starts (doc_id, text, starts); keep: also the runs to commit.
    """
    read = materialize(read_fingerprints(docs, window, gram), "fingerprints")
    # documents of the same words: the first stands for all
    same = materialize(read.groupBy("text_key").agg(F.min("doc_id").alias("rep")), "first-of-words")
    known = materialize(
        read.select("doc_id", "n_words", "kept_sha256", "text_key").join(same, "text_key").select("doc_id", "n_words", "kept_sha256", "rep"), "documents-of-words"
    )
    firsts = known.where((F.col("doc_id") == F.col("rep")) & (F.col("n_words") >= window)).select("doc_id")
    fps = read.select("doc_id", F.arrays_zip("fps", "twice").alias("fps")).join(firsts, "doc_id", "left_semi")
    flat = materialize(fps.select("doc_id", F.explode("fps").alias("x")).select("doc_id", F.col("x.fps").alias("fp"), F.col("x.twice").alias("twice")), "fingerprint-rows")
    old_texts = index.tables("texts")
    n_words = known.where((F.col("doc_id") == F.col("rep")) & (F.col("n_words") >= window)).agg(F.sum("n_words")).first()[0] or 0
    new = {"texts": index.write("texts", docs.join(firsts, "doc_id", "left_semi"), n_words)}
    texts = index.spark.table(f"{index.tag}_{new['texts']}")

    # merge-join with the runs: of each fingerprint, whether it is there, and its only holder
    found = flat.groupBy("fp").agg(((F.count(F.lit(1)) > 1) | F.bool_or("twice")).alias("twice"), F.min("doc_id").alias("doc_id"))
    runs = index.tables("fps")
    for k, run in enumerate(runs):
        found = found.join(run.select("fp", F.col("doc_id").alias(f"holder_{k}"), F.lit(True).alias(f"in_{k}")).hint("merge"), "fp", "left")
    here = [F.coalesce(F.col(f"in_{k}"), F.lit(False)) for k in range(len(runs))]
    old = reduce(lambda a, b: a | b, here, F.lit(False))
    spread = reduce(lambda a, b: a | b, [x & F.col(f"holder_{k}").isNull() for k, x in enumerate(here)], F.lit(False))
    holder = F.coalesce(*(F.col(f"holder_{k}") for k in range(len(runs))), F.lit(None).cast("long"))
    found = materialize(found.select("fp", "twice", "doc_id", old.alias("old"), spread.alias("spread"), holder.alias("holder")), "fingerprints-found")

    hits = materialize(found.where("twice OR old").select("fp"), "fingerprints-repeated")
    wanted = flat.join(hits, "fp").groupBy("doc_id").agg(F.collect_list("fp").alias("hits"))
    windows = _windows(texts.join(wanted, "doc_id"), window, gram).withColumn("side", F.lit(1))
    if old_texts:
        asked = materialize(found.where("old AND NOT spread").groupBy(F.col("holder").alias("doc_id")).agg(F.collect_list("fp").alias("hits")), "holders")
        parts = [_windows(t.join(asked, "doc_id"), window, gram).where("NOT later").withColumn("side", F.lit(0)) for t in old_texts]
        windows = reduce(DataFrame.unionByName, parts, windows)
    for k, run in enumerate(index.tables("windows")):
        windows = windows.join(run.withColumn(f"in_{k}", F.lit(True)).hint("merge"), "digest", "left")
    seen = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"in_{k}"), F.lit(False)) for k in range(len(index.runs["windows"]))], F.lit(False))
    place = F.row_number().over(Window.partitionBy("digest").orderBy("side", "doc_id", "start"))
    judged = windows.withColumn("again", seen | F.col("later") | (place > 1))
    if keep:
        judged = materialize(judged.select("side", "doc_id", "start", "again", F.when(~F.col("again"), F.col("digest")).alias("digest")), "windows-judged")
    later = materialize(judged.where("side = 1 AND again").groupBy("doc_id").agg(F.collect_list("start").alias("starts")), "windows-repeated")
    if keep:
        fresh = found.where("NOT spread").select("fp", F.when(~(F.col("twice") | F.col("old")), F.col("doc_id")).alias("doc_id"))
        new["fps"] = index.write("fps", fresh, found.count())
        digests = judged.where("digest IS NOT NULL").select("digest")
        new["windows"] = index.write("windows", digests, digests.count())
        discard(judged)
    discard(read, same, flat, found, hits)
    return known, texts.join(later, "doc_id"), new


def _result(known: DataFrame, marked: DataFrame, window: int, with_text: bool) -> DataFrame:
    cut = _cut(marked, window)
    if not with_text:
        cut = cut.drop("kept")
    out = known.join(cut.withColumnRenamed("kept_sha256", "sha_after"), "doc_id", "left")
    copy = (F.col("doc_id") != F.col("rep")) & (F.col("n_words") >= window)
    return out.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("sha_after", "kept_sha256")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept")] if with_text else []),
    )


def dedup_batch(index: FingerprintIndex, docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """Removes every word covered by a window that a document of the index holds, or that starts earlier in the batch.

    Result and awkward rows as in :func:`dedup_substrings`; documents of the index come before the batch, whatever
    their ids. Afterwards the index has taken the batch in; it must always be used with the same window and gram.
    """
    known, marked, new = repeated_windows(index, one_row_per_id(docs), window, gram)
    out = materialize(_result(known, marked, window, with_text), "deduplicated")
    index.commit(new)
    return out


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, batches: int = 3, with_text: bool = False) -> DataFrame:
    """Removes every word covered by a window of ``window`` words that also starts earlier.

    Earlier: in a document of smaller doc_id, or before in the same one; windows are judged on the input. Returns
    doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept: the kept words joined by one space, or null where
    nothing was removed and the text stays as it is. A null or empty text has no words. Rows without an id are left
    out; an id that repeats counts once, with its smallest text. Other columns of ``docs`` are ignored; an empty
    table gives an empty result.
    """
    docs = one_row_per_id(docs)
    cuts = docs.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    edges = [None, *sorted({int(c) for c in cuts}), None]
    index = FingerprintIndex(docs.sparkSession, scratch_path(docs.sparkSession, "index"), 1, batches)
    parts = []
    try:
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            part = docs
            if low is not None:
                part = part.where(F.col("doc_id") >= low)
            if high is not None:
                part = part.where(F.col("doc_id") < high)
            *frames, new = repeated_windows(index, part, window, gram, keep=high is not None)
            parts.append(frames)
            if high is not None:
                index.commit(new)
    finally:
        index.close()
    known, marked = (reduce(DataFrame.unionByName, frames) for frames in zip(*parts, strict=True))
    return _result(known, marked, window, with_text)


def drop_repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` without the words of repeated windows, n_chars set anew; rows that lose all words go.

    Earlier rows are those of smaller doc_id (null last), then text; so rows without an id, or with one that repeats,
    are documents of their own. A text without removed words stays as it is; an empty table gives an empty result.
    """
    rows, key = numbered_rows(docs)
    cut = dedup_substrings(rows.select(F.col(key).alias("doc_id"), "text"), window, gram, with_text=True).where("n_removed > 0")
    cut = cut.select(F.col("doc_id").alias(key), F.struct("kept", "n_removed", "n_words").alias(f"{key}_cut"))
    kept = F.col(f"{key}_cut.kept")
    joined = rows.join(cut, key, "left").where(f"{key}_cut IS NULL OR {key}_cut.n_removed < {key}_cut.n_words")
    new = {"text": F.coalesce(kept, F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(kept.isNotNull(), F.char_length(kept).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return joined.withColumns(new).select(*docs.columns)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
