"""Exact n-gram Jaccard self-join with T-occurrence search (DivideSkip), as components of linked documents.

1. Every document's set of distinct word n-grams is reduced to its size and a 128-bit key; documents of equal sets
   form a class, which its smallest doc_id stands for from here on.
2. All sets are laid out in one global order: n-grams that very many documents hold come last, the others by hash.
   Two sets that link must share at least l n-grams within their first n - ceil(t n) + l (the l-prefix); these
   are the only ones that are shuffled. Documents with too few shared ones can't link to any other and drop out.
3. Of those left, the whole sets are counted: a document must share ceil(t n) of its n-grams with others. Then the
   rarest come first in the order, and documents that share one of their first n - ceil(t n) + 1 n-grams are in
   one candidate group (components; no link leaves one). Each group's whole texts meet in a task; a group above
   ``block`` documents is cut into blocks, and each pair of blocks meets.
4. In a task, words and n-grams are numbered by their bytes, and T-occurrence search finds the links: a query's short
   inverted lists are merged, the documents that occur in enough of them are looked for in its long lists by binary
   search, and those that reach the required overlap are compared exactly. Documents already known to be connected
   to the largest component are not queried.

Hashes of n-grams (of words' digests under a key of the run) choose candidates, sizes and classes; whether two texts of
a group link is decided by their words. An n-gram that very many documents hold counts as shared without being counted, so its holders are spread over tasks.
Links are kept as stars (document, smallest document it is connected to), so no pairs of a group are listed.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordKeys, WordNumbers, Words, discard, gram_hashes, materialize, mix, numbered_rows, one_row_per_id, ranges, text_slices
from .components import connected_components

#: An n-gram is put last in the order if more than one in HOT documents holds it; at most HOT times the mean size
#: of a set can be such, which bounds what is broadcast.
HOT = 400
#: Extra length of the prefix, in percent of the set.
EXTRA = 10
#: Documents whose whole texts meet in one task.
BLOCK = 3000
#: Parts that the holders of an n-gram of the last kind are spread over, and the number of holders they count as having.
SALTS, MANY = 64, 1 << 40
#: Mean number of n-grams from which on a part holds fewer documents; documents of a large group that meet all its parts.
LONG, PIVOTS = 2000, 16
#: Mean number of n-grams that a search task holds, unless one group's part has more.
TASK_GRAMS = 250_000


def set_of_column(column: pa.Array, gram: int, lower: bool, keys: WordKeys, twice: bool = False) -> tuple[np.ndarray, ...]:
    """Sorted distinct n-gram hashes of each text, one text after another, and their numbers; twice: a second hash of each.

    A text of fewer than ``gram`` words is one n-gram, its whole sequence; one without words has none.
    """
    words = Words(column, lower)
    n = np.maximum(words.counts - gram + 1, 0)
    at = ranges(words.first[:-1], n)
    short = [np.flatnonzero(words.counts == k) for k in range(1, gram)]
    doc = np.concatenate([np.repeat(np.arange(len(n)), n), *short])

    word_keys = keys.of(words)

    def hashed(which: int) -> np.ndarray:
        h = word_keys[which]
        return np.concatenate([gram_hashes(h, gram)[at], *(gram_hashes(h, k)[words.first[s]] for k, s in enumerate(short, 1) if len(s))])

    grams = hashed(0)
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    return grams[new], np.bincount(doc[new], minlength=len(n)), *([hashed(1)[order][new]] if twice else [])


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    """ceil(percent / 100 * n): the overlap with any set that links to one of size n is at least this."""
    return -(-percent * n // 100)


def _read_sets(docs: DataFrame, gram: int, lower: bool, key: bytes) -> DataFrame:
    """doc_id, n, key_a, key_b of each set; often, often_n: n-grams that repeat among the documents of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of = WordKeys(key)
        for b in text_slices(batches):
            grams, n, second = set_of_column(b.column("text"), gram, lower, keys_of, True)
            ends = np.concatenate([[0], np.cumsum(n)])
            total = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h))])[ends] for h in (grams, second)]
            keys = [np.diff(t).view(np.int64) for t in total]
            often, count = np.unique(grams, return_counts=True)
            often, count = often[count > 2].view(np.int64), count[count > 2]
            place = pa.array(np.concatenate([[0], np.full(b.num_rows, len(often))]), pa.int32())  # all on the first row
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(keys[0]), pa.array(keys[1]),
                    pa.ListArray.from_arrays(place, pa.array(often, pa.int64())), pa.ListArray.from_arrays(place, pa.array(count, pa.int64())),
                ],
                names=["doc_id", "n", "key_a", "key_b", "often", "often_n"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, key_a long, key_b long, often array<long>, often_n array<long>")


def _late(grams: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which n-grams are among the sorted ones of ``hot``."""
    return hot[np.minimum(np.searchsorted(hot, grams), len(hot) - 1)] == grams if len(hot) else np.zeros(len(grams), bool)


def _salt(late: np.ndarray, ids: np.ndarray) -> pa.Array:
    """0, or for n-grams of the last kind 1 to SALTS by document."""
    return pa.array(np.where(late, 1 + (mix(ids.astype(np.uint64)) % np.uint64(SALTS)).astype(np.int32), 0).astype(np.int32))


def _prefixes(docs: DataFrame, hot: np.ndarray, gram: int, percent: int, lower: bool, key: bytes) -> DataFrame:
    """The n-grams of each document's prefix: h, salt, doc_id; and need, the fewest that it must share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of = WordKeys(key)
        for b in text_slices(batches):
            grams, n = set_of_column(b.column("text"), gram, lower, keys_of)
            doc = np.repeat(np.arange(len(n)), n)
            late = _late(grams, hot)
            if late.any():
                order = np.lexsort((grams, late, doc))
                grams, late = grams[order], late[order]
            take = np.minimum(n, n - _need(n, percent) + 1 + n * EXTRA // 100)
            starts = np.concatenate([[0], np.cumsum(n)[:-1]])
            at = ranges(starts, take)
            need = 1 + _need(n, percent) * EXTRA // 100
            ids = b.column("doc_id").cast(pa.int64()).to_numpy()
            owner = np.repeat(np.arange(len(n)), take)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[at].view(np.int64)), _salt(late[at], ids[owner]), pa.array(ids[owner]), pa.array(need[owner].astype(np.int32))], names=["h", "salt", "doc_id", "need"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "h long, salt int, doc_id long, need int")


def _grams(docs: DataFrame, hot: np.ndarray, gram: int, lower: bool, key: bytes) -> DataFrame:
    """h, salt, doc_id: the n-grams of whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of = WordKeys(key)
        for b in text_slices(batches):
            grams, n = set_of_column(b.column("text"), gram, lower, keys_of)
            ids = np.repeat(b.column("doc_id").to_numpy(), n)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), _salt(_late(grams, hot), ids), pa.array(ids)], names=["h", "salt", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(run, "h long, salt int, doc_id long")


def exact_sets(texts: pa.Array, gram: int, lower: bool) -> list[np.ndarray]:
    """Sorted distinct numbers of each text's n-grams; two are the same if and only if their words are."""
    book = WordNumbers()
    number, counts = [], []
    for b in text_slices(iter([pa.RecordBatch.from_arrays([texts], names=["text"])])):
        words = Words(b.column("text"), lower)
        number.append(book.of(words.raw, words.starts, words.ends)[0] + 1)  # 0: no word
        counts.append(words.counts)
    if not number:
        return []
    number, counts = np.concatenate([*number, [0]]), np.concatenate(counts)
    ends = np.cumsum(counts)
    m = np.where(counts > 0, np.maximum(counts - gram + 1, 1), 0)
    at, end = ranges(ends - counts, m), np.repeat(ends, m)
    code = number[at]
    for j in range(1, gram):
        code = pd.factorize(code * (len(book) + 1) + np.where(at + j < end, number[np.minimum(at + j, len(number) - 1)], 0))[0]
    heads = np.cumsum(m)[:-1]
    return [np.unique(part) for part in np.split(code, heads)]


class Links:
    """Union-find; the root of a component is its smallest member."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = int(up[i])
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)


def divide_skip(sets: list[np.ndarray], percent: int, asking: np.ndarray | None = None, group: np.ndarray | None = None) -> np.ndarray:
    """For each set (in order), the first set that it is connected to by links of at least ``percent`` Jaccard.

    asking: places of the sets that are queried (by default all); group: sets of equal numbers are connected already.
    """
    m = len(sets)
    links = Links(m)
    if group is not None and m:
        _, head, which = np.unique(group, return_index=True, return_inverse=True)
        links.up = head[which]
    if m < 2:
        return links.up
    sizes = np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(code, kind="stable")
    lists, at = owner[order], np.concatenate([[0], np.cumsum(np.bincount(code))])  # inverted lists, sorted by set
    heads = np.concatenate([[0], np.cumsum(sizes)])
    length = np.diff(at)

    def query(q: int) -> np.ndarray:
        """Sets that link to set q."""
        mine = code[heads[q] : heads[q + 1]]
        mine = mine[np.argsort(length[mine], kind="stable")]
        least = int(_need(sizes[q : q + 1], percent)[0])
        # DivideSkip's number of long lists; at least one short list must then hold every result
        n_long = min(int(least / (0.1 * np.log2(max(2, length[mine[-1]])) + 1)), least - 1)
        short, long = mine[: len(mine) - n_long], mine[len(mine) - n_long :]
        merged = np.sort(lists[ranges(at[short], length[short])], kind="stable")
        first = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
        found, count = merged[first], np.diff(np.append(first, len(merged)))
        fits = (count >= least - n_long) & (found != q) & (100 * sizes[found] >= percent * sizes[q]) & (percent * sizes[found] <= 100 * sizes[q])
        found, count = found[fits], count[fits]
        for k, token in enumerate(long):  # probe the long lists, dropping what can't reach the overlap any more
            if not len(found):
                break
            line = lists[at[token] : at[token + 1]]
            place = np.minimum(np.searchsorted(line, found), len(line) - 1)
            count = count + (line[place] == found)
            alive = count >= least - (n_long - 1 - k)
            found, count = found[alive], count[alive]
        return found[100 * count >= percent * (sizes[q] + sizes[found] - count)]

    if asking is not None:
        for q in asking.tolist():
            if sizes[q]:
                for other in query(q).tolist():
                    links.join(q, other)
        return np.array([links.root(i) for i in range(m)])
    # the sets that share most go first: they gather the largest component, whose members needn't be asked any more
    shared = np.add.reduceat(np.append(length[code], 0), heads[:-1]) / np.maximum(sizes, 1)
    seeds = np.argsort(-shared, kind="stable")[:8].tolist()
    asked = np.zeros(m, bool)
    for q in seeds:
        asked[q] = True
        for other in query(q).tolist():
            links.join(q, other)
    roots = np.array([links.root(i) for i in range(m)])
    main = int(np.bincount(roots).argmax())
    for q in range(m):
        if not asked[q] and sizes[q] and links.root(q) != links.root(main):
            for other in query(q).tolist():
                links.join(q, other)
    return np.array([links.root(i) for i in range(m)])


def _search(blocks: DataFrame, gram: int, percent: int, lower: bool, tasks: int) -> DataFrame:
    """Stars (a: document, b: smallest document it is connected to) of each (root, i, j).

    Rows: root, i, j, doc_id, text, asks (null: every document does) and known (connected ones share it; null: none).
    """

    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        # of a document that stands for both sides, the row that asks
        t = pa.Table.from_batches(parts).combine_chunks().sort_by([("doc_id", "ascending"), ("asks", "descending")])
        ids = t["doc_id"].to_numpy()
        t = t.filter(pa.array(np.concatenate([[True], ids[1:] != ids[:-1]])))
        ids = t["doc_id"].to_numpy()
        asking = np.flatnonzero(t["asks"].to_numpy()) if not t["asks"].null_count else None
        group = t["known"].to_numpy() if not t["known"].null_count else None
        first = divide_skip(exact_sets(t["text"].combine_chunks(), gram, lower), percent, asking, group)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[first])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(c).to_numpy() for c in ("root", "i", "j")], axis=1)
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, z in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows], strict=True):
                now = tuple(keys[a])
                if held and now != key:
                    yield solve(held)
                    held = []
                key = now
                held.append(b.slice(a, z - a).select(["doc_id", "text", "asks", "known"]))
        if held:
            yield solve(held)

    # a number of tasks that follows the work: adaptive execution would merge small partitions that take long
    rows = blocks.repartition(tasks, "root", "i", "j").sortWithinPartitions("root", "i", "j")
    return rows.select("root", "i", "j", "doc_id", "text", "asks", "known").mapInArrow(run, "a long, b long")


def _links(texts: DataFrame, groups: DataFrame, gram: int, percent: int, lower: bool, block: int) -> DataFrame:
    """Stars of the links within candidate groups (node, root, n: size of the node's set).

    A group above ``block`` documents, or as many long ones, is cut into parts, each of which meets a few pivots of
    the group. Documents that the pivots don't connect to the group's largest component then ask all parts of it.
    """
    size = groups.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    parts = F.ceil(F.greatest(F.col("m") / block, F.col("n") / (block * LONG))).cast("int")
    large = materialize(size.withColumn("k", parts).where("k > 1").select("root", "k"), "large-groups")
    part = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    members = groups.join(large, "root", "left").withColumn("k", F.coalesce("k", F.lit(1))).withColumn("i", part)
    tasks = 1 + (groups.agg(F.sum("n")).first()[0] or 0) // TASK_GRAMS
    row = lambda df: df.select(F.col("node").alias("doc_id"), "root", "i", "j", "asks", "known")
    none = {"j": F.lit(0), "asks": F.lit(None).cast("boolean"), "known": F.lit(None).cast("long")}
    first = row(members.withColumns(none))
    if large.isEmpty():
        return _search(texts.join(first, "doc_id"), gram, percent, lower, tasks)

    members = materialize(members, "group-members")
    inside = members.where("k > 1")
    order = F.row_number().over(Window.partitionBy("root").orderBy(F.xxhash64("node", F.lit(1)), "node"))
    pivots = inside.withColumn("place", order).where(F.col("place") <= PIVOTS)
    others = F.filter(F.sequence(F.lit(0), F.col("k") - 1), lambda x: x != F.col("i"))
    spread = pivots.withColumn("i", F.explode(others)).withColumns(none)
    first = row(members.withColumns(none)).unionByName(row(spread))
    stars = materialize(_search(texts.join(first, "doc_id"), gram, percent, lower, tasks), "stars")
    have = connected_components(stars.join(inside.select(F.col("node").alias("a")), "a", "left_semi"))
    inside = materialize(inside.join(have.select("node", F.col("root").alias("known")), "node", "left").withColumn("known", F.coalesce("known", "node")), "members-so-far")
    counts = inside.groupBy("root", "known").agg(F.count(F.lit(1)).alias("c"))
    main = counts.groupBy("root").agg(F.max(F.struct("c", F.col("known").alias("main"))).alias("top")).select("root", "top.main")
    asking = materialize(inside.join(main, "root").where("known <> main").drop("main"), "members-asking")
    turns = asking.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("turns"))
    every_part, every_turn = F.explode(F.sequence(F.lit(0), F.col("k") - 1)), F.explode(F.sequence(F.lit(0), F.col("turns") - 1))
    asks = asking.join(turns, "root").withColumn("j", F.pmod(F.xxhash64("node", F.lit(2)), F.col("turns")).cast("int")).withColumn("i", every_part).withColumn("asks", F.lit(True))
    answers = inside.join(turns, "root").withColumn("j", every_turn).withColumn("asks", F.lit(False))
    second = row(asks).unionByName(row(answers))
    return stars.unionByName(_search(texts.join(second, "doc_id"), gram, percent, lower, tasks))


def linked_components(docs: DataFrame, gram: int = 4, percent: int = 85, lower: bool = True, block: int = BLOCK) -> DataFrame:
    """Components of documents that link: Jaccard similarity of their n-gram sets of at least ``percent`` / 100.

    Returns doc_id, n_shingles and component_id (smallest doc_id reachable, itself included). Null and wordless
    texts have empty sets and link with nothing; documents of equal sets link. Rows without an id are left out; an id
    that repeats counts once, with its smallest text; other columns are ignored; an empty table gives an empty result.
    """
    docs = one_row_per_id(docs)
    key = secrets.token_bytes(32)  # of this run: no text can be made to collide
    read = materialize(_read_sets(docs, gram, lower, key), "set-keys")
    n_docs = read.count()
    hot_rows = (
        read.where(F.size("often") > 0)
        .select(F.explode(F.arrays_zip("often", "often_n")).alias("x"))
        .groupBy(F.col("x.often").alias("h")).agg(F.sum("x.often_n").alias("c"))
        .where(F.col("c") * HOT > n_docs).select("h")
    )
    hot = np.sort(np.array([r[0] for r in hot_rows.collect()], np.int64).view(np.uint64))
    classes = materialize(read.where("n > 0").groupBy("key_a", "key_b", "n").agg(F.min("doc_id").alias("rep")), "first-of-sets")
    known = materialize(read.select("doc_id", "n", "key_a", "key_b").join(classes, ["key_a", "key_b", "n"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "set-classes")
    discard(read, classes)

    by_gram, by_doc = Window.partitionBy("h", "salt"), Window.partitionBy("doc_id")
    holders = F.when(F.col("salt") > 0, F.lit(MANY)).otherwise(F.count(F.lit(1)).over(by_gram))
    rows = _prefixes(docs, hot, gram, percent, lower, key)
    reps = known.where("n > 0 AND doc_id = rep").select("doc_id")
    shared = materialize(
        rows.withColumn("holders", holders).where("holders > 1").select("h", "salt", "doc_id", "need")
        .join(reps, "doc_id", "left_semi"),
        "shared-grams",
    )
    for turn in range(2):  # who shares too little drops out; then its n-grams may be shared no more
        before = shared
        shared = (
            shared.withColumn("holders", holders).where("holders > 1").drop("holders")
            .withColumn("have", F.count(F.lit(1)).over(by_doc)).where("have >= need").drop("have")
        )
        shared = materialize(shared, f"shared-grams-{turn}")
        discard(before)
    survivors = shared.select("doc_id").distinct()
    texts = materialize(docs.join(survivors, "doc_id"), "candidate-texts")
    discard(shared)
    counted = _grams(texts, hot, gram, lower, key).withColumn("holders", holders)
    enough = F.count_if(F.col("holders") > 1).over(by_doc) >= F.ceil(F.lit(percent) * F.col("n") / 100)
    rarest = F.row_number().over(by_doc.orderBy("holders", "h"))
    prefix = (
        counted.withColumn("n", F.count(F.lit(1)).over(by_doc)).withColumn("enough", enough).where("enough")
        .withColumn("place", rarest).where((F.col("place") <= F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1) & (F.col("holders") > 1))
    )
    # the holders of an n-gram hang on their first one; those of one that is spread, on the first of their part
    stars = materialize(prefix.withColumn("b", F.min("doc_id").over(by_gram)).select("h", "salt", F.col("doc_id").alias("a"), "b", "n"), "prefix-stars")
    firsts = stars.where("salt > 0").select("h", F.col("b").alias("a")).distinct().withColumn("b", F.min("a").over(Window.partitionBy("h")))
    groups = connected_components(stars.select("a", "b").unionByName(firsts.select("a", "b")))
    groups = materialize(groups.join(stars.groupBy("a").agg(F.max("n").alias("n")), F.col("node") == F.col("a")).drop("a"), "candidate-groups")
    discard(stars)
    roots = connected_components(_links(texts, groups, gram, percent, lower, block))
    return known.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("component_id")
    )


def keep_first_of_groups(docs: DataFrame, gram: int = 5, percent: int = 80, lower: bool = True) -> DataFrame:
    """All columns of the rows that are the first of their group of linked ones, by doc_id (null last), then text.

    Rows without an id and rows that repeat one are documents of their own; those without words link with nothing.
    """
    rows, key = numbered_rows(docs)
    others = linked_components(rows.select(F.col(key).alias("doc_id"), "text"), gram, percent, lower).where("doc_id <> component_id")
    return rows.join(others.select(F.col("doc_id").alias(key)), key, "left_anti").select(*docs.columns)


def op10_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return linked_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
