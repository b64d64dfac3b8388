"""Prefix trie of conversations, built as burst tries in shards.

1. A turn becomes an id, the first 128 bits of the SHA-256 of its role and text; from here on texts don't move. The
   turns of a conversation are put in order and rebuilt (see :func:`rebuilt`). Conversations of the same ids are
   counted as one sequence from here on, so that copies cost nothing.
2. A container holds the suffixes of all sequences under a trie head; at first one container hangs under the root.
   Those of more than ``container`` suffixes are burst: the turns that all of them share become a chain of nodes, and
   the others are dealt to new heads by their next turn id. Only rows of oversized containers move, and each round
   splits each of them, however long the shared part is.
3. The containers left are sharded by head. A task sorts the suffixes of one container at a time and sweeps them once:
   each id beyond the part shared with the suffix before is a new node, and the sums of subtrees go from the last node
   back to the head.
4. Sums of heads go up to the chains of burst containers, the last round first.

The ids that a node's digest is made of are sorted in pieces over all tasks where they are many; only the pieces of
text meet in the task that hashes them, one after another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Suffixes in a container that isn't burst.
CONTAINER = 200
#: Conversations that end at one node, from which on their ids are sorted and joined in pieces.
MANY = 10_000
#: Bytes of an id.
ID = 16
#: Turn ids (of all suffixes) that a shard is meant to hold.
SHARD_IDS = 1_000_000

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id and turns: an array of (turn, id, chars) in order; rows without a conv_id are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(F.col("turn").alias("turn"), F.substring(digest, 1, 2 * ID).alias("id"), F.char_length(text).cast("long").alias("chars"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, path (its turn ids, one after another) and chars (code points of each turn).

    A conversation c begins with the first h original turns of conversation c - c % 100 (all if there are fewer, none
    without it), h = crc32 of the decimal c, modulo 6; its own turns after its first h follow.
    """
    own = materialize(turns_of(conversations), "turns")
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    first = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("first"))
    rows = own.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), h.alias("h")).join(first, "base", "left")
    none = F.slice("turns", 1, 0)
    turns = F.concat(F.coalesce(F.slice("first", F.lit(1), F.col("h")), none), F.slice("turns", F.col("h") + 1, F.size("turns")))
    rows = rows.select("conv_id", turns.alias("t"))
    return rows.select("conv_id", F.unhex(F.array_join(F.col("t.id"), "")).alias("path"), F.col("t.chars").alias("chars"))


def _key(value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(value, 256), 1, 2 * ID))


def _digests_of_many(rows: DataFrame) -> DataFrame:
    """ends_sha256 of each key: SHA-256 of its conv_ids in order, joined by commas; however many a key has.

    rows: key, conv_id. All rows are sorted over all tasks; of each key, a task passes on pieces of text.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids = b.column("key").to_pylist(), b.column("conv_id").to_pylist()
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            spans = [(a, z) for a, z in zip(cuts[:-1], cuts[1:], strict=True) if z > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[a] for a, _ in spans], pa.binary()), pa.array([ids[a] for a, _ in spans], pa.int64()), pa.array([",".join(map(str, ids[a:z])) for a, z in spans], pa.string())],
                names=["key", "first", "piece"],
            )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        done: list[tuple[bytes, str]] = []
        for b in batches:
            for k, piece in zip(b.column("key").to_pylist(), b.column("piece").to_pylist(), strict=True):
                if k != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
        if state is not None:
            done.append((key, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], names=["key", "ends"])

    cut = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key binary, first long, piece string")
    return cut.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "key binary, ends string")


def sequences(conversations: DataFrame, many: int = MANY) -> DataFrame:
    """The distinct rebuilt conversations: rest (their turn ids), chars, n, conv_id (the smallest) and ends."""
    whole = materialize(rebuilt(conversations).withColumn("key", _key(F.col("path"))), "rebuilt")
    rows = whole.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.any_value("path").alias("rest"), F.any_value("chars").alias("chars"))
    rows = materialize(rows, "sequences")
    large = rows.where(F.col("n") > many).select("key")
    few = whole.join(large, "key", "left_anti").groupBy("key").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("conv_id")), ","), 256).alias("ends"))
    ends = few if large.isEmpty() else few.unionByName(_digests_of_many(whole.join(large, "key", "left_semi").select("key", "conv_id")))
    return rows.join(ends, "key").drop("key")


def _common(rows: DataFrame) -> DataFrame:
    """Adds to each row the number of whole ids that ``low`` and ``high`` begin with in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shared = []
            for x, y in zip(b.column("low").to_pylist(), b.column("high").to_pylist(), strict=True):
                at, end = 0, min(len(x), len(y))
                while at < end and x[at : at + ID] == y[at : at + ID]:
                    at += ID
                shared.append(at // ID)
            yield pa.RecordBatch.from_arrays([b.column("head"), pa.array(shared, pa.int32())], names=["head", "common"])

    return rows.select("head", "low", "high").mapInArrow(run, "head binary, common int")


def _burst(rows: DataFrame, container: int, turn: int) -> tuple[DataFrame, DataFrame] | None:
    """The chains of containers of more than ``container`` suffixes, and the rows of these under their new heads.

    A chain: head, depth, head_chars, parent_head, parent_conv, common (ids that all suffixes begin with), low (the
    smallest suffix), low_chars, n, conv_id, and ends of the sequence that ends with the chain, if one does.
    """
    about = [F.any_value(c).alias(c) for c in ("depth", "head_chars", "parent_head", "parent_conv")]
    of = F.struct("rest", "chars", "ends")
    sizes = rows.groupBy("head").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.min(of).alias("first"), F.max("rest").alias("high"), *about)
    sizes = materialize(sizes.where(F.col("rows") > container).withColumns({"low": F.col("first.rest"), "low_chars": F.col("first.chars"), "low_ends": F.col("first.ends")}).drop("first"), f"oversized-{turn}")
    if sizes.isEmpty():
        return None
    ended = F.octet_length("low") == F.col("common") * ID
    chains = materialize(sizes.join(_common(sizes), "head").withColumn("ends", F.when(ended, F.col("low_ends"))).drop("low_ends", "high", "rows"), f"chains-{turn}")
    at = F.col("common") * ID
    cut = chains.select("head", "common", F.col("conv_id").alias("first_conv"))
    moved = rows.join(cut, "head").where(F.octet_length("rest") > at)
    upto = F.expr(f"substring(rest, 1, (common + 1) * {ID})")
    moved = moved.select(
        _key(F.concat("head", upto)).alias("head"),
        (F.col("depth") + F.col("common") + 1).alias("depth"), F.get("chars", F.col("common")).alias("head_chars"), F.col("head").alias("parent_head"), F.col("first_conv").alias("parent_conv"),
        F.expr(f"substring(rest, (common + 1) * {ID} + 1)").alias("rest"), F.slice("chars", F.col("common") + 2, F.size("chars")).alias("chars"), "n", "conv_id", "ends",
    )
    return chains, materialize(moved, f"burst-{turn}")


def sweep(rest: list[bytes], chars: list[list[int]], n: list[int], conv: list[int], ends: list[str], head_chars: int) -> tuple[list, ...]:
    """The nodes of one container, its head first: depth below the head, parent, conv, n, children, leaves, saved, ends."""
    depth, parent, size = [0], [-1], [head_chars]
    count, least, kids, leaves, saved, last = [0], [None], [0], [0], [0], [EMPTY_SHA]
    open_nodes, before = [0], b""
    for i in sorted(range(len(rest)), key=rest.__getitem__):
        path = rest[i]
        shared, most = 0, min(len(path), len(before))
        while shared < most and path[shared : shared + ID] == before[shared : shared + ID]:
            shared += ID
        shared //= ID
        del open_nodes[shared + 1 :]
        for d in range(shared, len(path) // ID):
            parent.append(open_nodes[-1])
            open_nodes.append(len(depth))
            depth.append(d + 1)
            size.append(chars[i][d])
            count.append(0), least.append(None), kids.append(0), leaves.append(0), saved.append(0), last.append(EMPTY_SHA)
        node = open_nodes[-1]
        count[node], least[node], last[node] = n[i], conv[i], ends[i]
        before = path
    for v in range(len(depth) - 1, -1, -1):
        leaves[v] = leaves[v] or 1
        saved[v] += (count[v] - 1) * size[v]
        p = parent[v]
        if p >= 0:
            count[p] += count[v]
            least[p] = least[v] if least[p] is None else min(least[p], least[v])
            kids[p] += 1
            leaves[p] += leaves[v]
            saved[p] += saved[v]
    return depth, parent, least, count, kids, leaves, saved, last


def _swept(containers: DataFrame, shards: int) -> DataFrame:
    """All nodes of the containers, and with each container's head the head it hangs under (top)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[list] = [[] for _ in range(9)]

        def close() -> None:
            first = held[0]
            depth, parent, least, count, kids, leaves, saved, last = sweep(*([r[c] for r in held] for c in ("rest", "chars", "n", "conv_id", "ends")), first["head_chars"])
            above = [first["parent_conv"], *(least[p] for p in parent[1:])]
            for to, values in zip(out, (least, [first["depth"] + d for d in depth], above, count, kids, leaves, saved, last, [first["parent_head"]] + [None] * (len(depth) - 1)), strict=True):
                to.extend(values)
            held.clear()

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [pa.int64()] * 7 + [pa.string(), pa.binary()], strict=True)], names=[*(c.split()[0] for c in NODE.split(", ")), "top"])
            for c in out:
                c.clear()
            return made

        for b in batches:
            for r in b.to_pylist():
                if held and r["head"] != held[0]["head"]:
                    close()
                    if len(out[0]) > 20_000:
                        yield batch()
                held.append(r)
        if held:
            close()
        yield batch()

    rows = containers.repartition(shards, "head").sortWithinPartitions("head")
    return rows.mapInArrow(run, f"{NODE}, top binary")


def _chain_nodes(chains: DataFrame, below: DataFrame) -> DataFrame:
    """The nodes of chains: below has the sums of what hangs under each head (top, n_children, n_leaves, saved_tokens)."""
    joined = chains.join(below, F.col("head") == F.col("top")).drop("top")
    sizes = F.concat(F.array(F.col("head_chars")), F.slice("low_chars", F.lit(1), F.col("common")))
    rows = joined.withColumn("sizes", sizes).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("common"))))
    under = F.aggregate(F.slice("sizes", F.col("i") + 1, F.col("common") + 1), F.lit(0).cast("long"), lambda s, x: s + x)
    end = F.col("i") == F.col("common")
    return rows.select(
        "conv_id", (F.col("depth") + F.col("i")).cast("long").alias("depth"), F.when(F.col("i") == 0, F.col("parent_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(end, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves", (F.col("saved_tokens") + (F.col("n") - 1) * under).alias("saved_tokens"),
        F.when(end, F.coalesce("ends", F.lit(EMPTY_SHA))).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"), F.when(F.col("i") == 0, F.col("parent_head")).alias("top"),
    )


def prefix_trie(conversations: DataFrame, container: int = CONTAINER, many: int = MANY) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id (the parent's conv_id; root: null), n_convs (members), n_children,
    n_leaves (childless nodes of the subtree), saved_tokens (summed over the subtree: members but one, times the code
    points of the node's text) and ends_sha256 (of the conv_ids of conversations that end here). Turns come in the order
    of their number (null first); those of one number in the order of their ids, equal ones one after another. A null
    role or text is empty, and texts are whole; conversations without turns belong to the root alone; rows without a
    conv_id are left out; other columns are ignored. A table without conversations has no nodes.
    """
    rows = sequences(conversations, many)
    none = {"head": F.lit(b""), "depth": F.lit(0), "head_chars": F.lit(0).cast("long"), "parent_head": F.lit(None).cast("binary"), "parent_conv": F.lit(None).cast("long")}
    rows = materialize(rows.withColumns(none), "containers")
    containers, rounds = [], []
    while (made := _burst(rows, container, len(rounds))) is not None:
        rounds.append(made[0])
        containers.append(rows.join(made[0].select("head"), "head", "left_anti"))
        rows = made[1]
    left = reduce(DataFrame.unionByName, [*containers, rows])
    ids = left.agg(F.sum(F.octet_length("rest") / ID + 1)).first()[0] or 0
    nodes = _swept(left, 1 + int(ids) // SHARD_IDS)
    if not rounds:
        return nodes.drop("top")
    nodes = materialize(nodes, "nodes")
    tally = lambda df: df.where("top IS NOT NULL").groupBy("top").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    below = materialize(tally(nodes), "heads")
    parts = [nodes]
    more = None
    for k, chains in reversed(list(enumerate(rounds))):
        sums = below if more is None else below.unionByName(tally(more)).groupBy("top").agg(*(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")))
        more = materialize(_chain_nodes(chains, sums), f"chain-nodes-{k}")
        parts.append(more)
    return reduce(DataFrame.unionByName, parts).drop("top")


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
