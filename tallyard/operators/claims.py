"""Replay of a ledger of claims: what each move found, whether it was refused, and where the claim stands.

A move is a small table from state to state: a refused one leaves every state as it is. Tables can be composed before
the state they meet is known, so a claim's ledger may lie in any number of pieces:

1. all moves are sorted by claim and time over all tasks, so that a claim with very many moves has many pieces;
2. a task goes through its moves once, from every possible state at a time, and notes which state each leads to;
3. the tables of whole pieces are composed for the few claims (one a task at most) that go on from another piece,
   which gives the state that each piece begins with, and with it the state that each move met.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import written

START = "draft"


def _name(c: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))


def _own_faults() -> Column:
    """The rule that a move breaks in any state, or null: UNNAMED_ACTOR, FOUR_EYES, ANONYMOUS_LOCK, SELF_CONFIRMED."""
    locks = F.col("action") == "lock"
    return (
        F.when(_name("actor") == "", "UNNAMED_ACTOR").when(F.col("action").isin("approve", "lock") & (_name("actor") == _name("opened_by")), "FOUR_EYES")
        .when(locks & (_name("confirmed_by") == ""), "ANONYMOUS_LOCK").when(locks & (_name("confirmed_by") == _name("actor")), "SELF_CONFIRMED")
    )


def _walk(moves: DataFrame, n: int) -> DataFrame:
    """Adds piece, and for each of n states at the piece's beginning the state before and behind the move.

    moves: sorted within each task; step: array of n states, or null for a move that changes nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, list(range(n))
        for b in batches:
            before, after = [], []
            for claim, step in zip(b.column("claim_id").to_pylist(), b.column("step").to_pylist(), strict=True):
                if claim != key:
                    key, now = claim, list(range(n))
                before.append(now)
                if step is not None:
                    now = [step[s] for s in now]
                after.append(now)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before, kind), pa.array(after, kind)], names=[*b.schema.names, "before_of", "after_of"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in moves.schema)
    return moves.mapInArrow(run, f"{fields}, before_of array<int>, after_of array<int>")


def replayed(opened: DataFrame, transitions: DataFrame, steps: list[tuple[str, str, str]], pieces: int | None = None) -> DataFrame:
    """All moves of the ledger with ``before`` (the state that each met) and ``rule`` (the first rule it breaks; null: it holds).

    UNKNOWN_CLAIM (none opened), ILLEGAL_STEP (not allowed from that state), then a move's own faults. opened: claim_id,
    opened_by; transitions: claim_id, seq, at, action, to_status, actor, confirmed_by, in the order of (at, seq).
    pieces: into how many the ledger is cut; by default as Spark deals shuffles.
    """
    spark = transitions.sparkSession
    states = sorted({s for a, _, b in steps for s in (a, b)} | {START}, key=lambda s: (s != START, s))
    at = {s: k for k, s in enumerate(states)}
    tables: dict[tuple[str, str], list[int]] = {}
    for a, action, b in steps:
        tables.setdefault((action, b), list(range(len(states))))[at[a]] = at[b]
    fixed = spark.createDataFrame([(*k, t) for k, t in tables.items()], "action string, to_status string, table array<int>")
    claims = opened.select("claim_id", "opened_by", F.lit(True).alias("known"))
    moves = transitions.select("claim_id", "seq", "at", "action", "to_status", "actor", "confirmed_by").join(F.broadcast(fixed), ["action", "to_status"], "left").join(claims, "claim_id", "left")
    moves = moves.withColumn("fault", F.when(F.col("known").isNull(), "UNKNOWN_CLAIM").otherwise(_own_faults()))
    moves = moves.withColumn("step", F.when(F.col("fault").isNull(), F.col("table")))
    order = ["claim_id", "at", "seq"]
    dealt = moves.repartitionByRange(pieces, *order) if pieces else moves.repartitionByRange(*order)
    walked = _walk(dealt.sortWithinPartitions(*order).withColumn("piece", F.spark_partition_id()), len(states))
    walked = written(walked, "replayed-claims")

    # where a claim goes on from another piece: at most once for each piece
    ends = walked.groupBy("claim_id", "piece").agg(F.max_by("after_of", F.struct("at", "seq")).alias("table"))
    first = F.min("piece").over(Window.partitionBy("claim_id"))
    many = ends.withColumn("first", first).withColumn("last", F.max("piece").over(Window.partitionBy("claim_id"))).where("first < last")
    earlier = Window.partitionBy("claim_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.aggregate(F.collect_list("table").over(earlier), F.lit(0), lambda s, t: F.get(t, s))
    begins = many.withColumn("start", begins).select("claim_id", "piece", "start")
    met = F.get("before_of", F.coalesce("start", F.lit(0)))
    rows = walked.join(begins, ["claim_id", "piece"], "left").withColumn("met", met)
    legal = F.col("table").isNotNull() & (F.get("table", F.col("met")) != F.col("met"))
    rule = F.when(F.col("fault") == "UNKNOWN_CLAIM", F.col("fault")).when(~F.coalesce(legal, F.lit(False)), "ILLEGAL_STEP").otherwise(F.col("fault"))
    named = F.array(*map(F.lit, states))
    return rows.select("claim_id", "seq", "at", F.get(named, F.col("met")).alias("before"), "action", "to_status", "actor", "confirmed_by", rule.alias("rule"))


def states_of(opened: DataFrame, moves: DataFrame) -> DataFrame:
    """Where each opened claim stands after its moves (as :func:`replayed` gives them): refused ones change nothing."""
    held = moves.where("rule IS NULL").groupBy("claim_id").agg(F.max_by(F.struct("to_status", "confirmed_by", "at"), F.struct("at", "seq")).alias("last"))
    state = F.coalesce("last.to_status", F.lit(START))
    return opened.join(held, "claim_id", "left").select("claim_id", "opened_by", state.alias("status"), F.when(state == "locked", F.col("last.confirmed_by")).alias("locked_by"), F.col("last.at").alias("changed_at"))
