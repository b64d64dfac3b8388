"""Delete reconciliation: key inventories, anti-join tombstones, sweeps, triage. Keys stay distributed throughout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import natural_id, ratio

#: Delete semantics of an entity that an anti-join of key inventories may decide.
BATCH = "anti_join"


def source_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct natural ids that the source still holds; leave soft-deleted rows out before."""
    return df.select(natural_id(*keys).alias("source_key")).distinct()


def warehouse_keys(df: DataFrame) -> DataFrame:
    return df.select(F.col("source_id").alias("source_key")).distinct()


def tombstones(source: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Keys of the warehouse that the source has no more; none at all if the source is empty.

    The guard against an empty source is a one-row semi-join, so it is decided inside the job.
    """
    some = source.limit(1).select(F.lit(1).alias("_some"))
    gone = warehouse.join(source, "source_key", "left_anti")
    return gone.join(F.broadcast(some), F.lit(1) == F.col("_some"), "left_semi")


def snapshot_diff(previous: DataFrame, new: DataFrame) -> DataFrame:
    """Keys of the previous full snapshot that the new one lacks."""
    return tombstones(new, previous)


def may_reconcile(entities: DataFrame) -> DataFrame:
    """Entities whose deletes an anti-join may find: not those with change capture or period-scoped extracts."""
    return entities.where((F.col("delete_semantics") == BATCH) & F.col("enabled"))


def ratio_of(tombstoned: str | Column, warehouse: str | Column) -> Column:
    return F.coalesce(ratio(tombstoned, warehouse), F.lit(0.0))


def live(staged: DataFrame, gone: DataFrame) -> DataFrame:
    """Staged rows without those whose key has a tombstone."""
    return staged.join(gone.select(F.col("source_key").alias("source_id")), "source_id", "left_anti")


def tag(df: DataFrame, source: str, entity: str) -> DataFrame:
    return df.select(F.lit(source).alias("source_id"), F.lit(entity).alias("entity"), "source_key")


def sweep(source: list[DataFrame], warehouse: list[DataFrame]) -> DataFrame:
    """Per (source_id, entity): counts of both inventories, tombstones and their share, from one job.

    Each list holds tagged inventories (source_id, entity, source_key). An entity whose source inventory is empty
    counts as not scanned: source_keys is 0 and nothing is tombstoned.
    """
    both = reduce(DataFrame.unionByName, [d.withColumn("side", F.lit(1)) for d in source] + [d.withColumn("side", F.lit(2)) for d in warehouse])
    # one row for each key, then partial sums for each entity: a large entity doesn't meet in one task
    keys = both.groupBy("source_id", "entity", "source_key").agg(F.bool_or(F.col("side") == 1).alias("there"), F.bool_or(F.col("side") == 2).alias("here"))
    counts = keys.groupBy("source_id", "entity").agg(F.count_if("there").alias("source_keys"), F.count_if("here").alias("warehouse_keys"), F.count_if(F.col("here") & ~F.col("there")).alias("missing"))
    return counts.withColumn("tombstoned", F.when(F.col("source_keys") > 0, F.col("missing")).otherwise(0)).drop("missing").withColumn("ratio", ratio_of("tombstoned", "warehouse_keys"))


def triage(runs: DataFrame, alert_ratio: float = 0.10) -> DataFrame:
    """What to do about each run: REVIEW, APPLY, SKIP_LOUD (no scan), or NONE."""
    action = F.when(F.col("source_keys") == 0, "SKIP_LOUD").when(F.col("ratio") >= alert_ratio, "REVIEW").when(F.col("tombstoned") > 0, "APPLY").otherwise("NONE")
    return runs.withColumn("action", action)


def fidelity(gone: DataFrame, next_keys: DataFrame, flagged: DataFrame) -> DataFrame:
    """How reviews fared: the share of each entity's tombstones whose keys came back in the next inventory.

    gone: source_id, entity, source_key; flagged: source_id, entity of runs sent to review.
    """
    back = next_keys.select("source_id", "entity", "source_key", F.lit(1).alias("back")).distinct()
    rates = gone.join(back, ["source_id", "entity", "source_key"], "left").groupBy("source_id", "entity").agg(F.avg(F.coalesce("back", F.lit(0))).alias("false_delete_rate"))
    marks = flagged.select("source_id", "entity", F.lit(True).alias("flagged")).distinct()
    verdict = F.when(F.col("flagged") & (F.col("false_delete_rate") >= 0.5), "CORRECT").when(F.col("flagged"), "FALSE_ALARM").otherwise("UNFLAGGED")
    return rates.join(marks, ["source_id", "entity"], "left").select("source_id", "entity", "false_delete_rate", verdict.alias("verdict"))
