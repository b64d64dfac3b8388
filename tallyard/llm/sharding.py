"""Balanced contiguous shards from byte-size prefix sums, with DataFrame functions only.

Rows are laid out in one fixed total order: by a 64-bit hash of the text, then by doc_id. The order is cut into
cells (ranges of the hash), each small enough for a task; the totals of the cells give every cell its global
offset, and a running sum inside the cell gives every row its global byte position. The line of all bytes is cut
at equal targets, so shards are contiguous in that order. Equal texts are neighbours and stay together, unless
their group is so large (over 1/64 of a shard) that keeping it whole would unbalance the shards; then its rows
are dealt over sub-cells by doc_id and placed one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Hash ranges, and the least number of sub-ranges of a large group, which has as many as its rows would fill ranges: at
#: most twice as many in all, so the table of offsets is bounded whatever the input, and so is a task's share of a group.
CELLS = 2048
PARTS = 16
#: A group of equal texts is kept whole if it is at most this part of a shard.
WHOLE = 64


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """Assigns every row to one of ``shards`` contiguous shards of nearly equal bytes.

    Returns id, size (UTF-8 bytes plus 1; null text: 1), text_crc32 (null: of no bytes), shard and slot (0, 1, ...
    in each shard). Rows with a null id or a repeated id are kept as they are; ties are ordered by size and
    checksum. Other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    text = F.col(text_col)
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
            F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"),
        ),
        "shard-sizes",
    )
    total = rows.agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("total_n"))
    parts = F.greatest(F.lit(PARTS), F.ceil(F.col("n") * CELLS / F.col("total_n"))).cast("int")
    # at most shards * WHOLE groups can be over this size: a bounded table
    large = (
        rows.groupBy("h").agg(F.sum("size").alias("group_size"), F.count(F.lit(1)).alias("n"))
        .crossJoin(F.broadcast(total))
        .where((F.col("n") > 1) & (F.col("group_size") * shards * WHOLE > F.col("total")))
        .select("h", F.lit(True).alias("large"), parts.alias("parts"))
    )
    cut = F.shiftright(F.col("h"), 53) + 1024 if cells == 2048 else F.pmod(F.shiftright(F.col("h"), 32), F.lit(cells))
    placed = (
        rows.join(F.broadcast(large), "h", "left")
        .withColumn("cell", cut.cast("int"))
        # within a cell: first the rows of small groups, then each large group, in parts
        .withColumn("hot", F.when(F.col("large"), F.col("h")))
        .withColumn("part", F.when(F.col("large"), F.pmod(F.xxhash64("id"), F.col("parts"))).otherwise(0).cast("int")).drop("parts")
    )
    cell = ["cell", "hot", "part"]
    line = Window.orderBy(F.col("cell"), F.col("hot").asc_nulls_first(), F.col("part"))
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*cell).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        .withColumn("byte_at", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
        .withColumn("row_at", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select(*cell, "byte_at", "row_at")
    )
    # 2 * CELLS + shards * WHOLE * PARTS rows at most, so this table too may be broadcast
    keyed = placed.join(
        F.broadcast(offsets.withColumnRenamed("cell", "c").withColumnRenamed("hot", "g").withColumnRenamed("part", "p")),
        (F.col("cell") == F.col("c")) & F.col("hot").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")),
    )
    inside = Window.partitionBy(*cell).orderBy("h", "id", "size", "crc").rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy(*cell, "h")
    at = (
        keyed.withColumn("end", F.col("byte_at") + F.sum("size").over(inside))
        .withColumn("n", F.col("row_at") + F.count(F.lit(1)).over(inside) - 1)
        .withColumn("lo", F.when(F.col("large"), F.col("end") - F.col("size")).otherwise(F.min(F.col("end") - F.col("size")).over(group)))
        .withColumn("hi", F.when(F.col("large"), F.col("end")).otherwise(F.max("end").over(group)))
        .crossJoin(F.broadcast(total))
        # the middle of the row's (or group's) bytes against equal targets
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor((F.col("lo") + F.col("hi")) * shards / (F.col("total") * 2)).cast("int")))
        .select("id", "size", "crc", "shard", "n")
    )
    at = materialize(at, "shard-positions")
    starts = at.groupBy("shard").agg(F.min("n").alias("from"))
    return at.join(F.broadcast(starts), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("n") - F.col("from")).alias("slot")
    )


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard_by_bytes(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
