"""Incremental landing of files as a stream that runs until what is there is landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.keys import natural_id


def land_available(spark: SparkSession, inbox: str, schema: StructType, lake: str, audit: str, checkpoint: str, keys: list[str], source_id: str, file_format: str = "parquet", options: dict | None = None) -> None:
    """Lands the files of ``inbox`` that no earlier run landed, then stops.

    The checkpoint is the cursor. Each micro-batch writes its own partition of the lake (replaced if the batch is
    replayed), and its receipt last, so a receipt means that the rows are there; a second run lands nothing.
    """
    rows = spark.readStream.schema(schema).format(file_format).options(**(options or {})).load(inbox)
    stamped = rows.withColumns({"source_id": natural_id(*keys), "source_file": F.col("_metadata.file_name")})

    def promote(batch: DataFrame, number: int) -> None:
        path = f"{lake}/batch={number}"
        batch.write.mode("overwrite").parquet(path)
        landed = batch.sparkSession.read.schema(batch.schema).parquet(path)
        receipt = landed.groupBy(F.col("source_file").alias("file_name")).agg(F.count(F.lit(1)).alias("rows_parsed"))
        receipt.select(F.lit(source_id).alias("source"), F.lit(number).cast("long").alias("batch_no"), "file_name", "rows_parsed", F.lit("PROMOTED").alias("status")).write.mode("overwrite").parquet(f"{audit}/batch={number}")

    stamped.writeStream.foreachBatch(promote).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
