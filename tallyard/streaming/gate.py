"""A gate in the stream of deliveries: what a source sent before is kept as state, not looked up in an audit of all files.

Each source's state is the newest generation that was promoted and, by batch, the hash of its content; both live in the
state store behind the checkpoint, so a run that starts again goes on where the last one ended. Sources share buckets, so
that what a call costs is paid once for many of them, and the store is asked once for each source and batch of a micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DELIVERY = "source_id string, batch_id string, generated_at string, content_hash string, arrival long"
#: Files of a micro-batch: a bucket's deliveries of one are put in order in memory.
FILES = 1000
#: Sources by hash, each bucket with a state of its own; of a kept checkpoint, this number stays as it is.
BUCKETS = 1024
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def instant(text: str | None) -> int | None:
    """Microseconds since 1970 of an ISO instant (UTC where it names no zone), or null for what isn't one."""
    try:
        at = datetime.fromisoformat(text)
    except (TypeError, ValueError):
        return None
    at = at if at.tzinfo else at.replace(tzinfo=UTC)
    return round((at - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds() * 1e6)


class Gate(StatefulProcessor):
    """Judges the deliveries of a bucket's sources, each source's in the order of arrival; only a promoted one changes what is known.

    Verdicts: PROMOTED; SKIPPED_DUPLICATE (the same content of the same batch); REGENERATED_BATCH (other content of a
    batch that was promoted); UNREADABLE_GENERATION; STALE_MANIFEST (a new batch no newer than the newest promoted one).
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getMapState("newest", "source_id string", "micros long")
        self.hashes = handle.getMapState("hashes", "source_id string, batch_id string", "content_hash string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        given = pd.concat(list(rows)).sort_values(["source_id", "arrival", "batch_id", "content_hash"], kind="stable")
        verdicts, source, newest, before, known = [], None, None, None, {}
        for name, batch, generated, content in zip(given["source_id"], given["batch_id"], given["generated_at"], given["content_hash"], strict=True):
            if name != source:
                if newest != before:
                    self.newest.updateValue((source,), (newest,))
                source, known = name, {}
                kept = self.newest.getValue((source,))
                newest = before = None if kept is None else kept[0]
            if batch not in known:  # a source of which nothing was promoted has no batches either
                kept = None if before is None else self.hashes.getValue((source, batch))
                known[batch] = None if kept is None else kept[0]
            at = instant(generated)
            if known[batch] is not None:
                verdicts.append("SKIPPED_DUPLICATE" if known[batch] == content else "REGENERATED_BATCH")
            elif at is None:
                verdicts.append("UNREADABLE_GENERATION")
            elif newest is not None and at <= newest:
                verdicts.append("STALE_MANIFEST")
            else:
                verdicts.append("PROMOTED")
                newest, known[batch] = at, content
                self.hashes.updateValue((source, batch), (content,))
        if newest != before:
            self.newest.updateValue((source,), (newest,))
        given["verdict"] = verdicts
        yield given[["source_id", "batch_id", "generated_at", "content_hash", "arrival", "verdict"]]

    def close(self) -> None:
        pass


def judge_available(spark: SparkSession, inbox: str, out: str, checkpoint: str) -> None:
    """Judges the deliveries (rows of DELIVERY as Parquet files) of ``inbox`` that no earlier run judged, then stops.

    Each micro-batch writes its own folder of verdicts below ``out``, replaced if the micro-batch is replayed. Rows without
    a source or batch are judged MALFORMED, without state.
    """
    rows = spark.readStream.schema(DELIVERY).option("maxFilesPerTrigger", FILES).parquet(inbox)
    named = rows.where("source_id IS NOT NULL AND batch_id IS NOT NULL AND content_hash IS NOT NULL")
    judged = named.withColumn("bucket", F.pmod(F.xxhash64("source_id"), F.lit(BUCKETS))).groupBy("bucket").transformWithStateInPandas(Gate(), f"{DELIVERY}, verdict string", "Append", "None")
    odd = rows.where("source_id IS NULL OR batch_id IS NULL OR content_hash IS NULL").withColumn("verdict", F.lit("MALFORMED"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        stream = judged.unionByName(odd).writeStream.foreachBatch(keep).outputMode("append").option("checkpointLocation", checkpoint)
        stream.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
