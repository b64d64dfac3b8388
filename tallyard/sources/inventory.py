"""Kept inventories of keys: what the warehouse holds of an entity, so that a delivery is compared without dealing old keys anew.

Keys lie in buckets by their hash, sorted, as a base and runs of changes (a key came, or went). A delivery is dealt to the
same buckets once, and joined with the base and its runs where these lie: no exchange of what is kept. It then only
keeps its own changes, as a new run; many runs are folded into a new base. Which runs count is a version of the
inventory's folder, so that a delivery that fails changes nothing.

A join that keeps all rows of both sides would lose the buckets, so each key is looked at from the oldest table that has
it: that table without the keys of older ones, joined to the left with the newer ones.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import Versions

RUNS = 4


class KeyInventory:
    """The keys of an entity in the folder ``path``, in ``buckets`` buckets; opened anew, it goes on."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, most_runs: int = RUNS):
        self.spark, self.path, self.buckets, self.most_runs = spark, path.rstrip("/"), buckets, most_runs
        self.versions = Versions(spark, self.path, T.StructType([T.StructField("source_key", T.StringType()), T.StructField("present", T.BooleanType())]))
        self.tag = f"keys_{uuid.uuid4().hex[:12]}"
        self._named: set[str] = set()

    def _runs(self) -> list[dict]:
        known = self.versions.numbers()
        return self.versions.record(known[-1])["runs"] if known else []

    def _table(self, run: dict) -> DataFrame:
        name = f"{self.tag}_{run['folder'].replace('-', '_')}"
        if name not in self._named:
            n = run["buckets"]
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (source_key string, present boolean) USING parquet CLUSTERED BY (source_key) SORTED BY (source_key) INTO {n} BUCKETS LOCATION '{self.path}/{run['folder']}'")
            self._named.add(name)
        return self.spark.table(name)

    def _write(self, rows: DataFrame, kind: str) -> dict:
        folder = f"{kind}-{uuid.uuid4().hex}"
        name = f"{self.tag}_{folder.replace('-', '_')}"
        dealt = rows.select("source_key", "present").repartition(self.buckets, "source_key")
        dealt.write.bucketBy(self.buckets, "source_key").sortBy("source_key").option("path", f"{self.path}/{folder}").format("parquet").saveAsTable(name)
        self._named.add(name)
        return {"folder": folder, "run": 0, "buckets": self.buckets}

    def _states(self, tables: list[DataFrame]) -> list[DataFrame]:
        """source_key, present of all keys of the tables (oldest first), of each key the newest: by the first table that has it."""
        out = []
        for i, own in enumerate(tables):
            df = own.select("source_key", F.col("present").alias("p0"))
            for older in tables[:i]:
                df = df.join(older.select("source_key").hint("merge"), "source_key", "left_anti")
            for k, newer in enumerate(tables[i + 1 :], 1):
                df = df.join(newer.select("source_key", F.col("present").alias(f"p{k}")).hint("merge"), "source_key", "left")
            out.append(df.select("source_key", F.coalesce(*(F.col(f"p{k}") for k in range(len(tables) - i - 1, -1, -1))).alias("present")))
        return out

    def held(self) -> DataFrame:
        """All keys that count as there (source_key)."""
        states = self._states([self._table(run) for run in self._runs()])
        return reduce(DataFrame.unionByName, states).where("present").select("source_key") if states else self.spark.createDataFrame([], "source_key string")

    def compare(self, delivery: DataFrame) -> DataFrame:
        """source_key and change of each key that differs from a full delivery (source_key): CAME or WENT.

        The delivery is written in buckets first, its only exchange. An empty one changes nothing: a source that can't be
        read doesn't lose its keys.
        """
        keys = delivery.where(F.col("source_key").isNotNull()).select("source_key").distinct()
        new = self._table(self._write(keys.withColumn("present", F.lit(True)), "delivery")).select("source_key")
        if new.isEmpty():
            return self.spark.createDataFrame([], "source_key string, change string")
        tables = [self._table(run) for run in self._runs()]
        parts = []
        for state in self._states(tables):
            both = state.join(new.withColumn("new", F.lit(True)).hint("merge"), "source_key", "left").where("present <> (new IS NOT NULL)")
            parts.append(both.select("source_key", F.when(F.col("present"), "WENT").otherwise("CAME").alias("change")))
        for old in tables:
            new = new.join(old.select("source_key").hint("merge"), "source_key", "left_anti")
        return reduce(DataFrame.unionByName, [*parts, new.withColumn("change", F.lit("CAME"))])

    def take(self, delivery: DataFrame) -> DataFrame:
        """Compares a full delivery, keeps what changed as a run, and returns the changes (source_key, change)."""
        first = not self._runs()
        run = self._write(self.compare(delivery).withColumn("present", F.col("change") == "CAME"), "base" if first else "run")
        self.versions.commit(lambda runs: [*runs, run])
        changes = self._table(run).select("source_key", F.when(F.col("present"), "CAME").otherwise("WENT").alias("change"))
        if len(self._runs()) > self.most_runs:
            self.compact()
        return changes

    def compact(self) -> None:
        """Folds base and runs into a new base; runs that came meanwhile stay on top of it."""
        folded = [r["folder"] for r in self._runs()]
        base = self._write(self.held().withColumn("present", F.lit(True)), "base")
        self.versions.commit(lambda runs: [base, *runs[len(folded) :]] if [r["folder"] for r in runs[: len(folded)]] == folded else runs)

    def close(self) -> None:
        """Takes the tables out of the session's catalog; their files stay."""
        for name in self._named:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._named.clear()
