"""Versions of a landed entity: what readers see changes in one step, and only when all of it has been written.

An entity is a folder. Rows are written beside those that are there; then a numbered commit record, which lists the
folders of rows that count, is put in place by creating a file that must not be there yet. Readers take the newest
record, so they never see half of a landing, and a writer that fails leaves nothing but folders that no record lists.
Of two writers that try the same number one wins; the other takes up what the winner wrote and tries the next one.

A merge only writes its own rows, as a run of a higher number; readers let the newest run decide for each key, and
compaction folds runs into one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Times that a writer tries the next number when others are faster.
TRIES = 20

RUN = "_run"


class Conflict(RuntimeError):
    """Other writers kept being faster, or changed what a rewrite was made of."""


class Versions:
    """The versions of an entity in the folder ``path``, whose rows have ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._fs = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    # ---- records

    def numbers(self) -> list[int]:
        """The numbers of the versions that are there, oldest first."""
        folder = self._hadoop(f"{self.path}/commits")
        found = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n) for n in found if n.isdigit())

    def record(self, number: int) -> dict:
        stream = self._fs.open(self._hadoop(f"{self.path}/commits/{number:020}"))
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _put(self, number: int, record: dict) -> bool:
        """Writes a record aside, whole, and moves it to its number; False if another writer has that number."""
        aside, place = f"{self.path}/commits/.{uuid.uuid4().hex}", f"{self.path}/commits/{number:020}"
        stream = self._fs.create(self._hadoop(aside), False)
        stream.write(bytearray(json.dumps(record).encode()))
        stream.close()
        jvm = self.spark._jvm
        try:
            if self._fs.getScheme() == "file":  # a hard link is made if and only if the name is free
                local = lambda p: jvm.java.nio.file.Paths.get(self._hadoop(p).toUri().getPath(), self.spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
                jvm.java.nio.file.Files.createLink(local(place), local(aside))
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._hadoop(self.path).toUri(), self.spark._jsc.hadoopConfiguration())
                context.rename(self._hadoop(aside), self._hadoop(place), self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
            return True
        except Exception as e:  # noqa: BLE001  py4j wraps what the file system throws
            if "AlreadyExists" in str(e):
                return False
            raise
        finally:
            self._fs.delete(self._hadoop(aside), False)

    def commit(self, change: Callable[[list[dict]], list[dict]]) -> int:
        """Makes the next version of ``change`` applied to the newest one's runs; tries again when another writer was faster."""
        for _ in range(TRIES):
            known = self.numbers()
            number = known[-1] + 1 if known else 1
            if self._put(number, {"runs": change(self.record(known[-1])["runs"] if known else [])}):
                return number
        raise Conflict(f"{self.path}: {TRIES} versions were taken by others")

    # ---- writing

    def _write(self, df: DataFrame) -> dict:
        name = f"rows-{uuid.uuid4().hex}"
        df.select(*self.schema.fieldNames()).write.parquet(f"{self.path}/{name}")
        return {"folder": name}

    def replace(self, df: DataFrame) -> int:
        """All rows anew; the rows before stay readable until then, and as older versions after it."""
        run = self._write(df)
        return self.commit(lambda _: [run | {"run": 1}])

    def append(self, df: DataFrame) -> int:
        """More rows beside those of the newest run."""
        run = self._write(df)
        return self.commit(lambda runs: [*runs, run | {"run": max((r["run"] for r in runs), default=1)}])

    def merge(self, df: DataFrame) -> int:
        """Rows that replace those of the same key, whatever is there when they count; only they are written."""
        run = self._write(df)
        return self.commit(lambda runs: [*runs, run | {"run": 1 + max((r["run"] for r in runs), default=0)}])

    def compact(self, keys: list[str], order: list[str]) -> int:
        """Folds the runs of the newest version into one; what others land meanwhile stays on top of it."""
        known = self.numbers()
        if not known:
            raise ValueError(f"{self.path} has no version")
        folded = self.record(known[-1])["runs"]
        run = self._write(self.current(keys, order, known[-1]))
        names = [r["folder"] for r in folded]

        def change(runs: list[dict]) -> list[dict]:
            if [r["folder"] for r in runs[: len(names)]] != names:
                raise Conflict(f"{self.path} was replaced while it was compacted")
            return [run | {"run": folded[-1]["run"] if folded else 1}, *runs[len(names) :]]

        return self.commit(change)

    # ---- reading

    def rows(self, number: int | None = None) -> DataFrame:
        """All rows of a version (by default the newest; none yet: no rows), with the number of their run in ``_run``."""
        known = self.numbers()
        runs = self.record(known[-1] if number is None else number)["runs"] if known else []
        fields = T.StructType([*self.schema, T.StructField(RUN, T.LongType())])
        if not runs:
            return self.spark.createDataFrame([], fields)
        by_run: dict[int, list[str]] = {}
        for r in runs:
            by_run.setdefault(r["run"], []).append(f"{self.path}/{r['folder']}")
        out = None
        for run, folders in by_run.items():
            part = self.spark.read.schema(self.schema).parquet(*folders).withColumn(RUN, F.lit(run).cast("long"))
            out = part if out is None else out.unionByName(part)
        return out

    def read(self, number: int | None = None) -> DataFrame:
        """All rows of a version, as they were landed."""
        return self.rows(number).drop(RUN)

    def current(self, keys: list[str], order: list[str], number: int | None = None) -> DataFrame:
        """One row a key: of the newest run that has it, the greatest by ``order``. Partial maxima go before the shuffle."""
        rows = self.rows(number)
        rest = [c for c in self.schema.fieldNames() if c not in keys]
        best = F.max_by(F.struct(*rest), F.struct(RUN, *order, *[c for c in rest if c not in order and _ordered(self.schema[c].dataType)])).alias("_best") if rest else F.count(F.lit(1)).alias("_best")
        found = rows.groupBy(*keys).agg(best)
        return found.select(*(F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in self.schema.fieldNames()))

    def expire(self, keep: int = 10) -> list[str]:
        """Removes all but the newest ``keep`` versions, and the rows that only those had; returns the folders removed.

        Folders that no version lists aren't touched: another writer may be about to commit them.
        """
        known = self.numbers()
        old, stay = known[:-keep] if keep else known, known[-keep:] if keep else []
        folders = lambda ns: {r["folder"] for n in ns for r in self.record(n)["runs"]}
        gone = sorted(folders(old) - folders(stay))
        for n in old:
            self._fs.delete(self._hadoop(f"{self.path}/commits/{n:020}"), False)
        for name in gone:
            self._fs.delete(self._hadoop(f"{self.path}/{name}"), True)
        return gone


def _ordered(kind: T.DataType) -> bool:
    """Whether values of a type can be compared, to break ties by them."""
    return not isinstance(kind, (T.MapType, T.VariantType))
