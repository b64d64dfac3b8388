"""What was valid when: lines joined with the windows of their key, by bins of days, for tables too large to broadcast.

A window is spread over the bins that it touches (of those its key has lines in), a line has one bin, and both meet by
(key, bin): a line meets each window once, so nothing is doubled, and a key that most lines share is cut by time. Keys
of few lines stay uncut, as long as those of more are few enough to be broadcast. A bin of a key that still holds more
lines than a task should is dealt over salts, to which only its windows are copied. Where the windows are few, by count,
all of their bins are broadcast, and lines stay where they are; many are never broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

BIN_DAYS = 32
#: Lines of one key and bin that meet in a task.
TASK_LINES = 1_000_000
#: Lines of one key up to which it isn't cut into bins.
BIN_LINES = 1_000
#: Bins of windows (or crowded keys) that are broadcast at most: some 10 MB.
FEW_WINDOWS = 100_000


def _bin(day: Column, days: int) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / days).cast("int")


def valid_at(lines: DataFrame, windows: DataFrame, key: str, at: str, start: str, end: str, days: int = BIN_DAYS, task_lines: int = TASK_LINES, few_windows: int = FEW_WINDOWS) -> DataFrame:
    """All lines (key, at, ...) with the columns of the windows (key, start, end, ...) of their key that hold ``at``.

    Both ends belong to a window. A line that no window holds stays, with nulls; one that several hold comes once for each;
    lines without a key or date hold nothing. Columns of the same name other than the key aren't allowed.
    """
    if both := (set(lines.columns) & set(windows.columns)) - {key}:
        raise ValueError(f"columns of both tables: {sorted(both)}")
    columns = [*lines.columns, *(c for c in windows.columns if c != key)]
    dated = lines.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn("_bin", _bin(F.col(at), days))
    # lines are read twice in all: for their keys, and to be joined; a third time only if bins may hold more than a task should
    span = written(dated.groupBy(key).agg(F.min("_bin").alias("_from"), F.max("_bin").alias("_to"), F.count(F.lit(1)).alias("_n")), "spans")
    few = windows.limit(few_windows + 1).count() <= few_windows
    # many are never broadcast: the optimizer knows the size of the files that windows are made of, not how many one row becomes
    met = (F.broadcast(windows) if few else windows.hint("merge")).join(span, key)
    met = met.withColumn("_a", F.greatest(_bin(F.col(start), days), "_from")).withColumn("_z", F.least(_bin(F.col(end), days), "_to")).where("_a <= _z AND " + f"`{start}` <= `{end}`")
    over = lambda bins: met.withColumn("_wbin", F.explode(bins)).withColumnRenamed(key, "_key").drop("_a", "_z", "_from", "_to", "_n")
    each = F.sequence("_a", "_z")
    on = (F.col(key) == F.col("_key")) & F.col(at).between(F.col(start), F.col(end))
    if few and (w := over(each)).limit(few_windows + 1).count() <= few_windows:
        return lines.join(F.broadcast(w), on & (_bin(F.col(at), days) == F.col("_wbin")), "left").select(*columns)
    least = min(BIN_LINES, task_lines)
    crowded = span.where(F.col("_n") > least).select(key)
    n = crowded.limit(few_windows + 1).count()
    if n <= few_windows:  # the others stay uncut, in a bin 0
        cut = F.broadcast(crowded.withColumn("_cut", F.lit(True)))
        w = over(F.when(F.col("_n") > least, each).otherwise(F.array(F.lit(0))))
        dealt = lines.join(cut, key, "left") if n else lines.withColumn("_cut", F.lit(None).cast("boolean"))
        dealt = dealt.withColumn("_bin", F.when(F.col("_cut") | F.col(key).isNull(), _bin(F.col(at), days)).otherwise(0)).drop("_cut")
    else:
        w, dealt = over(each), lines.withColumn("_bin", _bin(F.col(at), days))
    on &= F.col("_bin") == F.col("_wbin")
    full = span.where(F.col("_n") > task_lines).select(key)
    if n and not full.isEmpty():  # rows of both, keys and bins, are at most one for each task_lines lines
        counts = dated.join(F.broadcast(full), key, "left_semi").groupBy(key, "_bin").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > task_lines)
        hot = F.broadcast(written(counts.select(key, "_bin", F.ceil(F.col("_n") / task_lines).cast("int").alias("_salts")), "hot-bins"))
        w = w.join(hot.withColumnsRenamed({key: "_key", "_bin": "_wbin"}), ["_key", "_wbin"], "left").withColumn("_wsalt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
        # by the line itself, so that a task that is run again deals alike
        salt = F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*lines.columns), F.col("_salts"))).cast("int")
        dealt, on = dealt.join(hot, [key, "_bin"], "left").withColumn("_salt", salt).drop("_salts"), on & (F.col("_salt") == F.col("_wsalt"))
    return dealt.join(w.hint("merge"), on, "left").select(*columns)
