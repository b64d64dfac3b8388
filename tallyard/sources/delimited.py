"""Delimited files with quoted cells, read over splits: any file is read by many tasks, whatever its cells hold.

Python's csv module sets the rules: a cell may be quoted, a quote inside of one is doubled, and a quoted cell may hold
delimiters and line breaks, so that a line by itself doesn't tell whether it begins inside of a cell. So

1. every split is read once, line by line, under both assumptions (its first line begins outside or inside of quotes);
   each line gets its state and the number of its record within the split under either;
2. a split as a whole maps the state before it to the state behind it: it keeps it, turns it over, or sets it. A
   window over the splits of a file (one row each) finds the true state before each of them and how many records came
   before;
3. lines that are records by themselves are cut where they are; only the lines of records that span several meet by
   file and record, also over the seams of splits.

A record keeps its number of fields, so that rows of another width than the header can be told apart.
"""

from __future__ import annotations

import codecs
import csv
import io
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scratch import written

#: A record that spans lines and is longer than this isn't put together, but reported as malformed: an open quote
#: would otherwise gather the rest of its file in one row.
RECORD_BYTES = 16 << 20

_LINE = "path string, split long, at long, text string, readable boolean, quoted boolean, in_out boolean, end_out boolean, no_out long, in_in boolean, end_in boolean, no_in long"


class QuoteState:
    """Whether the end of a line lies inside of quotes, for either state of its beginning."""

    def __init__(self, delimiter: str):
        d = re.escape(delimiter)
        rest = rf'(?:(?:"[^"]*+(?:""[^"]*+)*+"[^{d}]*+|(?!")[^{d}]*+)(?:{d}|\Z))*+'
        self.outside = re.compile(rest, re.DOTALL)
        self.inside = re.compile(rf'[^"]*+(?:""[^"]*+)*+"[^{d}]*+(?:{d}{rest}|\Z)', re.DOTALL)

    def after(self, line: str, inside: bool) -> bool:
        if '"' not in line:
            return inside
        m = (self.inside if inside else self.outside).match(line)
        return m is None or m.end() < len(line)


def check_encoding(encoding: str) -> str:
    """The name of an encoding in which lines, commas and quotes are single bytes as in ASCII; ValueError for others."""
    try:
        name = codecs.lookup(encoding).name
    except LookupError:
        raise ValueError(f"unknown encoding: {encoding!r}") from None
    if 'a,"\r\n'.encode(name.removesuffix("-sig").replace("_sig", "")) != b'a,"\r\n':
        raise ValueError(f"files in {encoding} can't be split at lines")
    return "utf-8" if name == "utf-8-sig" else name


def _lines(spark: SparkSession, path: str, delimiter: str, encoding: str) -> DataFrame:
    """All lines of all files with their state under both assumptions, in splits as Spark deals them."""
    raw = spark.read.text(path, lineSep="\n").select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = QuoteState(delimiter)
        now, out, inn, no_out, no_in = None, False, True, 0, 0
        for b in batches:
            columns: list[list] = [[] for _ in range(9)]
            for value, path, split in zip(b.column("value").to_pylist(), b.column("path").to_pylist(), b.column("split").to_pylist(), strict=True):
                if (path, split) != now:
                    now, out, inn, no_out, no_in = (path, split), False, True, 0, 0
                try:
                    text, readable = value.decode(encoding), True
                except UnicodeDecodeError:
                    text, readable = value.decode(encoding, "replace"), False
                if split == 0 and no_out == 0 and text.startswith("\ufeff"):
                    text = text[1:]
                quoted = '"' in text
                end_out, end_in = (state.after(text, out), state.after(text, inn)) if quoted else (out, inn)
                begins = text not in ("", "\r")  # a blank line outside of quotes is no record
                no_out += begins and not out
                no_in += begins and not inn
                for to, x in zip(columns, (text, readable, quoted, out, end_out, no_out, inn, end_in, no_in), strict=True):
                    to.append(x)
                out, inn = end_out, end_in
            kinds = [pa.string(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64()]
            made = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("split"), b.column("at"), *made], names=[c.split()[0] for c in _LINE.split(", ")])

    return raw.mapInArrow(run, _LINE)


def _splits(lines: DataFrame) -> DataFrame:
    """Of each split of a file: whether it begins inside of quotes, and how many records begin before it."""
    last = F.max(F.struct("at", "end_out", "end_in")).alias("last")
    splits = lines.groupBy("path", "split").agg(last, F.max("no_out").alias("n_out"), F.max("no_in").alias("n_in"))
    splits = splits.select("path", "split", "n_out", "n_in", F.col("last.end_out").alias("end_out"), F.col("last.end_in").alias("end_in"))
    turns = (F.col("end_out") & ~F.col("end_in")).cast("int")
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, 0)
    # the last split before that sets the state, and the turns since then
    splits = splits.withColumn("turned", F.sum(turns).over(upto))
    sets = F.when(F.col("end_out") == F.col("end_in"), F.struct(F.col("end_out").cast("int").alias("to"), F.col("turned").alias("turned")))
    splits = splits.withColumn("set", F.last(sets, ignorenulls=True).over(before)).withColumn("had", F.coalesce(F.lag("turned").over(Window.partitionBy("path").orderBy("split")), F.lit(0)))
    inside = (F.coalesce("set.to", F.lit(0)) + F.col("had") - F.coalesce("set.turned", F.lit(0))) % 2 == 1
    splits = splits.withColumn("inside", inside)
    count = F.when(F.col("inside"), F.col("n_in")).otherwise(F.col("n_out"))
    return splits.withColumn("records", F.coalesce(F.sum(count).over(before), F.lit(0))).select("path", "split", "inside", "records")


def _parsed(rows: DataFrame, delimiter: str) -> DataFrame:
    """path, record, cells of each (path, record, text); cells is null where the text is no record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for b in batches:
            cells = []
            for text in b.column("text").to_pylist():
                try:
                    cells.append(None if text is None else next(csv.reader(io.StringIO(text, newline="\n"), delimiter=delimiter), []))
                except csv.Error:
                    cells.append(None)
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("record"), pa.array(cells, pa.list_(pa.string()))], names=["path", "record", "cells"])

    return rows.select("path", "record", "text").mapInArrow(run, "path string, record long, cells array<string>")


def read_records(spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "utf-8") -> DataFrame:
    """source_path, record (from 0, in the order of the file; the header is one) and cells of all records.

    Blank lines are no records. cells is null for what is no record: bytes that aren't of the encoding, a carriage return
    by itself outside of quotes, or more than RECORD_BYTES over several lines. Files without lines are in no row. The
    lines are written to the shared folder once.
    """
    if len(delimiter) != 1 or delimiter in '"\r\n':
        raise ValueError(f"no delimiter: {delimiter!r}")
    lines = written(_lines(spark, path, delimiter, check_encoding(encoding)), "drop-lines")
    pick = lambda a, b: F.when(F.col("inside"), F.col(a)).otherwise(F.col(b))
    placed = lines.join(_splits(lines), ["path", "split"]).select(
        "path", "at", "text", "readable", "quoted", pick("in_in", "in_out").alias("starts_in"), pick("end_in", "end_out").alias("ends_in"), (F.col("records") + pick("no_in", "no_out") - 1).alias("record")
    )
    whole = placed.where("NOT starts_in AND NOT ends_in AND text <> '' AND text <> '\\r'")
    bare = F.regexp_replace("text", "\\r$", "")
    simple = F.col("readable") & ~F.col("quoted") & ~bare.contains("\r")
    plain = whole.where(simple).select("path", "record", F.split(bare, f"\\Q{delimiter}\\E", -1).alias("cells"))
    alone = whole.where(~simple).select("path", "record", F.when(F.col("readable"), F.concat("text", F.lit("\n"))).alias("text"))
    # lines of records that span several; those of one that is too long never meet
    spanning = placed.where("starts_in OR ends_in")
    sizes = spanning.groupBy("path", "record").agg(F.sum(F.octet_length("text") + 1).alias("bytes"), F.bool_and("readable").alias("fine"))
    fits = sizes.where(F.col("fine") & (F.col("bytes") <= RECORD_BYTES)).select("path", "record")
    joined = spanning.join(fits, ["path", "record"], "left_semi").groupBy("path", "record").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]).alias("parts"))
    joined = joined.select("path", "record", F.concat(F.array_join("parts", "\n"), F.lit("\n")).alias("text"))
    broken = sizes.where(~F.col("fine") | (F.col("bytes") > RECORD_BYTES)).select("path", "record", F.lit(None).cast("string").alias("text"))
    cut = _parsed(alone.unionByName(joined).unionByName(broken), delimiter)
    return plain.unionByName(cut).select(F.col("path").alias("source_path"), "record", "cells")


def headers(records: DataFrame) -> DataFrame:
    """source_path and header (trimmed names) of each file: its first record."""
    return records.where("record = 0").select("source_path", F.transform(F.coalesce("cells", F.array().cast("array<string>")), lambda c: F.trim(c)).alias("header"))
