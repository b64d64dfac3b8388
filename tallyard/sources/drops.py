"""Landing of file drops: manifests, fingerprints, gates, typed scans, quarantine and promotion receipts.

A drop is a folder with a JSON manifest and the delimited files it declares. Each file's verdict is a column of a
DataFrame; a file that fails contributes no row. Everything stays distributed, paths included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files as streams
from .delimited import headers, read_records
from .schemas import entity_schema

MANIFEST = T.StructType(
    [
        T.StructField("batch_id", T.StringType()), T.StructField("generated_at", T.StringType()), T.StructField("source_company", T.StringType()), T.StructField("schema_version", T.StringType()),
        T.StructField("files", T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (("name", T.StringType()), ("sha256", T.StringType()), ("rows", T.LongType()), ("encoding", T.StringType()), ("delimiter", T.StringType()))]))),
    ]
)

#: Reasons for which a file is refused, in the order they are tested.
REASONS = ["MISSING_FILE", "EMPTY_FILE", "CHECKSUM_MISMATCH", "HEADER_SCHEMA_DRIFT", "PARSE_ERROR", "ROW_COUNT_MISMATCH"]


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per declared file: batch_id, generated_at, source_company, name, sha256, rows, encoding, delimiter, problem.

    problem names what is wrong with the manifest itself: a missing key, no files, or a name declared twice.
    """
    m = spark.read.schema(MANIFEST).json(path, multiLine=True)
    missing = F.when(F.col("batch_id").isNull() | F.col("generated_at").isNull() | F.col("source_company").isNull(), F.lit("MISSING_KEY")).when(F.coalesce(F.size("files"), F.lit(0)) <= 0, F.lit("NO_FILES"))
    files = m.withColumn("head_problem", missing).select("batch_id", "generated_at", "source_company", "head_problem", F.explode_outer("files").alias("f"))
    twice = F.count(F.lit(1)).over(Window.partitionBy("batch_id", "f.name")) > 1
    return files.select(
        "batch_id", "generated_at", "source_company", "f.name", F.lower("f.sha256").alias("sha256"), "f.rows", F.coalesce("f.encoding", F.lit("utf-8")).alias("encoding"), F.coalesce("f.delimiter", F.lit(",")).alias("delimiter"),
        F.coalesce("head_problem", F.when(F.col("f.name").isNull() | F.col("f.sha256").isNull() | F.col("f.rows").isNull(), "MISSING_KEY"), F.when(twice, "DUPLICATE_NAME")).alias("problem"),
    )


def fingerprint(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, folder (its last part), name, bytes, file_hash (SHA-256), lines and blank of each file, in bounded memory."""
    listed = streams.list_files(spark, folder, pattern)
    return listed.select("path", "folder", "name").join(streams.digests(listed), "path")


#: What counts as white space around a cell.
_SPACE = " \t\r\n\f\x0b"


def read_raw(spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "utf-8", columns: list[str] | None = None) -> DataFrame:
    """All cells as trimmed strings (blank: null) by each file's header, with source_path, source_file, source_row_no
    (from 1, behind the header), n_fields (of the record; null: it isn't one) and n_expected (of the header).

    A file's own header says where its columns stand; of a name that it repeats, the last one counts. A cell that the
    record or the header lacks is null. Without ``columns``, all names of all headers, in their order.
    """
    return raw_cells(read_records(spark, path, delimiter, encoding), columns)


def raw_cells(records: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The rows of :func:`read_raw` from records that were read already."""
    heads = headers(records)
    if columns is None:
        names = heads.select(F.posexplode("header").alias("at", "name")).groupBy("name").agg(F.min("at").alias("at")).where("name <> ''").orderBy("at", "name").collect()
        columns = [r["name"] for r in names]
    rows = records.where("record > 0").join(heads, "source_path")
    place = lambda c: F.array_position(F.reverse("header"), F.lit(c))
    cell = lambda c: F.when(place(c) > 0, F.get("cells", (F.size("header") - place(c)).cast("int")))
    return rows.select(
        *(F.nullif(F.trim(cell(c), F.lit(_SPACE)), F.lit("")).alias(c) for c in columns),
        "source_path", F.regexp_extract("source_path", r"([^/]+)$", 1).alias("source_file"), F.col("record").alias("source_row_no"),
        F.when(F.col("cells").isNotNull(), F.size("cells")).alias("n_fields"), F.size("header").alias("n_expected"),
    )


def parsed_files(raw: DataFrame, entity: str, name: str = "source_file") -> DataFrame:
    """Of each file (by ``name``): rows_parsed, bad_cells with their first messages, and bad_rows, of another width than its header."""
    other = ~F.coalesce(F.col("n_fields") == F.col("n_expected"), F.lit(False))
    counts = raw.groupBy(F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("rows_parsed"), F.count_if(other).alias("bad_rows"))
    return counts.join(cast_errors(raw.withColumn("source_file", F.col(name)), entity).withColumnRenamed("source_file", "name"), "name", "left")


def typed(cell: Column, kind: T.DataType) -> Column:
    """A trimmed text as its declared type; what doesn't read as that type is null. Dates must be yyyy-mm-dd."""
    if isinstance(kind, T.StringType):
        return cell
    if isinstance(kind, T.DateType):
        return F.when(cell.rlike(r"^\d{4}-\d{2}-\d{2}$"), cell.try_cast(kind))
    if isinstance(kind, T.LongType):
        return F.when(cell.rlike(r"^[+-]?\d+$"), cell.try_cast(kind))
    return cell.try_cast(kind)


def cast_drop(raw: DataFrame, entity: str) -> DataFrame:
    """The declared columns, typed; other columns are dropped, provenance columns stay."""
    schema = entity_schema(entity)
    return raw.select(*(typed(F.col(f.name), f.dataType).alias(f.name) for f in schema), *(c for c in ("source_file", "source_row_no") if c in raw.columns))


def read_drop(spark: SparkSession, folder: str, entity: str, delimiter: str = ",", encoding: str = "utf-8") -> DataFrame:
    """Typed rows of an entity's file in a drop folder."""
    return cast_drop(read_raw(spark, f"{folder}/{entity}.csv", delimiter, encoding, [f.name for f in entity_schema(entity)]), entity)


def header_drift(expected: Column, actual: Column, allow_additive: bool = False) -> tuple[Column, Column, Column]:
    """Missing columns, extra columns, and whether that is drift; extra ones may be tolerated (and are dropped)."""
    missing, extra = F.array_except(expected, actual), F.array_except(actual, expected)
    drift = (F.size(missing) > 0) | (F.lit(not allow_additive) & (F.size(extra) > 0))
    return missing, extra, drift


def cast_errors(raw: DataFrame, entity: str, examples: int = 5) -> DataFrame:
    """Per file: how many cells don't read as their type, and the first messages 'row N: column ...'."""
    schema = entity_schema(entity)
    checks = [f for f in schema if not isinstance(f.dataType, T.StringType)]
    bad = F.array(*(F.when(F.col(f.name).isNotNull() & typed(F.col(f.name), f.dataType).isNull(), F.concat(F.lit("row "), F.col("source_row_no"), F.lit(f": {f.name} is no {f.dataType.simpleString()}"))) for f in checks))
    cells = raw.select("source_file", "source_row_no", F.posexplode(bad).alias("column_no", "message")).where("message IS NOT NULL")
    # counted apart from the messages, so that both shrink before they are shuffled: by partial counts, and by a limit
    counts = cells.groupBy("source_file").agg(F.count(F.lit(1)).alias("bad_cells"))
    first = cells.withColumn("n", F.row_number().over(Window.partitionBy("source_file").orderBy("source_row_no", "column_no"))).where(F.col("n") <= examples)
    messages = first.groupBy("source_file").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "message"))), lambda x: x["message"]).alias("messages"))
    return counts.join(messages, "source_file")


def gate(manifest: DataFrame, files: DataFrame, parsed: DataFrame, drift: DataFrame) -> DataFrame:
    """The verdict on each declared file; the first failing gate names the reason, null means it may be promoted.

    files: name, bytes, file_hash and, if known, blank; parsed: name, rows_parsed, bad_cells, messages and, if known,
    bad_rows: rows of another width fail as cells do that don't read as their type. drift: name, drift.
    """
    blank = (F.col("blank") if "blank" in files.columns else F.lit(False)) | (F.col("bytes") == 0)
    ragged = F.coalesce("bad_rows", F.lit(0)) if "bad_rows" in parsed.columns else F.lit(0)
    joined = manifest.join(files.select("name", "bytes", "file_hash", blank.alias("is_blank")), "name", "left").join(parsed, "name", "left").join(drift.select("name", "drift"), "name", "left")
    reason = (
        F.when(F.col("file_hash").isNull(), REASONS[0]).when(F.col("is_blank"), REASONS[1]).when(F.col("file_hash") != F.col("sha256"), REASONS[2])
        .when(F.coalesce("drift", F.lit(False)), REASONS[3]).when((F.coalesce("bad_cells", F.lit(0)) > 0) | (ragged > 0), REASONS[4]).when(F.coalesce("rows_parsed", F.lit(0)) != F.col("rows"), REASONS[5])
    )
    widths = F.when(ragged > 0, F.concat(ragged, F.lit(" row(s) of another width")))
    detail = F.when(F.col("reason_code") == REASONS[4], F.concat_ws("; ", "messages", widths))
    return joined.withColumn("reason_code", reason).withColumn("detail", detail).drop("is_blank")


def quarantine(files: DataFrame, verdicts: DataFrame, path: str) -> None:
    """Keeps the bytes of refused files with their reason, by batch: rows of parts (path, part, content), none of them large."""
    refused = files.select("path", "name").join(verdicts.where("reason_code IS NOT NULL").select("name", "batch_id", "reason_code", "detail"), "name")
    kept = refused.join(streams.contents(refused.distinct()), "path")
    kept.write.mode("append").partitionBy("batch_id").parquet(path)


def new_files(files: DataFrame, audit: DataFrame) -> DataFrame:
    """Files whose content wasn't promoted before for their source; refused content may be delivered again."""
    done = audit.where("status = 'PROMOTED'").select("source_id", "file_hash").distinct()
    return files.join(done, ["source_id", "file_hash"], "left_anti")


def receipts(verdicts: DataFrame, audit: DataFrame, processed_at: Column) -> DataFrame:
    """An audit row for each file: PROMOTED, QUARANTINED, or SKIPPED_DUPLICATE if its content was promoted before."""
    done = audit.where("status = 'PROMOTED'").select("source_id", "file_hash", F.lit(True).alias("seen")).distinct()
    status = F.when(F.col("seen"), "SKIPPED_DUPLICATE").when(F.col("reason_code").isNull(), "PROMOTED").otherwise("QUARANTINED")
    return verdicts.join(done, ["source_id", "file_hash"], "left").select(
        "source_id", "batch_id", F.col("name").alias("file_name"), "file_hash", F.col("rows").alias("rows_declared"), "rows_parsed", status.alias("status"), "reason_code", processed_at.alias("processed_at")
    )


def first_receipt(audit: DataFrame) -> DataFrame:
    """Insert-if-absent: of several receipts for a file of a batch, the first holds."""
    w = Window.partitionBy("source_id", "batch_id", "file_name", "file_hash").orderBy("processed_at", "status")
    return audit.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def batch_order(manifests: DataFrame) -> DataFrame:
    """Each batch against those that arrived before it: REGENERATED_BATCH, STALE_MANIFEST, or null if in order.

    manifests: source_id, batch_id, generated_at (ISO text), content_hash, arrival. Generations are compared as
    instants, not as text.
    """
    instant = F.try_to_timestamp("generated_at")
    before = Window.partitionBy("source_id").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("source_id", "batch_id").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    known, newest = F.last("content_hash").over(same), F.max(instant).over(before)
    verdict = F.when(known.isNotNull() & (known != F.col("content_hash")), "REGENERATED_BATCH").when(known.isNull() & (instant <= newest), "STALE_MANIFEST")
    return manifests.withColumn("verdict", verdict)


def split_code_name(df: DataFrame, column: str) -> DataFrame:
    """``code:name`` in ``column`` as <column>_code and <column>_name; without a separator, only a code."""
    parts = F.split(F.col(column), ":", 2)
    return df.withColumns({f"{column}_code": F.trim(F.get(parts, 0)), f"{column}_name": F.trim(F.get(parts, 1))})


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def split_malformed(df: DataFrame, keys: list[str], width: Column | None = None, expected: Column | int | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, malformed): malformed rows lack a key, or have another number of fields than expected (or none)."""
    bad = F.lit(False)
    for k in keys:
        bad = bad | F.col(k).isNull()
    if width is not None:
        bad = bad | F.coalesce(width != expected, F.lit(True))
    return df.where(~bad), df.where(bad)
