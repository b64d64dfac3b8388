"""Queries of file drops, sinks and the landing stream: files that Spark writes from the tables, landed again."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import scratch_path, written
from ..operators import quality
from ..sources import databases, drops, extracts, inventory
from ..sources.schemas import entity_schema
from ..sources.versions import Versions
from ..streaming.gate import DELIVERY, judge_available
from ..streaming.landing import land_available
from .registry import query

_VENDORS = "SELECT vendor_no, vendor_name, terms, lead_time_days FROM vendors"


def _vendor_drop(w, delimiter: str = ",") -> str:
    """A drop folder with the vendors as a delimited file (several parts)."""
    folder = scratch_path(w.spark, "drop")
    columns = [f.name for f in entity_schema("vendors")]
    padded = w.vendors.select(F.concat(F.lit("  "), "vendor_no").alias("vendor_no"), *columns[1:])
    padded.write.csv(f"{folder}/vendors.csv", header=True, sep=delimiter, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return folder


def _torn_drop(w, delimiter: str) -> str:
    """A drop of the parts as spreadsheets write them: cells with line breaks, delimiters and doubled quotes, rows that
    lack their last cell or have one too many, and blank lines; in files of 500 rows, each with its header."""
    k = F.col("p_partkey")
    mark = F.lit('"')
    quoted = lambda c: F.concat(mark, F.replace(c, mark, F.lit('""')), mark)
    name = F.concat("p_name", F.when(k % 7 == 0, F.lit('\nsecond "line"')).when(k % 7 == 1, F.lit(f"{delimiter} with é")).otherwise(F.lit("")))
    line = F.concat(
        k.cast("string"), F.lit(delimiter), quoted(name), F.lit(delimiter), F.when(k % 5 == 0, quoted(F.concat("p_brand", F.lit('\r\n""')))).otherwise(F.col("p_brand")),
        F.when(k % 11 == 3, F.lit("")).when(k % 11 == 4, F.lit(f"{delimiter}EA{delimiter}more")).otherwise(F.lit(f"{delimiter}EA")), F.when(k % 13 == 0, F.lit("\n\r\n")).otherwise(F.lit("")),
    )
    head = delimiter.join(["part", "name", '"the\nbrand"', "uom"])
    rows = w.table("part").groupBy(F.expr("p_partkey div 500").alias("file")).agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("line")))), lambda x: x["line"]).alias("lines"))
    path = scratch_path(w.spark, "torn")
    rows.select("file", F.concat(F.lit(head + "\n"), F.array_join("lines", "\n")).alias("value")).write.partitionBy("file").text(path)
    return path


_TORN_NAME = """p_name || CASE p_partkey % 7 WHEN 0 THEN chr(10) || 'second "line"' WHEN 1 THEN '{} with é' ELSE '' END"""
_TORN = """SELECT p_partkey AS part, {name} AS name, p_brand || CASE WHEN p_partkey % 5 = 0 THEN chr(13) || chr(10) || '""' ELSE '' END AS brand, CASE WHEN p_partkey % 11 <> 3 THEN 'EA' END AS uom,
cast(CASE p_partkey % 11 WHEN 3 THEN 3 WHEN 4 THEN 5 ELSE 4 END AS int) AS n_fields, cast(row_number() OVER (PARTITION BY p_partkey // 500 ORDER BY p_partkey) AS bigint) AS source_row_no FROM part"""


def _torn_rows(w, delimiter: str):
    raw = drops.read_raw(w.spark, f"{_torn_drop(w, delimiter)}/*", delimiter, columns=["part", "name", "the\nbrand", "uom"])
    return raw.withColumn("part", F.col("part").cast("bigint")).withColumnRenamed("the\nbrand", "brand")


query("i1_quoted_csv", _TORN.format(name=_TORN_NAME.format(",")))(lambda w: _torn_rows(w, ",").select("part", "name", "brand", "uom", "n_fields", "source_row_no"))
query("i2_quoted_pipe", _TORN.format(name=_TORN_NAME.format("|")))(lambda w: _torn_rows(w, "|").select("part", "name", "brand", "uom", "n_fields", "source_row_no"))


@query("i10_ragged_rows", "SELECT p_partkey AS part, p_partkey % 11 IN (3, 4) OR p_partkey % 17 = 0 AS malformed FROM part")
def _(w):
    """Rows of another width than their header, or without their key, are diverted; the others stay."""
    rows = _torn_rows(w, ",").withColumn("key", F.when(F.col("part") % 17 != 0, F.col("part")))
    good, malformed = drops.split_malformed(rows, ["key"], F.col("n_fields"), F.col("n_expected"))
    return good.select("part", F.lit(False).alias("malformed")).unionByName(malformed.select("part", F.lit(True).alias("malformed")))


query("i1_typed_csv", _VENDORS)(lambda w: drops.read_drop(w.spark, _vendor_drop(w), "vendors").drop("source_file", "source_row_no"))
query("i2_pipe_drop", _VENDORS)(lambda w: drops.read_drop(w.spark, _vendor_drop(w, "|"), "vendors", "|").drop("source_file", "source_row_no"))
query("i8_row_count", "SELECT 'vendors' AS entity, count(*) AS rows_parsed, count(DISTINCT vendor_no) AS keys FROM vendors")(
    lambda w: drops.read_drop(w.spark, _vendor_drop(w), "vendors").agg(F.count(F.lit(1)).alias("rows_parsed"), F.count_distinct("vendor_no").alias("keys")).select(F.lit("vendors").alias("entity"), "rows_parsed", "keys")
)


@query("i3_manifest", "SELECT 'b' || user_id % 9 AS batch_id, event_type AS name, sha256(event_type) AS sha256, count(*) AS rows, CASE WHEN user_id % 9 = 4 THEN 'MISSING_KEY' END AS problem FROM events GROUP BY user_id % 9, event_type")
def _(w):
    """A manifest for each group of users, one file for each event type; one group lacks its company."""
    files = w.table("events").groupBy(F.expr("user_id % 9").alias("k"), F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    whole = files.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("name", F.sha2("name", 256).alias("sha256"), "rows"))).alias("files"))
    path = scratch_path(w.spark, "manifests")
    manifest = whole.select(F.concat(F.lit("b"), "k").alias("batch_id"), F.lit("2024-01-01T00:00:00Z").alias("generated_at"), F.when(F.col("k") != 4, F.lit("one")).alias("source_company"), "files")
    manifest.repartition("batch_id").write.partitionBy().option("maxRecordsPerFile", 1).json(path)
    return drops.read_manifest(w.spark, path).select("batch_id", "name", "sha256", "rows", "problem")


def _event_files(w) -> str:
    """The events' properties as text files of at most 1,000 lines, in the order of the ids; each begins with its name."""
    path = scratch_path(w.spark, "event-files")
    name = F.concat_ws("-", "event_type", F.expr("event_id div 1000"))
    lines = w.table("events").groupBy(name.alias("file")).agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "props"))), lambda x: x["props"]).alias("p"))
    lines.select("file", F.concat_ws("\n", F.lit("").alias("x"), "p").alias("value")).select("file", F.concat("file", "value").alias("value")).write.partitionBy("file").text(path)
    return path


_CONTENT = "event_type || '-' || (event_id // 1000) || chr(10) || string_agg(props, chr(10) ORDER BY event_id) || chr(10)"
_GROUPS = "GROUP BY event_type, event_id // 1000"
query("i4_fingerprint", f"SELECT sha256({_CONTENT}) AS file_hash, cast(strlen({_CONTENT}) AS bigint) AS bytes FROM events {_GROUPS}")(
    lambda w: drops.fingerprint(w.spark, _event_files(w), "*.txt").select("file_hash", "bytes")
)


@query("i9_quarantine", f"SELECT 'CHECKSUM_MISMATCH' AS reason_code, sha256({_CONTENT}) AS content_hash, cast(strlen({_CONTENT}) AS bigint) AS bytes FROM events {_GROUPS} HAVING event_type <> 'view'")
def _(w):
    """All files but those of views are refused; what is kept of them has the bytes that they had."""
    files = drops.fingerprint(w.spark, _event_files(w), "*.txt").withColumn("name", F.regexp_replace("folder", "^file=", ""))
    refused = files.where("name NOT LIKE 'view-%'").select("name", F.lit("b1").alias("batch_id"), F.lit("CHECKSUM_MISMATCH").alias("reason_code"), F.lit(None).cast("string").alias("detail"))
    path = scratch_path(w.spark, "quarantine")
    drops.quarantine(files, refused, path)
    kept = w.spark.read.parquet(path).groupBy("reason_code", "path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "content"))), lambda x: x["content"].cast("string")), "").alias("whole"))
    return kept.select("reason_code", F.sha2("whole", 256).alias("content_hash"), F.octet_length("whole").cast("long").alias("bytes"))


_GATED = """SELECT 'f-' || (event_id // 500) AS name, CASE event_id // 500 % 6 WHEN 1 THEN 'MISSING_FILE' WHEN 2 THEN 'CHECKSUM_MISMATCH' WHEN 3 THEN 'HEADER_SCHEMA_DRIFT' WHEN 4 THEN 'PARSE_ERROR' WHEN 5 THEN 'ROW_COUNT_MISMATCH' END AS reason_code,
CASE WHEN event_id // 500 % 6 = 4 THEN 'row 1: lead_time_days is no bigint' END AS detail FROM events GROUP BY 1, 2, 3 UNION ALL SELECT 'f-none', 'EMPTY_FILE', NULL"""


@query("i5_gate", _GATED)
def _(w):
    """Files of 500 events each, read again and held against what is declared of them.

    Of six in turn one is right, one isn't there, one has other bytes, one another header, one a word for a number and
    one a row less than declared; those of the last four declare one row too many, so that the first gate that fails decides.
    """
    columns, k, fault = [f.name for f in entity_schema("vendors")], F.expr("event_id div 500"), F.col("k") % 6
    lines = w.table("events").select(k.alias("k"), "event_id", F.concat_ws(",", "event_id", "event_type", F.lit("NET30"), "user_id").alias("line"), F.concat_ws(",", "event_id", "event_type", F.lit("NET30"), F.lit("soon")).alias("odd"))
    groups = lines.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "line", "odd"))), lambda x, i: F.when((fault == 4) & (i == 0), x["odd"]).otherwise(x["line"])).alias("lines"))
    header = F.when(fault == 3, ",".join(columns).replace("terms", "term")).otherwise(",".join(columns))
    drop = written(groups.select(F.concat(F.lit("f-"), "k").alias("name"), fault.alias("fault"), F.size("lines").alias("n"), F.concat_ws("\n", header, "lines").alias("value")), "gated")
    path = scratch_path(w.spark, "gated-files")
    drop.where("fault <> 1").select(F.col("name").alias("file"), "value").write.partitionBy("file").text(path)
    drop.limit(0).select("value").write.text(f"{path}/file=f-none")
    right = F.sha2(F.concat("value", F.lit("\n")), 256)
    manifest = drop.select("name", F.when(F.col("fault") == 2, F.sha2("name", 256)).otherwise(right).alias("sha256"), (F.col("n") + F.when(F.col("fault") >= 2, 1).otherwise(0)).alias("rows"))
    manifest = manifest.unionByName(w.spark.sql("SELECT 'f-none' AS name, sha2('', 256) AS sha256, 0 AS rows"))
    name_of = lambda c: F.regexp_extract(c, "/file=([^/]+)/[^/]+$", 1)
    files = drops.fingerprint(w.spark, path, "*.txt").withColumn("name", name_of("path"))
    records = drops.read_records(w.spark, f"{path}/*")
    raw = drops.raw_cells(records, columns).withColumn("file", name_of("source_path"))
    parsed = drops.parsed_files(raw, "vendors", "file")
    drift = drops.headers(records).select(name_of("source_path").alias("name"), drops.header_drift(F.array(*map(F.lit, columns)), F.col("header"))[2].alias("drift"))
    return drops.gate(manifest, files, parsed, drift).select("name", "reason_code", "detail")


@query("i12_receipts", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'SKIPPED_DUPLICATE' WHEN event_id % 3 = 0 THEN 'QUARANTINED' ELSE 'PROMOTED' END AS status FROM events")
def _(w):
    files = w.table("events").select(F.col("event_type").alias("source_id"), F.lit("b").alias("batch_id"), F.col("event_id").cast("string").alias("name"), F.sha2(F.col("event_id").cast("string"), 256).alias("file_hash"), F.lit(1).alias("rows"), F.lit(1).alias("rows_parsed"), F.when(F.col("event_id") % 3 == 0, "PARSE_ERROR").alias("reason_code"))
    audit = files.where("cast(name as bigint) % 4 = 0").select("source_id", "file_hash", F.lit("PROMOTED").alias("status"))
    return drops.receipts(files, audit, F.lit("2024-01-01")).select(F.col("file_name").cast("bigint").alias("event_id"), "status")


_STAMP = "date '2024-01-01' + cast(lead_time_days AS int)"


@query("i16_jdbc_scan", f"SELECT vendor_no, vendor_name, terms, lead_time_days, {_STAMP} AS watermark FROM vendors WHERE {_STAMP} > date '2024-01-15'")
def _(w):
    """The vendors in a database, read in parts behind a watermark.

    The database is the one that Spark embeds, in the memory of the driver: for a local master only, where tasks share it.
    """
    if w.spark.sparkContext.master.split("[")[0] != "local":  # local-cluster has executors of its own
        raise ValueError("the embedded database is reached by the tasks of a local master only")
    w.spark._jvm.System.setProperty("derby.stream.error.file", "/dev/null")
    source = databases.source_table("informix", "vendors")
    options = {"url": f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    stamped = w.vendors.withColumn(source.watermark, F.date_add(F.lit("2024-01-01").cast("date"), F.col("lead_time_days").cast("int")))
    stamped.write.format("jdbc").options(**options, dbtable=source.table).save()
    parts = {"partitionColumn": "lead_time_days", "lowerBound": "0", "upperBound": "60", "numPartitions": "4"}
    return databases.scan_entity(w.spark, options | parts, source, "vendors", "2024-01-15")


@query("i36_replace", "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0")
def _(w):
    """A full landing replaces what was there."""
    path = scratch_path(w.spark, "lake")
    rows = w.table("supplier").select("s_suppkey", "s_name")
    extracts.land_full(rows, f"{path}/one/vendors")
    extracts.land_full(rows.where("s_suppkey % 2 = 0"), f"{path}/one/vendors")
    return extracts.staged(w.spark, path, "one", "vendors", rows.schema)


@query("i39_staged", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0")
def _(w):
    path = scratch_path(w.spark, "lake")
    rows = w.table("supplier").select("s_suppkey", "s_name")
    extracts.land_append(rows, f"{path}/one/vendors")
    extracts.land_append(rows.where("s_suppkey % 2 = 0"), f"{path}/one/vendors")
    return extracts.staged(w.spark, path, "one", "vendors", rows.schema)


@query("i36_failed_replace", "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 <> 0")
def _(w):
    """A landing that breaks off half-way changes nothing: neither what is read, nor what a later one does."""
    path = scratch_path(w.spark, "lake")
    rows = w.table("supplier").select("s_suppkey", "s_name")
    extracts.land_full(rows.where("s_suppkey % 3 <> 0"), f"{path}/one/vendors")
    broken = rows.where(F.when(F.col("s_suppkey") > 3, F.raise_error(F.lit("the source went away")).cast("boolean")).otherwise(True))
    try:
        extracts.land_full(broken, f"{path}/one/vendors")
    except PySparkException as e:
        if "the source went away" not in str(e):
            raise
    return extracts.staged(w.spark, path, "one", "vendors", rows.schema)


@query("i38_stored_merge", "SELECT l_orderkey, l_linenumber, max(l_partkey) FILTER (WHERE l_partkey % 3 = r) AS l_partkey FROM (SELECT *, max(l_partkey % 3) OVER (PARTITION BY l_orderkey, l_linenumber) AS r FROM lineitem) GROUP BY 1, 2")
def _(w):
    """Three merges, the last one decides for its keys; then they are folded into one."""
    path = scratch_path(w.spark, "lake")
    rows = w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    for k in range(3):
        extracts.land_merge(rows.where(f"l_partkey % 3 = {k}"), f"{path}/one/lines")
    versions = Versions(w.spark, f"{path}/one/lines", rows.schema)
    versions.compact(["l_orderkey", "l_linenumber"], ["l_partkey"])
    versions.expire(1)
    return versions.read()


@query("i41_stored_state", "SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY 1, 2")
def _(w):
    """A control table as versions: each run lands the states that it saw, and the latest one of a key holds."""
    path = scratch_path(w.spark, "control")
    rows = w.table("events").select("user_id", "event_type", "event_id")
    half = rows.agg(F.percentile_approx("event_id", 0.5)).first()[0] or 0
    extracts.land_merge(rows.where(F.col("event_id") <= half), f"{path}/all/state")
    extracts.land_merge(rows.where(F.col("event_id") > half), f"{path}/all/state")
    return extracts.staged(w.spark, path, "all", "state", rows.schema, ["user_id", "event_type"], ["event_id"])


@query(
    "r3_kept_inventory",
    """SELECT 1 AS delivery, 'C-' || c_custkey AS source_key, 'CAME' AS change FROM customer UNION ALL SELECT 2, 'C-' || c_custkey, 'WENT' FROM customer WHERE c_custkey % 17 = 0
    UNION ALL SELECT 4, 'C-' || c_custkey, CASE WHEN c_custkey % 17 = 0 THEN 'CAME' ELSE 'WENT' END FROM customer WHERE (c_custkey % 17 = 0) <> (c_custkey % 5 = 0)""",
)
def _(w):
    """Four deliveries against a kept inventory; the third is empty and takes nothing away. Each only writes its changes."""
    keys = w.table("customer").select("c_custkey", F.concat(F.lit("C-"), "c_custkey").alias("source_key"))
    kept = inventory.KeyInventory(w.spark, scratch_path(w.spark, "inventory"), int(w.spark.conf.get("spark.sql.shuffle.partitions")), 2)
    parts = []
    for n, rows in enumerate((keys, keys.where("c_custkey % 17 <> 0"), keys.limit(0), keys.where("c_custkey % 5 <> 0")), 1):
        parts.append(written(kept.take(rows).select(F.lit(n).alias("delivery"), "source_key", "change"), "changes"))
    kept.close()
    return reduce(DataFrame.unionByName, parts)


@query("i27_strict_lines", "SELECT l_orderkey AS order_no, l_linenumber AS line_no, l_partkey AS item FROM lineitem")
def _(w):
    """Documents that all have their lines: nothing fails, and every line comes with its header."""
    nested = w.table("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey")).alias("lines"))
    flat = extracts.flatten_lines(nested, "lines", {"order_no": "l_orderkey"}, {"line_no": "l_linenumber", "item": "l_partkey"}, "line_no", strict=True)
    return extracts.with_header(w.table("orders").select(F.col("o_orderkey").alias("order_no")), flat, "order_no")


@query("s1_landing_stream", "SELECT event_id, event_type, cast(event_id AS varchar) AS source_id FROM events")
def _(w):
    """Two deliveries and three runs: each file is landed once."""
    path = scratch_path(w.spark, "stream")
    rows = w.table("events").select("event_id", "event_type")
    run = lambda: land_available(w.spark, f"{path}/in/*", rows.schema, f"{path}/lake", f"{path}/audit", f"{path}/checkpoint", ["event_id"], "one")
    rows.where("event_id % 2 = 0").write.parquet(f"{path}/in/one")
    run()
    rows.where("event_id % 2 = 1").write.parquet(f"{path}/in/two")
    run()
    run()
    return w.spark.read.parquet(f"{path}/lake").select("event_id", "event_type", "source_id")


# delivery by delivery: a source's newest generation and the content of its batches, as far as promoted
_GATE = """WITH RECURSIVE d AS (SELECT user_id AS s, event_type AS b, CASE WHEN event_id % 13 <> 0 THEN date_trunc('second', ts) END AS g, 'h' || (event_id % 3) AS h, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
    judged AS (SELECT d.*, CASE WHEN g IS NULL THEN 'UNREADABLE_GENERATION' ELSE 'PROMOTED' END AS verdict, g AS newest, CASE WHEN g IS NULL THEN [] ELSE [b || '|' || h] END AS known FROM d WHERE n = 1
    UNION ALL SELECT s, b, g, h, event_id, n, verdict, CASE WHEN verdict = 'PROMOTED' THEN g ELSE newest END, CASE WHEN verdict = 'PROMOTED' THEN list_append(known, b || '|' || h) ELSE known END FROM (
      SELECT d.*, j.newest, j.known, CASE WHEN list_contains(j.known, d.b || '|' || d.h) THEN 'SKIPPED_DUPLICATE' WHEN list_bool_or(list_transform(j.known, lambda x: starts_with(x, d.b || '|'))) THEN 'REGENERATED_BATCH'
        WHEN d.g IS NULL THEN 'UNREADABLE_GENERATION' WHEN d.g <= j.newest THEN 'STALE_MANIFEST' ELSE 'PROMOTED' END AS verdict FROM judged j JOIN d ON d.s = j.s AND d.n = j.n + 1))
    SELECT event_id AS arrival, verdict FROM judged"""


@query("i13_gate_stream", _GATE)
def _(w):
    """Deliveries of every user in two parts, judged by two runs of a stream: the second one goes on from the first one's state."""
    path = scratch_path(w.spark, "gate")
    generated = F.when(F.col("event_id") % 13 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("soon")
    rows = w.table("events").select(
        F.col("user_id").cast("string").alias("source_id"), F.col("event_type").alias("batch_id"), generated.alias("generated_at"), F.concat(F.lit("h"), F.col("event_id") % 3).alias("content_hash"), F.col("event_id").cast("long").alias("arrival")
    )
    half = rows.agg(F.percentile_approx("arrival", 0.5)).first()[0] or 0
    for n, part in enumerate((rows.where(F.col("arrival") <= half), rows.where(F.col("arrival") > half))):
        part.write.parquet(f"{path}/in/{n}")
        judge_available(w.spark, f"{path}/in/*", f"{path}/out", f"{path}/checkpoint")
    return w.spark.read.schema(f"{DELIVERY}, verdict string").parquet(f"{path}/out").select("arrival", "verdict")


@query("q12_manifest_check", f"SELECT event_type || '-' || (event_id // 1000) AS name FROM events {_GROUPS} HAVING event_type = 'view' OR count(*) % 2 = 1")
def _(w):
    """Files with their own hashes: other bytes are declared of those of views, and another row of those of odd length."""
    files = drops.fingerprint(w.spark, _event_files(w), "*.txt").withColumn("name", F.regexp_replace("folder", "^file=", ""))
    counts = files.select("name", (F.col("lines") - 1).alias("rows_parsed"))  # but for the name
    events = w.table("events").groupBy(F.concat_ws("-", "event_type", F.expr("event_id div 1000")).alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    sums = files.select("name", F.when(F.col("name").startswith("view-"), F.sha2("name", 256)).otherwise(F.col("file_hash")).alias("sha256"))
    declared = events.select("name", (F.col("rows") + F.col("rows") % 2).alias("rows")).join(sums, "name", "left")
    return quality.manifest_check(declared, files, counts).select("name")


@query("q13_stored_results", "SELECT 'not_null:events.user_id' AS check_name, 'pass' AS status, cast(count(*) FILTER (WHERE user_id IS NULL) AS bigint) AS failing_rows FROM events")
def _(w):
    path = scratch_path(w.spark, "results")
    quality.store(quality.not_null(w.table("events"), ["user_id"], "events"), path, F.expr("timestamp '2024-01-01 00:00:00'"))
    return w.spark.read.parquet(path).select("check_name", "status", "failing_rows")


@query("q16_provenance", "SELECT s_suppkey, 'erp' AS source_system, cast(s_suppkey AS varchar) AS source_id, 1 AS n FROM supplier")
def _(w):
    """Stamped rows and how often each natural id stands: more than once would be a key that isn't one."""
    stamped = extracts.stamp(w.table("supplier").select("s_suppkey"), "erp", ["s_suppkey"], F.expr("timestamp '2024-01-01 00:00:00'"))
    ids = stamped.groupBy("source_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return stamped.join(ids, "source_id").select("s_suppkey", "source_system", "source_id", "n")
