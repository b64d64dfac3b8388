"""File drops, extracts, sinks and the landing stream on small inline cases."""

import csv
import datetime
import hashlib
import io
import json
import random
import resource
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyard.functions import intervals
from tallyard.functions.canonical import canonical_json
from tallyard.operators import bi, claims, governance, marts, metrics, model, nearest, quality, reconcile
from tallyard.sources import databases, delimited, drops, extracts, inventory, versions
from tallyard.sources import files as streams
from tallyard.sources.schemas import COLUMNS, NATURAL_KEYS, entity_schema
from tallyard.streaming.gate import DELIVERY, Gate, judge_available
from tallyard.streaming.landing import land_available

VENDORS = "vendor_no,vendor_name,terms,lead_time_days\nV1, Ann ,NET30,7\nV2,Bob,,12\n"


def write_drop(folder, files, declared=None, **head):
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_text(text)
    declared = declared or {}
    entries = []
    for name, text in files.items():
        entry = {"name": name, "sha256": hashlib.sha256(text.encode()).hexdigest(), "rows": text.count("\n") - 1, "delimiter": ","} | declared.get(name, {})
        entries.append(entry)
    entries += [e for n, e in declared.items() if n not in files]
    manifest = {"batch_id": "b1", "generated_at": "2024-01-01T00:00:00Z", "source_company": "one", "schema_version": "1", "files": entries} | head
    (folder / "manifest.json").write_text(json.dumps(manifest))


def verdict(spark, folder):
    manifest = drops.read_manifest(spark, f"{folder}/manifest.json")
    files = drops.fingerprint(spark, str(folder), "*.csv")
    raw = drops.read_raw(spark, f"{folder}/vendors.csv", columns=[f.name for f in entity_schema("vendors")])
    expected = F.array(*(F.lit(f.name) for f in entity_schema("vendors")))
    heads = drops.headers(drops.read_records(spark, f"{folder}/vendors.csv"))
    drift = heads.select(F.regexp_extract("source_path", "([^/]+)$", 1).alias("name"), drops.header_drift(expected, F.col("header"))[2].alias("drift"))
    return {r["name"]: r["reason_code"] for r in drops.gate(manifest, files, drops.parsed_files(raw, "vendors"), drift).collect()}


@pytest.mark.parametrize(
    ("text", "declared", "reason"),
    [
        (VENDORS, {}, None),
        ("", {"sha256": hashlib.sha256(b"").hexdigest(), "rows": 0}, "EMPTY_FILE"),
        (VENDORS, {"sha256": "0" * 64}, "CHECKSUM_MISMATCH"),
        (VENDORS.replace("terms", "term"), {}, "HEADER_SCHEMA_DRIFT"),
        (VENDORS.replace("12", "abc"), {}, "PARSE_ERROR"),
        (VENDORS, {"rows": 3}, "ROW_COUNT_MISMATCH"),
        (" \n\t\n", {}, "EMPTY_FILE"),
        (VENDORS + "V3,Cid,NET30\n", {}, "PARSE_ERROR"),
        (VENDORS + "V3,Cid,NET30,7,more\n", {}, "PARSE_ERROR"),
        (VENDORS + 'V3,"Ci\nd, ""the"" one",NET30,7\n', {"rows": 3}, None),
    ],
)
def test_gate(spark, tmp_path, text, declared, reason):
    write_drop(tmp_path / "d", {"vendors.csv": text}, {"vendors.csv": declared})
    assert verdict(spark, tmp_path / "d") == {"vendors.csv": reason}


def test_missing_file_and_manifest_problems(spark, tmp_path):
    entry = {"name": "items.csv", "sha256": "0", "rows": 1}
    write_drop(tmp_path / "d", {"vendors.csv": VENDORS}, {"items.csv": entry})
    assert verdict(spark, tmp_path / "d") == {"vendors.csv": None, "items.csv": "MISSING_FILE"}
    write_drop(tmp_path / "e", {})
    assert drops.read_manifest(spark, f"{tmp_path}/e/manifest.json").first().problem == "NO_FILES"
    write_drop(tmp_path / "f", {}, {"items.csv": entry, "twice": entry})
    assert {r.problem for r in drops.read_manifest(spark, f"{tmp_path}/f/manifest.json").collect()} == {"DUPLICATE_NAME"}


def test_read_drop(spark, tmp_path):
    write_drop(tmp_path / "d", {"vendors.csv": VENDORS.replace(",", "|")})
    rows = drops.read_drop(spark, f"{tmp_path}/d", "vendors", "|").orderBy("source_row_no").collect()
    assert [(r.vendor_no, r.vendor_name, r.terms, r.lead_time_days, r.source_row_no) for r in rows] == [("V1", "Ann", "NET30", 7, 1), ("V2", "Bob", None, 12, 2)]


def test_row_numbers_go_on_over_the_splits_of_a_file(spark, tmp_path):
    """Small splits: every row has its place in its own file, though files lie in several tasks."""
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "vendors.csv").write_text("vendor_no,vendor_name,terms,lead_time_days\n" + "".join(f"{name}{k},x,,{k}\n" for k in range(1, 2001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = drops.read_raw(spark, f"{tmp_path}/*/vendors.csv").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 4000 and all(r.vendor_no[1:] == str(r.source_row_no) == r.lead_time_days for r in rows)


def by_csv_module(text, delimiter=","):
    """The rows of a text as Python's csv module reads them, blank ones left out."""
    return [r for r in csv.reader(io.StringIO(text), delimiter=delimiter) if r]


def in_small_splits(spark, size, *args):
    """The records of files that are read in splits of ``size`` bytes; what is made of the lines isn't split as small."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        return drops.read_records(spark, *args)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_of_any_text_equal_the_csv_module(spark, tmp_path):
    """Random texts of quotes, delimiters and line breaks, each file over many splits."""
    rng = random.Random(3)
    cells = lambda: rng.choice(["a", "", "é ü", 'x"y', '"q"', '"a,b"', '"l1\nl2"', '"l1\r\n\r\nl3,"', '"d""q"', '"""', '""', '" "x', "long " * 9, '"' + "line\n" * 20 + '"'])
    texts = {}
    for k in range(20):
        lines = [",".join(cells() for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 30))]
        texts[f"f{k:02}.csv"] = rng.choice(["\n", "\r\n", "\n\n"]).join(lines) + rng.choice(["", "\n", "\r\n"])
    for k in range(20, 40):
        texts[f"f{k:02}.csv"] = "".join(rng.choice('ab,"\n') for _ in range(rng.randint(0, 300)))
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    got = {}
    for r in in_small_splits(spark, 150, f"{tmp_path}/*.csv").collect():
        got.setdefault(r.source_path.rsplit("/", 1)[1], {})[r.record] = r.cells
    for name, text in texts.items():
        rows = by_csv_module(text)
        mine = got.get(name, {})
        assert sorted(mine) == list(range(len(rows))), name
        for k, want in enumerate(rows):
            # of a quote that is never closed, the line break at the end of the file can't be told from none
            assert mine[k] == want or (k == len(rows) - 1 and [c.rstrip("\n") for c in mine[k]] == [c.rstrip("\n") for c in want]), (name, k)


@pytest.mark.parametrize(("delimiter", "encoding"), [("|", "cp1252"), (";", "utf-8-sig"), ("\t", "latin-1"), ("|", "shift_jis"), (",", "UTF8")])
def test_records_of_other_encodings(spark, tmp_path, delimiter, encoding):
    letters = "表示ソ" if encoding == "shift_jis" else "éü€"[: 3 if encoding != "latin-1" else 2]
    text = "\r\n".join(delimiter.join([f"k{k}", f'"{letters}{delimiter}\n{k}"', letters]) for k in range(30))
    (tmp_path / "f.csv").write_bytes(text.encode(encoding))
    rows = in_small_splits(spark, 100, f"{tmp_path}/f.csv", delimiter, encoding).orderBy("record").collect()
    assert [r.cells for r in rows] == by_csv_module(text, delimiter)


def test_records_that_are_none(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(delimited, "RECORD_BYTES", 200)
    (tmp_path / "f.csv").write_bytes(b'a,b\n1,x\ry\n2,\xff\n3,"' + b"line\n" * 100 + b'"\n4,y\n')
    raw = drops.read_raw(spark, f"{tmp_path}/f.csv")
    assert [(r.a, r.b, r.source_row_no, r.n_fields, r.n_expected) for r in raw.orderBy("source_row_no").collect()] == [(None, None, 1, None, 2), (None, None, 2, None, 2), (None, None, 3, None, 2), ("4", "y", 4, 2, 2)]
    good, bad = drops.split_malformed(raw, ["a"], F.col("n_fields"), F.col("n_expected"))
    assert good.count() == 1 and bad.count() == 3
    for wrong in ("utf-16", "cp037", "no such"):
        with pytest.raises(ValueError):
            drops.read_raw(spark, f"{tmp_path}/f.csv", encoding=wrong)


def test_headers_say_where_columns_stand(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufeffx, y \n1,2\n3\n")
    (tmp_path / "b.csv").write_text('y,z,"x"\n5,6,7\n,,\n')
    (tmp_path / "c.csv").write_text("x,y,y\n1,2,3\n")
    (tmp_path / "d.csv").write_text("")
    raw = drops.read_raw(spark, f"{tmp_path}/*.csv")
    assert set(raw.columns[:3]) == {"x", "y", "z"}
    got = {(r.source_file, r.source_row_no, r.x, r.y, r.z, r.n_fields) for r in raw.collect()}
    assert got == {("a.csv", 1, "1", "2", None, 2), ("a.csv", 2, "3", None, None, 1), ("b.csv", 1, "7", "5", "6", 3), ("b.csv", 2, None, None, None, 3), ("c.csv", 1, "1", "3", None, 3)}


def test_files_in_chunks(spark, tmp_path):
    """Digests, sizes and lines of files that are read chunk by chunk; hidden files aren't listed; parts make up the file."""
    data = {"a.csv": b"", "b.csv": b"x\n" * 1700, "sub/c.csv": bytes(range(256)) * 40, "sub/deep/d.csv": b" \n", "sub/e.txt": b"no"}
    for name, content in data.items():
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_bytes(content)
    (tmp_path / "_hidden.csv").write_bytes(b"1")
    (tmp_path / "sub/.crc.csv").write_bytes(b"1")
    listed = streams.list_files(spark, f"file://{tmp_path}", "*.csv")
    got = {r.name: r for r in listed.drop("bytes").join(streams.digests(listed, 1000), "path").collect()}
    assert set(got) == {"a.csv", "b.csv", "c.csv", "d.csv"} and got["d.csv"].folder == "deep"
    for name, content in data.items():
        if name.endswith("csv"):
            r = got[name.rsplit("/", 1)[-1]]
            assert (r.file_hash, r.bytes, r.lines, r.blank) == (hashlib.sha256(content).hexdigest(), len(content), content.count(b"\n"), not content.strip())
    parts = streams.contents(streams.list_files(spark, str(tmp_path), "*"), 1000).collect()
    for name, content in data.items():
        mine = sorted((r.part, bytes(r.content)) for r in parts if r.path.endswith("/" + name))
        assert b"".join(c for _, c in mine) == content and all(len(c) <= 1000 for _, c in mine)


def test_a_large_file_is_hashed_in_bounded_memory(spark, tmp_path):
    """A sparse file of 3 GB, beyond what a row can hold, by a task that may not hold more than a few chunks."""
    with open(tmp_path / "big.bin", "wb") as f:
        f.truncate(3 << 30)
    before = resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss
    (r,) = drops.fingerprint(spark, str(tmp_path), "*.bin").collect()
    want = hashlib.sha256()
    for _ in range(3 << 10):
        want.update(bytes(1 << 20))
    assert r.bytes == 3 << 30 and r.file_hash == want.hexdigest() and r.lines == 0
    assert resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss < max(before, 1 << 20)  # KB


def test_messages_and_quarantine(spark, tmp_path):
    write_drop(tmp_path / "d", {"vendors.csv": "vendor_no,vendor_name,terms,lead_time_days\n" + "V,x,y,z\n" * 7})
    raw = drops.read_raw(spark, f"{tmp_path}/d/vendors.csv")
    r = drops.cast_errors(raw, "vendors").first()
    assert r.bad_cells == 7 and len(r.messages) == 5 and r.messages[0].startswith("row 1: lead_time_days")
    files = drops.fingerprint(spark, f"{tmp_path}/d", "*.csv")
    drops.quarantine(files, files.select("name", F.lit("b1").alias("batch_id"), F.lit("PARSE_ERROR").alias("reason_code"), F.lit(None).cast("string").alias("detail")), f"{tmp_path}/q")
    assert bytes(spark.read.parquet(f"{tmp_path}/q").first().content).startswith(b"vendor_no")


def test_receipts(spark):
    audit = spark.sql("SELECT 's' AS source_id, 'h1' AS file_hash, 'PROMOTED' AS status UNION ALL SELECT 's', 'h2', 'QUARANTINED'")
    rows = spark.sql("SELECT * FROM VALUES ('s','b','f1','h1',1,1,NULL), ('s','b','f2','h2',1,1,NULL), ('s','b','f3','h3',1,1,'EMPTY_FILE') AS t(source_id,batch_id,name,file_hash,rows,rows_parsed,reason_code)")
    got = {r.file_name: r.status for r in drops.receipts(rows, audit, F.lit("2024")).collect()}
    assert got == {"f1": "SKIPPED_DUPLICATE", "f2": "PROMOTED", "f3": "QUARANTINED"}
    assert {r.file_hash for r in drops.new_files(rows.select("source_id", "file_hash"), audit).collect()} == {"h2", "h3"}


def test_batch_order(spark):
    rows = spark.sql("SELECT * FROM VALUES ('s','b1','2024-01-02T00:00:00Z','x',1), ('s','b2','2024-01-01T00:00:00Z','y',2), ('s','b1','2024-01-03T00:00:00Z','z',3), ('s','b3','2024-01-04T00:00:00Z','w',4) AS t(source_id,batch_id,generated_at,content_hash,arrival)")
    assert [r.verdict for r in drops.batch_order(rows).orderBy("arrival").collect()] == [None, "STALE_MANIFEST", "REGENERATED_BATCH", None]


def test_watermarks(spark):
    t = spark.sql("SELECT * FROM VALUES ('2024-01-01T00:00:00.6Z'), ('2024-01-01T00:00:00.603Z') AS t(x)")
    assert extracts.next_watermark_instant(t, "x").first().watermark == "2024-01-01T00:00:00.603Z"
    docs = spark.sql("SELECT * FROM VALUES ('A','999'), ('A','1000'), ('B','x1'), ('B','x2') AS t(k,d)")
    assert {r.type: r.watermark for r in extracts.next_watermark_by_type(docs, "k", "d").collect()} == {"A": "1000", "B": "x2"}


def test_flatten_and_soft_delete(spark):
    df = spark.sql("SELECT 1 AS id, array(named_struct('n', 1, 'v', 'a'), named_struct('n', NULL, 'v', 'b')) AS ls UNION ALL SELECT 2, NULL")
    assert [tuple(r) for r in extracts.flatten_lines(df, "ls", {"id": "id"}, {"n": "n", "v": "v"}, "n").collect()] == [(1, 1, "a")]
    assert extracts.flatten_lines(df, "ls", {"id": "id"}, {"n": "n", "v": "v"}, "n", keep_empty=True).count() == 3
    flags = spark.sql("SELECT * FROM VALUES ('Y'), ('N'), (NULL) AS t(f)")
    assert extracts.drop_soft_deleted(flags, "f").count() == 2
    assert extracts.drop_soft_deleted(flags, "f", null_safe=False).count() == 1


def test_stamp_refuses(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS source_id")
    with pytest.raises(ValueError, match="provenance"):
        extracts.stamp(df, "erp", ["a"], F.current_timestamp())
    with pytest.raises(ValueError, match="missing"):
        extracts.stamp(df.drop("source_id"), "erp", ["b"], F.current_timestamp())
    assert extracts.stamp(df.drop("source_id"), "erp", ["a"], F.current_timestamp()).first().source_id == "1"


def test_jdbc_options():
    o = extracts.jdbc_options("oracle", "h", "db", "orders", 1521, "erp", "id", (0, 9), 3)
    assert o["dbtable"] == "erp.orders" and o["url"].endswith("h:1521/db") and o["numPartitions"] == "3"
    with pytest.raises(ValueError, match="identifier"):
        extracts.jdbc_options("mysql", "h", "db", "orders; drop")


def test_sinks(spark, tmp_path):
    df = spark.range(3).withColumn("source_id", F.col("id").cast("string"))
    extracts.land_full(df, f"{tmp_path}/lake/s/items")
    extracts.land_append(df, f"{tmp_path}/lake/s/items")
    assert extracts.staged(spark, f"{tmp_path}/lake", "s", "items", df.schema).count() == 6
    extracts.land_full(df, f"{tmp_path}/lake/s/items")
    assert extracts.staged(spark, f"{tmp_path}/lake", "s", "items", df.schema).count() == 3


def test_versions_of_an_entity(spark, tmp_path):
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "k long, v string")
    got = lambda df: sorted(tuple(r) for r in df.collect())
    v = versions.Versions(spark, f"{tmp_path}/e", rows((1, "a")).schema)
    assert v.numbers() == [] and got(v.read()) == []
    assert v.replace(rows((1, "a"), (2, "b"))) == 1 and v.append(rows((2, "b"))) == 2
    assert got(v.read()) == [(1, "a"), (2, "b"), (2, "b")] and got(v.read(1)) == [(1, "a"), (2, "b")]
    assert v.merge(rows((2, "A"), (3, "c"))) == 3
    assert got(v.current(["k"], [])) == [(1, "a"), (2, "A"), (3, "c")]
    assert v.compact(["k"], []) == 4 and got(v.read()) == [(1, "a"), (2, "A"), (3, "c")]
    # a writer that breaks off leaves the rows as they were, and its folder alone
    with pytest.raises(Exception, match="gone"):
        v.replace(rows((9, "x")).where(F.raise_error(F.lit("gone")).cast("boolean")))
    assert v.numbers()[-1] == 4 and got(v.read()) == [(1, "a"), (2, "A"), (3, "c")]
    assert len(v.expire(1)) == 3 and v.numbers() == [4] and got(v.read()) == [(1, "a"), (2, "A"), (3, "c")]


def test_two_writers_lose_nothing(spark, tmp_path):
    """Writers that find their number taken take up what the other one wrote; a rewrite of what was replaced is refused."""
    row = lambda k: spark.createDataFrame([(k, "x")], "k long, v string")
    v = versions.Versions(spark, f"{tmp_path}/e", row(1).schema)
    v.replace(row(0))
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda k: versions.Versions(spark, f"{tmp_path}/e", v.schema).append(row(k)), range(1, 13)))
    assert sorted(numbers) == list(range(2, 14)) and sorted(r.k for r in v.read().collect()) == list(range(13))

    class Slow(versions.Versions):
        def _write(self, df):
            out = super()._write(df)
            v.merge(row(99)) if self.meanwhile == "merge" else v.replace(row(77))
            return out

    slow = Slow(spark, f"{tmp_path}/e", v.schema)
    slow.meanwhile = "merge"
    slow.compact(["k"], [])
    assert sorted(r.k for r in v.current(["k"], []).collect()) == [*range(13), 99]
    slow.meanwhile = "replace"
    with pytest.raises(versions.Conflict):
        slow.compact(["k"], [])
    assert [r.k for r in v.read().collect()] == [77]
    assert not v._put(v.numbers()[-1], {"runs": []})


def test_kept_inventory_is_compared_where_it_lies(spark, tmp_path):
    keys = lambda *ks: spark.createDataFrame([(k,) for k in ks], "source_key string")
    inv = inventory.KeyInventory(spark, f"{tmp_path}/k", 3, 2)
    changes = lambda df: sorted((r.source_key, r.change) for r in df.collect())
    assert changes(inv.take(keys("a", "b", "b", "c", None))) == [("a", "CAME"), ("b", "CAME"), ("c", "CAME")]
    assert changes(inv.take(keys("b", "d"))) == [("a", "WENT"), ("c", "WENT"), ("d", "CAME")]
    other = inventory.KeyInventory(spark, f"{tmp_path}/k", 3, 2)  # opened anew, it goes on
    assert sorted(r[0] for r in other.held().collect()) == ["b", "d"] and changes(other.compare(keys())) == []
    assert changes(other.compare(keys("a", "d"))) == [("a", "CAME"), ("b", "WENT")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = other.compare(keys("a", "d"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the delivery was dealt when it was written; it is joined with base and run in their buckets
    assert "Exchange" not in plan and plan.count("SortMergeJoin") >= 4, plan
    assert changes(other.take(keys("a"))) == [("a", "CAME"), ("b", "WENT"), ("d", "WENT")]
    assert len(other._runs()) == 1 and [r[0] for r in other.held().collect()] == ["a"]
    inv.close(), other.close()


@pytest.mark.parametrize("task_lines", [5, 10**6])
def test_windows_by_bins_equal_the_plain_join(spark, task_lines):
    """Random windows (open-ended, inverted, touching, doubled) and lines, nine of ten on one key, with and without salts."""
    rng = random.Random(task_lines)
    day = lambda k: datetime.date(2020, 1, 1) + datetime.timedelta(k)
    lines = [(k, rng.choice(["hot"] * 9 + ["a", "b", None, "none"]), rng.choice([day(rng.randrange(400)), day(rng.randrange(400)), None])) for k in range(400)]
    windows = [(rng.choice(["hot", "a", "b"]), day(s := rng.randrange(-50, 400)), rng.choice([day(s + rng.randrange(-5, 200)), datetime.date(9999, 12, 31)]), k) for k in range(25)]
    got = intervals.valid_at(spark.createDataFrame(lines, "id long, key string, at date"), spark.createDataFrame(windows, "key string, a date, z date, w long"), "key", "at", "a", "z", 20, task_lines)
    want = []
    for i, k, at in lines:
        held = [w for key, a, z, w in windows if key == k and at and a <= at <= z]
        want += [(i, w) for w in held] or [(i, -1)]
    assert sorted((r.id, -1 if r.w is None else r.w) for r in got.collect()) == sorted(want)
    with pytest.raises(ValueError):
        intervals.valid_at(got, spark.createDataFrame(windows, "key string, a date, z date, w long"), "key", "at", "a", "z")


def test_flattening_fails_closed(spark):
    docs = spark.sql("SELECT 1 AS id, array(named_struct('n', 1, 'x', 'a')) AS l UNION ALL SELECT 2, array()")
    flat = lambda df: extracts.flatten_lines(df, "l", {"doc": "id"}, {"line": "n", "x": "x"}, "line", strict=True)
    assert [tuple(r) for r in flat(docs).collect()] == [(1, 1, "a")]
    for bad, said in (("SELECT 3 AS id, CAST(NULL AS array<struct<n: int, x: string>>) AS l", "l is missing: 3"), ("SELECT 4 AS id, array(named_struct('n', 1, 'x', 'a'), named_struct('n', NULL, 'x', 'b')) AS l", "a line has no number: 4")):
        with pytest.raises(Exception, match=said):
            flat(docs.unionByName(spark.sql(bad))).collect()
    heads = spark.sql("SELECT 1 AS doc, 'h' AS h")
    lines = flat(docs)
    assert extracts.with_header(heads, lines, "doc").first().h == "h"
    for doc in ("5", "NULL"):
        with pytest.raises(Exception, match="a line has no header"):
            extracts.with_header(heads, lines.withColumn("doc", F.expr(f"cast({doc} AS int)")), "doc").collect()


def test_landing_stream_is_idempotent(spark, tmp_path):
    inbox = f"{tmp_path}/in"
    spark.range(5).write.parquet(f"{inbox}/one")
    run = lambda: land_available(spark, f"{inbox}/*", spark.range(1).schema, f"{tmp_path}/lake", f"{tmp_path}/audit", f"{tmp_path}/cp", ["id"], "s")
    run()
    run()
    assert spark.read.parquet(f"{tmp_path}/lake").count() == 5
    spark.range(5, 7).write.parquet(f"{inbox}/two")
    run()
    assert spark.read.parquet(f"{tmp_path}/lake").count() == 7
    assert spark.read.parquet(f"{tmp_path}/audit").agg(F.sum("rows_parsed")).first()[0] == 7


def test_every_entity_has_its_keys():
    for entity, keys in NATURAL_KEYS.items():
        assert set(keys) <= {f.name for f in entity_schema(entity)} and entity in COLUMNS


def test_close_cycle_of_the_published_calendar(spark):
    closes = spark.sql("SELECT date '2026-01-31' AS period_end_date, date '2026-02-15' AS close_completed_on")
    empty = spark.sql("SELECT date '2026-01-01' AS invoice_date, cast(1 as decimal(29,4)) AS revenue_amount, cast(1 as decimal(29,4)) AS cogs_amount, cast(1 as decimal(30,4)) AS gross_margin_amount")
    snaps = spark.sql("SELECT date '2026-01-31' AS snapshot_date, cast(5 as decimal(18,4)) AS inventory_value")
    ledger = spark.sql("SELECT 'GRP-1100' AS consolidated_account, cast(1 as decimal(19,4)) AS net_amount")
    assert marts.kpi_finance(empty, snaps, ledger, closes).first().close_cycle_days == 15.0


def test_effective_dating(spark):
    coa = spark.sql("SELECT * FROM VALUES ('c','1','A',date '2020-01-01',date '2020-12-31','DIRECT',true), ('c','1','B',date '2020-06-01',date '9999-12-31','DIRECT',true) AS t(source_company_id,source_gl_account,target_consolidated_account,effective_start_date,effective_end_date,mapping_rule_type,active_flag)")
    assert model.coa_overlaps(coa).count() == 1
    assert model.dim_date(spark, "2024-01-01", "2024-01-07").where("day_of_week = 0").first().date_key.isoformat() == "2024-01-07"


def test_empty_source_and_zero_ratio(spark):
    keys = spark.sql("SELECT 'a' AS source_key UNION ALL SELECT 'b'")
    none = keys.where("false")
    assert reconcile.tombstones(none, keys).count() == 0
    run = reconcile.triage(reconcile.sweep([reconcile.tag(none, "s", "e")], [reconcile.tag(keys, "s", "e")])).first()
    assert (run.action, run.ratio) == ("SKIP_LOUD", 0.0)


def test_stale_and_plausible(spark):
    state = spark.sql("SELECT 's' AS source_id, 'e' AS entity, timestamp '2024-01-01 00:00:00' AS updated_at")
    assert quality.stale(state, F.expr("timestamp '2024-01-03 00:00:00'"), 24).count() == 1
    assert quality.stale(state, F.expr("timestamp '2024-01-01 02:00:00'"), 24).count() == 0
    row = spark.sql("SELECT 0.2D AS gross_margin_pct, CAST(NULL AS DOUBLE) AS inventory_turns, 2D AS gmroi")
    assert {r.check_name: r.status for r in quality.plausible(row).collect()} == {"plausible:gross_margin_pct": "pass", "plausible:inventory_turns": "fail", "plausible:gmroi": "pass"}


def test_numbers_in_answers(spark):
    df = spark.sql("SELECT * FROM VALUES ('about 13,306.99 or 24%'), ('none'), (NULL) AS t(a)")
    assert [r[0] for r in df.select(metrics.first_number(F.col("a"))).collect()] == [13306.99, None, None]


def test_sql_policy(spark):
    cases = {
        "SELECT description FROM t": "OK", "": "EMPTY", "select ';' from t;": "MULTIPLE_STATEMENTS", "select 1; drop table t": "MULTIPLE_STATEMENTS", "insert into t values (1)": "NOT_SELECT", "select 1 /* drop */": "OK",
        "with x as (select 1) select glob('a')": "FILE_FUNCTION", "select glob from t": "OK", "select replace(a, 'x', 'y') from t": "OK", "select 1 from sqlite_scan('a', 'b')": "FILE_FUNCTION", "select 'reset'": "FORBIDDEN_KEYWORD",
        "select checkpoint from read_json_auto('a')": "FILE_FUNCTION", "selected": "NOT_SELECT", "WITH": "OK",
    }
    df = spark.createDataFrame([(k,) for k in cases], "sql string")
    assert {r.sql: r.verdict for r in governance.sql_policy(df).collect()} == cases


def test_grants_deny_unknown(spark):
    docs = spark.sql("SELECT 1 AS doc_id, array('analyst') AS allow UNION ALL SELECT 2, array('ann') UNION ALL SELECT 3, array()")
    people = spark.sql("SELECT * FROM VALUES ('ann', array('analyst')), ('bob', NULL) AS t(principal, roles)")
    assert {tuple(r) for r in governance.granted_documents(docs, people).collect()} == {("ann", 1), ("ann", 2)}


def test_jdbc_scan_behind_a_watermark(spark, tmp_path):
    """Spark's own embedded database stands in for a source; the watermark reaches its SQL."""
    from tallyard.sources.extracts import read_jdbc

    url, driver = "jdbc:derby:memory:erp;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    spark.range(10).withColumn("stamp", F.col("id") * 10).write.format("jdbc").options(url=url, driver=driver, dbtable="orders").save()
    options = {"url": url, "driver": driver, "dbtable": "orders", "partitionColumn": "id", "lowerBound": "0", "upperBound": "10", "numPartitions": "3"}
    rows = read_jdbc(spark, options, "stamp", 50)
    assert sorted(r.id for r in rows.collect()) == [6, 7, 8, 9]
    assert "GreaterThan(stamp,50)" in rows._jdf.queryExecution().executedPlan().toString().replace("STAMP", "stamp")


def test_source_tables():
    every = {(d, e): databases.source_table(d, e) for d in extracts.DIALECTS for e in COLUMNS}
    assert len(every) == 99 and all(extracts.identifier(s.table) and extracts.identifier(s.watermark) for s in every.values())
    assert every["oracle", "gl_entries"] == databases.SourceTable("ORA_GL_ENTRIES", "ENTRY_DATE")
    assert every["sqlserver", "inventory_snapshots"] == databases.SourceTable("dbo.InventorySnapshots", "SnapshotDate")
    assert {c for c, _ in every["db2_iseries", "sales_order_lines"].columns} == {f.name for f in entity_schema("sales_order_lines")}
    with pytest.raises(ValueError, match="no source"):
        databases.source_table("informix", "nothing")


def test_claim_rules(spark):
    opened = spark.createDataFrame([(1, "Ann "), (2, "ann")], "claim_id long, opened_by string")
    steps = [("submit", "submitted", "ann", None), ("start_review", "under_review", "bob", None), ("approve", "approved", " ANN", None), ("lock", "locked", "bob", "cy")]
    rows = [(1, k, k, *s) for k, s in enumerate(steps)]
    rows += [(2, 0, 0, "submit", "submitted", " ", None), (2, 1, 1, "approve", "approved", "bob", None), (2, 2, 2, "lock", "locked", "bob", ""), (3, 0, 0, "submit", "submitted", "bob", None)]
    moves = spark.createDataFrame(rows, "claim_id long, seq long, at long, action string, to_status string, actor string, confirmed_by string")
    found = {(r.claim_id, r.seq): r.rule for r in governance.illegal_transitions(opened, moves).collect()}
    assert found == {(1, 2): "FOUR_EYES", (1, 3): "ILLEGAL_STEP", (2, 0): "UNNAMED_ACTOR", (2, 1): "ILLEGAL_STEP", (2, 2): "ILLEGAL_STEP", (3, 0): "UNKNOWN_CLAIM"}
    assert {(r.claim_id, r.status, r.locked_by) for r in governance.claim_states(opened, moves).collect()} == {(1, "under_review", None), (2, "draft", None)}
    fair = moves.where("claim_id = 1").withColumn("actor", F.when(F.col("action") == "approve", "dee").otherwise(F.col("actor")))
    assert [(r.status, r.locked_by) for r in governance.claim_states(opened.where("claim_id = 1"), fair).collect()] == [("locked", "cy")]
    assert [r.rule for r in governance.illegal_transitions(opened, fair.withColumn("confirmed_by", F.lit("Bob "))).collect()] == ["SELF_CONFIRMED"]


@pytest.mark.parametrize("pieces", [None, 1, 7])
def test_claims_equal_a_plain_loop(spark, pieces):
    """Random ledgers with refused moves, one of them of very many; cut into pieces anywhere. One more rule makes a circle."""
    steps = [*governance.STEPS, ("rejected", "reopen", "draft")]
    rng = random.Random(pieces)
    rows = []
    for claim in [*range(25), *[99] * 30]:
        for _ in range(rng.randint(0, 12)):
            _, action, to = rng.choice(steps)
            rows.append((claim, len(rows), rng.randrange(500), action, rng.choice([to] * 9 + ["draft"]), rng.choice(["ann", " Bob", "cy", "", None]), rng.choice(["dee", "BOB ", None, " "])))
    opened = [(c, rng.choice(["Ann", "bob "])) for c in [*range(23), 99, 200]]
    want, state, lock = {}, dict.fromkeys([c for c, _ in opened], "draft"), {}
    clean = lambda x: (x or "").strip().lower()
    for claim, seq, _, action, to, actor, confirmed in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        before, owner = state.get(claim, "draft"), dict(opened).get(claim)
        if claim not in state:
            rule = "UNKNOWN_CLAIM"
        elif (before, action, to) not in steps:
            rule = "ILLEGAL_STEP"
        elif not clean(actor):
            rule = "UNNAMED_ACTOR"
        elif action in ("approve", "lock") and clean(actor) == clean(owner):
            rule = "FOUR_EYES"
        elif action == "lock" and not clean(confirmed):
            rule = "ANONYMOUS_LOCK"
        elif action == "lock" and clean(confirmed) == clean(actor):
            rule = "SELF_CONFIRMED"
        else:
            rule, state[claim] = None, to
            lock[claim] = confirmed if to == "locked" else lock.get(claim)
        want[seq] = (before, rule)
    o = spark.createDataFrame(opened, "claim_id long, opened_by string")
    moves = claims.replayed(o, spark.createDataFrame(rows, "claim_id long, seq long, at long, action string, to_status string, actor string, confirmed_by string"), steps, pieces)
    assert {r.seq: (r.before, r.rule) for r in moves.collect()} == want
    assert {r.claim_id: (r.status, r.locked_by) for r in claims.states_of(o, moves).collect()} == {c: (s, lock.get(c) if s == "locked" else None) for c, s in state.items()}


def test_canonical_json_equals_the_json_module(spark):
    rng = random.Random(8)
    floats = [0.0, -0.0, 1.0, 0.1, 1e-4, 1.5e-5, 123456789.125, 1e15, 1e16, 1.25e22, -2.5e-300, 9999999.0, 1e7, 0.001, 12345678.9] + [rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 20) for _ in range(60)]
    texts = ["", "é", "😀 a", 'q"\\ \n\t\r\f\b', "\x00\x1f\x7f", "/", "plain", None]
    rows = [(rng.choice(texts), rng.choice([None, True, 5]) is True, rng.randrange(-(10**18), 10**18), f, {rng.choice(["b", "é", "a", "Z"]): [rng.choice(texts)] for _ in range(3)}, (2, (rng.choice(texts), None))) for f in floats]
    df = spark.createDataFrame(rows, "t string, b boolean, n long, f double, m map<string, array<string>>, s struct<z: int, a: struct<y: string, x: double>>")
    text = F.struct(*(c for c in ("t", "f", "n", "m", "b", "s")))
    got = df.withColumn("x", text)
    got = [r[0] for r in got.select(canonical_json(F.col("x"), got.schema["x"].dataType)).collect()]
    want = [json.dumps({"t": t, "b": b, "n": n, "f": f, "m": m, "s": {"z": s[0], "a": {"y": s[1][0], "x": None}}}, sort_keys=True, separators=(",", ":")) for t, b, n, f, m, s in rows]
    assert got == want
    signals = spark.createDataFrame([("k", "sé", {"b": 1, "a": 2}), ("k", "x", None)], "kind string, subject string, payload map<string, int>")
    ids = [hashlib.sha256(json.dumps(x, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16] for x in ({"kind": "k", "subject": "sé", "payload": {"b": 1, "a": 2}}, {"kind": "k", "subject": "x", "payload": {}})]
    assert [r.signal_id for r in governance.with_signal_id(signals).collect()] == ids
    with pytest.raises(TypeError):
        canonical_json(F.lit(None), df.select(F.current_date().alias("d")).schema["d"].dataType)


def test_signal_with_another_half_life_is_one(spark):
    rows = spark.sql("SELECT 's' AS signal_id, 'k' AS kind, 'x' AS subject, h AS half_life_seconds, e AS emitted_at FROM VALUES (10D, 1), (20D, 3), (30D, 2) AS t(h, e)")
    assert [(r.half_life_seconds, r.emitted_at) for r in governance.post(rows).collect()] == [(20.0, 3)]


def test_projection_and_marks(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 'D-7'), ('a', 'D-9'), ('b', '9'), ('b', '10') AS t(type, doc)")
    assert extracts.project(df, {"x": "doc", "y": "none"}, {"y": "int"}).schema.simpleString() == "struct<x:string,y:int>"
    with pytest.raises(ValueError):
        extracts.project(df, {"x": "dok"})
    marks = spark.sql("SELECT * FROM VALUES ('a', 'D-7'), ('b', '9') AS t(type, watermark)")
    assert {r.doc for r in extracts.scan_by_type(df, "type", "doc", marks).collect()} == {"D-9", "10"}
    assert tuple(extracts.next_watermark_instant(spark.sql("SELECT * FROM VALUES ('2024-01-01T00:00:00Z'), ('x') AS t(a)"), "a").first()) == (None, 1)


def test_empty_text_has_a_vector_of_zeros(spark):
    df = spark.sql("SELECT * FROM VALUES (1, ''), (2, NULL), (3, 'a  A c') AS t(doc_id, text)")
    got = {r.doc_id: r.vector for r in governance.hashed_bag(df).collect()}
    assert got[1] == got[2] == [0] * 64 and sum(got[3]) == 3 and 2 in got[3]


def test_authorized_nearest_in_any_blocks(spark):
    rng = random.Random(5)
    vectors = {i: [rng.randint(-3, 3) / 1.0 for _ in range(4)] for i in range(60)} | {60: None, 61: [1.0]}
    grants = [(p, i) for p, m in (("ann", 1), ("bob", 3), ("eve", 99)) for i in vectors if i % m == 0 and p != "eve"]
    queries = [(f"{p}{i}", p, vectors[i]) for p in ("ann", "bob", "eve") for i in range(9)] + [("none", "ann", None)]
    want = set()
    for q, p, v in queries:
        near = sorted((-sum(a * b for a, b in zip(vectors[i], v, strict=True)), i) for g, i in grants if g == p and v and len(vectors[i] or ()) == 4)
        want |= {(q, i, rank) for rank, (_, i) in enumerate(near[:5], 1)}
    frames = (
        spark.createDataFrame(list(vectors.items()), "doc_id long, vector array<double>"), spark.createDataFrame(grants, "principal string, doc_id long"),
        spark.createDataFrame(queries, "query_id string, principal string, query array<double>"),
    )
    for docs_block, queries_block in ((2048, 128), (7, 2), (1, 1)):
        hits = governance.authorized_nearest(*frames, 5, docs_block, queries_block)
        assert {(r.query_id, r.doc_id, r["rank"]) for r in hits.collect()} == want
    assert governance.authorized_nearest(frames[0], frames[1].limit(0), frames[2]).count() == 0


def test_scored_share_shrinks_with_the_table(spark):
    """Clustered vectors: the hits are those of scoring everything, and the share that is scored falls as the table grows."""
    rng = np.random.default_rng(4)
    shares = []
    for n in (400, 6400):
        centres = rng.normal(0, 1, (40, 8))
        v = centres[rng.integers(0, 40, n)] + rng.normal(0, 0.05, (n, 8))
        docs = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "doc_id long, vector array<double>")
        asked = [(f"q{i}", "ann", v[i].tolist()) for i in range(20)]
        hits, work = nearest.nearest_granted(docs, docs.select(F.lit("ann").alias("principal"), "doc_id"), spark.createDataFrame(asked, "query_id string, principal string, query array<double>"), 5, 500)
        got = {}
        for r in hits.collect():
            got.setdefault(r.query_id, {})[r["rank"]] = r.doc_id
        for name, _, q in asked:
            score = [sum(a * b for a, b in zip(x, q, strict=True)) for x in v.tolist()]
            assert [got[name][k] for k in range(1, 6)] == sorted(range(n), key=lambda i: (-score[i], i))[:5]
        counts = work.agg(F.sum("scored"), F.sum("granted")).first()
        assert counts[1] == 20 * n
        shares.append(counts[0] / counts[1])
    assert shares[1] < shares[0] < 0.6 and shares[1] < 0.2, shares


def test_cash_cycle_carries_balances_over_months(spark):
    d = datetime.date
    invoices = spark.createDataFrame([(d(2024, 1, 9), 100, 50), (d(2024, 3, 2), 200, 80)], "invoice_date date, revenue_amount int, cogs_amount int").withColumns({c: F.col(c).cast("decimal(18,4)") for c in ("revenue_amount", "cogs_amount")})
    ledger = spark.createDataFrame([(d(2024, 1, 9), "GRP-1100", 40), (d(2024, 2, 1), "GRP-1100", 10), (d(2024, 2, 1), "GRP-2000", -16)], "entry_date date, consolidated_account string, net_amount int").withColumn("net_amount", F.col("net_amount").cast("decimal(18,4)"))
    stock = spark.createDataFrame([(d(2024, 3, 1), 30), (d(2024, 3, 31), 50)], "snapshot_date date, inventory_value int").withColumn("inventory_value", F.col("inventory_value").cast("decimal(18,4)"))
    january, march = bi.cash_cycle_by_month(invoices, stock, ledger).collect()
    assert (january.dio, january.dso, january.dpo, january.cash_conversion_cycle) == (None, 0.4 * 31, 0.0, None)
    assert (march.dio, march.dso, march.dpo) == (0.5 * 31, 0.25 * 31, 0.2 * 31)


def test_gate_of_deliveries_goes_on_after_a_restart(spark, tmp_path):
    """Over three runs: re-delivered, regenerated, unreadable and stale batches; what was refused changes nothing."""
    at = lambda d: f"2024-01-{d:02}T00:00:00Z"
    runs = [
        [("s", "b1", at(5), "x", 1, "PROMOTED"), ("s", "b1", at(5), "x", 2, "SKIPPED_DUPLICATE"), ("s", "b0", at(5), "y", 3, "STALE_MANIFEST"), ("t", "b1", "2024-01-02T03:00:00+03:00", "x", 4, "PROMOTED")],
        [("s", "b1", at(9), "z", 5, "REGENERATED_BATCH"), ("s", "b2", at(6), "z", 6, "PROMOTED"), ("s", "b0", at(7), "y", 7, "PROMOTED"), ("t", "b2", at(2), "q", 8, "STALE_MANIFEST"), (None, "b", at(1), "x", 9, "MALFORMED")],
        [("s", "b0", at(7), "y", 10, "SKIPPED_DUPLICATE"), ("t", "b3", "soon", "q", 11, "UNREADABLE_GENERATION"), ("u", "b", at(1), "x", 12, "PROMOTED")],
    ]
    for k, rows in enumerate(runs):
        spark.createDataFrame([r[:5] for r in rows], DELIVERY).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        judge_available(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/cp")
    judge_available(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/cp")
    got = {r.arrival: r.verdict for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {r[4]: r[5] for rows in runs for r in rows}


def test_declared_checks_deal_only_what_can_fail(spark):
    """Digests, texts that resemble them, and values that repeat: the counts of each check one by one."""
    digest = "md5(cast(id AS string))"
    rows = spark.range(200).selectExpr(
        f"CASE WHEN id < 20 THEN NULL WHEN id < 60 THEN upper({digest}) WHEN id < 150 THEN md5(cast(id % 50 AS string)) ELSE concat('k', id) END AS k", f"CASE WHEN id % 7 <> 0 THEN {digest} WHEN id % 2 = 0 THEN 'sixteen bytes, a' END AS p"
    )
    parents = spark.range(0, 200, 2).selectExpr(f"{digest} AS k").unionByName(spark.sql("SELECT 'other' AS k"))
    checks = [("not_null", "t", "k", None, None), ("unique", "t", "k", None, None), ("relationship", "t", "p", "q", "k"), ("unique", "q", "k", None, None), ("not_null", "t", "p", None, None)]
    got = {r.check_name: r.failing_rows for r in quality.declared_checks({"t": rows, "q": parents}, checks).collect()}
    t, known = rows.collect(), {r.k for r in parents.collect()}
    keys = [r.k for r in t if r.k is not None]
    assert got == {
        "not_null:t.k": 20, "unique:t.k": sum(keys.count(k) > 1 for k in set(keys)), "relationship:t.p->q": sum(r.p is not None and r.p not in known for r in t), "unique:q.k": 0, "not_null:t.p": sum(r.p is None for r in t),
    }
    assert got["unique:t.k"] > 0
    shorter, longer = (spark.range(1).select(quality._packed(F.lit(v)).alias("v")).first().v for v in ("0" * 32, "0" * 31))
    assert (len(shorter), len(longer)) == (16, 32)


@pytest.mark.parametrize("apart", [(), ("t", "u")])
def test_declared_checks_take_tables_apart_and_counted_values(spark, apart):
    """One job for each table, or children that were counted before, and the same results."""
    t = spark.range(60).selectExpr("IF(id % 20 = 0, NULL, concat('k', id % 50)) AS k", "IF(id % 6 = 0, NULL, concat('p', id % 7)) AS p")
    u = spark.range(30).selectExpr("concat('k', id) AS k", "concat('p', id % 9) AS p")
    tables = {"t": t, "u": u, "q": spark.range(5).selectExpr("concat('p', id) AS p")}
    checks = [(kind, n, "k", None, None) for n in "tu" for kind in ("not_null", "unique")] + [("relationship", n, "p", "q", "p") for n in "tu"] + [("unique", "q", "p", None, None)]
    results = lambda **more: {r.check_name: r.failing_rows for r in quality.declared_checks(tables, checks, **more).collect()}
    want = {"not_null:t.k": 3, "unique:t.k": 9, "not_null:u.k": 0, "unique:u.k": 0, "relationship:t.p->q": 12, "relationship:u.p->q": 12, "unique:q.p": 0}
    counted = {(n, "p"): tables[n].groupBy(F.col("p").alias("v")).agg(F.count(F.lit(1)).alias("n")) for n in "tu"}
    assert results(apart=apart) == results(apart=apart, counted=counted) == want


def test_written_apart_frees_the_disk(spark):
    """Exchanges of what was written leave nothing behind; slices are all rows, and the setting is as it was."""
    import glob
    import os

    from tallyard.functions.scratch import _FREED, written_apart

    left = lambda: {f for f in glob.glob(spark.conf.get("spark.local.dir") + "/**/shuffle_*.data", recursive=True) if os.path.getsize(f)}
    before, setting = left(), spark.conf.get(_FREED)
    counts = spark.range(40_000).groupBy((F.col("id") % 20_000).alias("k")).count()
    for slices in (1, 3):
        rows = written_apart(counts, "counts", "k", slices)
        assert not left() - before
        assert (rows.count(), rows.selectExpr("count(DISTINCT k)").first()[0], rows.where("count <> 2").isEmpty()) == (20_000, 20_000, True)
        before |= left()
    assert spark.conf.get(_FREED) == setting


def test_declared_tables_fail_as_the_joined_facts_do(spark, monkeypatch):
    """Crosswalks that lack keys or repeat them, a dimension that lacks rows: facts of source keys fail the checks as often as joined ones."""
    from tallyard.plans import flows
    from tallyard.plans.registry import Warehouse
    from tallyard.sources import shape

    monkeypatch.setattr(shape, "SLICED_BYTES", 0)
    w = Warehouse(spark, "/root/testdata/sf0.001")
    for name, key in (("item", "I-"), ("customer", "C-"), ("vendor", "V-")):
        x = getattr(w, f"xwalk_{name}").withColumn("number", F.expr(f"cast(replace(source_key, '{key}') AS int)"))
        again = x.where("number % 5 = 0").withColumn(f"canonical_{name}_key", F.concat(F.lit("again-"), F.col(f"canonical_{name}_key")))
        w._built[f"xwalk_{name}"] = x.where("number % 7 <> 0").unionByName(again).drop("number")
        w._built[f"dim_{name}"] = getattr(w, f"dim_{name}").where(F.col(f"{name}_key") > "8")
    tables, counted = flows.declared_tables(w)
    got = quality.declared_checks(tables, quality.DECLARED, counted=counted, apart=("fact_sales", "fact_inventory"))
    want = quality.declared_checks({t: getattr(w, t) for t in tables}, quality.DECLARED)
    rows = lambda df: {r.check_name: r.failing_rows for r in df.collect()}
    failing = rows(got)
    assert failing == rows(want)
    assert all(failing[f"{kind}:{c}"] for kind, c in (("unique", "fact_sales.sales_order_line_key"), ("unique", "fact_inventory.inventory_snapshot_key"), ("relationship", "fact_sales.customer_key->dim_customer"), ("relationship", "fact_inventory.item_key->dim_item"), ("relationship", "fact_purchase.vendor_key->dim_vendor")))


def test_gate_asks_its_state_once_a_source_and_batch():
    """A bucket of many sources and deliveries: one answer for each source and batch, whatever the number of deliveries."""

    class Kept(dict):
        asked = 0

        def getValue(self, key):
            self.asked += 1
            return self.get(key)

        def updateValue(self, key, value):
            self[key] = value

    gate = Gate()
    gate.newest, gate.hashes = Kept(), Kept()
    at = lambda n: f"2024-01-01T00:00:{n:02}Z"
    rows = [(f"s{s}", f"b{n % 3}", at(n), f"h{n % 3}", n) for n in range(30) for s in range(20)]
    frame = pd.DataFrame(rows, columns=["source_id", "batch_id", "generated_at", "content_hash", "arrival"])
    (first,) = gate.handleInputRows((0,), iter([frame[300:], frame[:300]]), None)
    assert first["verdict"].value_counts().to_dict() == {"PROMOTED": 60, "SKIPPED_DUPLICATE": 540}
    assert (gate.newest.asked, gate.hashes.asked) == (20, 0)  # nothing is known of a new source
    later = frame[:60].assign(content_hash="other", arrival=frame["arrival"][:60] + 100)
    (second,) = gate.handleInputRows((0,), iter([later]), None)
    assert set(second["verdict"]) == {"REGENERATED_BATCH"}
    assert (gate.newest.asked, gate.hashes.asked) == (40, 60)


@pytest.mark.parametrize("task_lines", [5, 10**6])
def test_windows_that_are_many_meet_by_exchange(spark, task_lines):
    lines = spark.range(300).selectExpr("id", "IF(id % 10 = 0, 'a', 'hot') AS key", "date_add(date '2020-01-01', cast(id % 200 AS int)) AS at")
    windows = spark.range(12).selectExpr("IF(id % 3 = 0, 'a', 'hot') AS key", "date_add(date '2020-01-01', cast(id * 15 AS int)) AS a", "date_add(date '2020-01-01', cast(id * 15 + 40 AS int)) AS z", "id AS w")
    got = intervals.valid_at(lines, windows, "key", "at", "a", "z", 20, task_lines, few_windows=11)
    few = intervals.valid_at(lines, windows, "key", "at", "a", "z", 20, task_lines)
    plain = lines.join(windows, (lines.key == windows.key) & F.col("at").between(F.col("a"), F.col("z")), "left").select("id", "w")
    rows = lambda df: sorted((r.id, -1 if r.w is None else r.w) for r in df.select("id", "w").collect())
    assert rows(got) == rows(few) == rows(plain)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(key" not in plan.split("BroadcastExchange")[0]  # lines stay where they are


@pytest.mark.parametrize(("task_lines", "least"), [(10**6, 1_000), (10**6, 50), (10, 1_000)])
def test_many_windows_made_of_few_rows_are_never_broadcast(spark, monkeypatch, task_lines, least):
    """A small table that becomes many windows: keys uncut, cut and dealt over salts give the same lines, those without a key or date too."""
    monkeypatch.setattr(intervals, "BIN_LINES", least, raising=False)
    lines = spark.range(400).selectExpr("id", "CASE WHEN id % 9 = 0 THEN NULL WHEN id % 5 = 0 THEN 'hot' ELSE concat('k', id % 20) END AS key", "IF(id % 7 = 0, NULL, date_add(date '1969-11-01', cast(id % 200 AS int))) AS at")
    table = spark.range(21).selectExpr("IF(id = 20, 'hot', concat('k', id)) AS key", "explode(sequence(0, 9)) AS w")
    windows = table.selectExpr("w", "key", "date_add(date '1969-11-01', w * 20) AS a", "date_add(date '1969-11-01', w * 20 + 25 - 50 * int(w = 4)) AS z")
    got = intervals.valid_at(lines, windows, "key", "at", "a", "z", 20, task_lines, few_windows=20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # broadcast are crowded keys, and full bins to lines and windows, alone
    assert plan.count("SortMergeJoin") == 2 and plan.count("BroadcastHashJoin") == (3 if task_lines == 10 else int(least == 50))
    assert got.columns == ["id", "key", "at", "w", "a", "z"]
    plain = lines.join(windows.withColumnRenamed("key", "k"), (F.col("key") == F.col("k")) & F.col("at").between(F.col("a"), F.col("z")), "left").select("id", "w")
    rows = lambda df: sorted((r.id, -1 if r.w is None else r.w) for r in df.select("id", "w").collect())
    assert rows(got) == rows(plain)


def test_search_plan_of_many_cells_stays_small(spark):
    """Queries with many cells each are planned one at a time: no Python object for each cell."""
    import tracemalloc

    cells = "array<struct<cell: int, n: bigint, far: double>>"
    asked = spark.range(4000).selectExpr("cast(id AS string) AS query_id", "'p' AS principal", "array(1D, cast(id AS double)) AS query", f"cast(transform(sequence(0, 255), c -> struct(c, 3L, 0.5D)) AS {cells}) AS cells")
    pivots = {2: np.arange(512, dtype=float).reshape(256, 2)}
    planned = nearest._planned(asked, pivots, 10)
    row = planned.where("query_id = '7'").first()
    assert row["first"][:2] == [255, 254] and len(row["first"]) == 4 and len(row["rest"]) == len(row["bounds"]) == 252
    run = []
    frame = type("Frame", (), {"schema": asked.schema, "mapInArrow": lambda self, f, fields: run.append(f)})()
    nearest._planned(frame, pivots, 10)
    batches = asked.toArrow().combine_chunks().to_batches()
    tracemalloc.start()
    (out,) = run[0](iter(batches))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == 4000 and peak < 60 << 20  # 4,000 x 256 cells as objects: over 300 MB


def test_states_by_a_column_are_those_of_its_values(spark):
    """One pass makes the states of each part; together they are the states of all lines."""
    lines = spark.range(60).selectExpr("id % 3 AS part", "date_add(date '2020-01-01', cast(id % 5 AS int)) AS invoice_date", "IF(id % 4 = 0, NULL, concat('c', id % 4)) AS customer_key", "concat('l', id % 2) AS location_key", "concat('i', id div 6) AS invoice_no",
        "concat('o', id div 6) AS order_no", "id % 4 AS filled_qty", "3L AS ordered_qty", "0L AS cancelled_qty", "id % 4 >= 3 AS is_line_complete", "id % 2 = 0 AS is_on_time", "id % 4 < 3 AS is_backordered", "IF(id % 5 = 0, NULL, date '2020-01-02') AS shipped_date", "2L AS received_qty",
        "last_day(date_add(date '2020-01-01', cast(id AS int))) AS snapshot_date", "IF(id % 2 = 0, 'a', 'b') AS consolidated_account", *(f"cast(id * 1.5 AS decimal(18,4)) AS {c}" for c in ("revenue_amount", "cogs_amount", "gross_margin_amount", "inventory_value", "ppv_amount", "received_standard_amount", "net_amount")))
    facts = {n: lines for n in ("invoices", "sales", "inventory", "purchases", "gl")}
    rows = lambda df: sorted(map(repr, df.collect()))
    kept, whole = marts.states_of(facts, by="part"), marts.states_of(facts)
    parts = {n: df.drop("part") for n, df in kept.items()}
    empty = {n: df.where("false") for n, df in parts.items()}
    for name, merged in marts.merged_states(parts, added=empty).items():
        assert rows(merged.select(*sorted(merged.columns))) == rows(whole[name].select(*sorted(merged.columns))), name
        one = marts.states_of({n: df.where("part = 1") for n, df in facts.items()})[name]
        assert rows(kept[name].where("part = 1").select(*one.columns)) == rows(one), name


def test_entries_are_counted_before_they_meet_the_chart(spark):
    """No join or sort takes the entries of an account into one task."""
    from tallyard.plans import QUERIES

    plan = QUERIES["c13_coa_usage"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join LeftOuter" in line and "source_gl_account" in line)
    below = plan[plan.index(join) :]
    assert "Aggregate [account" in below


@pytest.mark.parametrize("master", ["local-cluster[3,2,1024]", "spark://host:7077", "yarn"])
def test_jdbc_scan_refuses_executors_of_their_own(master):
    """Before anything is written: each executor would have an embedded database of its own."""
    from types import SimpleNamespace

    from tallyard.plans import QUERIES

    with pytest.raises(ValueError, match="local master only"):
        QUERIES["i16_jdbc_scan"](SimpleNamespace(sparkContext=SimpleNamespace(master=master)), "/root/testdata/sf0.001")
