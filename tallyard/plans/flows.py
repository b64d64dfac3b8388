"""Queries of landing and extraction (i), reconciliation (r), quality (q), metrics (m) and governance (g)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import natural_id
from ..operators import governance, marts, metrics, model, quality, reconcile
from ..sources import drops, extracts
from ..sources.schemas import entity_schema
from ..sources.shape import SOURCE
from .registry import query

LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINES = ", ".join(LINE)

# ---- landing and extraction -------------------------------------------------------------------------------------



@query(
    "i6_header_drift",
    """SELECT l_orderkey, list_filter(e, lambda x: NOT list_contains(a, x)) AS missing, list_filter(a, lambda x: NOT list_contains(e, x)) AS extra, len(list_filter(e, lambda x: NOT list_contains(a, x))) > 0 OR len(list_filter(a, lambda x: NOT list_contains(e, x))) > 0 AS drift
    FROM (SELECT l_orderkey, ['A', 'N'] AS e, list_sort(list(DISTINCT l_returnflag)) AS a FROM lineitem GROUP BY 1)""",
)
def _(w):
    """Return flags of each order as the columns of a file that should have A and N."""
    rows = w.table("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("a"))
    missing, extra, drift = drops.header_drift(F.array(F.lit("A"), F.lit("N")), F.col("a"))
    return rows.select("l_orderkey", missing.alias("missing"), extra.alias("extra"), drift.alias("drift"))


@query("i7_cast_errors", "SELECT event_type AS source_file, count(*) AS bad_cells FROM events WHERE try_cast(CASE WHEN event_id % 7 = 0 THEN 'n' || event_id ELSE cast(event_id AS varchar) END AS bigint) IS NULL GROUP BY 1")
def _(w):
    cell = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("n"), F.col("event_id"))).otherwise(F.col("event_id").cast("string"))
    raw = w.table("events").select(F.col("event_type").alias("source_file"), F.col("event_id").alias("source_row_no"), cell.alias("lead_time_days"), *(F.lit("x").alias(c) for c in ("vendor_no", "vendor_name", "terms")))
    return drops.cast_errors(raw, "vendors").select("source_file", "bad_cells")


_HASHED = "SELECT event_id, cast(user_id AS varchar) AS source_id, sha256(props) AS file_hash, ts FROM events"
query("i11_new_files", f"WITH f AS ({_HASHED}) SELECT event_id, source_id, file_hash FROM f WHERE (source_id, file_hash) NOT IN (SELECT (source_id, file_hash) FROM f WHERE event_id % 3 = 0) AND event_id % 3 <> 0")(
    lambda w: (lambda f: drops.new_files(f.where("event_id % 3 <> 0").select("event_id", "source_id", "file_hash"), f.where("event_id % 3 = 0").select("source_id", "file_hash", F.lit("PROMOTED").alias("status"))))(
        w.table("events").select("event_id", F.col("user_id").cast("string").alias("source_id"), F.sha2("props", 256).alias("file_hash"))
    )
)
query("i12_first_receipt", f"WITH f AS ({_HASHED}) SELECT source_id, file_hash, min(struct_pack(t := ts, i := event_id)).i AS event_id FROM f GROUP BY 1, 2")(
    lambda w: drops.first_receipt(w.table("events").select("event_id", F.col("user_id").cast("string").alias("source_id"), F.lit("b").alias("batch_id"), F.lit("f").alias("file_name"), F.sha2("props", 256).alias("file_hash"), F.struct("ts", "event_id").alias("processed_at"), F.lit("PROMOTED").alias("status")))
    .select("source_id", "file_hash", "event_id")
)
query(
    "i13_batch_order",
    """SELECT event_id, CASE WHEN k IS NOT NULL AND k <> h THEN 'REGENERATED_BATCH' WHEN k IS NULL AND g <= m THEN 'STALE_MANIFEST' END AS verdict FROM (SELECT *, last_value(h) OVER (PARTITION BY s, b ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k,
    max(g) OVER (PARTITION BY s ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM (SELECT event_id, user_id AS s, event_type AS b, sha256(props) AS h, date_trunc('second', ts) AS g FROM events))""",
)(
    lambda w: drops.batch_order(
        w.table("events").select("event_id", F.col("user_id").alias("source_id"), F.col("event_type").alias("batch_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"), F.sha2("props", 256).alias("content_hash"), F.col("event_id").alias("arrival"))
    ).select("event_id", "verdict")
)
query("i14_split_code_name", "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_brand ELSE trim(p_brand) END AS g_code, CASE WHEN p_partkey % 5 <> 0 THEN p_type || ':' || p_name END AS g_name FROM part")(
    lambda w: drops.split_code_name(w.table("part").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.col("p_brand")).otherwise(F.concat_ws(":", "p_brand", "p_type", "p_name")).alias("g")), "g").drop("g")
)
query("i15_keep_first", f"SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINES}) AS r FROM lineitem) WHERE r = 1")(lambda w: drops.keep_first(w.table("lineitem"), ["l_orderkey", "l_linenumber"], LINE))
query("i10_malformed", "SELECT cast(count(*) FILTER (WHERE l_orderkey % 11 <> 0) AS bigint) AS good, cast(count(*) FILTER (WHERE l_orderkey % 11 = 0) AS bigint) AS malformed FROM lineitem")(
    lambda w: (lambda p: marts.one_row(p[0].agg(F.count(F.lit(1)).alias("good")), p[1].agg(F.count(F.lit(1)).alias("malformed"))))(
        drops.split_malformed(w.table("lineitem").withColumn("k", F.when(F.col("l_orderkey") % 11 != 0, F.col("l_orderkey"))), ["k"])
    )
)
query("i18_projection", "SELECT o_orderkey AS order_no, o_orderdate AS order_date, NULL::varchar AS branch_code FROM orders")(
    lambda w: extracts.project(w.table("orders"), {"order_no": "o_orderkey", "order_date": "o_orderdate", "branch_code": "absent"}, {"branch_code": "string"})
)
query("i19_incremental", "SELECT event_id, ts FROM events WHERE event_id > 5000")(lambda w: extracts.incremental(w.table("events").select("event_id", "ts"), "event_id", 5000))
query("i20_watermark_text", "SELECT max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS watermark FROM events")(
    lambda w: extracts.next_watermark_text(w.table("events").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("t")), "t")
)
_T = "CASE WHEN event_id % 2 = 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || '.5Z' ELSE strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || '.250Z' END"
query("i21_watermark_instant", f"SELECT event_type, CASE WHEN event_type <> 'error' THEN max_by({_T}, struct_pack(a := date_trunc('second', ts), b := CASE WHEN event_id % 2 = 0 THEN 500 ELSE 250 END)) END AS watermark, cast(count(*) FILTER (WHERE event_type = 'error' AND event_id % 5 = 0) AS bigint) AS unreadable FROM events GROUP BY 1")(
    lambda w: extracts.next_watermark_instant(
        w.table("events").select("event_type", F.when(F.expr("event_type = 'error' AND event_id % 5 = 0"), "soon").otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, ".5Z").otherwise(".250Z"))).alias("t")), "t", ["event_type"]
    )
)
query("i22_watermark_by_type", "SELECT event_type AS type, cast(greatest(max(event_id), CASE WHEN event_type = 'click' THEN 999999 ELSE 5 END) AS varchar) AS watermark FROM events GROUP BY event_type UNION ALL SELECT 'return', '7'")(
    lambda w: extracts.next_watermark_by_type(
        w.table("events"), "event_type", "event_id",
        w.table("events").select(F.col("event_type").alias("type")).distinct().select("type", F.when(F.col("type") == "click", "999999").otherwise("5").alias("watermark")).unionByName(w.spark.sql("SELECT 'return' AS type, '7' AS watermark")),
    )
)
query("i23_scan_by_type", "SELECT event_id, event_type FROM events WHERE (event_type = 'click' AND event_id > 999) OR event_type = 'view'")(
    lambda w: extracts.scan_by_type(w.table("events").select("event_id", "event_type"), "event_type", "event_id", w.spark.sql("SELECT * FROM VALUES ('click', '999'), ('view', NULL) AS t(type, watermark)"))
)
query("i24_keyset", f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber) > (1000, 3)")(lambda w: extracts.after(w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"], [1000, 3]))
query("i25_join_documents", "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey")(
    lambda w: extracts.join_documents(w.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey")
)
query("i26_orphans", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_orderkey % 13 = 0")(
    lambda w: extracts.orphans(w.table("orders").where("o_orderkey % 13 <> 0").select(F.col("o_orderkey").alias("l_orderkey")), w.table("lineitem").select("l_orderkey", "l_partkey"), "l_orderkey")
)
query("i27_flatten_lines", "SELECT l_orderkey AS order_no, l_linenumber AS line_no, l_partkey AS item FROM lineitem WHERE l_linenumber <> 2")(
    lambda w: extracts.flatten_lines(
        w.table("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.when(F.col("l_linenumber") != 2, F.col("l_linenumber")).alias("n"), F.col("l_partkey").alias("p"))).alias("lines")),
        "lines", {"order_no": "l_orderkey"}, {"line_no": "n", "item": "p"}, "line_no",
    )
)
query("i28_union_scoped", "SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN 'north' ELSE 'south' END AS company_id FROM customer")(
    lambda w: extracts.union_scoped({"north": w.table("customer").where("c_nationkey < 12").select("c_custkey"), "south": w.table("customer").where("c_nationkey >= 12").select("c_custkey")})
)
query("i29_scoped", "SELECT c_custkey FROM customer WHERE c_nationkey IN (1, 2, 3) AND c_mktsegment = 'BUILDING'")(lambda w: extracts.scoped_to(w.table("customer"), c_nationkey=[1, 2, 3], c_mktsegment="BUILDING").select("c_custkey"))
query("i30_soft_delete", "SELECT l_orderkey, l_partkey FROM lineitem WHERE coalesce(nullif(l_returnflag, 'N'), 'x') <> 'R'")(
    lambda w: extracts.drop_soft_deleted(w.table("lineitem").select("l_orderkey", "l_partkey", F.nullif("l_returnflag", F.lit("N")).alias("flag")), "flag", ["R"]).drop("flag")
)
query("i31_stamp_snapshot", "SELECT p_partkey, date '2024-05-31' AS snapshot_date FROM part")(lambda w: extracts.stamp_snapshot(w.table("part").select("p_partkey"), "2024-05-31"))
query("i32_date_windows", "SELECT d.window_start, d.window_end, count(o_orderkey) AS n FROM (SELECT cast(s AS date) AS window_start, least(cast(s AS date) + 29, date '1998-12-31') AS window_end FROM (SELECT unnest(generate_series(date '1995-01-01', date '1998-12-31', interval 30 day)) AS s)) d LEFT JOIN orders ON cast(o_orderdate AS date) BETWEEN d.window_start AND d.window_end GROUP BY 1, 2")(
    lambda w: (lambda d: d.join(w.table("orders").select(F.to_date("o_orderdate").alias("d"), F.floor(F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")) / 30).alias("k"), "o_orderkey").where("d BETWEEN date '1995-01-01' AND date '1998-12-31'"), F.floor(F.datediff("window_start", F.lit("1995-01-01").cast("date")) / 30) == F.col("k"), "left").groupBy("window_start", "window_end").agg(F.count("o_orderkey").alias("n")))(
        extracts.date_windows(w.spark, "1995-01-01", "1998-12-31", 30)
    )
)
query("i33_catalog", "SELECT DISTINCT p_brand AS application, p_type AS cube FROM part")(lambda w: extracts.flatten_catalog(w.table("part").groupBy("p_brand").agg(F.collect_set("p_type").alias("types")), "p_brand", "types"))
query("i34_natural_id", "SELECT event_id, concat_ws(':', event_type, coalesce(cast(CASE WHEN event_id % 4 > 0 THEN user_id END AS varchar), 'None')) AS id FROM events")(
    lambda w: w.table("events").select("event_id", natural_id("event_type", F.when(F.col("event_id") % 4 > 0, F.col("user_id"))).alias("id"))
)
query("i35_provenance", "SELECT c_custkey, 'erp' AS source_system, cast(c_custkey AS varchar) AS source_id, 'b1' AS batch_id FROM customer")(
    lambda w: extracts.stamp(w.table("customer").select("c_custkey"), "erp", ["c_custkey"], F.expr("timestamp '2024-01-01 00:00:00'"), "b1").select("c_custkey", "source_system", "source_id", "batch_id")
)
query("i37_append", "SELECT event_id, event_type FROM events UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 10 = 0")(
    lambda w: extracts.appended(w.table("events").select("event_id", "event_type"), w.table("events").where("event_id % 10 = 0").select("event_id"))
)
query("i38_merge", f"SELECT * EXCLUDE (r) FROM (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC) AS r FROM lineitem) WHERE r = 1")(
    lambda w: (lambda d: extracts.merged(d.where("l_partkey % 2 = 0"), d.where("l_partkey % 2 = 1"), ["l_orderkey", "l_linenumber"], [F.desc("l_partkey")]))(w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"))
)
query("i41_latest_state", "SELECT user_id, event_type, max(struct_pack(t := ts, i := event_id)).i AS event_id FROM events GROUP BY 1, 2")(
    lambda w: extracts.latest(w.table("events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], "ts", [F.desc("event_id")]).drop("ts")
)
query("i41_source_status", "SELECT e.event_type AS source_id, true AS enabled, cast(count(*) FILTER (WHERE value > 50) AS bigint) AS promoted, cast(count(*) FILTER (WHERE NOT value > 50) AS bigint) AS quarantined FROM events e GROUP BY 1")(
    lambda w: extracts.source_status(w.table("events").select(F.col("event_type").alias("source_id")).distinct().withColumn("enabled", F.lit(True)), w.table("events").select(F.col("event_type").alias("source_id"), F.when(F.col("value") > 50, "PROMOTED").otherwise("QUARANTINED").alias("status")))
)

# ---- reconciliation ---------------------------------------------------------------------------------------------

_GONE = "SELECT 'C-' || c_custkey AS source_key FROM customer WHERE c_custkey % 17 = 0"


def _customers_left(w):
    return reconcile.source_keys(w.customers.where(F.col("postal_code").cast("bigint") % 17 != 0), ["customer_no"])


def _customers_held(w):
    return reconcile.warehouse_keys(w.customers.select(F.col("customer_no").alias("source_id")))


def _parts(w, everything: bool):
    keys = w.items if everything else w.items.where("p_partkey % 17 <> 0")
    return keys.select(F.col("item_no").alias("source_key"))


def _runs(w):
    return reconcile.sweep(
        [reconcile.tag(_customers_left(w), "one", "customers"), reconcile.tag(_parts(w, False), "one", "items")],
        [reconcile.tag(_customers_held(w), "one", "customers"), reconcile.tag(_parts(w, True), "one", "items"), reconcile.tag(w.vendors.select(F.col("vendor_no").alias("source_key")), "one", "vendors")],
    )


_SWEEP = """SELECT 'one' AS source_id, 'customers' AS entity, cast(count(*) FILTER (WHERE c_custkey % 17 <> 0) AS bigint) AS source_keys, count(*) AS warehouse_keys, cast(count(*) FILTER (WHERE c_custkey % 17 = 0) AS bigint) AS tombstoned, count(*) FILTER (WHERE c_custkey % 17 = 0)::double / count(*)::double AS ratio FROM customer
    UNION ALL SELECT 'one', 'items', count(*) FILTER (WHERE p_partkey % 17 <> 0), count(*), count(*) FILTER (WHERE p_partkey % 17 = 0), count(*) FILTER (WHERE p_partkey % 17 = 0)::double / count(*)::double FROM part UNION ALL SELECT 'one', 'vendors', 0, count(*), 0, 0.0 FROM supplier"""

query("r1_source_keys", "SELECT DISTINCT 'C-' || c_custkey AS source_key FROM customer WHERE c_custkey % 17 <> 0")(_customers_left)
query("r2_warehouse_keys", "SELECT 'C-' || c_custkey AS source_key FROM customer")(_customers_held)
query("r3_tombstones", _GONE)(lambda w: reconcile.tombstones(_customers_left(w), _customers_held(w)))
query("r4_snapshot_diff", "SELECT 'I-' || p_partkey AS source_key FROM part WHERE p_partkey % 17 = 0")(lambda w: reconcile.snapshot_diff(_parts(w, True), _parts(w, False)))
query("r5_empty_source", f"{_GONE} LIMIT 0")(lambda w: reconcile.tombstones(_customers_left(w).where("source_key IS NULL"), _customers_held(w)))
query("r6_semantics", "SELECT 'S-' || s_suppkey AS source_id, true AS enabled FROM supplier WHERE s_suppkey % 3 = 0")(
    lambda w: reconcile.may_reconcile(w.table("supplier").select(F.concat(F.lit("S-"), "s_suppkey").alias("source_id"), F.when(F.col("s_suppkey") % 3 == 0, reconcile.BATCH).otherwise("cdc").alias("delete_semantics"), F.lit(True).alias("enabled"))).drop("delete_semantics")
)
query("r8_sweep", _SWEEP)(_runs)
query("r7_ratio", f"SELECT entity, ratio FROM ({_SWEEP})")(lambda w: _runs(w).select("entity", "ratio"))
query("r9_triage", f"SELECT entity, tombstoned, CASE WHEN source_keys = 0 THEN 'SKIP_LOUD' WHEN ratio >= 0.058 THEN 'REVIEW' WHEN tombstoned > 0 THEN 'APPLY' ELSE 'NONE' END AS action FROM ({_SWEEP})")(
    lambda w: reconcile.triage(_runs(w), 0.058).select("entity", "tombstoned", "action")
)
query("r10_fidelity", "SELECT 'one' AS source_id, 'customers' AS entity, avg(CASE WHEN c_custkey % 2 = 0 THEN 1.0::double ELSE 0.0 END) AS false_delete_rate, CASE WHEN avg(CASE WHEN c_custkey % 2 = 0 THEN 1.0::double ELSE 0.0 END) >= 0.5 THEN 'CORRECT' ELSE 'FALSE_ALARM' END AS verdict FROM customer WHERE c_custkey % 17 = 0")(
    lambda w: reconcile.fidelity(
        reconcile.tag(reconcile.tombstones(_customers_left(w), _customers_held(w)), "one", "customers"), reconcile.tag(w.customers.where(F.col("postal_code").cast("bigint") % 2 == 0).select(F.col("customer_no").alias("source_key")), "one", "customers"),
        w.spark.sql("SELECT 'one' AS source_id, 'customers' AS entity"),
    )
)
query("r11_live", "SELECT 'C-' || c_custkey AS source_id, c_name AS customer_name FROM customer WHERE c_custkey % 17 <> 0")(
    lambda w: reconcile.live(w.customers.select(F.col("customer_no").alias("source_id"), "customer_name"), reconcile.tombstones(_customers_left(w), _customers_held(w)))
)

# ---- quality ----------------------------------------------------------------------------------------------------

_OK = "'error' AS severity, CASE WHEN failing_rows > 0 THEN 'fail' ELSE 'pass' END AS status, cast(failing_rows AS bigint) AS failing_rows, NULL::varchar AS detail"
query("q1_not_null", f"SELECT check_name, {_OK} FROM (SELECT 'not_null:sales.customer_key' AS check_name, count(*) FILTER (WHERE customer_key IS NULL) AS failing_rows FROM fact_sales UNION ALL SELECT 'not_null:sales.shipped_date', count(*) FILTER (WHERE shipped_date IS NULL) FROM fact_sales)")(
    lambda w: quality.not_null(w.fact_sales, ["customer_key", "shipped_date"], "sales")
)
query("q2_unique", f"SELECT 'unique:lineitem.l_orderkey+l_linenumber' AS check_name, {_OK} FROM (SELECT count(*) AS failing_rows FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))")(
    lambda w: quality.unique(w.table("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")
)
query("q3_relationship", f"SELECT 'relationship:sales.customer' AS check_name, {_OK} FROM (SELECT count(*) AS failing_rows FROM sales_order_lines WHERE cast(substr(customer_no, 3) AS bigint) % 17 = 0)")(
    lambda w: quality.relationship(w.sales_order_lines, "customer_no", w.customers.where(F.col("postal_code").cast("bigint") % 17 != 0), "customer_no", "sales.customer")
)


def _declared_sql(checks: list[quality.Check]) -> str:
    parts = []
    for c in checks:
        kind, table, column, parent, key = c
        count = {
            "not_null": f"SELECT count(*) FROM {table} WHERE {column} IS NULL",
            "unique": f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)",
            "relationship": f"SELECT count(*) FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)",
        }[kind]
        parts.append(f"SELECT '{quality.check_name(c)}' AS check_name, ({count}) AS failing_rows")
    return f"SELECT check_name, {_OK} FROM ({' UNION ALL '.join(parts)})"


def declared_tables(w):
    """Tables of the declared checks, and what :func:`quality.declared_checks` takes as counted.

    Facts hold source keys here, as often as the crosswalks have them; for relationships they are counted by key before they meet the
    crosswalks, so no exchange carries a canonical key for each line.
    """
    kept = w.met(numbered=True, apart=True)
    sold, bought = (kept.having(lines=model.repeated(kept.lines, *c)) for c in (["customer_keys", "part_keys"], ["supplier_keys", "part_keys"]))
    plain = lambda df, **keys: df.withColumns({name: F.col(c) for name, c in (keys | {"item_key": "item_no"}).items()})
    facts = {
        "fact_sales": model.fact_sales_order_line(plain(sold.sales_order_lines, customer_key="customer_no"), None, None), "fact_invoice": model.fact_invoice_line(plain(sold.invoice_lines, customer_key="customer_no"), None, None),
        "fact_purchase": model.fact_purchase_order_line(plain(bought.purchase_order_lines, vendor_key="vendor_no"), None, None),
        "fact_inventory": model.fact_inventory_snapshot(plain(model.repeated(kept.positions.where("item_no IS NOT NULL"), "part_keys")), None), "fact_gl": kept.fact_gl,
    }
    counted = {(table, c): model.key_counts(facts[table], c, getattr(w, f"xwalk_{c[:-4]}"), f"canonical_{c}", SOURCE) for kind, table, c, *_ in quality.DECLARED if kind == "relationship" and table in facts}
    names = sorted({c[1] for c in quality.DECLARED} | {c[3] for c in quality.DECLARED if c[3]})
    return {t: facts[t] if t in facts else getattr(w, t) for t in names}, counted


@query("q1_declared", _declared_sql(quality.DECLARED))
def _(w):
    """Every check that the model declares, over all of its tables: of the dimensions together, of each fact by itself."""
    tables, counted = declared_tables(w)
    return quality.declared_checks(tables, quality.DECLARED, counted=counted, apart=tuple(t for t in tables if t.startswith("fact_")))


# tables with faults: lines that repeat their keys, shipping dates that are missing, and items and vendors that aren't there
_FAULTY = [("not_null", "l", "shipped", None, None), ("unique", "l", "line", None, None), ("relationship", "l", "item", "p", "k"), ("relationship", "l", "vendor", "s", "k"), ("unique", "p", "k", None, None)]
_FAULTY_TABLES = """WITH l AS (SELECT l_orderkey || '-' || l_linenumber AS line, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS shipped, l_partkey AS item, CASE WHEN l_linenumber <> 3 THEN l_suppkey END AS vendor FROM lineitem),
    p AS (SELECT p_partkey // 2 AS k FROM part), s AS (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey % 4 <> 0)"""


@query("q3_declared_faults", f"{_FAULTY_TABLES} {_declared_sql(_FAULTY)}")
def _(w):
    """The same over tables with faults of every kind."""
    lines = w.table("lineitem").selectExpr("concat_ws('-', l_orderkey, l_linenumber) AS line", "CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS shipped", "l_partkey AS item", "CASE WHEN l_linenumber <> 3 THEN l_suppkey END AS vendor")
    return quality.declared_checks({"l": lines, "p": w.table("part").selectExpr("p_partkey div 2 AS k"), "s": w.table("supplier").where("s_suppkey % 4 <> 0").selectExpr("s_suppkey AS k")}, _FAULTY)


query("q4_unmapped", "SELECT account, count(*) AS lines FROM gl_entries WHERE account = '1010' OR (account = '1200' AND entry_date < date '1998-01-01') GROUP BY 1")(
    lambda w: quality.unmapped_accounts(model.fact_gl_transaction(w.gl_entries, model.ref_coa_mapping(w.coa).where("target_consolidated_account NOT IN ('GRP-1010', 'GRP-1200')"), SOURCE))
)
query("q5_orders_vs_invoices", "SELECT * FROM (SELECT order_no, filled, coalesce(invoiced, 0) AS invoiced FROM (SELECT order_no, cast(sum(filled_qty) AS bigint) AS filled FROM fact_sales WHERE shipped_date IS NOT NULL AND cancelled_qty = 0 GROUP BY 1) LEFT JOIN (SELECT order_no, cast(sum(invoiced_qty) AS bigint) AS invoiced FROM fact_invoice WHERE line_no <> 5 GROUP BY 1) USING (order_no)) WHERE abs(filled - invoiced) > 0.001")(
    lambda w: quality.orders_vs_invoices(w.fact_sales, w.fact_invoice.where("line_no <> 5"))
)
query("q6_unbalanced", "SELECT journal_no, cast(sum(debit_amt) AS decimal(38,4)) AS debit, cast(sum(credit_amt) AS decimal(38,4)) AS credit FROM fact_gl WHERE NOT (journal_no LIKE 'JS-1%' AND line_no = 2) GROUP BY 1 HAVING abs(sum(debit_amt) - sum(credit_amt)) > 0.01")(
    lambda w: quality.unbalanced_journals(w.fact_gl.where("NOT (journal_no LIKE 'JS-1%' AND line_no = 2)"))
)
query("q7_ledger_vs_book", "SELECT booked, invoiced, abs(cast(booked AS double) / cast(invoiced AS double) - 1) AS gap, abs(cast(booked AS double) / cast(invoiced AS double) - 1) <= 0.02 AS within FROM (SELECT cast(sum(debit_amt) AS decimal(38,4)) AS booked FROM fact_gl WHERE journal_no LIKE 'JS-%' AND account = '1100'), (SELECT cast(sum(revenue_amount) AS decimal(38,4)) AS invoiced FROM fact_invoice)")(
    lambda w: quality.ledger_vs_invoices(w.fact_gl, w.fact_invoice)
)
query("q8_plausible", "SELECT n AS check_name, 'warn' AS severity, CASE WHEN ok THEN 'pass' ELSE 'fail' END AS status, cast(CASE WHEN ok THEN 0 ELSE 1 END AS bigint) AS failing_rows, NULL::varchar AS detail FROM (SELECT 'plausible:gross_margin_pct' AS n, gross_margin_pct BETWEEN 0.18 AND 0.35 AS ok FROM k8 UNION ALL SELECT 'plausible:inventory_turns', inventory_turns BETWEEN 3 AND 8 FROM k8 UNION ALL SELECT 'plausible:gmroi', gmroi BETWEEN 1 AND 4 FROM k8)")(
    lambda w: quality.plausible(marts.kpi_headline(w.facts, rounded=False))
)
query("q9_row_parity", f"SELECT n AS check_name, {_OK} FROM (SELECT 'row_parity:invoice_lines' AS n, abs((SELECT count(*) FROM invoice_lines) - (SELECT count(*) FROM fact_invoice)) AS failing_rows UNION ALL SELECT 'row_parity:gl_entries', abs((SELECT count(*) FROM gl_entries) - (SELECT count(*) FROM fact_gl)))")(
    lambda w: quality.row_parity({"invoice_lines": (w.invoice_lines, w.fact_invoice), "gl_entries": (w.gl_entries, w.fact_gl)})
)
query("q10_missing_entities", "SELECT entity FROM (SELECT DISTINCT p_type AS entity FROM part) WHERE entity NOT IN (SELECT p_type FROM part WHERE p_partkey < 4)")(
    lambda w: quality.missing_entities(w.table("part").select(F.col("p_type").alias("entity")).distinct(), w.table("part").where("p_partkey < 4").select(F.col("p_type").alias("entity")))
)
query("q11_count_parity", "SELECT entity, n_one, n_two FROM (SELECT event_type AS entity, count(*) AS n_one FROM events GROUP BY 1) FULL JOIN (SELECT event_type AS entity, count(*) AS n_two FROM events WHERE event_id % 100 <> 0 AND event_type <> 'view' GROUP BY 1) USING (entity) WHERE n_one IS DISTINCT FROM n_two")(
    lambda w: (lambda e: quality.count_parity(e.groupBy("entity").agg(F.count(F.lit(1)).alias("n")), e.where("event_id % 100 <> 0 AND entity <> 'view'").groupBy("entity").agg(F.count(F.lit(1)).alias("n"))))(w.table("events").select(F.col("event_type").alias("entity"), "event_id"))
)
query(
    "q14_escalations",
    "SELECT source_id, run_no, files, quarantined, rate, min(o) OVER x = 1 AND count(*) OVER x = 3 AS escalate FROM (SELECT *, cast(rate > 0.5 AS int) AS o FROM (SELECT user_id AS source_id, cast(ts AS date) AS run_no, count(*) AS files, cast(count(*) FILTER (WHERE value > 50) AS bigint) AS quarantined, count(*) FILTER (WHERE value > 50)::double / count(*)::double AS rate FROM events GROUP BY 1, 2)) WINDOW x AS (PARTITION BY source_id ORDER BY run_no ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
)(lambda w: quality.escalations(w.table("events").groupBy(F.col("user_id").alias("source_id"), F.to_date("ts").alias("run_no")).agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("value") > 50).alias("quarantined")), 0.5))


query("q14_variance", "SELECT entity, n_source, n_warehouse, abs(n_source - n_warehouse)::double / n_source::double AS variance FROM (SELECT event_type AS entity, count(*) AS n_source, cast(count(*) FILTER (WHERE NOT (event_id % 50 = 0 AND value > 20) AND event_type <> 'view') AS bigint) AS n_warehouse FROM events GROUP BY 1) WHERE abs(n_source - n_warehouse)::double / n_source::double > 0.01")(
    lambda w: (lambda e: quality.variance_escalations(e.groupBy("entity").agg(F.count(F.lit(1)).alias("n")), e.where("NOT (event_id % 50 = 0 AND value > 20) AND entity <> 'view'").groupBy("entity").agg(F.count(F.lit(1)).alias("n"))))(
        w.table("events").select(F.col("event_type").alias("entity"), "event_id", "value")
    )
)


#: Entities whose every declared column is read over all rows; the customers' states are emptied first, so that one fails.
READ = ["items", "customers", "vendors", "invoice_lines"]
_EMPTY = " ".join(
    f"UNION ALL SELECT * FROM (SELECT '{e}', '{f.name}', '{f.dataType.simpleString()}', NULL, 'empty') WHERE (SELECT count({'nullif(state, state)' if (e, f.name) == ('customers', 'state') else f.name}) FROM {e}) = 0"
    for e in READ for f in entity_schema(e)
)


@query(
    "q15_catalog_drift",
    """SELECT 'items' AS "table", 'list_price' AS "column", 'decimal(38,9)' AS type, 'decimal(18,4)' AS actual_type, 'retyped' AS problem UNION ALL SELECT 'items', 'p_partkey', NULL, 'bigint', 'undeclared'
    UNION ALL SELECT * FROM (SELECT 'lineitem', 'l_orderkey+l_linenumber', 'unique', cast(count(*) AS varchar) AS n, 'grain' FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) WHERE n <> '0'
    UNION ALL SELECT * FROM (SELECT 'orders', 'o_custkey', 'unique', cast(count(*) AS varchar) AS n, 'grain' FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)) WHERE n <> '0'
    UNION ALL SELECT * FROM (SELECT 'items', 'item_no', 'unique', cast(count(*) AS varchar) AS n, 'grain' FROM (SELECT 1 FROM items GROUP BY item_no HAVING count(*) > 1)) WHERE n <> '0' """ + _EMPTY,
)
def _(w):
    """The declared columns of items against the frame that the tables give, the declared grain of three tables, and every declared column of four read."""
    rows = [("items", f.name, "decimal(38,9)" if f.name == "list_price" else f.dataType.simpleString()) for f in entity_schema("items")] + [("items", "source_system", "string")]
    drift = quality.catalog_drift(w.spark.createDataFrame(rows, "table string, column string, type string"), w.items.schema, "items")
    for name, frame, grain in (("lineitem", w.table("lineitem"), ["l_orderkey", "l_linenumber"]), ("orders", w.table("orders"), ["o_custkey"]), ("items", w.items, ["item_no"])):
        drift = drift.unionByName(quality.grain_drift(frame, grain, name))
    for e in READ:
        frame = w.customers.withColumn("state", F.nullif("state", F.col("state"))) if e == "customers" else getattr(w, e)
        drift = drift.unionByName(quality.unfilled(frame, [f.name for f in entity_schema(e)], e))
    return drift


#: The declared many-to-one relationships: child, its column, parent, its key.
RELATIONSHIPS = [
    ("dim_item", "item_category_key", "dim_item_category", "item_category_key"), ("dim_ship_to", "customer_key", "dim_customer", "customer_key"), ("fact_inventory", "item_key", "dim_item", "item_key"),
    ("fact_invoice", "customer_key", "dim_customer", "customer_key"), ("fact_invoice", "item_key", "dim_item", "item_key"), ("fact_purchase", "vendor_key", "dim_vendor", "vendor_key"),
    ("fact_purchase", "item_key", "dim_item", "item_key"), ("fact_sales", "customer_key", "dim_customer", "customer_key"), ("fact_sales", "item_key", "dim_item", "item_key"),
]


def _kept_parents(table: str) -> str:
    """All rows of a dimension but those with a key that begins with 0: so that some relationships fail."""
    return f"(SELECT * FROM {table} WHERE {table[4:]}_key NOT LIKE '0%')"


_MANY = " UNION ALL ".join(
    f"SELECT 'unique:{c}.{p}.{k}' AS n, (SELECT count(*) FROM (SELECT 1 FROM {_kept_parents(p)} GROUP BY {k} HAVING count(*) > 1)) AS failing_rows UNION ALL SELECT 'relationship:{c}.{p}', (SELECT count(*) FROM {c} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {k} FROM {_kept_parents(p)}))"
    for c, col, p, k in RELATIONSHIPS
)


@query("q17_many_to_one", f"SELECT n AS check_name, {_OK} FROM ({_MANY})")
def _(w):
    w, out = w.kept(), None
    for child, column, parent, key in RELATIONSHIPS:
        kept = getattr(w, parent).where(~F.col(f"{parent[4:]}_key").startswith("0"))
        checks = quality.many_to_one(getattr(w, child), column, kept, key, f"{child}.{parent}")
        out = checks if out is None else out.unionByName(checks)
    return out


query("q18_stale", "SELECT source_id, entity, updated_at, age_hours FROM (SELECT user_id AS source_id, event_type AS entity, max(ts) AS updated_at, date_diff('microsecond', max(ts), timestamp '2024-02-01 00:00:00') / 3.6e9::double AS age_hours FROM events GROUP BY 1, 2) WHERE age_hours > 72")(
    lambda w: quality.stale(w.table("events").select(F.col("user_id").alias("source_id"), F.col("event_type").alias("entity"), F.col("ts").alias("updated_at")), F.expr("timestamp '2024-02-01 00:00:00'"), 72)
)


# ---- metrics ----------------------------------------------------------------------------------------------------

query("m3_metrics", "SELECT 'open_po_lines' AS metric, cast(count(*) FILTER (WHERE NOT is_received_in_full) AS double) AS value FROM fact_purchase UNION ALL SELECT 'vendors', cast(count(DISTINCT vendor_key) AS double) FROM fact_purchase")(
    lambda w: metrics.evaluate(w.fact_purchase, {"open_po_lines": "count(*) filter (where not is_received_in_full)", "vendors": "count(distinct vendor_key)"})
)
query("m4_population", "SELECT 'invoices' AS metric, cast(1 AS bigint) AS measured, count(*) AS now, count(*) <> 1 AS drifted FROM fact_invoice UNION ALL SELECT 'late', cast(0 AS bigint), count(*), count(*) <> 0 FROM fact_sales WHERE NOT is_on_time")(
    lambda w: metrics.population_drift({"invoices": (w.fact_invoice, 1), "late": (w.fact_sales.where("NOT is_on_time"), 0)})
)
_GOLD = "(" + " UNION ALL ".join(f"SELECT '{k}' AS metric, '{u}' AS unit, cast({k} AS double) AS expected, {t}::double AS tolerance FROM k8" for k, (u, t) in metrics.UNITS.items()) + ")"
query("m6_golden", f"SELECT * FROM {_GOLD}")(lambda w: metrics.golden_cases(marts.kpi_headline(w.facts, rounded=False)))
query("m7_parity", f"SELECT metric, unit, abs(value - expected) <= tolerance OR (unit = 'percent' AND abs(value / 100 - expected) <= tolerance) AS passed FROM (SELECT *, CASE WHEN unit = 'percent' THEN expected * 100 WHEN unit = 'days' THEN expected + 1 ELSE expected END AS value FROM {_GOLD})")(
    lambda w: (lambda g: metrics.parity(g.select("metric", F.expr("CASE WHEN unit = 'percent' THEN expected * 100 WHEN unit = 'days' THEN expected + 1 ELSE expected END").alias("value")), g).select("metric", "unit", "passed"))(metrics.golden_cases(marts.kpi_headline(w.facts, rounded=False)))
)
_ANSWER = "'about ' || format('{:,}', length(text)) || ' characters'"
query("m8_scored_answers", "SELECT conv_id, turn, cast(length(text) AS double) AS value, length(text) > 99 AS correct FROM conversations WHERE role = 'assistant'")(
    lambda w: metrics.score_answers(
        w.table("conversations").where("role = 'assistant'").select("conv_id", "turn", F.when(F.char_length("text") > 99, "long").otherwise("short").alias("metric"), F.concat(F.lit("about "), F.format_number(F.char_length("text"), 0), F.lit(" characters")).alias("answer"), F.lit(1).alias("latency_ms")),
        w.spark.sql("SELECT * FROM VALUES ('long', 'usd', 0D, 1e9D), ('short', 'usd', -10D, 5D) AS t(metric, unit, expected, tolerance)"),
    ).select("conv_id", "turn", "value", "correct")
)
query("m9_summary", "SELECT count(*) AS cases, cast(count(*) FILTER (WHERE value > 50) AS bigint) AS correct, max(event_id) AS max_latency_ms FROM events")(
    lambda w: metrics.evaluation_summary(w.table("events").select((F.col("value") > 50).alias("correct"), F.col("event_id").alias("latency_ms")))
)
_EVIDENCE = [("a", True, None, None), ("b", None, True, None), ("c", None, None, None), ("d", True, True, None), ("e", True, None, False), ("f", None, True, True), ("g", False, True, None)]
query("m10_badge", "SELECT t.served, CASE WHEN gmroi IS NULL THEN 'MOCK' ELSE t.badge END AS badge FROM k8, (VALUES ('a', 'LIVE'), ('b', 'CACHE'), ('c', 'MOCK'), ('d', 'MOCK'), ('e', 'MOCK'), ('f', 'MOCK'), ('g', 'MOCK')) AS t(served, badge)")(
    lambda w: metrics.badge(marts.kpi_headline(w.facts, rounded=False).crossJoin(F.broadcast(w.spark.createDataFrame(_EVIDENCE, "served string, live boolean, cached boolean, mock boolean")))).select("served", "badge")
)
query("m11_answer_score", "SELECT event_id, s AS score, s >= CASE WHEN event_type = 'purchase' THEN 100 ELSE 70 END AS accepted FROM (SELECT event_id, event_type, CASE WHEN value > 10 THEN 40 ELSE 0 END + CASE WHEN user_id % 4 >= 1 THEN 30 ELSE 0 END + CASE WHEN value > 70 THEN 30 ELSE 0 END AS s FROM events)")(
    lambda w: metrics.answer_score(w.table("events").select("event_id", F.when(F.col("event_type") == "purchase", "finance").otherwise("other").alias("domain"), (F.col("value") > 10).alias("guarded"), (F.col("user_id") % 4).alias("row_count"), (F.col("value") > 70).alias("in_tolerance"))).select("event_id", "score", "accepted")
)
# ---- governance -------------------------------------------------------------------------------------------------

_KIND = "CASE event_type WHEN 'click' THEN 'reconciliation_run' WHEN 'error' THEN 'tombstone_batch' WHEN 'view' THEN 'key_scan_missing' ELSE 'exception_disposition' END"
_PAYLOAD = """'{"batch":{"n":' || (user_id % 7) || ',"share":' || (user_id % 8 / 8) || '},"by":["Soci\\u00e9t\\u00e9 ' || (user_id % 3) || '",null]}'"""
_SIG = f"""SELECT substr(sha256('{{"kind":"' || kind || '","payload":' || {_PAYLOAD} || ',"subject":"' || user_id || '"}}'), 1, 16) AS signal_id, kind, cast(user_id AS varchar) AS subject,
    CASE kind WHEN 'reconciliation_run' THEN 43200 WHEN 'tombstone_batch' THEN 21600 WHEN 'key_scan_missing' THEN 86400 ELSE 172800 END::double AS half_life_seconds, max(ts) AS emitted_at FROM (SELECT *, {_KIND} AS kind FROM events) GROUP BY ALL"""


def _signals(w):
    """Signals of a nested payload, whose fields aren't in the order of their names and whose text isn't ASCII."""
    user = F.col("user_id")
    by = F.array(F.concat(F.lit("Société "), user % 3), F.lit(None).cast("string"))
    payload = F.struct(by.alias("by"), F.struct((user % 8 / 8).alias("share"), (user % 7).alias("n")).alias("batch"))
    e = governance.with_signal_id(w.table("events").withColumns({"subject": user.cast("string"), "payload": payload, "kind": F.expr(_KIND)}))
    return governance.post(e.select("signal_id", "kind", "subject", governance.half_life(F.col("kind")).alias("half_life_seconds"), F.col("ts").alias("emitted_at")))


_NOW = "timestamp '{}'"
query("g1_signals", _SIG)(_signals)
_AT = "2024-02-01 00:00:00"
_SAL = f"pow(0.5::double, greatest(0, date_diff('microsecond', emitted_at, timestamp '{_AT}')) / 1e6::double / half_life_seconds)"
query("g2_salience", f"SELECT signal_id, {_SAL} AS salience FROM ({_SIG})")(lambda w: _signals(w).select("signal_id", governance.salience(F.col("emitted_at"), F.col("half_life_seconds"), F.expr(_NOW.format(_AT))).alias("salience")))
query("g3_read", f"SELECT signal_id, kind, subject FROM ({_SIG}) WHERE kind IN ('reconciliation_run', 'key_scan_missing') AND {_SAL} >= 0.001")(
    lambda w: governance.read_signals(_signals(w), F.expr(_NOW.format(_AT)), ["reconciliation_run", "key_scan_missing"], 0.001).select("signal_id", "kind", "subject")
)
query("g4_sweep", f"SELECT kind, cast(count(*) FILTER (WHERE {_SAL} >= 0.0009765625) AS bigint) AS kept, cast(count(*) FILTER (WHERE {_SAL} < 0.0009765625) AS bigint) AS dropped FROM ({_SIG}) GROUP BY 1")(lambda w: governance.swept(_signals(w), F.expr(_NOW.format(_AT))))

_ACTION = "CASE event_id % 6 WHEN 0 THEN 'submit' WHEN 1 THEN 'start_review' WHEN 2 THEN 'approve' WHEN 3 THEN 'lock' WHEN 4 THEN 'reject' ELSE 'withdraw' END"
_TO = "CASE event_id % 6 WHEN 0 THEN 'submitted' WHEN 1 THEN 'under_review' WHEN 2 THEN 'approved' WHEN 3 THEN 'locked' WHEN 4 THEN 'rejected' ELSE 'withdrawn' END"
_ACTOR = "CASE WHEN event_id % 35 = 0 THEN ' ' ELSE 'U' || (event_id % 5) END"
_CONFIRMED = "CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 7 < 3 THEN ' u' || (event_id % 5) ELSE 'v' END"
_OPEN = "SELECT user_id AS claim_id, 'u' || (user_id % 5) AS opened_by FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 10 <> 9"
_MOVES = f"SELECT user_id AS claim_id, event_id AS seq, ts AS moved_at, {_ACTION} AS action, {_TO} AS to_status, {_ACTOR} AS actor, {_CONFIRMED} AS confirmed_by FROM events"


def _opened(w):
    return w.table("events").select(F.col("user_id").alias("claim_id")).distinct().where("claim_id % 10 <> 9").withColumn("opened_by", F.expr("concat('u', claim_id % 5)"))


def _moves(w):
    text = {"action": _ACTION, "to_status": _TO, "actor": _ACTOR, "confirmed_by": _CONFIRMED}
    return w.table("events").select(F.col("user_id").alias("claim_id"), F.col("event_id").alias("seq"), F.col("ts").alias("at"), *(F.expr(e).alias(c) for c, e in text.items()))


def _rule(before: str) -> str:
    """The rule that a move breaks in a state."""
    return f"""CASE WHEN opened_by IS NULL THEN 'UNKNOWN_CLAIM'
        WHEN ({before}, action) NOT IN (('draft', 'submit'), ('draft', 'withdraw'), ('submitted', 'start_review'), ('submitted', 'withdraw'), ('under_review', 'approve'), ('under_review', 'reject'), ('under_review', 'withdraw'), ('approved', 'lock')) THEN 'ILLEGAL_STEP'
        WHEN trim(actor) = '' THEN 'UNNAMED_ACTOR' WHEN action IN ('approve', 'lock') AND lower(trim(actor)) = lower(trim(opened_by)) THEN 'FOUR_EYES'
        WHEN action = 'lock' AND trim(confirmed_by) = '' THEN 'ANONYMOUS_LOCK' WHEN action = 'lock' AND lower(trim(confirmed_by)) = lower(trim(actor)) THEN 'SELF_CONFIRMED' END"""


# move by move: each claim's next move meets the state that the one before left
_REPLAY = f"""(WITH RECURSIVE m AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY moved_at, seq) AS n FROM ({_MOVES}) LEFT JOIN ({_OPEN}) USING (claim_id)),
    walk AS (SELECT *, 'draft' AS before, {_rule("'draft'")} AS rule FROM m WHERE n = 1
    UNION ALL SELECT *, {_rule("before")} AS rule FROM (SELECT m.*, CASE WHEN walk.rule IS NULL THEN walk.to_status ELSE walk.before END AS before FROM walk JOIN m ON m.claim_id = walk.claim_id AND m.n = walk.n + 1))
    SELECT * FROM walk)"""
_STATES = f"""SELECT o.claim_id, o.opened_by, coalesce(l.to_status, 'draft') AS status, CASE WHEN l.to_status = 'locked' THEN l.confirmed_by END AS locked_by, l.moved_at AS changed_at FROM ({_OPEN}) o
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY n DESC) AS k FROM {_REPLAY} WHERE rule IS NULL) l ON l.claim_id = o.claim_id AND l.k = 1"""
query("g5_claims", _STATES)(lambda w: governance.claim_states(_opened(w), _moves(w)))
query("g6_illegal", f"SELECT claim_id, seq, before, action, to_status, actor, rule FROM {_REPLAY} WHERE rule IS NOT NULL")(lambda w: governance.illegal_transitions(_opened(w), _moves(w)))
query(
    "g7_lock_gate",
    f"""SELECT claim_id // 5 AS export_id, bool_and(status = 'locked') AS granted, count(*) AS claims, CASE WHEN bool_and(status = 'locked') THEN sha256('[' || string_agg('{{"claim_id":' || claim_id || ',"status":"' || status || '"}}', ',' ORDER BY claim_id) || ']') END AS content_hash FROM ({_STATES}) GROUP BY 1""",
)(lambda w: governance.lock_gate(governance.claim_states(_opened(w), _moves(w)), _opened(w).select(F.expr("claim_id div 5").alias("export_id"), "claim_id")))
_Q = "trim(regexp_replace(lower(text), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'))"
query("g8_coverage", f"SELECT substr(sha256({_Q}), 1, 12) AS question_hash, {_Q} AS normalized_question, count(*) AS request_count, min(turn) AS first_requested_at, max(turn) AS last_requested_at, array_to_string(list_sort(list(DISTINCT CASE WHEN conv_id % 2 = 0 THEN 'no_model' ELSE 'no_data' END)), ',') AS reasons FROM conversations WHERE role = 'user' GROUP BY 1, 2")(
    lambda w: governance.coverage_queue(w.table("conversations").where("role = 'user'").select(F.col("text").alias("question"), F.expr("CASE WHEN conv_id % 2 = 0 THEN 'no_model' ELSE 'no_data' END").alias("reason"), F.col("turn").alias("at")))
)
query("g9_audit_trail", "SELECT event_id AS id, ts AS \"at\", event_type AS outcome FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")(
    lambda w: governance.audit_trail(w.table("events").select(F.col("event_id").alias("id"), F.col("ts").alias("at"), F.col("event_type").alias("outcome")), 100)
)
query("g9_outcomes", "SELECT event_type AS outcome, count(*) AS n FROM events GROUP BY 1")(lambda w: governance.outcome_counts(w.table("events").select(F.col("event_type").alias("outcome"))))
query("g10_redemptions", "SELECT event_id, CASE WHEN n > 1 THEN 'REPLAY' WHEN value > 80 THEN 'EXPIRED' ELSE 'REDEEMED' END AS verdict FROM (SELECT event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events)")(
    lambda w: governance.redemptions(w.table("events").select("event_id", F.concat_ws(":", "user_id", "event_type").alias("receipt_id"), F.col("ts").alias("redeemed_at"), F.when(F.col("value") > 80, F.col("ts")).otherwise(F.col("ts") + F.expr("interval 1 hour")).alias("expires_at"))).select("event_id", "verdict")
)
query("g11_integrity", "SELECT event_id FROM events WHERE event_id % 50 = 0")(
    lambda w: governance.broken_entries(w.table("events").select("event_id", F.col("props").alias("body"), F.sha2(F.when(F.col("event_id") % 50 == 0, F.concat("props", F.lit(" "))).otherwise(F.col("props")), 256).alias("body_sha256"))).select("event_id")
)
_SUBMITTED = [
    ("SELECT created_at FROM t -- DROP", "OK"), ("DROP TABLE t", "NOT_SELECT"), ("select 1; select 2", "MULTIPLE_STATEMENTS"), ("WITH a AS (DELETE FROM t) SELECT 1", "FORBIDDEN_KEYWORD"), ("select * from read_csv('x')", "FILE_FUNCTION"),
    ("select 'drop';;", "FORBIDDEN_KEYWORD"), ("select replace(a, 'x', 'y'), glob from t", "OK"), ("select set_at from Iceberg_Scan ('x') /* USE */", "FILE_FUNCTION"), (" -- nothing", "EMPTY"), ("(select 1)", "NOT_SELECT"), ("select 1 from t use", "FORBIDDEN_KEYWORD"),
]
query("g12_sql_policy", "SELECT event_id, CASE event_id % 11 " + " ".join(f"WHEN {i} THEN '{v}'" for i, (_, v) in enumerate(_SUBMITTED)) + " END AS verdict FROM events")(
    lambda w: governance.sql_policy(w.table("events").select("event_id", F.array(*(F.lit(t) for t, _ in _SUBMITTED))[(F.col("event_id") % 11).cast("int")].alias("sql"))).select("event_id", "verdict")
)
query("g13_row_cap", "SELECT least(count(*), 5001) AS seen, count(*) > 5000 AS exceeded FROM events")(lambda w: governance.over_cap(w.table("events"), 5000))

_ALLOW = "SELECT vec_id AS doc_id, CASE vec_id % 7 WHEN 0 THEN 'ann' WHEN 1 THEN 'analyst' WHEN 2 THEN 'board' ELSE 'staff' END AS name FROM embeddings"
_NAMES = "SELECT * FROM (VALUES ('ann', 'ann'), ('ann', 'analyst'), ('bob', 'bob'), ('bob', 'staff'), ('eve', 'eve')) AS p(principal, name)"
_GRANTS = f"SELECT DISTINCT principal, doc_id FROM ({_ALLOW}) JOIN ({_NAMES}) USING (name)"
_ASK = "SELECT 'q' || vec_id || p.principal AS query_id, p.principal, embedding AS query FROM embeddings, (VALUES ('ann'), ('bob'), ('eve')) AS p(principal) WHERE vec_id % 50 = 0"


def _grants(w, modulo: int = 7):
    docs = w.table("embeddings").select(F.col("vec_id").alias("doc_id"), F.array(F.expr("CASE vec_id % 7 WHEN 0 THEN 'ann' WHEN 1 THEN 'analyst' WHEN 2 THEN 'board' ELSE 'staff' END")).alias("allow"))
    people = w.spark.sql("SELECT * FROM VALUES ('ann', array('analyst')), ('bob', array('staff')), ('eve', NULL) AS t(principal, roles)")
    return governance.granted_documents(docs, people)


def _asked(w):
    people = w.spark.sql("SELECT * FROM VALUES ('ann'), ('bob'), ('eve') AS t(principal)")
    return w.table("embeddings").where("vec_id % 50 = 0").crossJoin(F.broadcast(people)).select(F.concat(F.lit("q"), "vec_id", "principal").alias("query_id"), "principal", F.col("embedding").alias("query"))


def _hits(w):
    return governance.authorized_nearest(w.table("embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector")), _grants(w), _asked(w))


_HITS = f"SELECT query_id, principal, doc_id, rank FROM (SELECT query_id, q.principal, g.doc_id, row_number() OVER (PARTITION BY query_id ORDER BY list_dot_product(embedding::double[], query::double[]) DESC, g.doc_id) AS rank FROM ({_ASK}) q JOIN ({_GRANTS}) g USING (principal) JOIN embeddings e ON e.vec_id = g.doc_id) WHERE rank <= 10"
query("g14_grants", _GRANTS)(_grants)
query("g15_authorized_knn", f"SELECT query_id, doc_id, cast(rank AS int) AS rank FROM ({_HITS})")(lambda w: _hits(w).select("query_id", "doc_id", "rank"))
query("g16_post_verify", f"SELECT query_id, principal, doc_id, cast(rank AS int) AS rank, CASE WHEN doc_id % 5 = 0 THEN 'POST_VERIFY_REMOVED' ELSE 'EXECUTED' END AS outcome FROM ({_HITS})")(
    lambda w: governance.post_verify(_hits(w), _asked(w), _grants(w).where("doc_id % 5 <> 0"))
)
query(
    "g17_hashed_bag",
    r"""WITH c AS (SELECT doc_id, cast(('0x' || substr(sha256(tok), 15, 2)) AS int) % 64 AS b FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[ \t\n\r\f\x0B]+')) AS tok FROM documents) WHERE tok <> ''), s AS (SELECT doc_id, b, count(*) AS n FROM c GROUP BY 1, 2)
    SELECT doc_id, list(coalesce(n, 0) ORDER BY i) AS vector FROM (SELECT d.doc_id, i, n FROM documents d CROSS JOIN (SELECT unnest(range(64)) AS i) LEFT JOIN s ON s.doc_id = d.doc_id AND s.b = i) GROUP BY 1""",
)(lambda w: governance.hashed_bag(w.spread("documents", "doc_id")))
query("g18_outcomes", f"SELECT query_id, CASE WHEN n IS NULL THEN 'NO_GRANTS' WHEN removed > 0 THEN 'POST_VERIFY_REMOVED' ELSE 'EXECUTED' END AS outcome, coalesce(removed, 0) AS removed FROM ({_ASK}) LEFT JOIN (SELECT query_id, count(*) AS n, cast(count(*) FILTER (WHERE doc_id % 5 = 0) AS bigint) AS removed FROM ({_HITS}) GROUP BY 1) USING (query_id)")(
    lambda w: governance.retrieval_outcomes(_asked(w), governance.post_verify(_hits(w), _asked(w), _grants(w).where("doc_id % 5 <> 0")))
)
