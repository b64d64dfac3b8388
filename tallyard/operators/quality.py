"""Data-quality checks. Results have one shape: check_name, severity, status, failing_rows, detail."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.keys import ratio, total
from ..functions.scratch import written_apart


def _result(counted: DataFrame, name: str | Column, severity: str = "error", detail: Column | None = None) -> DataFrame:
    """``counted`` has a column failing_rows."""
    name = F.lit(name) if isinstance(name, str) else name
    status = F.when(F.col("failing_rows") > 0, "fail").otherwise("pass")
    return counted.select(name.alias("check_name"), F.lit(severity).alias("severity"), status.alias("status"), F.col("failing_rows").cast("long").alias("failing_rows"), (detail if detail is not None else F.lit(None).cast("string")).alias("detail"))


def not_null(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """One pass for all columns."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    rows = counts.select(F.explode(F.array(*(F.struct(F.lit(f"not_null:{table}.{c}").alias("n"), F.col(c).alias("failing_rows")) for c in columns))).alias("r")).select("r.*")
    return _result(rows, F.col("n"))


def unique(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """Values that stand more than once (nulls aside) count as one failing row each."""
    twice = df.dropna(subset=columns).groupBy(*columns).count().where("count > 1")
    return _result(twice.agg(F.count(F.lit(1)).alias("failing_rows")), f"unique:{table}.{'+'.join(columns)}")


def relationship(child: DataFrame, column: str, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Child values, nulls aside, that no parent has."""
    values = child.where(F.col(column).isNotNull()).select(F.col(column).alias("k"))
    lost = values.join(parent.select(F.col(key).alias("k")).distinct(), "k", "left_anti")
    return _result(lost.agg(F.count(F.lit(1)).alias("failing_rows")), f"relationship:{name}")


#: A declared check: not_null or unique of a table's columns, or relationship of one to a column of a parent.
Check = tuple[str, str, str, str | None, str | None]

#: What the dimensional model declares of its columns, as kind, table, column, parent, parent's column.
DECLARED: list[Check] = [
    *((kind, table, key, None, None) for kind in ("not_null", "unique") for table, key in (
        ("dim_item", "item_key"), ("dim_item_category", "item_category_key"), ("dim_customer", "customer_key"), ("dim_ship_to", "ship_to_key"), ("dim_vendor", "vendor_key"), ("dim_location", "location_key"),
        ("dim_salesperson", "salesperson_key"), ("fact_sales", "sales_order_line_key"), ("fact_invoice", "invoice_line_key"), ("fact_purchase", "purchase_order_line_key"), ("fact_inventory", "inventory_snapshot_key"), ("fact_gl", "gl_transaction_key"),
    )),
    ("not_null", "fact_invoice", "revenue_amount", None, None), ("not_null", "fact_gl", "consolidated_account", None, None), ("not_null", "coa", "target_consolidated_account", None, None),
    ("relationship", "dim_item", "item_category_key", "dim_item_category", "item_category_key"), ("relationship", "dim_ship_to", "customer_key", "dim_customer", "customer_key"),
    ("relationship", "fact_sales", "customer_key", "dim_customer", "customer_key"), ("relationship", "fact_sales", "item_key", "dim_item", "item_key"),
    ("relationship", "fact_invoice", "customer_key", "dim_customer", "customer_key"), ("relationship", "fact_invoice", "item_key", "dim_item", "item_key"),
    ("relationship", "fact_purchase", "vendor_key", "dim_vendor", "vendor_key"), ("relationship", "fact_purchase", "item_key", "dim_item", "item_key"),
    ("relationship", "fact_inventory", "item_key", "dim_item", "item_key"),
]


def check_name(check: Check) -> str:
    kind, table, column, parent, _ = check
    return f"{kind}:{table}.{column}" + (f"->{parent}" if parent else "")


def _packed(v: Column) -> Column:
    """Bytes of a string, other ones for another string: hexadecimal digests of 32 digits as their 16 bytes, which nothing else is packed to."""
    raw = v.cast("binary")
    return F.when(F.octet_length(v) < 16, raw).when((F.octet_length(v) == 32) & (F.lower(F.hex(F.unhex(v))) == v), F.unhex(v)).otherwise(F.concat(raw, F.unhex(F.lit("00"))))


def declared_checks(tables: dict[str, DataFrame], checks: list[Check], severity: str = "error", counted: dict[tuple[str, str], DataFrame] | None = None, apart: tuple[str, ...] = ()) -> DataFrame:
    """All declared checks from one pass over each table and one exchange, however many they are.

    A row becomes (check, value) for each check that its table takes part in, as a child or as a parent, and is counted
    where it is read; then one row for each value of each check is dealt, so a value that most rows share costs no more. Null
    values fail not_null checks alone; a value that stands several times fails a unique check once; each child row
    without a parent fails a relationship.

    Only what can fail is dealt, in few bytes: of not_null checks the nulls, of others what isn't null. Values of unique
    checks travel as hashes of 64 bits; where a hash stands several times, which is rare, a second pass over the tables of
    such checks deals these values themselves.

    ``counted``: (v, n), the values of a table's column and how many rows have them, which take the place of its rows as children
    of relationships. ``apart``: tables that are each checked by themselves, one after the other; what one took of the disk
    is free before the next, and parents are read again for each of them.
    """
    kinds, counted = [c[0] for c in checks], counted or {}

    def rows(numbers: list[int], wanted: Callable[[int, Column, bool], Column]) -> DataFrame:
        """(n, v, children, parents) of these checks as ``wanted`` makes them of a check's number, a value, and whether it is the child's."""
        out = []
        for name, df in tables.items():
            parts, used = [], set()
            for n in numbers:
                kind, table, column, parent, key = checks[n]
                rowwise = table == name and not (kind == "relationship" and (table, column) in counted)
                for c, child in ((column, True),) * rowwise + ((key, False),) * (parent == name):
                    parts.append(wanted(n, F.col(c).cast("string"), child))
                    used.add(c)
            if parts:
                out.append(df.select(*sorted(used)).select(F.inline(F.array_compact(F.array(*parts)))))
        return reduce(DataFrame.unionByName, out)

    row = lambda n, v, child: F.struct(F.lit(n).alias("n"), v.alias("v"), F.lit(int(child)).cast("long").alias("children"), F.lit(int(not child)).cast("long").alias("parents"))

    def first(n: int, v: Column, child: bool) -> Column:
        if kinds[n] == "not_null":
            return F.when(v.isNull(), row(n, F.lit(None).cast("binary"), child))
        return F.when(v.isNotNull(), row(n, F.unhex(F.hex(F.xxhash64(v))) if kinds[n] == "unique" else _packed(v), child))

    kind = F.array(*map(F.lit, kinds))[F.col("n")]

    def failing_of(numbers: list[int]) -> DataFrame:
        """(n, v, failing): what fails of each check, where v is null, and hashes of a unique check that stand several times."""
        dealt = rows(numbers, first)
        for n in numbers:
            if kinds[n] == "relationship" and (values := counted.get(checks[n][1:3])) is not None:
                dealt = dealt.unionByName(values.where("v IS NOT NULL").select(F.lit(n).alias("n"), _packed(F.col("v").cast("string")).alias("v"), F.col("n").cast("long").alias("children"), F.lit(0).cast("long").alias("parents")))
        counts = dealt.groupBy("n", "v").agg(F.sum("children").alias("children"), F.sum("parents").alias("parents"))
        lost = F.when(kind == "not_null", F.col("children")).when((kind != "unique") & (F.col("parents") == 0), F.col("children")).otherwise(0)
        # of a unique check only what may stand several times is kept, beside the sums of all others
        twice = (kind == "unique") & (F.col("children") > 1)
        found = counts.groupBy("n", F.when(twice, F.col("v")).alias("v")).agg(F.sum(lost).alias("failing")).where("v IS NOT NULL OR failing > 0")
        return written_apart(found, "failing")

    groups = [[n for n, c in enumerate(checks) if c[1] not in apart], *([n for n, c in enumerate(checks) if c[1] == name] for name in apart)]
    found = reduce(DataFrame.unionByName, [failing_of(numbers) for numbers in groups if numbers])
    failing = found.where("v IS NULL").select("n", "failing")
    again = found.where("v IS NOT NULL").select("n", F.col("v").alias("h"))
    if hit := sorted(r.n for r in again.select("n").distinct().collect()):  # at most the checks
        values = rows(hit, lambda n, v, child: F.when(v.isNotNull(), row(n, v, child)))
        values = values.withColumn("h", F.unhex(F.hex(F.xxhash64("v")))).join(again, ["n", "h"], "left_semi")
        failing = failing.unionByName(values.groupBy("n", "v").count().where("count > 1").groupBy("n").agg(F.count(F.lit(1)).alias("failing")))
    named = found.sparkSession.createDataFrame([(n, check_name(c)) for n, c in enumerate(checks)], "n int, name string")
    return _result(named.join(failing, "n", "left").select("name", F.coalesce("failing", F.lit(0)).alias("failing_rows")), F.col("name"), severity)


def unmapped_accounts(ledger: DataFrame) -> DataFrame:
    return ledger.where("consolidated_account IS NULL").groupBy("account").agg(F.count(F.lit(1)).alias("lines"))


def orders_vs_invoices(lines: DataFrame, invoices: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Orders whose filled and shipped quantity differs from what was invoiced."""
    filled = lines.where("shipped_date IS NOT NULL AND cancelled_qty = 0").groupBy("order_no").agg(F.sum("filled_qty").alias("filled"))
    billed = invoices.groupBy("order_no").agg(F.sum("invoiced_qty").alias("invoiced"))
    return filled.join(billed, "order_no", "left").withColumn("invoiced", F.coalesce("invoiced", F.lit(0))).where(F.abs(F.col("filled") - F.col("invoiced")) > tolerance)


def unbalanced_journals(ledger: DataFrame, tolerance: float = 0.01) -> DataFrame:
    sums = ledger.groupBy("journal_no").agg(total("debit_amt").alias("debit"), total("credit_amt").alias("credit"))
    return sums.where(F.abs(F.col("debit") - F.col("credit")) > tolerance)


def ledger_vs_invoices(ledger: DataFrame, invoices: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Sales booked in the ledger against the invoice book, with the relative gap."""
    booked = ledger.where("journal_no LIKE 'JS-%' AND account = '1100'").agg(total("debit_amt").alias("booked"))
    both = booked.crossJoin(invoices.agg(total("revenue_amount").alias("invoiced")))
    gap = F.abs(ratio("booked", "invoiced") - 1)
    return both.withColumn("gap", gap).withColumn("within", F.col("gap") <= tolerance)


#: Ranges in which these KPIs are plausible.
PLAUSIBLE = {"gross_margin_pct": (0.18, 0.35), "inventory_turns": (3.0, 8.0), "gmroi": (1.0, 4.0)}


def plausible(headline: DataFrame, ranges: dict[str, tuple[float, float]] = PLAUSIBLE) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(f"plausible:{k}").alias("n"), F.when(F.coalesce(F.col(k).between(a, z), F.lit(False)), 0).otherwise(1).alias("failing_rows")) for k, (a, z) in ranges.items()))
    return _result(headline.select(F.explode(rows).alias("r")).select("r.*"), F.col("n"), "warn")


def row_parity(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows of staging that a fact lost (or gained) by its joins."""
    parts = []
    for name, (staged, fact) in pairs.items():
        both = staged.agg(F.count(F.lit(1)).alias("a")).crossJoin(fact.agg(F.count(F.lit(1)).alias("b")))
        parts.append(both.select(F.lit(f"row_parity:{name}").alias("n"), F.abs(F.col("a") - F.col("b")).alias("failing_rows")))
    return _result(reduce(DataFrame.unionByName, parts), F.col("n"))


def missing_entities(expected: DataFrame, present: DataFrame) -> DataFrame:
    return expected.join(present, "entity", "left_anti")


def count_parity(one: DataFrame, two: DataFrame) -> DataFrame:
    """Entities (entity, n) whose row counts differ between two sources, or that one lacks."""
    both = one.withColumnRenamed("n", "n_one").join(two.withColumnRenamed("n", "n_two"), "entity", "full")
    return both.where(~F.col("n_one").eqNullSafe(F.col("n_two")))


def manifest_check(manifest: DataFrame, files: DataFrame, counts: DataFrame) -> DataFrame:
    """Declared files (name, sha256, rows) whose checksum or row count isn't what was found."""
    found = manifest.join(files.select("name", "file_hash"), "name", "left").join(counts.select("name", "rows_parsed"), "name", "left")
    return found.where(~F.col("sha256").eqNullSafe(F.col("file_hash")) | ~F.col("rows").eqNullSafe(F.col("rows_parsed")))


def store(results: DataFrame, path: str, evaluated_at: Column) -> None:
    results.withColumn("evaluated_at", evaluated_at).write.mode("append").parquet(path)


def escalations(runs: DataFrame, limit: float = 0.005, streak: int = 3) -> DataFrame:
    """Runs (source_id, run_no, files, quarantined) that end ``streak`` runs in a row above the quarantine limit."""
    w = Window.partitionBy("source_id").orderBy("run_no").rowsBetween(1 - streak, 0)
    rate = F.coalesce(ratio("quarantined", "files"), F.lit(0.0))
    over = runs.withColumn("rate", rate).withColumn("over", (F.col("rate") > limit).cast("int"))
    return over.withColumn("escalate", (F.min("over").over(w) == 1) & (F.count(F.lit(1)).over(w) == streak)).drop("over")


def variance_escalations(one: DataFrame, two: DataFrame, limit: float = 0.01) -> DataFrame:
    """Entities (entity, n) whose counts in a source and in the warehouse differ by more than ``limit`` of the source's."""
    both = one.withColumnRenamed("n", "n_source").join(two.withColumnRenamed("n", "n_warehouse"), "entity", "full").na.fill(0, ["n_source", "n_warehouse"])
    variance = F.when(F.col("n_source") == F.col("n_warehouse"), F.lit(0.0)).otherwise(F.coalesce(ratio(F.abs(F.col("n_source") - F.col("n_warehouse")), "n_source"), F.lit(1.0)))
    return both.withColumn("variance", variance).where(F.col("variance") > limit)


def grain_drift(df: DataFrame, grain: list[str], table: str) -> DataFrame:
    """The declared grain of a table, as catalog drift, if rows repeat it: actual_type says how many values do."""
    twice = df.groupBy(*grain).count().where("count > 1").agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    return twice.select(F.lit(table).alias("table"), F.lit("+".join(grain)).alias("column"), F.lit("unique").alias("type"), F.col("n").cast("string").alias("actual_type"), F.lit("grain").alias("problem"))


def catalog_drift(declared: DataFrame, actual: StructType, table: str) -> DataFrame:
    """Declared columns (table, column, type) against a table's schema: missing, retyped or undeclared ones."""
    spark = declared.sparkSession
    have = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in actual], "column string, actual_type string")
    both = declared.where(F.col("table") == table).join(have, "column", "full")
    problem = F.when(F.col("actual_type").isNull(), "missing").when(F.col("type").isNull(), "undeclared").when(F.col("type") != F.col("actual_type"), "retyped")
    return both.select(F.lit(table).alias("table"), "column", "type", "actual_type", problem.alias("problem")).where("problem IS NOT NULL")


def unfilled(frame: DataFrame, columns: list[str], table: str) -> DataFrame:
    """Declared columns that the table has, each read over all rows in one aggregation; those without any value, as drift."""
    have = [f for f in frame.schema if f.name in columns]
    counts = frame.agg(*(F.count(F.col(f.name)).alias(f.name) for f in have))
    each = F.explode(F.array(*(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("n")) for f in have)))
    rows = counts.select(each.alias("c")).where("c.n = 0")
    return rows.select(F.lit(table).alias("table"), "c.column", "c.type", F.lit(None).cast("string").alias("actual_type"), F.lit("empty").alias("problem"))


def many_to_one(child: DataFrame, column: str, parent: DataFrame, key: str, name: str) -> DataFrame:
    """A declared many-to-one relationship: unique on the one side, and every child found."""
    return unique(parent, [key], name).unionByName(relationship(child, column, parent, key, name))


def stale(state: DataFrame, now: Column, hours: float) -> DataFrame:
    """Watermarks (source_id, entity, updated_at) that weren't advanced for longer than ``hours``."""
    last = state.groupBy("source_id", "entity").agg(F.max("updated_at").alias("updated_at"))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("updated_at").cast("timestamp"))) / F.lit(3.6e9)
    return last.withColumn("age_hours", age).where(F.col("age_hours") > hours)
