"""The nine entities derived from the order and event tables at hand, by fixed rules.

Lines are numbered by window, since the tables repeat (order, line) pairs; dates follow from the order date. All
money is decimal. Every frame carries source_system; the SQL of the same rules is in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scratch import written, written_apart

SOURCE = "dealer_one"
#: Size of a table's files up to which its keys are broadcast: some ten million rows, 100 MB in memory.
BROADCAST_BYTES = 16 << 20
#: Bytes of a small table's files for which one task is worth its start.
TASK_BYTES = 1 << 20
#: Bytes of files of order lines from which on they are written in slices, and the slices.
SLICED_BYTES, SLICES = 64 << 20, 4
#: Bytes of such a table's files that one task gets at most: some 200,000 order lines.
DEALT_BYTES = 4 << 20

_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


class Lake:
    """Entities of one folder of tables, built lazily; each is a DataFrame over the whole tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:  # reading a schema is a job
            self._tables[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._tables[name]

    def bounded(self, df: DataFrame, table: str) -> DataFrame:
        """``df``, keys of one row of ``table`` each, to be broadcast if that table's files stay below BROADCAST_BYTES.

        Otherwise the optimizer decides. Without it, small facts may be broadcast to a single task over the keys.
        """
        return F.broadcast(df) if self.size(table) <= BROADCAST_BYTES else df

    def size(self, table: str) -> int:
        """Bytes of a table's files."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.dir}/{table}.parquet")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    def spread(self, table: str, key: str) -> DataFrame:
        """A table to be worked on at length, its rows dealt by ``key`` over all cores if its files can't occupy them.

        A file is read by as many tasks as it has row groups, so a small table in one group is worked on by one core.
        Tasks are as many as the cores, and more where a core's share would exceed DEALT_BYTES, so that a task's memory
        doesn't grow with the table. Tables of which each core gets a full split (``spark.sql.files.maxPartitionBytes``)
        are read as they are: no exchange is added where it would cost.
        """
        rows, cores, size = self.table(table), self.spark.sparkContext.defaultParallelism, self.size(table)
        split = self.spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        n = max(min(cores, size // TASK_BYTES), -(-size // DEALT_BYTES))
        return rows.repartition(n, key) if n > 1 and size < cores * split else rows

    def having(self, **frames: DataFrame) -> Lake:
        """A lake of the same tables with these frames in place of its own of that name."""
        out = type(self)(self.spark, self.dir)
        out._tables = self._tables
        out._built.update(frames)
        return out

    def kept(self, numbered: bool = True, more: tuple[str, ...] = (), apart: bool = False) -> Lake:
        """The same lake with its joined lines written once: for queries that make several entities of them.

        Without ``numbered``, lines have no numbers, which cost a sort of each order's lines: for queries that only sum.
        ``more``: columns of the lines beyond those that the entities are made of. ``apart``: the disk that exchanges take is free
        afterwards, and of large tables only a share of the lines is dealt at a time (:func:`written_apart`).
        """
        columns = [c for c in _LINE_COLUMNS if numbered or c != "line_no"]
        lines = self.lines.select(*columns, *more)
        lines = written_apart(lines, "lines", "l_orderkey", SLICES if self.size("lineitem") > SLICED_BYTES else 1) if apart else written(lines, "lines")
        lines = lines.selectExpr("*", *_LINE_CODES)
        return self.having(lines=lines if numbered else lines.withColumn("line_no", F.lit(None).cast("int")))

    def __getattr__(self, name: str) -> DataFrame:
        make = _RULES.get(name)
        if make is None:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = make(self)
        return self._built[name]


def _branches(lake: Lake) -> DataFrame:
    return lake.table("nation").join(lake.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "concat('BR-', lpad(cast(n_nationkey as string), 2, '0')) AS branch_code", "n_name AS branch_name", "r_name AS region",
        "date_add(date '1990-01-01', n_nationkey * 180) AS owned_since", "5 + n_nationkey AS fte_count",
    )


def _items(lake: Lake) -> DataFrame:
    priced = lake.table("part").withColumn("price", F.col("p_retailprice").cast("decimal(18,2)"))
    return priced.selectExpr(
        f"'{SOURCE}' AS source_system", "concat('I-', p_partkey) AS item_no", "p_name AS description", "p_type AS category", "p_brand AS subcategory", "'EA' AS uom",
        "cast(price * cast(0.76 as decimal(3,2)) as decimal(18,4)) AS unit_cost", "cast(price as decimal(18,4)) AS list_price",
        "CASE WHEN p_size % 10 = 0 THEN 'DISCONTINUED' ELSE 'ACTIVE' END AS item_status", "p_partkey",
    )


def _customers(lake: Lake) -> DataFrame:
    places = lake.table("nation").join(lake.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return lake.table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        f"'{SOURCE}' AS source_system", "concat('C-', c_custkey) AS customer_no", "c_name AS customer_name", "c_mktsegment AS customer_class", "'NET30' AS terms",
        "cast(cast(c_acctbal as decimal(18,2)) as decimal(18,4)) AS credit_limit", "concat('No. ', c_custkey) AS address1", "n_name AS city", "r_name AS state",
        "lpad(cast(c_custkey as string), 8, '0') AS postal_code",
    )


def _vendors(lake: Lake) -> DataFrame:
    return lake.table("supplier").selectExpr(
        f"'{SOURCE}' AS source_system", "concat('V-', s_suppkey) AS vendor_no", "s_name AS vendor_name", "'NET30' AS terms", "cast(s_suppkey % 30 as bigint) AS lead_time_days"
    )


def _salespeople(lake: Lake) -> DataFrame:
    codes = lake.table("orders").selectExpr("o_orderkey % 40 AS k").distinct()
    return codes.selectExpr(
        f"'{SOURCE}' AS source_system", "concat('S-', k) AS salesperson_code", "concat('Rep ', k) AS salesperson_name", "concat('BR-', lpad(cast(k % 25 as string), 2, '0')) AS home_branch"
    )


def _lines(lake: Lake) -> DataFrame:
    """Line items with order, nations and item prices; the base of order, invoice and purchase lines.

    Lines are spread by order, which numbering them asks for too. Orders meet their customers before they meet lines, which
    are several times as many.
    """
    orders = lake.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").join(lake.line_customers, F.col("o_custkey") == F.col("c_custkey"))
    return (
        lake.spread("lineitem", "l_orderkey")
        .withColumn("line_no", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(lake.line_vendors, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(lake.line_items, F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(
            "*", "cast(o_orderdate as date) AS od", "cast(l_quantity as int) AS qty", "cast(l_discount as decimal(4,2)) AS disc", "cast(l_tax as decimal(4,2)) AS tax", *_LINE_CODES
        )
    )


#: Columns of the lines that the entities are made of, but for codes, which are made of keys where lines are read.
_LINE_COLUMNS = ["l_orderkey", "line_no", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus", "o_custkey", "o_orderstatus", "od", "qty", "disc", "tax", "unit_cost", "list_price", "s_nationkey", "c_nationkey"]
_LINE_CODES = [
    "concat('I-', l_partkey) AS item_no", "concat('BR-', lpad(cast(s_nationkey as string), 2, '0')) AS supplier_branch",
    "concat('BR-', lpad(cast(CASE WHEN l_orderkey % 4 = 0 THEN s_nationkey ELSE c_nationkey END as string), 2, '0')) AS branch_code",
]


def _sales_order_lines(lake: Lake) -> DataFrame:
    return (
        lake.lines.withColumn("ordered_qty", F.expr("cast(CASE WHEN l_returnflag = 'R' THEN qty + 3 ELSE qty END as bigint)"))
        .withColumn("filled_qty", F.expr("cast(CASE WHEN o_orderstatus = 'P' AND l_linestatus = 'O' THEN 0 ELSE qty END as bigint)"))
        .withColumn("cancelled_qty", F.expr("CASE WHEN disc = 0.10 THEN ordered_qty ELSE 0 END"))
        .withColumn("shipped_date", F.expr("CASE WHEN l_linestatus = 'F' THEN date_add(od, 1 + 2 * l_linenumber) END"))
        .selectExpr(
            f"'{SOURCE}' AS source_system", "concat('SO-', l_orderkey) AS order_no", "cast(line_no as bigint) AS line_no", "od AS order_date", "concat('C-', o_custkey) AS customer_no", "branch_code",
            "concat('S-', l_orderkey % 40) AS salesperson_code", "item_no", "'EA' AS uom", "ordered_qty", "filled_qty", "cancelled_qty",
            "cast(list_price * (1 - disc) as decimal(18,4)) AS unit_price", "unit_cost", "date_add(od, 7) AS promised_date", "shipped_date",
            "CASE WHEN cancelled_qty > 0 THEN 'CANCELLED' WHEN shipped_date IS NULL THEN 'OPEN' WHEN filled_qty < ordered_qty THEN 'PARTIAL' ELSE 'SHIPPED' END AS order_status",
            "l_orderkey", "o_custkey", "tax",
        )
    )


def _invoice_lines(lake: Lake) -> DataFrame:
    return lake.sales_order_lines.where("shipped_date IS NOT NULL AND filled_qty > 0 AND cancelled_qty = 0").selectExpr(
        "source_system", "concat('INV-', l_orderkey) AS invoice_no", "line_no", "shipped_date AS invoice_date", "order_no", "customer_no", "branch_code", "item_no", "uom",
        "filled_qty AS invoiced_qty", "unit_price", "unit_cost", "cast(cast(filled_qty as int) * cast(0.05 as decimal(4,2)) as decimal(18,4)) AS freight_amt",
        "cast(cast(filled_qty as int) * unit_price * tax as decimal(18,4)) AS tax_amt", "l_orderkey", "o_custkey",
    )


def _purchase_order_lines(lake: Lake) -> DataFrame:
    return lake.lines.withColumn("received_qty", F.expr("cast(CASE WHEN l_returnflag = 'N' THEN greatest(qty - l_linenumber, 0) ELSE qty END as bigint)")).selectExpr(
        f"'{SOURCE}' AS source_system", "concat('PO-', l_orderkey) AS po_no", "cast(line_no as bigint) AS line_no", "od AS po_date", "concat('V-', l_suppkey) AS vendor_no", "supplier_branch AS branch_code",
        "item_no", "'EA' AS uom", "cast(qty as bigint) AS ordered_qty", "received_qty",
        "cast(unit_cost * (1 + tax - cast(0.02 as decimal(4,2))) as decimal(18,4)) AS unit_cost_actual", "unit_cost AS unit_cost_standard",
        "CASE WHEN received_qty > 0 THEN date_add(od, 14) END AS received_date", "l_suppkey",
    )


def _inventory_snapshots(lake: Lake, *more: str) -> DataFrame:
    """Month-end positions; ``more``: columns that an item's lines share."""
    return (
        lake.lines.groupBy(F.last_day(F.col("l_shipdate").cast("date")).alias("snapshot_date"), F.col("supplier_branch").alias("branch_code"), "item_no", "unit_cost", *more)
        .agg(
            F.sum("qty").alias("on_hand_qty"), F.sum(F.expr("CASE WHEN l_returnflag = 'R' THEN qty ELSE 0 END")).alias("allocated_qty"),
            F.sum(F.expr("CASE WHEN l_linestatus = 'O' THEN qty ELSE 0 END")).alias("on_order_qty"), F.sum(F.expr("CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END")).alias("backorder_qty"),
        )
        .selectExpr(
            f"'{SOURCE}' AS source_system", "snapshot_date", "branch_code", "item_no", "on_hand_qty", "allocated_qty", "on_order_qty", "backorder_qty", "unit_cost",
            "cast(cast(on_hand_qty as int) * unit_cost as decimal(18,4)) AS inventory_value", *more,
        )
    )


def _gl_entries(lake: Lake, by_day: bool = False) -> DataFrame:
    """Entries of invoices and bills; ``by_day``: their sums of each day and account, without journals and branches."""
    sales = lake.invoice_lines.groupBy("l_orderkey").agg(
        F.min("invoice_date").alias("d"), F.min("branch_code").alias("branch_code"), F.sum(F.expr("cast(invoiced_qty as int) * unit_price")).cast("decimal(18,2)").cast("decimal(18,4)").alias("x")
    )
    bills = lake.purchase_order_lines.groupBy("l_suppkey", F.last_day("po_date").alias("d"), "branch_code").agg(
        F.sum(F.expr("cast(received_qty as int) * unit_cost_actual")).cast("decimal(18,2)").cast("decimal(18,4)").alias("x")
    )

    if by_day:  # of the keys no more stays than what decides which entries there are
        days = lambda df, key: df.groupBy("d", (F.col(key) % 5).alias(key), F.lit(None).cast("string").alias("branch_code")).agg(F.sum("x").alias("x"))
        sales, bills = days(sales, "l_orderkey"), days(bills, "l_suppkey")

    def entries(df: DataFrame, number: str, legs: list[tuple[str, str, int, str, str, str]]) -> DataFrame:
        """Two lines of each leg (prefix, condition, days after d, debit, credit, description), from one pass over df."""
        line = "struct('{0}' AS prefix, date_add(d, {2}) AS entry_date, '{5}' AS description, cast(%d as bigint) AS line_no, '{%d}' AS account, %s AS debit_amt, %s AS credit_amt)"
        zero = "cast(0 as decimal(18,4))"
        pair = f"array({line % (1, 3, 'x', zero)}, {line % (2, 4, zero, 'x')})"
        lines = ", ".join(f"IF({leg[1]}, {pair.format(*leg)}, array())" for leg in legs)
        rows = df.selectExpr("*", f"explode(concat({lines})) AS e")
        return rows.selectExpr(
            f"'{SOURCE}' AS source_system", f"concat(e.prefix, '-', {number}) AS journal_no", "e.line_no", "e.entry_date", "branch_code", "e.account", "e.description", "e.debit_amt", "e.credit_amt"
        )

    return entries(sales, "l_orderkey", [("JS", "true", 0, "1100", "4000", "sale"), ("JC", "l_orderkey % 5 <> 0", 30, "1010", "1100", "receipt")]).unionByName(
        entries(bills, "l_suppkey, '-', d, '-', branch_code", [("JB", "true", 0, "1200", "2000", "bill"), ("JP", "l_suppkey % 5 <> 0", 30, "2000", "1010", "payment")])
    )


COA_ROWS = """
    ('1010', 'Cash', 'GRP-1010', date '1990-01-01', date '9999-12-31', 'DIRECT', true),
    ('1100', 'Receivables', 'GRP-1100', date '1990-01-01', date '9999-12-31', 'DIRECT', true),
    ('1200', 'Inventory', 'GRP-1200', date '1990-01-01', date '1997-12-31', 'DIRECT', true),
    ('1200', 'Inventory', 'GRP-1210', date '1998-01-01', date '9999-12-31', 'DIRECT', true),
    ('2000', 'Payables', 'GRP-2000', date '1990-01-01', date '9999-12-31', 'DIRECT', true),
    ('2000', 'Payables, old', 'GRP-2999', date '1990-01-01', date '9999-12-31', 'DIRECT', false),
    ('4000', 'Sales', 'GRP-4000', date '1990-01-01', date '9999-12-31', 'ADDBACK', true)
"""
COA_COLUMNS = "source_gl_account, source_account_name, target_consolidated_account, effective_start_date, effective_end_date, mapping_rule_type, active_flag"


def _coa(lake: Lake) -> DataFrame:
    return lake.spark.sql(f"SELECT '{SOURCE}' AS source_company_id, * FROM VALUES {COA_ROWS} AS t({COA_COLUMNS})")


def _close_calendar(lake: Lake) -> DataFrame:
    """Each month of the invoices closes 10 to 20 days after it ends."""
    return lake.invoice_lines.select(F.last_day("invoice_date").alias("period_end_date")).distinct().withColumn("close_completed_on", F.expr("date_add(period_end_date, 10 + month(period_end_date) % 11)"))


_RULES = {
    "line_customers": lambda lake: lake.table("customer").select("c_custkey", "c_nationkey"), "line_vendors": lambda lake: lake.table("supplier").select("s_suppkey", "s_nationkey"),
    "line_items": lambda lake: lake.items.select("p_partkey", "unit_cost", "list_price"), "gl_days": lambda lake: _gl_entries(lake, by_day=True),
    "branches": _branches, "items": _items, "customers": _customers, "vendors": _vendors, "salespeople": _salespeople, "lines": _lines,
    "sales_order_lines": _sales_order_lines, "invoice_lines": _invoice_lines, "purchase_order_lines": _purchase_order_lines,
    "inventory_snapshots": _inventory_snapshots, "positions": lambda lake: _inventory_snapshots(lake, "part_keys"), "gl_entries": _gl_entries, "coa": _coa, "close_calendar": _close_calendar,
}
