"""The dimensional model: crosswalks, dimensions, reference tables and facts.

Inner joins drop what has no key, silently; ``quality.row_parity`` reports it. Joins carry no hints: the optimizer
broadcasts a dimension only if its size, checked at run time, is below the limit, and splits hot keys otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.intervals import valid_at
from ..functions.keys import amount, sk


def staging(sources: Iterable[DataFrame]) -> DataFrame:
    """The staging layers of several sources as one frame; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def staged(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The staging boundary: canonical name -> source column, nothing else passes."""
    return df.select(*(F.col(source).alias(name) for name, source in columns.items()))


def crosswalk(df: DataFrame, key: str, what: str) -> DataFrame:
    """(source_system, source_key) -> canonical_<what>_key of a master table."""
    return df.select("source_system", F.col(key).alias("source_key"), sk("source_system", key).alias(f"canonical_{what}_key"))


def crosswalk_location(branches: DataFrame, as_of: Column) -> DataFrame:
    """Branches are shared by the group: the key is that of the code alone. ``as_of`` is the load stamp."""
    return branches.select(F.lit("group").alias("source_system"), F.col("branch_code").alias("source_key"), sk("branch_code").alias("canonical_location_key"), as_of.alias("loaded_at"))


def matched(df: DataFrame, key: Column, xwalk: DataFrame, company: str, name: str) -> DataFrame:
    """``df`` with the number of rows that a crosswalk has for ``key``: lines that meet ``df`` need not meet the crosswalk."""
    n = xwalk.where(F.col("source_system") == company).groupBy(F.col("source_key").alias("_key")).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    return df.withColumn("_key", key).join(n, "_key", "left").withColumn(name, F.coalesce("_n", F.lit(0))).drop("_key", "_n")


def repeated(lines: DataFrame, *counts: str) -> DataFrame:
    """Lines as often as joins with the crosswalks of these counts (:func:`matched`) would give them: once, as a rule."""
    times = reduce(lambda a, b: a * b, (F.col(c) for c in counts))
    return lines.select("*", F.explode(F.array_repeat(F.lit(True), times)).alias("_time")).drop("_time")


def key_counts(fact: DataFrame, key: str, xwalk: DataFrame, canonical: str, company: str) -> DataFrame:
    """(v, n): how many rows of a fact have each canonical key, of a fact that holds source keys as ``key`` and its rows as often
    as the crosswalk has them (:func:`repeated`). Rows are counted before they meet the crosswalk, where both are dealt by key."""
    n = fact.groupBy(F.col(key).alias("source_key")).agg(F.count(F.lit(1)).alias("n"))
    times = F.count(F.lit(1)).over(Window.partitionBy("source_key"))
    x = xwalk.where(F.col("source_system") == company).select("source_key", F.col(canonical).alias("v"), times.alias("_times"))
    return n.join(x.hint("merge"), "source_key").select("v", F.expr("n div _times").alias("n"))


def _keyed(df: DataFrame, xwalk: DataFrame | None, key: str, canonical: str, name: str) -> DataFrame:
    """``df`` with the key that the crosswalk gives; without a crosswalk, ``df`` has it already."""
    if xwalk is None:
        return df
    x = xwalk.select(F.col("source_system"), F.col("source_key").alias(key), F.col(canonical).alias(name))
    return df.join(x, ["source_system", key])


def dim_customer(customers: DataFrame, xwalk: DataFrame) -> DataFrame:
    return _keyed(customers, xwalk, "customer_no", "canonical_customer_key", "customer_key")


def dim_item_category(items: DataFrame) -> DataFrame:
    return items.where("category IS NOT NULL").select(sk("category", F.coalesce("subcategory", F.lit("-"))).alias("item_category_key"), "category", "subcategory").distinct()


def dim_item(items: DataFrame, xwalk: DataFrame, categories: DataFrame, null_safe: bool = False) -> DataFrame:
    """Items with their category key; a null subcategory finds none unless ``null_safe``."""
    keyed = _keyed(items, xwalk, "item_no", "canonical_item_key", "item_key")
    c = categories.select("item_category_key", F.col("category").alias("_c"), F.col("subcategory").alias("_s"))
    same = F.col("subcategory").eqNullSafe(F.col("_s")) if null_safe else F.col("subcategory") == F.col("_s")
    return keyed.join(c, (F.col("category") == F.col("_c")) & same, "left").drop("_c", "_s")


def dim_vendor(vendors: DataFrame, xwalk: DataFrame) -> DataFrame:
    return _keyed(vendors, xwalk, "vendor_no", "canonical_vendor_key", "vendor_key")


def dim_location(branches: DataFrame) -> DataFrame:
    return branches.select(sk("branch_code").alias("location_key"), "branch_code", "branch_name", "region", "owned_since", "fte_count")


def dim_salesperson(salespeople: DataFrame, xwalk: DataFrame, locations: DataFrame) -> DataFrame:
    keyed = _keyed(salespeople, xwalk, "salesperson_code", "canonical_salesperson_key", "salesperson_key")
    places = locations.select("location_key", F.col("branch_code").alias("home_branch"))
    return keyed.join(places, "home_branch", "left").withColumn("home_location_key", F.coalesce("location_key", sk("home_branch"))).drop("location_key")


def dim_ship_to(customers: DataFrame, xwalk: DataFrame, scoped: bool = False) -> DataFrame:
    """One address a customer; the key has no source system unless ``scoped``."""
    keyed = _keyed(customers, xwalk, "customer_no", "canonical_customer_key", "customer_key")
    parts = [F.lit("ship_to"), *(["source_system"] if scoped else []), "customer_no"]
    return keyed.select(sk(*parts).alias("ship_to_key"), "customer_key", F.col("customer_name").alias("ship_to_name"), "address1", "city", "state", "postal_code")


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The day spine from ``start`` to ``end``; day_of_week is 0 on Sundays, weeks start on Mondays."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("date_key"))
    d = F.col("date_key")
    return days.select(
        d, F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.date_format(d, "yyyy-MM").alias("year_month"), F.dayofmonth(d).alias("day"),
        (F.dayofweek(d) - 1).alias("day_of_week"), F.trunc(d, "week").alias("week_start"), F.trunc(d, "month").alias("month_start"),
    )


def ref_coa_mapping(coa: DataFrame) -> DataFrame:
    return coa.select(
        "source_company_id", F.col("source_gl_account").cast("string").alias("source_gl_account"), "source_account_name", "target_consolidated_account",
        F.col("effective_start_date").cast("date").alias("effective_start_date"), F.col("effective_end_date").cast("date").alias("effective_end_date"),
        "mapping_rule_type", F.col("active_flag").cast("boolean").alias("active_flag"),
    )


def coa_overlaps(coa: DataFrame) -> DataFrame:
    """Active windows of one account that overlap the next one, which would repeat ledger lines."""
    w = Window.partitionBy("source_company_id", "source_gl_account").orderBy("effective_start_date", "effective_end_date")
    return coa.where("active_flag").withColumn("next_start", F.lead("effective_start_date").over(w)).where("next_start <= effective_end_date")


def ref_price_list(items: DataFrame, xwalk: DataFrame, loaded_at: Column) -> DataFrame:
    """List prices, valid from the load on and open-ended."""
    keyed = _keyed(items.where("list_price IS NOT NULL"), xwalk, "item_no", "canonical_item_key", "item_key")
    return keyed.select("item_key", "item_no", "uom", "list_price", loaded_at.cast("date").alias("effective_start_date"), F.lit("9999-12-31").cast("date").alias("effective_end_date"))


def fact_sales_order_line(lines: DataFrame, customers: DataFrame | None, items: DataFrame | None) -> DataFrame:
    """Order lines; customers and items are the crosswalks."""
    keyed = _keyed(_keyed(lines, customers, "customer_no", "canonical_customer_key", "customer_key"), items, "item_no", "canonical_item_key", "item_key")
    filled = F.least("filled_qty", "ordered_qty")
    return keyed.select(
        sk("source_system", "order_no", "line_no").alias("sales_order_line_key"), "source_system", "order_no", "line_no", "order_date", "customer_key", "item_key",
        sk("branch_code").alias("location_key"), sk("source_system", "salesperson_code").alias("salesperson_key"), "ordered_qty", "filled_qty", "cancelled_qty", "unit_price", "unit_cost",
        amount("ordered_qty", "unit_price").cast("decimal(29,4)").alias("ordered_amount"), amount(filled, "unit_price").cast("decimal(29,4)").alias("filled_amount"),
        "promised_date", "shipped_date", "order_status", F.coalesce(F.col("shipped_date") <= F.col("promised_date"), F.lit(False)).alias("is_on_time"),
        (F.col("filled_qty") >= F.col("ordered_qty")).alias("is_line_complete"), F.expr("filled_qty < ordered_qty AND cancelled_qty < ordered_qty").alias("is_backordered"),
    )


def fact_invoice_line(lines: DataFrame, customers: DataFrame | None, items: DataFrame | None) -> DataFrame:
    keyed = _keyed(_keyed(lines, customers, "customer_no", "canonical_customer_key", "customer_key"), items, "item_no", "canonical_item_key", "item_key")
    return keyed.select(
        sk("source_system", "invoice_no", "line_no").alias("invoice_line_key"), "source_system", "invoice_no", "line_no", "invoice_date", "order_no", "customer_key", "item_key",
        sk("branch_code").alias("location_key"), "invoiced_qty", "unit_price", "unit_cost", amount("invoiced_qty", "unit_price").cast("decimal(29,4)").alias("revenue_amount"),
        amount("invoiced_qty", "unit_cost").cast("decimal(29,4)").alias("cogs_amount"), amount("invoiced_qty", F.col("unit_price") - F.col("unit_cost")).cast("decimal(30,4)").alias("gross_margin_amount"),
        "freight_amt", "tax_amt",
    )


def fact_purchase_order_line(lines: DataFrame, vendors: DataFrame | None, items: DataFrame | None) -> DataFrame:
    keyed = _keyed(_keyed(lines, vendors, "vendor_no", "canonical_vendor_key", "vendor_key"), items, "item_no", "canonical_item_key", "item_key")
    return keyed.select(
        sk("source_system", "po_no", "line_no").alias("purchase_order_line_key"), "source_system", "po_no", "line_no", "po_date", "vendor_key", "item_key", sk("branch_code").alias("location_key"),
        "ordered_qty", "received_qty", "unit_cost_actual", "unit_cost_standard", "received_date",
        amount("received_qty", F.col("unit_cost_actual") - F.col("unit_cost_standard")).cast("decimal(30,4)").alias("ppv_amount"),
        amount("received_qty", "unit_cost_standard").cast("decimal(29,4)").alias("received_standard_amount"),
        F.col("received_date").isNotNull().alias("is_received"), (F.col("received_qty") >= F.col("ordered_qty")).alias("is_received_in_full"),
    )


def fact_inventory_snapshot(snapshots: DataFrame, items: DataFrame | None, scoped: bool = False) -> DataFrame:
    """Month-end positions; the key has no source system unless ``scoped``."""
    keyed = _keyed(snapshots, items, "item_no", "canonical_item_key", "item_key")
    parts = [*(["source_system"] if scoped else []), "snapshot_date", "branch_code", "item_no"]
    return keyed.select(
        sk(*parts).alias("inventory_snapshot_key"), "source_system", "snapshot_date", sk("branch_code").alias("location_key"), "item_key",
        "on_hand_qty", "allocated_qty", "on_order_qty", "backorder_qty", "unit_cost", "inventory_value",
    )


def fact_gl_transaction(entries: DataFrame, coa: DataFrame, company: str, by_bins: bool = False) -> DataFrame:
    """Ledger lines mapped to the group's accounts by the window that holds at the entry date.

    A join on the account, with the window as a residual; a company's chart of accounts has hundreds of rows, and
    the optimizer broadcasts it as long as it stays under the size limit. Lines that nothing maps stay, unmapped.
    by_bins: for charts beyond that limit, lines and windows meet by account and bin of days, so that an account which
    most lines share is cut by time.
    """
    m = coa.where((F.col("source_company_id") == company) & F.col("active_flag")).select(
        F.col("source_gl_account").alias("_account"), F.col("target_consolidated_account").alias("consolidated_account"), "mapping_rule_type", "effective_start_date", "effective_end_date"
    )
    if by_bins:
        joined = valid_at(entries, m.withColumnRenamed("_account", "account"), "account", "entry_date", "effective_start_date", "effective_end_date")
    else:
        held = F.col("entry_date").between(F.col("effective_start_date"), F.col("effective_end_date"))
        joined = entries.join(m, (F.col("account") == F.col("_account")) & held, "left")
    return joined.select(
        sk("source_system", "journal_no", "line_no").alias("gl_transaction_key"), "source_system", "journal_no", "line_no", "entry_date", sk("branch_code").alias("location_key"), "account",
        "consolidated_account", "mapping_rule_type", "description", "debit_amt", "credit_amt", (F.col("debit_amt") - F.col("credit_amt")).cast("decimal(19,4)").alias("net_amount"),
    )
