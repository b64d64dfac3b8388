"""Chart-ready aggregates and governed views over facts and dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import ratio, total
from .marts import KPIS, active_lines, kpi_window


def _with(fact: DataFrame, dim: DataFrame, key: str, *columns: str) -> DataFrame:
    return fact.join(dim.select(key, *columns), key)


def monthly_revenue_by_region(invoices: DataFrame, locations: DataFrame) -> DataFrame:
    by = _with(invoices, locations, "location_key", "region").groupBy(F.date_format("invoice_date", "yyyy-MM").alias("year_month"), "region")
    return by.agg(total("revenue_amount").alias("revenue")).orderBy("year_month", "region")


def inventory_position_latest(snapshots: DataFrame) -> DataFrame:
    """Positions at the last snapshot date, the most valuable item first.

    The date is looked up first (one value), from the narrow column; the rows of other dates then go where they are read.
    """
    last = snapshots.agg(F.max("snapshot_date")).first()[0]
    latest = snapshots.where(F.col("snapshot_date") == F.lit(last)).groupBy("item_key")
    return latest.agg(F.sum("on_hand_qty").alias("on_hand_qty"), total("inventory_value").alias("inventory_value")).orderBy(F.desc("inventory_value"), "item_key")


def invoice_branch(invoices: DataFrame, locations: DataFrame) -> DataFrame:
    return _with(invoices, locations, "location_key", "branch_name", "region").select("invoice_line_key", "invoice_date", "branch_name", "region", "revenue_amount", "gross_margin_amount")


def margin_by_category(invoices: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue and margin by category; lines are summed by item before they meet the item table."""
    by_item = invoices.groupBy("item_key").agg(total("revenue_amount").alias("r"), total("gross_margin_amount").alias("g"))
    out = _with(by_item, items, "item_key", "category").groupBy("category").agg(total("r").alias("revenue"), total("g").alias("gross_margin"))
    return out.withColumn("gross_margin_pct", ratio("gross_margin", "revenue"))


def inventory_by_category(snapshots: DataFrame, items: DataFrame) -> DataFrame:
    """Value by category of each item's latest snapshot at each location."""
    last = snapshots.groupBy("item_key", "location_key").agg(F.max(F.struct("snapshot_date", "inventory_value")).alias("x"))
    by_item = last.groupBy("item_key").agg(total("x.inventory_value").alias("v"))
    return _with(by_item, items, "item_key", "category").groupBy("category").agg(total("v").alias("inventory_value"))


def _fill() -> Column:
    return ratio(F.sum(F.least("filled_qty", "ordered_qty")), F.sum("ordered_qty"))


def fill_by_branch(lines: DataFrame, locations: DataFrame) -> DataFrame:
    return _with(active_lines(lines), locations, "location_key", "branch_name").groupBy("branch_name").agg(_fill().alias("fill_pct"))


def vendor_fill(purchases: DataFrame, vendors: DataFrame, n: int = 8) -> DataFrame:
    """The n vendors of the highest fill rate."""
    sums = purchases.groupBy("vendor_key").agg(F.sum("received_qty").alias("received"), F.sum("ordered_qty").alias("ordered"))
    by = _with(sums, vendors, "vendor_key", "vendor_no", "vendor_name").groupBy("vendor_no", "vendor_name")
    return by.agg(ratio(F.sum("received"), F.sum("ordered")).alias("fill_pct")).orderBy(F.desc("fill_pct"), "vendor_no").limit(n)


def kpi_long(headline: DataFrame, kpis: list[str] = KPIS) -> DataFrame:
    """One row for each KPI of the headline row, from one scan of it."""
    rows = F.array(*(F.struct(F.lit(i).alias("seq"), F.lit(k).alias("kpi"), F.col(k).cast("double").alias("value")) for i, k in enumerate(kpis, 1)))
    return headline.select(F.explode(rows).alias("r")).select("r.*")


def monthly_revenue(invoices: DataFrame, limit: int = 100) -> DataFrame:
    return invoices.groupBy(F.trunc("invoice_date", "month").alias("month")).agg(total("revenue_amount").alias("revenue")).orderBy("month").limit(limit)


def revenue_by_branch(invoices: DataFrame, locations: DataFrame, limit: int = 50) -> DataFrame:
    by = _with(invoices, locations, "location_key", "branch_name").groupBy("branch_name")
    return by.agg(total("revenue_amount").alias("revenue")).orderBy(F.desc("revenue"), "branch_name").limit(limit)


def headline_tile(headline: DataFrame, kpi: str) -> DataFrame:
    value = F.avg(F.col(kpi).cast("double"))
    return headline.agg(value.alias("value")).withColumn("is_finite", F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf")))


def service_by_branch(lines: DataFrame, locations: DataFrame) -> DataFrame:
    by = _with(active_lines(lines), locations, "location_key", "branch_name").groupBy("branch_name")
    return by.agg(F.count_distinct("order_no").alias("orders"), F.sum(F.least("filled_qty", "ordered_qty")).alias("filled_qty"), F.sum("ordered_qty").alias("ordered_qty"), _fill().alias("fill_rate"))


def efficiency_by_category(invoices: DataFrame, snapshots: DataFrame, items: DataFrame) -> DataFrame:
    """Average inventory, annualised cost of goods, GMROI and turns of each category."""
    sold = invoices.groupBy("item_key").agg(total("cogs_amount").alias("c"), total("gross_margin_amount").alias("g"))
    sold = _with(sold, items, "item_key", "category").groupBy("category").agg(total("c").alias("c"), total("g").alias("g")).crossJoin(F.broadcast(kpi_window(invoices).select("annualization")))
    held = _with(snapshots, items, "item_key", "category").groupBy("category", "snapshot_date").agg(total("inventory_value").alias("v"))
    held = held.groupBy("category").agg((F.sum("v").cast("double") / F.count(F.lit(1))).alias("avg_inventory"))
    both = sold.join(held, "category").withColumn("cogs_year", F.col("c").cast("double") * F.col("annualization")).withColumn("gm_year", F.col("g").cast("double") * F.col("annualization"))
    return both.select("category", "avg_inventory", "cogs_year", ratio("gm_year", "avg_inventory").alias("gmroi"), ratio("cogs_year", "avg_inventory").alias("turns"))


_AGGREGATES = {"SUM": F.sum, "AVG": F.avg, "COUNT": F.count, "MIN": F.min, "MAX": F.max, "COUNT_DISTINCT": F.count_distinct}


def chart(df: DataFrame, group_by: list[str], metrics: Mapping[str, tuple[str, str] | str], limit: int = 1000, max_limit: int = 10_000) -> DataFrame:
    """An ad-hoc chart: metrics are (aggregate, column) or an SQL expression; without metrics, the raw columns."""
    if not 0 < limit <= max_limit:
        raise ValueError(f"row limit must lie in 1..{max_limit}")
    if not metrics:
        return df.select(*group_by).limit(limit)
    columns = []
    for name, m in metrics.items():
        if isinstance(m, str):
            c = F.expr(m)
        elif m[0] not in _AGGREGATES:
            raise ValueError(f"unknown aggregate {m[0]}")
        else:
            c = _AGGREGATES[m[0]](m[1])
            if m[0] == "SUM" and df.schema[m[1]].dataType.typeName() == "decimal":
                c = c.cast("decimal(38,4)")
        columns.append(c.alias(name))
    return df.groupBy(*group_by).agg(*columns).orderBy(*group_by).limit(limit)


def summary(entities: Mapping[str, tuple[DataFrame, str, str | None]]) -> DataFrame:
    """Per entity: a count expression and the span of its date column, if it has one."""
    parts = [
        df.agg(F.expr(count).cast("long").alias("n"), *((F.min(d).cast("date").alias("first_date"), F.max(d).cast("date").alias("last_date")) if d else (F.max(F.lit(None).cast("date")).alias("first_date"), F.max(F.lit(None).cast("date")).alias("last_date"))))
        .select(F.lit(name).alias("entity"), "n", "first_date", "last_date")
        for name, (df, count, d) in entities.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def secured(fact: DataFrame, entitlements: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that each viewer is entitled to; entitlements: viewer and the columns that must match."""
    return fact.join(entitlements.select("viewer", *columns).distinct(), columns)


def lowest_fill(lines: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    sums = active_lines(lines).groupBy("item_key").agg(F.sum(F.least("filled_qty", "ordered_qty")).alias("f"), F.sum("ordered_qty").alias("o"))
    return _with(sums, items, "item_key", "item_no").select("item_no", ratio("f", "o").alias("fill_pct")).orderBy("fill_pct", "item_no").limit(n)


def over_credit_limit(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    sums = invoices.groupBy("customer_key").agg(total("revenue_amount").alias("revenue"))
    return _with(sums, customers, "customer_key", "customer_no", "credit_limit").where("revenue > credit_limit").select("customer_no", "credit_limit", "revenue")


def top_vendors_by_ppv(purchases: DataFrame, vendors: DataFrame, n: int = 10) -> DataFrame:
    sums = purchases.groupBy("vendor_key").agg(total("ppv_amount").alias("ppv_total"))
    return _with(sums, vendors, "vendor_key", "vendor_no").select("vendor_no", "ppv_total").orderBy(F.desc("ppv_total"), "vendor_no").limit(n)


def otif_by_branch(lines: DataFrame, locations: DataFrame) -> DataFrame:
    orders = active_lines(lines).groupBy("location_key", "order_no").agg(
        F.min(F.col("is_line_complete").cast("int")).alias("complete"), F.min(F.col("is_on_time").cast("int")).alias("on_time"), F.bool_and(F.col("shipped_date").isNotNull()).alias("shipped")
    )
    good = F.count_if(F.expr("shipped AND complete = 1 AND on_time = 1"))
    return _with(orders, locations, "location_key", "branch_name").groupBy("branch_name").agg(ratio(good, F.count(F.lit(1))).alias("otif_rate"))


def revenue_by_region_between(invoices: DataFrame, locations: DataFrame, start: str, end: str) -> DataFrame:
    part = invoices.where(F.col("invoice_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return _with(part, locations, "location_key", "region").groupBy("region").agg(total("revenue_amount").alias("revenue"))


def days_of_supply(invoices: DataFrame, snapshots: DataFrame, items: DataFrame) -> DataFrame:
    """Days that the average inventory of each category lasts at the window's rate of sales."""
    return efficiency_by_category(invoices, snapshots, items).select("category", (F.lit(365.0) / F.nullif("turns", F.lit(0.0))).alias("days_of_supply"))


def cash_cycle_by_month(invoices: DataFrame, snapshots: DataFrame, ledger: DataFrame) -> DataFrame:
    """Days of inventory, sales and payables of each month with invoices, and their cycle, none of them rounded.

    Balances are those at the month's end, from the ledger's start on; inventory is the mean over the month's snapshot
    dates. A month without snapshots or cost has no cycle. The running sums are over months, which are few.
    """
    change = lambda account: F.coalesce(total(F.when(F.col("consolidated_account") == account, F.col("net_amount"))), F.lit(0))
    sold = invoices.groupBy(F.last_day("invoice_date").alias("month_end")).agg(total("revenue_amount").alias("revenue"), total("cogs_amount").alias("cogs"))
    books = ledger.groupBy(F.last_day("entry_date").alias("month_end")).agg(change("GRP-1100").alias("ar"), change("GRP-2000").alias("ap"))
    by_date = snapshots.groupBy("snapshot_date").agg(total("inventory_value").alias("v"))
    held = by_date.groupBy(F.last_day("snapshot_date").alias("month_end")).agg((F.sum("v").cast("double") / F.count(F.lit(1))).alias("inventory"))
    so_far = Window.orderBy("month_end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    months = sold.join(books, "month_end", "full").withColumns({c: F.sum(c).over(so_far).cast("decimal(38,4)") for c in ("ar", "ap")}).where("revenue IS NOT NULL").join(held, "month_end", "left")
    days = F.dayofmonth("month_end").cast("double")
    rates = months.select("month_end", (F.col("inventory") / F.nullif(F.col("cogs").cast("double"), F.lit(0.0)) * days).alias("dio"), (ratio("ar", "revenue") * days).alias("dso"), (F.abs(ratio("ap", "cogs")) * days).alias("dpo"))
    return rates.withColumn("cash_conversion_cycle", F.col("dio") + F.col("dso") - F.col("dpo")).orderBy("month_end")
