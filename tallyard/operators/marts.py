"""KPI marts: one row each. Ratios are doubles of exact decimal sums; ``rounded`` gives the displayed digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import one_row, ratio, total
from ..functions.scratch import at_once, written

#: Digits shown, half away from zero.
DIGITS = {
    "inventory_turns": 2, "days_inventory_outstanding": 1, "weeks_of_supply": 1, "gmroi": 2, "line_fill_rate": 4, "order_fill_rate": 4, "on_time_delivery_rate": 4, "otif_rate": 4,
    "backorder_rate": 4, "gross_margin_pct": 4, "revenue": 2, "cogs": 2, "dso": 1, "dpo": 1, "cash_conversion_cycle": 1, "close_cycle_days": 1, "same_branch_share": 4, "organic_share": 4,
    "acquired_share": 4, "vendor_fill_rate": 4, "ppv_total": 2, "ppv_pct": 4, "sales_per_fte": 0, "avg_ticket": 2, "orders_per_active_day": 2,
}

KPIS = [
    "gmroi", "inventory_turns", "days_inventory_outstanding", "weeks_of_supply", "gross_margin_pct", "line_fill_rate", "order_fill_rate", "on_time_delivery_rate", "otif_rate", "backorder_rate",
    "vendor_fill_rate", "ppv_pct", "dso", "dpo", "cash_conversion_cycle", "close_cycle_days", "same_branch_share", "organic_share", "acquired_share", "sales_per_fte", "avg_ticket",
]


def shown(mart: DataFrame) -> DataFrame:
    """The mart with each KPI rounded to its displayed digits."""
    return mart.select(*(F.round(c, DIGITS[c]).alias(c) if c in DIGITS else F.col(c) for c in mart.columns))


def _final(mart: DataFrame, rounded: bool) -> DataFrame:
    return shown(mart) if rounded else mart


def narrow(invoices: DataFrame) -> DataFrame:
    """Of the invoice lines all that the marts need, written once for those that share it."""
    return written(invoices.select("customer_key", "location_key", "invoice_no", "invoice_date", "revenue_amount", "cogs_amount", "gross_margin_amount"), "invoices")


def invoice_totals(invoices: DataFrame) -> DataFrame:
    """Everything that five marts need of the invoice lines, in one pass."""
    return invoices.agg(
        F.min("invoice_date").alias("window_start"), F.max("invoice_date").alias("window_end"), total("revenue_amount").alias("revenue"), total("cogs_amount").alias("cogs"),
        total("gross_margin_amount").alias("gross_margin"),
    ).withColumn("window_days", (F.datediff("window_end", "window_start") + 1).cast("long")).withColumn("annualization", F.lit(365.0) / F.col("window_days").cast("double"))


def kpi_window(invoices: DataFrame) -> DataFrame:
    return invoice_totals(invoices).select("window_start", "window_end", "window_days", "annualization")


def average_inventory(snapshots: DataFrame) -> DataFrame:
    """Mean over snapshot dates of the value on hand."""
    by_date = snapshots.groupBy("snapshot_date").agg(total("inventory_value").alias("v"))
    return by_date.agg((F.sum("v").cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("avg_inventory"))


def _inventory() -> dict[str, Column]:
    """Over the totals of invoices and the average inventory."""
    year = lambda c: F.col(c).cast("double") * F.col("annualization") / F.nullif(F.col("avg_inventory"), F.lit(0.0))
    weekly = F.col("cogs").cast("double") / F.col("window_days") * 7
    turns = year("cogs")
    return {
        "avg_inventory": F.col("avg_inventory"), "inventory_turns": turns, "weeks_of_supply": F.col("avg_inventory") / F.nullif(weekly, F.lit(0.0)), "gmroi": year("gross_margin"),
        "days_inventory_outstanding": F.lit(365.0) / F.nullif(turns, F.lit(0.0)),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def kpi_inventory(invoices: DataFrame, snapshots: DataFrame, rounded: bool = True) -> DataFrame:
    return _final(one_row(invoice_totals(invoices), average_inventory(snapshots)).select(*_named(_inventory())), rounded)


def active_lines(lines: DataFrame) -> DataFrame:
    return lines.where("ordered_qty > 0 AND cancelled_qty < ordered_qty")


def kpi_service(lines: DataFrame, rounded: bool = True) -> DataFrame:
    """Line and order service levels, from one aggregation by order; on-time is over shipped orders, on-time-in-full over all."""
    orders = active_lines(lines).groupBy("order_no").agg(
        F.min(F.col("is_line_complete").cast("int")).alias("complete"), F.min(F.col("is_on_time").cast("int")).alias("on_time"), F.bool_and(F.col("shipped_date").isNotNull()).alias("shipped"),
        F.sum(F.least("filled_qty", "ordered_qty")).alias("filled"), F.sum("ordered_qty").alias("ordered"), F.count_if("is_backordered").alias("backordered"), F.count(F.lit(1)).alias("lines"),
    )
    mart = orders.agg(
        ratio(F.sum("filled"), F.sum("ordered")).alias("line_fill_rate"), ratio(F.sum("complete"), F.count(F.lit(1))).alias("order_fill_rate"),
        ratio(F.sum(F.when(F.col("shipped"), F.col("on_time"))), F.count_if("shipped")).alias("on_time_delivery_rate"),
        ratio(F.count_if(F.expr("shipped AND complete = 1 AND on_time = 1")), F.count(F.lit(1))).alias("otif_rate"), ratio(F.sum("backordered"), F.sum("lines")).alias("backorder_rate"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("active_lines"), F.count(F.lit(1)).alias("active_orders"),
    )
    return _final(mart, rounded)


def _books(ledger: DataFrame, closes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Receivables and payables, and the mean days to close."""
    balance = lambda account: total(F.when(F.col("consolidated_account") == account, F.col("net_amount")))
    return ledger.agg(balance("GRP-1100").alias("ar"), balance("GRP-2000").alias("ap")), _close_cycle(closes)


def _close_cycle(closes: DataFrame) -> DataFrame:
    return closes.agg(ratio(F.sum(F.datediff("close_completed_on", "period_end_date")), F.count(F.lit(1))).alias("close_cycle_days"))


def _finance() -> dict[str, Column]:
    """Over the totals of invoices, the average inventory and the books; the cycle adds the *rounded* days of inventory."""
    dio = F.round(_inventory()["days_inventory_outstanding"], 1)
    dso = ratio("ar", "revenue") * 365
    dpo = F.abs(F.col("ap").cast("double")) / F.nullif(F.col("cogs").cast("double"), F.lit(0.0)) * 365
    return {
        "gross_margin_pct": ratio("gross_margin", "revenue"), "revenue": F.col("revenue"), "cogs": F.col("cogs"), "dso": dso, "dpo": dpo, "close_cycle_days": F.col("close_cycle_days"),
        "cash_conversion_cycle": dio + dso - dpo,
    }


def kpi_finance(invoices: DataFrame, snapshots: DataFrame, ledger: DataFrame, closes: DataFrame, rounded: bool = True) -> DataFrame:
    """Margins and cash cycle; the cycle adds the *rounded* days of inventory to unrounded days of sales and payables."""
    both = one_row(invoice_totals(invoices), average_inventory(snapshots), *_books(ledger, closes))
    return _final(both.select(*_named(_finance())), rounded)


def kpi_growth(invoices: DataFrame, locations: DataFrame, rounded: bool = True) -> DataFrame:
    """Shares of revenue at home branches, of branches owned before the window, and of the rest (unknown ones too).

    A customer's home is the branch of the highest revenue; of equal ones, the smallest key.
    """
    return _final(_growth(_places(invoices), kpi_window(invoices).select("window_start"), locations), rounded)


def _places(invoices: DataFrame) -> DataFrame:
    return invoices.where("customer_key IS NOT NULL").groupBy("customer_key", "location_key").agg(total("revenue_amount").alias("r"))


def _growth(parts: DataFrame, window: DataFrame, locations: DataFrame) -> DataFrame:
    """From revenue r by customer_key and location_key, which is all that the shares need; window: one row, window_start."""
    places = locations.select("location_key", "owned_since")
    owned = F.coalesce(F.col("owned_since") < F.col("window_start"), F.lit(False))
    order = F.row_number().over(Window.partitionBy("customer_key").orderBy(F.desc("r"), "location_key"))
    parts = parts.withColumn("home", (order == 1) & F.col("location_key").isNotNull()).join(places, "location_key", "left")
    parts = parts.crossJoin(F.broadcast(window))
    return parts.agg(
        ratio(F.sum(F.when(F.col("home"), F.col("r")).otherwise(0)), F.sum("r")).alias("same_branch_share"),
        ratio(F.sum(F.when(owned, F.col("r")).otherwise(0)), F.sum("r")).alias("organic_share"), ratio(F.sum(F.when(owned, F.lit(0)).otherwise(F.col("r"))), F.sum("r")).alias("acquired_share"),
    )


def kpi_purchasing(purchases: DataFrame, rounded: bool = True) -> DataFrame:
    mart = purchases.agg(
        ratio(F.sum("received_qty"), F.sum("ordered_qty")).alias("vendor_fill_rate"), total("ppv_amount").alias("ppv_total"),
        ratio(F.sum("ppv_amount"), F.sum("received_standard_amount")).alias("ppv_pct"), F.count(F.lit(1)).alias("po_lines"),
    )
    return _final(mart, rounded)


def _activity(invoices: DataFrame, locations: DataFrame, days: DataFrame | None = None) -> tuple[DataFrame, ...]:
    """Numbers of invoices and of days with any, each by a distinct of its own, so that lines aren't expanded; and of people.

    ``days``: a frame with all invoice dates, where there is one shorter than the invoices.
    """
    many = lambda df, c, name: df.where(F.col(c).isNotNull()).select(c).distinct().agg(F.count(F.lit(1)).alias(name))
    return many(invoices, "invoice_no", "invoices"), many(invoices if days is None else days, "invoice_date", "active_days"), locations.agg(F.sum("fte_count").alias("fte"))


def _productivity() -> dict[str, Column]:
    """Over the totals of invoices and the counts of :func:`_activity`."""
    return {
        "sales_per_fte": F.col("revenue").cast("double") * F.col("annualization") / F.nullif(F.col("fte").cast("double"), F.lit(0.0)), "avg_ticket": ratio("revenue", "invoices"),
        "orders_per_active_day": ratio("invoices", "active_days"), "invoices": F.col("invoices"), "active_days": F.col("active_days"),
    }


def kpi_productivity(invoices: DataFrame, locations: DataFrame, rounded: bool = True) -> DataFrame:
    return _final(one_row(invoice_totals(invoices), *_activity(invoices, locations)).select(*_named(_productivity())), rounded)


# ---- states: sums that can be added to and taken from, of which the headline is made -----------------------------

#: Keys of each state's rows; all other columns are sums.
STATE_KEYS = {
    "invoices": ["g", "invoice_date", "customer_key", "location_key", "invoice_no"], "orders": ["order_no"], "inventory": ["snapshot_date"], "purchases": ["one"], "books": ["consolidated_account"],
}
#: Which keys a row of the invoices' state has: the day, the customer at a branch, the invoice.
BY_DAY, BY_PLACE, BY_INVOICE = 0b0111, 0b1001, 0b1110


def states_of(facts: dict[str, DataFrame], by: str | None = None) -> dict[str, DataFrame]:
    """The states of facts (invoices, sales, purchases, inventory, gl): one pass over each.

    Every row has the number of its lines, so that sets (days, invoices, orders) are exact when lines are taken away again.
    ``by``: a column of all facts, whose values' states are made in the same pass; it stays in front of the keys.
    """
    by = [by] if by else []
    n = F.count(F.lit(1)).alias("lines")
    money = [total(c).alias(c) for c in ("revenue_amount", "cogs_amount", "gross_margin_amount")]
    key = ["invoice_date", "customer_key", "location_key", "invoice_no"]
    sets = [[*by, "invoice_date"], [*by, "customer_key", "location_key"], [*by, "invoice_no"]]
    count = lambda c: F.sum(F.col(c).cast("long"))
    return {
        "invoices": facts["invoices"].groupingSets(sets, *by, *key).agg(F.grouping_id().alias("g"), *money, n),
        "orders": active_lines(facts["sales"]).groupBy(*by, "order_no").agg(
            F.count_if("is_line_complete").alias("complete"), F.count_if("is_on_time").alias("on_time"), F.count("shipped_date").alias("shipped"),
            F.sum(F.least("filled_qty", "ordered_qty")).alias("filled"), count("ordered_qty").alias("ordered"), F.count_if("is_backordered").alias("backordered"), n,
        ),
        "inventory": facts["inventory"].groupBy(*by, "snapshot_date").agg(total("inventory_value").alias("inventory_value"), n),
        "purchases": facts["purchases"].groupBy(*by, F.lit(1).alias("one")).agg(
            count("received_qty").alias("received"), count("ordered_qty").alias("ordered"), total("ppv_amount").alias("ppv"), total("received_standard_amount").alias("standard"), n,
        ),
        "books": facts["gl"].groupBy(*by, "consolidated_account").agg(total("net_amount").alias("net"), n),
    }


def merged_states(states: dict[str, DataFrame], added: dict[str, DataFrame] | None = None, removed: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """States with those of new lines added and those of lines that went taken away; rows without lines go.

    The rows of a key may be several in each of them, as where they come from several states: they are summed.
    """
    out = {}
    for name, keys in STATE_KEYS.items():
        sums = [c for c in states[name].columns if c not in keys]
        rows = states[name]
        if added:
            rows = rows.unionByName(added[name])
        if removed:
            rows = rows.unionByName(removed[name].select(*keys, *((-F.col(c)).alias(c) for c in sums)))
        kinds = {f.name: f.dataType for f in states[name].schema}
        out[name] = rows.groupBy(*keys).agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in sums)).where("lines > 0")
    return out


def headline_of(states: dict[str, DataFrame], locations: DataFrame, closes: DataFrame, rounded: bool = True) -> DataFrame:
    """The headline row from states: facts aren't read any more."""
    i = states["invoices"]
    days = i.where(F.col("g") == BY_DAY)
    # a line without a date or number counts for sums, but not as a day or an invoice
    totals = invoice_totals(days)
    parts = i.where(F.col("g") == BY_PLACE).where("customer_key IS NOT NULL").select("customer_key", "location_key", F.col("revenue_amount").alias("r"))
    counts = i.agg(
        F.count_if((F.col("g") == BY_INVOICE) & F.col("invoice_no").isNotNull()).alias("invoices"), F.count_if((F.col("g") == BY_DAY) & F.col("invoice_date").isNotNull()).alias("active_days")
    )
    every = lambda c: F.col(c) == F.col("lines")
    service = states["orders"].agg(
        ratio(F.sum("filled"), F.sum("ordered")).alias("line_fill_rate"), ratio(F.count_if(every("complete")), F.count(F.lit(1))).alias("order_fill_rate"),
        ratio(F.count_if(every("shipped") & every("on_time")), F.count_if(every("shipped"))).alias("on_time_delivery_rate"),
        ratio(F.count_if(every("shipped") & every("complete") & every("on_time")), F.count(F.lit(1))).alias("otif_rate"), ratio(F.sum("backordered"), F.sum("lines")).alias("backorder_rate"),
    )
    purchasing = states["purchases"].agg(ratio(F.sum("received"), F.sum("ordered")).alias("vendor_fill_rate"), ratio(F.sum("ppv"), F.sum("standard")).alias("ppv_pct"))
    balance = lambda account: total(F.when(F.col("consolidated_account") == account, F.col("net")))
    books = states["books"].agg(balance("GRP-1100").alias("ar"), balance("GRP-2000").alias("ap"))
    stock = states["inventory"].agg((F.sum("inventory_value").cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("avg_inventory"))
    row = one_row(
        totals, stock, books, _close_cycle(closes), counts, locations.agg(F.sum("fte_count").alias("fte")), service, _growth(parts, days.agg(F.min("invoice_date").alias("window_start")), locations), purchasing,
    )
    derived = {**_inventory(), **_finance(), **_productivity()}
    marts = row.select(*(derived.get(k, F.col(k)).alias(k) for k in KPIS), "window_start", "window_end", "window_days")
    return _final(marts, rounded)


def kpi_headline(facts: dict[str, DataFrame], rounded: bool = True) -> DataFrame:
    """One row of all 21 KPIs and the window. facts: invoices, sales, purchases, inventory, gl, locations, closes; and, where it
    is at hand, places: the invoices' revenue by customer and location, one row each.

    The sums of invoices by day, which three marts share, and the inventory values by date are written, both at a time; numbers of
    invoices and places are aggregates of their own, and the KPIs are expressions over one row of all aggregates. Where facts
    change, :func:`headline_of` makes the same row of kept states, without the facts.
    """
    i, places = facts["invoices"], facts.get("places")
    by_day = i.groupBy("invoice_date").agg(*(total(c).alias(c) for c in ("revenue_amount", "cogs_amount", "gross_margin_amount")))
    by_date = facts["inventory"].groupBy("snapshot_date").agg(total("inventory_value").alias("inventory_value"))
    days, inventory = at_once(by_date.sparkSession, lambda: written(by_day, "invoices-by-day"), lambda: written(by_date, "inventory-by-date"))
    parts = _places(i) if places is None else places.where("customer_key IS NOT NULL").withColumnRenamed("revenue_amount", "r")
    row = one_row(
        invoice_totals(days), average_inventory(inventory), *_books(facts["gl"], facts["closes"]), *_activity(i, facts["locations"], days), kpi_service(facts["sales"], False),
        _growth(parts, kpi_window(days).select("window_start"), facts["locations"]), kpi_purchasing(facts["purchases"], False),
    )
    derived = {**_inventory(), **_finance(), **_productivity()}
    marts = row.select(*(derived.get(k, F.col(k)).alias(k) for k in KPIS), "window_start", "window_end", "window_days")
    return _final(marts, rounded)
