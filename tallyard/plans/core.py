"""Queries of the dimensional model (c), the KPI marts (k) and the charts (b)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.intervals import valid_at
from ..functions.scratch import at_once, written
from ..operators import bi, marts, model
from ..sources.shape import SOURCE
from .oracle import SK
from .registry import query

D = "cast({} AS double)"
STAMP = "timestamp '2020-01-01 00:00:00'"

query("c0_surrogate_key", f"SELECT item_no, {SK('source_system', 'item_no', 'nullif(subcategory, subcategory)')} AS item_key FROM items")(
    lambda w: w.items.select("item_no", model.sk("source_system", "item_no", F.nullif("subcategory", F.col("subcategory"))).alias("item_key"))
)


@query("c1_staging_union", "SELECT source_system, count(*) AS n, cast(count(extra) AS bigint) AS with_extra FROM (SELECT source_system, customer_no, NULL AS extra FROM customers UNION ALL SELECT 'dealer_two', customer_no, city FROM customers) GROUP BY 1")
def _(w):
    one = w.customers.select("source_system", "customer_no")
    two = w.customers.select(F.lit("dealer_two").alias("source_system"), "customer_no", F.col("city").alias("extra"))
    return model.staging([one, two]).groupBy("source_system").agg(F.count(F.lit(1)).alias("n"), F.count("extra").alias("with_extra"))


_STAGED = {
    "items": "source_system, item_no, description, category, subcategory, uom, unit_cost, list_price, item_status", "salespeople": "source_system, salesperson_code, salesperson_name, home_branch",
    "customers": "source_system, customer_no, customer_name, customer_class, terms, credit_limit, city, state", "vendors": "source_system, vendor_no, vendor_name, terms, lead_time_days",
    "sales_order_lines": "source_system, order_no, line_no, order_date, customer_no, branch_code, salesperson_code, item_no, ordered_qty, filled_qty, cancelled_qty, unit_price, promised_date, shipped_date, order_status",
    "purchase_order_lines": "source_system, po_no, line_no, po_date, vendor_no, branch_code, item_no, ordered_qty, received_qty, unit_cost_actual, unit_cost_standard, received_date",
    "invoice_lines": "source_system, invoice_no, line_no, invoice_date, order_no, customer_no, branch_code, item_no, invoiced_qty, unit_price, unit_cost, freight_amt, tax_amt",
    "inventory_snapshots": "source_system, snapshot_date, branch_code, item_no, on_hand_qty, allocated_qty, on_order_qty, backorder_qty, unit_cost, inventory_value",
    "gl_entries": "source_system, journal_no, line_no, entry_date, branch_code, account, description, debit_amt, credit_amt",
}
for _name, _columns in _STAGED.items():
    query(f"c2_stg_{_name}", f"SELECT {_columns} FROM {_name}")(lambda w, n=_name, c=_columns: model.staged(getattr(w, n), {x: x for x in c.split(", ")}))

for _name in ("customer", "item", "vendor", "salesperson"):
    query(f"c3_xwalk_{_name}", f"SELECT * FROM xwalk_{_name}")(lambda w, n=_name: getattr(w, f"xwalk_{n}"))

query("c4_xwalk_location", f"SELECT 'group' AS source_system, branch_code AS source_key, {SK('branch_code')} AS canonical_location_key, {STAMP} AS loaded_at FROM branches")(
    lambda w: model.crosswalk_location(w.branches, F.expr("timestamp_ntz '2020-01-01 00:00:00'"))
)
query("c5_dim_customer", "SELECT * FROM dim_customer")(lambda w: w.dim_customer)
query("c6_dim_item_category", "SELECT * FROM dim_item_category")(lambda w: w.dim_item_category)
query("c7_dim_item", "SELECT * EXCLUDE (p_partkey) FROM dim_item")(lambda w: w.dim_item.drop("p_partkey"))
query("c8_dim_vendor", "SELECT * FROM dim_vendor")(lambda w: w.dim_vendor)
query("c9_dim_salesperson", "SELECT * FROM dim_salesperson")(lambda w: w.dim_salesperson)
query("c10_dim_ship_to", "SELECT * FROM dim_ship_to")(lambda w: w.dim_ship_to)
query("c11_dim_location", "SELECT * FROM dim_location")(lambda w: w.dim_location)


@query(
    "c12_dim_date",
    """SELECT d.date_key, cast(extract(year FROM d.date_key) AS int) AS year, cast(extract(quarter FROM d.date_key) AS int) AS quarter, cast(extract(month FROM d.date_key) AS int) AS month, strftime(d.date_key, '%Y-%m') AS year_month,
    cast(extract(day FROM d.date_key) AS int) AS day, cast(extract(dow FROM d.date_key) AS int) AS day_of_week, cast(date_trunc('week', d.date_key) AS date) AS week_start, cast(date_trunc('month', d.date_key) AS date) AS month_start, count(invoice_no) AS invoice_lines
    FROM (SELECT cast(unnest(generate_series(date '1995-01-01', date '1995-12-31', interval 1 day)) AS date) AS date_key) d LEFT JOIN invoice_lines i ON i.invoice_date = d.date_key GROUP BY ALL""",
)
def _(w):
    days = model.dim_date(w.spark, "1995-01-01", "1995-12-31")
    lines = w.invoice_lines.groupBy(F.col("invoice_date").alias("date_key")).agg(F.count(F.lit(1)).alias("invoice_lines"))
    return days.join(lines, "date_key", "left").withColumn("invoice_lines", F.coalesce("invoice_lines", F.lit(0)))


@query("c13_coa_usage", "SELECT source_gl_account, target_consolidated_account, effective_start_date, active_flag, count(journal_no) AS entries FROM coa LEFT JOIN gl_entries ON account = source_gl_account AND entry_date BETWEEN effective_start_date AND effective_end_date GROUP BY ALL")
def _(w):
    """Entries are counted by account and day before they meet the chart: an account that most entries share is no task of its own."""
    coa = model.ref_coa_mapping(w.coa)
    used = w.gl_entries.groupBy("account", "entry_date").agg(F.count("journal_no").alias("n"))
    on = (F.col("account") == F.col("source_gl_account")) & F.col("entry_date").between(F.col("effective_start_date"), F.col("effective_end_date"))
    return coa.join(used, on, "left").groupBy("source_gl_account", "target_consolidated_account", "effective_start_date", "active_flag").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("entries"))


query("c14_price_list", "SELECT item_key, item_no, uom, list_price, date '2020-01-01' AS effective_start_date, date '9999-12-31' AS effective_end_date FROM dim_item WHERE list_price IS NOT NULL")(
    lambda w: model.ref_price_list(w.items, w.xwalk_item, F.lit("2020-01-01"))
)
query("c15_fact_sales", "SELECT * FROM fact_sales")(lambda w: w.fact_sales)
query("c16_fact_invoice", "SELECT * FROM fact_invoice")(lambda w: w.fact_invoice)
query("c17_fact_purchase", "SELECT * FROM fact_purchase")(lambda w: w.fact_purchase)
query("c18_fact_inventory", "SELECT * FROM fact_inventory")(lambda w: w.fact_inventory)
query("c19_gl_bins", "SELECT * FROM fact_gl")(
    lambda w: model.fact_gl_transaction(written(w.gl_entries, "gl-entries"), model.ref_coa_mapping(w.coa), SOURCE, by_bins=True)  # read twice, to be counted and to be joined
)


@query(
    "c14_price_at",
    """SELECT l_orderkey, l_linenumber, cast(l_shipdate AS date) AS shipped_on, l_partkey, k, size FROM lineitem LEFT JOIN (SELECT p_partkey, k, p_size + k AS size, date '1992-01-01' + cast(k * 500 + p_partkey % 50 AS int) AS a,
    date '1992-01-01' + cast(k * 500 + p_partkey % 50 + 399 + CASE WHEN p_partkey % 10 = 0 THEN 200 ELSE 0 END AS int) AS z FROM part, (SELECT unnest(range(6))::int AS k)) ON p_partkey = l_partkey AND cast(l_shipdate AS date) BETWEEN a AND z""",
)
def _(w):
    """What was listed for an item on the day a line was shipped: windows with gaps, and for some items overlaps."""
    spread = w.table("part").select("p_partkey", "p_size", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
    first = F.col("k") * 500 + (F.col("p_partkey") % 50).cast("int")
    windows = spread.select(
        F.col("p_partkey").alias("l_partkey"), "k", (F.col("p_size") + F.col("k")).alias("size"), F.date_add(F.lit("1992-01-01").cast("date"), first).alias("a"),
        F.date_add(F.lit("1992-01-01").cast("date"), first + F.when(F.col("p_partkey") % 10 == 0, 599).otherwise(399)).alias("z"),
    )
    lines = w.table("lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped_on"), "l_partkey")
    return valid_at(lines, windows, "l_partkey", "shipped_on", "a", "z").drop("a", "z")


query("c19_gl", "SELECT * FROM fact_gl")(lambda w: w.fact_gl)

query("k1_window", "SELECT * FROM w")(lambda w: marts.kpi_window(w.fact_invoice))
query("k2_inventory", "SELECT * FROM k2")(lambda w: marts.kpi_inventory(w.fact_invoice, w.fact_inventory, rounded=False))
query("k3_service", "SELECT * FROM k3")(lambda w: marts.kpi_service(w.fact_sales, rounded=False))
query("k4_finance", "SELECT * FROM k4")(lambda w: (lambda f: marts.kpi_finance(marts.narrow(f["invoices"]), f["inventory"], f["gl"], f["closes"], rounded=False))(w.facts))
query("k5_growth", "SELECT * FROM k5")(lambda w: marts.kpi_growth(marts.narrow(w.fact_invoice), w.dim_location, rounded=False))
query("k6_purchasing", "SELECT * FROM k6")(lambda w: marts.kpi_purchasing(w.fact_purchase, rounded=False))
query("k7_productivity", "SELECT * FROM k7")(lambda w: marts.kpi_productivity(marts.narrow(w.fact_invoice), w.dim_location, rounded=False))
query("k8_headline", "SELECT * FROM k8")(lambda w: marts.kpi_headline(w.facts, rounded=False))


@query("k8_states", "SELECT * FROM k8")
def _(w):
    """The headline from states: those of two thirds of all lines, the other third added; a part is added twice and taken away again."""
    f = w.facts
    line = {"invoices": "invoice_no", "sales": "order_no", "purchases": "po_no", "inventory": "item_key", "gl": "journal_no"}
    # each line is read once; its third tells to which states it belongs
    thirds = marts.states_of({n: f[n].withColumn("third", F.pmod(F.xxhash64(c), F.lit(3))) for n, c in line.items()}, by="third")
    names = list(thirds)
    kept = dict(zip(names, at_once(w.spark, *(lambda n=n: written(thirds[n], f"thirds-{n}") for n in names)), strict=True))
    third = lambda k: {n: df.where(F.col("third").isin(k)).drop("third") for n, df in kept.items()}
    states = marts.merged_states(third([0, 1]), added=third([1, 2]), removed=third([1]))
    states = dict(zip(names, at_once(w.spark, *(lambda n=n: written(states[n], f"state-{n}") for n in names)), strict=True))
    return marts.headline_of(states, f["locations"], f["closes"], rounded=False)


@query("k9_mirror", "SELECT * FROM k8")
def _(w):
    """The headline straight from staging, keyed by natural codes: no crosswalk, so it cross-checks the model."""
    w = w.kept(numbered=False)
    invoices = w.invoice_lines.selectExpr("invoice_no", "invoice_date", "customer_no AS customer_key", "md5(branch_code) AS location_key", "cast(cast(invoiced_qty as int) * unit_price as decimal(29,4)) AS revenue_amount",
        "cast(cast(invoiced_qty as int) * unit_cost as decimal(29,4)) AS cogs_amount", "cast(cast(invoiced_qty as int) * (unit_price - unit_cost) as decimal(30,4)) AS gross_margin_amount")
    sales = w.sales_order_lines.selectExpr("*", "coalesce(shipped_date <= promised_date, false) AS is_on_time", "filled_qty >= ordered_qty AS is_line_complete", "filled_qty < ordered_qty AND cancelled_qty < ordered_qty AS is_backordered")
    purchases = w.purchase_order_lines.selectExpr("ordered_qty", "received_qty", "cast(cast(received_qty as int) * (unit_cost_actual - unit_cost_standard) as decimal(30,4)) AS ppv_amount", "cast(cast(received_qty as int) * unit_cost_standard as decimal(29,4)) AS received_standard_amount")
    ledger = w.gl_entries.selectExpr("CASE account WHEN '1100' THEN 'GRP-1100' WHEN '2000' THEN 'GRP-2000' END AS consolidated_account", "debit_amt - credit_amt AS net_amount")
    locations = w.branches.selectExpr("md5(branch_code) AS location_key", "owned_since", "fte_count")
    return marts.kpi_headline({"invoices": invoices, "sales": sales, "purchases": purchases, "inventory": w.inventory_snapshots, "gl": ledger, "locations": locations, "closes": w.close_calendar}, rounded=False)


REV = "cast(sum(revenue_amount) AS decimal(38,4)) AS revenue"
query("b1_month_region", f"SELECT strftime(invoice_date, '%Y-%m') AS year_month, region, {REV} FROM fact_invoice f JOIN dim_location l ON f.location_key = l.location_key GROUP BY 1, 2 ORDER BY 1, 2")(
    lambda w: bi.monthly_revenue_by_region(w.fact_invoice, w.dim_location)
)
query("b2_inventory_latest", "SELECT item_key, cast(sum(on_hand_qty) AS bigint) AS on_hand_qty, cast(sum(inventory_value) AS decimal(38,4)) AS inventory_value FROM fact_inventory WHERE snapshot_date = (SELECT max(snapshot_date) FROM fact_inventory) GROUP BY 1")(
    lambda w: bi.inventory_position_latest(w.fact_inventory)
)
query("b3_invoice_branch", "SELECT invoice_line_key, invoice_date, branch_name, region, revenue_amount, gross_margin_amount FROM fact_invoice f JOIN dim_location l ON f.location_key = l.location_key")(
    lambda w: bi.invoice_branch(w.fact_invoice, w.dim_location)
)
query("b4_margin_by_category", f"SELECT category, {REV}, cast(sum(gross_margin_amount) AS decimal(38,4)) AS gross_margin, cast(sum(gross_margin_amount) AS double) / nullif(cast(sum(revenue_amount) AS double), 0) AS gross_margin_pct FROM fact_invoice f JOIN dim_item i ON f.item_key = i.item_key GROUP BY 1")(
    lambda w: bi.margin_by_category(w.fact_invoice, w.dim_item)
)
query("b5_inventory_cat", "SELECT category, cast(sum(inventory_value) AS decimal(38,4)) AS inventory_value FROM (SELECT *, row_number() OVER (PARTITION BY item_key, location_key ORDER BY snapshot_date DESC) AS r FROM fact_inventory) f JOIN dim_item i ON f.item_key = i.item_key WHERE r = 1 GROUP BY 1")(
    lambda w: bi.inventory_by_category(w.fact_inventory, w.dim_item)
)
query("b6_so_branch", "SELECT branch_name, cast(sum(least(filled_qty, ordered_qty)) AS double) / nullif(cast(sum(ordered_qty) AS double), 0) AS fill_pct FROM k3_lines f JOIN dim_location l ON f.location_key = l.location_key GROUP BY 1")(
    lambda w: bi.fill_by_branch(w.fact_sales, w.dim_location)
)
query("b7_po_vendor", "SELECT vendor_no, vendor_name, cast(sum(received_qty) AS double) / nullif(cast(sum(ordered_qty) AS double), 0) AS fill_pct FROM fact_purchase f JOIN dim_vendor v ON f.vendor_key = v.vendor_key GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 8")(
    lambda w: bi.vendor_fill(w.fact_purchase, w.dim_vendor)
)
_KPI_LONG = ", ".join(f"({i}, '{k}', {D.format(k)})" for i, k in enumerate(marts.KPIS, 1))
query("b8_kpi_long", f"SELECT t.seq, t.kpi, t.value FROM k8, LATERAL (VALUES {_KPI_LONG}) AS t(seq, kpi, value)")(lambda w: bi.kpi_long(marts.kpi_headline(w.facts, rounded=False)))
query("b9_monthly_revenue", f"SELECT cast(date_trunc('month', invoice_date) AS date) AS month, {REV} FROM fact_invoice GROUP BY 1 ORDER BY 1 LIMIT 100")(lambda w: bi.monthly_revenue(w.fact_invoice))
query("b9_revenue_by_branch", f"SELECT branch_name, {REV} FROM fact_invoice f JOIN dim_location l ON f.location_key = l.location_key GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")(lambda w: bi.revenue_by_branch(w.fact_invoice, w.dim_location))
query("b10_headline_tile", "SELECT avg(gmroi) AS value, isfinite(avg(gmroi)) AS is_finite FROM k8")(lambda w: bi.headline_tile(marts.kpi_headline(w.facts, rounded=False), "gmroi"))
query("b11_headline", "SELECT gmroi, gross_margin_pct, line_fill_rate, otif_rate, window_start, window_end FROM k8")(
    lambda w: marts.kpi_headline(w.facts, rounded=False).select("gmroi", "gross_margin_pct", "line_fill_rate", "otif_rate", "window_start", "window_end")
)
query("b12_service_by_branch", "SELECT branch_name, count(DISTINCT order_no) AS orders, cast(sum(least(filled_qty, ordered_qty)) AS bigint) AS filled_qty, cast(sum(ordered_qty) AS bigint) AS ordered_qty, cast(sum(least(filled_qty, ordered_qty)) AS double) / nullif(cast(sum(ordered_qty) AS double), 0) AS fill_rate FROM k3_lines f JOIN dim_location l ON f.location_key = l.location_key GROUP BY 1")(
    lambda w: bi.service_by_branch(w.fact_sales, w.dim_location)
)
_EFFICIENCY = (
    """SELECT i.category, a.avg_inventory, i.cogs_year, i.gm_year / nullif(a.avg_inventory, 0) AS gmroi, i.cogs_year / nullif(a.avg_inventory, 0) AS turns FROM
    (SELECT category, cast(sum(cogs_amount) AS double) * any_value(annualization) AS cogs_year, cast(sum(gross_margin_amount) AS double) * any_value(annualization) AS gm_year FROM fact_invoice f JOIN dim_item d ON f.item_key = d.item_key, w GROUP BY 1) i JOIN
    (SELECT category, cast(sum(v) AS double) / count(*) AS avg_inventory FROM (SELECT category, snapshot_date, cast(sum(inventory_value) AS decimal(38,4)) AS v FROM fact_inventory f JOIN dim_item d ON f.item_key = d.item_key GROUP BY 1, 2) GROUP BY 1) a ON i.category = a.category"""
)
query("b13_efficiency_by_category", _EFFICIENCY)(lambda w: bi.efficiency_by_category(w.fact_invoice, w.fact_inventory, w.dim_item))
query("b14_chart_spec", "SELECT order_status, count(DISTINCT customer_key) AS customers, cast(max(ordered_qty) AS bigint) AS max_ordered, cast(sum(filled_amount) AS decimal(38,4)) AS filled FROM fact_sales GROUP BY 1 ORDER BY 1 LIMIT 100")(
    lambda w: bi.chart(w.fact_sales, ["order_status"], {"customers": ("COUNT_DISTINCT", "customer_key"), "max_ordered": ("MAX", "ordered_qty"), "filled": ("SUM", "filled_amount")}, 100)
)
query(
    "b15_summary",
    """SELECT 'customers' AS entity, count(*) AS n, NULL::date AS first_date, NULL::date AS last_date FROM customers UNION ALL SELECT 'items', count(*) FILTER (WHERE item_status = 'ACTIVE'), NULL, NULL FROM items
    UNION ALL SELECT 'invoice_lines', count(*), min(invoice_date), max(invoice_date) FROM invoice_lines UNION ALL SELECT 'sales_order_lines', count(*), min(order_date), max(order_date) FROM sales_order_lines
    UNION ALL SELECT 'branches', cast(sum(fte_count) AS bigint), min(owned_since), max(owned_since) FROM branches""",
)(lambda w: bi.summary({"customers": (w.customers, "count(1)", None), "items": (w.items, "count_if(item_status = 'ACTIVE')", None), "invoice_lines": (w.invoice_lines, "count(1)", "invoice_date"), "sales_order_lines": (w.sales_order_lines, "count(1)", "order_date"), "branches": (w.branches, "sum(fte_count)", "owned_since")}))
query("b16_margin_answer", "SELECT category, cast(sum(gross_margin_amount) AS decimal(38,4)) AS gross_margin FROM fact_invoice f JOIN dim_item i ON f.item_key = i.item_key GROUP BY 1")(
    lambda w: bi.margin_by_category(w.fact_invoice, w.dim_item).select("category", "gross_margin")
)
query("b16_gmroi_answer", "SELECT gmroi, window_end FROM k8 ORDER BY window_end DESC LIMIT 1")(lambda w: marts.kpi_headline(w.facts, rounded=False).select("gmroi", "window_end").orderBy(F.desc("window_end")).limit(1))
query("b17_row_security", f"SELECT viewer, count(*) AS n, {REV} FROM fact_invoice f JOIN dim_location l ON f.location_key = l.location_key JOIN (SELECT 'north' AS viewer, region AS entitled FROM branches WHERE region < 'B' GROUP BY 2 UNION ALL SELECT 'all', region FROM branches GROUP BY 2) e ON l.region = e.entitled GROUP BY 1")(
    lambda w: bi.secured(
        w.fact_invoice.join(w.dim_location.select("location_key", "region"), "location_key"),
        w.branches.where("region < 'B'").select(F.lit("north").alias("viewer"), "region").distinct().unionByName(w.branches.select(F.lit("all").alias("viewer"), "region").distinct()), ["region"],
    ).groupBy("viewer").agg(F.count(F.lit(1)).alias("n"), marts.total("revenue_amount").alias("revenue"))
)
query("b18_items_lowest_fill", "SELECT item_no, cast(sum(least(filled_qty, ordered_qty)) AS double) / nullif(cast(sum(ordered_qty) AS double), 0) AS fill_pct FROM k3_lines f JOIN dim_item i ON f.item_key = i.item_key GROUP BY 1 ORDER BY 2, 1 LIMIT 10")(
    lambda w: bi.lowest_fill(w.fact_sales, w.dim_item)
)
query("b18_over_credit", f"SELECT customer_no, credit_limit, {REV} FROM fact_invoice f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY 1, 2 HAVING sum(revenue_amount) > credit_limit")(
    lambda w: bi.over_credit_limit(w.fact_invoice, w.dim_customer)
)
query("b18_vendors_by_ppv", "SELECT vendor_no, cast(sum(ppv_amount) AS decimal(38,4)) AS ppv_total FROM fact_purchase f JOIN dim_vendor v ON f.vendor_key = v.vendor_key GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")(
    lambda w: bi.top_vendors_by_ppv(w.fact_purchase, w.dim_vendor)
)
query(
    "b18_otif_by_branch",
    """SELECT branch_name, cast(sum(CASE WHEN shipped AND complete = 1 AND on_time = 1 THEN 1 ELSE 0 END) AS double) / count(*) AS otif_rate FROM (SELECT location_key, order_no, min(cast(is_line_complete AS int)) AS complete, min(cast(is_on_time AS int)) AS on_time, bool_and(shipped_date IS NOT NULL) AS shipped
    FROM k3_lines GROUP BY 1, 2) o JOIN dim_location l ON o.location_key = l.location_key GROUP BY 1""",
)(lambda w: bi.otif_by_branch(w.fact_sales, w.dim_location))
query("b18_region_quarter", f"SELECT region, {REV} FROM fact_invoice f JOIN dim_location l ON f.location_key = l.location_key WHERE invoice_date BETWEEN date '1996-01-01' AND date '1996-03-31' GROUP BY 1")(
    lambda w: bi.revenue_by_region_between(w.fact_invoice, w.dim_location, "1996-01-01", "1996-03-31")
)
query("b18_days_of_supply", f"SELECT category, cast(365 AS double) / nullif(turns, 0) AS days_of_supply FROM ({_EFFICIENCY})")(lambda w: bi.days_of_supply(w.fact_invoice, w.fact_inventory, w.dim_item))
query("b18_acquired_share", "SELECT acquired_share FROM k5")(lambda w: marts.kpi_growth(marts.narrow(w.fact_invoice), w.dim_location, rounded=False).select("acquired_share"))
query(
    "b18_cash_cycle_by_month",
    """SELECT *, dio + dso - dpo AS cash_conversion_cycle FROM (SELECT month_end, inventory / nullif(cast(cogs AS double), 0) * day(month_end) AS dio, cast(ar AS double) / nullif(cast(revenue AS double), 0) * day(month_end) AS dso, abs(cast(ap AS double) / nullif(cast(cogs AS double), 0)) * day(month_end) AS dpo FROM
    (SELECT last_day(invoice_date) AS month_end, cast(sum(revenue_amount) AS decimal(38,4)) AS revenue, cast(sum(cogs_amount) AS decimal(38,4)) AS cogs FROM fact_invoice GROUP BY 1) s
    JOIN (SELECT m, (SELECT cast(sum(net_amount) AS decimal(38,4)) FROM fact_gl WHERE consolidated_account = 'GRP-1100' AND entry_date <= m) AS ar, (SELECT cast(sum(net_amount) AS decimal(38,4)) FROM fact_gl WHERE consolidated_account = 'GRP-2000' AND entry_date <= m) AS ap
        FROM (SELECT DISTINCT last_day(invoice_date) AS m FROM fact_invoice)) b ON m = month_end
    LEFT JOIN (SELECT last_day(snapshot_date) AS h, cast(sum(v) AS double) / count(*) AS inventory FROM (SELECT snapshot_date, cast(sum(inventory_value) AS decimal(38,4)) AS v FROM fact_inventory GROUP BY 1) GROUP BY 1) i ON h = month_end)""",
)(lambda w: (lambda f: bi.cash_cycle_by_month(f["invoices"], f["inventory"], f["gl"]))(w.facts))
