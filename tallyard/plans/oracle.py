"""DuckDB SQL of the shaping rules and of the dimensional model: common table expressions that queries build on."""

from __future__ import annotations

import re

from ..sources.shape import COA_COLUMNS, COA_ROWS, SOURCE

_BR = "'BR-' || lpad(cast({} AS varchar), 2, '0')"

#: Each table expression by name; those it uses are found in its text.
CTES: dict[str, str] = {
    "branches": f"SELECT {_BR.format('n_nationkey')} AS branch_code, n_name AS branch_name, r_name AS region, date '1990-01-01' + n_nationkey * 180 AS owned_since, 5 + n_nationkey AS fte_count FROM nation JOIN region ON n_regionkey = r_regionkey",
    "items": f"""SELECT '{SOURCE}' AS source_system, 'I-' || p_partkey AS item_no, p_name AS description, p_type AS category, p_brand AS subcategory, 'EA' AS uom,
        cast(cast(p_retailprice AS decimal(18,2)) * cast(0.76 AS decimal(3,2)) AS decimal(18,4)) AS unit_cost, cast(cast(p_retailprice AS decimal(18,2)) AS decimal(18,4)) AS list_price,
        CASE WHEN p_size % 10 = 0 THEN 'DISCONTINUED' ELSE 'ACTIVE' END AS item_status, p_partkey FROM part""",
    "customers": f"""SELECT '{SOURCE}' AS source_system, 'C-' || c_custkey AS customer_no, c_name AS customer_name, c_mktsegment AS customer_class, 'NET30' AS terms,
        cast(cast(c_acctbal AS decimal(18,2)) AS decimal(18,4)) AS credit_limit, 'No. ' || c_custkey AS address1, n_name AS city, r_name AS state, lpad(cast(c_custkey AS varchar), 8, '0') AS postal_code
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "vendors": f"SELECT '{SOURCE}' AS source_system, 'V-' || s_suppkey AS vendor_no, s_name AS vendor_name, 'NET30' AS terms, cast(s_suppkey % 30 AS bigint) AS lead_time_days FROM supplier",
    "salespeople": f"SELECT DISTINCT '{SOURCE}' AS source_system, 'S-' || (o_orderkey % 40) AS salesperson_code, 'Rep ' || (o_orderkey % 40) AS salesperson_name, {_BR.format('o_orderkey % 40 % 25')} AS home_branch FROM orders",
    "order_base": f"""SELECT l.*, o.o_custkey, o.o_orderstatus, cast(o.o_orderdate AS date) AS od, cast(l_quantity AS int) AS qty, cast(l_discount AS decimal(4,2)) AS disc, cast(l_tax AS decimal(4,2)) AS tax,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS line_no,
        i.item_no, i.unit_cost, i.list_price, {_BR.format('s_nationkey')} AS supplier_branch, {_BR.format('CASE WHEN l_orderkey % 4 = 0 THEN s_nationkey ELSE c_nationkey END')} AS branch_code
        FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN items i ON l_partkey = i.p_partkey""",
    "sol_base": """SELECT *, cast(CASE WHEN l_returnflag = 'R' THEN qty + 3 ELSE qty END AS bigint) AS ordered_qty,
        cast(CASE WHEN o_orderstatus = 'P' AND l_linestatus = 'O' THEN 0 ELSE qty END AS bigint) AS filled_qty, CASE WHEN l_linestatus = 'F' THEN od + (1 + 2 * l_linenumber) END AS shipped_date FROM order_base""",
    "sales_order_lines": f"""SELECT *, CASE WHEN cancelled_qty > 0 THEN 'CANCELLED' WHEN shipped_date IS NULL THEN 'OPEN' WHEN filled_qty < ordered_qty THEN 'PARTIAL' ELSE 'SHIPPED' END AS order_status FROM (
        SELECT '{SOURCE}' AS source_system, 'SO-' || l_orderkey AS order_no, cast(line_no AS bigint) AS line_no, od AS order_date, 'C-' || o_custkey AS customer_no, branch_code, 'S-' || (l_orderkey % 40) AS salesperson_code,
        item_no, 'EA' AS uom, ordered_qty, filled_qty, CASE WHEN disc = 0.10 THEN ordered_qty ELSE 0 END AS cancelled_qty, cast(list_price * (1 - disc) AS decimal(18,4)) AS unit_price, unit_cost,
        od + 7 AS promised_date, shipped_date, l_orderkey, tax FROM sol_base)""",
    "invoice_lines": """SELECT source_system, 'INV-' || l_orderkey AS invoice_no, line_no, shipped_date AS invoice_date, order_no, customer_no, branch_code, item_no, uom, filled_qty AS invoiced_qty, unit_price, unit_cost,
        cast(cast(filled_qty AS int) * cast(0.05 AS decimal(4,2)) AS decimal(18,4)) AS freight_amt, cast(cast(filled_qty AS int) * unit_price * tax AS decimal(18,4)) AS tax_amt, l_orderkey
        FROM sales_order_lines WHERE shipped_date IS NOT NULL AND filled_qty > 0 AND cancelled_qty = 0""",
    "purchase_order_lines": f"""SELECT *, CASE WHEN received_qty > 0 THEN po_date + 14 END AS received_date FROM (
        SELECT '{SOURCE}' AS source_system, 'PO-' || l_orderkey AS po_no, cast(line_no AS bigint) AS line_no, od AS po_date, 'V-' || l_suppkey AS vendor_no, supplier_branch AS branch_code, item_no, 'EA' AS uom, cast(qty AS bigint) AS ordered_qty,
        cast(CASE WHEN l_returnflag = 'N' THEN greatest(qty - l_linenumber, 0) ELSE qty END AS bigint) AS received_qty,
        cast(unit_cost * (1 + tax - cast(0.02 AS decimal(4,2))) AS decimal(18,4)) AS unit_cost_actual, unit_cost AS unit_cost_standard, l_suppkey FROM order_base)""",
    "inventory_snapshots": f"""SELECT '{SOURCE}' AS source_system, *, cast(cast(on_hand_qty AS int) * unit_cost AS decimal(18,4)) AS inventory_value FROM (
        SELECT last_day(cast(l_shipdate AS date)) AS snapshot_date, supplier_branch AS branch_code, item_no, unit_cost, cast(sum(qty) AS bigint) AS on_hand_qty, cast(sum(CASE WHEN l_returnflag = 'R' THEN qty ELSE 0 END) AS bigint) AS allocated_qty,
        cast(sum(CASE WHEN l_linestatus = 'O' THEN qty ELSE 0 END) AS bigint) AS on_order_qty, cast(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS bigint) AS backorder_qty FROM order_base GROUP BY ALL)""",
    "gl_sales": "SELECT l_orderkey, min(invoice_date) AS d, min(branch_code) AS branch_code, cast(cast(sum(cast(invoiced_qty AS int) * unit_price) AS decimal(18,2)) AS decimal(18,4)) AS x FROM invoice_lines GROUP BY l_orderkey",
    "gl_bills": "SELECT l_suppkey, last_day(po_date) AS d, branch_code, cast(cast(sum(cast(received_qty AS int) * unit_cost_actual) AS decimal(18,2)) AS decimal(18,4)) AS x FROM purchase_order_lines GROUP BY ALL",
    "gl_pairs": """SELECT 'JS-' || l_orderkey AS journal_no, d AS entry_date, branch_code, '1100' AS dr, '4000' AS cr, 'sale' AS description, x FROM gl_sales
        UNION ALL SELECT 'JC-' || l_orderkey, d + 30, branch_code, '1010', '1100', 'receipt', x FROM gl_sales WHERE l_orderkey % 5 <> 0
        UNION ALL SELECT 'JB-' || l_suppkey || '-' || d || '-' || branch_code, d, branch_code, '1200', '2000', 'bill', x FROM gl_bills
        UNION ALL SELECT 'JP-' || l_suppkey || '-' || d || '-' || branch_code, d + 30, branch_code, '2000', '1010', 'payment', x FROM gl_bills WHERE l_suppkey % 5 <> 0""",
    "gl_entries": f"""SELECT '{SOURCE}' AS source_system, journal_no, cast(1 AS bigint) AS line_no, entry_date, branch_code, dr AS account, description, x AS debit_amt, cast(0 AS decimal(18,4)) AS credit_amt FROM gl_pairs
        UNION ALL SELECT '{SOURCE}', journal_no, 2, entry_date, branch_code, cr, description, cast(0 AS decimal(18,4)), x FROM gl_pairs""",
    "coa": f"SELECT '{SOURCE}' AS source_company_id, * FROM (VALUES {COA_ROWS}) AS t({COA_COLUMNS})",
    "close_calendar": "SELECT period_end_date, period_end_date + cast(10 + month(period_end_date) % 11 AS int) AS close_completed_on FROM (SELECT DISTINCT last_day(invoice_date) AS period_end_date FROM invoice_lines)",
}


def _sk(*parts: str) -> str:
    return "md5(concat_ws(':', " + ", ".join(f"cast({p} AS varchar)" for p in parts) + "))"


CTES |= {
    "xwalk_customer": f"SELECT source_system, customer_no AS source_key, {_sk('source_system', 'customer_no')} AS canonical_customer_key FROM customers",
    "xwalk_item": f"SELECT source_system, item_no AS source_key, {_sk('source_system', 'item_no')} AS canonical_item_key FROM items",
    "xwalk_vendor": f"SELECT source_system, vendor_no AS source_key, {_sk('source_system', 'vendor_no')} AS canonical_vendor_key FROM vendors",
    "xwalk_salesperson": f"SELECT source_system, salesperson_code AS source_key, {_sk('source_system', 'salesperson_code')} AS canonical_salesperson_key FROM salespeople",
    "dim_customer": "SELECT canonical_customer_key AS customer_key, c.* FROM customers c JOIN xwalk_customer x ON c.source_system = x.source_system AND c.customer_no = x.source_key",
    "dim_item_category": f"SELECT DISTINCT md5(concat_ws(':', category, coalesce(subcategory, '-'))) AS item_category_key, category, subcategory FROM items WHERE category IS NOT NULL",
    "dim_item": "SELECT canonical_item_key AS item_key, k.item_category_key, i.* FROM items i JOIN xwalk_item x ON i.source_system = x.source_system AND i.item_no = x.source_key LEFT JOIN dim_item_category k ON i.category = k.category AND i.subcategory = k.subcategory",
    "dim_vendor": "SELECT canonical_vendor_key AS vendor_key, v.* FROM vendors v JOIN xwalk_vendor x ON v.source_system = x.source_system AND v.vendor_no = x.source_key",
    "dim_location": f"SELECT {_sk('branch_code')} AS location_key, * FROM branches",
    "dim_salesperson": f"SELECT canonical_salesperson_key AS salesperson_key, s.*, coalesce(l.location_key, {_sk('home_branch')}) AS home_location_key FROM salespeople s JOIN xwalk_salesperson x ON s.source_system = x.source_system AND s.salesperson_code = x.source_key LEFT JOIN dim_location l ON s.home_branch = l.branch_code",
    "dim_ship_to": "SELECT md5(concat_ws(':', 'ship_to', customer_no)) AS ship_to_key, canonical_customer_key AS customer_key, customer_name AS ship_to_name, address1, city, state, postal_code FROM customers c JOIN xwalk_customer x ON c.source_system = x.source_system AND c.customer_no = x.source_key",
    "fact_sales": f"""SELECT {_sk('s.source_system', 'order_no', 'line_no')} AS sales_order_line_key, s.source_system, order_no, line_no, order_date, canonical_customer_key AS customer_key, canonical_item_key AS item_key, {_sk('branch_code')} AS location_key, {_sk('s.source_system', 'salesperson_code')} AS salesperson_key,
        ordered_qty, filled_qty, cancelled_qty, unit_price, unit_cost, cast(cast(ordered_qty AS int) * unit_price AS decimal(29,4)) AS ordered_amount, cast(cast(least(filled_qty, ordered_qty) AS int) * unit_price AS decimal(29,4)) AS filled_amount,
        promised_date, shipped_date, order_status, coalesce(shipped_date <= promised_date, false) AS is_on_time, filled_qty >= ordered_qty AS is_line_complete, (filled_qty < ordered_qty AND cancelled_qty < ordered_qty) AS is_backordered
        FROM sales_order_lines s JOIN xwalk_customer c ON s.source_system = c.source_system AND customer_no = c.source_key JOIN xwalk_item i ON s.source_system = i.source_system AND item_no = i.source_key""",
    "fact_invoice": f"""SELECT {_sk('s.source_system', 'invoice_no', 'line_no')} AS invoice_line_key, s.source_system, invoice_no, line_no, invoice_date, order_no, canonical_customer_key AS customer_key, canonical_item_key AS item_key, {_sk('branch_code')} AS location_key,
        invoiced_qty, unit_price, unit_cost, cast(cast(invoiced_qty AS int) * unit_price AS decimal(29,4)) AS revenue_amount, cast(cast(invoiced_qty AS int) * unit_cost AS decimal(29,4)) AS cogs_amount,
        cast(cast(invoiced_qty AS int) * (unit_price - unit_cost) AS decimal(30,4)) AS gross_margin_amount, freight_amt, tax_amt
        FROM invoice_lines s JOIN xwalk_customer c ON s.source_system = c.source_system AND customer_no = c.source_key JOIN xwalk_item i ON s.source_system = i.source_system AND item_no = i.source_key""",
    "fact_purchase": f"""SELECT {_sk('p.source_system', 'po_no', 'line_no')} AS purchase_order_line_key, p.source_system, po_no, line_no, po_date, canonical_vendor_key AS vendor_key, canonical_item_key AS item_key, {_sk('branch_code')} AS location_key,
        ordered_qty, received_qty, unit_cost_actual, unit_cost_standard, received_date, cast(cast(received_qty AS int) * (unit_cost_actual - unit_cost_standard) AS decimal(30,4)) AS ppv_amount, cast(cast(received_qty AS int) * unit_cost_standard AS decimal(29,4)) AS received_standard_amount,
        received_date IS NOT NULL AS is_received, received_qty >= ordered_qty AS is_received_in_full
        FROM purchase_order_lines p JOIN xwalk_vendor v ON p.source_system = v.source_system AND vendor_no = v.source_key JOIN xwalk_item i ON p.source_system = i.source_system AND item_no = i.source_key""",
    "fact_inventory": f"""SELECT {_sk('snapshot_date', 'branch_code', 'item_no')} AS inventory_snapshot_key, s.source_system, snapshot_date, {_sk('branch_code')} AS location_key, canonical_item_key AS item_key, on_hand_qty, allocated_qty, on_order_qty, backorder_qty, unit_cost, inventory_value
        FROM inventory_snapshots s JOIN xwalk_item i ON s.source_system = i.source_system AND item_no = i.source_key""",
    "fact_gl": f"""SELECT {_sk('g.source_system', 'journal_no', 'line_no')} AS gl_transaction_key, g.source_system, journal_no, line_no, entry_date, {_sk('branch_code')} AS location_key, account, target_consolidated_account AS consolidated_account, mapping_rule_type, description, debit_amt, credit_amt,
        cast(debit_amt - credit_amt AS decimal(19,4)) AS net_amount
        FROM gl_entries g LEFT JOIN coa m ON m.source_company_id = '{SOURCE}' AND m.active_flag AND g.account = m.source_gl_account AND g.entry_date BETWEEN m.effective_start_date AND m.effective_end_date""",
    "w": """SELECT min(invoice_date) AS window_start, max(invoice_date) AS window_end, cast(date_diff('day', min(invoice_date), max(invoice_date)) + 1 AS bigint) AS window_days,
        cast(365 AS double) / cast(date_diff('day', min(invoice_date), max(invoice_date)) + 1 AS double) AS annualization FROM fact_invoice""",
    "book": "SELECT cast(sum(revenue_amount) AS decimal(38,4)) AS revenue, cast(sum(cogs_amount) AS decimal(38,4)) AS cogs, cast(sum(gross_margin_amount) AS decimal(38,4)) AS gross_margin FROM fact_invoice",
    "avg_inv": "SELECT cast(sum(v) AS double) / count(*) AS avg_inventory FROM (SELECT snapshot_date, cast(sum(inventory_value) AS decimal(38,4)) AS v FROM fact_inventory GROUP BY 1)",
    "k2": """SELECT *, 365.0::double / nullif(inventory_turns, 0) AS days_inventory_outstanding FROM (SELECT avg_inventory, cast(cogs AS double) * annualization / nullif(avg_inventory, 0) AS inventory_turns,
        avg_inventory / nullif(cast(cogs AS double) / window_days * 7, 0) AS weeks_of_supply, cast(gross_margin AS double) * annualization / nullif(avg_inventory, 0) AS gmroi FROM book, avg_inv, w)""",
    "k3_lines": "SELECT * FROM fact_sales WHERE ordered_qty > 0 AND cancelled_qty < ordered_qty",
    "k3": """SELECT line_fill_rate, order_fill_rate, on_time_delivery_rate, otif_rate, backorder_rate, active_lines, active_orders FROM
        (SELECT cast(sum(least(filled_qty, ordered_qty)) AS double) / nullif(cast(sum(ordered_qty) AS double), 0) AS line_fill_rate, cast(count(*) FILTER (WHERE is_backordered) AS double) / nullif(count(*), 0) AS backorder_rate, count(*) AS active_lines FROM k3_lines),
        (SELECT cast(sum(complete) AS double) / nullif(count(*), 0) AS order_fill_rate, cast(sum(CASE WHEN shipped THEN on_time END) AS double) / nullif(count(*) FILTER (WHERE shipped), 0) AS on_time_delivery_rate,
            cast(sum(CASE WHEN shipped AND complete = 1 AND on_time = 1 THEN 1 ELSE 0 END) AS double) / nullif(count(*), 0) AS otif_rate, count(*) AS active_orders FROM
            (SELECT order_no, min(cast(is_line_complete AS int)) AS complete, min(cast(is_on_time AS int)) AS on_time, bool_and(shipped_date IS NOT NULL) AS shipped FROM k3_lines GROUP BY 1))""",
    "k4": """SELECT cast(gross_margin AS double) / nullif(cast(revenue AS double), 0) AS gross_margin_pct, revenue, cogs, cast(ar AS double) / nullif(cast(revenue AS double), 0) * 365 AS dso, abs(cast(ap AS double)) / nullif(cast(cogs AS double), 0) * 365 AS dpo, close_cycle_days,
        round(days_inventory_outstanding, 1) + cast(ar AS double) / nullif(cast(revenue AS double), 0) * 365 - abs(cast(ap AS double)) / nullif(cast(cogs AS double), 0) * 365 AS cash_conversion_cycle FROM book, k2,
        (SELECT cast(sum(CASE WHEN consolidated_account = 'GRP-1100' THEN net_amount END) AS decimal(38,4)) AS ar, cast(sum(CASE WHEN consolidated_account = 'GRP-2000' THEN net_amount END) AS decimal(38,4)) AS ap FROM fact_gl),
        (SELECT cast(sum(date_diff('day', period_end_date, close_completed_on)) AS double) / count(*) AS close_cycle_days FROM close_calendar)""",
    "k5_home": "SELECT customer_key, location_key FROM (SELECT customer_key, location_key, row_number() OVER (PARTITION BY customer_key ORDER BY sum(revenue_amount) DESC, location_key) AS r FROM fact_invoice GROUP BY 1, 2) WHERE r = 1",
    "k5": """SELECT cast(sum(CASE WHEN f.location_key = h.location_key THEN revenue_amount ELSE 0 END) AS double) / nullif(cast(sum(revenue_amount) AS double), 0) AS same_branch_share,
        cast(sum(CASE WHEN coalesce(owned_since < window_start, false) THEN revenue_amount ELSE 0 END) AS double) / nullif(cast(sum(revenue_amount) AS double), 0) AS organic_share,
        cast(sum(CASE WHEN coalesce(owned_since < window_start, false) THEN 0 ELSE revenue_amount END) AS double) / nullif(cast(sum(revenue_amount) AS double), 0) AS acquired_share
        FROM fact_invoice f JOIN k5_home h ON f.customer_key = h.customer_key LEFT JOIN dim_location l ON f.location_key = l.location_key, w""",
    "k6": """SELECT cast(sum(received_qty) AS double) / nullif(cast(sum(ordered_qty) AS double), 0) AS vendor_fill_rate, cast(sum(ppv_amount) AS decimal(38,4)) AS ppv_total,
        cast(sum(ppv_amount) AS double) / nullif(cast(sum(received_standard_amount) AS double), 0) AS ppv_pct, count(*) AS po_lines FROM fact_purchase""",
    "k7": """SELECT cast(revenue AS double) * annualization / nullif(fte, 0) AS sales_per_fte, cast(revenue AS double) / nullif(invoices, 0) AS avg_ticket, cast(invoices AS double) / nullif(active_days, 0) AS orders_per_active_day, invoices, active_days
        FROM book, w, (SELECT sum(fte_count) AS fte FROM dim_location), (SELECT count(DISTINCT invoice_no) AS invoices, count(DISTINCT invoice_date) AS active_days FROM fact_invoice)""",
    "k8": """SELECT gmroi, inventory_turns, days_inventory_outstanding, weeks_of_supply, gross_margin_pct, line_fill_rate, order_fill_rate, on_time_delivery_rate, otif_rate, backorder_rate, vendor_fill_rate, ppv_pct, dso, dpo, cash_conversion_cycle, close_cycle_days,
        same_branch_share, organic_share, acquired_share, sales_per_fte, avg_ticket, window_start, window_end, window_days FROM k2, k3, k4, k5, k6, k7, w""",
}


def sql(body: str) -> str:
    """``body`` with the table expressions that it needs, directly or through others, in front."""
    needed: list[str] = []

    def visit(text: str, path: tuple[str, ...] = ()) -> None:
        for name in CTES:
            if name not in needed and name not in path and re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", text):
                visit(CTES[name], (*path, name))
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + body


SK = _sk
