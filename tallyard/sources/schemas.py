"""The nine canonical staging entities: columns, natural keys, and the provenance that every staged row carries."""

from __future__ import annotations

from pyspark.sql import types as T

from ..functions.keys import MONEY

_KINDS = {"s": T.StringType(), "i": T.LongType(), "m": T.DecimalType(18, 4), "d": T.DateType()}

#: Column name and kind (s string, i integer, m money, d date) of each entity.
COLUMNS = {
    "items": "item_no s, description s, category s, subcategory s, uom s, unit_cost m, list_price m, item_status s",
    "salespeople": "salesperson_code s, salesperson_name s, home_branch s",
    "customers": "customer_no s, customer_name s, customer_class s, terms s, credit_limit m, address1 s, city s, state s, postal_code s",
    "vendors": "vendor_no s, vendor_name s, terms s, lead_time_days i",
    "sales_order_lines": "order_no s, line_no i, order_date d, customer_no s, branch_code s, salesperson_code s, item_no s, uom s, ordered_qty i, filled_qty i, cancelled_qty i, unit_price m, unit_cost m, promised_date d, shipped_date d, order_status s",
    "purchase_order_lines": "po_no s, line_no i, po_date d, vendor_no s, branch_code s, item_no s, uom s, ordered_qty i, received_qty i, unit_cost_actual m, unit_cost_standard m, received_date d",
    "invoice_lines": "invoice_no s, line_no i, invoice_date d, order_no s, customer_no s, branch_code s, item_no s, uom s, invoiced_qty i, unit_price m, unit_cost m, freight_amt m, tax_amt m",
    "inventory_snapshots": "snapshot_date d, branch_code s, item_no s, on_hand_qty i, allocated_qty i, on_order_qty i, backorder_qty i, unit_cost m, inventory_value m",
    "gl_entries": "journal_no s, line_no i, entry_date d, branch_code s, account s, description s, debit_amt m, credit_amt m",
}

#: The columns that name a row of each entity in its source.
NATURAL_KEYS = {
    "items": ["item_no"], "salespeople": ["salesperson_code"], "customers": ["customer_no"], "vendors": ["vendor_no"],
    "sales_order_lines": ["order_no", "line_no"], "purchase_order_lines": ["po_no", "line_no"], "invoice_lines": ["invoice_no", "line_no"],
    "inventory_snapshots": ["snapshot_date", "branch_code", "item_no"], "gl_entries": ["journal_no", "line_no"],
}

PROVENANCE = ["source_system", "source_id", "source_file", "source_row_no", "batch_id", "loaded_at"]


def entity_schema(entity: str) -> T.StructType:
    pairs = [c.split() for c in COLUMNS[entity].split(", ")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


__all__ = ["COLUMNS", "MONEY", "NATURAL_KEYS", "PROVENANCE", "entity_schema"]
