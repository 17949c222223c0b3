"""Declared data tests: what columns of each table must hold, and one count of violations for each test."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checks import orphans, repeats

#: Fixed values. Tests of a column: filled, unique, not_negative, positive, one of some values (in:a,b), a reference (to:table.column).
DECLARED: dict[str, dict[str, str]] = {
    "silver_customers": {"customer_id": "filled unique", "batch_id": "filled", "updated_at": "filled"},
    "silver_products": {"product_id": "filled unique", "batch_id": "filled", "updated_at": "filled"},
    "silver_orders": {"order_id": "filled unique", "customer_id": "filled to:silver_customers.customer_id", "batch_id": "filled", "updated_at": "filled"},
    "silver_order_items": {"order_id,line_number": "unique", "order_id": "filled to:silver_orders.order_id", "line_number": "filled", "product_id": "filled to:silver_products.product_id", "batch_id": "filled", "updated_at": "filled"},
    "stg_customers": {"customer_id": "filled unique", "email": "filled", "customer_status": "filled in:active,inactive", "source_batch_id": "filled"},
    "stg_products": {"product_id": "filled unique", "sku": "filled unique", "unit_price": "filled not_negative", "is_active": "filled"},
    "stg_orders": {"order_id": "filled unique", "customer_id": "filled to:stg_customers.customer_id", "order_status": "filled in:pending,paid,shipped,cancelled"},
    "stg_order_items": {"order_item_id": "filled unique", "order_id": "filled to:stg_orders.order_id", "line_number": "filled", "product_id": "filled to:stg_products.product_id", "quantity": "filled positive", "unit_price": "filled not_negative"},
    "orders_enriched": {"order_id": "filled unique", "customer_id": "filled", "order_total": "filled not_negative"},
    "order_items_enriched": {"order_item_id": "filled unique", "order_id": "filled", "product_id": "filled", "line_amount": "filled not_negative"},
    "validation_customers": {"customer_id": "filled unique"},
    "validation_products": {"product_id": "filled unique"},
    "validation_orders": {"order_id": "filled unique"},
    "validation_order_items": {"order_id,line_number": "unique", "order_id": "filled", "line_number": "filled"},
    "dim_customer": {"customer_id": "filled unique", "email": "filled", "customer_status": "filled in:active,inactive", "pipeline_run_id": "filled", "pipeline_batch_id": "filled"},
    "dim_product": {"product_id": "filled unique", "sku": "filled unique", "unit_price": "filled not_negative", "is_active": "filled", "pipeline_run_id": "filled"},
    "dim_date": {"date_key": "filled unique", "date_day": "filled unique", "pipeline_run_id": "filled"},
    "fact_order": {"order_id": "filled unique", "customer_id": "filled to:dim_customer.customer_id", "order_date_key": "filled to:dim_date.date_key", "order_total": "filled not_negative", "pipeline_run_id": "filled"},
    "fact_order_item": {
        "order_id,line_number": "unique",
        "order_item_id": "filled unique",
        "order_id": "filled to:fact_order.order_id",
        "line_number": "filled",
        "customer_id": "filled to:dim_customer.customer_id",
        "product_id": "filled to:dim_product.product_id",
        "order_date_key": "filled to:dim_date.date_key",
        "quantity": "filled positive",
        "line_amount": "filled not_negative",
        "pipeline_run_id": "filled",
    },
}


def violations(name: str, tables: Mapping[str, DataFrame], declared: Mapping[str, str] | None = None) -> DataFrame:
    """(test, violations) for each declared test of a table; those of single rows are counted in one pass."""
    df, rows, others = tables[name], [], []
    for columns, tests in (declared or DECLARED[name]).items():
        names = columns.split(",")
        c = F.col(names[0])
        for test in tests.split():
            kind, _, rest = test.partition(":")
            label = f"{name}.{columns} {test}"
            if kind == "unique":
                others.append((label, repeats(df, names)))
            elif kind == "to":
                parent, _, column = rest.partition(".")
                others.append((label, orphans(df, columns, tables[parent], column)))
            else:
                wrong = {"filled": lambda: c.isNull(), "not_negative": lambda: c < 0, "positive": lambda: c <= 0, "in": lambda: ~c.isin(*rest.split(","))}[kind]()
                rows.append(F.struct(F.lit(label).alias("test"), F.count_if(wrong).alias("violations")))
    out = [found.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(label).alias("test"), "violations") for label, found in others]
    if rows:
        out.insert(0, df.agg(F.array(*rows).alias("x")).select(F.inline("x")))
    return reduce(DataFrame.unionByName, out)
