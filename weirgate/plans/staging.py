"""Staging: typed, trimmed rows of a snapshot up to the run's batch; and the names that reconciliation compares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import MONEY, cleaned, instant, joined_key, lowered


def _upto(df: DataFrame, batch: int) -> DataFrame:
    return df.where(F.col("batch_id").cast("bigint") <= F.lit(batch))


def _tail() -> list:
    return [instant(F.col("updated_at")).alias("source_updated_at"), F.col("batch_id").cast("bigint").alias("source_batch_id")]


def customers(silver: DataFrame, batch: int) -> DataFrame:
    return _upto(silver, batch).select(
        F.col("customer_id").cast("bigint").alias("customer_id"),
        cleaned(F.col("first_name")).alias("first_name"),
        cleaned(F.col("last_name")).alias("last_name"),
        lowered(F.col("email")).alias("email"),
        lowered(F.col("status")).alias("customer_status"),
        *_tail(),
    )


def products(silver: DataFrame, batch: int) -> DataFrame:
    return _upto(silver, batch).select(
        F.col("product_id").cast("bigint").alias("product_id"),
        cleaned(F.col("sku")).alias("sku"),
        cleaned(F.col("name")).alias("product_name"),
        cleaned(F.col("category")).alias("category"),
        F.col("unit_price").cast(MONEY).alias("unit_price"),
        F.col("active").cast("boolean").alias("is_active"),
        *_tail(),
    )


def orders(silver: DataFrame, batch: int) -> DataFrame:
    return _upto(silver, batch).select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        lowered(F.col("status")).alias("order_status"),
        instant(F.col("ordered_at")).alias("ordered_at"),
        *_tail(),
    )


def order_items(silver: DataFrame, batch: int) -> DataFrame:
    return _upto(silver, batch).select(
        joined_key(F.col("order_id"), F.col("line_number")).alias("order_item_id"),
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("line_number").cast("int").alias("line_number"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("unit_price").cast(MONEY).alias("unit_price"),
        *_tail(),
    )


STAGING = {"customers": customers, "products": products, "orders": orders, "order_items": order_items}

#: Columns of staging under the source's names.
COMPARED = {
    "customers": {"customer_id": "customer_id", "email": "email", "first_name": "first_name", "last_name": "last_name", "updated_at": "source_updated_at", "batch_id": "source_batch_id"},
    "products": {"product_id": "product_id", "sku": "sku", "name": "product_name", "category": "category", "unit_price": "unit_price", "active": "is_active", "updated_at": "source_updated_at", "batch_id": "source_batch_id"},
    "orders": {"order_id": "order_id", "customer_id": "customer_id", "ordered_at": "ordered_at", "status": "order_status", "updated_at": "source_updated_at", "batch_id": "source_batch_id"},
    "order_items": {"order_id": "order_id", "line_number": "line_number", "product_id": "product_id", "quantity": "quantity", "unit_price": "unit_price", "updated_at": "source_updated_at", "batch_id": "source_batch_id"},
}


def compared(entity: str, staged: DataFrame) -> DataFrame:
    """A staged entity as reconciliation compares it with its source."""
    return staged.select(*(F.col(c).alias(name) for name, c in COMPARED[entity].items()))
