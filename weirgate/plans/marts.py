"""Enriched orders and lines, dimensions and facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import MONEY, amount, cleaned, date_key, day_name, iso_weekday, month_name


def orders_enriched(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their customer and the totals of their lines; orders without lines have zeros."""
    totals = items.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).cast(MONEY).alias("total"),
        F.sum("quantity").alias("quantity"),
        F.count(F.lit(1)).alias("lines"),
    )
    people = customers.select("customer_id", "first_name", "last_name", "email")
    both = orders.join(people, "customer_id", "left").join(totals, "order_id", "left")
    return both.select(
        "order_id",
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "order_status",
        "ordered_at",
        F.to_date("ordered_at").alias("order_date"),
        F.coalesce("total", F.lit(0).cast(MONEY)).alias("order_total"),
        F.coalesce("quantity", F.lit(0).cast("bigint")).alias("item_quantity"),
        F.coalesce("lines", F.lit(0).cast("bigint")).alias("item_count"),
        "source_updated_at",
        "source_batch_id",
    )


def order_items_enriched(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with their order's customer, status and time, their product's names, and their amount."""
    heads = orders.select("order_id", "customer_id", "order_status", "ordered_at")
    goods = products.select("product_id", "sku", "product_name", "category")
    both = items.join(heads, "order_id", "left").join(goods, "product_id", "left")
    return both.select(
        "order_item_id",
        "order_id",
        "line_number",
        "customer_id",
        "product_id",
        "sku",
        "product_name",
        "category",
        "order_status",
        "ordered_at",
        F.to_date("ordered_at").alias("order_date"),
        "quantity",
        "unit_price",
        amount(F.col("quantity"), F.col("unit_price")).alias("line_amount"),
        "source_updated_at",
        "source_batch_id",
    )


def stamped(df: DataFrame, run_id: str, batch: int) -> DataFrame:
    """df with the run that made it."""
    return df.withColumns({"pipeline_run_id": F.lit(run_id), "pipeline_batch_id": F.lit(batch).cast("bigint")})


def dim_customer(customers: DataFrame, run_id: str, batch: int) -> DataFrame:
    name = cleaned(F.concat_ws(" ", "first_name", "last_name")).alias("customer_name")
    return stamped(customers.select("customer_id", "first_name", "last_name", name, "email", "customer_status", "source_updated_at", "source_batch_id"), run_id, batch)


def dim_product(products: DataFrame, run_id: str, batch: int) -> DataFrame:
    return stamped(products.select("product_id", "sku", "product_name", "category", "unit_price", "is_active", "source_updated_at", "source_batch_id"), run_id, batch)


def fact_order(enriched: DataFrame, run_id: str, batch: int) -> DataFrame:
    key = date_key(F.col("order_date")).alias("order_date_key")
    return stamped(enriched.select("order_id", "customer_id", key, "order_status", "ordered_at", "order_total", "item_quantity", "item_count", "source_updated_at", "source_batch_id"), run_id, batch)


def fact_order_item(enriched: DataFrame, run_id: str, batch: int) -> DataFrame:
    key = date_key(F.col("order_date")).alias("order_date_key")
    return stamped(enriched.select("order_item_id", "order_id", "line_number", "customer_id", "product_id", key, "quantity", "unit_price", "line_amount", "source_updated_at", "source_batch_id"), run_id, batch)


def calendar(days: DataFrame) -> DataFrame:
    """The calendar columns of a table with date_day."""
    day = F.col("date_day")
    return days.select(
        date_key(day).alias("date_key"),
        "date_day",
        F.year(day).alias("year_number"),
        F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"),
        month_name(day).alias("month_name"),
        F.weekofyear(day).alias("week_number"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday(day).alias("day_of_week"),
        day_name(day).alias("day_name"),
        iso_weekday(day).isin(6, 7).alias("is_weekend"),
    )


def dim_date(enriched: DataFrame, start: date, end: date, run_id: str, batch: int) -> DataFrame:
    """Every day from the first order or the interval's start to the last order or the interval's end."""
    bounds = enriched.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    low, high = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = bounds.select(F.explode(F.sequence(F.least(F.coalesce("first", low), low), F.greatest(F.coalesce("last", high), high))).alias("date_day"))
    return stamped(calendar(days), run_id, batch)


def spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """date_day for every day from start to end."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date_day"))
