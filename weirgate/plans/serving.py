"""What the dashboard asks of published marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Statuses that earn nothing (fixed values).
VOID = ("cancelled", "refunded")
MOST = 100


def order_dates(orders: DataFrame) -> DataFrame:
    day = F.to_date("ordered_at")
    return orders.agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))


def earning(orders: DataFrame, start: date, end: date) -> DataFrame:
    """Orders of the days from start to end whose status is known and not void."""
    low, high = F.lit(start).cast("timestamp"), F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")
    return orders.where((F.col("ordered_at") >= low) & (F.col("ordered_at") < high) & ~F.col("order_status").isin(*VOID))


def kpis(orders: DataFrame, start: date, end: date) -> DataFrame:
    nothing = F.lit(0)
    return earning(orders, start, end).agg(
        F.coalesce(F.sum("order_total"), nothing).cast("decimal(38,2)").alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        F.coalesce(F.avg("order_total"), nothing).cast("decimal(22,6)").alias("average_order_value"),
    )


def daily_revenue(orders: DataFrame, start: date, end: date) -> DataFrame:
    days = earning(orders, start, end).groupBy(F.to_date("ordered_at").alias("order_date"))
    return days.agg(F.sum("order_total").cast("decimal(38,2)").alias("revenue"), F.count(F.lit(1)).alias("orders")).orderBy("order_date")


def product_performance(items: DataFrame, orders: DataFrame, products: DataFrame, start: date, end: date, top: int = 20) -> DataFrame:
    """The products that earned most. Lines are summed by product before they meet the products' names."""
    if not 1 <= top <= MOST:
        raise ValueError(f"top must be from 1 to {MOST}")
    sold = items.join(earning(orders, start, end).select("order_id"), "order_id")
    sums = sold.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"), F.sum("line_amount").cast("decimal(38,2)").alias("revenue"), F.countDistinct("order_id").alias("orders"))
    named = sums.join(products.select("product_id", "sku", "product_name", "category"), "product_id")
    return named.select("product_id", "sku", "product_name", "category", "units_sold", "revenue", "orders").orderBy(F.desc("revenue"), "product_id").limit(top)


def freshness(orders: DataFrame, items: DataFrame) -> DataFrame:
    names = ("source_updated_at", "pipeline_run_id", "pipeline_batch_id")
    facts = orders.select(*names).unionByName(items.select(*names))
    return facts.agg(*(F.max(n).alias(n) for n in names))


def latest_publication(publications: DataFrame) -> DataFrame:
    return publications.orderBy(F.desc("published_at")).limit(1)


def published(table: DataFrame, batch: int, column: str = "pipeline_batch_id") -> DataFrame:
    """A published view: exactly the rows of its batch."""
    return table.where(F.col(column) == F.lit(batch))
