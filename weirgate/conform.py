"""Star-schema test tables in the retail shape, with versions, batches and padded text for the engine to deal with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.expressions import MONEY
from .operators.snapshot import latest

#: Order of versions of a line: ship date, part, supplier, then the rest, so that it is total.
VERSIONS = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(time: str) -> Column:
    return F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    number = F.element_at(F.split("c_name", "#"), 2)
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), "c_name", F.lit("@Example.Test ")).alias("email"),
        F.element_at(F.split("c_name", "#"), 1).alias("first_name"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit("  ")).otherwise(number).alias("last_name"),
        F.when(F.col("c_acctbal") >= 0, F.lit(" Active")).otherwise(F.lit("INACTIVE ")).alias("status"),
        F.concat(F.lit("1995-01-0"), (F.col("c_custkey") % 9 + 1).cast("string"), F.lit("T08:00:00+02:00")).alias("updated_at"),
        (F.col("c_custkey") % 7 + 1).cast("bigint").alias("batch_id"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat("p_brand", F.lit("-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        (F.col("p_size") % 5 != 0).alias("active"),
        F.concat(F.lit("1995-02-0"), (F.col("p_partkey") % 9 + 1).cast("string"), F.lit("T08:00:00Z")).alias("updated_at"),
        (F.col("p_partkey") % 7 + 1).cast("bigint").alias("batch_id"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        iso("o_orderdate").alias("ordered_at"),
        F.when(status == "F", F.lit("Shipped")).when(status == "O", F.lit("paid ")).when(F.col("o_orderpriority") == "5-LOW", F.lit("cancelled")).otherwise(F.lit("pending")).alias("status"),
        iso("o_orderdate").alias("updated_at"),
        (F.year("o_orderdate") - 1994).cast("bigint").alias("batch_id"),
    )


def line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of each line; a line's batch is its ship year, kept within 1 to 7."""
    newest = latest(line_versions(spark, sf_dir), ("l_orderkey", "l_linenumber"), VERSIONS)
    return newest.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("unit_price"),
        iso("l_shipdate").alias("updated_at"),
        F.greatest(F.lit(1), F.least(F.lit(7), F.year("l_shipdate") - 1994)).cast("bigint").alias("batch_id"),
    )


SILVER = {"customers": customers, "products": products, "orders": orders, "order_items": order_items}


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as change events of users: signup creates, error deletes, others update."""
    e = table(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return e.select(
        F.to_json(F.struct(F.col("user_id"))).alias("key_json"),
        "user_id",
        op.alias("operation"),
        F.dayofmonth("ts").cast("bigint").alias("batch_id"),
        F.col("event_id").alias("source_lsn"),
        F.lit(0).cast("bigint").alias("transaction_order"),
        F.lit("cdc.app.users").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.lit(False).alias("is_tombstone"),
        F.to_date("ts").alias("event_date"),
        F.col("ts"),
        F.col("value"),
        F.col("props"),
    )


def user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as source history, with operations spelled out."""
    word = F.when(F.col("operation") == "c", "INSERT").when(F.col("operation") == "d", "DELETE").otherwise("UPDATE")
    return changes(spark, sf_dir).select("user_id", word.alias("operation"), "batch_id", F.col("source_lsn").alias("history_id"), "ts", "value")
