"""One query for each operator over the star-schema test tables, and the same in DuckDB SQL."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conform
from .conform import table
from .entities import ENTITIES, Entity
from .functions import expressions as X
from .functions.canonical import canonical, decimal_text
from .operators import batches, checks, merge, snapshot
from .plans import marts, serving, staging
from .reconcile import measures
from .reconcile.rules import RETAIL, Aggregate, Rule
from .session import settle
from .sources import tables
from .streaming import parse

#: The run that queries are of: a cutoff that leaves rows out, and its interval.
BATCH, RUN = 6, "run-6"
START, END = date(1996, 1, 1), date(2000, 12, 31)
UNTIL = "2001-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Times as UTC wall-clock times without a zone."""
    return df.select(*(F.col(f"`{n}`").cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(f"`{n}`") for n, t in df.dtypes))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(f(settle(spark), sf_dir))

        run.__doc__, run.__name__ = f.__doc__, f.__name__
        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return run

    return add


# --- DuckDB building blocks, each named after what it stands for -------------------------------

MONEY = "DECIMAL(18,2)"
_TAIL = "CAST(CAST(updated_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS source_updated_at, batch_id AS source_batch_id"
_STAMP = f"'{RUN}' AS pipeline_run_id, CAST({BATCH} AS BIGINT) AS pipeline_batch_id"
_KEY = "CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_key"
BLOCKS = {
    "silver_customers": "SELECT c_custkey AS customer_id, ' ' || c_name || '@Example.Test ' AS email, split_part(c_name, '#', 1) AS first_name, CASE WHEN c_custkey % 10 = 0 THEN '  ' ELSE split_part(c_name, '#', 2) END AS last_name, CASE WHEN c_acctbal >= 0 THEN ' Active' ELSE 'INACTIVE ' END AS status, '1995-01-0' || (c_custkey % 9 + 1) || 'T08:00:00+02:00' AS updated_at, c_custkey % 7 + 1 AS batch_id FROM customer",
    "silver_products": f"SELECT p_partkey AS product_id, p_brand || '-' || p_partkey AS sku, p_name AS name, p_type AS category, CAST(p_retailprice AS {MONEY}) AS unit_price, p_size % 5 <> 0 AS active, '1995-02-0' || (p_partkey % 9 + 1) || 'T08:00:00Z' AS updated_at, p_partkey % 7 + 1 AS batch_id FROM part",
    "silver_orders": "SELECT o_orderkey AS order_id, o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS ordered_at, CASE WHEN o_orderstatus = 'F' THEN 'Shipped' WHEN o_orderstatus = 'O' THEN 'paid ' WHEN o_orderpriority = '5-LOW' THEN 'cancelled' ELSE 'pending' END AS status, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS updated_at, CAST(year(o_orderdate) - 1994 AS BIGINT) AS batch_id FROM orders",
    "line_ranked": "SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS n FROM lineitem",
    "silver_order_items": f"SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS {MONEY}) AS unit_price, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS updated_at, CAST(greatest(1, least(7, year(l_shipdate) - 1994)) AS BIGINT) AS batch_id FROM line_ranked WHERE n = 1",
    "stg_customers": f"SELECT customer_id, nullif(trim(first_name), '') AS first_name, nullif(trim(last_name), '') AS last_name, lower(nullif(trim(email), '')) AS email, lower(nullif(trim(status), '')) AS customer_status, {_TAIL} FROM silver_customers WHERE batch_id <= {BATCH}",
    "stg_products": f"SELECT product_id, nullif(trim(sku), '') AS sku, nullif(trim(name), '') AS product_name, nullif(trim(category), '') AS category, unit_price, active AS is_active, {_TAIL} FROM silver_products WHERE batch_id <= {BATCH}",
    "stg_orders": f"SELECT order_id, customer_id, lower(nullif(trim(status), '')) AS order_status, CAST(ordered_at AS TIMESTAMP) AS ordered_at, {_TAIL} FROM silver_orders WHERE batch_id <= {BATCH}",
    "stg_order_items": f"SELECT CAST(order_id AS VARCHAR) || ':' || CAST(line_number AS VARCHAR) AS order_item_id, order_id, line_number, product_id, quantity, unit_price, {_TAIL} FROM silver_order_items WHERE batch_id <= {BATCH}",
    "totals": f"SELECT order_id, CAST(sum(quantity * unit_price) AS {MONEY}) AS total, CAST(sum(quantity) AS BIGINT) AS quantity, count(*) AS lines FROM stg_order_items GROUP BY order_id",
    "orders_enriched": f"SELECT o.order_id, o.customer_id, c.first_name, c.last_name, c.email, o.order_status, o.ordered_at, CAST(o.ordered_at AS DATE) AS order_date, CAST(coalesce(t.total, 0) AS {MONEY}) AS order_total, coalesce(t.quantity, 0) AS item_quantity, coalesce(t.lines, 0) AS item_count, o.source_updated_at, o.source_batch_id FROM stg_orders o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id LEFT JOIN totals t ON o.order_id = t.order_id",
    "items_enriched": f"SELECT i.order_item_id, i.order_id, i.line_number, o.customer_id, i.product_id, p.sku, p.product_name, p.category, o.order_status, o.ordered_at, CAST(o.ordered_at AS DATE) AS order_date, i.quantity, i.unit_price, CAST(i.quantity * i.unit_price AS {MONEY}) AS line_amount, i.source_updated_at, i.source_batch_id FROM stg_order_items i LEFT JOIN stg_orders o ON i.order_id = o.order_id LEFT JOIN stg_products p ON i.product_id = p.product_id",
    "dim_customer": f"SELECT customer_id, first_name, last_name, nullif(trim(concat_ws(' ', first_name, last_name)), '') AS customer_name, email, customer_status, source_updated_at, source_batch_id, {_STAMP} FROM stg_customers",
    "dim_product": f"SELECT product_id, sku, product_name, category, unit_price, is_active, source_updated_at, source_batch_id, {_STAMP} FROM stg_products",
    "fact_order": f"SELECT order_id, customer_id, {_KEY}, order_status, ordered_at, order_total, item_quantity, item_count, source_updated_at, source_batch_id, {_STAMP} FROM orders_enriched",
    "fact_order_item": f"SELECT order_item_id, order_id, line_number, customer_id, product_id, {_KEY}, quantity, unit_price, line_amount, source_updated_at, source_batch_id, {_STAMP} FROM items_enriched",
    "earning": f"SELECT * FROM fact_order WHERE ordered_at >= TIMESTAMP '{START} 00:00:00' AND ordered_at < TIMESTAMP '{END} 00:00:00' + INTERVAL 1 DAY AND order_status NOT IN ('cancelled', 'refunded')",
    "changes": "SELECT '{\"user_id\":' || user_id || '}' AS key_json, user_id, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS operation, CAST(day(ts) AS BIGINT) AS batch_id, event_id AS source_lsn, CAST(ts AS DATE) AS event_date, ts, value, props FROM events",
    "user_ranked": "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY source_lsn DESC) AS n FROM changes WHERE batch_id <= 20",
    "user_history": "SELECT user_id, CASE operation WHEN 'c' THEN 'INSERT' WHEN 'd' THEN 'DELETE' ELSE 'UPDATE' END AS operation, batch_id, source_lsn AS history_id, ts, value FROM changes",
    "history_ranked": "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_id DESC, history_id DESC) AS n FROM user_history WHERE batch_id <= 20",
}
_NEEDS = {name: [b for b in BLOCKS if re.search(rf"\b(?:FROM|JOIN) {b}\b", text)] for name, text in BLOCKS.items()}


def sql(text: str, *blocks: str) -> str:
    """text with the building blocks that it names, and those that they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS[name]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in blocks:
        visit(name)
    return (f"WITH {', '.join(f'{n} AS ({BLOCKS[n]})' for n in order)} " if order else "") + text


def star(block: str) -> str:
    return sql(f"SELECT * FROM {block}", block)


# --- models ------------------------------------------------------------------------------------


def stg(spark: SparkSession, d: str, entity: str) -> DataFrame:
    return staging.STAGING[entity](conform.SILVER[entity](spark, d), BATCH)


def enriched(spark: SparkSession, d: str) -> DataFrame:
    return marts.orders_enriched(stg(spark, d, "orders"), stg(spark, d, "customers"), stg(spark, d, "order_items"))


def items(spark: SparkSession, d: str) -> DataFrame:
    return marts.order_items_enriched(stg(spark, d, "order_items"), stg(spark, d, "orders"), stg(spark, d, "products"))


def fact_orders(spark: SparkSession, d: str) -> DataFrame:
    return marts.fact_order(enriched(spark, d), RUN, BATCH)


def fact_items(spark: SparkSession, d: str) -> DataFrame:
    return marts.fact_order_item(items(spark, d), RUN, BATCH)


for _entity in ENTITIES:

    def _staged(spark: SparkSession, d: str, e: str = _entity) -> DataFrame:
        return stg(spark, d, e)

    def _compared(spark: SparkSession, d: str, e: str = _entity) -> DataFrame:
        return staging.compared(e, stg(spark, d, e))

    _staged.__name__, _compared.__name__ = f"stg_{_entity}", f"validation_{_entity}"
    query(star(f"stg_{_entity}"))(_staged)
    query(sql(f"SELECT {', '.join(f'{c} AS {n}' for n, c in staging.COMPARED[_entity].items())} FROM stg_{_entity}", f"stg_{_entity}"))(_compared)


@query(star("orders_enriched"))
def int_orders_enriched(spark, d):
    return enriched(spark, d)


@query(star("items_enriched"))
def int_order_items_enriched(spark, d):
    return items(spark, d)


@query(star("dim_customer"))
def dim_customer(spark, d):
    return marts.dim_customer(stg(spark, d, "customers"), RUN, BATCH)


@query(star("dim_product"))
def dim_product(spark, d):
    return marts.dim_product(stg(spark, d, "products"), RUN, BATCH)


@query(star("fact_order"))
def fact_order(spark, d):
    return fact_orders(spark, d)


@query(star("fact_order_item"))
def fact_order_item(spark, d):
    return fact_items(spark, d)


def _case(expr: str, names: tuple[str, ...]) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names, 1)) + " END"


CALENDAR = f"CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key, date_day, CAST(year(date_day) AS INTEGER) AS year_number, CAST(quarter(date_day) AS INTEGER) AS quarter_number, CAST(month(date_day) AS INTEGER) AS month_number, {_case('month(date_day)', X.MONTHS)} AS month_name, CAST(week(date_day) AS INTEGER) AS week_number, CAST(day(date_day) AS INTEGER) AS day_of_month, CAST(isodow(date_day) AS INTEGER) AS day_of_week, {_case('isodow(date_day)', X.DAYS)} AS day_name, isodow(date_day) IN (6, 7) AS is_weekend"


@query(sql(f"SELECT {CALENDAR}, {_STAMP} FROM (SELECT CAST(unnest(generate_series(least(coalesce(min(order_date), DATE '{START}'), DATE '{START}'), greatest(coalesce(max(order_date), DATE '{END}'), DATE '{END}'), INTERVAL 1 DAY)) AS DATE) AS date_day FROM orders_enriched) days", "orders_enriched"))
def dim_date(spark, d):
    return marts.dim_date(enriched(spark, d), START, END, RUN, BATCH)


@query(f"SELECT {CALENDAR} FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS date_day) days")
def calendar_labels(spark, d):
    return marts.calendar(marts.spine(spark, date(1995, 1, 1), date(2030, 12, 31)))


# --- scans, versions, state ----------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'")
def scan_project_orders(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_custkey", "o_orderdate")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ("customer", "events", "lineitem", "orders", "part")))
def parquet_row_counts(spark, d):
    return spark.createDataFrame([(t, tables.footer_rows(spark, f"{d}/{t}.parquet")) for t in ("customer", "events", "lineitem", "orders", "part")], "table_name string, row_count long")


@query(sql("SELECT order_id, source_batch_id, order_total FROM fact_order WHERE source_batch_id <= 3", "fact_order"))
def candidate_scan_cutoff(spark, d):
    path = scratch(spark, d, "fact_order")
    fact_orders(spark, d).write.mode("overwrite").parquet(path)
    return tables.candidate(spark, path, "source_batch_id", 3).select("order_id", "source_batch_id", "order_total")


_LINES = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"


@query(sql(f"SELECT {_LINES} FROM line_ranked WHERE n = 1", "line_ranked"))
def items_latest_version(spark, d):
    return snapshot.latest(conform.line_versions(spark, d), ("l_orderkey", "l_linenumber"), conform.VERSIONS).select(*_LINES.split(", "))


@query(sql(f"SELECT {_LINES} FROM line_ranked WHERE n = 1", "line_ranked"))
def items_latest_max_by(spark, d):
    return snapshot.latest_by_max(conform.line_versions(spark, d), ("l_orderkey", "l_linenumber"), conform.VERSIONS).select(*_LINES.split(", "))


_STATE = ("user_id", "operation", "batch_id", "source_lsn", "ts", "value")


@query(sql(f"SELECT {', '.join(_STATE)} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY source_lsn DESC) AS n FROM changes) r WHERE n = 1 AND operation <> 'd'", "changes"))
def events_current_state(spark, d):
    return snapshot.current_events(conform.changes(spark, d), 31).select(*_STATE)


@query(sql(f"SELECT {', '.join(_STATE)} FROM user_ranked WHERE n = 1 AND operation <> 'd'", "user_ranked"))
def events_state_as_of_batch(spark, d):
    return snapshot.current_events(conform.changes(spark, d), 20).select(*_STATE)


@query(sql(f"SELECT {', '.join(_STATE)} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY source_lsn DESC) AS n FROM changes WHERE batch_id <= 20 AND event_date <= DATE '2024-01-10') r WHERE n = 1 AND operation <> 'd'", "changes"))
def events_backfill_partition_end(spark, d):
    return snapshot.current_events(conform.changes(spark, d), 20, date(2024, 1, 10)).select(*_STATE)


@query(sql("SELECT key_json, batch_id, source_lsn, 'cdc.app.users' AS topic, CAST(user_id % 4 AS INTEGER) AS \"partition\", source_lsn AS \"offset\", operation FROM user_ranked WHERE n = 1 AND operation <> 'd'", "user_ranked"))
def snapshot_with_metadata(spark, d):
    return snapshot.current_events(conform.changes(spark, d), 20).select("key_json", "batch_id", "source_lsn", "topic", "partition", "offset", "operation")


@query(sql("SELECT user_id FROM history_ranked WHERE n = 1 AND operation = 'DELETE'", "history_ranked"))
def events_deleted_keys(spark, d):
    return snapshot.history_deleted(snapshot.with_deletion(conform.user_history(spark, d)), ("user_id",), 20)


@query(sql("SELECT user_id, left(operation, 1) AS operation, batch_id, history_id, ts, value FROM history_ranked WHERE n = 1 AND operation <> 'DELETE'", "history_ranked"))
def history_scan_cutoff(spark, d):
    return snapshot.history_state(snapshot.with_deletion(conform.user_history(spark, d)), ("user_id",), 20).select("user_id", "operation", "batch_id", "history_id", "ts", "value")


@query(sql("SELECT user_id, batch_id, count(*) AS occurrences FROM changes GROUP BY user_id, batch_id HAVING count(*) > 1", "changes"))
def events_duplicate_keys(spark, d):
    return snapshot.duplicate_keys(conform.changes(spark, d), ("user_id", "batch_id"))


@query(sql("SELECT max(batch_id) AS batch_id FROM (SELECT batch_id, CASE WHEN batch_id % 10 = 0 THEN NULL ELSE max(ts) END AS completed_at FROM changes GROUP BY batch_id) b WHERE completed_at < TIMESTAMP '2024-01-21 00:00:00'", "changes"))
def cutoff_max_closed_batch(spark, d):
    last = F.when(F.col("batch_id") % 10 != 0, F.max("ts"))
    return tables.last_closed(conform.changes(spark, d).groupBy("batch_id").agg(last.alias("completed_at")), date(2024, 1, 21))


# --- merges ----------------------------------------------------------------------------------------

@query(sql("SELECT customer_id, email, source_batch_id FROM stg_customers WHERE source_batch_id <= 4 AND customer_id % 3 <> 0 UNION ALL SELECT customer_id, upper(email) AS email, source_batch_id FROM stg_customers WHERE source_batch_id >= 5 OR customer_id % 3 = 0", "stg_customers"))
def merge_upsert_single_key(spark, d):
    rows = stg(spark, d, "customers").select("customer_id", "email", "source_batch_id")
    target = rows.where("source_batch_id <= 4")
    newer = rows.where("source_batch_id >= 5 or customer_id % 3 = 0").withColumn("email", F.upper("email"))
    return merge.merge(target, newer, ("customer_id",))


@query(sql("SELECT order_id, line_number, quantity, source_batch_id FROM stg_order_items WHERE source_batch_id <= 3 AND product_id % 4 <> 0 UNION ALL SELECT order_id, line_number, quantity + 100 AS quantity, source_batch_id FROM stg_order_items WHERE source_batch_id >= 5 OR (product_id % 4 = 0 AND source_batch_id <= 4)", "stg_order_items"))
def merge_upsert_composite_key(spark, d):
    rows = stg(spark, d, "order_items").select("order_id", "line_number", "quantity", "source_batch_id", "product_id")
    target = rows.where("source_batch_id <= 3")
    newer = rows.where("source_batch_id >= 5 or (product_id % 4 = 0 and source_batch_id <= 4)").withColumn("quantity", F.col("quantity") + 100)
    return merge.upsert(target, newer, ("order_id", "line_number")).drop("product_id")


@query(sql("SELECT order_id, order_total, source_batch_id FROM fact_order WHERE source_batch_id >= coalesce((SELECT max(source_batch_id) FROM fact_order WHERE source_batch_id <= 4), 0)", "fact_order"))
def incremental_high_water(spark, d):
    rows = fact_orders(spark, d).select("order_id", "order_total", "source_batch_id")
    return merge.increment(rows.where("source_batch_id <= 4"), rows, "source_batch_id")


# --- serving ---------------------------------------------------------------------------------------


@query(sql("SELECT min(CAST(ordered_at AS DATE)) AS first_date, max(CAST(ordered_at AS DATE)) AS last_date FROM fact_order", "fact_order"))
def order_date_range(spark, d):
    return serving.order_dates(fact_orders(spark, d))


@query(sql("SELECT CAST(coalesce(sum(order_total), 0) AS DECIMAL(38,2)) AS revenue, count(*) AS orders, count(DISTINCT customer_id) AS customers, round(CAST(coalesce(avg(order_total), 0) AS DOUBLE), 4) AS average_order_value FROM earning", "earning"))
def kpis(spark, d):
    out = serving.kpis(fact_orders(spark, d), START, END)
    return out.withColumn("average_order_value", F.round(F.col("average_order_value").cast("double"), 4))


@query(sql("SELECT CAST(ordered_at AS DATE) AS order_date, CAST(sum(order_total) AS DECIMAL(38,2)) AS revenue, count(*) AS orders FROM earning GROUP BY 1 ORDER BY 1", "earning"))
def daily_revenue(spark, d):
    return serving.daily_revenue(fact_orders(spark, d), START, END)


@query(sql("SELECT p.product_id, p.sku, p.product_name, p.category, CAST(sum(i.quantity) AS BIGINT) AS units_sold, CAST(sum(i.line_amount) AS DECIMAL(38,2)) AS revenue, count(DISTINCT i.order_id) AS orders FROM fact_order_item i JOIN earning o ON i.order_id = o.order_id JOIN dim_product p ON i.product_id = p.product_id GROUP BY ALL ORDER BY revenue DESC, p.product_id LIMIT 20", "fact_order_item", "earning", "dim_product"))
def product_performance_top20(spark, d):
    return serving.product_performance(fact_items(spark, d), fact_orders(spark, d), marts.dim_product(stg(spark, d, "products"), RUN, BATCH), START, END, 20)


@query(sql("SELECT max(source_updated_at) AS source_updated_at, max(pipeline_run_id) AS pipeline_run_id, max(pipeline_batch_id) AS pipeline_batch_id FROM (SELECT source_updated_at, pipeline_run_id, pipeline_batch_id FROM fact_order UNION ALL SELECT source_updated_at, pipeline_run_id, pipeline_batch_id FROM fact_order_item) f", "fact_order", "fact_order_item"))
def freshness(spark, d):
    return serving.freshness(fact_orders(spark, d), fact_items(spark, d))


@query(sql(f"SELECT order_id, order_total, pipeline_batch_id FROM fact_order WHERE pipeline_batch_id = {BATCH}", "fact_order"))
def published_batch_view(spark, d):
    return serving.published(fact_orders(spark, d), BATCH).select("order_id", "order_total", "pipeline_batch_id")


# --- data tests, on tables with planted faults -------------------------------------------------------


@query(sql("SELECT customer_id, email FROM stg_customers WHERE last_name IS NULL", "stg_customers"))
def dq_not_null(spark, d):
    return checks.is_null(stg(spark, d, "customers"), "last_name").select("customer_id", "email")


@query("SELECT l_orderkey AS l_orderkey, count(*) AS occurrences FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark, d):
    return checks.repeats(table(spark, d, "lineitem"), ("l_orderkey",))


@query("SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_combination(spark, d):
    return checks.repeats(table(spark, d, "lineitem"), ("l_orderkey", "l_linenumber"))


@query(sql("SELECT order_id, order_status FROM stg_orders WHERE order_status NOT IN ('pending', 'paid', 'shipped')", "stg_orders"))
def dq_accepted_values(spark, d):
    return checks.unaccepted(stg(spark, d, "orders"), "order_status", ("pending", "paid", "shipped")).select("order_id", "order_status")


@query(sql("SELECT order_id, customer_id FROM stg_orders o WHERE customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_customers c WHERE c.customer_id = o.customer_id)", "stg_orders", "stg_customers"))
def dq_relationships(spark, d):
    return checks.orphans(stg(spark, d, "orders"), "customer_id", stg(spark, d, "customers"), "customer_id").select("order_id", "customer_id")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def dq_non_negative(spark, d):
    return checks.negative(table(spark, d, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount <= 0")
def dq_positive(spark, d):
    return checks.not_positive(table(spark, d, "lineitem"), "l_discount").select("l_orderkey", "l_linenumber", "l_discount")


@query(sql("SELECT entity_name, expected_count, actual_count, actual_count - expected_count AS count_difference FROM (SELECT 'customer' AS entity_name, (SELECT count(*) FROM stg_customers) AS expected_count, (SELECT count(*) FROM dim_customer WHERE customer_id % 5 <> 0) AS actual_count UNION ALL SELECT 'product', (SELECT count(*) FROM stg_products), (SELECT count(*) FROM dim_product) UNION ALL SELECT 'order', (SELECT count(*) FROM stg_orders), (SELECT count(*) FROM fact_order WHERE item_count > 0) UNION ALL SELECT 'order_item', (SELECT count(*) FROM stg_order_items), (SELECT count(*) FROM fact_order_item)) c WHERE expected_count <> actual_count", "dim_customer", "dim_product", "fact_order", "fact_order_item"))
def reconcile_entity_counts(spark, d):
    customers, products = stg(spark, d, "customers"), stg(spark, d, "products")
    pairs = {
        "customer": (customers, marts.dim_customer(customers, RUN, BATCH).where("customer_id % 5 <> 0")),
        "product": (products, marts.dim_product(products, RUN, BATCH)),
        "order": (stg(spark, d, "orders"), fact_orders(spark, d).where("item_count > 0")),
        "order_item": (stg(spark, d, "order_items"), fact_items(spark, d)),
    }
    return checks.entity_counts(pairs)


@query(sql(f"SELECT order_id, order_total AS expected_amount, CAST(coalesce(t, 0) AS {MONEY}) AS actual_amount, CAST(coalesce(t, 0) - order_total AS {MONEY}) AS amount_difference FROM fact_order LEFT JOIN (SELECT order_id AS k, CAST(sum(line_amount) AS {MONEY}) AS t FROM fact_order_item WHERE line_number < 4 GROUP BY 1) s ON order_id = k WHERE abs(coalesce(t, 0) - order_total) > 0.01", "fact_order", "fact_order_item"))
def reconcile_order_amounts(spark, d):
    return checks.order_amounts(fact_orders(spark, d), fact_items(spark, d).where("line_number < 4"))


@query(sql(f"SELECT order_item_id, CAST(quantity * unit_price AS {MONEY}) AS expected_amount, CAST(quantity * unit_price + CASE WHEN product_id % 50 = 0 THEN 1 ELSE 0 END AS {MONEY}) AS actual_amount, CAST(CASE WHEN product_id % 50 = 0 THEN 1 ELSE 0 END AS {MONEY}) AS amount_difference FROM fact_order_item WHERE product_id % 50 = 0", "fact_order_item"))
def reconcile_item_amounts(spark, d):
    wrong = F.when(F.col("product_id") % 50 == 0, F.col("line_amount") + 1).otherwise(F.col("line_amount")).cast(X.MONEY)
    return checks.item_amounts(fact_items(spark, d).withColumn("line_amount", wrong))


def _beyond(column: str, alias: str, test: str) -> str:
    keys = {"customers": "CAST(customer_id AS VARCHAR)", "products": "CAST(product_id AS VARCHAR)", "orders": "CAST(order_id AS VARCHAR)", "order_items": "CAST(order_id AS VARCHAR) || ':' || CAST(line_number AS VARCHAR)"}
    return sql(" UNION ALL ".join(f"SELECT '{e}' AS source_name, {k} AS record_key, {column} AS {alias} FROM silver_{e} WHERE {test}" for e, k in keys.items()), *(f"silver_{e}" for e in keys))


_KEYS = {e.name: e.key for e in ENTITIES.values()}


@query(_beyond("batch_id", "source_batch_id", f"batch_id > {BATCH}"))
def source_batch_cutoff(spark, d):
    return checks.beyond_batch({e: make(spark, d) for e, make in conform.SILVER.items()}, _KEYS, BATCH)


@query(_beyond("updated_at", "source_updated_at", f"CAST(CAST(updated_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) >= TIMESTAMP '{UNTIL}'"))
def source_timestamp_cutoff(spark, d):
    return checks.beyond_time({e: make(spark, d) for e, make in conform.SILVER.items()}, _KEYS, f"{UNTIL}Z")


# --- reconciliation ----------------------------------------------------------------------------------

_RULES = {r.entity: r for r in RETAIL}
USER = Entity("users", {"user_id": "integer"}, ("user_id",), ("user_id",))
PAIR = Rule("order_items", {"order_id": "integer", "line_number": "integer", "product_id": "integer", "quantity": "integer", "unit_price": "decimal"}, ("order_id", "line_number"), {"product": ("product_id",)})


def both_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Source lines, and candidate lines that lack some and have some changed."""
    source = staging.compared("order_items", stg(spark, d, "order_items"))
    changed = F.when(F.col("product_id") % 40 == 0, F.col("quantity") + 1).otherwise(F.col("quantity"))
    return source, source.where("product_id % 30 <> 0").withColumn("quantity", changed)


SIDES = "source AS (SELECT order_id, line_number, product_id, quantity, unit_price FROM stg_order_items), candidate AS (SELECT order_id, line_number, product_id, quantity + CASE WHEN product_id % 40 = 0 THEN 1 ELSE 0 END AS quantity, unit_price FROM source WHERE product_id % 30 <> 0)"


def sides(text: str) -> str:
    return sql("", "stg_order_items").rstrip() + f", {SIDES} {text}"


@query(sides("SELECT 'order_items' AS entity, (SELECT count(*) FROM source) AS expected, (SELECT count(*) FROM candidate) AS actual, (SELECT count(*) FROM source) = (SELECT count(*) FROM candidate) AS passed"))
def rc_row_count(spark, d):
    return measures.row_counts(*both_sides(spark, d), PAIR)


_GROUPED = "SELECT coalesce(e.g, a.g) AS \"group\", e.v AS expected, a.v AS actual FROM ({}) e FULL JOIN ({}) a ON e.g = a.g WHERE e.v IS DISTINCT FROM a.v"


@query(sides(_GROUPED.format(*(f"SELECT 'I:' || product_id AS g, CAST(count(*) AS VARCHAR) AS v FROM {t} GROUP BY 1" for t in ("source", "candidate")))))
def rc_partition_count(spark, d):
    return measures.differences(*(measures.grouped_counts(x, PAIR, ("product_id",)) for x in both_sides(spark, d)))


@query(sides(_GROUPED.format(*(f"SELECT 'I:' || product_id AS g, 'M:' || CAST(CAST(sum(quantity) AS BIGINT) AS VARCHAR) AS v FROM {t} GROUP BY 1" for t in ("source", "candidate")))))
def rc_aggregate_sum(spark, d):
    spec = Aggregate("quantity", "sum", "quantity", ("product_id",))
    return measures.differences(*(measures.aggregate(x, PAIR, spec) for x in both_sides(spark, d)))


@query(sql("SELECT 'earliest_order' AS name, 'T:' || strftime(min(ordered_at), '%Y-%m-%dT%H:%M:%S.%fZ') AS value FROM stg_orders UNION ALL SELECT 'latest_order', 'T:' || strftime(max(ordered_at), '%Y-%m-%dT%H:%M:%S.%fZ') FROM stg_orders", "stg_orders"))
def rc_aggregate_minmax(spark, d):
    rows = staging.compared("orders", stg(spark, d, "orders"))
    out = [measures.aggregate(rows, _RULES["orders"], s).select(F.lit(s.name).alias("name"), "value") for s in _RULES["orders"].aggregates]
    return out[0].unionByName(out[1])


@query(sql("SELECT 'I:' || user_id AS \"group\" FROM history_ranked WHERE n = 1 AND operation = 'DELETE' AND user_id % 2 = 0", "history_ranked"))
def rc_deleted_absent(spark, d):
    rule = Rule("users", {"user_id": "integer"}, ("user_id",), {})
    history = snapshot.with_deletion(conform.user_history(spark, d))
    candidate = snapshot.history_ranked(history, ("user_id",), "batch_id", "history_id", 20).where("is_deleted = false or user_id % 2 = 0")
    return measures.still_present(candidate, snapshot.history_deleted(history, ("user_id",), 20), rule)


def _framed(text: str) -> str:
    return f"lpad(to_hex(octet_length(encode({text}))), 16, '0') || hex(encode({text}))"


@query(
    sql(
        "SELECT "
        + ", ".join(f"sha256(unhex(string_agg({_framed('k')} || {_framed(c)}, '' ORDER BY k))) AS {n}" for n, c in (("customer_id", "k"), ("email", "e"), ("updated_at", "u")))
        + " FROM (SELECT 'I:' || customer_id AS k, coalesce('S:' || email, 'N') AS e, 'T:' || strftime(source_updated_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS u FROM stg_customers) x",
        "stg_customers",
    )
)
def rc_checksum_exact(spark, d):
    return measures.exact_checksums(staging.compared("customers", stg(spark, d, "customers")), Rule("customers", {"customer_id": "integer", "email": "text", "updated_at": "timestamp"}, ("customer_id",), {}))


@query()
def rc_checksum_scalable(spark, d):
    """Hashes of another library than the oracle's; the tests hold it against equal and changed tables."""
    return measures.summed_checksums(staging.compared("order_items", stg(spark, d, "order_items")), PAIR)


@query("SELECT o_orderpriority AS entity, count(*) FILTER (o_totalprice >= 1000) AS checks_passed, count(*) FILTER (NOT o_totalprice >= 1000) AS checks_failed FROM orders GROUP BY 1")
def check_summary(spark, d):
    from .reconcile.service import summary

    return summary(table(spark, d, "orders").select(F.col("o_orderpriority").alias("entity"), (F.col("o_totalprice") >= 1000).alias("passed")))


_TEXTS = "(VALUES (1, 'plain'), (2, 'e' || chr(769) || 'te' || chr(769)), (3, chr(233) || 't' || chr(233)), (4, ''), (5, NULL), (6, chr(8491) || 'ngstrom'), (7, chr(64257) || 'ne')) AS t(id, x)"


@query(f"SELECT CAST(id AS INTEGER) AS id, CASE WHEN x IS NULL THEN 'N' ELSE 'S:' || nfc_normalize(x) END AS value FROM {_TEXTS}")
def canonical_text(spark, d):
    rows = [(1, "plain"), (2, "été"), (3, "été"), (4, ""), (5, None), (6, "Ångstrom"), (7, "ﬁne")]
    df = spark.createDataFrame(rows, "id int, x string")
    return df.select("id", canonical(F.col("x"), "text").alias("value"))


@query("SELECT p_partkey, 'M:' || CASE WHEN v LIKE '%.%' THEN rtrim(rtrim(v, '0'), '.') ELSE v END AS value FROM (SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS v FROM part) x")
def canonical_decimal(spark, d):
    return table(spark, d, "part").select("p_partkey", F.concat(F.lit("M:"), decimal_text(F.col("p_retailprice").cast(X.MONEY))).alias("value"))


@query("SELECT event_id, 'T:' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS value FROM events")
def canonical_timestamp(spark, d):
    return table(spark, d, "events").select("event_id", canonical(F.col("ts").cast("timestamp"), "timestamp").alias("value"))


# --- change events -------------------------------------------------------------------------------------

_CASES = [
    (1, "cdc.retail.customers", '{"customer_id":7}', '{"payload":{"op":"c","after":{"customer_id":7,"email":"a@b.c","first_name":"A","last_name":"B","status":"active","updated_at":"2025-01-01T00:00:00Z","batch_id":12},"source":{"lsn":9001,"ts_ms":1735689600000}}}', None),
    (2, "cdc.retail.customers", '{"customer_id":7}', "{not json", "invalid_json"),
    (3, "cdc.retail.customers", '{"customer_id":7}', "[1,2]", "invalid_json"),
    (4, "cdc.retail.unknown", '{"customer_id":7}', "{}", "unknown_topic"),
    (5, "cdc.retail.orders", '{"order_id":1}', '{"payload":5}', "invalid_envelope"),
    (6, "cdc.retail.orders", '{"order_id":1}', '{"op":"x"}', "unsupported_operation"),
    (7, "cdc.retail.orders", '{"order_id":1}', '{"op":"c"}', "invalid_envelope"),
    (8, "cdc.retail.orders", '{"order_id":1}', '{"op":"c","after":{"order_id":1}}', "invalid_envelope"),
    (9, "cdc.retail.orders", '{"order_id":1}', '{"op":"c","after":{"order_id":1},"source":{"lsn":true}}', "missing_source_lsn"),
    (10, "cdc.retail.orders", '{"order_id":1}', '{"op":"c","after":{"order_id":"1"},"source":{"lsn":5}}', "invalid_schema"),
    (11, "cdc.retail.orders", None, '{"op":"c","after":{"order_id":1,"customer_id":2,"ordered_at":"x","status":"paid","updated_at":"y","batch_id":1},"source":{"lsn":"5"}}', "missing_key"),
    (12, "cdc.retail.orders", '{"order_id":2}', '{"op":"c","after":{"order_id":1,"customer_id":2,"ordered_at":"x","status":"paid","updated_at":"y","batch_id":1},"source":{"lsn":5}}', "invalid_schema"),
    (13, "cdc.retail.orders", '{"order_id":1}', '{"op":"d","before":{"order_id":1,"customer_id":2,"ordered_at":"x","status":"paid","updated_at":"y"},"source":{"lsn":5}}', "missing_batch_id"),
    (14, "cdc.retail.orders", '{"order_id":1}', None, None),
    (15, "cdc.retail.orders", '{"other":1}', None, "missing_key"),
    (16, "CDC.Retail.ORDERS", '{"order_id":1}', '{"op":"r","after":{"order_id":1,"customer_id":2,"ordered_at":1,"status":"paid","updated_at":"y"},"source":{"lsn":0,"batch_id":"3"}}', None),
]


def _text(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


@query("SELECT CAST(id AS INTEGER) AS id, reason_code FROM (VALUES " + ", ".join(f"({i}, {_text(r)})" for i, *_, r in _CASES) + ") AS t(id, reason_code)")
def cdc_reason_codes(spark, d):
    rows = [(None if k is None else k.encode(), None if v is None else v.encode(), t, 0, i, None) for i, t, k, v, _ in _CASES]
    found = parse.classified(spark.createDataFrame(rows, tables.RECORD))
    return found.select(F.col("offset").cast("int").alias("id"), "reason_code")


@query("SELECT topic, CASE WHEN lower(split_part(topic, '.', -1)) IN ('customers', 'products', 'orders', 'order_items') THEN lower(split_part(topic, '.', -1)) END AS entity FROM (VALUES " + ", ".join(f"({_text(t)})" for t in ("a.b.customers", "ORDERS", "x.Order_Items", "x.other", "", "products.", "a.products")) + ") AS t(topic)")
def cdc_topic_entity(spark, d):
    df = spark.createDataFrame([(t,) for t in ("a.b.customers", "ORDERS", "x.Order_Items", "x.other", "", "products.", "a.products")], "topic string")
    return df.select("topic", parse.entity_of(F.col("topic")).alias("entity"))


_ORDERS = [(1, '{"data_collection_order":4,"total_order":9}', 4), (2, '{"data_collection_order":0,"total_order":9}', 9), (3, '{"total_order":"7"}', 7), (4, "{}", 0), (5, '{"data_collection_order":-1,"total_order":true}', 0)]


@query("SELECT CAST(id AS INTEGER) AS id, CAST(o AS BIGINT) AS transaction_order FROM (VALUES " + ", ".join(f"({i}, {o})" for i, _, o in _ORDERS) + ") AS t(id, o)")
def cdc_tx_order(spark, d):
    body = '{"op":"c","after":{"order_id":1,"customer_id":2,"ordered_at":"x","status":"paid","updated_at":"y","batch_id":1},"source":{"lsn":5},"transaction":%s}'
    rows = [(b'{"order_id":1}', (body % t).encode(), "orders", 0, i, None) for i, t, _ in _ORDERS]
    found = parse.events(parse.classified(spark.createDataFrame(rows, tables.RECORD)))
    return found.select(F.col("offset").cast("int").alias("id"), "transaction_order")


_DECIMALS = [("AQAAAAAAAAAAAAAAAAAAAAAAAAA=", 3, f"{2**152 // 1000}.{2**152 % 1000:03}"), ("gAAAAAAAAAAAAAAAAAAAAA==", 0, str(-(2**127))), ("B8s=", 2, "19.95"), ("AA==", 2, "0.00"), ("/w==", 2, "-0.01"), ("gA==", 0, "-128"), ("AIA=", 1, "12.8"), ("19.95", 2, None), ("////", 3, "-0.001"), ("", 2, None)]


@query("SELECT CAST(id AS INTEGER) AS id, value FROM (VALUES " + ", ".join(f"({i}, {_text(v)})" for i, (*_, v) in enumerate(_DECIMALS)) + ") AS t(id, value)")
def cdc_decimal_decode(spark, d):
    df = spark.createDataFrame([(i, t, s) for i, (t, s, _) in enumerate(_DECIMALS)], "id int, t string, s long")
    return df.select("id", parse.decoded_decimal(F.col("t"), F.col("s")).alias("value"))


@query("SELECT p_partkey AS product_id, p_name AS name, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price, p_size % 2 = 0 AS active FROM part")
def cdc_typed_row(spark, d):
    p = table(spark, d, "part")
    body = F.to_json(F.struct(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_retailprice").cast(X.MONEY).cast("string").alias("unit_price"), (F.col("p_size") % 2 == 0).alias("active")))
    return p.select(F.from_json(body, ENTITIES["products"].row_type()).alias("r")).select("r.product_id", "r.name", "r.unit_price", "r.active")


@query(sql("SELECT source_lsn, key_json FROM changes", "changes"))
def cdc_key_json(spark, d):
    e = table(spark, d, "events")
    made = parse.parsed(F.concat(F.lit('{ "user_id" : '), F.col("user_id").cast("string"), F.lit(" }")))
    return e.select(F.col("event_id").alias("source_lsn"), parse.key_json(USER, made).alias("key_json"))


@query("SELECT event_id, CAST(ts AS DATE) AS event_date FROM events")
def cdc_event_date(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", parse.event_day(F.unix_millis(F.col("ts").cast("timestamp")), F.lit(None).cast("timestamp")).alias("event_date"))


@query(sql("SELECT DISTINCT event_date FROM changes", "changes"))
def distinct_event_dates(spark, d):
    return batches.event_days(conform.changes(spark, d))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def props_json_extract(spark, d):
    return table(spark, d, "events").select("event_id", parse.natural(parse.at(parse.parsed(F.col("props")), "k")).alias("k"))


@query(sql("SELECT batch_id, count(*) AS mutations FROM (SELECT batch_id FROM silver_customers UNION ALL SELECT batch_id FROM silver_products UNION ALL SELECT batch_id FROM silver_orders UNION ALL SELECT batch_id FROM silver_order_items) m GROUP BY 1", *(f"silver_{e}" for e in ENTITIES)))
def batch_mutation_counts(spark, d):
    return batches.mutation_counts(make(spark, d) for make in conform.SILVER.values())


@query(sql("SELECT batch_id, md5(string_agg(v, '|' ORDER BY v)) AS checksum FROM (SELECT batch_id, 'product:' || product_id || ':' || sku || ':' || CAST(unit_price AS VARCHAR) || ':' || batch_id AS v FROM silver_products) x GROUP BY 1", "silver_products"))
def batch_source_checksum(spark, d):
    p = conform.products(spark, d)
    record = batches.record_text("product", F.col("product_id"), F.col("sku"), F.col("unit_price"), F.col("batch_id"))
    return batches.checksums(p.select("batch_id", record.alias("record")))


# --- stored tables and streams ---------------------------------------------------------------------------


def scratch(spark: SparkSession, d: str, name: str) -> str:
    """A fresh folder that driver and executors share, for tables that a query stores and reads again."""
    import tempfile
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None) or os.path.join(tempfile.gettempdir(), "weirgate")
    return f"{root.rstrip('/')}/queries/{name}-{uuid.uuid4().hex}"


@query(star("silver_orders"))
def silver_write_read_roundtrip(spark, d):
    return tables.written(conform.orders(spark, d), scratch(spark, d, "silver"))


def _topic_log(spark: SparkSession, d: str, broken: bool) -> tuple[str, str]:
    """Orders as change events in a topic log; with broken, each tenth has no log position."""
    o = conform.orders(spark, d)
    after = F.struct(*(F.col(c) for c in o.columns))
    lsn = F.when(F.lit(broken) & (F.col("order_id") % 10 == 0), F.lit(None).cast("bigint")).otherwise(F.col("order_id"))
    body = F.struct(F.lit("c").alias("op"), after.alias("after"), F.struct(lsn.alias("lsn"), F.unix_millis(F.col("ordered_at").cast("timestamp")).alias("ts_ms")).alias("source"))
    rows = o.select(F.to_json(F.struct("order_id")).cast("binary").alias("key"), F.to_json(F.struct(body.alias("payload"))).cast("binary").alias("value"), F.lit("cdc.retail.orders").alias("topic"), F.lit(0).alias("partition"), F.col("order_id").alias("offset"), F.lit("2025-01-01").cast("timestamp").alias("timestamp"))
    root = scratch(spark, d, "stream")
    rows.coalesce(4).write.parquet(f"{root}/log")
    return root, f"{root}/log"


def _streamed(spark: SparkSession, d: str, broken: bool, times: int = 1):
    from datetime import UTC, datetime

    from .context import Layout, Run
    from .streaming.bronze import ingest

    root, log = _topic_log(spark, d, broken)
    run, layout = Run(RUN, BATCH, datetime(1995, 1, 1, tzinfo=UTC), datetime(2025, 1, 1, tzinfo=UTC)), Layout(root)
    for _ in range(times):
        ingest(tables.topic_stream(spark, "cdc.retail.orders", log=log), layout, run, "orders", "cdc.retail.orders")
    return layout


_ROUND = "SELECT order_id, customer_id, ordered_at, status, updated_at, batch_id FROM silver_orders"


@query(sql(f"{_ROUND} WHERE batch_id <= {BATCH}", "silver_orders"))
def stream_bronze_roundtrip(spark, d):
    from .pipeline import EVENTS

    layout = _streamed(spark, d, False)
    rows = snapshot.snapshot(tables.bronze(spark, layout.bronze("orders"), EVENTS), ENTITIES["orders"].row_type(), BATCH)
    return rows.select("order_id", "customer_id", "ordered_at", "status", "updated_at", "batch_id")


@query(sql("SELECT 'missing_source_lsn' AS reason_code, order_id AS \"offset\" FROM silver_orders WHERE order_id % 10 = 0", "silver_orders"))
def stream_dead_letters(spark, d):
    layout = _streamed(spark, d, True)
    return spark.read.option("basePath", layout.dead_letters("orders")).parquet(layout.dead_letters("orders")).select("reason_code", "offset")


@query(sql("SELECT count(*) AS events, count(DISTINCT order_id) AS orders FROM silver_orders", "silver_orders"))
def stream_replay_idempotent(spark, d):
    from .pipeline import EVENTS

    layout = _streamed(spark, d, False, times=2)
    return tables.bronze(spark, layout.bronze("orders"), EVENTS).agg(F.count(F.lit(1)).alias("events"), F.countDistinct("key_json").alias("orders"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned lines, staged and joined to orders, as revenue by day."""
    return QUERIES["daily_revenue"](spark, sf_dir)
