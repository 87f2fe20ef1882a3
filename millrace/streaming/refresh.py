"""A whole refresh: landed files to bronze, silver, gold, in a fixed order.

Bronze and silver are incremental: a second run reads only new files.  Gold is
computed again from silver each time. What the rules of each silver table let pass is counted in the streams and
kept as events of the update.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.quality import expect, expect_or_drop, expect_or_fail
from millrace.streaming import cdc, ingest, metrics

ORDER_SHAPE = "order_id BIGINT, customer_id BIGINT, notifications STRING, order_timestamp BIGINT"
STATUS_SHAPE = "order_id BIGINT, status STRING, status_timestamp BIGINT"
CUSTOMER_SHAPE = "customer_id STRING, name STRING, email STRING, state STRING, operation STRING, timestamp STRING"
EMAIL = r"^[A-Za-z0-9._%+#-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def bronze(spark: SparkSession, landing: str, shape: str, out: str, loaded_at: str) -> None:
    rows = ingest.stream_files(spark, landing, shape)
    stamped = rows.select("*", F.lit(loaded_at).cast("timestamp").alias("processing_time"), F.col("_metadata.file_path").alias("source_file"))
    ingest.append(stamped, f"{out}/data", f"{out}/checkpoint")


def _read_stream(spark: SparkSession, table: str) -> DataFrame:
    return spark.readStream.schema(spark.read.parquet(f"{table}/data").schema).parquet(f"{table}/data")


def order_rules() -> dict[str, Column]:
    return {"valid_date": F.timestamp_seconds("order_timestamp") > F.lit("1990-01-01").cast("timestamp")}


def status_rules() -> dict[str, Column]:
    return {"valid_timestamp": F.timestamp_seconds("status_timestamp") > F.lit("1990-01-01").cast("timestamp")}


def silver_orders(spark: SparkSession, bronze_table: str, out: str, log: str, update: str) -> None:
    """An order without a usable time stops the refresh."""
    rows = metrics.observed(_read_stream(spark, bronze_table), "orders", order_rules())
    good = expect_or_fail(rows, order_rules())
    typed = good.withColumn("order_timestamp", F.timestamp_seconds("order_timestamp")).drop("source_file")
    metrics.record(ingest.append(typed, f"{out}/data", f"{out}/checkpoint"), "orders", log, update)


def silver_status(spark: SparkSession, bronze_table: str, out: str, log: str, update: str) -> None:
    rows = metrics.observed(_read_stream(spark, bronze_table), "status", status_rules())
    good = expect_or_drop(rows, status_rules())
    typed = good.withColumn("status_timestamp", F.timestamp_seconds("status_timestamp")).drop("source_file")
    metrics.record(ingest.append(typed, f"{out}/data", f"{out}/checkpoint"), "status", log, update)


def customer_rules() -> dict[str, dict]:
    """Rules of the change feed by what happens when they fail."""
    operation = F.col("operation")
    return {
        "fail": {"valid_id": F.col("customer_id").isNotNull()},
        "drop": {
            "valid_operation": operation.isNotNull(),
            "valid_email": (operation == "DELETE") | F.rlike("email", F.lit(EMAIL)),
        },
        "warn": {
            "valid_name": (operation == "DELETE") | F.col("name").isNotNull(),
            "valid_address": (operation == "DELETE") | F.col("state").isNotNull(),
        },
    }


def clean_changes(changes: DataFrame) -> DataFrame:
    rules = customer_rules()
    kept = expect_or_drop(expect_or_fail(changes, rules["fail"]), rules["drop"])
    return expect(kept, rules["warn"])


def silver_customers(spark: SparkSession, bronze_table: str, out: str, log: str, update: str) -> None:
    every: Mapping[str, Column] = {name: rule for rules in customer_rules().values() for name, rule in rules.items()}
    rows = metrics.observed(_read_stream(spark, bronze_table), "customers", every)
    changes = clean_changes(rows).withColumn("sequence", F.col("timestamp").cast("bigint"))
    query = cdc.apply_changes(changes, ["customer_id"], ["sequence", "operation"], f"{out}/state", f"{out}/checkpoint")
    metrics.record(query, "customers", log, update)


def expectation_counts(spark: SparkSession, out: str, update: str | None = None) -> DataFrame:
    """Passed and failed records by dataset and rule, of one update or of all so far."""
    events = spark.read.schema(metrics.EVENT).parquet(f"{out}/events")
    return metrics.expectation_counts(events if update is None else events.filter(F.col("origin.update_id") == update))


def customers(spark: SparkSession, silver: str) -> DataFrame:
    state = cdc.read_state(spark, f"{silver}/state")
    hidden = ["operation", "source_file", "sequence", "timestamp", *customer_rules()["warn"]]
    return cdc.visible(state, ["customer_id"], ["sequence", "operation"], F.col("operation") == "DELETE", hidden)


def orders_by_date(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.to_date("order_timestamp").alias("order_date")).agg(F.count("*").alias("total_daily_orders"))


def customers_by_state(customer_rows: DataFrame) -> DataFrame:
    return customer_rows.groupBy("state").agg(F.count("*").alias("customer_count"))


def subscribed_orders(orders: DataFrame, customer_rows: DataFrame) -> DataFrame:
    """Mail address of the customers who want to hear about an order."""
    wanted = orders.filter("notifications = 'Y'").select(
        F.col("customer_id").cast("string").alias("customer_id"), "order_id"
    )
    return wanted.join(customer_rows.select("customer_id", "name", "email"), "customer_id")


def order_updates(subscribed: DataFrame, status: DataFrame) -> DataFrame:
    return subscribed.join(status.select("order_id", "status", "status_timestamp"), "order_id")


def run(spark: SparkSession, landing: str, out: str, loaded_at: str, update: str | None = None) -> dict[str, DataFrame]:
    """One refresh of all tables; returns the gold results. ``update`` names it in the events (default: ``loaded_at``)."""
    metrics.remember(spark)
    log, update = f"{out}/events", update or loaded_at
    for name, shape in (("orders", ORDER_SHAPE), ("status", STATUS_SHAPE), ("customers", CUSTOMER_SHAPE)):
        bronze(spark, f"{landing}/{name}", shape, f"{out}/bronze-{name}", loaded_at)
    silver_orders(spark, f"{out}/bronze-orders", f"{out}/silver-orders", log, update)
    silver_status(spark, f"{out}/bronze-status", f"{out}/silver-status", log, update)
    silver_customers(spark, f"{out}/bronze-customers", f"{out}/silver-customers", log, update)
    orders = spark.read.parquet(f"{out}/silver-orders/data")
    status = spark.read.parquet(f"{out}/silver-status/data")
    people = customers(spark, f"{out}/silver-customers")
    subscribed = subscribed_orders(orders, people)
    return {
        "orders_by_date": orders_by_date(orders),
        "customers_by_state": customers_by_state(people),
        "subscribed_orders": subscribed,
        "order_updates": order_updates(subscribed, status),
    }
