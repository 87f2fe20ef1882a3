"""Web-shop products over ``events, sales, users, items``.

``sales`` holds one row per order with its mail address and revenue.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import truncated


def revenue_by_traffic(events: DataFrame, top: int = 3) -> DataFrame:
    """Sources with the greatest revenue, sums and means rounded and cut off to cents."""
    revenue = F.col("ecommerce.purchase_revenue_in_usd")
    best = (
        events.filter(revenue.isNotNull()).groupBy("traffic_source")
        .agg(F.sum(revenue).alias("total"), F.avg(revenue).alias("mean"))
        .orderBy(F.desc("total"), "traffic_source").limit(top)
    )
    cents = lambda c: F.round(c, 2)
    # the sum of cents is rounded before it is cut, or its binary error would show
    return best.select(
        "traffic_source", cents("total").alias("total_rev"), cents("mean").alias("avg_rev"),
        truncated(F.round("total", 6), 2).alias("total_cut"), truncated(F.round("mean", 6), 2).alias("avg_cut"),
    )


def purchase_revenues(events: DataFrame) -> DataFrame:
    """Events with revenue, greatest first, without the fields that are then constant."""
    revenue = F.col("ecommerce.purchase_revenue_in_usd")
    return events.withColumn("revenue", revenue).filter("revenue IS NOT NULL").drop("event_name")


def conversions(users: DataFrame, sales: DataFrame) -> DataFrame:
    """Every user and buyer with a flag for having bought."""
    # users without a mail address are in neither part, so they do not meet in one task
    known = users.filter("email IS NOT NULL")
    buyers = sales.select("email").filter("email IS NOT NULL").distinct().withColumn("converted", F.lit(True))
    strangers = buyers.join(known.select("email").distinct(), "email", "left_anti")
    return known.join(buyers, "email", "left").unionByName(strangers, allowMissingColumns=True).na.fill(False, ["converted"])


def carts(events: DataFrame) -> DataFrame:
    """Distinct items each user put into a cart, one row per user and item."""
    items = events.select("user_id", F.explode("items").alias("item"))
    return items.select("user_id", F.col("item.item_id").alias("item_id")).distinct()


def abandoned_carts(events: DataFrame, users: DataFrame, sales: DataFrame) -> DataFrame:
    """Items in the carts of users who did not buy, with the number of such carts.

    Works on (user, item) rows from start to end; no list of items per user is
    ever built.
    """
    idle = conversions(users, sales).filter("NOT converted").select("user_id")
    return carts(events).join(idle, "user_id", "left_semi").groupBy("item_id").agg(F.count("*").alias("carts"))


def abandoned_cart_lists(events: DataFrame, users: DataFrame, sales: DataFrame) -> DataFrame:
    """One row per idle user with a cart: mail address and the item ids, bounded by the item list."""
    listed = carts(events).groupBy("user_id").agg(F.array_sort(F.collect_set("item_id")).alias("cart"))
    flagged = conversions(users, sales).join(listed, "user_id", "left")
    return flagged.filter("NOT converted AND cart IS NOT NULL").select("user_id", "email", "cart")


def click_paths(events: DataFrame, names: Sequence[str], orders: DataFrame) -> DataFrame:
    """Event counts per user, one column per event name, beside the user's orders."""
    path = events.groupBy("user_id").pivot("event_name", list(names)).count()
    return path.join(orders, "user_id")


def clean_users(users: DataFrame) -> DataFrame:
    """One row per user and first visit, with day, time and mail domain of the visit."""
    known = users.filter("user_id IS NOT NULL")
    single = known.groupBy("user_id", "user_first_touch_timestamp").agg(F.max("email").alias("email"), F.max("updated").alias("updated"))
    first = F.timestamp_micros("user_first_touch_timestamp")
    return single.select(
        "user_id", "email", "updated", F.date_format(first, "MMM d, yyyy").alias("first_touch_date"),
        F.date_format(first, "HH:mm:ss").alias("first_touch_time"), F.regexp_extract("email", "(?<=@).+", 0).alias("email_domain"),
    )


def item_purchases(events: DataFrame, lookup: DataFrame, item_ids: Sequence[str]) -> DataFrame:
    """Quantity of each listed item per purchase, one column per item."""
    bought = events.filter("event_name = 'purchase'").select("event_id", "user_id", F.explode("items").alias("item"))
    named = bought.join(lookup, F.col("item.item_id") == F.col("item_id"))
    return named.groupBy("event_id", "user_id").pivot("item_id", list(item_ids)).agg(F.sum("item.quantity"))
