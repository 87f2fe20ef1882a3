"""Web-shop products."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import standins as S
from millrace.catalog.registry import Tables, query
from millrace.plans import shop

EVENT_NAMES = ["click", "error", "purchase", "signup", "view"]
SALES_SQL = """sales AS (SELECT o_orderkey AS order_id, lower(c_name) || '@mail' || (c_nationkey % 5) || '.com' AS email, o_custkey::VARCHAR AS user_id, o_totalprice AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' AND o_custkey % 3 = 0)"""


def sales(t: Tables):
    """Urgent orders of every third customer; the others count as not converted."""
    some = t.orders.filter("o_orderpriority = '1-URGENT' AND o_custkey % 3 = 0")
    mail = F.concat(F.lower("c_name"), F.lit("@mail"), (F.col("c_nationkey") % 5).cast("string"), F.lit(".com"))
    return some.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("order_id"), mail.alias("email"), F.col("o_custkey").cast("string").alias("user_id"), F.col("o_totalprice").alias("revenue")
    )


@query("shp_01", S.with_sql(S.SHOP_EVENTS_SQL) + """SELECT traffic_source, round(total, 2) AS total_rev, round(mean, 2) AS avg_rev, trunc(round(total, 6) * 100) / 100 AS total_cut, trunc(round(mean, 6) * 100) / 100 AS avg_cut FROM
  (SELECT traffic_source, sum(revenue) AS total, avg(revenue) AS mean FROM shop_events WHERE revenue IS NOT NULL GROUP BY 1 ORDER BY total DESC, 1 LIMIT 3)""")
def revenue_by_traffic(t):
    return shop.revenue_by_traffic(S.shop_events(t))


USERS_AND_SALES = (S.SHOP_ITEMS_SQL, S.SHOP_USERS_SQL, SALES_SQL)
CONVERTED_SQL = """flagged AS (SELECT coalesce(u.email, s.email) AS email, u.user_id, s.email IS NOT NULL AS converted FROM shop_users u
  FULL JOIN (SELECT DISTINCT email FROM sales) s ON u.email = s.email WHERE coalesce(u.email, s.email) IS NOT NULL)"""


@query("shp_02", S.with_sql(*USERS_AND_SALES, CONVERTED_SQL) + """SELECT item_id, count(*) AS carts FROM (SELECT DISTINCT user_id, item_id FROM shop_items) c
  WHERE user_id IN (SELECT user_id FROM flagged WHERE NOT converted AND user_id IS NOT NULL) GROUP BY 1""")
def abandoned_carts(t):
    return shop.abandoned_carts(S.shop_events(t), S.shop_users(t), sales(t))


@query("shp_02_lists", S.with_sql(*USERS_AND_SALES, CONVERTED_SQL) + """SELECT f.user_id, f.email, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS cart FROM flagged f JOIN shop_items i ON f.user_id = i.user_id
  WHERE NOT converted GROUP BY 1, 2""")
def abandoned_cart_lists(t):
    lists = shop.abandoned_cart_lists(S.shop_events(t), S.shop_users(t), sales(t))
    return lists.withColumn("cart", F.array_join("cart", ","))


@query("shp_02_flags", S.with_sql(*USERS_AND_SALES, CONVERTED_SQL) + "SELECT converted, count(*) AS users, count(user_id) AS known FROM flagged GROUP BY 1")
def conversion_flags(t):
    flags = shop.conversions(S.shop_users(t), sales(t))
    return flags.groupBy("converted").agg(F.count("*").alias("users"), F.count("user_id").alias("known"))


_pivot = ", ".join(f"nullif(count(*) FILTER (WHERE event_name = '{n}'), 0) AS {n}" for n in EVENT_NAMES)


@query("shp_03", S.with_sql(S.SHOP_EVENTS_SQL) + f"""SELECT p.*, o_orderkey AS order_id, o_totalprice AS revenue FROM (SELECT user_id, {_pivot} FROM shop_events GROUP BY 1) p
  JOIN orders ON p.user_id = o_custkey::VARCHAR""")
def click_paths(t):
    orders = t.orders.select(F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("revenue"))
    return shop.click_paths(S.shop_events(t), EVENT_NAMES, orders)


@query("shp_04", S.with_sql(S.SHOP_USERS_SQL) + """SELECT user_id, email, strftime(make_timestamp(updated_s * 1000000), '%Y-%m-%d %H:%M:%S.%f') AS updated, strftime(make_timestamp(user_first_touch_timestamp), '%b %-d, %Y') AS first_touch_date,
  strftime(make_timestamp(user_first_touch_timestamp), '%H:%M:%S') AS first_touch_time, regexp_extract(email, '@(.+)$', 1) AS email_domain FROM shop_users""")
def clean_users(t):
    """Every user twice, once without mail, plus rows of nothing but nulls."""
    users = S.shop_users(t)
    nothing = users.filter("user_id = '0'").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in users.schema.fields])
    dirty = users.unionByName(users.withColumn("email", F.lit(None).cast("string"))).unionByName(nothing)
    return shop.clean_users(dirty)


_items = ", ".join(f'sum(CASE WHEN item_id = \'{i}\' THEN quantity END)::BIGINT AS "{i}"' for i in S.ITEM_IDS)


@query("shp_05", S.with_sql(S.SHOP_ITEMS_SQL, S.ITEM_LOOKUP_SQL) + f"""SELECT event_id, user_id, {_items} FROM shop_items WHERE event_name = 'purchase' AND item_id IN (SELECT item_id FROM item_lookup) GROUP BY 1, 2""")
def item_purchases(t):
    return shop.item_purchases(S.shop_events(t), S.item_lookup(t), S.ITEM_IDS)


@query("shp_06", S.with_sql(S.SHOP_EVENTS_SQL) + "SELECT event_id, device, traffic_source, revenue FROM shop_events WHERE revenue IS NOT NULL")
def purchase_revenues(t):
    events = shop.purchase_revenues(S.shop_events(t))
    return events.select("event_id", "device", "traffic_source", "revenue").orderBy(F.col("revenue").desc_nulls_last(), "event_id")
