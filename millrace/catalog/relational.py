"""Projection, filter, sort, limit and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import workspace
from millrace.catalog.registry import query
from millrace.catalog.standins import SHOP_EVENTS_SQL, SHOP_USERS_SQL, shop_events, shop_users, with_sql
from millrace.functions.columns import non_blank
from millrace.operators.membership import not_in

EVENTS = with_sql(SHOP_EVENTS_SQL)
USERS = with_sql(SHOP_USERS_SQL)

# ------------------------------------------------------------------ projection


@query("prj_01", EVENTS + "SELECT user_id, city AS user_city, state AS user_state FROM shop_events")
def nested_fields(t):
    return shop_events(t).select("user_id", F.col("geo.city").alias("user_city"), F.col("geo")["state"].alias("user_state"))


@query("prj_02", EVENTS + "SELECT event_id, device IN ('macOS', 'Android') AS apple_or_android FROM shop_events")
def expressions(t):
    return shop_events(t).selectExpr("event_id", "device IN ('macOS', 'Android') AS apple_or_android")


@query("prj_03", "SELECT c_custkey, c_name FROM customer")
def dropped_columns(t):
    customer = t.customer
    return customer.drop("c_acctbal", "c_nationkey").drop(customer.c_mktsegment)


@query("prj_04", "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_totalprice > 100000 AS is_large FROM orders")
def added_column(t):
    orders = t.orders.select("o_orderkey", "o_totalprice").withColumn("is_large", F.col("o_totalprice") > 100000)
    return orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)


@query("prj_05", "SELECT s_suppkey, s_acctbal AS balance FROM supplier")
def renamed_column(t):
    return t.supplier.select("s_suppkey", "s_acctbal").withColumnRenamed("s_acctbal", "balance")


@query("prj_06", "SELECT * EXCLUDE (l_shipdate, l_tax, l_linenumber) FROM lineitem")
def star_except(t):
    view = workspace.fresh_name("lineitem")
    t.lineitem.createOrReplaceTempView(view)
    return t.spark.sql(f"SELECT * EXCEPT (l_shipdate, l_tax, l_linenumber) FROM {view}")


@query("prj_07", EVENTS + "SELECT event_id, city, state FROM shop_events")
def struct_star(t):
    return shop_events(t).select("event_id", "geo.*")


@query("prj_08", """SELECT o_orderkey::VARCHAR AS key_text, trunc(o_totalprice)::BIGINT AS whole, (o_custkey % 100)::BIGINT AS small,
  o_orderkey::DOUBLE AS as_double, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders""")
def casts(t):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("key_text"), F.col("o_totalprice").cast("long").alias("whole"),
        (F.col("o_custkey") % 100).cast("int").alias("small"), F.col("o_orderkey").cast("double").alias("as_double"),
        F.date_format("o_orderdate", "yyyy-MM-dd").try_cast("date").alias("order_day"),
    )


@query("prj_09", "SELECT c_custkey, true AS known FROM customer")
def literal_column(t):
    return t.customer.select("c_custkey", F.lit(True).alias("known"))


@query("prj_10", """SELECT p_partkey, CASE WHEN p_name LIKE '%ring' THEN 'jewellery' WHEN p_size > 40 THEN 'bulky ' || p_name
  ELSE 'small ' || p_name END AS size_note FROM part""")
def conditional(t):
    note = (
        F.when(F.col("p_name").like("%ring"), "jewellery").when(F.col("p_size") > 40, F.concat(F.lit("bulky "), "p_name"))
        .otherwise(F.concat(F.lit("small "), "p_name"))
    )
    return t.part.select("p_partkey", note.alias("size_note"))


@query("prj_11", """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net,
  round(l_extendedprice * (1 - l_discount), 4) > 50000 AS is_large FROM lineitem""")
def lateral_alias(t):
    view = workspace.fresh_name("lineitem")
    t.lineitem.createOrReplaceTempView(view)
    return t.spark.sql(
        f"SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net, net > 50000 AS is_large FROM {view}"
    )


# ---------------------------------------------------------------------- filter


@query("flt_01", "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice < 950 AND p_size > 10")
def text_and_column_predicates(t):
    return t.part.where("p_retailprice < 950").filter(F.col("p_size") > 10).select("p_partkey", "p_retailprice")


@query("flt_02", EVENTS + "SELECT event_id, revenue FROM shop_events WHERE revenue IS NOT NULL UNION ALL "
       "SELECT event_id, revenue FROM shop_events WHERE item_quantity IS NULL AND device = 'macOS'")
def null_tests(t):
    events = shop_events(t).select("event_id", "device", F.col("ecommerce.purchase_revenue_in_usd").alias("revenue"), F.col("ecommerce.total_item_quantity").alias("n"))
    some = events.filter(F.col("revenue").isNotNull())
    none = events.filter(F.col("n").isNull() & (F.col("device") == "macOS"))
    return some.unionByName(none).select("event_id", "revenue")


@query("flt_03", """SELECT l_orderkey, l_partkey FROM lineitem WHERE (l_returnflag <> 'N' AND l_linestatus = 'F') OR l_quantity > 49""")
def conjunction(t):
    keep = ((F.col("l_returnflag") != "N") & (F.col("l_linestatus") == "F")) | (F.col("l_quantity") > 49)
    return t.lineitem.filter(keep).select("l_orderkey", "l_partkey")


@query("flt_04", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def membership(t):
    return t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@query("flt_05", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%' AND p_name NOT LIKE '%ring'")
def pattern(t):
    return t.part.filter(F.col("p_name").like("small%") & ~F.col("p_name").like("%ring")).select("p_partkey", "p_name")


@query("flt_06", USERS + r"SELECT user_id, email FROM shop_users WHERE regexp_matches(email, '^[a-z]+#\d{7}[02468]\d@mail[0-3]\.com$')")
def regular_expression(t):
    return shop_users(t).filter(F.rlike("email", F.lit(r"^[a-z]+#\d{7}[02468]\d@mail[0-3]\.com$"))).select("user_id", "email")


@query("flt_07", USERS + "SELECT user_id FROM shop_users WHERE ends_with(email, 'mail3.com')")
def suffix(t):
    return shop_users(t).filter(F.col("email").endswith("mail3.com")).select("user_id")


@query("flt_08", """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')""")
def in_subquery(t):
    promo = t.part.filter("p_type = 'PROMO'").select(F.col("p_partkey").alias("l_partkey"))
    return t.lineitem.join(promo, "l_partkey", "left_semi").select("l_orderkey", "l_partkey", "l_quantity")


@query("flt_09", """SELECT 'known' AS list, c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
  UNION ALL SELECT 'with null', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT nullif(o_custkey, 0) FROM orders)""")
def not_in_subquery(t):
    """A single null in the list removes every row of the second part."""
    customer = t.customer.select("c_custkey")
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    with_null = t.orders.select(F.nullif("o_custkey", F.lit(0)).alias("o_custkey"))
    part = lambda name, listed: not_in(customer, "c_custkey", listed, "o_custkey").select(F.lit(name).alias("list"), "c_custkey")
    return part("known", urgent).unionByName(part("with null", with_null))


@query("flt_10", USERS + "SELECT user_id, email FROM shop_users WHERE email IS NOT NULL")
def rows_without_nulls(t):
    return shop_users(t).select("user_id", "email").na.drop()


@query("flt_11", EVENTS + "SELECT event_id, coalesce(revenue, 0.0) AS revenue, coalesce(nullif(traffic_source, 'direct'), 'none') AS source FROM shop_events")
def filled_nulls(t):
    events = shop_events(t).select(
        "event_id", F.col("ecommerce.purchase_revenue_in_usd").alias("revenue"),
        F.nullif("traffic_source", F.lit("direct")).alias("source"),
    )
    return events.na.fill("none").na.fill(0.0)


@query("flt_12", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def replaced_values(t):
    return t.orders.select("o_orderkey", "o_orderstatus").na.replace({"F": "final", "O": "open"}, subset=["o_orderstatus"])


@query("flt_13", "SELECT l_orderkey, l_partkey, coalesce(nullif(trim(CASE WHEN l_returnflag = 'N' THEN ' ' ELSE l_returnflag END), ''), l_linestatus) AS flag FROM lineitem")
def blank_safe(t):
    flag = F.when(F.col("l_returnflag") == "N", " ").otherwise(F.col("l_returnflag"))
    return t.lineitem.select("l_orderkey", "l_partkey", F.coalesce(non_blank(flag), "l_linestatus").alias("flag"))


# --------------------------------------------------------------- sort and limit


@query("ord_01", "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer")
def sorted_rows(t):
    return t.customer.select("c_mktsegment", "c_acctbal", "c_custkey").sort(F.col("c_mktsegment").desc(), "c_acctbal", "c_custkey")


@query("ord_02", EVENTS + "SELECT event_id, revenue, row_number() OVER (ORDER BY revenue DESC NULLS LAST, event_id) > count(revenue) OVER () AS at_end FROM shop_events")
def nulls_last(t):
    """A whole sort; a row after the last known revenue is one without."""
    events = shop_events(t).select("event_id", F.col("ecommerce.purchase_revenue_in_usd").alias("revenue"))
    # the order is seen in the written parts: none begins before an earlier one's revenues are at an end
    sorted_ = workspace.settle(events.orderBy(F.col("revenue").desc_nulls_last(), "event_id").withColumn("place", F.monotonically_increasing_id()), "sorted")
    end = sorted_.filter("revenue is null").agg(F.min("place").alias("place")).first()["place"]
    return sorted_.select("event_id", "revenue", F.coalesce(F.col("place") >= F.lit(end).cast("bigint"), F.lit(False)).alias("at_end"))


@query("ord_03", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey, o_totalprice LIMIT 100")
def limited(t):
    """The limit is the feature; an order makes the kept rows the same in every run."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey", "o_totalprice").limit(100)


@query("ord_04", """SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1 ORDER BY spent DESC, o_custkey LIMIT 10""")
def top_k(t):
    spent = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return spent.orderBy(F.desc("spent"), "o_custkey").limit(10)


@query("ord_05", "SELECT 'first' AS action, min(o_orderkey)::BIGINT AS result FROM orders UNION ALL SELECT 'count', count(*) FROM orders UNION ALL SELECT 'take', 5")
def actions(t):
    """What first, count and take give, as rows; nothing passes through the driver."""
    orders = t.orders.select("o_orderkey")
    first = orders.orderBy("o_orderkey").limit(1).select(F.lit("first").alias("action"), F.col("o_orderkey").cast("bigint").alias("result"))
    count = lambda name, rows: rows.agg(F.lit(name).alias("action"), F.count("*").alias("result"))
    return first.unionByName(count("count", orders)).unionByName(count("take", orders.limit(5)))


# -------------------------------------------------------------- set operations


@query("set_01", """SELECT n_name AS name, count(*) AS times FROM (SELECT n_name FROM nation UNION ALL SELECT n_name FROM nation UNION ALL SELECT r_name FROM region) GROUP BY 1""")
def union_rows(t):
    names = t.nation.select(F.col("n_name").alias("name"))
    both = names.union(names).union(t.region.select("r_name"))
    return both.groupBy("name").agg(F.count("*").alias("times"))


@query("set_02", """SELECT l_orderkey, l_extendedprice, 'archive' AS part FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01'
  UNION ALL SELECT l_orderkey, l_extendedprice, 'current' FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01'""")
def union_all(t):
    archive = t.lineitem.filter("l_shipdate < '2001-01-01'").select("l_orderkey", "l_extendedprice", F.lit("archive").alias("part"))
    current = t.lineitem.filter("l_shipdate >= '2001-01-01'").select(F.lit("current").alias("part"), "l_extendedprice", "l_orderkey")
    return archive.unionByName(current)


@query("set_03", "SELECT l_partkey AS part, l_suppkey AS supplier FROM lineitem WHERE l_quantity < 25 UNION SELECT l_partkey, l_suppkey FROM lineitem WHERE l_quantity >= 20")
def union_distinct(t):
    pair = lambda condition: t.lineitem.filter(condition).select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"))
    return pair("l_quantity < 25").union(pair("l_quantity >= 20")).distinct()


SHAPED = ["nation", "region", "customer", "supplier", "part", "orders"]


@query("set_04", " UNION ALL ".join(
    f"SELECT '{n}' AS name, {n == 'nation'} AS like_nation, true AS like_copy, count(*) AS row_count FROM {n}" for n in SHAPED))
def schema_equality(t):
    """Each table's schema against that of another table and of its own written copy."""
    shape, parts = t.nation.schema, []
    for name in SHAPED:
        table = getattr(t, name)
        copy = workspace.settle(table.limit(0), "copy").schema
        same = lambda a, b: F.lit([(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b])
        parts.append(table.agg(F.lit(name).alias("name"), same(table.schema, shape).alias("like_nation"), same(table.schema, copy).alias("like_copy"), F.count("*").alias("row_count")))
    return reduce(DataFrame.unionByName, parts)
