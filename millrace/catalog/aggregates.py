"""Grouping, distinct, pivot and summary statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import workspace
from millrace.catalog import standins as S
from millrace.catalog.registry import query
from millrace.operators import sketches

EVENTS = S.with_sql(S.SHOP_EVENTS_SQL)
ITEMS = S.with_sql(S.SHOP_ITEMS_SQL)
USERS = S.with_sql(S.SHOP_USERS_SQL)


@query("agg_01", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def group_count(t):
    return t.events.groupBy("event_type").count()


@query("agg_02", EVENTS + "SELECT state, city, round(avg(revenue), 4) AS avg_revenue, sum(item_quantity)::BIGINT AS quantity FROM shop_events GROUP BY 1, 2")
def nested_keys(t):
    grouped = S.shop_events(t).groupBy("geo.state", "geo.city")
    return grouped.agg(
        F.round(F.avg("ecommerce.purchase_revenue_in_usd"), 4).alias("avg_revenue"),
        F.sum("ecommerce.total_item_quantity").alias("quantity"),
    )


@query("agg_03", EVENTS + "SELECT traffic_source, round(sum(revenue), 2) AS total_rev, round(avg(revenue), 4) AS avg_rev FROM shop_events GROUP BY 1")
def named_aggregates(t):
    revenue = F.col("ecommerce.purchase_revenue_in_usd")
    return S.shop_events(t).groupBy("traffic_source").agg(
        F.round(F.sum(revenue), 2).alias("total_rev"), F.round(F.avg(revenue), 4).alias("avg_rev")
    )


@query("agg_04", "SELECT l_returnflag, l_linestatus, count(DISTINCT l_partkey) AS parts, true AS within_bound FROM lineitem GROUP BY 1, 2")
def approximate_distinct(t):
    """Sketches by day and group, united over the days, against the exact count of each group; three standard errors are allowed."""
    keys = ["l_returnflag", "l_linestatus"]
    daily = sketches.distinct_sketches(t.lineitem, [*keys, F.to_date("l_shipdate").alias("day")], "l_partkey")
    about = sketches.distinct_of(daily, keys)
    exact = t.lineitem.groupBy(*keys).agg(F.count_distinct("l_partkey").alias("parts"))
    bound = F.abs(F.col("about") - F.col("parts")) <= F.col("parts") * 0.05
    return exact.join(about, keys).select(*keys, "parts", bound.alias("within_bound"))


@query("agg_05", USERS + "SELECT count(*) AS row_count, count(email) AS emails, count(user_id) AS users FROM shop_users")
def non_null_counts(t):
    return S.shop_users(t).agg(F.count("*").alias("row_count"), F.count("email").alias("emails"), F.count("user_id").alias("users"))


@query("agg_06", USERS + "SELECT count(*) FILTER (WHERE email IS NULL) AS without_email, count(*) FILTER (WHERE email LIKE '%mail1%') AS at_mail1 FROM shop_users")
def conditional_count(t):
    return S.shop_users(t).agg(
        F.count_if(F.col("email").isNull()).alias("without_email"), F.count_if(F.col("email").like("%mail1%")).alias("at_mail1")
    )


@query("agg_07", """SELECT count(*) AS pairs FROM (SELECT DISTINCT l_suppkey, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END FROM lineitem)""")
def distinct_tuples(t):
    """A tuple with a null field still counts."""
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return t.lineitem.agg(F.count_distinct(F.struct("l_suppkey", flag)).alias("pairs"))


@query("agg_08", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber::BIGINT AS l_linenumber FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("agg_09", "SELECT DISTINCT user_id, event_type FROM events")
def one_row_per_key(t):
    """Which row is kept is open, so only the keys are returned."""
    return t.events.dropDuplicates(["user_id", "event_type"]).select("user_id", "event_type")


@query("agg_10", "SELECT user_id, event_type, max(value) AS value, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS updated FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2")
def dedup_by_max(t):
    known = t.events.filter("user_id IS NOT NULL")
    return known.groupBy("user_id", "event_type").agg(F.max("value").alias("value"), F.max("ts").alias("updated"))


@query("agg_11", """SELECT 'orders' AS name, max(n) <= 1 AS is_unique FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)
  UNION ALL SELECT 'events', max(n) <= 1 FROM (SELECT count(*) AS n FROM events GROUP BY user_id)""")
def uniqueness(t):
    def test(df, key, name):
        return df.groupBy(key).count().agg(F.lit(name).alias("name"), (F.max("count") <= 1).alias("is_unique"))

    return test(t.orders, "o_orderkey", "orders").unionByName(test(t.events, "user_id", "events"))


@query("agg_12", ITEMS + """SELECT e.user_id, string_agg(DISTINCT e.event_name, ',' ORDER BY e.event_name) AS event_history,
  (SELECT string_agg(DISTINCT item_id, ',' ORDER BY item_id) FROM shop_items i WHERE i.user_id = e.user_id) AS cart_history
  FROM shop_events e GROUP BY 1""")
def collected_sets(t):
    """Event names and item ids of each user; both sets are bounded by their small domains."""
    events = S.shop_events(t)
    names = F.array_sort(F.collect_set("event_name"))
    names = events.groupBy("user_id").agg(F.array_join(names, ",").alias("event_history"))
    # flatten before collecting: one set of ids is built per task, never a list of arrays per user
    ids = events.select("user_id", F.explode_outer("items.item_id").alias("item_id"))
    ids = ids.groupBy("user_id").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    cart = ids.select("user_id", F.when(F.size("ids") > 0, F.array_join("ids", ",")).alias("cart_history"))
    return names.join(cart, "user_id")


@query("agg_13", """SELECT user_id, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS counted FROM
  (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1""")
def collected_list(t):
    """Lists are collected from counted values, so their length does not grow with the rows."""
    counted = t.events.groupBy("user_id", "event_type").count()
    pairs = F.array_sort(F.collect_list(F.concat_ws(":", "event_type", F.col("count").cast("string"))))
    return counted.groupBy("user_id").agg(F.array_join(pairs, ",").alias("counted"))


@query("agg_14", """SELECT o_custkey, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS F, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS O,
  sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS P FROM (SELECT o_custkey, o_orderstatus, floor(o_totalprice)::DOUBLE AS o_totalprice FROM orders) GROUP BY 1""")
def pivot_listed(t):
    orders = t.orders.select("o_custkey", "o_orderstatus", F.floor("o_totalprice").cast("double").alias("o_totalprice"))
    return orders.groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.sum("o_totalprice"))


@query("agg_15", EVENTS + """SELECT user_id, nullif(count(*) FILTER (WHERE event_name = 'click'), 0) AS click, nullif(count(*) FILTER (WHERE event_name = 'error'), 0) AS error,
  nullif(count(*) FILTER (WHERE event_name = 'purchase'), 0) AS purchase, nullif(count(*) FILTER (WHERE event_name = 'signup'), 0) AS signup,
  nullif(count(*) FILTER (WHERE event_name = 'view'), 0) AS view FROM shop_events GROUP BY 1""")
def pivot_discovered(t):
    """Values are found by a first scan, at most ``pivotMaxValues`` of them."""
    return S.shop_events(t).groupBy("user_id").pivot("event_name").count()


@query("agg_16", "SELECT user_id, min(value) AS min_value, round(avg(value), 4) AS mean_value, max(value) AS max_value, count(*) AS readings FROM events GROUP BY 1")
def summary_per_user(t):
    return t.events.groupBy("user_id").agg(
        F.min("value").alias("min_value"), F.round(F.mean("value"), 4).alias("mean_value"), F.max("value").alias("max_value"),
        F.count("*").alias("readings"),
    )


@query("agg_17", "SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, round(avg(value), 4) AS mean_value FROM events GROUP BY 1, 2")
def mean_per_day(t):
    day = F.date_trunc("day", "ts").cast("date")
    return t.events.groupBy("user_id", day.alias("day")).agg(F.round(F.mean("value"), 4).alias("mean_value"))


@query("agg_18", "SELECT l_partkey, count(*) AS lines, round(sum(l_extendedprice), 2) AS cost FROM lineitem GROUP BY 1 HAVING count(*) > 30 AND cost <> 0")
def having(t):
    grouped = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("cost"))
    return grouped.filter("lines > 30 AND cost <> 0")


@query("agg_19", "SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned, sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END) AS kept FROM lineitem GROUP BY 1")
def conditional_sum(t):
    returned = F.col("l_returnflag") == "R"
    return t.lineitem.groupBy("l_suppkey").agg(
        F.sum(F.when(returned, F.col("l_quantity")).otherwise(0)).alias("returned"),
        F.sum(F.when(~returned, F.col("l_quantity")).otherwise(0)).alias("kept"),
    )


@query("agg_20", """SELECT strftime(l_shipdate, '%Y-%m') AS month, CASE WHEN l_quantity > 25 THEN 'bulk' ELSE 'piece' END AS size, count(*) AS lines
  FROM lineitem GROUP BY 1, 2""")
def computed_keys(t):
    size = F.when(F.col("l_quantity") > 25, "bulk").otherwise("piece")
    return t.lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month"), size.alias("size")).agg(F.count("*").alias("lines"))


@query("agg_21", "SELECT event_type, '2024-02-01 00:00:00.000000' AS updated_at, count(*) AS events FROM events GROUP BY 1")
def first_over_group(t):
    """A value that is the same on every row of the group: here the run's clock."""
    clocked = t.events.withColumn("updated_at", F.lit("2024-02-01").cast("timestamp"))
    return clocked.groupBy("event_type").agg(F.first("updated_at").alias("updated_at"), F.count("*").alias("events"))


@query("agg_22", """SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS correlation, round(stddev_samp(l_quantity), 6) AS spread,
  round(var_pop(l_discount), 8) AS variance, sum(DISTINCT l_quantity) AS distinct_sum FROM lineitem GROUP BY 1""")
def statistics(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("correlation"), F.round(F.stddev_samp("l_quantity"), 6).alias("spread"),
        F.round(F.var_pop("l_discount"), 8).alias("variance"), F.sum_distinct("l_quantity").alias("distinct_sum"),
    )


@query("agg_23", """SELECT 'count' AS summary, count(l_quantity)::VARCHAR AS l_quantity, count(l_discount)::VARCHAR AS l_discount FROM lineitem
  UNION ALL SELECT 'max', max(l_quantity)::VARCHAR, max(l_discount)::VARCHAR FROM lineitem
  UNION ALL SELECT 'min', min(l_quantity)::VARCHAR, abs(min(l_discount))::VARCHAR FROM lineitem""")
def described(t):
    return t.lineitem.select("l_quantity", F.abs("l_discount").alias("l_discount")).summary("count", "min", "max")


SUMMED = ["l_quantity", "l_extendedprice", "l_tax", "l_partkey"]


@query("agg_23b", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, unnest([0.25, 0.5, 0.75])::DOUBLE AS share, true AS within_bound FROM lineitem" for c in SUMMED))
def described_by_sketches(t):
    """A summary from sketches kept by month: of each quantile the share of smaller and of equal values is looked up; 3 % are allowed."""
    shares = [0.25, 0.5, 0.75]
    monthly = workspace.settle(sketches.quantile_sketches(t.lineitem, [F.trunc("l_shipdate", "month").alias("month")], SUMMED), "sketches")
    found = sketches.summary_of(monthly, SUMMED, shares)
    about = found.select("column", "count", "min", "max", F.explode(F.arrays_zip(F.array(*map(F.lit, shares)).alias("share"), F.col("quantiles").alias("value"))).alias("q"))
    about = workspace.settle(about.select("column", "count", "min", "max", "q.share", "q.value"), "quantiles")
    marks = {(r["column"], r["share"]): r["value"] for r in about.collect()}  # three a column
    ranks = t.lineitem.agg(*[
        F.struct((F.count_if(F.col(c) < v) / F.count(c)).alias("below"), (F.count_if(F.col(c) <= v) / F.count(c)).alias("upto")).alias(f"{c}@{s}") for (c, s), v in marks.items()
    ])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(s).alias("share"), ((F.col(f"`{c}@{s}`.below") - 0.03 <= s) & (F.col(f"`{c}@{s}`.upto") + 0.03 >= s)).alias("within_bound")) for c, s in marks]
    return about.join(ranks.select(F.inline(F.array(*rows))), ["column", "share"]).select("column", "count", "min", "max", "share", "within_bound")


@query("agg_24", ITEMS + """SELECT city, strftime(make_timestamp(event_timestamp), '%Y-%m-%d') AS day, round(sum(price_in_usd), 2) AS price, sum(quantity)::BIGINT AS quantity, count(*) AS items
  FROM shop_items GROUP BY 1, 2""")
def explode_then_aggregate(t):
    items = S.shop_events(t).select(
        "geo.city", F.timestamp_micros("event_timestamp").cast("date").alias("day"), F.explode("items").alias("item")
    )
    return items.groupBy("city", "day").agg(
        F.round(F.sum("item.price_in_usd"), 2).alias("price"), F.sum("item.quantity").alias("quantity"), F.count("item").alias("items")
    )


@query("agg_25", S.with_sql(S.BILL_SOURCE_SQL) + """SELECT owner_id, product_code, pricing_unit, count(*) AS line_count, round(sum(usage_amount), 4) AS usage_amount, 'sum' AS grain
  FROM bill_source WHERE (upper(pricing_unit) NOT LIKE '%HR%' AND upper(pricing_unit) NOT LIKE '%HOUR%') OR usage_amount > 1 GROUP BY 1, 2, 3
  UNION ALL SELECT owner_id, product_code, pricing_unit, 1, round(usage_amount, 4), 'line' FROM bill_source
  WHERE (upper(pricing_unit) LIKE '%HR%' OR upper(pricing_unit) LIKE '%HOUR%') AND usage_amount <= 1""")
def split_grain(t):
    """Hourly lines below one unit stay as they are, everything else is summed."""
    bill = S.bill_source(t).select("owner_id", "product_code", "pricing_unit", "usage_amount")
    unit = F.upper("pricing_unit")
    hourly = unit.like("%HR%") | unit.like("%HOUR%")
    keys = ["owner_id", "product_code", "pricing_unit"]
    summed = bill.filter(~hourly | (F.col("usage_amount") > 1)).groupBy(*keys).agg(
        F.count("*").alias("line_count"), F.round(F.sum("usage_amount"), 4).alias("usage_amount"), F.lit("sum").alias("grain")
    )
    lines = bill.filter(hourly & (F.col("usage_amount") <= 1)).select(
        *keys, F.lit(1).cast("bigint").alias("line_count"), F.round("usage_amount", 4).alias("usage_amount"), F.lit("line").alias("grain")
    )
    return summed.unionByName(lines)
