"""Joins on equal keys, on patterns and on validity ranges.

No join carries a hint: Spark broadcasts a side only when its size, estimated
or measured at run time, is below the session's threshold, and otherwise
shuffles, with skewed partitions split by AQE.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import workspace
from millrace.catalog import standins as S
from millrace.catalog.registry import query
from millrace.operators import rules, validity

USERS = S.with_sql(S.SHOP_USERS_SQL)


@query("jon_01", """SELECT c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders
  JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def inner_using(t):
    customer = t.customer.select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    orders = t.orders.select(F.col("o_custkey").alias("custkey"), "o_totalprice")
    joined = orders.join(customer, on="custkey", how="inner")
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("jon_02", S.with_sql(S.SHOP_ITEMS_SQL, S.ITEM_LOOKUP_SQL) + """SELECT event_id, i.item_id, name, quantity FROM shop_items i
  JOIN item_lookup l ON i.item_id = l.item_id""")
def inner_after_explode(t):
    items = S.shop_events(t).select("event_id", F.explode("items").alias("item")).alias("a")
    lookup = S.item_lookup(t).alias("b")
    return items.join(lookup, F.col("a.item.item_id") == F.col("b.item_id")).select(
        "event_id", "b.item_id", "name", F.col("item.quantity").alias("quantity")
    )


@query("jon_03", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def inner_named_keys(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("jon_04", USERS + """SELECT coalesce(u.email, s.email) AS email, user_id, coalesce(s.converted, false) AS converted
  FROM shop_users u FULL JOIN (SELECT DISTINCT lower(c_name) || '@mail' || (c_nationkey % 5) || '.com' AS email, true AS converted
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P') s ON u.email = s.email""")
def full_outer_flag(t):
    buyers = (
        t.orders.filter("o_orderstatus = 'P'").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.concat(F.lower("c_name"), F.lit("@mail"), (F.col("c_nationkey") % 5).cast("string"), F.lit(".com")).alias("email"))
        .distinct().withColumn("converted", F.lit(True))
    )
    users = S.shop_users(t).select("user_id", "email")
    named, nameless = users.filter("email IS NOT NULL"), users.filter("email IS NULL")  # the nulls would meet in one task
    joined = named.join(buyers, "email", "outer").unionByName(nameless, allowMissingColumns=True)
    return joined.na.fill(False, ["converted"])


@query("jon_05", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def left_join(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return t.customer.select("c_custkey").join(orders, "c_custkey", "left")


SUPPLY_SQL = "(SELECT l_partkey, l_suppkey, count(*) AS shipments FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)"


@query("jon_06", f"""SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, coalesce(s.shipments, 0) AS returns FROM lineitem l
  LEFT JOIN {SUPPLY_SQL} s ON l.l_partkey = s.l_partkey AND l.l_suppkey = s.l_suppkey""")
def composite_left(t):
    returns = t.lineitem.filter("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("returns"))
    return (
        t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey").join(returns, ["l_partkey", "l_suppkey"], "left")
        .na.fill(0, ["returns"])
    )


RATE_SQL = """rates AS (SELECT product_code, product_family, os, region, usage_type, count(*) AS line_count,
  round(max(ondemand_rate) * 0.6, 4) AS partial_rate FROM bill_source WHERE pricing_term = 'OnDemand' AND ondemand_rate > 6 GROUP BY 1, 2, 3, 4, 5)"""


@query("jon_07", S.with_sql(S.BILL_SOURCE_SQL, RATE_SQL) + """SELECT b.line_id, b.usage_amount, r.partial_rate FROM bill_source b LEFT JOIN rates r
  ON b.product_code = r.product_code AND b.product_family = r.product_family AND b.os = r.os AND b.region = r.region
  AND b.usage_type = r.usage_type""")
def five_key_price(t):
    bill = S.bill_source(t)
    keys = ["product_code", "product_family", "os", "region", "usage_type"]
    rates = (
        bill.filter("pricing_term = 'OnDemand' AND ondemand_rate > 6").groupBy(*keys)
        .agg(F.round(F.max("ondemand_rate") * 0.6, 4).alias("partial_rate"))
    )
    return bill.select("line_id", "usage_amount", *keys).join(rates, keys, "left").select("line_id", "usage_amount", "partial_rate")


@query("jon_08", """SELECT a.p_partkey AS sku, a.p_retailprice AS ondemand, b.p_retailprice AS reserved FROM part a
  JOIN part b ON a.p_name = b.p_name AND a.p_size = b.p_size WHERE a.p_type = 'STANDARD' AND b.p_type = 'ECONOMY'""")
def self_join(t):
    ondemand = t.part.filter("p_type = 'STANDARD'").alias("a")
    reserved = t.part.filter("p_type = 'ECONOMY'").alias("b")
    same = (F.col("a.p_name") == F.col("b.p_name")) & (F.col("a.p_size") == F.col("b.p_size"))
    return ondemand.join(reserved, same).select(
        F.col("a.p_partkey").alias("sku"), F.col("a.p_retailprice").alias("ondemand"), F.col("b.p_retailprice").alias("reserved")
    )


@query("jon_09", """SELECT s.s_suppkey, x.suppkey, x.value FROM supplier s FULL JOIN
  (SELECT l_suppkey + 5 AS suppkey, round(sum(l_extendedprice), 2) AS value FROM lineitem GROUP BY 1) x ON s.s_suppkey = x.suppkey""")
def full_audit(t):
    """Both sides keep their unmatched rows, so a gap on either side shows."""
    value = t.lineitem.groupBy((F.col("l_suppkey") + 5).alias("suppkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("value"))
    return t.supplier.select("s_suppkey").join(value, F.col("s_suppkey") == F.col("suppkey"), "full")


CONTRACTS = [
    ("c1", "old", "1995-06-01", "1998-05-31", 10.0),
    ("c2", "red", "1996-01-01", "1999-12-31", 20.0),
    ("c3", "small r", "1995-01-01", "1996-12-31", 30.0),
    ("c4", "blue", "1999-03-01", "2001-12-31", 40.0),
]
CONTRACT_DDL = "contract string, prefix string, date_from string, date_to string, budget double"
CONTRACT_SQL = "contracts(contract, prefix, date_from, date_to, budget) AS (VALUES " + ", ".join(
    f"('{c}', '{p}', DATE '{a}', DATE '{b}', {x}::DOUBLE)" for c, p, a, b, x in CONTRACTS
) + ")"
COST_SQL = """cost AS (SELECT date_trunc('month', l_shipdate)::DATE AS month_start, p_name AS grp, round(sum(l_quantity), 2) AS cost
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def contracts(t):
    rows = t.spark.createDataFrame(CONTRACTS, CONTRACT_DDL)
    return rows.withColumn("date_from", F.to_date("date_from")).withColumn("date_to", F.to_date("date_to"))


def group_cost(t):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.groupBy(F.trunc("l_shipdate", "month").alias("month_start"), F.col("p_name").alias("grp")).agg(
        F.round(F.sum("l_quantity"), 2).alias("cost")
    )


@query("jon_10", S.with_sql(CONTRACT_SQL, COST_SQL) + """SELECT strftime(month_start, '%Y-%m-%d') AS month_start, grp, cost, contract, budget
  FROM cost LEFT JOIN contracts ON grp LIKE prefix || '%' AND month_start >= date_from AND month_start <= date_to""")
def prefix_and_range(t):
    """Contracts are spread over their months; a group meets those of its month that begin like it, found by equality."""
    cost = workspace.settle(group_cost(t), "group-cost")
    terms = validity.by_month(contracts(t), "date_from", "date_to").withColumn("pattern", F.concat("prefix", F.lit("%")))
    names = cost.select("month_start", "grp").distinct()
    own = rules.like_candidates(names, "month_start", "grp", terms, "valid_month", "pattern").filter(F.startswith("grp", F.col("prefix")))
    return cost.join(own.select("month_start", "grp", "contract", "budget"), ["month_start", "grp"], "left").select("month_start", "grp", "cost", "contract", "budget")


@query("jon_11", S.with_sql(CONTRACT_SQL, COST_SQL) + """SELECT strftime(month_start, '%Y-%m-%d') AS month_start, grp, cost, contract
  FROM cost LEFT JOIN (SELECT * FROM contracts WHERE contract = 'c2') ON grp NOT LIKE prefix || '%'
  AND month_start >= date_from AND month_start <= date_to""")
def parent_range(t):
    parent = validity.by_month(contracts(t).filter("contract = 'c2'"), "date_from", "date_to")
    on = (F.col("month_start") == F.col("valid_month")) & ~F.startswith(F.col("grp"), F.col("prefix"))
    return group_cost(t).join(parent, on, "left").select("month_start", "grp", "cost", "contract")


RESOURCE_RULES = [
    (1, "resource", "res:1%", "acct3", "ONE"),
    (2, "resource", "res:%5", "acct3", "FIVE"),
    (3, "resource", "i-%", "acct7", "NODE"),
    (4, "resource", "%9%", "acct11", "NINE"),
]
RULES_SQL = "rules(priority, pattern, original, new) AS (VALUES " + ", ".join(
    f"({p}, '{a}', '{o}', '{n}')" for p, _, a, o, n in RESOURCE_RULES
) + ")"


@query("jon_12", S.with_sql(S.BILL_SOURCE_SQL, RULES_SQL) + """SELECT line_id, resource, owner_id,
  (SELECT arg_min(new, priority) FROM rules WHERE resource LIKE pattern AND owner_id = original) AS new_group FROM bill_source""")
def value_like_pattern(t):
    """Patterns are tried on distinct resources of the owner; the first rule wins."""
    bill = S.bill_source(t).select("line_id", "resource", "owner_id")
    return rules.with_pattern_target(bill, "owner_id", "resource", rules.rule_table(t.spark, RESOURCE_RULES), "new_group")


NODES_SQL = """nodes AS (SELECT year, month, owner_id, instance_type, sum(usage_amount) AS used FROM bill_source WHERE item_type = 'Usage' GROUP BY ALL),
reserved AS (SELECT year, month, owner_id, usage_type, sum(usage_amount) AS held FROM bill_source WHERE usage_type LIKE 'HeavyUsage%' GROUP BY ALL)"""


@query("jon_13", S.with_sql(S.BILL_SOURCE_SQL, NODES_SQL) + """SELECT n.year, n.month, n.owner_id, n.instance_type, round(used, 4) AS used, r.usage_type, round(held, 4) AS held
  FROM nodes n LEFT JOIN reserved r ON n.year = r.year AND n.month = r.month AND n.owner_id = r.owner_id
  AND r.usage_type LIKE '%' || coalesce(nullif(n.instance_type, ''), ' serverless')""")
def suffix_with_default(t):
    bill = S.bill_source(t)
    keys = ["year", "month", "owner_id"]
    nodes = bill.filter("item_type = 'Usage'").groupBy(*keys, "instance_type").agg(F.round(F.sum("usage_amount"), 4).alias("used"))
    reserved = bill.filter(F.col("usage_type").like("HeavyUsage%")).groupBy(*keys, "usage_type").agg(F.round(F.sum("usage_amount"), 4).alias("held"))
    value = F.coalesce(F.nullif("instance_type", F.lit("")), F.lit(" serverless"))
    return rules.suffix_lookup(nodes, reserved, keys, value, "usage_type")


@query("jon_14", S.with_sql(S.USAGE_SQL, S.LIST_PRICES_SQL) + """SELECT record_id, usage.sku, quantity, listed_rate FROM usage LEFT JOIN list_prices p
  ON usage.sku = p.sku AND usage_date >= start_date AND (end_date IS NULL OR usage_date <= end_date)""")
def price_as_of(t):
    facts = S.usage(t).select("record_id", "sku", "quantity", "usage_date")
    return validity.valid_at(facts, S.list_prices(t), "sku", "usage_date").select("record_id", "sku", "quantity", "listed_rate")


@query("jon_15", S.with_sql(S.USAGE_SQL, S.LIST_PRICES_SQL) + """SELECT record_id, usage.sku, listed_rate FROM usage LEFT JOIN list_prices p
  ON usage.sku = p.sku AND p.end_date IS NULL""")
def current_dimension(t):
    open_rows = validity.current_rows(S.list_prices(t)).select("sku", "listed_rate")
    return S.usage(t).select("record_id", "sku").join(open_rows, "sku", "left")


@query("jon_16", """SELECT u.l_suppkey, s_name, round(u.cost, 2) AS cost FROM
  (SELECT l_suppkey, sum(l_extendedprice) AS cost FROM lineitem GROUP BY 1) u LEFT JOIN supplier ON u.l_suppkey = s_suppkey""")
def aggregate_to_dimension(t):
    cost = t.lineitem.groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("cost"))
    names = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return cost.join(names, "l_suppkey", "left")


@query("jon_19", """SELECT 'right' AS kind, c_custkey AS id FROM orders RIGHT JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'anti', c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
  UNION ALL SELECT 'semi', c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def right_anti_semi(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    customer = t.customer.select("c_custkey")
    part = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.col("c_custkey").alias("id"))
    return (
        part(orders.join(customer, "c_custkey", "right"), "right")
        .unionByName(part(customer.join(orders, "c_custkey", "left_anti"), "anti"))
        .unionByName(part(customer.join(orders, "c_custkey", "left_semi"), "semi"))
    )


@query("jon_20", """SELECT a.l_suppkey, a.l_returnflag, a.n AS lines, b.q AS quantity, s_name FROM
  (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) a
  JOIN (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) b
    ON a.l_suppkey = b.l_suppkey AND a.l_returnflag = b.l_returnflag
  LEFT JOIN supplier ON a.l_suppkey = s_suppkey""")
def several_keys(t):
    keys = ["l_suppkey", "l_returnflag"]
    lines = t.lineitem.groupBy(*keys).agg(F.count("*").alias("lines"))
    quantity = t.lineitem.groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"))
    named = lines.join(quantity, keys)
    return named.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left_outer").select(*keys, "lines", "quantity", "s_name")
