"""Cloud-bill cost products over the line items as bill lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace import workspace
from millrace.catalog import standins as S
from millrace.catalog.registry import Tables, query
from millrace.operators import rules as R
from millrace.plans import bill as B

AS_OF = dt.date(2000, 6, 15)
RULES = [
    (1, "owner", "acct1", "SA", "solo one"),
    (2, "owner", "acct2", "SCOPE", "scope two"),
    (3, "owner", "acct3", "GROUP", "group three"),
    (4, "owner", "acct4", "GROUP", "group four"),
    (5, "tag", "CostGroup", "hub core", "core"),
    (6, "tag", "CostGroup", "vega", "Vega-2"),
    (7, "resource", "res:1%", "acct5", "ones"),
    (8, "resource", "i-%", "acct5", "nodes"),
    (9, "resource", "res:%7", "acct11", "sevens "),
    (10, "resource", "res:2%", "acct12", "twos"),
]


def rule_rows(t: Tables):
    return R.rule_table(t.spark, RULES)


def norm(t: Tables):
    return B.normalise(S.bill_source(t))


#: What the retags and the allocation read, whichever columns a report asks for.
WORKED = ("line_id", "usage_time", "resource_id", "tag_name", "owner_id", "tag_group2", "tag_scope")


def by_name(t: Tables, *columns: str):
    """The first retag is stored: the second reads its input several times. With ``columns`` only they, and what the fact is worked from, are carried."""
    carried = tuple(dict.fromkeys([*WORKED, *columns])) if columns else ()
    read = dict.fromkeys(B.ORIGINALS.get(c, c) for c in carried)
    lines = lambda: norm(t).select(*read) if read else norm(t)
    by_resource = workspace.stored(lambda: B.retag_by_resource(lines()), t.spark, "bill-by-resource", t.root, carried, written=True)
    return B.retag_by_name(by_resource)


def fact(t: Tables, *columns: str):
    """Bill fact: retagged by resource and name, then reallocated."""
    return B.reallocate(by_name(t, *columns), rule_rows(t))


def stored_fact(t: Tables, *columns: str):
    """The fact as the stored table that adjustments and reports read; a report that names its columns stores no others."""
    return workspace.stored(lambda: fact(t, *columns), t.spark, "bill-fact", t.root, columns)


def rounded(df, *columns, digits: int = 4):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ check texts

_billable = "(net_cost <> 0 OR reservation_cost <> 0 OR plan_cost <> 0 OR (net_cost = 0 AND item_type = 'RIFee'))"
_tidy = ", ".join(f"upper(trim({c})) AS {c}" for c in B.TAGS)
NORM_SQL = f"""norm AS (SELECT line_id, year, month, usage_time, billing_entity, owner_id, {_tidy},
  CASE WHEN billing_entity = 'Marketplace' OR product_code LIKE '%Support%' THEN product_name
    WHEN resource || plan_arn || reservation_arn = '' THEN 'item:' || line_id
    WHEN resource = '' AND reservation_arn <> '' THEN 'ri:' || reservation_arn
    WHEN resource = '' AND plan_arn <> '' THEN 'sp:' || plan_arn ELSE resource END AS resource_id,
  CASE WHEN billing_entity = 'Marketplace' THEN billing_entity WHEN product_code LIKE '%Savings%' AND bill_type = 'Purchase' THEN product_code || ' Purchase'
    WHEN item_type = 'Tax' THEN item_type WHEN product_code LIKE '%Support%' THEN product_name ELSE product_code END AS service,
  product_name AS service_name, CASE WHEN product_code LIKE '%Savings%' AND bill_type = 'Purchase' THEN 'Purchase' ELSE product_family END AS family,
  operation, region, os, instance_type, pricing_term, pricing_unit, usage_type, item_type, usage_amount, net_cost, ondemand_cost, ondemand_rate, sku
  FROM bill_source WHERE {_billable})"""


def retag_sql(name: str, source: str, key: str, keep_nulls=(), bypass: bool = True, originals: bool = False) -> str:
    """The newest value of each tag and its time per key, joined back; rows newer than it see nothing."""
    keyed = f"coalesce({key} <> '', false)" if bypass else "true"
    newest = ", ".join(
        f"{'arg_max_null' if c in keep_nulls else 'arg_max'}({c}, row(usage_time, line_id)) AS v_{c}, max(usage_time) FILTER ({c} IS NOT NULL) AS t_{c}" for c in B.TAGS
    )
    filled = ", ".join(f"v_{c} AS {c}" if c in keep_nulls else f"CASE WHEN usage_time <= t_{c} THEN v_{c} END AS {c}" for c in B.TAGS)
    extra = ", tag_group2 AS original_group2, tag_project AS original_project" if originals else ""
    helpers = ", ".join(["n_key", *[f"{h}_{c}" for c in B.TAGS for h in "vt"]])
    rows = f"(SELECT *{extra} FROM {source})"
    text = f"""{name} AS (SELECT * EXCLUDE ({helpers}) REPLACE ({filled}) FROM {rows} s
      JOIN (SELECT {key} AS n_key, {newest} FROM {source} WHERE {keyed} GROUP BY 1) n ON s.{key} IS NOT DISTINCT FROM n_key WHERE {keyed}"""
    if bypass:
        text += f" UNION ALL SELECT *{extra} FROM {source} WHERE NOT {keyed}"
    return text + ")"


BY_ID_SQL = retag_sql("by_id", "norm", "resource_id", originals=True)
BY_NAME_SQL = retag_sql("by_name", "by_id", "tag_name", keep_nulls=("tag_plan",))
RULES_SQL = "rules(priority, kind, pattern, original, new) AS (VALUES " + ", ".join(
    f"({p}, '{k}', '{a}', '{o}', '{n}')" for p, k, a, o, n in RULES
) + ")"


def reallocate_sql(extra: str = "") -> str:
    return f"""realloc AS (SELECT * EXCLUDE (sa_original, sa_new, tg_new, re_new) REPLACE (CASE WHEN sa_original = 'SA' THEN sa_new
      WHEN sa_original = 'SCOPE' THEN CASE WHEN upper(tag_scope) = 'SOUTHLAKE' THEN 'SOUTH LAKE' ELSE sa_new END {extra}
      WHEN sa_original = 'GROUP' THEN coalesce(tg_new, nullif(tag_group2, ''), sa_new, '')
      ELSE coalesce(tg_new, nullif(tag_group2, ''), re_new, '') END AS tag_group2) FROM (
    SELECT b.*, sa.original AS sa_original, upper(sa.new) AS sa_new, upper(tg.new) AS tg_new,
      (SELECT arg_min(upper(re.new), re.priority) FROM rules re WHERE re.kind = 'resource' AND upper(b.resource_id) LIKE upper(re.pattern) AND upper(b.owner_id) = upper(re.original)) AS re_new
    FROM by_name b LEFT JOIN rules sa ON sa.kind = 'owner' AND upper(b.owner_id) = upper(sa.pattern)
    LEFT JOIN rules tg ON tg.kind = 'tag' AND upper(coalesce(tag_group2, '')) = upper(tg.original)))"""


NORM = S.with_sql(S.BILL_SOURCE_SQL, NORM_SQL)
CHAIN = (S.BILL_SOURCE_SQL, NORM_SQL, BY_ID_SQL, BY_NAME_SQL, RULES_SQL, reallocate_sql())
FACT = S.with_sql(*CHAIN)
_tags = ", ".join(B.TAGS)

# ---------------------------------------------------- normalise, retag, allocate


@query("cur_01", NORM + "SELECT * EXCLUDE (usage_time) FROM norm")
def normalised(t):
    return norm(t).drop("usage_time")


@query("cur_02", S.with_sql(S.BILL_SOURCE_SQL) + f"SELECT item_type, count(*) AS lines, round(sum(net_cost), 2) AS net_cost FROM bill_source WHERE {_billable} GROUP BY 1")
def billable_lines(t):
    return S.bill_source(t).filter(B.billable()).groupBy("item_type").agg(F.count("*").alias("lines"), F.round(F.sum("net_cost"), 2).alias("net_cost"))


@query("cur_03", NORM + """SELECT service_name, year, month, count(*) AS lines FROM norm WHERE usage_time >= DATE '2000-02-01' AND (usage_time < DATE '2000-05-01'
  OR (service_name = 'Search service' AND make_date(year, month, 1) >= DATE '2000-02-01' AND make_date(year, month, 1) < DATE '2000-05-01') OR usage_time >= DATE '2000-06-01') GROUP BY 1, 2, 3""")
def month_window(t):
    kept = B.month_window(norm(t), AS_OF, -4, -2, "Search service")
    return kept.groupBy("service_name", "year", "month").agg(F.count("*").alias("lines"))


@query("cur_04", S.with_sql(S.BILL_SOURCE_SQL, NORM_SQL, BY_ID_SQL) + f"SELECT line_id, {_tags}, original_group2, original_project FROM by_id")
def retagged_by_resource(t):
    lines = norm(t).select("line_id", "usage_time", "resource_id", *B.TAGS)
    return B.retag_by_resource(lines).select("line_id", *B.TAGS, "original_group2", "original_project")


@query("cur_05", S.with_sql(S.BILL_SOURCE_SQL, NORM_SQL, BY_ID_SQL, BY_NAME_SQL) + f"SELECT line_id, {_tags}, original_group2, original_project FROM by_name")
def retagged_by_name(t):
    columns = ("line_id", *B.TAGS, "original_group2", "original_project")
    return by_name(t, *columns).select(*columns)


@query("cur_06", FACT + "SELECT line_id, owner_id, tag_group2, original_group2 FROM realloc")
def reallocated(t):
    columns = ("line_id", "owner_id", "tag_group2", "original_group2")
    return fact(t, *columns).select(*columns)


@query("cur_06b", S.with_sql(*CHAIN[:-1], reallocate_sql("WHEN tag_name LIKE '%NODE 1%' THEN 'NODE-ONE'")) + "SELECT line_id, tag_name, tag_group2 FROM realloc")
def reallocated_by_name(t):
    return B.reallocate(by_name(t), rule_rows(t), {"%NODE 1%": "NODE-ONE"}).select("line_id", "tag_name", "tag_group2")


@query("cur_07", FACT + "SELECT line_id, tag_group2, service, round(net_cost, 2) AS net_cost FROM realloc WHERE year = 2000 AND month = 5")
def month_facts(t):
    return B.month_fact(stored_fact(t, "line_id", "year", "month", "tag_group2", "service", "net_cost"), 2000, 5).select("line_id", "tag_group2", "service", F.round("net_cost", 2).alias("net_cost"))


PASSES_SQL = """p0 AS (SELECT line_id, owner_id, resource_id, tag_scope, tag_group2 AS g FROM norm),
p1 AS (SELECT * REPLACE (CASE WHEN g <> upper(trim(coalesce(g, ''))) OR (upper(trim(tag_scope)) = 'SOUTHLAKE' AND g <> 'SOUTH LAKE')
  THEN CASE WHEN upper(trim(tag_scope)) = 'SOUTHLAKE' THEN 'SOUTH LAKE' ELSE upper(trim(coalesce(g, ''))) END ELSE g END AS g) FROM p0),
p2 AS (SELECT p1.* REPLACE (coalesce(upper(trim(r.new)), g) AS g) FROM p1 LEFT JOIN rules r ON r.kind = 'owner' AND r.original = 'SA' AND owner_id = r.pattern),
p3 AS (SELECT p2.* REPLACE (coalesce(upper(trim(r.new)), g) AS g) FROM p2 LEFT JOIN rules r ON r.kind = 'owner' AND r.original = 'GROUP' AND owner_id = r.pattern AND g = ''),
p4 AS (SELECT p3.* REPLACE (coalesce(upper(trim(r.new)), g) AS g) FROM p3 LEFT JOIN rules r ON r.kind = 'tag' AND g = upper(trim(r.original)) AND g <> upper(trim(r.new))),
p5 AS (SELECT p4.* REPLACE (coalesce(upper(trim(r.new)), g) AS g) FROM p4 LEFT JOIN rules r ON r.kind = 'resource' AND owner_id = r.original AND resource_id LIKE r.pattern AND g <> upper(trim(r.new)))"""


@query("cur_08", S.with_sql(S.BILL_SOURCE_SQL, NORM_SQL, RULES_SQL, PASSES_SQL) + "SELECT line_id, g AS tag_group2 FROM p5")
def rule_passes(t):
    return B.rule_passes(norm(t), rule_rows(t)).select("line_id", "tag_group2")


# ------------------------------------------------------------------ adjustments

COMMITTED_SQL = """committed AS (SELECT tag_group2, DATE '2000-05-01' AS usage_month, 31 * 24 AS hours, sum(plan_rate) AS plan_rate, sum(ondemand_rate) AS ondemand_rate
  FROM (SELECT upper('unit ' || (s_suppkey % 3)) AS g1, CASE s_suppkey % 6 WHEN 0 THEN 'ATLAS' WHEN 1 THEN 'BOREALIS' WHEN 2 THEN 'CORE' WHEN 3 THEN 'VEGA-2' WHEN 4 THEN 'SOLO ONE' END AS tag_group2,
    (s_suppkey % 10) / 16.0::DOUBLE AS plan_rate, (s_suppkey % 10) / 8.0::DOUBLE AS ondemand_rate FROM supplier) WHERE tag_group2 IS NOT NULL GROUP BY 1)"""


def commitments(t: Tables):
    group = F.element_at(F.array(*[F.lit(x) for x in ("ATLAS", "BOREALIS", "CORE", "VEGA-2", "SOLO ONE", None)]), (F.col("s_suppkey") % 6 + 1).cast("int"))
    assets = t.supplier.select(
        group.alias("tag_group2"), (F.col("s_suppkey") % 10 / 16).alias("plan_rate"), (F.col("s_suppkey") % 10 / 8).alias("ondemand_rate")
    )
    return B.commitment_totals(assets, AS_OF)


BENEFIT_SQL = """used AS (SELECT year, month, tag_group2, day(last_day(usage_time)) * 24 AS hours, date_trunc('month', usage_time)::DATE AS usage_month,
    sum(usage_amount) AS usage_amount, sum(net_cost) AS net, sum(ondemand_cost) AS od FROM realloc
  WHERE service = 'Compute' AND family = 'Compute Instance' AND pricing_term <> 'Spot' AND billing_entity <> 'Adjustment' GROUP BY ALL),
benefit AS (SELECT u.year, u.month, u.hours::BIGINT AS hours, u.usage_month, u.tag_group2, coalesce(c.hours, u.usage_amount)::DOUBLE AS usage_amount, u.net AS actual_net, u.od AS actual_ondemand,
  coalesce(c.hours * plan_rate, 0) AS benefit_net, coalesce(c.hours * ondemand_rate, 0) AS benefit_ondemand,
  (u.od - coalesce(c.hours * ondemand_rate, 0) + coalesce(c.hours * plan_rate, 0)) * 0.82::DOUBLE - u.net AS net_cost,
  coalesce(plan_rate, 0) AS plan_rate, coalesce(ondemand_rate, 0) AS ondemand_rate
  FROM used u LEFT JOIN committed c ON u.tag_group2 = c.tag_group2 AND u.usage_month = c.usage_month)"""


BENEFIT_READS = ("year", "month", "usage_time", "tag_group2", "service", "family", "pricing_term", "billing_entity", "usage_amount", "net_cost", "ondemand_cost")


@query("cur_09", S.with_sql(*CHAIN, COMMITTED_SQL, BENEFIT_SQL) + """SELECT year, month, hours, strftime(usage_month, '%Y-%m-%d') AS usage_month, tag_group2, round(usage_amount, 4) AS usage_amount,
  round(actual_net, 2) AS actual_net, round(actual_ondemand, 2) AS actual_ondemand, round(benefit_net, 4) AS benefit_net, round(benefit_ondemand, 4) AS benefit_ondemand,
  round(net_cost, 5) AS net_cost, plan_rate, ondemand_rate FROM benefit""")
def plan_benefit(t):
    result = B.plan_benefit(stored_fact(t, *BENEFIT_READS), commitments(t))
    result = rounded(result, "usage_amount", "benefit_net", "benefit_ondemand")
    return rounded(rounded(result, "actual_net", "actual_ondemand", digits=2), "net_cost", digits=5)


@query("cur_10", S.with_sql(*CHAIN, COMMITTED_SQL, BENEFIT_SQL) + """SELECT year, month, strftime(usage_month, '%Y-%m-%d') AS usage_month, tag_group2, 'SavingsPlanCoveredUsage' AS item_type, hours::DOUBLE AS usage_amount,
  round(net_cost, 5) AS net_cost, round(actual_ondemand, 2) AS ondemand_cost, ondemand_rate FROM benefit
  UNION ALL SELECT year, month, strftime(usage_month, '%Y-%m-%d'), 'NOT ALLOCATED', 'SavingsPlanRecurringFee', -sum(hours)::DOUBLE, round(-sum(net_cost), 5), round(-sum(actual_ondemand), 2), sum(ondemand_rate) FROM benefit GROUP BY year, month, usage_month""")
def plan_adjustments(t):
    result = B.plan_adjustments(B.plan_benefit(stored_fact(t, *BENEFIT_READS), commitments(t)))
    return rounded(rounded(result, "net_cost", digits=5), "ondemand_cost", digits=2)


NODES_SQL = """nodes AS (SELECT year, month, day(last_day(usage_time)) * 24 AS hours, date_trunc('month', usage_time)::DATE AS usage_month, tag_group2, service, service_name,
  CASE WHEN usage_type LIKE '%HeavyUsage%' THEN 'Reserved Nodes' ELSE family END AS family, CASE WHEN usage_type LIKE '%HeavyUsage%' THEN usage_type ELSE instance_type END AS instance_type,
  coalesce(ondemand_rate, 0) AS ondemand_rate, sum(CASE WHEN resource_id LIKE 'ri:%' OR resource_id LIKE '%reserve%' THEN 0 ELSE usage_amount END) / (day(last_day(usage_time)) * 24) AS nodes,
  sum(CASE WHEN resource_id LIKE 'ri:%' OR resource_id LIKE '%reserve%' THEN usage_amount ELSE 0 END) / (day(last_day(usage_time)) * 24) AS reserved_nodes,
  sum(net_cost) AS net_cost, sum(ondemand_cost) AS ondemand_cost FROM realloc
  WHERE (service LIKE '%Warehouse%' OR service LIKE '%Database%') AND (lower(family) LIKE '%instance%' OR lower(family) LIKE '%serverless%' OR pricing_term = 'Reserved')
  GROUP BY year, month, service, service_name, CASE WHEN usage_type LIKE '%HeavyUsage%' THEN 'Reserved Nodes' ELSE family END, tag_group2, day(last_day(usage_time)) * 24,
    CASE WHEN usage_type LIKE '%HeavyUsage%' THEN usage_type ELSE instance_type END, coalesce(ondemand_rate, 0), usage_type, date_trunc('month', usage_time)::DATE)"""
NODE_BENEFIT_SQL = """node_benefit AS (SELECT n.year, n.month, n.hours, n.usage_month, n.tag_group2, n.service, n.service_name, n.family, n.instance_type, n.ondemand_rate, n.nodes,
  coalesce(r.reserved_nodes, 0) AS reserved_nodes, n.net_cost AS actual_net, n.ondemand_cost AS actual_ondemand, n.ondemand_rate * n.hours * coalesce(r.reserved_nodes, 0) AS benefit_ondemand,
  coalesce(r.net_cost, 0) / 0.82::DOUBLE AS benefit_net, (n.ondemand_cost - n.ondemand_rate * n.hours * coalesce(r.reserved_nodes, 0)) * 0.82::DOUBLE + coalesce(r.net_cost, 0) - n.net_cost AS net_cost
  FROM (SELECT * FROM nodes WHERE family <> 'Reserved Nodes') n LEFT JOIN (SELECT * FROM nodes WHERE family = 'Reserved Nodes') r
  ON n.tag_group2 = r.tag_group2 AND n.year = r.year AND n.month = r.month AND r.instance_type LIKE '%' || coalesce(nullif(n.instance_type, ''), ' serverless'))"""
RESERVED = ["ri:%", "%reserve%"]
NODE_READS = (
    "year", "month", "usage_time", "tag_group2", "service", "service_name", "family", "pricing_term", "usage_type", "instance_type", "resource_id",
    "ondemand_rate", "usage_amount", "net_cost", "ondemand_cost",
)


@query("cur_11", S.with_sql(*CHAIN, NODES_SQL) + """SELECT year, month, hours::BIGINT AS hours, strftime(usage_month, '%Y-%m-%d') AS usage_month, tag_group2, service, service_name, family, instance_type, ondemand_rate,
  round(nodes, 9) AS nodes, round(reserved_nodes, 9) AS reserved_nodes, round(net_cost, 2) AS net_cost, round(ondemand_cost, 2) AS ondemand_cost FROM nodes""")
def node_usage(t):
    result = rounded(B.node_usage(stored_fact(t, *NODE_READS), RESERVED), "nodes", "reserved_nodes", digits=9)
    return rounded(result, "net_cost", "ondemand_cost", digits=2)


@query("cur_12", S.with_sql(*CHAIN, NODES_SQL, NODE_BENEFIT_SQL) + """SELECT year, month, tag_group2, service, family, instance_type, ondemand_rate, round(nodes, 9) AS nodes, round(reserved_nodes, 9) AS reserved_nodes,
  round(benefit_ondemand, 4) AS benefit_ondemand, round(net_cost, 5) AS net_cost FROM node_benefit""")
def node_benefit(t):
    result = B.node_benefit(B.node_usage(stored_fact(t, *NODE_READS), RESERVED)).select(
        "year", "month", "tag_group2", "service", "family", "instance_type", "ondemand_rate", "nodes", "reserved_nodes", "benefit_ondemand", "net_cost"
    )
    return rounded(rounded(rounded(result, "nodes", "reserved_nodes", digits=9), "benefit_ondemand"), "net_cost", digits=5)


@query("cur_13", S.with_sql(*CHAIN, NODES_SQL, NODE_BENEFIT_SQL, """node_rows AS (SELECT year, month, service, family, tag_group2, sum(nodes) AS usage_amount, sum(net_cost) AS net_cost, sum(actual_ondemand) AS ondemand_cost,
  sum(ondemand_rate * nodes) AS ondemand_rate FROM node_benefit GROUP BY ALL)""") + """SELECT year, month, service, family, tag_group2, 'DiscountedUsage' AS item_type, round(usage_amount, 9) AS usage_amount, round(net_cost, 5) AS net_cost,
  round(ondemand_cost, 2) AS ondemand_cost, round(ondemand_rate, 9) AS ondemand_rate FROM node_rows
  UNION ALL SELECT year, month, service, family, 'NOT ALLOCATED', 'RIFee', round(-sum(usage_amount), 9), round(-sum(net_cost), 5), round(-sum(ondemand_cost), 2), round(sum(ondemand_rate), 9) FROM node_rows GROUP BY year, month, service, family""")
def node_adjustments(t):
    result = B.node_adjustments(B.node_benefit(B.node_usage(stored_fact(t, *NODE_READS), RESERVED))).drop("usage_month", "service_name")
    result = rounded(rounded(result, "usage_amount", "ondemand_rate", digits=9), "net_cost", digits=5)
    return rounded(result, "ondemand_cost", digits=2)


# ----------------------------------------------------------------------- assets

PRICES_SQL = """rate_rows AS (SELECT product_code AS service, product_family AS family, os, region, usage_type, max(ondemand_rate) / 2 AS partial_rate,
  CASE WHEN region <> 'region-1' THEN max(ondemand_rate) * 0.75::DOUBLE END AS noupfront_rate FROM bill_source WHERE pricing_term = 'Reserved' OR region = 'region-2' GROUP BY 1, 2, 3, 4, 5)"""
SERVICES = ["Compute", "Warehouse", "Database", "Search", "Cache"]


def prices(t: Tables):
    picked = S.bill_source(t).filter("pricing_term = 'Reserved' OR region = 'region-2'")
    grouped = picked.groupBy(F.col("product_code").alias("service"), F.col("product_family").alias("family"), "os", "region", "usage_type")
    return grouped.agg(
        (F.max("ondemand_rate") / 2).alias("partial_rate"),
        F.when(F.col("region") != "region-1", F.max("ondemand_rate") * 0.75).alias("noupfront_rate"),
    )


ASSETS_SQL = """assets AS (SELECT n.*, p.partial_rate, p.noupfront_rate, (day(last_day(usage_time)) * 24)::BIGINT AS hours FROM norm n
  LEFT JOIN rate_rows p ON n.service = p.service AND n.family = p.family AND n.os = p.os AND n.region = p.region AND n.usage_type = p.usage_type
  WHERE pricing_term <> 'Spot' AND n.service IN ('Compute', 'Warehouse', 'Database', 'Search', 'Cache') AND (n.family LIKE '%Instance%' OR n.family LIKE '%Serverless%'))"""
ASSET_FACT_SQL = """asset_fact AS (SELECT owner_id, hours, tag_group2, CASE WHEN tag_name IS NULL AND resource_id NOT LIKE 'i-%' THEN resource_id ELSE tag_name END AS tag_name, resource_id, tag_plan,
  service, family, os, region, usage_type, partial_rate, noupfront_rate, ondemand_rate, sum(usage_amount) AS usage_amount, sum(ondemand_rate * usage_amount) AS ondemand_cost FROM assets
  GROUP BY owner_id, hours, tag_group2, CASE WHEN tag_name IS NULL AND resource_id NOT LIKE 'i-%' THEN resource_id ELSE tag_name END, resource_id, tag_plan,
  service, family, os, region, usage_type, partial_rate, noupfront_rate, ondemand_rate)"""
NAMED_SQL = """accounts AS (SELECT 'acct' || s_suppkey AS owner_id, s_name AS account_name FROM supplier WHERE s_suppkey < 15),
named AS (SELECT a.* EXCLUDE (tag_group2, tag_plan) REPLACE (coalesce(a.tag_name, a.usage_type) AS tag_name), g.last_group AS tag_group2, g.last_plan AS tag_plan, account_name
  FROM asset_fact a JOIN (SELECT owner_id, tag_name, tag_group2 AS last_group, tag_plan AS last_plan FROM asset_fact
    QUALIFY row_number() OVER (PARTITION BY owner_id, tag_name ORDER BY resource_id DESC, usage_type DESC, coalesce(tag_group2, '') DESC, coalesce(tag_plan, '') DESC, tag_group2 IS NOT NULL DESC, tag_plan IS NOT NULL DESC) = 1) g
  ON a.owner_id = g.owner_id AND a.tag_name IS NOT DISTINCT FROM g.tag_name LEFT JOIN accounts c ON a.owner_id = c.owner_id)"""
ASSET_CHAIN = (S.BILL_SOURCE_SQL, NORM_SQL, PRICES_SQL, ASSETS_SQL, ASSET_FACT_SQL)


def assets(t: Tables):
    return B.asset_inventory(norm(t), prices(t), SERVICES)


def accounts(t: Tables):
    return t.supplier.filter("s_suppkey < 15").select(F.concat(F.lit("acct"), F.col("s_suppkey").cast("string")).alias("owner_id"), F.col("s_name").alias("account_name"))


def named(t: Tables):
    return B.named_assets(B.asset_fact(assets(t)), accounts(t))


@query("cur_14", S.with_sql(*ASSET_CHAIN) + "SELECT line_id, service, usage_type, hours, usage_amount, partial_rate, noupfront_rate FROM assets")
def asset_inventory(t):
    return assets(t).select("line_id", "service", "usage_type", "hours", "usage_amount", "partial_rate", "noupfront_rate")


@query("cur_15", S.with_sql(*ASSET_CHAIN) + "SELECT * REPLACE (round(usage_amount, 4) AS usage_amount, round(ondemand_cost, 5) AS ondemand_cost) FROM asset_fact")
def asset_facts(t):
    return rounded(rounded(B.asset_fact(assets(t)), "usage_amount"), "ondemand_cost", digits=5)


@query("cur_16", S.with_sql(*ASSET_CHAIN, NAMED_SQL) + """SELECT account_name, owner_id, hours, tag_group2, tag_name, tag_plan, service, family, os, region, usage_type, partial_rate, noupfront_rate, ondemand_rate,
  round(sum(usage_amount), 4) AS usage_amount, CASE WHEN round(sum(usage_amount) / hours, 0) = 1 THEN '100%' ELSE round(sum(usage_amount) / hours, 0)::BIGINT::VARCHAR END AS utilisation
  FROM named GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, hours"))
def utilisation(t):
    return rounded(B.utilisation(named(t)), "usage_amount")


PRICE_LIST_SQL = """price_list AS (SELECT DISTINCT sku, usage_type, region, os AS engine, o.term, o.option, o.lease, o.unit, round(ondemand_rate * o.factor, 4) AS price FROM bill_source,
  (VALUES ('OnDemand', NULL, NULL, 'Hrs', 1.0::DOUBLE), ('Reserved', 'All Upfront', '1yr', 'Quantity', 5000.0::DOUBLE), ('Reserved', 'Partial Upfront', '1yr', 'Hrs', 0.5::DOUBLE),
   ('Reserved', 'No Upfront', '1yr', 'Hrs', 0.6::DOUBLE), ('Reserved', 'No Upfront', '3yr', 'Hrs', 0.4::DOUBLE), ('Reserved', 'All Upfront', '1yr', 'Hrs', 0.0::DOUBLE)) o(term, option, lease, unit, factor)
  WHERE usage_type LIKE 'BoxUsage%')"""


def price_list(t: Tables):
    """Price list with one on-demand and five reserved offers for each sku."""
    offer = lambda *values: F.struct(*[F.lit(v).cast(k).alias(n) for v, k, n in zip(values, ("string",) * 4 + ("double",), ("term", "option", "lease", "unit", "factor"))])
    offers = F.array(
        offer("OnDemand", None, None, "Hrs", 1.0), offer("Reserved", "All Upfront", "1yr", "Quantity", 5000.0),
        offer("Reserved", "Partial Upfront", "1yr", "Hrs", 0.5), offer("Reserved", "No Upfront", "1yr", "Hrs", 0.6),
        offer("Reserved", "No Upfront", "3yr", "Hrs", 0.4), offer("Reserved", "All Upfront", "1yr", "Hrs", 0.0),
    )
    skus = S.bill_source(t).filter(F.col("usage_type").like("BoxUsage%")).select("sku", "usage_type", "region", F.col("os").alias("engine"), "ondemand_rate").distinct()
    rows = skus.select("*", F.inline(offers))
    return rows.select("sku", "usage_type", "region", "engine", "term", "option", "lease", "unit", F.round(F.col("ondemand_rate") * F.col("factor"), 4).alias("price"))


REFERENCE_SQL = """reference AS (SELECT DISTINCT d.service, d.region, d.usage_type, d.ondemand_rate, a.sku, a.engine, r.option,
  CASE WHEN r.option = 'All Upfront' THEN r.price / 12 / 730 ELSE r.price END AS hourly_price
  FROM (SELECT DISTINCT service, usage_type, region, ondemand_rate FROM asset_fact WHERE service = 'Database') d
  JOIN price_list a ON d.usage_type = a.usage_type AND d.region = a.region AND d.ondemand_rate = a.price AND a.term = 'OnDemand'
  JOIN (SELECT DISTINCT sku, usage_type, region, option, price FROM price_list WHERE term = 'Reserved' AND lease = '1yr' AND ((unit = 'Hrs' AND option <> 'All Upfront') OR (unit = 'Quantity' AND option = 'All Upfront'))) r
  ON a.sku = r.sku AND a.usage_type = r.usage_type AND a.region = r.region)"""


def reference(t: Tables):
    used = B.asset_fact(assets(t)).filter("service = 'Database'")
    return B.reserved_prices(used, price_list(t))


@query("cur_17", S.with_sql(*ASSET_CHAIN, PRICE_LIST_SQL, REFERENCE_SQL) + "SELECT * REPLACE (round(hourly_price, 8) AS hourly_price) FROM reference")
def reserved_prices(t):
    return rounded(reference(t), "hourly_price", digits=8)


RATES, NEWER = {"partial_rate": "Partial Upfront", "noupfront_rate": "No Upfront"}, {"t2": "m5", "m4": "m5"}


def price_sql(option: str, extra: str = "") -> str:
    return f"""(SELECT min(hourly_price) FROM reference r WHERE r.option = '{option}' AND r.usage_type = replace(replace(a.usage_type, 't2', 'm5'), 'm4', 'm5')
    AND r.service = a.service AND r.region = a.region AND r.ondemand_rate = a.ondemand_rate {extra})"""


@query("cur_18", S.with_sql(*ASSET_CHAIN, PRICE_LIST_SQL, REFERENCE_SQL) + f"""SELECT a.owner_id, a.tag_name, a.resource_id, a.usage_type, a.region, a.os, a.ondemand_rate,
  coalesce(a.partial_rate, {price_sql('Partial Upfront', 'AND r.engine = a.os')}) AS partial_rate, coalesce(a.noupfront_rate, {price_sql('No Upfront', 'AND r.engine = a.os')}) AS noupfront_rate FROM asset_fact a""")
def backfilled_rates(t):
    """Missing rates of assets, from prices of their own engine."""
    found = B.backfill_rates(B.asset_fact(assets(t)), reference(t), RATES, NEWER, engine="os")
    return found.select("owner_id", "tag_name", "resource_id", "usage_type", "region", "os", "ondemand_rate", "partial_rate", "noupfront_rate")


@query("cur_18b", S.with_sql(*ASSET_CHAIN, PRICE_LIST_SQL, REFERENCE_SQL) + f"""SELECT service, family, os, region, usage_type, ondemand_rate, coalesce({price_sql('Partial Upfront')}, partial_rate) AS partial_rate,
  coalesce({price_sql('No Upfront')}, noupfront_rate) AS noupfront_rate FROM (SELECT DISTINCT service, family, os, region, usage_type, partial_rate, noupfront_rate, ondemand_rate FROM asset_fact) a""")
def repriced_rates(t):
    """The wider pass over the rate dimension: prices of any engine replace what is there."""
    return B.backfill_rates(B.rate_dimension(B.asset_fact(assets(t))), reference(t), RATES, NEWER, only_missing=False)


RATE_OVERRIDES = [
    ("Database", "region-1", "BoxUsage:m5.large", 1.25, 0.124, 0.128),
    ("Search", "region-3", "BoxUsage:t2.large", 2.375, 0.2, 0.25),
    ("Compute", "region-0", "BoxUsage:m4.large", 1.0, None, 0.5),
]


@query("cur_19", S.with_sql(*ASSET_CHAIN, "fixed(service, region, usage_type, ondemand_rate, p, n) AS (VALUES " + ", ".join(
    f"('{a}', '{b}', '{c}', {d}::DOUBLE, {'NULL' if e is None else e}::DOUBLE, {f}::DOUBLE)" for a, b, c, d, e, f in RATE_OVERRIDES) + ")") + """
  SELECT r.service, r.family, r.os, r.region, r.usage_type, r.ondemand_rate, CASE WHEN f.service IS NOT NULL THEN f.p ELSE r.partial_rate END AS partial_rate,
  CASE WHEN f.service IS NOT NULL THEN f.n ELSE r.noupfront_rate END AS noupfront_rate
  FROM (SELECT DISTINCT service, family, os, region, usage_type, partial_rate, noupfront_rate, ondemand_rate FROM asset_fact) r
  LEFT JOIN fixed f ON r.service = f.service AND r.region = f.region AND r.usage_type = f.usage_type AND r.ondemand_rate = f.ondemand_rate""")
def overridden_rates(t):
    fixed = t.spark.createDataFrame(
        RATE_OVERRIDES, "service string, region string, usage_type string, ondemand_rate double, partial_rate double, noupfront_rate double"
    )
    return B.override_rates(B.rate_dimension(B.asset_fact(assets(t))), fixed)


# ---------------------------------------------------------------------- reports

_rate = "CASE WHEN tag_plan LIKE 'Y%' AND family = 'Compute Instance' THEN TRY_CAST(split_part(tag_plan, ',', 5) AS DOUBLE) - TRY_CAST(split_part(tag_plan, ',', 4) AS DOUBLE) ELSE 0 END"


@query("cur_20", FACT + f"""SELECT year, month, tag_group2, name AS tag_name, tag_plan, service, family, region, round(sum(net_cost), 2) AS net_cost, round(sum(usage_amount), 4) AS usage_amount, round(sum(ondemand_cost), 2) AS ondemand_cost,
  {_rate} AS adjusted_rate, round((sum(ondemand_cost) + {_rate} * sum(usage_amount)) * 0.82::DOUBLE, 5) AS direct_usage
  FROM (SELECT *, CASE WHEN tag_name LIKE 'RUN-%' OR tag_name LIKE 'HUB-%' THEN substring(tag_name, 11, length(tag_name) - 10) WHEN service <> 'Compute' THEN split_part(resource_id, 'res:', -1) ELSE tag_name END AS name
    FROM realloc WHERE tag_group2 IN ('CORE', 'ATLAS')) GROUP BY year, month, tag_group2, name, tag_plan, service, family, region""")
def direct_usage_report(t):
    name = (
        F.when(F.col("tag_name").like("RUN-%") | F.col("tag_name").like("HUB-%"), F.substring("tag_name", F.lit(11), F.length("tag_name") - 10))
        .when(F.col("service") != "Compute", F.split_part("resource_id", F.lit("res:"), F.lit(-1))).otherwise(F.col("tag_name"))
    )
    result = B.direct_usage(stored_fact(t), F.col("tag_group2").isin("CORE", "ATLAS"), name, ["service", "family", "region"])
    return rounded(rounded(rounded(result, "usage_amount"), "net_cost", "ondemand_cost", digits=2), "direct_usage", digits=5)


CHARGE_READS = (
    "line_id", "year", "month", "usage_time", "tag_group2", "tag_name", "resource_id", "tag_local_env", "tag_local_client", "service", "family",
    "usage_amount", "ondemand_cost",
)


@query("cur_21", FACT + """SELECT line_id, year, month, strftime(usage_time, '%Y-%m-01') AS charge_month, 'Cross Charge' AS charge_type, tag_group2, tag_name, resource_id AS resource, tag_local_env, tag_local_client,
  service, family, usage_amount, round(ondemand_cost * 0.82::DOUBLE, 4) AS net_ondemand_cost FROM realloc WHERE tag_group2 = 'BOREALIS' AND ondemand_cost <> 0""")
def cross_charge(t):
    return rounded(B.cross_charge(stored_fact(t, *CHARGE_READS), "BOREALIS"), "net_ondemand_cost")


DETAIL_READS = (
    "year", "month", "usage_time", "billing_entity", "tag_group2", "tag_name", "resource_id", "tag_plan", "service", "family", "region", "os",
    "instance_type", "pricing_term", "pricing_unit", "ondemand_rate", "tag_local_env", "tag_local_client", "tag_local_group1", "tag_local_group2",
    "tag_product", "item_type", "usage_amount", "ondemand_cost",
)


@query("cur_22", FACT + """SELECT year, month, strftime(usage_time, '%Y-%m-01') AS charge_month, billing_entity, tag_group2, coalesce(tag_name, '') AS tag_name, resource_id, tag_plan, service, family, region, os, instance_type, pricing_term,
  pricing_unit, ondemand_rate, max(tag_local_env) AS tag_local_env, max(tag_local_client) AS tag_local_client, max(tag_local_group1) AS tag_local_group1, max(tag_local_group2) AS tag_local_group2, max(tag_product) AS tag_product,
  round(sum(usage_amount), 4) AS usage_amount, round(sum(ondemand_cost) * 0.82::DOUBLE, 4) AS net_ondemand_cost FROM realloc WHERE upper(tag_group2) = 'BOREALIS' AND item_type <> 'Tax'
  GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16 HAVING sum(ondemand_cost) * 0.82::DOUBLE <> 0""")
def detailed_usage(t):
    return rounded(B.detailed_usage(stored_fact(t, *DETAIL_READS), "BOREALIS"), "usage_amount", "net_ondemand_cost")


@query("cur_23", FACT + "SELECT year, month, tag_group2, service, family, item_type, round(sum(net_cost), 2) AS net_cost FROM realloc WHERE net_cost <> 0 GROUP BY 1, 2, 3, 4, 5, 6")
def group_summary(t):
    return rounded(B.group_summary(stored_fact(t, "year", "month", "tag_group2", "service", "family", "item_type", "net_cost")), "net_cost", digits=2)


@query("cur_24", S.with_sql(*CHAIN, "accounts AS (SELECT 'acct' || s_suppkey AS owner_id, s_name AS account_name FROM supplier WHERE s_suppkey < 15)",
       "listed(product, area) AS (VALUES ('ATLAS', 'NORTH'), ('CORE', 'NORTH'), ('BOREALIS', 'SOUTH'), ('VEGA-2', 'EAST'))") + """SELECT year, month, account_name, area, tag_group2, service, round(sum(net_cost), 2) AS net_cost
  FROM realloc f LEFT JOIN accounts a ON f.owner_id = a.owner_id LEFT JOIN listed g ON f.tag_group2 = g.product WHERE area IN ('NORTH', 'SOUTH') AND (tag_group2 LIKE 'COR%' OR tag_group2 IN ('ATLAS', 'BOREALIS'))
  AND item_type LIKE '%Usage' AND service NOT LIKE '%Market%' GROUP BY 1, 2, 3, 4, 5, 6""")
def account_group_query(t):
    listed = t.spark.createDataFrame([("ATLAS", "NORTH"), ("CORE", "NORTH"), ("BOREALIS", "SOUTH"), ("VEGA-2", "EAST")], "tag_group2 string, area string")
    group = F.col("tag_group2")
    whole = stored_fact(t, "year", "month", "owner_id", "tag_group2", "service", "item_type", "net_cost")
    picked = whole.filter((group.like("COR%") | group.isin("ATLAS", "BOREALIS")) & F.col("item_type").like("%Usage") & ~F.col("service").like("%Market%"))
    joined = picked.join(accounts(t), "owner_id", "left").join(listed, "tag_group2", "left").filter(F.col("area").isin("NORTH", "SOUTH"))
    return joined.groupBy("year", "month", "account_name", "area", "tag_group2", "service").agg(F.round(F.sum("net_cost"), 2).alias("net_cost"))


@query("cur_25", FACT + """SELECT 'source' AS stage, count(*) AS row_count FROM bill_source UNION ALL SELECT 'normalised', count(*) FROM norm UNION ALL SELECT 'by name', count(*) FROM by_name UNION ALL SELECT 'fact', count(*) FROM realloc""")
def reconciliation(t):
    return B.stage_counts({"source": S.bill_source(t), "normalised": norm(t), "by name": by_name(t), "fact": stored_fact(t)})


@query("cur_26", NORM + """SELECT resource_id, owner_id, min(tag_group2) AS lowest, max(tag_group2) AS highest, count(*) AS rules FROM
  (SELECT DISTINCT resource_id, owner_id, tag_group2 FROM norm WHERE tag_group2 IS NOT NULL) GROUP BY 1, 2 HAVING count(*) > 1""")
def conflicting_tags(t):
    """Resources of one owner that carry several groups."""
    pairs = norm(t).filter("tag_group2 IS NOT NULL").select("resource_id", "owner_id", F.col("tag_group2").alias("new")).distinct()
    return R.rule_conflicts(pairs, ["resource_id", "owner_id"])


@query("cur_27", S.with_sql(S.BILL_SOURCE_SQL) + """SELECT strftime(min(usage_time), '%Y-%m-%d') AS first_day, owner_id, item_type, product_code, resource, round(sum(net_cost), 2) AS net_cost FROM bill_source
  WHERE year = 2000 AND coalesce(tag_product, '') <> 'product1' GROUP BY 2, 3, 4, 5 HAVING min(usage_time) >= TIMESTAMP '2000-07-02' AND sum(net_cost) > 0""")
def migrated_tags(t):
    """Resources first seen after a day and not carrying the migration tag."""
    picked = S.bill_source(t).filter((F.col("year") == 2000) & (F.coalesce("tag_product", F.lit("")) != "product1"))
    grouped = picked.groupBy("owner_id", "item_type", "product_code", "resource").agg(
        F.min("usage_time").alias("first_seen"), F.round(F.sum("net_cost"), 2).alias("net_cost")
    )
    return grouped.filter("first_seen >= '2000-07-02' AND net_cost > 0").select(F.to_date("first_seen").alias("first_day"), "owner_id", "item_type", "product_code", "resource", "net_cost")


@query("cur_28", FACT + "SELECT year, month, count(*) AS lines, round(sum(net_cost), 2) AS net_cost FROM realloc GROUP BY 1, 2")
def full_fact(t):
    whole = stored_fact(t, "year", "month", "usage_time", "net_cost")
    archive, current = whole.filter("usage_time < '2000-06-01'"), whole.filter("usage_time >= '2000-06-01'")
    return archive.unionByName(current).groupBy("year", "month").agg(F.count("*").alias("lines"), F.round(F.sum("net_cost"), 2).alias("net_cost"))


@query("cur_29", NORM + "SELECT DISTINCT service, family, operation, os, region, pricing_unit, pricing_term, usage_type, item_type FROM norm")
def key_dimensions(t):
    return norm(t).select("service", "family", "operation", "os", "region", "pricing_unit", "pricing_term", "usage_type", "item_type").distinct()


@query("cur_30", FACT + """SELECT year, month, (day(last_day(usage_time)) * 24)::BIGINT AS hours, CASE WHEN tag_group2 <> '' THEN tag_group2 ELSE 'ASSETS NOT ALLOCATED' END AS tag_group2, service, family, item_type,
  round(sum(net_cost), 2) AS net_cost, round(sum(ondemand_cost), 2) AS ondemand_cost FROM realloc WHERE usage_type LIKE '%BoxUsage%' AND item_type LIKE '%Usage%' AND service = 'Compute'
  GROUP BY 1, 2, 3, 4, 5, 6, 7""".replace("GROUP BY 1, 2, 3, 4, 5, 6, 7", "GROUP BY year, month, (day(last_day(usage_time)) * 24)::BIGINT, CASE WHEN tag_group2 <> '' THEN tag_group2 ELSE 'ASSETS NOT ALLOCATED' END, service, family, item_type"))
def instance_summary(t):
    return rounded(B.instance_summary(stored_fact(t)), "net_cost", "ondemand_cost", digits=2)


@query("cur_31", FACT + """SELECT strftime(usage_time, '%Y-%m-%d') AS day, service || '-' || family AS detailed_service, pricing_unit, resource_id, round(sum(usage_amount), 4) AS usage_amount, round(sum(net_cost), 2) AS net_cost
  FROM realloc WHERE tag_group2 = 'CORE' AND tag_product = 'PRODUCT1' GROUP BY 1, 2, 3, 4""")
def daily_service(t):
    return rounded(rounded(B.daily_service(stored_fact(t), "CORE", "PRODUCT1"), "usage_amount"), "net_cost", digits=2)


@query("cur_32", S.with_sql(COMMITTED_SQL) + "SELECT tag_group2, strftime(usage_month, '%Y-%m-%d') AS usage_month, hours::BIGINT AS hours, plan_rate, ondemand_rate FROM committed")
def commitment_totals(t):
    return commitments(t)


@query("cur_33", FACT + """SELECT 'name' AS by, tag_group2, tag_name, resource_id, round(sum(ondemand_cost), 2) AS ondemand_cost, round(sum(net_cost), 2) AS net_cost FROM realloc WHERE tag_name LIKE '%NODE 11%' GROUP BY 2, 3, 4
  UNION ALL SELECT 'resource', tag_group2, tag_name, resource_id, round(sum(ondemand_cost), 2), round(sum(net_cost), 2) FROM realloc WHERE resource_id LIKE '%res:19%' GROUP BY 2, 3, 4
  UNION ALL SELECT 'group', tag_group2, tag_name, resource_id, round(sum(ondemand_cost), 2), round(sum(net_cost), 2) FROM realloc WHERE tag_group2 LIKE '%SOUTH%' GROUP BY 2, 3, 4""")
def drill_downs(t):
    whole = stored_fact(t)
    part = lambda by, column, pattern: B.drill_down(whole, column, pattern).withColumn("by", F.lit(by))
    result = part("name", "tag_name", "%NODE 11%").unionByName(part("resource", "resource_id", "%res:19%")).unionByName(part("group", "tag_group2", "%SOUTH%"))
    return rounded(result, "ondemand_cost", "net_cost", digits=2)


@query("cur_34", S.with_sql(*ASSET_CHAIN, NAMED_SQL) + "SELECT DISTINCT service, family, os, region, usage_type, partial_rate, noupfront_rate, ondemand_rate FROM named")
def rate_dimension(t):
    return B.rate_dimension(named(t))


TAG_DIM_SQL = """tag_dim AS (SELECT resource_id, owner_id, max(coalesce(tag_group2, '')) AS tag_group2 FROM norm GROUP BY 1, 2)"""


@query("cur_35", S.with_sql(S.BILL_SOURCE_SQL, NORM_SQL, RULES_SQL, TAG_DIM_SQL) + """SELECT resource_id, owner_id, CASE WHEN g = '' AND o.new IS NOT NULL THEN o.new ELSE g END AS tag_group2 FROM (
  SELECT resource_id, owner_id, coalesce((SELECT arg_min(upper(trim(new)), priority) FROM rules WHERE kind = 'resource' AND resource_id LIKE pattern AND original = owner_id), tag_group2) AS g FROM tag_dim)
  LEFT JOIN rules o ON o.kind = 'owner' AND o.pattern = owner_id""")
def tag_dimension(t):
    tags = norm(t).groupBy("resource_id", "owner_id").agg(F.max(F.coalesce("tag_group2", F.lit(""))).alias("tag_group2"))
    return B.refresh_tag_dimension(tags, rule_rows(t))


OLD_ID_SQL = retag_sql("old_id", "norm", "resource_id", B.OLD_FORM_NULLS, bypass=False, originals=True)
OLD_NAME_SQL = retag_sql("old_name", "old_id", "tag_name", B.OLD_FORM_NULLS, bypass=False)


@query("cur_36", S.with_sql(S.BILL_SOURCE_SQL, NORM_SQL, OLD_ID_SQL, OLD_NAME_SQL) + f"SELECT line_id, {_tags} FROM old_name")
def retagged_old_form(t):
    return B.retag_old_form(norm(t).select("line_id", "usage_time", "resource_id", *B.TAGS)).select("line_id", *B.TAGS)


