"""Compute-usage cost products over the line items as metered usage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace import workspace
from millrace.catalog import standins as S
from millrace.catalog.registry import Tables, query
from millrace.operators import changes
from millrace.plans import monthly
from millrace.plans import usage as U
from millrace.sources import files

AS_OF = dt.date(2000, 6, 15)
START, BEFORE = "DATE '2000-06-01'", "DATE '2000-05-01'"

# (new group, group patterns, agency patterns)
REMAP = [
    ("PX-GROUP", ["%PRISM%"], ["%AG3%"]),
    ("REEF-GROUP", ["%REEF%"], []),
    ("HARBOR-GROUP", ["%HARBOR%"], []),
    ("KILN-GROUP", ["%KILN%"], []),
    ("BLOOM-GROUP", ["%BLOOM%"], []),
]
RULES = [
    U.GroupRule("HARBOR-GROUP", ("ws1",), ("%HARBOR%",)),
    U.GroupRule("PX-GROUP", ("ws2", "ws3"), ("%PX%",)),
    U.GroupRule("REEF-GROUP", ("ws4",)),
    U.GroupRule("OMEGA-GROUP", (), ("%OMEGA%",)),
]
ROLLED = ["%KILN%", "%BLOOM%", "%ZETA%"]
ROOT = "CORE-GROUP"
# budgets above and below a month's cost, and limits far off, so that every alert occurs; a limit of zero
CONTRACTS = [
    # id, parent, key, value, from, to, committed, annual, month, limit, active
    ("k0", "k0", "group", "CORE", "1995-01-01", "2002-12-31", 90000.0, 36000.0, 3000.0, None, 1),
    ("k1", "k0", "group", "PX", "1996-01-01", "2000-12-31", 50000.0, 12000000.0, 1000000.0, 60000.0, 1),
    ("k2", "k0", "group", "REEF", "1997-02-15", "2000-06-30", 20000.0, 6000.0, 500.0, None, 0),
    ("k3", "k0", "group", "HARBOR", "1998-01-01", "2001-03-31", 30000.0, 9000.0, 750.0, 1000000000.0, 1),
    ("k4", "k0", "group", "CORE", "1999-01-01", "2000-06-30", 10000.0, 2400.0, 200.0, 15000.0, 0),
    ("k5", "k0", "group", "CORE", "2000-07-01", "2001-12-31", 8000.0, 1200.0, 100.0, 0.0, 0),
]
CONTRACT_DDL = (
    "contract_id string, parent_id string, tag_key string, tag_value string, date_from string, date_to string, "
    "committed double, annual_budget double, month_budget double, hard_limit double, is_active int"
)


def tags(t: Tables):
    return U.latest_tags(S.usage(t), REMAP)


def fact(t: Tables):
    return U.daily_fact(S.usage(t), S.contract_prices(t), S.list_prices(t), tags(t), RULES)


def stored_fact(t: Tables):
    """The fact as the stored table that roll-ups and reports read."""
    return workspace.stored(lambda: fact(t), t.spark, "usage-fact", t.root)


def fact_slice(t: Tables, which: str):
    return U.month_slice(stored_fact(t), "usage_date", AS_OF, which)


def contracts(t: Tables):
    rows = t.spark.createDataFrame(CONTRACTS, CONTRACT_DDL)
    return rows.withColumn("date_from", F.to_date("date_from")).withColumn("date_to", F.to_date("date_to"))


def terms(t: Tables, which: str, by_sub_group: bool = False):
    cost = workspace.settle(U.monthly_cost(fact_slice(t, which), ROLLED, ROOT, by_sub_group), "monthly")
    return U.with_contract_terms(cost, contracts(t), "group", "CORE")


def settled_terms(t: Tables, by_sub_group: bool = False):
    """Archive and current month with their terms, from one pass over the usage.

    The monthly cost is written once: it is tiny, and both parts read it.
    """
    cost = workspace.settle(U.monthly_cost(stored_fact(t), ROLLED, ROOT, by_sub_group), "monthly")
    first = F.make_date("year", "month", F.lit(1))
    start = F.lit(AS_OF.replace(day=1))
    return [
        U.with_contract_terms(part, contracts(t), "group", "CORE")
        for part in (cost.filter(first < start), cost.filter(first >= start))
    ]


def rounded(df, *columns, digits: int = 4):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ check texts

_remap = " ".join(
    "WHEN " + " OR ".join([f"g LIKE '{p}'" for p in groups] + [f"a LIKE '{p}'" for p in agencies]) + f" THEN '{new}'"
    for new, groups, agencies in REMAP
)
TAGS_SQL = f"""tags AS (SELECT entity_id, a AS agency, d AS division, CASE {_remap} ELSE g END AS cost_group, project, client FROM (
  SELECT entity_id, upper(replace(tag_agency, ' ', '')) AS a, upper(replace(tag_division, ' ', '')) AS d,
    upper(replace(tag_group, ' ', '')) AS g, upper(trim(tag_project)) AS project, upper(trim(tag_client)) AS client,
    row_number() OVER (PARTITION BY entity_id ORDER BY usage_time DESC, record_id DESC) AS rn
  FROM usage WHERE tag_group IS NOT NULL) WHERE rn = 1)"""
_group = """CASE WHEN (tg IS NULL AND workspace_id = 'ws1') OR upper(tg) LIKE '%HARBOR%' THEN 'HARBOR-GROUP'
  WHEN (tg IS NULL AND workspace_id IN ('ws2', 'ws3')) OR upper(tg) LIKE '%PX%' THEN 'PX-GROUP'
  WHEN tg IS NULL AND workspace_id = 'ws4' THEN 'REEF-GROUP' WHEN upper(tg) LIKE '%OMEGA%' THEN 'OMEGA-GROUP' ELSE upper(tg) END"""
FACT_SQL = f"""fact AS (SELECT CAST(year(usage_date) AS BIGINT) AS year, CAST(month(usage_date) AS BIGINT) AS month, usage_date, workspace_id,
  agency, division, {_group} AS cost_group, project, client, sku, listed_rate, contract_rate, entity_type, entity_id,
  sum(quantity) AS quantity, sum(quantity) * listed_rate AS cost, sum(quantity) * contract_rate AS net_cost
  FROM (SELECT u.*, l.listed_rate, coalesce(c.contract_rate, l.listed_rate) AS contract_rate, c.entity_type,
      g.agency, g.division, g.cost_group AS tg, g.project, g.client
    FROM usage u LEFT JOIN contract_prices c ON u.sku = c.sku AND c.end_date IS NULL
    LEFT JOIN list_prices l ON u.sku = l.sku AND l.end_date IS NULL LEFT JOIN tags g ON u.entity_id = g.entity_id)
  GROUP BY ALL)"""
FACT_CTES = (S.USAGE_SQL, S.LIST_PRICES_SQL, S.CONTRACT_PRICES_SQL, TAGS_SQL.replace("GROUP BY ALL", ""), FACT_SQL.replace(
    "GROUP BY ALL", "GROUP BY usage_date, workspace_id, agency, division, tg, project, client, sku, listed_rate, contract_rate, entity_type, entity_id"))
FACT = S.with_sql(*FACT_CTES)


def _value(x):
    return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)


CONTRACTS_SQL = "contracts AS (SELECT contract_id, parent_id, tag_key, tag_value, CAST(date_from AS DATE) AS date_from, CAST(date_to AS DATE) AS date_to, " \
    "CAST(committed AS DOUBLE) AS committed, CAST(annual_budget AS DOUBLE) AS annual_budget, CAST(month_budget AS DOUBLE) AS month_budget, CAST(hard_limit AS DOUBLE) AS hard_limit, CAST(is_active AS BIGINT) AS is_active FROM (VALUES " + ", ".join(
    "(" + ", ".join(map(_value, row)) + ")" for row in CONTRACTS
) + ") v(contract_id, parent_id, tag_key, tag_value, date_from, date_to, committed, annual_budget, month_budget, hard_limit, is_active))"

_main = "CASE WHEN cost_group LIKE '%KILN%' OR cost_group LIKE '%BLOOM%' OR cost_group LIKE '%ZETA%' OR cost_group IS NULL THEN 'CORE-GROUP' ELSE cost_group END"


def terms_sql(sub: bool) -> str:
    extra = ", cost_group AS sub_group" if sub else ""
    keep = "sub_group, " if sub else ""
    return f"""cost AS (SELECT year, month, make_date(year, month, 1) AS ym, {_main} AS main_group{extra}, sum(net_cost) AS usage_cost
      FROM fact GROUP BY ALL),
    terms AS (SELECT year, month, ym, main_group, {keep}usage_cost, ifnull(o.contract_id, r.contract_id) AS contract_id, ifnull(o.committed, 0) AS committed,
      ifnull(o.annual_budget, 0) AS annual_budget, ifnull(o.month_budget, 0) AS month_budget,
      CASE WHEN ifnull(o.is_active, r.is_active) = 1 THEN ifnull(o.hard_limit, 95) ELSE ifnull(o.hard_limit, ifnull(o.month_budget, r.month_budget)) END AS hard_limit,
      ifnull(o.is_active, r.is_active) AS contract_status
      FROM cost LEFT JOIN contracts o ON main_group LIKE o.tag_value || '%' AND o.parent_id <> o.contract_id AND ym >= o.date_from AND ym <= o.date_to
      LEFT JOIN contracts r ON main_group NOT LIKE r.tag_value || '%' AND r.tag_key = 'group' AND r.tag_value = 'CORE' AND ym >= r.date_from AND ym <= r.date_to)"""


BY_GROUP = S.with_sql(*FACT_CTES, CONTRACTS_SQL, terms_sql(False))
BY_SUB = S.with_sql(*FACT_CTES, CONTRACTS_SQL, terms_sql(True))
CUMULATIVE_SQL = """cumulated AS (SELECT *, sum(usage_cost) OVER (PARTITION BY contract_id, main_group ORDER BY year, month) AS cumulative_usage_cost,
  sum(month_budget - usage_cost) OVER (PARTITION BY contract_id, main_group, contract_status ORDER BY year, month) AS balance FROM (SELECT DISTINCT * FROM terms))"""
_own = "main_group = sub_group"
SUB_CUMULATIVE_SQL = f"""sub_cumulated AS (SELECT *, cumulative_month_budget - cumulative_contract_usage_cost AS cumulative_month_balance FROM (
  SELECT year, month, ym, main_group, sub_group, usage_cost, CASE WHEN {_own} THEN committed ELSE 0 END AS committed, CASE WHEN {_own} THEN annual_budget ELSE 0 END AS annual_budget,
  CASE WHEN {_own} THEN month_budget ELSE 0 END AS month_budget, CASE WHEN {_own} THEN hard_limit ELSE 0 END AS hard_limit,
  sum(usage_cost) OVER (PARTITION BY contract_id, main_group, sub_group ORDER BY year, month) AS cumulative_usage_cost,
  CASE WHEN {_own} THEN sum(usage_cost) OVER (PARTITION BY contract_id, main_group ORDER BY year, month) ELSE 0 END AS cumulative_contract_usage_cost,
  CASE WHEN {_own} THEN sum(CASE WHEN {_own} THEN month_budget ELSE 0 END) OVER (PARTITION BY contract_id, main_group ORDER BY year, month) ELSE 0 END AS cumulative_month_budget,
  contract_status FROM (SELECT DISTINCT * FROM terms)))"""

# ---------------------------------------------------------------------- queries


@query("dbu_01", S.with_sql(S.USAGE_SQL) + "SELECT entity_id, count(*) AS records, sum(quantity) AS quantity FROM usage GROUP BY 1")
def entity_ids(t):
    return S.usage(t).groupBy(U.entity_id().alias("entity_id")).agg(F.count("*").alias("records"), F.sum("quantity").alias("quantity"))


@query("dbu_02", S.with_sql(S.USAGE_SQL, TAGS_SQL) + "SELECT * FROM tags")
def latest_tags(t):
    return tags(t)


OLD_TAGS_SQL = TAGS_SQL.replace("tags AS", "old_tags AS").replace("IS NOT NULL) WHERE", f"IS NOT NULL AND usage_date < DATE '2000-01-01') WHERE")
NEW_TAGS_SQL = TAGS_SQL.replace("tags AS", "new_tags AS").replace("IS NOT NULL) WHERE", f"IS NOT NULL AND usage_date >= DATE '2000-01-01') WHERE")


@query("dbu_03", S.with_sql(S.USAGE_SQL, OLD_TAGS_SQL, NEW_TAGS_SQL) + """SELECT * FROM old_tags o WHERE NOT EXISTS (SELECT 1 FROM new_tags n WHERE n.entity_id = o.entity_id)
  UNION SELECT * FROM new_tags""")
def tag_history(t):
    records = S.usage(t)
    previous = U.latest_tags(records.filter("usage_date < '2000-01-01'"), REMAP)
    current = U.latest_tags(records.filter("usage_date >= '2000-01-01'"), REMAP)
    return U.tag_history(previous, current)


@query("dbu_04", S.with_sql(S.USAGE_SQL, S.LIST_PRICES_SQL, S.CONTRACT_PRICES_SQL) + """SELECT record_id, u.sku, quantity, l.listed_rate,
  coalesce(c.contract_rate, l.listed_rate) AS contract_rate, c.entity_type FROM usage u
  LEFT JOIN contract_prices c ON u.sku = c.sku AND c.end_date IS NULL LEFT JOIN list_prices l ON u.sku = l.sku AND l.end_date IS NULL""")
def priced_usage(t):
    records = S.usage(t).select("record_id", "sku", "quantity")
    return U.priced_usage(records, S.contract_prices(t), S.list_prices(t))


@query("dbu_05", S.with_sql(S.USAGE_SQL) + f"""SELECT record_id, {_group} AS cost_group FROM (SELECT *, tag_group AS tg FROM usage)""")
def group_assignment(t):
    tag = F.try_element_at("tags", F.lit("group"))
    return S.usage(t).select("record_id", U.assigned_group(tag, F.col("workspace_id"), RULES).alias("cost_group"))


FACT_COLUMNS = "year, month, strftime(usage_date, '%Y-%m-%d') AS usage_date, workspace_id, agency, division, cost_group, project, client, sku, listed_rate, contract_rate, entity_type, entity_id, quantity, round(cost, 4) AS cost, round(net_cost, 4) AS net_cost"


@query("dbu_06", FACT + f"SELECT {FACT_COLUMNS} FROM fact")
def daily_fact(t):
    return rounded(fact(t), "cost", "net_cost")


@query("dbu_07", FACT + f"""SELECT 'current' AS slice, count(*) AS rows, sum(quantity) AS quantity FROM fact WHERE usage_date >= {START}
  UNION ALL SELECT 'previous', count(*), sum(quantity) FROM fact WHERE usage_date >= {BEFORE} AND usage_date < {START}
  UNION ALL SELECT 'history', count(*), sum(quantity) FROM fact WHERE usage_date < {START}""")
def month_slices(t):
    parts = [
        fact_slice(t, which).agg(F.lit(which).alias("slice"), F.count("*").alias("rows"), F.sum("quantity").alias("quantity"))
        for which in ("current", "previous", "history")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("dbu_08", FACT + "SELECT year, month, cost_group, count(*) AS rows, round(sum(net_cost), 4) AS net_cost FROM fact GROUP BY 1, 2, 3")
def full_fact(t):
    whole = U.full_fact(fact_slice(t, "history"), fact_slice(t, "current"))
    return whole.groupBy("year", "month", "cost_group").agg(F.count("*").alias("rows"), F.round(F.sum("net_cost"), 4).alias("net_cost"))


TERM_COLUMNS = "contract_id, committed, annual_budget, month_budget, hard_limit, contract_status"


@query("dbu_09", BY_GROUP + f"SELECT year, month, main_group, round(usage_cost, 4) AS usage_cost, {TERM_COLUMNS} FROM terms WHERE ym < {START}")
def monthly_with_contract(t):
    return rounded(terms(t, "history"), "usage_cost")


@query("dbu_10", BY_SUB + f"SELECT year, month, main_group, sub_group, round(usage_cost, 4) AS usage_cost, {TERM_COLUMNS} FROM terms WHERE ym < {START}")
def monthly_by_sub_group(t):
    return rounded(terms(t, "history", True), "usage_cost")


@query("dbu_11", S.with_sql(*FACT_CTES, CONTRACTS_SQL, terms_sql(False), CUMULATIVE_SQL) + f"""SELECT year, month, strftime(ym, '%Y-%m-%d') AS year_month, main_group, round(usage_cost, 4) AS usage_cost,
  {TERM_COLUMNS}, round(cumulative_usage_cost, 4) AS cumulative_usage_cost, round(balance, 4) AS balance FROM cumulated""")
def running_cost(t):
    return rounded(U.cumulative(*settled_terms(t)), "usage_cost", "cumulative_usage_cost", "balance")


@query("dbu_12", S.with_sql(*FACT_CTES, CONTRACTS_SQL, terms_sql(True), SUB_CUMULATIVE_SQL) + """SELECT year, month, strftime(ym, '%Y-%m-%d') AS year_month, main_group, sub_group, round(usage_cost, 4) AS usage_cost,
  committed, annual_budget, month_budget, hard_limit, round(cumulative_usage_cost, 4) AS cumulative_usage_cost, round(cumulative_contract_usage_cost, 4) AS cumulative_contract_usage_cost,
  cumulative_month_budget, round(cumulative_month_balance, 4) AS cumulative_month_balance, contract_status FROM sub_cumulated""")
def running_cost_by_sub_group(t):
    result = U.cumulative_by_sub_group(*settled_terms(t, True))
    return rounded(result, "usage_cost", "cumulative_usage_cost", "cumulative_contract_usage_cost", "cumulative_month_balance")


@query("dbu_13", S.with_sql(*FACT_CTES, CONTRACTS_SQL, terms_sql(False), CUMULATIVE_SQL) + """SELECT year, month, round(sum(usage_cost), 4) AS usage_cost, sum(month_budget) AS month_budget, sum(annual_budget) AS annual_budget,
  sum(committed) AS committed, CASE WHEN sum(hard_limit) = 0 THEN sum(committed) * 0.95 ELSE sum(hard_limit) END AS hard_limit, round(sum(cumulative_usage_cost), 4) AS cumulative_usage_cost,
  CASE WHEN sum(usage_cost) > sum(month_budget) * 0.95 THEN 10 WHEN sum(cumulative_usage_cost) > sum(hard_limit) THEN 100 ELSE 0 END::BIGINT AS alert
  FROM cumulated GROUP BY 1, 2""")
def dashboard(t):
    return rounded(U.dashboard(U.cumulative(*settled_terms(t))), "usage_cost", "cumulative_usage_cost")


@query("dbu_14", S.with_sql(*FACT_CTES, CONTRACTS_SQL, terms_sql(True), SUB_CUMULATIVE_SQL) + """SELECT 'summary' AS report, NULL AS sub_group, strftime(ym, '%Y-%m-%d') AS year_month, round(sum(usage_cost), 4) AS usage_cost,
  round(avg(month_budget), 4) AS month_budget, round(avg(committed), 4) AS committed, round(CASE WHEN avg(hard_limit) = 0 THEN sum(committed) * 0.95 ELSE avg(hard_limit) END, 4) AS hard_limit,
  round(avg(cumulative_usage_cost), 7) AS cumulative_usage_cost FROM sub_cumulated WHERE main_group = 'CORE-GROUP' GROUP BY ym
  UNION ALL SELECT 'detail', ifnull(sub_group, '-1'), strftime(ym, '%Y-%m-%d'), round(sum(usage_cost), 4), round(sum(month_budget), 4), round(sum(committed), 4),
  round(CASE WHEN sum(hard_limit) = 0 THEN sum(committed) * 0.95 ELSE sum(hard_limit) END, 4), round(sum(cumulative_usage_cost), 7) FROM sub_cumulated WHERE main_group = 'CORE-GROUP' GROUP BY sub_group, ym""")
def agency_report(t):
    cumulated = workspace.settle(U.cumulative_by_sub_group(*settled_terms(t, True)), "cumulated")
    columns = ["report", "sub_group", "year_month", "usage_cost", "month_budget", "committed", "hard_limit", "cumulative_usage_cost"]
    summary = U.agency_summary(cumulated, ROOT).withColumns({"report": F.lit("summary"), "sub_group": F.lit(None).cast("string")})
    detail = U.agency_detail(cumulated, ROOT).withColumn("report", F.lit("detail"))
    both = rounded(summary.select(*columns).unionByName(detail.select(*columns)), "usage_cost")
    both = rounded(both, "cumulative_usage_cost", digits=7)
    return rounded(both, "month_budget", "committed", "hard_limit")


def workspaces(t):
    return t.supplier.filter("s_suppkey < 9").select(
        F.concat(F.lit("ws"), F.col("s_suppkey").cast("string")).alias("workspace_id"), F.col("s_name").alias("workspace"),
        F.concat(F.lit("host"), F.col("s_suppkey").cast("string")).alias("host"),
    )


@query("dbu_15", S.with_sql(*FACT_CTES, "ws AS (SELECT 'ws' || s_suppkey AS workspace_id, s_name AS workspace, 'host' || s_suppkey AS host FROM supplier WHERE s_suppkey < 9)") + """
  SELECT max(year * 100 + month) AS last_month, workspace, workspace_id, cost_group, sku, entity_type, entity_id, project, round(sum(net_cost), 4) AS net_cost,
  CASE WHEN entity_id LIKE 'job/%' OR entity_id LIKE 'warehouse/%' OR entity_id LIKE 'flow/%' OR entity_id LIKE 'vector/%' OR entity_id LIKE 'model/%' OR entity_id LIKE 'cluster/%'
    THEN 'https://' || host || '.example.com/' || entity_id || '?o=' || workspace_id
  WHEN entity_id LIKE 'notebook/%' THEN 'https://' || host || '.example.com/?o=' || workspace_id || '#' || entity_id
  ELSE 'https://' || host || '.example.com/cluster/' || entity_id || '?o=' || workspace_id END AS link
  FROM fact LEFT JOIN ws USING (workspace_id) WHERE cost_group IS NULL OR cost_group NOT LIKE '%-GROUP%' OR workspace IS NULL OR entity_type IS NULL
  GROUP BY workspace, host, workspace_id, cost_group, sku, entity_type, entity_id, project""")
def untagged_audit(t):
    return rounded(U.untagged_audit(stored_fact(t), workspaces(t), "%-GROUP%"), "net_cost")


@query("dbu_16", S.with_sql(S.USAGE_SQL, TAGS_SQL) + """SELECT 'tags' AS source, count(*) AS doubled FROM (SELECT entity_id FROM tags GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'records', count(*) FROM (SELECT entity_id FROM usage GROUP BY 1 HAVING count(*) > 1)""")
def duplicate_entities(t):
    """Entities with more than one row: none among the tags, many among the raw records."""
    count = lambda df, name: changes.duplicate_keys(df, ["entity_id"]).agg(F.lit(name).alias("source"), F.count("*").alias("doubled"))
    return count(tags(t), "tags").unionByName(count(S.usage(t).select(U.entity_id().alias("entity_id")), "records"))


@query("dbu_17", FACT + "SELECT sku, listed_rate, contract_rate, strftime(min(usage_date), '%Y-%m-%d') AS first_day, strftime(max(usage_date), '%Y-%m-%d') AS last_day FROM fact GROUP BY 1, 2, 3")
def price_coverage(t):
    return U.price_coverage(stored_fact(t))


RUNS = (dt.date(2000, 6, 1), dt.date(2000, 7, 1))


def _known_at(end: str, tags: str, fact: str, months: str) -> tuple[str, str]:
    """Tags from the records before a day, and the fact of some months with these tags."""
    known = TAGS_SQL.replace("tags AS", f"{tags} AS", 1).replace("IS NOT NULL) WHERE", f"IS NOT NULL AND usage_date < DATE '{end}') WHERE")
    cut = FACT_CTES[4].replace("fact AS", f"{fact} AS", 1).replace("LEFT JOIN tags g", f"LEFT JOIN {tags} g").replace(
        "ON u.entity_id = g.entity_id)", f"ON u.entity_id = g.entity_id WHERE {months})")
    return known, cut


RUN_SQL = S.with_sql(
    *FACT_CTES[:3], *_known_at("2000-07-01", "june_tags", "june_fact", "u.usage_date < DATE '2000-06-01'"),
    *_known_at("2000-08-01", "july_tags", "july_fact", "u.usage_date >= DATE '2000-06-01' AND u.usage_date < DATE '2000-08-01'"),
    "fact AS (SELECT * FROM june_fact UNION ALL SELECT * FROM july_fact)", CONTRACTS_SQL, terms_sql(False), CUMULATIVE_SQL,
)


@query("dbu_run", RUN_SQL + f"""SELECT year, month, main_group, round(usage_cost, 4) AS usage_cost, {TERM_COLUMNS}, round(cumulative_usage_cost, 4) AS cumulative_usage_cost,
  round(balance, 4) AS balance FROM cumulated""")
def monthly_runs(t):
    """The job for June, broken off once, again, and twice for July: the running cost that is published in the end."""
    store = monthly.Published(t.spark, t.out("cost"))
    inputs = monthly.Inputs(S.usage(t), S.contract_prices(t), S.list_prices(t), contracts(t), REMAP, RULES, ROLLED, ROOT)
    try:
        monthly.run_month(store, inputs, RUNS[0], fail_before_switch=True)
    except RuntimeError:
        pass
    for as_of in (*RUNS, RUNS[1]):
        monthly.run_month(store, inputs, as_of)
    return rounded(store.table("cumulative").drop("year_month"), "usage_cost", "cumulative_usage_cost", "balance")


OVERRIDES = [
    # step, kind, value, cost group, agency, only where there is none
    *[(1, "entity", e, "HAND-GROUP", "HAND", True) for e in ("job/3", "cluster/17", "warehouse/9")],
    (1, "workspace", "ws7", "HAND-GROUP", "HAND", True),
    *[(2, "pattern", p, "POOL-GROUP", None, False) for p in ("pool/1%", "flow/%2")],
    (3, "workspace", "ws5", "WS5-GROUP", "W5", True),
]


@query("dbu_18", FACT + """SELECT usage_date_text AS usage_date, workspace_id, sku, entity_id, CASE WHEN hit3 THEN 'W5' ELSE a1 END AS agency, CASE WHEN hit3 THEN 'WS5-GROUP' ELSE g2 END AS cost_group FROM (
  SELECT *, workspace_id = 'ws5' AND g2 IS NULL AS hit3 FROM (
    SELECT *, CASE WHEN entity_id LIKE 'pool/1%' OR entity_id LIKE 'flow/%2' THEN 'POOL-GROUP' ELSE g1 END AS g2 FROM (
      SELECT *, CASE WHEN hit1 THEN 'HAND-GROUP' ELSE cost_group END AS g1, CASE WHEN hit1 THEN 'HAND' ELSE agency END AS a1 FROM (
        SELECT *, strftime(usage_date, '%Y-%m-%d') AS usage_date_text, coalesce(entity_id IN ('job/3', 'cluster/17', 'warehouse/9') OR workspace_id = 'ws7', false) AND cost_group IS NULL AS hit1 FROM fact))))""")
def overrides(t):
    return U.apply_overrides(stored_fact(t), t.spark.createDataFrame(OVERRIDES, U.OVERRIDES)).select("usage_date", "workspace_id", "sku", "entity_id", "agency", "cost_group")


@query("dbu_19", BY_GROUP + """SELECT CASE main_group WHEN 'PX-GROUP' THEN 'PX-NEW' WHEN 'GAMMA' THEN 'GAMMA-GROUP' ELSE main_group END AS main_group, count(*) AS months, round(sum(usage_cost), 4) AS usage_cost FROM terms GROUP BY 1""")
def renamed_groups(t):
    cost = workspace.settle(U.monthly_cost(stored_fact(t), ROLLED, ROOT), "monthly")
    whole = U.with_contract_terms(cost, contracts(t), "group", "CORE")
    renamed = U.rename_groups(whole, "main_group", {"PX-GROUP": "PX-NEW", "GAMMA": "GAMMA-GROUP"})
    return renamed.groupBy("main_group").agg(F.count("*").alias("months"), F.round(F.sum("usage_cost"), 4).alias("usage_cost"))


@query("dbu_20", FACT + f"SELECT {_main} AS main_group, cost_group, count(*) AS rows FROM fact GROUP BY 1, 2")
def rolled_groups(t):
    main = U.parent_group(F.col("cost_group"), ROLLED, ROOT)
    return stored_fact(t).groupBy(main.alias("main_group"), "cost_group").agg(F.count("*").alias("rows"))


@query("dbu_21", """SELECT CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS BIGINT) AS month, sum(l_quantity) AS quantity, count(*) AS records
  FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-07-01' GROUP BY 1, 2""")
def archive_import(t):
    """Old usage kept as CSV with header, types found by inference."""
    path = t.out("usage-archive")
    old = S.usage(t).filter("usage_date < '1996-07-01'").select("usage_date", "sku", "quantity")
    old.write.option("header", True).csv(path)
    archive = files.read_csv(t.spark, path)
    return archive.groupBy(F.year("usage_date").alias("year"), F.month("usage_date").alias("month")).agg(
        F.sum("quantity").alias("quantity"), F.count("*").alias("records")
    )
