"""UPDATE, DELETE, MERGE and row versions as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import workspace
from millrace.catalog.registry import Tables, query
from millrace.catalog import bill, standins as S, usage
from millrace.operators import changes as C
from millrace.operators import versions as V
from millrace.plans import bill as B
from millrace.plans import usage as U


@query("dml_01", "SELECT c_custkey, CASE WHEN c_mktsegment LIKE 'M%' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer")
def update(t):
    customer = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    return C.update_where(customer, F.col("c_mktsegment").like("M%"), {"c_acctbal": F.col("c_acctbal") + 1}).drop("c_mktsegment")


@query("dml_02", """SELECT event_id, nullif(event_type, 'view') AS kind FROM events WHERE nullif(event_type, 'view') IS NULL OR nullif(event_type, 'view') <> 'error'""")
def delete(t):
    """A row whose condition is null stays."""
    events = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("kind"))
    return C.delete_where(events, F.col("kind") == "error")


BATCH_SQL = """batch AS (SELECT c_custkey + 700 AS c_custkey, 'M-' || c_name AS c_name, c_acctbal * 2 AS c_acctbal,
  CASE c_custkey % 4 WHEN 0 THEN 'update' WHEN 1 THEN 'delete' WHEN 2 THEN 'insert' ELSE 'update' END AS kind FROM customer),
target AS (SELECT c_custkey, c_name, nullif(c_acctbal, 0) AS c_acctbal FROM customer)"""


def target(t: Tables):
    return t.customer.select("c_custkey", "c_name", F.nullif("c_acctbal", F.lit(0.0)).alias("c_acctbal"))


def batch(t: Tables):
    kind = F.element_at(F.array(*map(F.lit, ("update", "delete", "insert", "update"))), (F.col("c_custkey") % 4 + 1).cast("int"))
    return t.customer.select(
        (F.col("c_custkey") + 700).alias("c_custkey"), F.concat(F.lit("M-"), "c_name").alias("c_name"), (F.col("c_acctbal") * 2).alias("c_acctbal"), kind.alias("kind")
    )


@query("dml_03", f"WITH {BATCH_SQL}" + """SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
  CASE WHEN t.c_custkey IS NULL THEN s.c_name WHEN s.c_acctbal > t.c_acctbal THEN s.c_name ELSE t.c_name END AS c_name,
  CASE WHEN t.c_custkey IS NULL THEN s.c_acctbal WHEN s.c_acctbal > t.c_acctbal THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal
  FROM target t FULL JOIN batch s ON t.c_custkey = s.c_custkey""")
def upsert(t):
    """Matched rows change only when the guard holds; unmatched rows are inserted."""
    return C.merge_into(target(t), batch(t), ["c_custkey"], update_if=F.col("s.c_acctbal") > F.col("t.c_acctbal"))


@query("dml_04", f"WITH {BATCH_SQL}" + """SELECT * FROM target UNION ALL SELECT c_custkey, c_name, c_acctbal FROM batch s
  WHERE kind = 'insert' AND NOT EXISTS (SELECT 1 FROM target t WHERE t.c_custkey = s.c_custkey)""")
def insert_only(t):
    return C.insert_new(target(t), batch(t), ["c_custkey"], F.col("kind") == "insert")


@query("dml_05", f"WITH {BATCH_SQL}" + """SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, CASE WHEN t.c_custkey IS NULL OR s.kind = 'update' THEN s.c_name ELSE t.c_name END AS c_name,
  CASE WHEN t.c_custkey IS NULL OR s.kind = 'update' THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal FROM target t FULL JOIN batch s ON t.c_custkey = s.c_custkey
  WHERE NOT (t.c_custkey IS NOT NULL AND coalesce(s.kind, '') = 'delete') AND NOT (t.c_custkey IS NULL AND s.kind <> 'insert')""")
def three_way(t):
    return C.merge_into(
        target(t), batch(t), ["c_custkey"], update_if=F.col("s.kind") == "update", delete_if=F.col("s.kind") == "delete", insert_if=F.col("s.kind") == "insert"
    )


@query("dml_06", """SELECT coalesce(t.p, s.p) AS part, coalesce(t.q, 0) + coalesce(s.q, 0) AS quantity FROM
  (SELECT l_partkey AS p, sum(l_quantity) AS q FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1) t FULL JOIN
  (SELECT l_partkey AS p, sum(l_quantity) AS q FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1) s ON t.p = s.p""")
def additive(t):
    total = lambda condition: t.lineitem.filter(condition).groupBy(F.col("l_partkey").alias("part")).agg(F.sum("l_quantity").alias("quantity"))
    return C.merge_into(
        total("l_shipdate < '1998-01-01'"), total("l_shipdate >= '1998-01-01'"), ["part"],
        update={"quantity": F.col("t.quantity") + F.col("s.quantity")},
    )


@query("dml_07", usage.FACT + """SELECT strftime(usage_date, '%Y-%m-%d') AS usage_date, workspace_id, sku, f.entity_id, CASE WHEN g.entity_id IS NOT NULL THEN g.division ELSE f.agency END AS agency,
  CASE WHEN g.entity_id IS NOT NULL THEN g.client ELSE f.cost_group END AS cost_group FROM fact f LEFT JOIN
  (SELECT * FROM tags WHERE client IN ('CL1', 'CL2', 'CL3')) g ON f.entity_id = g.entity_id""")
def dimension_update(t):
    """Facts of the entities in a dimension take its values."""
    dimension = usage.tags(t).filter(F.col("client").isin("CL1", "CL2", "CL3")).select("entity_id", F.col("division").alias("agency"), F.col("client").alias("cost_group"))
    fact = usage.stored_fact(t).select("usage_date", "workspace_id", "sku", "entity_id", "agency", "cost_group")
    return C.update_from(fact, dimension, ["entity_id"], ["agency", "cost_group"])


@query("dml_08", usage.FACT + """, gaps AS (SELECT *, CASE WHEN sku::BIGINT % 3 = 0 THEN NULL ELSE contract_rate END AS old_rate FROM fact),
  priced AS (SELECT g.*, c.contract_rate AS new_rate, c.listed_rate AS new_listed, c.entity_type AS new_type, c.sku IS NOT NULL AND (old_rate IS NULL OR old_rate <> c.contract_rate) AS changed
    FROM gaps g LEFT JOIN contract_prices c ON g.sku = c.sku AND usage_date >= c.start_date AND (c.end_date IS NULL OR usage_date <= c.end_date)),
  moved AS (SELECT *, CASE WHEN changed THEN new_rate ELSE old_rate END AS rate2, CASE WHEN changed THEN new_listed ELSE listed_rate END AS listed2 FROM priced)
  SELECT strftime(usage_date, '%Y-%m-%d') AS usage_date, workspace_id, sku, entity_id, listed2 AS listed_rate, rate2 AS contract_rate, CASE WHEN changed THEN new_type ELSE entity_type END AS entity_type,
  round(CASE WHEN cost IS NULL OR cost <> quantity * listed2 THEN quantity * listed2 ELSE cost END, 4) AS cost FROM moved""")
def price_backfill(t):
    gap = F.when(F.col("sku").cast("bigint") % 3 != 0, F.col("contract_rate"))
    fact = usage.stored_fact(t).withColumn("contract_rate", gap)
    result = U.backfill_prices(fact, S.contract_prices(t))
    return usage.rounded(result.select("usage_date", "workspace_id", "sku", "entity_id", "listed_rate", "contract_rate", "entity_type", "cost"), "cost")


@query("dml_09", S.with_sql(S.BILL_SOURCE_SQL, bill.NORM_SQL, bill.RULES_SQL, bill.PASSES_SQL) + "SELECT g AS tag_group2, count(*) AS lines FROM p5 GROUP BY 1")
def rule_merge(t):
    passed = B.rule_passes(bill.norm(t), bill.rule_rows(t))
    return passed.groupBy("tag_group2").agg(F.count("*").alias("lines"))


MONTHS_SQL = """m AS (SELECT year(l_shipdate)::BIGINT AS year, month(l_shipdate)::BIGINT AS month, l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL)"""


def monthly(t: Tables):
    return t.lineitem.groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "l_suppkey").agg(F.sum("l_quantity").alias("quantity"))


@query("dml_10", f"WITH {MONTHS_SQL} " + """SELECT * FROM m WHERE year < 2001 AND NOT (year = 2000 AND month > 6) UNION ALL SELECT year, month, l_suppkey, quantity * 10 FROM m WHERE year = 2001 OR (year = 2000 AND month > 6)""")
def month_replace(t):
    """Months in the new batch replace the stored ones, partition by partition."""
    path = t.out("monthly")
    months = monthly(t)
    months.filter("year < 2001").write.partitionBy("year", "month").parquet(path)
    new = months.filter("year = 2001 OR (year = 2000 AND month > 6)").withColumn("quantity", F.col("quantity") * 10)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)
    return t.spark.read.parquet(path).select("year", "month", "l_suppkey", "quantity")


@query("dml_11", f"WITH {MONTHS_SQL} " + "SELECT * FROM m WHERE year < 2000 UNION ALL SELECT year, month, l_suppkey, quantity * 10 FROM m WHERE year >= 2000")
def month_archive(t):
    """Loaded twice on purpose: the second run finds every month there."""
    months = monthly(t)
    archive = months.filter("year < 2000")
    new = months.filter("year >= 1999").withColumn("quantity", F.col("quantity") * 10)
    once = workspace.settle(C.archive_absent_months(archive, new, ["year", "month"]), "archive")
    return C.archive_absent_months(once, new, ["year", "month"])


# -------------------------------------------------------------------- versions

LOG_SQL = """log AS (
  SELECT c_custkey, 1 AS version, 'insert' AS op, c_name, c_acctbal FROM customer
  UNION ALL SELECT c_custkey, 2, 'update', c_name, c_acctbal + 100 FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT c_custkey, 3, 'delete', NULL, NULL FROM customer WHERE c_custkey % 5 = 0
  UNION ALL SELECT c_custkey + 1000000, 4, 'insert', 'new ' || c_name, c_acctbal FROM customer WHERE c_custkey % 7 = 0
  UNION ALL SELECT c_custkey, 5, 'update', c_name, -1 FROM customer WHERE c_custkey % 11 = 0 AND c_custkey % 5 <> 0)"""


def changelog(t: Tables):
    customer = t.customer.select("c_custkey", "c_name", "c_acctbal")
    entry = lambda df, version, op: df.select("c_custkey", F.lit(version).cast("bigint").alias("version"), F.lit(op).alias("op"), "c_name", "c_acctbal")
    gone = {"c_name": F.lit(None).cast("string"), "c_acctbal": F.lit(None).cast("double")}
    return (
        entry(customer, 1, "insert")
        .unionByName(entry(customer.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 100), 2, "update"))
        .unionByName(entry(customer.filter("c_custkey % 5 = 0").withColumns(gone), 3, "delete"))
        .unionByName(entry(customer.filter("c_custkey % 7 = 0").withColumns({"c_custkey": F.col("c_custkey") + 1000000, "c_name": F.concat(F.lit("new "), "c_name")}), 4, "insert"))
        .unionByName(entry(customer.filter("c_custkey % 11 = 0 AND c_custkey % 5 <> 0").withColumn("c_acctbal", F.lit(-1.0)), 5, "update"))
    )


AS_OF_2 = "SELECT c_custkey, c_name, c_acctbal FROM log WHERE version <= 2 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY version DESC) = 1 AND op <> 'delete'"


@query("ver_01", f"WITH {LOG_SQL} {AS_OF_2}")
def as_of(t):
    return V.as_of_version(changelog(t), ["c_custkey"], 2)


@query("ver_02", f"WITH {LOG_SQL} SELECT version::BIGINT AS version, op, count(*) AS changed_rows FROM log GROUP BY 1, 2")
def history(t):
    return V.history(changelog(t))


@query("ver_03", f"WITH {LOG_SQL} {AS_OF_2}")
def restore(t):
    """Newest state after the restoring changes were appended: equal to the restored version."""
    log = changelog(t)
    restored = log.unionByName(V.restore(log, ["c_custkey"], 2, 6))
    return V.as_of_version(restored, ["c_custkey"], 6)


@query("ver_04", f"WITH {LOG_SQL}, v AS ({AS_OF_2}) SELECT count(*) AS rows, round(sum(c_acctbal), 2) AS total FROM v")
def version_view(t):
    name = workspace.fresh_name("version")
    V.as_of_version(changelog(t), ["c_custkey"], 2).createOrReplaceTempView(name)
    return t.spark.sql(f"SELECT count(*) AS rows, round(sum(c_acctbal), 2) AS total FROM {name}")
