"""Writes: each query writes from the given tables and returns what was stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import workspace
from millrace.catalog.registry import query
from millrace.catalog.standins import SHOP_USERS_SQL, shop_users, with_sql
from millrace.operators import layout
from millrace.operators.changes import merge_into
from millrace.sinks import tables as T

PART_SQL = "SELECT p_partkey, p_name, p_retailprice FROM part"


def part(t):
    return t.part.select("p_partkey", "p_name", "p_retailprice")


@query("snk_01", PART_SQL)
def parquet(t):
    path = t.out("part")
    part(t).write.option("compression", "snappy").mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query("snk_02", PART_SQL)
def table(t):
    return T.save_table(part(t), workspace.fresh_name("part"), t.out("part"))


@query("snk_03", PART_SQL)
def by_format(t):
    path = t.out("part")
    part(t).write.format("orc").mode("overwrite").save(path)
    return t.spark.read.format("orc").load(path)


@query("snk_04", "SELECT p_partkey, p_name FROM part UNION ALL SELECT p_partkey, p_name FROM part WHERE p_size > 40")
def append_csv(t):
    path = t.out("part-csv")
    rows = t.part.select("p_partkey", "p_name")
    rows.write.option("header", True).csv(path)
    t.part.filter("p_size > 40").select("p_partkey", "p_name").write.mode("append").format("csv").option("header", True).save(path)
    return t.spark.read.schema(rows.schema).option("header", True).csv(path)


@query("snk_05", "SELECT o_orderkey, o_totalprice FROM orders")
def replace_table(t):
    """The second statement replaces the table of the first."""
    name, source = workspace.fresh_name("prices"), workspace.fresh_name("orders")
    t.orders.createOrReplaceTempView(source)
    T.save_table(t.orders, name, t.out("first"))
    return T.save_table(t.spark.sql(f"SELECT o_orderkey, o_totalprice FROM {source}"), name, t.out("second"))


@query("snk_06", "SELECT o_orderkey AS order_id, o_totalprice AS price FROM orders")
def projected_table(t):
    renamed = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"))
    return T.save_table(renamed, workspace.fresh_name("renamed"), t.out("renamed"))


@query("snk_07", with_sql(SHOP_USERS_SQL) + """SELECT user_id, email, strftime(make_timestamp(user_first_touch_timestamp), '%Y-%m-01') AS first_touch_month,
  '2024-02-01 00:00:00.000000' AS loaded_at FROM shop_users""")
def partitioned_table(t):
    """Partitioned by month with load time; the table carries a comment."""
    users = shop_users(t).select(
        "user_id", "email", F.trunc(F.timestamp_micros("user_first_touch_timestamp"), "month").alias("first_touch_month"),
        F.lit("2024-02-01").cast("timestamp").alias("loaded_at"),
    )
    name = workspace.fresh_name("users")
    # AQE gathers small months into one task and splits large ones over several
    T.save_table(users.hint("rebalance", "first_touch_month"), name, t.out("users"), partition_by=["first_touch_month"])
    t.spark.sql(f"COMMENT ON TABLE {name} IS 'Users with the month of their first visit'")
    return t.spark.table(name)


@query("snk_08", "SELECT * REPLACE (n_nationkey::BIGINT AS n_nationkey, n_regionkey::BIGINT AS n_regionkey) FROM (SELECT * FROM nation UNION ALL SELECT * FROM nation)")
def insert_append(t):
    """Appending the same rows again doubles them."""
    name = workspace.fresh_name("nation")
    T.save_table(t.nation, name, t.out("nation"))
    t.nation.write.insertInto(name)
    return t.spark.table(name)


@query("snk_09", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def insert_overwrite(t):
    path = t.out("orders")
    orders = t.orders.select("o_orderkey", "o_totalprice")
    orders.write.parquet(path)
    return T.overwrite_checked(orders.filter("o_totalprice > 100000"), t.spark, path)


@query("snk_10", "SELECT o_orderkey, o_custkey FROM orders")
def load_once(t):
    """Three loads of a growing folder: every file is taken exactly once."""
    folder, target, checkpoint = t.out("incoming"), t.out("loaded"), t.out("checkpoint")
    orders = t.orders.select("o_orderkey", "o_custkey")
    load = lambda: T.load_once(t.spark, folder, "json", orders.schema, target, checkpoint)
    orders.filter("o_orderkey % 2 = 0").write.json(folder)
    load()
    load()
    orders.filter("o_orderkey % 2 = 1").write.mode("append").json(folder)
    return load()


@query("snk_11", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders")
def generated_column(t):
    """Computed where it is not supplied, compared where it is."""
    day = F.to_date("o_orderdate")
    plain = T.with_generated(t.orders.filter("o_orderkey % 2 = 0"), "order_day", day)
    given = T.with_generated(t.orders.filter("o_orderkey % 2 = 1").withColumn("order_day", day), "order_day", day)
    path = t.out("orders")
    plain.unionByName(given).select("o_orderkey", "order_day").write.parquet(path)
    return t.spark.read.parquet(path)


@query("snk_12", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders")
def check_constraint(t):
    checked = T.with_check(t.orders, "valid_date", F.col("o_orderdate") > F.lit("1990-01-01"))
    path = t.out("orders")
    checked.select("o_orderkey", F.to_date("o_orderdate").alias("order_day")).write.parquet(path)
    return t.spark.read.parquet(path)


@query("snk_13", """SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS s_acctbal FROM supplier
  UNION ALL SELECT s_suppkey + 1000000, NULL, s_acctbal FROM supplier WHERE s_suppkey % 2 = 1""")
def schema_evolution(t):
    """A merge whose source brings a column: the target gains it, null in rows that the source does not name."""
    key = F.col("s_suppkey")
    source = t.supplier.select(F.when(key % 2 == 0, key).otherwise(key + 1000000).alias("s_suppkey"), "s_acctbal")
    return merge_into(t.supplier.select("s_suppkey", "s_name"), source, ["s_suppkey"], evolve=True)


@query("snk_14", "SELECT 0::BIGINT AS stored, count(*) AS source FROM orders")
def empty_copy(t):
    """A table with the columns of a query and none of its rows."""
    path = t.out("empty")
    t.orders.limit(0).write.parquet(path)
    empty = t.spark.read.parquet(path)
    assert empty.columns == t.orders.columns
    both = empty.select(F.lit("stored").alias("side")).union(t.orders.select(F.lit("source")))
    return both.agg(F.count_if(F.col("side") == "stored").alias("stored"), F.count_if(F.col("side") == "source").alias("source"))


@query("snk_15", "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate, l_linenumber::BIGINT AS l_linenumber) FROM lineitem")
def dataset_copy(t):
    path = t.out("lineitem-copy")
    t.lineitem.write.parquet(path)
    return t.spark.read.parquet(path)


@query("snk_16", "SELECT o_orderkey, o_custkey, NULL::DOUBLE AS discount, NULL::VARCHAR AS note FROM orders")
def altered_columns(t):
    kept = t.orders.drop("o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return kept.withColumns({"discount": F.lit(None).cast("double"), "note": F.lit(None).cast("string")})


@query("snk_17", """SELECT p_partkey AS part_id, CASE WHEN p_size % 7 = 0 THEN 0 ELSE p_retailprice END AS budget, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size::BIGINT END AS size FROM part""")
def promoted(t):
    """Text columns with marker words become typed columns."""
    text = t.part.select(
        F.col("p_partkey").cast("string").alias("_c0"), F.when(F.col("p_size") % 7 == 0, "NA").otherwise(F.col("p_retailprice").cast("string")).alias("budget"),
        F.when(F.col("p_size") % 5 == 0, "unknown").otherwise(F.col("p_size").cast("string")).alias("size"),
    )
    return T.promote(text, {"_c0": "part_id"}, {"_c0": "bigint", "budget": "double", "size": "int"}, {"budget": ("NA", "0")})


@query("snk_18", """SELECT l_partkey, l_suppkey, count(*) AS lines, round(sum(l_extendedprice), 2) AS total, true AS fewer_files FROM lineitem GROUP BY 1, 2""")
def compaction(t):
    """Many small files rewritten into few, clustered on two columns."""
    path, out = t.out("scattered"), t.out("clustered")
    columns = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    columns.repartition(24).write.parquet(path)
    scattered = t.spark.read.parquet(path)
    layout.clustered(scattered, ["l_partkey", "l_suppkey"]).write.parquet(out)
    compact = t.spark.read.parquet(out)
    fewer = len(compact.inputFiles()) < len(scattered.inputFiles())
    return compact.groupBy("l_partkey", "l_suppkey").agg(
        F.count("*").alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("total"), F.lit(fewer).alias("fewer_files")
    )


@query("snk_19", "SELECT event_type, count(*) AS source, true AS stored_part, true AS repeatable FROM events GROUP BY 1")
def sampled_insert(t):
    """A part of the rows chosen by the hash of their id: of each type about a fourth, and the same in every run."""
    path = t.out("pings")
    part = F.pmod(F.xxhash64("event_id"), F.lit(4)) == 0
    t.events.filter(part).select("event_type", "user_id", F.floor(F.col("value")).alias("ping"), "ts").write.parquet(path)
    stored = t.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("stored"))
    source = t.events.groupBy("event_type").agg(F.count("*").alias("source"), F.count_if(part).alias("again"))
    about = F.col("stored").between(F.col("source") * 0.1, F.col("source") * 0.4)
    return source.join(stored, "event_type").select("event_type", "source", about.alias("stored_part"), (F.col("stored") == F.col("again")).alias("repeatable"))


@query("snk_20", "SELECT p_type, count(*) AS parts FROM part WHERE p_retailprice > 920 GROUP BY 1")
def views(t):
    """A second definition under the same name replaces the first."""
    name = workspace.fresh_name("view")
    t.part.createOrReplaceTempView(name)
    t.part.filter("p_retailprice > 920").createOrReplaceTempView(name)
    return t.spark.sql(f"SELECT p_type, count(*) AS parts FROM {name} GROUP BY p_type")
