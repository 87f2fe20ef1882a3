"""Scans and sources.  Files are written from the given tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import workspace
from millrace.catalog.registry import Tables, query
from millrace.catalog.standins import SHOP_ITEMS_SQL, shop_events, with_sql
from millrace.sources import files

ORDERS_DDL = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate STRING, o_orderpriority STRING"
ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders"""


def plain_orders(t: Tables):
    return t.orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def staged_orders(t: Tables, kind: str, **options) -> str:
    path = t.out(f"orders-{kind}")
    plain_orders(t).write.format(kind).options(**options).save(path)
    return path


@query("src_01", "SELECT o_orderkey, o_totalprice FROM orders")
def catalog_table_scan(t):
    name = workspace.fresh_name("orders")
    files.external_table(t.spark, name, t.path("orders"), "parquet", "", {})
    return t.spark.table(name).select("o_orderkey", "o_totalprice")


@query("src_02", """SELECT l_returnflag, count(*) AS line_count, round(sum(l_extendedprice), 2) AS revenue
  FROM lineitem GROUP BY 1""")
def parquet_scan(t):
    lines = t.spark.sql(f"SELECT * FROM parquet.`{t.path('lineitem')}`")
    return lines.groupBy("l_returnflag").agg(
        F.count("*").alias("line_count"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")
    )


@query("src_03", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation UNION ALL SELECT s_suppkey, s_name FROM supplier")
def json_directory_scan(t):
    """A folder is the union of its files."""
    path = t.out("names")
    both = t.nation.select("n_nationkey", "n_name").union(t.supplier.select("s_suppkey", "s_name"))
    both.write.json(path)
    return t.spark.sql(f"SELECT n_nationkey, n_name FROM json.`{path}`")


@query("src_04", ORDERS_SQL)
def json_inferred(t):
    return t.spark.read.option("inferSchema", True).json(staged_orders(t, "json"))


ITEM_TYPE = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("price_in_usd", T.DoubleType()),
        T.StructField("quantity", T.LongType()),
    ]
)
EVENT_TYPE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("geo", T.StructType([T.StructField("city", T.StringType()), T.StructField("state", T.StringType())])),
        T.StructField("items", T.ArrayType(ITEM_TYPE)),
    ]
)


@query("src_05", with_sql(SHOP_ITEMS_SQL) + """SELECT e.event_id, e.city, coalesce(n, 0) AS item_count, coalesce(q, 0)::BIGINT AS last_quantity
  FROM shop_events e LEFT JOIN (SELECT event_id, count(*) AS n, max(quantity) AS q FROM shop_items GROUP BY 1) i
  ON e.event_id = i.event_id""")
def json_declared_nested(t):
    path = t.out("events-json")
    shop_events(t).select("event_id", "geo", "items", "device").write.json(path)
    events = t.spark.read.schema(EVENT_TYPE).json(path)
    return events.select(
        "event_id", "geo.city", F.size("items").alias("item_count"),
        F.coalesce(F.array_max("items.quantity"), F.lit(0)).alias("last_quantity"),
    )


@query("src_06", ORDERS_SQL)
def csv_inferred(t):
    read = files.read_csv(t.spark, staged_orders(t, "csv", sep="|", header=True), sep="|")
    return read.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("src_07", ORDERS_SQL)
def csv_declared(t):
    """The same file through a StructType and through DDL text."""
    path = staged_orders(t, "csv", sep="|", header=True)
    fields = T.StructType.fromDDL(ORDERS_DDL)
    by_type = files.read_csv(t.spark, path, fields, sep="|").filter("o_orderkey % 2 = 0")
    by_text = files.read_csv(t.spark, path, ORDERS_DDL, sep="|").filter("o_orderkey % 2 = 1")
    return by_type.unionByName(by_text)


@query("src_08", ORDERS_SQL)
def csv_external_table(t):
    name = workspace.fresh_name("orders_csv")
    path = staged_orders(t, "csv", sep="|", header=True)
    files.external_table(t.spark, name, path, "csv", ORDERS_DDL, {"header": "true", "delimiter": "|"})
    return t.spark.table(name)


@query("src_09", "SELECT o_orderstatus, count(*) AS order_count FROM orders GROUP BY 1")
def csv_strict(t):
    """Strict mode stops at a malformed line; a good file reads as usual."""
    path = staged_orders(t, "csv", header=True)
    return files.read_csv(t.spark, path, ORDERS_DDL, strict=True).groupBy("o_orderstatus").agg(F.count("*").alias("order_count"))


@query("src_10", """SELECT n_nationkey::VARCHAR || '|' || n_name || '|' || n_regionkey AS _c0 FROM nation
  UNION ALL SELECT 'n_nationkey|n_name|n_regionkey'""")
def csv_naive(t):
    """Without options the header is data and nothing is split."""
    path = t.out("nation-csv")
    t.nation.coalesce(1).write.option("header", True).option("sep", "|").csv(path)
    return t.spark.sql(f"SELECT * FROM csv.`{path}`")


@query("src_11", "SELECT length(p_name)::BIGINT AS width, count(*) AS line_count FROM part GROUP BY 1")
def text_scan(t):
    path = t.out("part-text")
    t.part.select("p_name").write.text(path)
    lines = t.spark.sql(f"SELECT value FROM text.`{path}`")
    return lines.groupBy(F.length("value").alias("width")).agg(F.count("*").alias("line_count"))


@query("src_12", "SELECT sum(strlen(p_name) + 1)::BIGINT AS bytes, sum(strlen(p_name) + 1)::BIGINT AS content_bytes, true AS has_time FROM part")
def binary_scan(t):
    """Size, content and time of the files of a text table: its names, each with a line end."""
    path = t.out("part-lines")
    t.part.select("p_name").write.text(path)
    found = t.spark.read.format("binaryFile").load(path)
    return found.agg(
        F.sum("length").alias("bytes"), F.sum(F.octet_length("content")).alias("content_bytes"), F.bool_and(F.col("modificationTime").isNotNull()).alias("has_time")
    )


QUEUE_DDL = "key BINARY, offset BIGINT, partition INT, timestamp BIGINT, topic STRING, value BINARY"


def queue_dump(t: Tables) -> str:
    """Events as a message queue would dump them: binary key and JSON value."""
    path = t.out("queue")
    t.events.select(
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        F.col("event_id").alias("offset"),
        (F.col("event_id") % 2).cast("int").alias("partition"),
        F.unix_millis("ts").alias("timestamp"),
        F.lit("events").alias("topic"),
        F.encode(F.to_json(F.struct("user_id", "event_type", "value")), "UTF-8").alias("value"),
    ).write.json(path)
    return path


@query("src_13", """SELECT user_id::VARCHAR AS message_key, event_id AS message_offset, epoch_us(ts) // 1000 AS message_ms, event_type
  FROM events""")
def queue_scan(t):
    dump = t.spark.read.schema(QUEUE_DDL).json(queue_dump(t))
    return dump.select(
        F.col("key").cast("string").alias("message_key"), F.col("offset").alias("message_offset"),
        F.col("timestamp").alias("message_ms"),
        F.get_json_object(F.col("value").cast("string"), "$.event_type").alias("event_type"),
    )


@query("src_16", """SELECT c_mktsegment, v.label, count(*) AS customer_count FROM customer
  JOIN (VALUES ('BUILDING', 'b'), ('HOUSEHOLD', 'h'), ('MACHINERY', 'm')) AS v(segment, label)
  ON c_mktsegment = v.segment GROUP BY 1, 2""")
def literal_rows(t):
    view = workspace.fresh_name("labels")
    t.spark.sql(
        f"CREATE OR REPLACE TEMP VIEW {view} AS SELECT * FROM VALUES ('BUILDING', 'b'), ('HOUSEHOLD', 'h') AS v(segment, label)"
    )
    labels = t.spark.table(view).union(t.spark.createDataFrame([("MACHINERY", "m")], "segment string, label string"))
    return (
        t.customer.join(labels, F.col("c_mktsegment") == F.col("segment"))
        .groupBy("c_mktsegment", "label").agg(F.count("*").alias("customer_count"))
    )


@query("src_17", """SELECT r.id AS bucket, count(o_orderkey) AS order_count
  FROM (SELECT unnest(range(20)) AS id) r LEFT JOIN orders ON o_orderkey % 19 = r.id GROUP BY 1""")
def number_range(t):
    """Every bucket appears, also the last one, which has no orders; orders are counted before they meet it."""
    counted = t.orders.groupBy((F.col("o_orderkey") % 19).alias("id")).agg(F.count("o_orderkey").alias("order_count"))
    return t.spark.range(20).join(counted, "id", "left").na.fill(0).withColumnRenamed("id", "bucket")


@query("src_18", """SELECT 'orders.parquet' AS source_file, '2024-02-01 00:00:00.000000' AS ingested_at, count(*) AS row_count FROM orders""")
def source_columns(t):
    rows = files.with_source(t.orders.select("o_orderkey", "_metadata"), F.lit("2024-02-01").cast("timestamp"))
    return rows.groupBy(
        F.element_at(F.split("source_file", "/"), -1).alias("source_file"), "ingested_at"
    ).agg(F.count("*").alias("row_count"))


@query("src_19", "SELECT p_partkey, p_brand, NULL::VARCHAR AS p_origin FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, p_brand, 'x' || p_size FROM part WHERE p_partkey % 2 = 1")
def dimension_csv(t):
    """Dimension folder in which newer files have one more column."""
    path = t.out("dim")
    t.part.filter("p_partkey % 2 = 0").select("p_partkey", "p_brand").write.option("header", True).csv(f"{path}/old")
    t.part.filter("p_partkey % 2 = 1").selectExpr("p_partkey", "p_brand", "concat('x', p_size) AS p_origin").write.option("header", True).csv(f"{path}/new")
    shape = "p_partkey BIGINT, p_brand STRING"
    old = files.read_csv(t.spark, f"{path}/old", shape)
    new = files.read_csv(t.spark, f"{path}/new", shape + ", p_origin STRING")
    return new.unionByName(old, allowMissingColumns=True)


@query("src_20", """SELECT l_orderkey, l_quantity, CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' THEN l_tax END AS l_tax FROM lineitem""")
def parquet_merged_schema(t):
    path = t.out("drift")
    t.lineitem.filter("l_shipdate < '1998-01-01'").select("l_orderkey", "l_quantity").write.parquet(f"{path}/part=1")
    t.lineitem.filter("l_shipdate >= '1998-01-01'").select("l_orderkey", "l_quantity", "l_tax").write.parquet(f"{path}/part=2")
    return t.spark.read.option("mergeSchema", True).parquet(path).drop("part")


@query("src_21", "SELECT p_partkey::VARCHAR AS item_sku, p_type AS term_type, p_retailprice AS price_per_unit FROM part")
def preamble_csv(t):
    path = t.out("prices")
    listed = t.part.selectExpr("concat_ws(',', p_partkey, p_type, p_retailprice) AS value")
    head = t.spark.createDataFrame(
        [("FormatVersion: v1",), ("Disclaimer: sample",), ("Publication Date: 2024",), ("Version: 1",), ("Offer: parts",), ("Item SKU,Term Type,Price Per Unit",)],
        "value string",
    )
    head.union(listed).write.text(path)
    columns = [files.plain_name(c) for c in ("Item SKU", "Term Type", "Price Per Unit")]
    return files.read_preamble_csv(t.spark, path, columns, {"price_per_unit": "double"})


@query("src_22", "SELECT 'before' AS moment, count(*) AS row_count FROM nation UNION ALL SELECT 'after', 2 * count(*) FROM nation")
def refreshed_table(t):
    name, path = workspace.fresh_name("nation"), t.out("nation")
    t.nation.write.parquet(path)
    files.external_table(t.spark, name, path, "parquet", "", {})
    before = workspace.settle(t.spark.table(name).select(F.lit("before").alias("moment")).groupBy("moment").agg(F.count("*").alias("row_count")))
    t.nation.write.mode("append").parquet(path)
    t.spark.catalog.refreshTable(name)
    after = t.spark.table(name).select(F.lit("after").alias("moment")).groupBy("moment").agg(F.count("*").alias("row_count"))
    return before.unionByName(after)


@query("src_23", """SELECT * FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
  ('o_totalprice', 'double'), ('o_orderdate', 'timestamp'), ('o_orderpriority', 'string')) v(col_name, data_type)
  JOIN (UNPIVOT (SELECT count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey, count(o_orderstatus) AS o_orderstatus, count(o_totalprice) AS o_totalprice,
    count(o_orderdate) AS o_orderdate, count(o_orderpriority) AS o_orderpriority FROM orders) ON COLUMNS(*) INTO NAME col_name VALUE filled) f USING (col_name)""")
def source_metadata(t):
    """Described columns and how many rows fill each."""
    name = workspace.fresh_name("orders")
    files.external_table(t.spark, name, t.path("orders"), "parquet", "", {})
    described, orders = t.spark.sql(f"DESCRIBE {name}").select("col_name", "data_type"), t.spark.table(name)
    filled = orders.agg(*[F.count(c).alias(c) for c in orders.columns]).unpivot([], orders.columns, "col_name", "filled")
    return described.join(filled, "col_name")


@query("src_24", "SELECT c_custkey, c_acctbal FROM customer")
def path_scan(t):
    return t.spark.sql(f"SELECT c_custkey, c_acctbal FROM parquet.`{t.path('customer')}`")


@query("src_25", "SELECT event_type AS action, count(*) AS entries FROM events GROUP BY 1")
def json_log_scan(t):
    """Log of JSON entries in which each line has one of several shapes."""
    path = t.out("log")
    entry = F.when(F.col("event_type") == "error", F.to_json(F.struct(F.struct("event_id", "value").alias("error"))))
    for kind in ("click", "purchase", "signup", "view"):
        entry = entry.when(F.col("event_type") == kind, F.to_json(F.struct(F.struct("event_id").alias(kind))))
    t.events.select(entry.alias("value")).write.text(path)
    log = t.spark.read.json(path)
    action = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in sorted(log.columns)])
    return log.groupBy(action.alias("action")).agg(F.count("*").alias("entries"))
