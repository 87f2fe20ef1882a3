"""Streams over files landed from the given tables; each result equals its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.registry import Tables, query
from millrace.operators import quality as Q
from millrace.streaming import cdc, ingest, joins, refresh

EVENT_SHAPE = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, us BIGINT"
EVENT_SQL = "SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us FROM events"


def feed(t: Tables):
    return t.events.select("event_id", "user_id", "event_type", "value", F.unix_micros("ts").alias("us"))


def landed(t: Tables, kind: str = "json") -> str:
    """Folder of event files, as a collector would leave them."""
    path = t.out(f"landed-{kind}")
    feed(t).write.format(kind).option("header", True).save(path)
    return path


def streamed(t: Tables, rows):
    out = t.out("stream")
    ingest.append(rows, f"{out}/data", f"{out}/checkpoint")
    return t.spark.read.parquet(f"{out}/data")


@query("stm_01", EVENT_SQL)
def inferred_ingest(t):
    path = landed(t)
    shape = ingest.hinted_schema(t.spark, path, "json", {})
    return streamed(t, ingest.stream_files(t.spark, path, shape))


@query("stm_02", "SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type, value::VARCHAR AS value, epoch_us(ts)::VARCHAR AS us FROM events")
def text_ingest(t):
    path = landed(t)
    return streamed(t, ingest.stream_files(t.spark, path, ingest.all_text(feed(t).schema)))


@query("stm_03", "SELECT event_id, user_id::DOUBLE AS user_id, event_type, value, epoch_us(ts)::DOUBLE AS us FROM events")
def hinted_ingest(t):
    path = landed(t)
    shape = ingest.hinted_schema(t.spark, path, "json", {"us": "double", "user_id": "double"})
    return streamed(t, ingest.stream_files(t.spark, path, shape))


@query("stm_04", EVENT_SQL)
def csv_ingest(t):
    return streamed(t, ingest.stream_files(t.spark, landed(t, "csv"), EVENT_SHAPE, "csv", header="true"))


@query("stm_05", """SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-16' AND event_type <> 'error' THEN value END AS value,
  CASE WHEN ts >= TIMESTAMP '2024-01-16' AND event_type = 'error' THEN '{"value":"n/a"}' END AS _rescued_data FROM events""")
def rescued_ingest(t):
    """A column that the second delivery brings is gained; values that do not fit its type are kept as JSON text."""
    path, out = t.out("landed"), t.out("ingested")
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp")
    first = F.to_json(F.struct("event_id", "event_type"))
    second = F.when(F.col("event_type") == "error", F.to_json(F.struct("event_id", "event_type", F.lit("n/a").alias("value")))).otherwise(
        F.to_json(F.struct("event_id", "event_type", "value")))
    for part, entry in ((~late, first), (late, second)):
        t.events.filter(part).select(entry.alias("value")).write.mode("append").text(path)
        rows = ingest.ingest_json(t.spark, path, out, hints={"value": "double"})
    return rows


@query("stm_06", "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at FROM events")
def silver_append(t):
    rows = ingest.stream_files(t.spark, landed(t), EVENT_SHAPE)
    stamped = rows.select("*", F.col("_metadata.file_path").alias("source_file"))
    return streamed(t, stamped.select("*", F.timestamp_micros("us").alias("at")).drop("us", "source_file"))


def rules():
    typed = F.nullif("event_type", F.lit("view"))
    return {"positive": F.col("value") > 1, "not_error": typed != "error"}


@query("stm_07", "SELECT event_id, value > 1 AS positive, coalesce(nullif(event_type, 'view') <> 'error', false) AS not_error FROM events")
def expectation_warn(t):
    """All rows stay; a null condition counts as failed."""
    rows = ingest.stream_files(t.spark, landed(t), EVENT_SHAPE)
    return streamed(t, Q.expect(rows, rules())).select("event_id", "positive", "not_error")


@query("stm_08", "SELECT event_id, event_type, value FROM events WHERE value > 1 AND nullif(event_type, 'view') <> 'error'")
def expectation_drop(t):
    rows = ingest.stream_files(t.spark, landed(t), EVENT_SHAPE)
    return streamed(t, Q.expect_or_drop(rows, rules())).select("event_id", "event_type", "value")


@query("stm_09", "SELECT event_id, value FROM events")
def expectation_fail(t):
    """No row breaks the rule here; one that did would stop the stream."""
    rows = ingest.stream_files(t.spark, landed(t), EVENT_SHAPE)
    return streamed(t, Q.expect_or_fail(rows, {"known_time": F.col("us") > 0})).select("event_id", "value")


CDC_SQL = """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1 AND event_type <> 'error'"""


def applied(t: Tables, first, second):
    """Land and apply two deliveries of changes one after the other."""
    path, state, checkpoint = t.out("changes"), t.out("state"), t.out("checkpoint")
    for delivery in (first, second):
        feed(t).filter(delivery).write.mode("append").json(path)
        cdc.apply_changes(ingest.stream_files(t.spark, path, EVENT_SHAPE), ["user_id"], ["us", "event_id"], state, checkpoint)
    rows = cdc.visible(cdc.read_state(t.spark, state), ["user_id"], ["us", "event_id"], F.col("event_type") == "error", ["us"])
    return rows.select("user_id", "event_id", "event_type", "value")


@query("stm_11", CDC_SQL)
def change_capture(t):
    middle = F.unix_micros(F.lit("2024-01-16").cast("timestamp"))
    return applied(t, F.col("us") < middle, F.col("us") >= middle)


@query("stm_12", CDC_SQL)
def late_changes(t):
    """The newer half is delivered first; older changes must not win or revive a deleted key."""
    middle = F.unix_micros(F.lit("2024-01-16").cast("timestamp"))
    return applied(t, F.col("us") >= middle, F.col("us") < middle)


@query("jon_17", """SELECT event_id, e.user_id, c_name, c_mktsegment FROM events e LEFT JOIN customer ON e.user_id = c_custkey""")
def stream_static_join(t):
    known = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    rows = ingest.stream_files(t.spark, landed(t), EVENT_SHAPE)
    return streamed(t, rows.join(known, "user_id", "left").select("event_id", "user_id", "c_name", "c_mktsegment"))


LINE_SHAPE = "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE, shipped TIMESTAMP"
ORDER_SHAPE = "o_orderkey BIGINT, o_custkey BIGINT, ordered TIMESTAMP"
#: Lines and orders arrive in four deliveries by time, the longest of 731 days; a line ships up to 120 days after its order.
BATCH_ENDS = ("1997-01-01", "1999-01-01", "2000-07-01", "2100-01-01")
SHIPPING = joins.Range(before="1 day", after="120 days", delay="731 days")
SHIPPED_SQL = "lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate - INTERVAL 1 DAY AND l_shipdate <= o_orderdate + INTERVAL 120 DAY"


def shipped_orders(t: Tables):
    """Both streams run after each delivery into one table; rows past the range and the delay have left the state by then."""
    orders, lines, out = t.out("orders"), t.out("lines"), t.out("shipped")
    first = "1900-01-01"
    for end in BATCH_ENDS:
        span = lambda c: (F.col(c) >= F.lit(first).cast("timestamp")) & (F.col(c) < F.lit(end).cast("timestamp"))  # noqa: B023, E731
        ordered = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("ordered"))
        shipped = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", F.col("l_shipdate").alias("shipped"))
        ordered.filter(span("ordered")).write.mode("append").parquet(orders)
        shipped.filter(span("shipped")).write.mode("append").parquet(lines)
        left, right = ingest.stream_files(t.spark, lines, LINE_SHAPE, "parquet"), ingest.stream_files(t.spark, orders, ORDER_SHAPE, "parquet")
        joined = joins.join_in_range(left, right, [("l_orderkey", "o_orderkey")], "shipped", "ordered", SHIPPING)
        ingest.append(joined.select("l_orderkey", "o_custkey", "l_partkey", "l_quantity"), f"{out}/data", f"{out}/checkpoint")
        first = end
    return t.spark.read.parquet(f"{out}/data")


@query("jon_18", f"SELECT l_orderkey, o_custkey, l_partkey, l_quantity FROM {SHIPPED_SQL}")
def stream_stream_join(t):
    """Lines shipped up to 120 days after their order: watermarks and a range much shorter than the seven years of data."""
    return shipped_orders(t)


@query("stm_13", """SELECT c_mktsegment, count(*) AS events, round(sum(value), 2) AS value FROM events JOIN customer ON user_id = c_custkey GROUP BY 1""")
def enriched_stream(t):
    known = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    rows = ingest.stream_files(t.spark, landed(t), EVENT_SHAPE)
    joined = streamed(t, rows.join(known, "user_id").select("event_id", "c_mktsegment", "value"))
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("events"), F.round(F.sum("value"), 2).alias("value"))


@query("stm_14", f"SELECT o_custkey, count(*) AS lines, sum(l_quantity) AS quantity FROM {SHIPPED_SQL} GROUP BY 1")
def joined_streams(t):
    """Totals over the joined streams; the state of the join is bounded by its range and delay."""
    return shipped_orders(t).groupBy("o_custkey").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))


#: Events arrive in three deliveries by time. Files of one are read in any order, so the watermark waits for as long as one lasts.
DELIVERIES, DELAY = ("2024-01-11", "2024-01-21"), "11 days"


def windowed_means(t: Tables, width: str, name: str, label):
    """Mean value per user and window, the stream run after each delivery."""
    path, out, us = t.out("deliveries"), t.out("windows"), F.col("us")
    first, second = (F.unix_micros(F.lit(d).cast("timestamp")) for d in DELIVERIES)
    for part in (us < first, (us >= first) & (us < second), us >= second):
        feed(t).filter(part).write.mode("append").json(path)
        rows = ingest.stream_files(t.spark, path, EVENT_SHAPE).withColumn("at", F.timestamp_micros("us"))
        mean = ingest.watermarked(rows, "at", DELAY).groupBy("user_id", F.window("at", width).alias("w")).agg(F.avg("value").alias("mean_value"))
        shown = mean.select("user_id", label.alias(name), F.round("mean_value", 4).alias("mean_value"))
        ingest.aggregate_updates(shown, ["user_id", name], f"{out}/data", f"{out}/checkpoint")
    return ingest.newest_windows(t.spark, f"{out}/data", ["user_id", name])


@query("stm_15", "SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, round(avg(value), 4) AS mean_value FROM events GROUP BY 1, 2")
def streaming_aggregate(t):
    """Daily means; a day is dropped from state once it is past the watermark."""
    return windowed_means(t, "1 day", "day", F.col("w.start").cast("date"))


def landing(t: Tables) -> str:
    """Orders, their status and a customer change feed as JSON files."""
    path = t.out("landing")
    t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderkey") % 3 == 0, "Y").otherwise("N").alias("notifications"), F.unix_seconds("o_orderdate").alias("order_timestamp"),
    ).write.json(f"{path}/orders")
    t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 10 != 0, F.unix_seconds("o_orderdate") + 86400).alias("status_timestamp"),
    ).write.json(f"{path}/status")
    email = F.when(F.col("c_custkey") % 8 == 0, "broken").otherwise(F.concat(F.lower("c_name"), F.lit("@mail.com")))
    new = t.customer.select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("name"), email.alias("email"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("state"), F.lit("NEW").alias("operation"), F.lit("100").alias("timestamp"),
    )
    moved = new.filter("cast(customer_id AS bigint) % 4 = 1").withColumns({"state": F.lit("MOVED"), "operation": F.lit("UPDATE"), "timestamp": F.lit("200")})
    gone = new.filter("cast(customer_id AS bigint) % 9 = 2").select(
        "customer_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("state"), F.lit("DELETE").alias("operation"), F.lit("300").alias("timestamp"),
    )
    new.unionByName(moved).unionByName(gone).write.json(f"{path}/customers")
    return path


PEOPLE_SQL = """people AS (SELECT c_custkey, c_name AS name, lower(c_name) || '@mail.com' AS email, CASE WHEN c_custkey % 4 = 1 THEN 'MOVED' ELSE 'S' || c_nationkey END AS state
  FROM customer WHERE c_custkey % 9 <> 2 AND c_custkey % 8 <> 0)"""


@query("stm_16", f"WITH {PEOPLE_SQL} " + """SELECT 'orders' AS result, strftime(o_orderdate, '%Y-%m-%d') AS key, count(*) AS total FROM orders GROUP BY 2
  UNION ALL SELECT 'customers', state, count(*) FROM people GROUP BY 2""")
def gold_tables(t):
    gold = refresh.run(t.spark, landing(t), t.out("refresh"), "2024-02-01")
    by_date = gold["orders_by_date"].select(F.lit("orders").alias("result"), F.date_format("order_date", "yyyy-MM-dd").alias("key"), F.col("total_daily_orders").alias("total"))
    by_state = gold["customers_by_state"].select(F.lit("customers").alias("result"), F.col("state").alias("key"), F.col("customer_count").alias("total"))
    return by_date.unionByName(by_state)


# valid mails: not of every eighth customer; the feed has all customers, a fourth again as moved, a ninth as gone
FEED_SQL = """changes AS (SELECT c_custkey AS k, 'NEW' AS op FROM customer UNION ALL SELECT c_custkey, 'UPDATE' FROM customer WHERE c_custkey % 4 = 1
  UNION ALL SELECT c_custkey, 'DELETE' FROM customer WHERE c_custkey % 9 = 2)"""


@query("stm_10", f"""WITH {FEED_SQL} SELECT 'orders' AS dataset, 'valid_date' AS name, count(*) AS passed_records, 0::BIGINT AS failed_records FROM orders
  UNION ALL SELECT 'status', 'valid_timestamp', count(*) FILTER (o_orderkey % 10 <> 0), count(*) FILTER (o_orderkey % 10 = 0) FROM orders
  UNION ALL SELECT 'customers', unnest(['valid_id', 'valid_operation', 'valid_name', 'valid_address']), count(*), 0 FROM changes
  UNION ALL SELECT 'customers', 'valid_email', count(*) FILTER (op = 'DELETE' OR k % 8 <> 0), count(*) FILTER (op <> 'DELETE' AND k % 8 = 0) FROM changes""")
def expectation_metrics(t):
    """Counts of all rules of a whole refresh, observed by its streams and read from the events of the update."""
    out = t.out("refresh")
    refresh.run(t.spark, landing(t), out, "2024-02-01", update="u1")
    return refresh.expectation_counts(t.spark, out, "u1")


@query("stm_17", f"WITH {PEOPLE_SQL} " + """SELECT c_custkey::VARCHAR AS customer_id, o_orderkey AS order_id, name, email, o_orderstatus AS status FROM orders JOIN people ON o_custkey = c_custkey
  WHERE o_orderkey % 3 = 0 AND o_orderkey % 10 <> 0""")
def gold_join(t):
    gold = refresh.run(t.spark, landing(t), t.out("refresh"), "2024-02-01")
    return gold["order_updates"].select("customer_id", "order_id", "name", "email", "status")


@query("stm_18", """SELECT user_id, strftime(make_timestamp((epoch_us(ts) // 180000000 + 1) * 180000000), '%Y-%m-%d %H:%M:%S.%f') AS window_end, round(avg(value), 4) AS mean_value
  FROM events GROUP BY 1, 2""")
def tumbling_window(t):
    """Three-minute means; a window is dropped from state once it is past the watermark."""
    return windowed_means(t, "3 minutes", "window_end", F.col("w.end"))


@query("stm_19", "SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us FROM events")
def replayed(t):
    """The files of the written table as a stream: Spark forms the micro-batches, of two files each."""
    table, out = t.out("events"), t.out("stream")
    feed(t).repartition(6).write.parquet(table)
    files = ingest.stream_files(t.spark, table, EVENT_SHAPE, "parquet", files_per_batch=2)
    ingest.append(files, f"{out}/data", f"{out}/checkpoint")
    return t.spark.read.parquet(f"{out}/data")
