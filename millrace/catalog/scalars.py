"""Scalar, nested-data, JSON and user-defined functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import workspace
from millrace.catalog import standins as S
from millrace.catalog.registry import query
from millrace.functions import columns as C
from millrace.functions import udfs

EVENTS = S.with_sql(S.SHOP_EVENTS_SQL)
ITEMS = S.with_sql(S.SHOP_ITEMS_SQL)
USERS = S.with_sql(S.SHOP_USERS_SQL)
USAGE = S.with_sql(S.USAGE_SQL)

# ------------------------------------------------------------------------ text


@query("str_01", "SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[-1] AS last_word, p_brand[7:] AS brand_no FROM part")
def split_text(t):
    words = F.split("p_name", " ")
    return t.part.select(
        "p_partkey", words[0].alias("first_word"), F.element_at(words, -1).alias("last_word"),
        F.element_at(F.split("p_brand", "#", 2), 2).alias("brand_no"),
    )


@query("str_02", "SELECT c_custkey, split_part(c_name, '#', 1) AS head, split_part(c_name, '#', -1) AS tail, split_part(c_name, '#', 5) AS missing FROM customer")
def split_parts(t):
    part = lambda n: F.split_part("c_name", F.lit("#"), F.lit(n))
    return t.customer.select("c_custkey", part(1).alias("head"), part(-1).alias("tail"), part(5).alias("missing"))


@query("str_03", "SELECT c_custkey, substring(c_name, 11, length(c_name) - 10) AS tail FROM customer")
def substring_to_end(t):
    return t.customer.select("c_custkey", F.substring("c_name", F.lit(11), F.length("c_name") - 10).alias("tail"))


@query("str_04", """SELECT p_partkey, upper(trim(x)) AS both, lower(ltrim(x)) AS head, rtrim(x) AS tail
  FROM (SELECT p_partkey, '  ' || p_name || ' ' AS x FROM part)""")
def case_and_trim(t):
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    return t.part.select("p_partkey", C.tidy(padded).alias("both"), F.lower(F.ltrim(padded)).alias("head"), F.rtrim(padded).alias("tail"))


@query("str_05", "SELECT p_partkey, replace(replace(p_name, 'small', 'tiny'), 'ring', 'loop') AS renamed, upper(replace(p_name, ' ', '')) AS squeezed FROM part")
def replaced_text(t):
    renamed = F.replace(F.replace("p_name", F.lit("small"), F.lit("tiny")), F.lit("ring"), F.lit("loop"))
    return t.part.select("p_partkey", renamed.alias("renamed"), C.squeezed("p_name").alias("squeezed"))


@query("str_06", EVENTS + "SELECT event_id, device || '/' || CASE WHEN revenue IS NOT NULL THEN city END AS place FROM shop_events")
def concat_with_null(t):
    events = S.shop_events(t)
    city = F.when(F.col("ecommerce.purchase_revenue_in_usd").isNotNull(), F.col("geo.city"))
    return events.select("event_id", F.concat("device", F.lit("/"), city).alias("place"))


@query("str_07", "SELECT o_orderkey, lpad(month(o_orderdate)::VARCHAR, 2, '0') AS month, lpad(o_orderkey::VARCHAR, 3, '0') AS cut FROM orders")
def left_padded(t):
    return t.orders.select(
        "o_orderkey", F.lpad(F.month("o_orderdate").cast("string"), 2, "0").alias("month"),
        F.lpad(F.col("o_orderkey").cast("string"), 3, "0").alias("cut"),
    )


@query("str_08", USERS + "SELECT user_id, regexp_extract(email, '@(.+)$', 1) AS domain FROM shop_users WHERE email IS NOT NULL")
def extracted_domain(t):
    return S.shop_users(t).filter("email IS NOT NULL").select("user_id", F.regexp_extract("email", "(?<=@).+", 0).alias("domain"))


@query("str_09", "SELECT c_custkey, regexp_replace(c_name, '[0-9]+', 'N', 'g') AS no_digits, translate(c_name, 'abc', 'xy') AS swapped FROM customer")
def regexp_and_translate(t):
    return t.customer.select("c_custkey", F.regexp_replace("c_name", "[0-9]+", "N").alias("no_digits"), F.translate("c_name", "abc", "xy").alias("swapped"))


@query("str_10", "SELECT s_suppkey, repeat('*', length(s_name) - 2) || right(s_name, 2) AS masked FROM supplier")
def masked_text(t):
    from millrace.operators.secure import mask_tail

    return t.supplier.select("s_suppkey", mask_tail(F.col("s_name")).alias("masked"))


@query("str_11", USAGE + """SELECT record_id, CASE WHEN entity_id LIKE 'job/%' OR entity_id LIKE 'warehouse/%' OR entity_id LIKE 'flow/%'
    OR entity_id LIKE 'vector/%' OR entity_id LIKE 'model/%' OR entity_id LIKE 'cluster/%' THEN 'https://' || workspace_id || '.example.com/' || entity_id || '?o=' || workspace_id
  WHEN entity_id LIKE 'notebook/%' THEN 'https://' || workspace_id || '.example.com/?o=' || workspace_id || '#' || entity_id
  ELSE 'https://' || workspace_id || '.example.com/cluster/' || entity_id || '?o=' || workspace_id END AS link FROM usage""")
def link_by_prefix(t):
    from millrace.plans import usage as U

    return S.usage(t).select("record_id", U.entity_link(U.entity_id(), F.col("workspace_id"), F.col("workspace_id")).alias("link"))


# ----------------------------------------------------------------------- dates


@query("dtm_01", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS whole FROM events")
def micros_to_time(t):
    """Exact from the integer; dividing by 1e6 first is good to the second."""
    micros = t.events.select("event_id", F.unix_micros("ts").alias("us"))
    return micros.select(
        "event_id", F.timestamp_micros("us").alias("at"),
        F.date_format((F.col("us") / 1e6).cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("whole"),
    )


@query("dtm_02", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS at FROM events""")
def seconds_to_time(t):
    seconds = t.events.select("event_id", F.unix_seconds("ts").alias("s"))
    return seconds.select("event_id", F.from_unixtime("s").cast("date").alias("day"), F.timestamp_seconds("s").alias("at"))


@query("dtm_03", "SELECT event_id, strftime(ts, '%b %d, %Y') AS day, strftime(ts, '%H:%M:%S') AS time FROM events")
def formatted(t):
    return t.events.select("event_id", F.date_format("ts", "MMM dd, yyyy").alias("day"), F.date_format("ts", "HH:mm:ss").alias("time"))


@query("dtm_04", """SELECT event_id, year(ts)::BIGINT AS year, month(ts)::BIGINT AS month, (dayofweek(ts) + 1)::BIGINT AS weekday, minute(ts)::BIGINT AS minute, second(ts)::BIGINT AS second FROM events""")
def date_parts(t):
    return t.events.select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofweek("ts").alias("weekday"),
        F.minute("ts").alias("minute"), F.second("ts").alias("second"),
    )


@query("dtm_05", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS a, strftime(ts, '%Y-%m-%d') AS b, strftime(ts, '%Y-%m-%d') AS c FROM events")
def to_dates(t):
    return t.events.select("event_id", F.to_date("ts").alias("a"), F.expr("date(ts)").alias("b"), F.col("ts").cast("date").alias("c"))


@query("dtm_06", """SELECT o_orderkey, strftime(o_orderdate::DATE + 2, '%Y-%m-%d') AS plus_days, strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS plus_month,
  strftime(o_orderdate - INTERVAL 3 MONTH, '%Y-%m-%d') AS minus_months FROM orders""")
def date_arithmetic(t):
    return t.orders.select(
        "o_orderkey", F.date_add("o_orderdate", 2).alias("plus_days"),
        F.expr("dateadd(MONTH, 1, o_orderdate)").cast("date").alias("plus_month"), F.add_months("o_orderdate", -3).alias("minus_months"),
    )


@query("dtm_07", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-01') AS first_text, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS first_day FROM orders")
def month_starts(t):
    return t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-01").alias("first_text"), C.month_start("o_orderdate").alias("first_day")
    )


@query("dtm_08", "SELECT event_id, strftime(date_trunc('month', ts), '%Y-%m-%d %H:%M:%S.%f') AS month, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') AS day FROM events")
def truncated_times(t):
    return t.events.select("event_id", F.date_trunc("month", "ts").alias("month"), F.date_trunc("day", "ts").alias("day"))


@query("dtm_09", "SELECT o_orderkey, day(last_day(o_orderdate))::BIGINT * 24 AS hours FROM orders")
def month_hours(t):
    return t.orders.select("o_orderkey", C.hours_of_month("o_orderdate").alias("hours"))


@query("dtm_10", "SELECT o_orderkey, year(o_orderdate)::BIGINT * 100 + month(o_orderdate) AS month_number FROM orders")
def month_numbers(t):
    return t.orders.select("o_orderkey", C.month_number(F.year("o_orderdate"), F.month("o_orderdate")).alias("month_number"))


@query("dtm_11", "SELECT event_id, CASE WHEN day(ts) > 21 THEN 21 ELSE day(ts) END::BIGINT AS batch FROM events")
def batch_numbers(t):
    return t.events.select("event_id", C.batch_number("ts", 21).alias("batch"))


@query("dtm_12", """SELECT event_id, epoch_us(date_trunc('second', ts)) // 1000000 AS seconds, strftime(ts, '%Y-%m-%d %H:%M:%S') AS back, true AS clock_set FROM events""")
def unix_times(t):
    seconds = F.unix_timestamp("ts")
    return t.events.select(
        "event_id", seconds.alias("seconds"), F.from_unixtime(seconds).alias("back"), F.current_timestamp().isNotNull().alias("clock_set")
    )


# ------------------------------------------------------------------------ math


@query("mth_01", "SELECT l_orderkey, l_partkey, trunc(l_extendedprice / 7 * 100) / 100 AS cut FROM lineitem")
def cut_off(t):
    return t.lineitem.select("l_orderkey", "l_partkey", C.truncated(F.col("l_extendedprice") / 7, 2).alias("cut"))


@query("mth_02", "SELECT l_orderkey, l_partkey, round(l_extendedprice / 7, 2) AS cents, round(l_extendedprice / 7, 0) AS whole FROM lineitem")
def rounded(t):
    seventh = F.col("l_extendedprice") / 7
    return t.lineitem.select("l_orderkey", "l_partkey", F.round(seventh, 2).alias("cents"), F.round(seventh, 0).alias("whole"))


@query("mth_03", "SELECT p_partkey, round(sqrt(p_size), 9) AS root, round(cos(p_size), 9) AS cosine FROM part")
def roots(t):
    return t.part.select("p_partkey", F.round(F.sqrt("p_size"), 9).alias("root"), F.round(F.cos("p_size"), 9).alias("cosine"))


@query("mth_04", "SELECT p_partkey, ceil(p_retailprice)::BIGINT AS up, round(ln(p_retailprice), 9) AS log FROM part")
def ceilings(t):
    return t.part.select("p_partkey", F.ceil("p_retailprice").alias("up"), F.round(F.log("p_retailprice"), 9).alias("log"))


@query("mth_05", "SELECT count(*) AS row_count, true AS in_range, true AS spread FROM lineitem")
def random_values(t):
    """Random values differ from run to run; only what is always true is returned."""
    drawn = t.lineitem.select(F.rand(42).alias("x"))
    return drawn.agg(
        F.count("*").alias("row_count"), (F.min("x") >= 0).__and__(F.max("x") < 1).alias("in_range"),
        F.avg("x").between(0.4, 0.6).alias("spread"),
    )


# --------------------------------------------------------- arrays, maps, JSON


@query("arr_01", ITEMS + "SELECT event_id, item_id, quantity FROM shop_items")
def exploded(t):
    items = S.shop_events(t).select("event_id", F.explode("items").alias("item"))
    return items.select("event_id", "item.item_id", "item.quantity")


@query("arr_02", ITEMS + "SELECT event_id, count(*) AS items FROM shop_items GROUP BY 1 HAVING count(*) > 1")
def sized(t):
    return S.shop_events(t).filter(F.size("items") > 1).select("event_id", F.size("items").alias("items"))


@query("arr_03", ITEMS + """SELECT event_id, max(CASE WHEN quantity = 1 THEN item_id END) AS first_item, bool_or(item_id = 'P_3-xl') AS has_item FROM shop_items GROUP BY 1""")
def array_access(t):
    events = S.shop_events(t).filter(F.size("items") > 0)
    return events.select(
        "event_id", F.element_at("items", 1)["item_id"].alias("first_item"), F.array_contains("items.item_id", "P_3-xl").alias("has_item")
    )


@query("arr_04", ITEMS + """SELECT event_id, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS distinct_ids FROM shop_items GROUP BY 1""")
def distinct_flat(t):
    """Two arrays of ids put together and reduced to distinct values."""
    events = S.shop_events(t).filter(F.size("items") > 0)
    both = F.array(F.col("items.item_id"), F.reverse("items.item_id"))
    return events.select("event_id", F.array_join(F.array_sort(F.array_distinct(F.flatten(both))), ",").alias("distinct_ids"))


@query("arr_05", ITEMS + """SELECT event_id, string_agg(item_id, ',' ORDER BY quantity) AS large_items FROM shop_items WHERE item_id LIKE '%-xl' GROUP BY 1""")
def array_filter(t):
    large = F.filter("items", lambda i: i.item_id.like("%-xl"))
    return S.shop_events(t).select("event_id", F.array_join(F.transform(large, lambda i: i.item_id), ",").alias("large_items")).filter("large_items <> ''")


@query("arr_06", ITEMS + """SELECT event_id, string_agg(floor(price_in_usd * 10)::BIGINT::VARCHAR, ',' ORDER BY quantity) AS tenths FROM shop_items GROUP BY 1""")
def array_transform(t):
    tenths = F.transform("items", lambda i: F.floor(i.price_in_usd * 10).cast("string"))
    return S.shop_events(t).filter(F.size("items") > 0).select("event_id", F.array_join(tenths, ",").alias("tenths"))


@query("arr_07", ITEMS + """SELECT e.event_id, coalesce(m, false) AS has_large, coalesce(c, false) AS has_coupon FROM shop_events e LEFT JOIN
  (SELECT event_id, bool_or(item_id LIKE '%-xl') AS m, bool_or(coupon IS NOT NULL) AS c FROM shop_items GROUP BY 1) i ON e.event_id = i.event_id""")
def array_exists(t):
    return S.shop_events(t).select(
        "event_id", F.exists("items", lambda i: i.item_id.like("%-xl")).alias("has_large"),
        F.exists("items", lambda i: i.coupon.isNotNull()).alias("has_coupon"),
    )


@query("arr_08", ITEMS + """SELECT event_id, string_agg(item_id, ',' ORDER BY quantity) AS ids FROM shop_items GROUP BY 1""")
def field_of_array(t):
    return S.shop_events(t).filter(F.size("items") > 0).select("event_id", F.array_join(F.col("items.item_id"), ",").alias("ids"))


@query("map_01", USAGE + "SELECT record_id, tag_group, tag_agency, model, NULL::VARCHAR AS absent FROM usage")
def map_lookup(t):
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    return S.usage(t).select(
        "record_id", tag("group").alias("tag_group"), F.col("tags")["agency"].alias("tag_agency"), tag("endpoint").alias("model"),
        tag("nothing").alias("absent"),
    )


@query("jsn_01", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS missing FROM events")
def json_path(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.none").alias("missing"))


@query("jsn_02", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_struct(t):
    return t.events.select("event_id", F.from_json("props", "k BIGINT").alias("json")).select("event_id", "json.*")


@query("jsn_03", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_described(t):
    """Schema taken from one example text, then used for every row."""
    shape = F.schema_of_json(F.lit('{"k": 1}'))
    return t.events.select("event_id", F.from_json("props", shape).alias("json")).select("event_id", "json.k")


@query("jsn_04", """SELECT event_type, name, sum(passed)::BIGINT AS passed, sum(failed)::BIGINT AS failed FROM (
  SELECT event_type, 'positive' AS name, (value > 0)::INT AS passed, (value <= 0)::INT AS failed FROM events
  UNION ALL SELECT event_type, 'small', (value < 50)::INT, (value >= 50)::INT FROM events) GROUP BY 1, 2""")
def json_array_exploded(t):
    """Metrics written to a log as a JSON array, read back and exploded."""
    entry = lambda name, ok: F.struct(
        F.lit(name).alias("name"), ok.cast("int").alias("passed"), (~ok).cast("int").alias("failed")
    )
    log = t.events.select("event_type", F.to_json(F.array(entry("positive", F.col("value") > 0), entry("small", F.col("value") < 50))).alias("details"))
    metric = F.explode(F.from_json("details", "array<struct<name string, passed int, failed int>>"))
    rows = log.select("event_type", metric.alias("m"))
    return rows.groupBy("event_type", "m.name").agg(F.sum("m.passed").alias("passed"), F.sum("m.failed").alias("failed"))


@query("bin_01", "SELECT s_suppkey, s_name AS name, length(s_name)::BIGINT AS bytes FROM supplier")
def binary_to_text(t):
    packed = t.supplier.select("s_suppkey", F.col("s_name").cast("binary").alias("packed"))
    return packed.select("s_suppkey", F.col("packed").cast("string").alias("name"), F.octet_length("packed").alias("bytes"))


@query("nul_01", """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'F'), 'done') AS status, nullif(o_orderpriority, '5-LOW') AS urgent,
  ifnull(nullif(o_custkey % 2, 0), -1) AS parity FROM orders""")
def null_functions(t):
    return t.orders.select(
        "o_orderkey", F.coalesce(F.nullif("o_orderstatus", F.lit("F")), F.lit("done")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("urgent"),
        F.ifnull(F.nullif(F.col("o_custkey") % 2, F.lit(0)), F.lit(-1)).alias("parity"),
    )


# ------------------------------------------------------------------- functions


def _view(df):
    name = workspace.fresh_name("view")
    df.createOrReplaceTempView(name)
    return name


@query("udf_01", "SELECT p_partkey, upper(p_name) || ': ' || round(p_retailprice * 1.19, 0)::VARCHAR || ' with tax' AS tag FROM part")
def sql_function(t):
    udfs.register(t.spark)
    return t.spark.sql(f"SELECT p_partkey, mr_price_tag(p_name, p_retailprice) AS tag FROM {_view(t.part)}")


@query("udf_02", """SELECT p_partkey, CASE WHEN p_name LIKE '%ring' THEN 'jewellery' WHEN p_size > 40 THEN 'bulky ' || p_name ELSE 'small ' || p_name END AS note FROM part""")
def sql_function_case(t):
    udfs.register(t.spark)
    return t.spark.sql(f"SELECT p_partkey, mr_size_note(p_name, p_size) AS note FROM {_view(t.part)}")


FIRST_SQL = "SELECT c_custkey, c_mktsegment[1] AS letter FROM customer"


@query("udf_03", FIRST_SQL)
def python_function(t):
    return t.customer.select("c_custkey", udfs.first_letter_udf("c_mktsegment").alias("letter"))


@query("udf_04", FIRST_SQL)
def python_function_typed(t):
    return t.customer.select("c_custkey", udfs.first_letter_typed("c_mktsegment").alias("letter"))


@query("udf_05", "SELECT o_orderkey, o_orderpriority[1] AS letter FROM orders")
def batch_function(t):
    return t.orders.select("o_orderkey", udfs.first_letter_batch("o_orderpriority").alias("letter"))


@query("udf_06", FIRST_SQL)
def function_from_sql(t):
    udfs.register(t.spark)
    return t.spark.sql(f"SELECT c_custkey, mr_first_letter_batch(c_mktsegment) AS letter FROM {_view(t.customer)}")


@query("udf_07", "SELECT c_custkey, repeat('*', length(c_name) - 2) || right(c_name, 2) AS masked FROM customer")
def mask_function(t):
    udfs.register(t.spark)
    return t.spark.sql(f"SELECT c_custkey, mr_mask(c_name) AS masked FROM {_view(t.customer)}")


@query("udf_08", "SELECT count(*) AS parts, true AS described FROM part")
def function_description(t):
    """The description of a function beside the rows it is meant for."""
    udfs.register(t.spark)
    text = " ".join(row[0] for row in t.spark.sql("DESCRIBE FUNCTION EXTENDED mr_price_tag").collect())
    return t.part.agg(F.count("*").alias("parts"), F.lit("Name of an item" in text).alias("described"))
