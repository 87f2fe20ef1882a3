"""Views whose columns and rows depend on the reader's groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.operators.secure import secure_view


def both_roles(t, build):
    """The same view as a restricted reader and as an open reader sees it."""
    seen = [build(groups).withColumn("reader", F.lit(name)) for name, groups in (("restricted", {"analysts"}), ("open", {"admins"}))]
    return seen[0].unionByName(seen[1])


def readings(t):
    return t.events.select("user_id", F.concat(F.lit("name "), F.col("user_id").cast("string")).alias("name"), F.col("event_type").alias("device"), F.to_date("ts").alias("day"), "value")


@query("gov_01", """SELECT 'restricted' AS reader, 'REDACTED' AS name, strftime(ts, '%Y-%m-%d') AS day, round(avg(value), 4) AS mean_value FROM events GROUP BY user_id, day
  UNION ALL SELECT 'open', 'name ' || user_id, strftime(ts, '%Y-%m-%d') AS day, round(avg(value), 4) FROM events GROUP BY user_id, day""".replace("GROUP BY user_id, day", "GROUP BY user_id, strftime(ts, '%Y-%m-%d')"))
def redacted_columns(t):
    """Grouped by the real name: one redacted row per person and day remains."""
    daily = readings(t).groupBy("name", "day").agg(F.round(F.mean("value"), 4).alias("mean_value"))
    return both_roles(t, lambda groups: secure_view(daily, groups, "analysts", redacted=["name"]))


@query("gov_02", """SELECT 'restricted' AS reader, user_id, count(*) AS events FROM events WHERE user_id < 30 GROUP BY user_id
  UNION ALL SELECT 'open', user_id, count(*) FROM events GROUP BY user_id""")
def limited_rows(t):
    return both_roles(
        t, lambda groups: secure_view(readings(t), groups, "analysts", rows=F.col("user_id") < 30).groupBy("user_id").agg(F.count("*").alias("events"))
    )


@query("gov_03", """SELECT 'restricted' AS reader, repeat('*', length('name ' || user_id) - 2) || right('name ' || user_id, 2) AS name, event_type AS device, round(sum(value), 2) AS value FROM events WHERE user_id < 30 GROUP BY user_id, event_type
  UNION ALL SELECT 'open', 'name ' || user_id, event_type, round(sum(value), 2) FROM events GROUP BY user_id, event_type""")
def masked_and_limited(t):
    summed = readings(t).groupBy("user_id", "name", "device").agg(F.round(F.sum("value"), 2).alias("value"))
    return both_roles(t, lambda groups: secure_view(summed, groups, "analysts", masked=["name"], rows=F.col("user_id") < 30).drop("user_id"))
