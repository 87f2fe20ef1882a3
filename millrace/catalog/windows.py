"""Window operators; hot keys never reach a single task whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import standins as S
from millrace.catalog.registry import query
from millrace.operators import newest, running
from millrace.functions.columns import month_start


@query("win_01", """SELECT user_id, event_id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_row(t):
    events = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    return newest.latest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


MONTHLY_SQL = """monthly AS (SELECT l_suppkey, l_returnflag, CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS BIGINT) AS month,
  sum(l_quantity) AS cost, count(*) * 30.0::DOUBLE AS budget FROM lineitem GROUP BY ALL)"""


def monthly_lines(t):
    return t.lineitem.select(
        "l_suppkey", "l_returnflag", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "l_quantity"
    )


@query("win_02", S.with_sql(MONTHLY_SQL) + """SELECT l_suppkey, l_returnflag, year, month, cost,
  sum(cost) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY year, month) AS cumulative_cost FROM monthly""")
def running_total(t):
    return running.running_totals(monthly_lines(t), ["l_suppkey", "l_returnflag"], ["year", "month"], {"cost": F.col("l_quantity")})


@query("win_03", S.with_sql(MONTHLY_SQL) + """SELECT l_suppkey, l_returnflag, year, month,
  sum(budget - cost) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY year, month) AS cumulative_balance FROM monthly""")
def running_difference(t):
    balance = running.running_totals(
        monthly_lines(t), ["l_suppkey", "l_returnflag"], ["year", "month"], {"balance": 30.0 - F.col("l_quantity")}
    )
    return balance.drop("balance")


@query("win_04", """WITH m AS (SELECT l_suppkey % 10 AS parent, l_suppkey AS child, date_trunc('month', l_shipdate) AS mon, sum(l_quantity) AS cost
    FROM lineitem GROUP BY ALL)
  SELECT parent, child, strftime(mon, '%Y-%m-%d') AS mon, sum(cost) OVER (PARTITION BY parent, child ORDER BY mon) AS child_total,
    CASE WHEN parent = child THEN sum(cost) OVER (PARTITION BY parent ORDER BY mon) ELSE 0 END AS parent_total FROM m""")
def two_grain_running_total(t):
    """The parent's running total is shown on the row where child = parent."""
    lines = t.lineitem.select(
        (F.col("l_suppkey") % 10).alias("parent"), F.col("l_suppkey").alias("child"), month_start("l_shipdate").alias("mon"), "l_quantity"
    )
    total = {"cost": F.col("l_quantity")}
    child = running.running_totals(lines, ["parent", "child"], ["mon"], total)
    parent = running.running_totals(lines, ["parent"], ["mon"], total)
    parent = parent.select("parent", "mon", F.col("cumulative_cost").alias("whole"))
    own = F.col("parent") == F.col("child")
    return child.join(parent, ["parent", "mon"]).select(
        "parent", "child", "mon", F.col("cumulative_cost").alias("child_total"),
        F.when(own, F.col("whole")).otherwise(0.0).alias("parent_total"),
    )


FILL_SQL = """e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'signup' THEN value END AS plan,
  CASE WHEN event_type IN ('click', 'error') THEN event_type WHEN event_type = 'view' THEN '' END AS tag FROM events)"""


def tagged_events(t):
    kind = F.col("event_type")
    return t.events.select(
        "event_id", "user_id", "ts", F.when(kind == "signup", F.col("value")).alias("plan"),
        F.when(kind.isin("click", "error"), kind).when(kind == "view", "").alias("tag"),
    )


@query("win_05", S.with_sql(FILL_SQL) + """SELECT event_id, user_id, first_value(plan IGNORE NULLS) OVER w AS plan, first_value(tag IGNORE NULLS) OVER w AS tag
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts DESC)""")
def newest_non_null(t):
    """Rows newer than the newest filled row stay null; an empty text counts as a value."""
    return newest.newest_value_fill(tagged_events(t), "user_id", "ts", "event_id", ["plan", "tag"], bypass_blank=False).drop("ts")


@query("win_06", S.with_sql(FILL_SQL) + """SELECT event_id, user_id, first_value(plan) OVER w AS plan, first_value(tag) OVER w AS tag
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts DESC)""")
def newest_with_nulls(t):
    return newest.newest_value_fill(
        tagged_events(t), "user_id", "ts", "event_id", ["plan", "tag"], keep_nulls=["plan", "tag"], bypass_blank=False
    ).drop("ts")


@query("win_07", S.with_sql(FILL_SQL) + """SELECT event_id, user_id, last_value(tag) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS tag FROM e""")
def last_over_group(t):
    events = tagged_events(t).select("event_id", "user_id", "ts", "tag")
    return newest.last_value_over(events, ["user_id"], ["ts", "event_id"], ["tag"]).drop("ts")


@query("win_08", """SELECT event_id, user_id, event_type, sum(value) OVER w AS running_value, count(*) OVER w AS running_count
  FROM (SELECT event_id, user_id, event_type, ts, floor(value)::DOUBLE AS value FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts)""")
def shared_window(t):
    """Several running columns over one window, by hour blocks per user."""
    events = t.events.select("event_id", "user_id", "event_type", "ts", F.floor("value").cast("double").alias("value"))
    hour = F.date_trunc("hour", "ts")
    both = running.running_columns_in_blocks(events, ["user_id"], "ts", hour, {"value": F.col("value"), "rows": F.lit(1)})
    return both.select("event_id", "user_id", "event_type", F.col("cumulative_value").alias("running_value"), F.col("cumulative_rows").alias("running_count"))
