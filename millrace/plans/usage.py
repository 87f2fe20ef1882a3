"""Compute-usage cost: tags, prices, daily facts, contracts, running totals, reports.

Inputs
  usage      workspace_id, sku, usage_date, usage_time, quantity, product,
             tags map, origin struct, record_id
  prices     sku, start_date, end_date, listed_rate [, contract_rate, entity_type]
  contracts  contract_id, parent_id, tag_key, tag_value, date_from, date_to,
             committed, annual_budget, month_budget, hard_limit, is_active

Usage is summed to one row per day, workspace, sku and entity before it meets
any dimension, so the joins move the fact and not the raw records.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import squeezed, tidy
from millrace.operators.changes import update_where
from millrace.operators.newest import latest_per_key
from millrace.operators.rules import like_candidates, matches_any, ordered_case
from millrace.operators.validity import by_month, current_rows, valid_at

# Fixed values
DEFAULT_LIMIT = 95.0  # hard limit of an active contract that names none
LIMIT_SHARE = 0.95  # share of the committed sum used as limit where the limit is zero
ALERT_SHARE = 0.95  # share of the month's budget above which the budget alert is raised
BUDGET_ALERT, LIMIT_ALERT = 10, 100
VECTOR_PRODUCT, SERVING_PRODUCT = "VECTOR_SEARCH", "MODEL_SERVING"  # products of usage records that have endpoints


@dataclass(frozen=True)
class GroupRule:
    """Assign ``group`` when the tag is missing in a workspace or looks like a pattern."""

    group: str
    workspaces: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()


#: Hand-written corrections, a row for each entity, pattern or workspace of a step: ``kind`` says which one ``value`` is.
OVERRIDES = "step int, kind string, value string, cost_group string, agency string, only_if_null boolean"


# -------------------------------------------------------------------- entities


def entity_id() -> Column:
    """Who used the resource: the most specific origin that is known."""
    origin, product = F.col("origin"), F.col("product")
    served = F.try_element_at("tags", F.lit("endpoint"))
    named = lambda kind, value: F.concat(F.lit(kind + "/"), value)
    return F.coalesce(
        named("job", origin["job"]),
        named("warehouse", origin["warehouse"]),
        F.when(origin["endpoint"].isNotNull() & (product == VECTOR_PRODUCT), named("vector", origin["endpoint_name"])),
        F.when(product == SERVING_PRODUCT, named("model", served)),
        named("notebook", origin["notebook"]),
        named("pool", origin["pool"]),
        named("flow", origin["flow"]),
        named("cluster", origin["cluster"]),
    )


def entity_link(entity: Column, host: Column, workspace: Column) -> Column:
    """Page of the entity; entities without a page of their own open as clusters."""
    site = F.concat(F.lit("https://"), host, F.lit(".example.com/"))
    paged = matches_any(entity, [f"{kind}/%" for kind in ("job", "warehouse", "flow", "vector", "model", "cluster")])
    return (
        F.when(paged, F.concat(site, entity, F.lit("?o="), workspace))
        .when(entity.like("notebook/%"), F.concat(site, F.lit("?o="), workspace, F.lit("#"), entity))
        .otherwise(F.concat(site, F.lit("cluster/"), entity, F.lit("?o="), workspace))
    )


def latest_tags(usage: DataFrame, remap: Sequence[tuple[str, Sequence[str], Sequence[str]]] = ()) -> DataFrame:
    """Tags of each entity from its newest record that carries a cost group.

    ``remap`` holds (new group, group patterns, agency patterns) in order.
    """
    tag = lambda name: F.try_element_at("tags", F.lit(name))
    tagged = usage.filter(tag("group").isNotNull()).select(
        entity_id().alias("entity_id"), "usage_time", "record_id", squeezed(tag("agency")).alias("agency"),
        squeezed(tag("division")).alias("division"), squeezed(tag("group")).alias("cost_group"),
        tidy(tag("project")).alias("project"), tidy(tag("client")).alias("client"),
    )
    newest = latest_per_key(tagged, ["entity_id"], ["usage_time", "record_id"]).drop("usage_time", "record_id")
    cases = [
        (matches_any(F.col("cost_group"), groups) | F.coalesce(matches_any(F.col("agency"), agencies), F.lit(False)), new)
        for new, groups, agencies in remap
    ]
    return newest.withColumn("cost_group", ordered_case(cases, F.col("cost_group")))


def tag_history(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Entities that no longer appear keep their last tags; the others get the current ones.

    An entity without id in ``current`` does not empty the history, as a
    ``NOT IN`` list with a null would.
    """
    gone = previous.join(current.select("entity_id"), "entity_id", "left_anti")
    return gone.select(*current.columns).union(current).distinct()


# ---------------------------------------------------------------------- prices


def priced_usage(usage: DataFrame, contract_prices: DataFrame, list_prices: DataFrame) -> DataFrame:
    """Add listed and contract rate; without a contract the list price holds."""
    negotiated = current_rows(contract_prices).select("sku", "contract_rate", "entity_type")
    listed = current_rows(list_prices).select("sku", "listed_rate")
    priced = usage.join(negotiated, "sku", "left").join(listed, "sku", "left")
    return priced.withColumn("contract_rate", F.coalesce("contract_rate", "listed_rate"))


def backfill_prices(fact: DataFrame, prices: DataFrame) -> DataFrame:
    """Take missing or changed rates from the price rows valid on the day; recompute cost."""
    # cost is a function of the row's own rates, so rates and cost change together
    wanted = prices.select(
        "sku", "start_date", "end_date", F.col("listed_rate").alias("_listed"),
        F.col("contract_rate").alias("_contract"), F.col("entity_type").alias("_type"), F.lit(True).alias("_hit"),
    )
    joined = valid_at(fact, wanted, "sku", "usage_date")
    changed = F.coalesce(F.col("_hit"), F.lit(False)) & (
        F.col("contract_rate").isNull() | (F.col("contract_rate") != F.col("_contract"))
    )
    moved = update_where(
        joined, changed,
        {"listed_rate": F.col("_listed"), "contract_rate": F.col("_contract"), "entity_type": F.col("_type")},
    ).select(*fact.columns)
    stale = F.coalesce(F.col("cost") != F.col("quantity") * F.col("listed_rate"), F.lit(False)) | (
        F.col("cost").isNull() & F.col("listed_rate").isNotNull()
    )
    return update_where(
        moved, stale,
        {"cost": F.col("quantity") * F.col("listed_rate"), "net_cost": F.col("quantity") * F.col("contract_rate")},
    )


def price_coverage(fact: DataFrame) -> DataFrame:
    """First and last day each price was used."""
    return fact.groupBy("sku", "listed_rate", "contract_rate").agg(
        F.min("usage_date").alias("first_day"), F.max("usage_date").alias("last_day")
    )


# ----------------------------------------------------------------------- facts


def assigned_group(tag: Column, workspace: Column, rules: Sequence[GroupRule]) -> Column:
    """Ordered rules; a tag no rule knows is used in upper case."""
    missing = F.ltrim(tag).isNull()
    cases = [
        (
            (missing & workspace.isin(*rule.workspaces) if rule.workspaces else F.lit(False))
            | F.coalesce(matches_any(F.upper(tag), rule.patterns), F.lit(False)),
            rule.group,
        )
        for rule in rules
    ]
    return ordered_case(cases, F.upper(tag))


def daily_fact(
    usage: DataFrame, contract_prices: DataFrame, list_prices: DataFrame, tags: DataFrame, rules: Sequence[GroupRule]
) -> DataFrame:
    """One row per day, workspace, sku and entity with its tags, rates, quantity and cost."""
    summed = (
        usage.groupBy("usage_date", "workspace_id", "sku", entity_id().alias("entity_id"))
        .agg(F.sum("quantity").alias("quantity"))
    )
    priced = priced_usage(summed, contract_prices, list_prices)
    tagged = priced.join(tags, "entity_id", "left")
    return tagged.select(
        F.year("usage_date").alias("year"), F.month("usage_date").alias("month"), "usage_date", "workspace_id",
        "agency", "division", assigned_group(F.col("cost_group"), F.col("workspace_id"), rules).alias("cost_group"),
        "project", "client", "sku", "listed_rate", "contract_rate", "entity_type", "entity_id", "quantity",
        (F.col("quantity") * F.col("listed_rate")).alias("cost"),
        (F.col("quantity") * F.col("contract_rate")).alias("net_cost"),
    )


def month_slice(df: DataFrame, date: str, as_of: dt.date, which: str, since: dt.date | None = None) -> DataFrame:
    """Rows of the current month, the previous month, or all earlier months.

    The bounds are literals, so they reach the scan as filters and prune
    partitions.
    """
    start = as_of.replace(day=1)
    before = (start - dt.timedelta(days=1)).replace(day=1)
    if which == "current":
        return df.filter(F.col(date) >= F.lit(start))
    if which == "previous":
        return df.filter((F.col(date) >= F.lit(before)) & (F.col(date) < F.lit(start)))
    if which == "history":
        kept = df.filter(F.col(date) < F.lit(start))
        return kept if since is None else kept.filter(F.col(date) >= F.lit(since))
    raise ValueError(f"unknown slice {which}")


def full_fact(archive: DataFrame, current: DataFrame) -> DataFrame:
    return archive.unionByName(current)


def apply_overrides(fact: DataFrame, overrides: DataFrame) -> DataFrame:
    """Apply the rows of an override table in the order of their steps; a later step sees the result of the earlier ones.

    A step hits a row whose entity or workspace is one of its values or whose entity is LIKE one of its patterns, with
    ``only_if_null`` only while the row has no cost group; an agency that is null is not changed. The table is matched
    against the distinct entities and workspaces, by equality or a piece of the pattern, so it may be long.
    """
    keys = ["entity_id", "workspace_id"]
    pairs = fact.select(*keys).distinct()
    step = F.struct("step", "cost_group", "agency", "only_if_null").alias("step")
    by = lambda kind: overrides.filter(F.col("kind") == kind).select("value", step)
    found = [pairs.join(by(kind), F.col(c) == F.col("value")).select(*keys, "step") for kind, c in (("entity", "entity_id"), ("workspace", "workspace_id"))]
    every = by("pattern").withColumn("_every", F.lit(1))
    held = like_candidates(pairs.withColumn("_all", F.lit(1)), "_all", "entity_id", every, "_every", "value")
    found.append(held.filter(F.expr("entity_id LIKE value")).select(*keys, "step"))
    # at most one entry a step of the table, in order
    steps = reduce(DataFrame.unionByName, found).groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.array_sort(F.collect_set("step")).alias("_steps"))
    joined = fact.join(steps, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
    state = lambda group, agency: F.struct(group.alias("cost_group"), agency.alias("agency"))
    folded = F.aggregate(
        F.coalesce("_steps", F.array().cast(steps.schema["_steps"].dataType)), state(F.col("cost_group"), F.col("agency")),
        lambda now, s: F.when(s["only_if_null"] & now["cost_group"].isNotNull(), now).otherwise(state(s["cost_group"], F.coalesce(s["agency"], now["agency"]))),
    )
    done = joined.withColumn("_done", folded)
    return done.select(*[F.col("_done")[c].alias(c) if c in ("cost_group", "agency") else F.col(c) for c in fact.columns])


def rename_groups(df: DataFrame, column: str, names: Mapping[str, str]) -> DataFrame:
    return df.replace(dict(names), subset=[column])


# ------------------------------------------------------------------- contracts


def parent_group(group: Column, patterns: Sequence[str], parent: str) -> Column:
    """Groups that look like one of the patterns, or are missing, belong to the parent."""
    return F.when(group.isNull() | matches_any(group, patterns), parent).otherwise(group)


def monthly_cost(fact: DataFrame, patterns: Sequence[str], parent: str, by_sub_group: bool = False) -> DataFrame:
    keys = ["year", "month", parent_group(F.col("cost_group"), patterns, parent).alias("main_group")]
    if by_sub_group:
        keys.append(F.col("cost_group").alias("sub_group"))
    return fact.groupBy(*keys).agg(F.sum("net_cost").alias("usage_cost"))


def with_contract_terms(
    cost: DataFrame, contracts: DataFrame, root_key: str, root_value: str, default_limit: float = DEFAULT_LIMIT
) -> DataFrame:
    """Join each monthly cost to its own contract, else to the root contract.

    A contract applies when the group starts with its tag value and the month
    lies in its range.  Contracts are found for the distinct months and groups, by equality
    with the beginnings of the group's name, so ``cost`` is read twice.
    """
    base = cost.withColumn("_month", F.make_date("year", "month", F.lit(1)))
    terms = by_month(contracts, "date_from", "date_to")
    beginnings = F.transform(F.sequence(F.lit(0), F.length("main_group")), lambda n: F.left(F.col("main_group"), n))
    named = base.select("_month", "main_group").distinct().select("*", F.explode(beginnings).alias("_start")).alias("n")
    own = named.join(
        terms.filter("parent_id <> contract_id").alias("t"),
        (F.col("n._month") == F.col("t.valid_month")) & (F.col("n._start") == F.col("t.tag_value")),
    ).select("n._month", "n.main_group", "t.*").alias("own")
    root = terms.filter((F.col("tag_key") == root_key) & (F.col("tag_value") == root_value)).alias("root")
    elsewhere = F.when(~F.startswith("main_group", F.lit(root_value)), F.col("_month"))
    joined = base.withColumn("_root_month", elsewhere).alias("c").join(
        own, (F.col("c._month") == F.col("own._month")) & (F.col("c.main_group") == F.col("own.main_group")), "left"
    ).join(root, F.col("c._root_month") == F.col("root.valid_month"), "left")
    status = F.coalesce("own.is_active", "root.is_active")
    limit = F.when(status == 1, F.coalesce("own.hard_limit", F.lit(default_limit))).otherwise(
        F.coalesce("own.hard_limit", "own.month_budget", "root.month_budget")
    )
    return joined.select(
        *[F.col(f"c.{c}") for c in cost.columns],
        F.coalesce("own.contract_id", "root.contract_id").alias("contract_id"),
        F.coalesce("own.committed", F.lit(0.0)).alias("committed"),
        F.coalesce("own.annual_budget", F.lit(0.0)).alias("annual_budget"),
        F.coalesce("own.month_budget", F.lit(0.0)).alias("month_budget"),
        limit.alias("hard_limit"),
        status.alias("contract_status"),
    )


def cumulative(archive: DataFrame, current: DataFrame) -> DataFrame:
    """Running cost and balance per contract and group; equal rows of both parts count once."""
    rows = archive.unionByName(current).distinct()
    per_group = Window.partitionBy("contract_id", "main_group").orderBy("year", "month")
    per_status = Window.partitionBy("contract_id", "main_group", "contract_status").orderBy("year", "month")
    return rows.select(
        "*",
        F.make_date("year", "month", F.lit(1)).alias("year_month"),
        F.sum("usage_cost").over(per_group).alias("cumulative_usage_cost"),
        F.sum(F.col("month_budget") - F.col("usage_cost")).over(per_status).alias("balance"),
    )


def cumulative_by_sub_group(archive: DataFrame, current: DataFrame) -> DataFrame:
    """Running cost per sub-group; contract terms and totals only on the parent's own row."""
    rows = archive.unionByName(current).distinct()
    own = F.col("main_group") == F.col("sub_group")
    shown = lambda c: F.when(own, c).otherwise(0.0)
    per_sub = Window.partitionBy("contract_id", "main_group", "sub_group").orderBy("year", "month")
    per_group = Window.partitionBy("contract_id", "main_group").orderBy("year", "month")
    result = rows.select(
        "year", "month", F.make_date("year", "month", F.lit(1)).alias("year_month"), "main_group", "sub_group", "usage_cost",
        *[shown(F.col(c)).alias(c) for c in ("committed", "annual_budget", "month_budget", "hard_limit")],
        F.sum("usage_cost").over(per_sub).alias("cumulative_usage_cost"),
        shown(F.sum("usage_cost").over(per_group)).alias("cumulative_contract_usage_cost"),
        shown(F.sum(shown(F.col("month_budget"))).over(per_group)).alias("cumulative_month_budget"),
        "contract_status",
    )
    return result.withColumn(
        "cumulative_month_balance", F.col("cumulative_month_budget") - F.col("cumulative_contract_usage_cost")
    )


# --------------------------------------------------------------------- reports


def dashboard(cumulated: DataFrame) -> DataFrame:
    """Month totals with an alert: 10 near the budget, 100 beyond the limit, 0 otherwise."""
    total = cumulated.groupBy("year", "month").agg(
        *[F.sum(c).alias(c) for c in ("usage_cost", "month_budget", "annual_budget", "committed", "hard_limit", "cumulative_usage_cost")]
    )
    alert = (
        F.when(F.col("usage_cost") > F.col("month_budget") * ALERT_SHARE, BUDGET_ALERT)
        .when(F.col("cumulative_usage_cost") > F.col("hard_limit"), LIMIT_ALERT).otherwise(0)
    )
    return total.withColumn("alert", alert).withColumn("hard_limit", _limit_or_share())


def _limit_or_share() -> Column:
    return F.when(F.col("hard_limit") == 0, F.col("committed") * LIMIT_SHARE).otherwise(F.col("hard_limit"))


def agency_summary(cumulated: DataFrame, group: str) -> DataFrame:
    """Per month of one group: total cost, average terms."""
    one = cumulated.filter(F.col("main_group") == group)
    total = one.groupBy("main_group", "year_month").agg(
        F.sum("usage_cost").alias("usage_cost"), F.sum("committed").alias("_sum_committed"),
        *[F.avg(c).alias(c) for c in ("month_budget", "annual_budget", "committed", "hard_limit", "cumulative_usage_cost")],
    )
    limit = F.when(F.col("hard_limit") == 0, F.col("_sum_committed") * LIMIT_SHARE).otherwise(F.col("hard_limit"))
    return total.withColumn("hard_limit", limit).drop("_sum_committed")


def agency_detail(cumulated: DataFrame, group: str) -> DataFrame:
    """Per month and sub-group of one group: totals throughout."""
    one = cumulated.filter(F.col("main_group") == group)
    total = one.groupBy("main_group", F.coalesce("sub_group", F.lit("-1")).alias("sub_group"), "year_month").agg(
        *[F.sum(c).alias(c) for c in ("usage_cost", "month_budget", "annual_budget", "committed", "hard_limit", "cumulative_usage_cost")]
    )
    return total.withColumn("hard_limit", _limit_or_share())


def untagged_audit(fact: DataFrame, workspaces: DataFrame, known_groups: str) -> DataFrame:
    """Entities without usable group, workspace or type, with their cost and a link."""
    joined = fact.join(workspaces, "workspace_id", "left").filter(
        F.col("cost_group").isNull() | ~F.col("cost_group").like(known_groups) | F.col("workspace").isNull() | F.col("entity_type").isNull()
    )
    keys = ["workspace", "host", "workspace_id", "cost_group", "sku", "entity_type", "entity_id", "project"]
    summed = joined.groupBy(*keys).agg(
        F.max(F.col("year") * 100 + F.col("month")).alias("last_month"), F.sum("net_cost").alias("net_cost")
    )
    link = entity_link(F.col("entity_id"), F.col("host"), F.col("workspace_id"))
    return summed.withColumn("link", link).drop("host")
