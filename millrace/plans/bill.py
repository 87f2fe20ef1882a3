"""Cloud-bill cost: normalise, retag, reallocate, adjust, report.

The bill fact carries ``year, month, usage_time, billing_entity, owner_id``,
the tags in ``TAGS``, the resource and service columns, and the measures
``usage_amount, net_cost, ondemand_cost, ondemand_rate``.  ``line_id`` breaks
ties between lines of one resource with the same time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import hours_of_month, month_start, packed_rate, tidy
from millrace.operators import rules as R
from millrace.operators.changes import update_from, update_where
from millrace.operators.newest import last_value_over, newest_value_parts
from millrace.workspace import settle_parts

TAGS = [
    "tag_group1", "tag_group2", "tag_name", "tag_plan", "tag_env", "tag_project", "tag_client", "tag_agency",
    "tag_product", "tag_owner", "tag_scope", "tag_local_env", "tag_local_group1", "tag_local_group2", "tag_local_client",
]
ORIGINALS = {"original_group2": "tag_group2", "original_project": "tag_project"}  # kept by the first retag
SCOPED_GROUP = ("SOUTHLAKE", "SOUTH LAKE")  # scope text and the group it stands for

# Fixed values
NET_SHARE = 0.82  # share of the on-demand price that is charged on
MONTHS_PER_YEAR, HOURS_PER_MONTH = 12, 730  # to spread a price paid for a year up front
RESERVATION_FEE = "RIFee"  # item types of bill lines
PLAN_COVERED, PLAN_FEE = "SavingsPlanCoveredUsage", "SavingsPlanRecurringFee"
HEAVY_USAGE = "HeavyUsage"  # in the usage type of reserved nodes
RESERVED_FAMILY, CROSS_CHARGE = "Reserved Nodes", "Cross Charge"  # names in reports


# ------------------------------------------------------------------- bill lines


def billable() -> Column:
    """Lines that cost something, and the free lines of a reservation fee."""
    return (
        (F.col("net_cost") != 0) | (F.col("reservation_cost") != 0) | (F.col("plan_cost") != 0)
        | ((F.col("net_cost") == 0) & (F.col("item_type") == RESERVATION_FEE))
    )


def normalise(source: DataFrame) -> DataFrame:
    """Source lines to fact columns: tidy tags, one resource id, service and family."""
    market = F.col("billing_entity") == "Marketplace"
    support = F.col("product_code").like("%Support%")
    bought_plan = F.col("product_code").like("%Savings%") & (F.col("bill_type") == "Purchase")
    blank = F.col("resource") == ""
    resource = (
        F.when(market | support, F.col("product_name"))
        .when(F.concat("resource", "plan_arn", "reservation_arn") == "", F.concat(F.lit("item:"), "line_id"))
        .when(blank & (F.col("reservation_arn") != ""), F.concat(F.lit("ri:"), "reservation_arn"))
        .when(blank & (F.col("plan_arn") != ""), F.concat(F.lit("sp:"), "plan_arn"))
        .otherwise(F.col("resource"))
    )
    service = (
        F.when(market, F.col("billing_entity")).when(bought_plan, F.concat("product_code", F.lit(" Purchase")))
        .when(F.col("item_type") == "Tax", F.col("item_type")).when(support, F.col("product_name"))
        .otherwise(F.col("product_code"))
    )
    return source.filter(billable()).select(
        "line_id", "year", "month", "usage_time", "billing_entity", "owner_id", *[tidy(c).alias(c) for c in TAGS],
        resource.alias("resource_id"), service.alias("service"), F.col("product_name").alias("service_name"),
        F.when(bought_plan, "Purchase").otherwise(F.col("product_family")).alias("family"),
        "operation", "region", "os", "instance_type", "pricing_term", "pricing_unit", "usage_type", "item_type",
        "usage_amount", "net_cost", "ondemand_cost", "ondemand_rate", "sku",
    )


def month_window(df: DataFrame, as_of: dt.date, first: int, last: int, late_service: str | None = None) -> DataFrame:
    """Lines from month offset ``first`` to ``last``, plus the open month.

    A service that is billed late is taken by the month of its bill instead
    of the day of use.
    """
    start = as_of.replace(day=1)
    at = lambda offset: F.add_months(F.lit(start), offset)
    used = F.col("usage_time")
    inside = used < at(last + 1)
    if late_service is not None:
        billed = F.make_date("year", "month", F.lit(1))
        inside = inside | ((F.col("service_name") == late_service) & (billed >= at(first)) & (billed < at(last + 1)))
    return df.filter((used >= at(first)) & (inside | (used >= F.lit(start))))


# ------------------------------------------------------------------- retagging


def _retagged(fact: DataFrame, key: str, keep_nulls: Sequence[str], bypass_blank: bool) -> list[DataFrame]:
    """In parts; a fact that has only some of the tags is retagged in those."""
    tags = [c for c in TAGS if c in fact.columns]
    return newest_value_parts(fact, key, "usage_time", "line_id", tags, keep_nulls, bypass_blank)


def retag_by_resource(fact: DataFrame, bypass_blank: bool = True, keep_nulls: Sequence[str] = ()) -> DataFrame:
    """Give every line of a resource its newest tags, as a written table; the original group and project are kept."""
    kept = fact.withColumns({name: F.col(c) for name, c in ORIGINALS.items() if c in fact.columns})
    return settle_parts(_retagged(kept, "resource_id", keep_nulls, bypass_blank), "by-resource")


def retag_by_name(fact: DataFrame, bypass_blank: bool = True, keep_nulls: Sequence[str] = ("tag_plan",)) -> DataFrame:
    """The same over lines that share a name; the plan tag follows the newest line as it is. Written only if the names are many."""
    parts = _retagged(fact, "tag_name", keep_nulls, bypass_blank)
    return settle_parts(parts, "by-name") if len(parts) > 1 else parts[0]


OLD_FORM_NULLS = tuple(c for c in TAGS if c not in ("tag_group1", "tag_group2", "tag_name"))


def retag_old_form(fact: DataFrame) -> DataFrame:
    """Older form: blank keys are retagged too, and only group and name tags skip nulls."""
    return retag_by_name(retag_by_resource(fact, False, OLD_FORM_NULLS), False, OLD_FORM_NULLS)


def _kind(rules: DataFrame, kind: str) -> DataFrame:
    return rules.filter(F.col("kind") == kind).withColumns({c: F.upper(c) for c in ("pattern", "original", "new")})


def reallocate(fact: DataFrame, rules: DataFrame, name_groups: Mapping[str, str] | None = None) -> DataFrame:
    """Final group of each line from owner, tag and resource rules.

    Owner rules of sort SA win outright, of sort SCOPE unless the scope tag
    names a group; of sort GROUP only where there is no tag.  ``name_groups``
    maps name patterns to groups and is looked at after SA and SCOPE.
    """
    owner = _kind(rules, "owner").withColumn("new", F.struct("original", "new"))
    joined = R.with_exact_target(fact, F.upper("owner_id"), owner, "pattern", "_by_owner")
    joined = R.with_exact_target(
        joined, F.upper(F.coalesce("tag_group2", F.lit(""))), _kind(rules, "tag"), "original", "_by_tag"
    )
    shaped = joined.withColumns({"_owner_up": F.upper("owner_id"), "_resource_up": F.upper("resource_id")})
    shaped = R.with_pattern_target(shaped, "_owner_up", "_resource_up", _kind(rules, "resource"), "_by_resource")
    sort, by_owner = F.col("_by_owner")["original"], F.col("_by_owner")["new"]
    own_tag = F.nullif("tag_group2", F.lit(""))
    scope, scope_group = SCOPED_GROUP
    cases = [
        (sort == "SA", by_owner),
        (sort == "SCOPE", F.when(F.upper("tag_scope") == scope, scope_group).otherwise(by_owner)),
        *[(F.col("tag_name").like(pattern), group) for pattern, group in (name_groups or {}).items()],
        (sort == "GROUP", F.coalesce("_by_tag", own_tag, by_owner, F.lit(""))),
    ]
    group = R.ordered_case(cases, F.coalesce("_by_tag", own_tag, "_by_resource", F.lit("")))
    return shaped.select(*[group.alias(c) if c == "tag_group2" else F.col(c) for c in fact.columns])


def month_fact(fact: DataFrame, year: int, month: int) -> DataFrame:
    return fact.filter((F.col("year") == year) & (F.col("month") == month))


def rule_passes(fact: DataFrame, rules: DataFrame) -> DataFrame:
    """The written rules applied to a stored fact, pass after pass, as updates.

    A missing group stays missing in the tidying passes, because comparing it
    gives null.  Two resource rules for one line stop the job.
    """
    scope, scope_group = SCOPED_GROUP
    group = F.col("tag_group2")
    scoped = tidy("tag_scope") == scope
    clean = tidy(F.coalesce(group, F.lit("")))
    fact = update_where(
        fact, (group != clean) | (scoped & (group != scope_group)),
        {"tag_group2": F.when(scoped, scope_group).otherwise(clean)},
    )
    plain = rules.withColumn("new", tidy("new"))
    of = lambda kind, sort=None: plain.filter((F.col("kind") == kind) & (F.col("original") == sort if sort else F.lit(True)))

    def update(found: DataFrame, condition: Column) -> DataFrame:
        return update_where(found, F.col("_new").isNotNull() & condition, {"tag_group2": F.col("_new")}).drop("_new")

    fact = update(R.with_exact_target(fact, F.col("owner_id"), of("owner", "SA"), "pattern", "_new"), F.lit(True))
    fact = update(R.with_exact_target(fact, F.col("owner_id"), of("owner", "GROUP"), "pattern", "_new"), group == "")
    tag_rules = of("tag").withColumn("original", tidy("original"))
    fact = update(R.with_exact_target(fact, group, tag_rules, "original", "_new"), group != F.col("_new"))
    fact = update(
        R.with_pattern_target(fact, "owner_id", "resource_id", of("resource"), "_new", on_conflict="error"),
        group != F.col("_new"),
    )
    return update_where(fact, group != clean, {"tag_group2": clean})


# ----------------------------------------------------------------- adjustments


def commitment_totals(assets: DataFrame, as_of: dt.date) -> DataFrame:
    """Commitment and on-demand rates per group, for the hours of the month before ``as_of``."""
    month = F.add_months(F.lit(as_of.replace(day=1)), -1)
    return (
        assets.filter("tag_group2 IS NOT NULL").groupBy("tag_group2")
        .agg(F.sum("plan_rate").alias("plan_rate"), F.sum("ondemand_rate").alias("ondemand_rate"))
        .withColumns({"hours": hours_of_month(month), "usage_month": month})
    )


def plan_benefit(fact: DataFrame, commitments: DataFrame) -> DataFrame:
    """Gain or loss of each group when commitments are charged to their buyers.

    Adjustment = (on-demand - covered on-demand + commitment) * share - net.
    """
    month = month_start("usage_time")
    used = (
        fact.filter(
            "service = 'Compute' AND family = 'Compute Instance' AND pricing_term <> 'Spot' AND billing_entity <> 'Adjustment'"
        )
        .groupBy("year", "month", "tag_group2", month.alias("usage_month"), hours_of_month("usage_time").alias("hours"))
        .agg(*[F.sum(c).alias(c) for c in ("usage_amount", "net_cost", "ondemand_cost")])
    )
    held = commitments.select(
        "tag_group2", "usage_month", F.col("hours").alias("_hours"), "plan_rate", F.col("ondemand_rate").alias("_rate")
    )
    joined = used.join(held, ["tag_group2", "usage_month"], "left")
    plan = F.coalesce(F.col("_hours") * F.col("plan_rate"), F.lit(0.0))
    covered = F.coalesce(F.col("_hours") * F.col("_rate"), F.lit(0.0))
    return joined.select(
        "year", "month", "hours", "usage_month", "tag_group2",
        F.coalesce("_hours", "usage_amount").alias("usage_amount"),
        F.col("net_cost").alias("actual_net"), F.col("ondemand_cost").alias("actual_ondemand"),
        plan.alias("benefit_net"), covered.alias("benefit_ondemand"),
        ((F.col("ondemand_cost") - covered + plan) * NET_SHARE - F.col("net_cost")).alias("net_cost"),
        F.coalesce("plan_rate", F.lit(0.0)).alias("plan_rate"), F.coalesce("_rate", F.lit(0.0)).alias("ondemand_rate"),
    )


def _balanced(rows: DataFrame, keys: Sequence[str], measures: Sequence[str], item_type: str) -> DataFrame:
    """Rows plus, per key, one row that takes the measures back out."""
    back = rows.groupBy(*keys).agg(*[(-F.sum(c)).alias(c) for c in measures], F.sum("ondemand_rate").alias("ondemand_rate"))
    back = back.withColumns({"tag_group2": F.lit("NOT ALLOCATED"), "item_type": F.lit(item_type)})
    return rows.unionByName(back)


def plan_adjustments(benefit: DataFrame) -> DataFrame:
    """One adjustment line per group and one balancing line per month; each month sums to zero."""
    rows = benefit.select(
        "year", "month", "usage_month", "tag_group2", F.lit(PLAN_COVERED).alias("item_type"),
        F.col("hours").cast("double").alias("usage_amount"), "net_cost", F.col("actual_ondemand").alias("ondemand_cost"), "ondemand_rate",
    )
    return _balanced(rows, ["year", "month", "usage_month"], ["usage_amount", "net_cost", "ondemand_cost"], PLAN_FEE)


def node_usage(fact: DataFrame, reserved_patterns: Sequence[str]) -> DataFrame:
    """Nodes in use per month, and how many of them are reserved."""
    reserved = F.coalesce(R.matches_any(F.col("resource_id"), reserved_patterns), F.lit(False))
    heavy = F.col("usage_type").like(f"%{HEAVY_USAGE}%")
    hours = hours_of_month("usage_time")
    picked = fact.filter(
        (F.col("service").like("%Warehouse%") | F.col("service").like("%Database%"))
        & (F.lower("family").like("%instance%") | F.lower("family").like("%serverless%") | (F.col("pricing_term") == "Reserved"))
    )
    grouped = picked.groupBy(
        "year", "month", hours.alias("hours"), month_start("usage_time").alias("usage_month"), "tag_group2", "service",
        "service_name", F.when(heavy, RESERVED_FAMILY).otherwise(F.col("family")).alias("family"),
        F.when(heavy, F.col("usage_type")).otherwise(F.col("instance_type")).alias("instance_type"),
        "usage_type", F.coalesce("ondemand_rate", F.lit(0.0)).alias("ondemand_rate"),
    ).agg(
        F.sum(F.when(reserved, 0.0).otherwise(F.col("usage_amount"))).alias("_free"),
        F.sum(F.when(reserved, F.col("usage_amount")).otherwise(0.0)).alias("_reserved"),
        F.sum("net_cost").alias("net_cost"), F.sum("ondemand_cost").alias("ondemand_cost"),
    )
    return grouped.withColumns(
        {"nodes": F.col("_free") / F.col("hours"), "reserved_nodes": F.col("_reserved") / F.col("hours")}
    ).drop("_free", "_reserved", "usage_type")


def node_benefit(nodes: DataFrame) -> DataFrame:
    """Nodes beside the reservation of their group, month and instance type."""
    held = nodes.filter(F.col("family") == RESERVED_FAMILY).select(
        "tag_group2", "year", "month", F.col("instance_type").alias("_type"), F.col("reserved_nodes").alias("_nodes"),
        F.col("net_cost").alias("_net"),
    )
    own = nodes.filter(F.col("family") != RESERVED_FAMILY).drop("reserved_nodes")
    suffix = F.coalesce(F.nullif("instance_type", F.lit("")), F.lit(" serverless"))
    joined = R.suffix_lookup(own, held, ["tag_group2", "year", "month"], suffix, "_type")
    reserved, net = F.coalesce("_nodes", F.lit(0.0)), F.coalesce("_net", F.lit(0.0))
    covered = F.col("ondemand_rate") * F.col("hours") * reserved
    return joined.select(
        "year", "month", "hours", "usage_month", "tag_group2", "service", "service_name", "family", "instance_type",
        "ondemand_rate", "nodes", reserved.alias("reserved_nodes"), F.col("net_cost").alias("actual_net"),
        F.col("ondemand_cost").alias("actual_ondemand"), covered.alias("benefit_ondemand"), (net / NET_SHARE).alias("benefit_net"),
        ((F.col("ondemand_cost") - covered) * NET_SHARE + net - F.col("net_cost")).alias("net_cost"),
    )


def node_adjustments(benefit: DataFrame) -> DataFrame:
    """Adjustment per month, group and service, balanced per month and service."""
    keys = ["year", "month", "usage_month", "service", "service_name", "family"]
    rows = benefit.groupBy(*keys, "tag_group2").agg(
        F.sum("nodes").alias("usage_amount"), F.sum("net_cost").alias("net_cost"),
        F.sum("actual_ondemand").alias("ondemand_cost"), F.sum(F.col("ondemand_rate") * F.col("nodes")).alias("ondemand_rate"),
    ).withColumn("item_type", F.lit("DiscountedUsage"))
    return _balanced(rows, keys, ["usage_amount", "net_cost", "ondemand_cost"], RESERVATION_FEE)


# ---------------------------------------------------------------------- assets

PRICE_KEYS = ["service", "family", "os", "region", "usage_type"]


def asset_inventory(fact: DataFrame, prices: DataFrame, services: Sequence[str]) -> DataFrame:
    """Instances of the given services with the commitment rates of their price row."""
    kept = fact.filter(
        (F.col("pricing_term") != "Spot") & F.col("service").isin(*services)
        & (F.col("family").like("%Instance%") | F.col("family").like("%Serverless%"))
    )
    return kept.join(prices.select(*PRICE_KEYS, "partial_rate", "noupfront_rate"), PRICE_KEYS, "left").withColumn(
        "hours", hours_of_month("usage_time")
    )


ASSET_KEYS = ["owner_id", "hours", "tag_group2", "tag_name", "resource_id", "tag_plan", *PRICE_KEYS, "partial_rate", "noupfront_rate", "ondemand_rate"]


def asset_fact(assets: DataFrame) -> DataFrame:
    """Assets summed; a resource without a name uses its id, unless it is an instance id."""
    name = F.when(F.col("tag_name").isNull() & ~F.col("resource_id").like("i-%"), F.col("resource_id")).otherwise(F.col("tag_name"))
    return assets.withColumn("tag_name", name).groupBy(*ASSET_KEYS).agg(
        F.sum("usage_amount").alias("usage_amount"),
        F.sum(F.col("ondemand_rate") * F.col("usage_amount")).alias("ondemand_cost"),
    )


def named_assets(assets: DataFrame, accounts: DataFrame) -> DataFrame:
    """Assets with the last group and plan of their owner and name, and the account name.

    The last row is the one with the greatest resource id, then group and
    plan: a fixed order in place of one that leaves the choice open.
    """
    order = [
        "resource_id", "usage_type", F.coalesce("tag_group2", F.lit("")), F.coalesce("tag_plan", F.lit("")),
        F.col("tag_group2").isNotNull(), F.col("tag_plan").isNotNull(),
    ]
    last = last_value_over(assets, ["owner_id", "tag_name"], order, ["tag_group2", "tag_plan"])
    named = last.join(accounts, "owner_id", "left")
    return named.withColumn("tag_name", F.coalesce("tag_name", "usage_type"))


def utilisation(assets: DataFrame) -> DataFrame:
    """Share of the month each asset ran: 100% for about one whole unit, else the number."""
    keys = ["account_name", "owner_id", "hours", "tag_group2", "tag_name", "tag_plan", *PRICE_KEYS, "partial_rate", "noupfront_rate", "ondemand_rate"]
    summed = assets.groupBy(*keys).agg(F.sum("usage_amount").alias("usage_amount"))
    share = F.round(F.col("usage_amount") / F.col("hours"), 0)
    label = F.when(share == 1, "100%").otherwise(share.cast("bigint").cast("string"))
    return summed.withColumn("utilisation", label)


def rate_dimension(assets: DataFrame) -> DataFrame:
    return assets.select(*PRICE_KEYS, "partial_rate", "noupfront_rate", "ondemand_rate").distinct()


def reserved_prices(assets: DataFrame, prices: DataFrame) -> DataFrame:
    """One-year reserved prices for the on-demand prices in use, all per hour.

    ``prices`` has sku, usage_type, region, term, option, lease, unit, price.
    A price paid in full up front is spread over the hours of a year.
    """
    ondemand = prices.filter("term = 'OnDemand'").select("sku", "usage_type", "region", F.col("price").alias("ondemand_rate"), "engine")
    reserved = prices.filter(
        "term = 'Reserved' AND lease = '1yr' AND ((unit = 'Hrs' AND option <> 'All Upfront') OR (unit = 'Quantity' AND option = 'All Upfront'))"
    ).select("sku", "usage_type", "region", "option", "price")
    used = assets.select("service", "usage_type", "region", "ondemand_rate").distinct()
    hourly = F.when(F.col("option") == "All Upfront", F.col("price") / MONTHS_PER_YEAR / HOURS_PER_MONTH).otherwise(F.col("price"))
    return (
        used.join(ondemand, ["usage_type", "region", "ondemand_rate"])
        .join(reserved, ["sku", "usage_type", "region"])
        .select("service", "region", "usage_type", "ondemand_rate", "sku", "engine", "option", hourly.alias("hourly_price"))
        .distinct()
    )


def backfill_rates(
    rows: DataFrame, reference: DataFrame, rates: Mapping[str, str], substitutes: Mapping[str, str],
    engine: str | None = None, only_missing: bool = True,
) -> DataFrame:
    """Commitment rates from the newer family's reserved price.

    ``rates`` names the purchase option of each rate column and ``substitutes`` renames old instance
    families inside the usage type.  With ``engine`` that column must equal the price's engine too.
    Only missing rates are filled, or every rate that has a price is set.
    When a key has several prices the lowest is taken.
    """
    family = F.col("usage_type")
    for old, new in substitutes.items():
        family = F.replace(family, F.lit(old), F.lit(new))
    keys = {"_type": F.col("usage_type")} | ({"_engine": F.col("engine")} if engine else {})
    found = reference.groupBy(*[c.alias(k) for k, c in keys.items()], "service", "region", "ondemand_rate").agg(
        *[F.min(F.when(F.col("option") == option, F.col("hourly_price"))).alias(f"_{rate}") for rate, option in rates.items()]
    )
    keyed = rows.withColumns({"_type": family} | ({"_engine": F.col(engine)} if engine else {}))
    joined = keyed.join(found, [*keys, "service", "region", "ondemand_rate"], "left")
    new = {rate: F.coalesce(*((rate, f"_{rate}") if only_missing else (f"_{rate}", rate))) for rate in rates}
    return joined.withColumns(new).select(*rows.columns)


def override_rates(prices: DataFrame, overrides: DataFrame) -> DataFrame:
    """Rates fixed by hand for exact service, region, usage type and price."""
    keys = ["service", "region", "usage_type", "ondemand_rate"]
    return update_from(prices, overrides, keys, ["partial_rate", "noupfront_rate"])


# --------------------------------------------------------------------- reports


def direct_usage(fact: DataFrame, group: Column, name: Column, keys: Sequence[str]) -> DataFrame:
    """Cost of the chosen groups at the on-demand price corrected by the packed plan tag."""
    packed = F.col("tag_plan").like("Y%") & (F.col("family") == "Compute Instance")
    rate = F.when(packed, packed_rate("tag_plan")).otherwise(F.lit(0.0))
    summed = fact.filter(group).withColumn("_name", name).groupBy("year", "month", "tag_group2", "_name", "tag_plan", *keys).agg(
        *[F.sum(c).alias(c) for c in ("net_cost", "usage_amount", "ondemand_cost")]
    )
    return summed.select(
        "year", "month", "tag_group2", F.col("_name").alias("tag_name"), "tag_plan", *keys, "net_cost", "usage_amount", "ondemand_cost",
        rate.alias("adjusted_rate"), ((F.col("ondemand_cost") + rate * F.col("usage_amount")) * NET_SHARE).alias("direct_usage"),
    )


def cross_charge(fact: DataFrame, group: str) -> DataFrame:
    """Lines of one group to be charged on, at the net share of the on-demand price."""
    return fact.filter((F.col("tag_group2") == group) & (F.col("ondemand_cost") != 0)).select(
        "line_id", "year", "month", month_start("usage_time").alias("charge_month"), F.lit(CROSS_CHARGE).alias("charge_type"),
        "tag_group2", "tag_name", F.col("resource_id").alias("resource"), "tag_local_env", "tag_local_client", "service", "family",
        "usage_amount", (F.col("ondemand_cost") * NET_SHARE).alias("net_ondemand_cost"),
    )


def detailed_usage(fact: DataFrame, group: str) -> DataFrame:
    """Usage of one group per resource, with the greatest local tags, without zero rows and tax."""
    keys = [
        "year", "month", month_start("usage_time").alias("charge_month"), "billing_entity", "tag_group2",
        F.coalesce("tag_name", F.lit("")).alias("tag_name"), "resource_id", "tag_plan", "service", "family", "region", "os",
        "instance_type", "pricing_term", "pricing_unit", "ondemand_rate",
    ]
    return (
        fact.filter((F.upper("tag_group2") == group) & (F.col("item_type") != "Tax")).groupBy(*keys)
        .agg(
            *[F.max(c).alias(c) for c in ("tag_local_env", "tag_local_client", "tag_local_group1", "tag_local_group2", "tag_product")],
            F.sum("usage_amount").alias("usage_amount"), (F.sum("ondemand_cost") * NET_SHARE).alias("net_ondemand_cost"),
        )
        .filter("net_ondemand_cost <> 0")
    )


def group_summary(fact: DataFrame) -> DataFrame:
    return fact.filter("net_cost <> 0").groupBy("year", "month", "tag_group2", "service", "family", "item_type").agg(
        F.sum("net_cost").alias("net_cost")
    )


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each stage in one result."""
    result = None
    for name, df in stages.items():
        count = df.agg(F.lit(name).alias("stage"), F.count("*").alias("row_count"))
        result = count if result is None else result.unionByName(count)
    return result


def instance_summary(fact: DataFrame) -> DataFrame:
    """Box usage per group; lines without group are shown as not allocated."""
    group = F.when(F.col("tag_group2") != "", F.col("tag_group2")).otherwise("ASSETS NOT ALLOCATED")
    picked = fact.filter(F.col("usage_type").like("%BoxUsage%") & F.col("item_type").like("%Usage%") & (F.col("service") == "Compute"))
    return picked.groupBy(
        "year", "month", hours_of_month("usage_time").alias("hours"), group.alias("tag_group2"), "service", "family", "item_type"
    ).agg(F.sum("net_cost").alias("net_cost"), F.sum("ondemand_cost").alias("ondemand_cost"))


def daily_service(fact: DataFrame, group: str, product: str) -> DataFrame:
    picked = fact.filter((F.col("tag_group2") == group) & (F.col("tag_product") == product))
    return picked.groupBy(
        F.to_date("usage_time").alias("day"), F.concat("service", F.lit("-"), "family").alias("detailed_service"), "pricing_unit", "resource_id"
    ).agg(F.sum("usage_amount").alias("usage_amount"), F.sum("net_cost").alias("net_cost"))


def drill_down(fact: DataFrame, column: str, pattern: str) -> DataFrame:
    return fact.filter(F.col(column).like(pattern)).groupBy("tag_group2", "tag_name", "resource_id").agg(
        F.sum("ondemand_cost").alias("ondemand_cost"), F.sum("net_cost").alias("net_cost")
    )


def refresh_tag_dimension(tags: DataFrame, rules: DataFrame) -> DataFrame:
    """Resource rules over the stored tags, then owner rules where the group is blank."""
    resource = rules.filter("kind = 'resource'").withColumn("new", tidy("new"))
    found = R.with_pattern_target(tags, "owner_id", "resource_id", resource, "_new")
    tags = update_where(found, F.col("_new").isNotNull(), {"tag_group2": F.col("_new")}).select(*tags.columns)
    found = R.with_exact_target(tags, F.col("owner_id"), rules.filter("kind = 'owner'"), "pattern", "_new")
    return update_where(found, (F.col("tag_group2") == "") & F.col("_new").isNotNull(), {"tag_group2": F.col("_new")}).select(*tags.columns)
