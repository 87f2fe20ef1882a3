"""The monthly cost run as one job that may be broken off and run again.

A run reads what is published, writes everything new into a folder of its own, and then publishes all of it
by one step: one small file is added to the ledger. Readers look up the newest entry of the ledger, so they see the
state before the run or after it, never a part of it. Months once archived are neither computed nor written again; a month that
has been run is left alone by a second run, and a run that was lost half way leaves files that nobody looks up.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans import usage as U
from millrace.workspace import exists

LEDGER = "version bigint, as_of date, name string, path string"


@dataclass(frozen=True)
class Inputs:
    """What a run reads: usage records, prices, contracts, and the rules for groups."""

    usage: DataFrame
    contract_prices: DataFrame
    list_prices: DataFrame
    contracts: DataFrame
    remap: Sequence[tuple[str, Sequence[str], Sequence[str]]]
    rules: Sequence[U.GroupRule]
    rolled: Sequence[str]
    root: str
    root_key: str = "group"
    root_value: str = "CORE"


class Published:
    """Tables of a folder that change together: each is a list of written parts, named by the newest ledger entry."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def entries(self) -> list:
        """Rows of the newest version; none before the first run. A version has a row a part, so a few a month."""
        if not exists(self.spark, f"{self.folder}/ledger"):
            return []
        ledger = self.spark.read.schema(LEDGER).parquet(f"{self.folder}/ledger")
        return ledger.join(ledger.agg(F.max("version").alias("version")), "version", "left_semi").collect()

    def table(self, name: str) -> DataFrame | None:
        paths = [r["path"] for r in self.entries() if r["name"] == name]
        return self.spark.read.parquet(*paths) if paths else None

    def months(self) -> set[dt.date]:
        """Months whose runs are published."""
        return {r["as_of"] for r in self.entries() if r["name"] == "run"}

    def switch(self, rows: list[tuple]) -> None:
        """The only step that readers see: a file with all rows of the next version."""
        self.spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(f"{self.folder}/ledger")


def run_month(store: Published, inputs: Inputs, as_of: dt.date, fail_before_switch: bool = False) -> bool:
    """Publish the state as of a month; false if that month has been run and nothing was done.

    Archived are all months before ``as_of`` that no earlier run has archived, with the tags known by the end of the month of ``as_of``;
    entities without newer records keep the tags they had. ``fail_before_switch`` breaks the run off where it would publish.
    """
    month = as_of.replace(day=1)
    after = (month + dt.timedelta(days=32)).replace(day=1)
    entries = store.entries()
    if month in {r["as_of"] for r in entries if r["name"] == "run"}:
        return False
    folder = f"{store.folder}/runs/{month:%Y-%m}-{uuid.uuid4().hex[:8]}"
    spark = store.spark

    def stage(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def before(name: str) -> DataFrame | None:
        paths = [r["path"] for r in entries if r["name"] == name]
        return spark.read.parquet(*paths) if paths else None

    usage = inputs.usage.filter(F.col("usage_date") < F.lit(after))
    tags, old_tags = U.latest_tags(usage, inputs.remap), before("tags")
    tags = stage(tags if old_tags is None else U.tag_history(old_tags, tags), "tags")

    # months at or after the first one not archived yet; literals, so the scan of the usage is cut as well
    kept = [r["as_of"] for r in entries if r["name"] == "run"]
    fresh = usage if not kept else usage.filter(F.col("usage_date") >= F.lit(max(kept)))
    fact = U.daily_fact(fresh, inputs.contract_prices, inputs.list_prices, tags, inputs.rules)
    current = stage(fact.filter(F.col("usage_date") >= F.lit(month)), "current")
    stage(fact.filter(F.col("usage_date") < F.lit(month)), "archive")
    spark_archive = [r["path"] for r in entries if r["name"] == "archive"] + [f"{folder}/archive"]

    def terms(part: DataFrame, name: str) -> DataFrame:
        cost = stage(U.monthly_cost(part, inputs.rolled, inputs.root), f"cost-{name}")
        return stage(U.with_contract_terms(cost, inputs.contracts, inputs.root_key, inputs.root_value), f"terms-{name}")

    terms(spark.read.parquet(f"{folder}/archive"), "archive")
    terms_archive = [r["path"] for r in entries if r["name"] == "terms-archive"] + [f"{folder}/terms-archive"]
    running = stage(U.cumulative(spark.read.parquet(*terms_archive), terms(current, "current")), "cumulative")
    stage(U.dashboard(running), "dashboard")
    if fail_before_switch:
        raise RuntimeError("broken off before the switch")

    parts = [("archive", p) for p in spark_archive] + [("terms-archive", p) for p in terms_archive]
    parts += [(n, f"{folder}/{n}") for n in ("tags", "current", "terms-current", "cumulative", "dashboard")]
    version = max((r["version"] for r in entries), default=0) + 1
    runs = [(version, d, "run", "") for d in sorted({*kept, month})]
    store.switch(runs + [(version, month, n, p) for n, p in parts])
    return True


def whole_fact(store: Published) -> DataFrame:
    """Archived months and the open one."""
    return U.full_fact(store.table("archive"), store.table("current"))
