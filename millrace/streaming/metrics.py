"""Expectation counts of running streams, taken while the rows pass by.

The counts are observed columns of the stream itself (``DataFrame.observe``): nothing is read twice, and rows
that a later rule drops are counted all the same. Spark reports them with the progress of every micro-batch, and
:func:`record` writes them down as the events of one update of one dataset, in a folder of their own, so that a
repeated update overwrites its own events.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENT = "timestamp timestamp, event_type string, origin struct<update_id: string, dataset: string, batch: bigint>, details string"
EXPECTATIONS = "array<struct<name: string, dataset: string, passed_records: bigint, failed_records: bigint>>"
_TOTAL = "mr_rows"
#: Micro-batches of one run whose progress a session remembers; Spark's own default is 100.
REMEMBERED = 10_000


def observed(rows: DataFrame, dataset: str, rules: Mapping[str, Column]) -> DataFrame:
    """The same rows; the passed ones of each rule are counted on the way. A null condition counts as failed."""
    passed = [F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    return rows.observe(dataset, F.count(F.lit(1)).alias(_TOTAL), *passed)


def remember(spark: SparkSession) -> None:
    """Keep the progress of more micro-batches than Spark does by default; call before a stream starts."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(REMEMBERED))


def record(query: StreamingQuery, dataset: str, log: str, update: str) -> None:
    """Write the counts of a finished run: one event for each micro-batch that had rows.

    A run whose first micro-batches are no longer remembered stops here, because its counts would be too low.
    """
    spark = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active()
    progress = [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]
    batches = sorted({p["batchId"] for p in progress})
    if batches and (len(progress) >= REMEMBERED or batches[-1] - batches[0] + 1 != len(batches)):
        raise ValueError(f"progress of {dataset} is incomplete; take more files at once")
    events = []
    for p in progress:
        counts = dict((p.get("observedMetrics") or {}).get(dataset) or {})
        total = counts.pop(_TOTAL, 0)
        if total:
            found = [{"name": n, "dataset": dataset, "passed_records": c, "failed_records": total - c} for n, c in counts.items()]
            details = json.dumps({"flow_progress": {"data_quality": {"expectations": found}}})
            events.append((p["timestamp"], "flow_progress", (update, dataset, p["batchId"]), details))
    shape = EVENT.replace("timestamp timestamp", "timestamp string")
    rows = spark.createDataFrame(events, shape).withColumn("timestamp", F.to_timestamp("timestamp"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{log}/update={update}/flow={dataset}")


def expectation_counts(events: DataFrame) -> DataFrame:
    """dataset, name, passed_records, failed_records over the flow events given (of one update, say)."""
    path = "$.flow_progress.data_quality.expectations"
    found = events.filter("event_type = 'flow_progress'").select(F.explode(F.from_json(F.get_json_object("details", path), EXPECTATIONS)).alias("e"))
    return found.groupBy("e.dataset", "e.name").agg(*[F.sum(f"e.{c}").alias(c) for c in ("passed_records", "failed_records")])
