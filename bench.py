"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (input folder), ``BENCH_CPUS`` (local cores),
``BENCH_QUERIES`` (comma-separated names; default is the headline list, ``all``
runs every registered query).
"""

from __future__ import annotations

import json
import os
import sys
import time

from millrace import catalog
from millrace.catalog import bill, standins, usage
from millrace.catalog.registry import Tables, run
from millrace.session import local_session

#: Tables that several queries read; built first and timed on lines of their own.
STORED = {"stored_bill_source": standins.bill_source, "stored_bill_fact": bill.stored_fact, "stored_usage_fact": usage.stored_fact}

HEADLINE = [
    # relational core
    "src_02", "flt_08", "flt_09", "jon_02", "jon_05", "jon_06", "jon_07", "jon_12", "jon_13", "jon_14",
    "agg_07", "agg_12", "agg_14", "agg_22", "agg_25", "win_01", "win_02", "win_05", "win_08", "ord_04", "set_03",
    # changes and writes
    "dml_03", "dml_07", "dml_08", "dml_10", "ver_01", "snk_10", "snk_18",
    # streams
    "stm_11", "stm_14", "stm_18",
    # products
    "shp_01", "shp_02", "shp_03", "shp_05", "dbu_02", "dbu_06", "dbu_11", "dbu_12", "dbu_15",
    "cur_01", "cur_05", "cur_06", "cur_08", "cur_10", "cur_13", "cur_16", "cur_20", "cur_22",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    registered = catalog.load()
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(registered) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = local_session(cpus, "millrace-bench")
    spark.read.parquet(f"{root}/nation.parquet").count()  # start-up is not a query
    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}
    stored = STORED if not asked else {}
    for name in [*stored, *names]:
        start = time.perf_counter()
        try:
            # every column of every row is computed, nothing is sent to the driver
            df = stored[name](Tables(spark, root)) if name in stored else run(name, spark, root)
            df.write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # noqa: BLE001
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
        print(f"{name} {seconds.get(name, 'failed')}", file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(root.rstrip("/")), "cpus": cpus,
    }
    if failed:
        result["failed"] = failed
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
