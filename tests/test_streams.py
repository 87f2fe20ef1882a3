"""Change capture and refresh on small hand-made feeds."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.streaming import cdc, ingest, joins, metrics, refresh
from millrace.workspace import fresh_path

SHAPE = refresh.CUSTOMER_SHAPE


def change(key, name, operation, at, email="a@b.com"):
    return (key, name, email, "S1", operation, str(at))


def deliver(spark, path, changes):
    spark.createDataFrame(changes, SHAPE).coalesce(1).write.mode("append").json(path)


def state_after(spark, *deliveries):
    path, state, checkpoint = (fresh_path(spark, n) for n in ("feed", "state", "check"))
    for changes in deliveries:
        deliver(spark, path, changes)
        feed = refresh.clean_changes(ingest.stream_files(spark, path, SHAPE)).withColumn("sequence", F.col("timestamp").cast("bigint"))
        cdc.apply_changes(feed, ["customer_id"], ["sequence", "operation"], state, checkpoint)
    read = cdc.read_state(spark, state)
    shown = cdc.visible(read, ["customer_id"], ["sequence", "operation"], F.col("operation") == "DELETE")
    folded = cdc.compact(spark, state, ["customer_id"], ["sequence", "operation"], fresh_path(spark, "compact"))
    again = cdc.visible(folded, ["customer_id"], ["sequence", "operation"], F.col("operation") == "DELETE")
    names = sorted((r["customer_id"], r["name"]) for r in shown.collect())
    assert names == sorted((r["customer_id"], r["name"]) for r in again.collect())
    return names


def test_change_capture_cases(spark):
    got = state_after(
        spark,
        [change("1", "new", "NEW", 1), change("2", "b", "NEW", 1), change("3", "c", "NEW", 1), change("6", None, "NEW", 1)],
        [
            change("1", "upd", "UPDATE", 5), change("2", None, "DELETE", 9, None), change("3", None, "DELETE", 4, None),
            change("4", "bad mail", "NEW", 1, "nope"), change("5", "no operation", None, 1),
        ],
        [
            change("1", "late", "UPDATE", 3),  # older than what is stored
            change("2", "late", "UPDATE", 8),  # older than the deletion: stays deleted
            change("3", "back", "NEW", 7),  # inserted again after the deletion
            change("1", "upd", "UPDATE", 5),  # delivered twice
        ],
    )
    assert got == [("1", "upd"), ("3", "back"), ("6", None)]


def test_change_folders_are_folded(spark):
    """Seven deliveries with two to a generation: every change is in, and no more than four folders are kept."""
    path, state, checkpoint = (fresh_path(spark, n) for n in ("feed", "state", "check"))
    for at in range(1, 8):
        deliver(spark, path, [change("all", f"at {at}", "UPDATE", at), change(str(at), "own", "NEW", at)])
        feed = ingest.stream_files(spark, path, SHAPE).withColumn("sequence", F.col("timestamp").cast("bigint"))
        cdc.apply_changes(feed, ["customer_id"], ["sequence"], state, checkpoint, fold=2)
        seen = cdc.visible(cdc.read_state(spark, state), ["customer_id"], ["sequence"], F.lit(False))
        assert {(r["customer_id"], r["name"]) for r in seen.collect()} == {("all", f"at {at}"), *((str(n), "own") for n in range(1, at + 1))}
    assert spark.read.parquet(state).select("slot", "batch").distinct().count() == 4


def test_window_state_is_dropped(spark):
    path, out = fresh_path(spark, "feed"), fresh_path(spark, "windows")
    for day in (1, 5, 9, 13):
        spark.createDataFrame([(day, f"2024-01-{day:02d} 00:00:00")], "n int, at string").coalesce(1).write.mode("append").json(path)
        rows = ingest.watermarked(ingest.stream_files(spark, path, "n int, at timestamp"), "at", "2 days")
        total = rows.groupBy(F.window("at", "1 day").alias("w")).agg(F.sum("n").alias("n")).select(F.col("w.start").alias("day"), "n")
        run = ingest.aggregate_updates(total, ["day"], f"{out}/data", f"{out}/check", fold=2)
        assert run.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    assert sorted(r["n"] for r in ingest.newest_windows(spark, f"{out}/data", ["day"]).collect()) == [1, 5, 9, 13]


def test_state_of_a_stream_join_stays_bounded(spark):
    """Twelve months in twelve deliveries, a range of ten days: state stops growing, all matches inside the range are found and none outside."""
    left, right, out = (fresh_path(spark, n) for n in ("left", "right", "joined"))
    span = joins.Range(before="0 days", after="10 days", delay="31 days")
    held = []
    for month in range(1, 13):
        day = lambda d: f"2023-{month:02d}-{d:02d} 00:00:00"  # noqa: B023, E731
        orders = [(month * 100 + i, day(1 + i)) for i in range(20)]
        # shipped at once, after ten days, after twenty, in the next month (never in range), and without a time
        lines = [(key, at) for key, at in orders]
        lines += [(month * 100 + i, day(11 + i)) for i in range(10)] + [(month * 100 + 1, day(22)), (month * 100 - 100, day(28)), (month * 100 + 2, None)]
        spark.createDataFrame(lines, "line string, at string").coalesce(1).write.mode("append").json(left)
        spark.createDataFrame(orders, "key string, ordered string").coalesce(1).write.mode("append").json(right)
        a = ingest.stream_files(spark, left, "line string, at timestamp")
        b = ingest.stream_files(spark, right, "key string, ordered timestamp")
        query = ingest.append(joins.join_in_range(a, b, [("line", "key")], "at", "ordered", span), f"{out}/data", f"{out}/check")
        held.append(joins.state_rows(query)[-1])
    assert spark.read.parquet(f"{out}/data").count() == 12 * 30
    assert max(held[4:]) <= max(held[:4]) and held[-1] < 4 * 53


def test_expectations_of_a_refresh_are_observed(spark):
    """Counts of each dataset, rule and update; a second update counts only what is new, and dropped rows count as failed."""
    landing, out = fresh_path(spark, "landing"), fresh_path(spark, "refresh")

    def land(orders, status, people):
        spark.createDataFrame(orders, refresh.ORDER_SHAPE).write.mode("append").json(f"{landing}/orders")
        spark.createDataFrame(status, refresh.STATUS_SHAPE).write.mode("append").json(f"{landing}/status")
        spark.createDataFrame(people, SHAPE).write.mode("append").json(f"{landing}/customers")

    def counts(update=None):
        return {(r["dataset"], r["name"]): (r["passed_records"], r["failed_records"]) for r in refresh.expectation_counts(spark, out, update).collect()}

    day = 1_700_000_000
    land([(1, 1, "Y", day)], [(1, "placed", day), (1, "lost", None)], [change("1", "Ann", "NEW", 1), change("2", None, "NEW", 1), change("3", "C", "NEW", 1, "nope")])
    refresh.run(spark, landing, out, "2024-01-01", update="a")
    first = counts("a")
    assert first["orders", "valid_date"] == (1, 0) and first["status", "valid_timestamp"] == (1, 1)
    assert first["customers", "valid_email"] == (2, 1) and first["customers", "valid_name"] == (2, 1) and first["customers", "valid_id"] == (3, 0)
    land([(2, 1, "Y", day)], [(2, "placed", day)], [change("1", "Anna", None, 2)])
    refresh.run(spark, landing, out, "2024-01-02", update="b")
    assert counts("a") == first and counts("b")["customers", "valid_operation"] == (0, 1) and counts("b")["status", "valid_timestamp"] == (1, 0)
    assert counts()["status", "valid_timestamp"] == (2, 1)
    assert spark.read.schema(metrics.EVENT).parquet(f"{out}/events").filter("event_type = 'flow_progress'").select("origin.update_id").distinct().count() == 2


def test_missing_id_stops_the_stream(spark):
    with pytest.raises(PySparkException):
        state_after(spark, [change(None, "x", "NEW", 1)])


def test_second_refresh_reads_only_new_files(spark):
    landing, out = fresh_path(spark, "landing"), fresh_path(spark, "refresh")

    def land(orders, status, people):
        spark.createDataFrame(orders, refresh.ORDER_SHAPE).write.mode("append").json(f"{landing}/orders")
        spark.createDataFrame(status, refresh.STATUS_SHAPE).write.mode("append").json(f"{landing}/status")
        spark.createDataFrame(people, SHAPE).write.mode("append").json(f"{landing}/customers")

    day = 1_700_000_000
    land([(1, 1, "Y", day)], [(1, "placed", day)], [change("1", "Ann", "NEW", 1)])
    first = refresh.run(spark, landing, out, "2024-01-01")
    assert first["order_updates"].count() == 1
    land([(2, 1, "Y", day), (3, 1, "N", day)], [(2, "placed", day), (2, "lost", None)], [change("1", "Anna", "UPDATE", 2)])
    second = refresh.run(spark, landing, out, "2024-01-02")
    assert sorted((r["order_id"], r["name"]) for r in second["order_updates"].collect()) == [(1, "Anna"), (2, "Anna")]
    assert second["orders_by_date"].agg(F.sum("total_daily_orders")).first()[0] == 3


def test_written_table_is_streamed_in_micro_batches(tables):
    from urllib.parse import urlparse
    from pathlib import Path

    from millrace.catalog.streams import replayed

    out = replayed(tables)
    log = Path(urlparse(out.inputFiles()[0]).path).parent / "_spark_metadata"
    assert [p.name for p in sorted(log.iterdir()) if not p.name.startswith(".")] == ["0", "1", "2"]
    assert out.count() == tables.events.count() and not hasattr(ingest, "replay")


def test_schema_lives_across_runs(spark):
    """A later file adds a column, known types stay, what does not fit is rescued, and a run without new files changes nothing."""
    path, out = fresh_path(spark, "landed"), fresh_path(spark, "ingested")

    def land(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
        return {r["id"]: r for r in ingest.ingest_json(spark, path, out, hints={"when": "timestamp"}).collect()}

    def versions():
        return spark.read.parquet(f"{out}/schema").count()

    got = land('{"id": 1, "n": 5, "when": "2024-01-01 00:00:00"}', '{"id": 2}')
    assert got[1]["n"] == 5 and got[2]["_rescued_data"] is None and versions() == 1
    got = land('{"id": 3, "n": "many", "m": {"a": 1}, "when": "soon"}')
    assert got[3]["n"] is None and got[3]["m"]["a"] == 1 and got[1]["m"] is None and versions() == 2
    assert got[3]["_rescued_data"] == '{"n":"many","when":"soon"}'
    assert [f.dataType.simpleString() for f in ingest.logged_schema(spark, path, f"{out}/schema").fields if f.name == "n"] == ["bigint"]
    assert versions() == 2 and len(ingest.ingest_json(spark, path, out).collect()) == 3
