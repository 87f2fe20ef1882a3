"""Edge cases on small literal tables: nulls, ties, duplicates, late data, failures."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.columns import non_blank, packed_rate, truncated
from millrace.operators import changes, layout, newest, quality, rules, running, secure, validity, versions
from millrace.sinks import tables as sink
from millrace.sources import database, files
from millrace.workspace import fresh_path


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# ----------------------------------------------------------------- newest values


def test_fill_frame_and_bypass(spark):
    data = [
        ("r1", 1, 1, "old"), ("r1", 2, 2, "new"), ("r1", 3, 3, None),  # newest row has no tag: stays null
        ("r2", 1, 4, None), ("r2", 2, 5, ""),  # an empty text is a value
        ("", 1, 6, "kept"), (None, 1, 7, None),  # blank keys pass through
    ]
    df = spark.createDataFrame(data, "k string, t int, id int, tag string")
    got = {r["id"]: r["tag"] for r in newest.newest_value_fill(df, "k", "t", "id", ["tag"]).collect()}
    assert got == {1: "new", 2: "new", 3: None, 4: "", 5: "", 6: "kept", 7: None}
    blank = newest.newest_value_fill(df, "k", "t", "id", ["tag"], blank_as_null=True)
    assert {r["id"]: r["tag"] for r in blank.collect()}[4] is None


def test_fill_matches_window_on_random_rows(spark):
    rng = random.Random(7)
    data = [(rng.choice(["a", "b", "c", None, ""]), rng.randint(0, 9), i, rng.choice([None, "", "x", "y"])) for i in range(400)]
    df = spark.createDataFrame(data, "k string, t int, id int, tag string")
    got = newest.newest_value_fill(df, "k", "t", "id", ["tag"], bypass_blank=False)
    # among rows of the same time the greatest id counts, which the brute force repeats
    expected = []
    for k, t, i, _ in data:
        seen = [(t2, i2, tag2) for k2, t2, i2, tag2 in data if k2 == k and t2 >= t and tag2 is not None]
        expected.append((i, max(seen)[2] if seen else None))
    assert rows(got.select("id", "tag")) == sorted(expected)


def test_latest_per_key_with_null_key_and_tie(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y"), (None, 5, 3, "z")], "k string, t int, id int, v string")
    assert rows(newest.latest_per_key(df, ["k"], ["t", "id"]).select("k", "v"), "v") == [("a", "y"), (None, "z")]


def test_running_totals_match_plain_window(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.randint(0, 50), float(rng.randint(-5, 9))) for _ in range(300)]
    df = spark.createDataFrame(data, "k string, t int, v double")
    w = Window.partitionBy("k").orderBy("t")
    plain = rows(df.select("k", "t", F.sum("v").over(w).alias("s")).distinct())
    assert rows(running.running_totals(df, ["k"], ["t"], {"v": F.col("v")}).select("k", "t", "cumulative_v")) == plain
    blocks = running.running_columns_in_blocks(df, ["k"], "t", F.floor(F.col("t") / 7), {"v": F.col("v"), "n": F.lit(1)})
    assert rows(blocks.select("k", "t", "cumulative_v").distinct()) == plain
    assert blocks.count() == df.count()


# -------------------------------------------------------------------- merge jobs

SHIPS = [(10, "Anna", 40.0), (20, "Borealis", 75.5), (30, "Tern", 12.0), (40, "Tide", 30.25), (50, "Vega", 98.0)]


def test_update_delete_and_guarded_merge(spark):
    table = spark.createDataFrame(SHIPS, "id int, name string, value double")
    table = changes.update_where(table, F.col("name").like("T%"), {"value": F.col("value") * 2})
    table = changes.delete_where(table, F.col("value") > 90)
    source = spark.createDataFrame(
        [(20, "Borealis II", 80.0, "update"), (30, "", None, "delete"), (60, "Comet", 15.5, "insert"), (70, "Dawn", 9.0, "update")],
        "id int, name string, value double, type string",
    )
    kind = F.col("s.type")
    merged = changes.merge_into(table, source, ["id"], update_if=kind == "update", delete_if=kind == "delete", insert_if=kind == "insert")
    assert rows(merged) == [(10, "Anna", 40.0), (20, "Borealis II", 80.0), (40, "Tide", 60.5), (60, "Comet", 15.5)]


def test_adding_merge_over_two_keys(spark):
    shape = "name string, metal string, kilos double, wanted boolean"
    stock = [("bolt", "steel", 120.0, True), ("bolt", "brass", 30.0, True), ("nut", "steel", 200.0, True), ("hook", "iron", 7.5, False)]
    table = changes.delete_where(spark.createDataFrame(stock, shape), ~F.col("wanted"))
    new = spark.createDataFrame([("bolt", "brass", 12.5, True), ("nut", "brass", 5.0, True), ("nail", "iron", 3.0, False)], shape)
    merged = changes.merge_into(
        table, new, ["name", "metal"], update={"kilos": F.col("t.kilos") + F.col("s.kilos")}, insert_if=F.col("s.wanted")
    )
    expected = [("bolt", "brass", 42.5), ("bolt", "steel", 120.0), ("nut", "brass", 5.0), ("nut", "steel", 200.0)]
    assert rows(merged.select("name", "metal", "kilos")) == expected


def test_evolving_merge_gains_the_column(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    source = spark.createDataFrame([(2, 5.0), (3, 7.0)], "id int, w double")
    merged = changes.merge_into(target, source, ["id"], evolve=True)
    assert rows(merged) == [(1, "a", None), (2, "b", 5.0), (3, None, 7.0)]
    assert merged.columns == ["id", "v", "w"]


def test_merge_reports_two_source_rows_for_one_target(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string")
    with pytest.raises(PySparkException, match="several source rows"):
        changes.merge_into(target, source, ["id"]).collect()
    assert rows(changes.duplicate_keys(source, ["id"])) == [(1, 2)]


def test_update_and_delete_leave_null_conditions_alone(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    assert rows(changes.delete_where(df, F.col("v") == "x")) == [(1, None)]
    assert rows(changes.update_where(df, F.col("v") != "x", {"v": F.lit("y")})) == [(1, None), (2, "x")]


def test_restore_brings_back_every_kind_of_change(spark):
    log = spark.createDataFrame(
        [(1, 1, "insert", "a"), (2, 1, "insert", "b"), (3, 1, "insert", None), (1, 2, "update", "z"), (2, 2, "delete", None), (4, 2, "insert", "n"), (6, 0, "insert", "x"), (6, 1, "delete", None)],
        "id int, version int, op string, v string",
    )
    back = versions.restore(log, ["id"], 1, 3)
    assert rows(back.select("id", "op")) == [(1, "update"), (2, "insert"), (4, "delete")]
    assert rows(versions.as_of_version(log.unionByName(back), ["id"], 3)) == rows(versions.as_of_version(log, ["id"], 1))


# ------------------------------------------------------------------------- rules


def test_pattern_rules_priority_and_conflict(spark):
    table = rules.rule_table(spark, [(2, "resource", "res%", "o1", "low"), (1, "resource", "%9", "o1", "high"), (3, "resource", "x%", "o1", "x")])
    df = spark.createDataFrame([("o1", "res19"), ("o1", "res1"), ("o2", "res19"), ("o1", None)], "owner string, res string")
    got = rules.with_pattern_target(df, "owner", "res", table, "new")
    assert rows(got, "owner", "res") == [("o1", None, None), ("o1", "res1", "low"), ("o1", "res19", "high"), ("o2", "res19", None)]
    with pytest.raises(PySparkException, match="several rules match"):
        rules.with_pattern_target(df, "owner", "res", table, "new", on_conflict="error").collect()
    assert rules.rule_conflicts(table, ["pattern", "original"]).count() == 0


def test_contract_months_and_price_ranges(spark):
    terms = spark.createDataFrame([("a", "2024-01-15", "2024-04-01"), ("b", "2024-02-01", "2024-02-20"), ("c", "2024-02-02", "2024-02-28")], "id string, f string, t string")
    terms = terms.withColumns({"f": F.to_date("f"), "t": F.to_date("t")})
    months = validity.by_month(terms, "f", "t").select("id", F.col("valid_month").cast("string"))
    assert rows(months) == [("a", "2024-02-01"), ("a", "2024-03-01"), ("a", "2024-04-01"), ("b", "2024-02-01")]
    prices = spark.createDataFrame([("s", "2024-01-01", "2024-01-31", 1.0), ("s", "2024-02-01", None, 2.0)], "sku string, start_date string, end_date string, rate double")
    facts = spark.createDataFrame([("s", "2024-01-31"), ("s", "2024-02-01"), ("s", "2023-01-01"), ("u", "2024-02-01")], "sku string, day string")
    got = validity.valid_at(facts, prices, "sku", "day").select("sku", "day", "rate")
    assert rows(got) == [("s", "2023-01-01", None), ("s", "2024-01-31", 1.0), ("s", "2024-02-01", 2.0), ("u", "2024-02-01", None)]


# ------------------------------------------------------- expectations and masking


def test_expectations_count_null_as_failed_and_can_stop(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    rule = {"positive": F.col("v") > 0}
    assert rows(quality.expectation_metrics(df, "d", rule)) == [("d", "positive", 1, 2)]
    assert quality.expect_or_drop(df, rule).count() == 1
    assert quality.expect(df, rule).count() == 3
    with pytest.raises(PySparkException, match="expectation failed: positive"):
        quality.expect_or_fail(df, rule).collect()


def test_masks(spark):
    df = spark.createDataFrame([("secret", 1), ("a", 2), (None, 3)], "name string, id int")
    masked = df.select(secure.mask_tail(F.col("name")))
    assert [r[0] for r in masked.collect()] == ["****et", "a", None]
    seen = secure.secure_view(df, {"g"}, "g", redacted=["name"], rows=F.col("id") < 3)
    assert rows(seen) == [("REDACTED", 1), ("REDACTED", 2)]
    assert secure.secure_view(df, {"other"}, "g", redacted=["name"]).count() == 3


# ------------------------------------------------------------------------- sinks


def test_generated_and_checked_columns_stop_bad_rows(spark):
    df = spark.createDataFrame([(2, 4), (3, 7)], "a int, double_a int")
    with pytest.raises(PySparkException, match="generated column"):
        sink.with_generated(df, "double_a", F.col("a") * 2).collect()
    with pytest.raises(PySparkException, match="check constraint"):
        sink.with_check(df, "small", F.col("a") < 3).collect()


def test_overwrite_refuses_other_columns(spark):
    path = fresh_path(spark, "checked")
    spark.createDataFrame([(1,)], "a int").write.parquet(path)
    with pytest.raises(ValueError, match="schema differs"):
        sink.overwrite_checked(spark.createDataFrame([("1",)], "a string"), spark, path)
    with pytest.raises(PySparkException):  # breaks half way: the old rows stay
        sink.overwrite_checked(spark.range(9).select(F.when(F.col("id") < 8, 1).otherwise(F.raise_error(F.lit("broken")).cast("int")).alias("a")), spark, path)
    assert rows(spark.read.parquet(path)) == [(1,)]
    table = spark.read.parquet(path)  # a batch may read the table that it replaces
    assert rows(sink.overwrite_checked(table.unionByName(table.select((F.col("a") + 1).alias("a"))), spark, path)) == [(1,), (2,)]
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]


def test_strict_csv_stops_at_bad_line(spark):
    path = fresh_path(spark, "bad-csv")
    spark.createDataFrame([("a,b",), ("1,2",), ("x,y",)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception, match="Malformed records"):
        files.read_csv(spark, path, "a INT, b INT", strict=True).collect()


def test_load_once_takes_every_file_once(spark):
    folder, target, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "checkpoint"))
    load = lambda: sink.load_once(spark, folder, "json", "id bigint", target, checkpoint)
    spark.range(5).coalesce(1).write.json(folder)
    assert rows(load()) == [(i,) for i in range(5)]
    # rows of a batch that never finished
    spark.range(100, 103).write.parquet(f"{target}/lost")
    spark.range(5, 8).coalesce(1).write.mode("append").json(folder)
    assert rows(load()) == rows(load()) == [(i,) for i in range(8)]


def test_z_value_interleaves(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 5)], "a int, b int")
    got = [r[0] for r in df.select(layout.z_value([F.col("a"), F.col("b")], 8)).collect()]
    assert got == [0, 1, 2, 0b100111]


# ----------------------------------------------------------------------- columns


def test_columns(spark):
    df = spark.createDataFrame([("Y,a,b,1.5,4", " ", 2.349)], "tag string, blank string, v double")
    row = df.select(packed_rate("tag"), packed_rate(F.lit("n/a")), non_blank("blank"), truncated(F.col("v"), 2)).first()
    assert tuple(row) == (2.5, None, None, 2.34)


def test_jdbc_readers_pass_their_options():
    """A database of its own process is not started here; only the request is checked."""
    calls = {}

    class Reader:
        def jdbc(self, url, table, **options):
            calls.update(url=url, table=table, **options)

    session = type("Session", (), {"read": Reader()})()
    database.read_partitioned(session, "jdbc:x", "people", "id", 1, 1_000_000, 8, {"user": "u"})
    assert calls["numPartitions"] == 8 and calls["column"] == "id" and calls["upperBound"] == 1_000_000
    database.read_table(session, "jdbc:x", "people", {})
    assert calls["table"] == "people"


def test_month_slice_bounds(spark):
    from millrace.plans.usage import month_slice

    days = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),), (dt.date(2024, 1, 31),), (dt.date(2024, 2, 1),)], "d date")
    count = lambda which: month_slice(days, "d", dt.date(2024, 2, 10), which).count()
    assert (count("current"), count("previous"), count("history")) == (1, 2, 3)


def test_not_in_follows_sql_nulls(spark):
    from millrace.operators.membership import not_in

    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    listed = lambda *values: spark.createDataFrame([(v,) for v in values], "x int")
    assert rows(not_in(df, "v", listed(1, 1), "x")) == [(2,)]
    assert rows(not_in(df, "v", listed(1, None), "x")) == []
    assert not_in(df, "v", listed(), "x").count() == 3


def test_described_function_is_registered(tables):
    from millrace.catalog.scalars import function_description

    assert function_description(tables).first().asDict() == {"parts": tables.part.count(), "described": True}
