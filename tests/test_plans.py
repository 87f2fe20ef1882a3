"""Invariants of the products and properties of their physical plans."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from millrace import catalog
from millrace.catalog import bill, registry, usage
from millrace.catalog import standins as S
from millrace.plans import bill as B
from millrace.operators.changes import merge_into
from millrace.operators.layout import clustered
from millrace.workspace import base_dir
from tests.conftest import SMALL

catalog.load()


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_adjustments_sum_to_zero(tables):
    fact = bill.stored_fact(tables)
    for rows in (
        B.plan_adjustments(B.plan_benefit(fact, bill.commitments(tables))),
        B.node_adjustments(B.node_benefit(B.node_usage(fact, bill.RESERVED))),
    ):
        worst = rows.groupBy("year", "month").agg(F.abs(F.sum("net_cost")).alias("d")).agg(F.max("d")).first()[0]
        assert worst < 1e-6


def test_retagging_keeps_every_line(tables):
    before, after = bill.norm(tables), bill.stored_fact(tables)
    assert after.count() == before.count() == after.select("line_id").distinct().count()


def test_fact_cost_equals_usage_cost(tables):
    whole = usage.stored_fact(tables).agg(F.sum("quantity")).first()[0]
    assert whole == S.usage(tables).agg(F.sum("quantity")).first()[0]


def test_filters_and_columns_reach_the_scan(tables):
    text = plan_of(tables.lineitem.filter("l_shipdate >= '2000-01-01'").groupBy("l_suppkey").agg(F.sum("l_quantity")))
    assert "GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp>" in text


def test_no_window_over_raw_keys_and_no_nested_loops(tables):
    for name in ("win_01", "win_05", "win_07", "cur_04", "cur_05", "cur_08", "dbu_02", "jon_10", "jon_12", "dbu_09"):
        text = plan_of(registry.REGISTRY[name].build(tables))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        if not name.startswith("jon"):
            assert "\nWindow" not in text and ") Window" not in text, name


def test_no_cross_joins_anywhere_in_relational_queries(tables):
    for name in registry.REGISTRY:
        if name.startswith(("jon_0", "jon_1", "agg", "dbu_1", "cur_1", "cur_2", "shp")) and name not in ("jon_17", "jon_18"):
            text = plan_of(registry.REGISTRY[name].build(tables))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_a_cluster_needs_a_shared_folder():
    class Session:
        conf = {}

        class sparkContext:
            master, applicationId = "spark://host:1", "app"

    with pytest.raises(ValueError):
        base_dir(Session)


def test_clustering_tells_large_keys_apart(spark):
    rows = spark.range(400_000).select((F.col("id") * 7919 % 400_000).alias("a"), (F.col("id") % 1000).alias("b"))
    placed = clustered(rows, ["a", "b"], files=16).withColumn("file", F.spark_partition_id())
    spans = placed.groupBy("file").agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")).agg(F.avg("a"), F.avg("b")).first()
    assert spans[0] < 240_000 and spans[1] < 600  # of 400,000 and 1,000; sampled bounds cut across cells


def test_no_full_outer_joins_in_merges_and_flags(tables):
    for name in ("dml_03", "dml_05", "dml_06", "shp_02"):
        assert "FullOuter" not in plan_of(registry.REGISTRY[name].build(tables)), name


def test_merge_with_null_target_keys(spark):
    target = spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), F.lit(1).alias("v"))
    source = spark.createDataFrame([(10, 2), (11, 3)], "k long, v int")
    merged = merge_into(target, source, ["k"])
    assert merged.count() == 1001 and {(r.k, r.v) for r in merged.filter("v > 1").collect()} == {(10, 2), (11, 3)}
    assert merged.filter("k is null").count() == 900


def test_registered_names_and_sql():
    assert len(registry.REGISTRY) > 270
    assert SMALL.endswith("sf0.001")
