"""Retags and rule lookups that keep little on the disks: slices of keys, few keys and few rules, tables of the asked columns."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace import workspace
from millrace.catalog import bill
from millrace.operators import newest, rules
from millrace.operators import rules as R


def rows(df):
    return sorted(map(str, df.collect()))


def lines(spark, n=600, seed=11):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "b", "c", None, "", f"k{i}", f"k{i // 3}"]), rng.choice([None, 1, 2, 3, 4]), i // 2, rng.choice([None, "", "x", "y"]), rng.choice([None, "p", "q"])) for i in range(n)]
    return spark.createDataFrame(data, "k string, t int, id int, tag string, plan string")


@pytest.mark.parametrize("bypass", [True, False])
@pytest.mark.parametrize("blank", [True, False])
def test_parts_are_the_whole_fill(spark, monkeypatch, bypass, blank):
    """Rows without time, repeated ties and blank keys: few keys in one part, many keys in slices, and the plain fill agree."""
    df = lines(spark)
    args = ("k", "t", "id", ["tag", "plan"], ["plan"], bypass, blank)
    whole = rows(newest.newest_value_fill(df, *args))
    few = newest.newest_value_parts(df, *args)
    assert len(few) == 1 and rows(few[0]) == whole
    assert "Exchange hashpartitioning" not in few[0]._jdf.queryExecution().executedPlan().toString()  # no row is shuffled
    monkeypatch.setattr(newest, "BROADCAST_KEYS", 5)
    one = newest.newest_value_parts(df, *args)
    sliced = newest.newest_value_parts(df, *args, slice_rows=100)
    assert len(one) == 1 and rows(one[0]) == whole
    assert len(sliced) == 6 and max(p.count() for p in sliced) < 300
    assert rows(workspace.settle_parts(sliced)) == whole


def test_parts_leave_no_shuffle_files(spark):
    """The shuffles of one part are gone before the next part is written."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: blocks.getAllFiles().mkString("\n").count("shuffle_")
    before = shuffles()
    parts = [spark.range(20_000).filter(f"id % 3 = {n}").groupBy((F.col("id") % 500).alias("k")).count() for n in range(3)]
    assert workspace.settle_parts(parts).agg(F.sum("count")).first()[0] == 20_000
    assert shuffles() <= before
    assert spark.conf.get(workspace.CLEANUP, "false") == "false"


def test_few_and_many_rules_agree(spark, monkeypatch):
    table = rules.rule_table(spark, [
        (2, "r", "res%", "o1", "low"), (1, "r", "%9", "o1", "high"), (3, "r", "x%", "o1", "x"), (None, "r", "%7", "o1", "first"), (4, "r", "_es8", "o1", None),
        (1, "r", "%", "o3", None), (1, "r", None, "o1", "z"), (1, "r", "%", None, "z"),
    ])
    frame = spark.createDataFrame([(o, v) for o in ("o1", "o2", "o3", None) for v in ("res19", "res1", "res8", "res7", "x7", "zzz", "", None)], "owner string, res string")
    few = rules.with_pattern_target(frame, "owner", "res", table, "new")
    exact = lambda: rules.with_exact_target(frame, F.col("owner"), table, "original", "new")
    few_exact = rows(exact())
    assert "Exchange" not in few._jdf.queryExecution().executedPlan().toString()
    once = table.filter("priority = 2 OR original = 'o3' AND false")
    sure = rules.with_pattern_target(frame, "owner", "res", once, "new", on_conflict="error")
    got, surely = rows(few), rows(sure)
    for wrong in (table.filter("original = 'o3'"), table.filter("priority < 3 AND original = 'o1'")):
        with pytest.raises(PySparkException, match="several rules match"):
            rules.with_pattern_target(frame, "owner", "res", wrong, "new", on_conflict="error").collect()
    monkeypatch.setattr(R, "FEW", 0)
    assert rows(rules.with_pattern_target(frame, "owner", "res", table, "new")) == got and rows(exact()) == few_exact
    assert rows(rules.with_pattern_target(frame, "owner", "res", once, "new", on_conflict="error")) == surely
    with pytest.raises(PySparkException, match="several rules match"):
        rules.with_pattern_target(frame, "owner", "res", table.filter("original = 'o3'"), "new", on_conflict="error").collect()


def test_a_report_stores_the_columns_it_reads(tables, monkeypatch):
    """A narrow fact has the rows of the complete one and no other column; the complete one serves all that come later."""
    monkeypatch.setattr(workspace, "_STORED", {})
    asked = ("line_id", "tag_group2", "original_group2", "original_project", "net_cost")
    narrow = bill.stored_fact(tables, *asked)
    assert narrow.columns == list(asked)
    (_, by_resource), = next(v for k, v in workspace._STORED.items() if k[1] == "bill-by-resource")
    assert set(by_resource.columns) == {*bill.WORKED, *asked}
    whole = bill.stored_fact(tables)
    assert len(whole.columns) == 40 and rows(narrow) == rows(whole.select(*asked))
    assert bill.stored_fact(tables, "year").columns == ["year"]
    assert [len(v) for k, v in workspace._STORED.items() if k[1] == "bill-fact"] == [2]
