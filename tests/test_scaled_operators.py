"""Operators that must stay cheap where one key, one rule owner or one far value stands out."""

import datetime as dt
import fnmatch
import random
import statistics

from pyspark.sql import functions as F

from millrace.operators import layout, rules, validity
from millrace.plans import usage as U


def like(value, pattern):
    return fnmatch.fnmatchcase(value, pattern.replace("%", "*").replace("_", "?"))


def test_many_patterns_of_one_owner(spark):
    """10,000 rules of one owner: a value meets few of them, and the first that fits wins as if it had met all."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    patterns = [rng.choice([f"{word(6)}%", f"%{word(6)}", f"%{word(5)}%", f"{word(2)}%{word(3)}", f"{word(3)}_{word(3)}%"]) for _ in range(9_997)] + ["%", "a%", "%_b"]
    table = spark.createDataFrame([(i, "resource", p, "o1", f"g{i}") for i, p in enumerate(patterns)], rules.RULE_SCHEMA)
    values = [word(rng.choice([5, 8, 9])) for _ in range(150)] + ["", "a", patterns[3].replace("%", "zz").replace("_", "q")]
    frame = spark.createDataFrame([("o1", v) for v in values] + [("o2", "abc"), (None, "abc"), ("o1", None)], "owner string, value string")
    got = {(r.owner, r.value): r.new for r in rules.with_pattern_target(frame, "owner", "value", table, "new").collect()}
    for v in values:
        assert got["o1", v] == next((f"g{i}" for i, p in enumerate(patterns) if like(v, p)), None), v
    assert got["o2", "abc"] is None and got[None, "abc"] is None and got["o1", None] is None
    pairs = frame.distinct()
    met = rules.like_candidates(pairs, "owner", "value", table, "original", "pattern")
    assert met.count() < 40 * len(values)  # of 10,000 a value
    assert met.groupBy("owner", "value", "priority").count().filter("count > 1").count() == 0


def test_escaped_patterns_are_tried_on_everything(spark):
    table = spark.createDataFrame([(1, "r", "10\\%%", "o", "ten")], rules.RULE_SCHEMA)
    frame = spark.createDataFrame([("o", "10% off"), ("o", "10 off")], "owner string, value string")
    assert {r.value: r.new for r in rules.with_pattern_target(frame, "owner", "value", table, "new").collect()} == {"10% off": "ten", "10 off": None}


def test_prices_of_a_hot_key(spark):
    """A key with 1,000 price rows and a third of the facts: no part has three times the median, and facts meet only prices of their month."""
    start = dt.date(1995, 1, 1)
    day = lambda n: start + dt.timedelta(days=n)
    prices = [("hot", day(2 * i), day(2 * i + 1), float(i)) for i in range(999)] + [("hot", day(1998), None, 999.0)]
    prices += [(f"k{i}", start, None, float(i)) for i in range(400)] + [("hot", day(10), day(12), -1.0), ("k1", day(9), day(3), -2.0)]
    facts = [("hot", day(i % 2100)) for i in range(4200)] + [(f"k{i % 400}", day(i % 2100)) for i in range(8400)] + [("none", start), ("hot", None), ("hot", dt.date(1990, 1, 1))]
    table = spark.createDataFrame(prices, "sku string, start_date date, end_date date, rate double")
    frame = spark.createDataFrame(facts, "sku string, day date")
    got = validity.valid_at(frame, table, "sku", "day").groupBy("sku", "day").agg(F.sort_array(F.collect_list("rate")).alias("r"), F.count("*").alias("n")).collect()
    by_key = {}
    for s, a, b, r in prices:
        by_key.setdefault(s, []).append((a, b, r))
    count = {f: facts.count(f) for f in set(facts[:50] + facts[-3:])}
    for row in got:
        found = [r for a, b, r in by_key.get(row.sku, []) if row.day and a <= row.day and (b is None or row.day <= b)]
        if (row.sku, row.day) in count:
            assert row.r == sorted(found * count[row.sku, row.day])
        assert row.n % max(len(found), 1) == 0 and set(row.r) == set(found)
    parts = frame.repartition(16, "sku", F.trunc("day", "month")).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert parts.max() < 3 * statistics.median(parts)
    whole = frame.repartition(16, "sku").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert whole.max() > 3 * statistics.median(whole)  # by the key alone one part has them all


def test_long_validity_ranges_stay_few_rows(spark):
    """Prices open for ten years: their bins make few rows of them, and 150,000 prices are not sent to every task, though Spark expects little of them."""
    prices = spark.range(150_000).select(
        F.col("id").alias("sku"), F.when(F.col("id") % 2 == 0, F.lit("1990-01-01")).otherwise(F.lit("1995-06-15")).cast("date").alias("start_date"),
        F.when(F.col("id") % 3 == 0, F.lit("1999-12-31").cast("date")).alias("end_date"), (F.col("id") % 7).alias("rate"),
    )
    facts = spark.range(4000).select((F.col("id") * 37 % 170_000).alias("sku"), F.date_add(F.lit("1989-06-01").cast("date"), (F.col("id") * 2).cast("int")).alias("day"))
    got = validity.valid_at(facts, prices, "sku", "day")
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    width, made = validity._width(prices, F.col("start_date"), F.coalesce("end_date", F.lit(dt.date(2011, 4, 25))))
    assert 150_000 <= made <= 300_000 and width > 365  # by months they were more than twenty million
    plain = facts.join(prices, "sku", "left").filter("rate IS NULL OR day >= start_date AND (end_date IS NULL OR day <= end_date)")
    inside = lambda df: sorted((r.sku, r.day, r.rate) for r in df.filter("rate IS NOT NULL").collect())
    assert inside(got) == inside(plain) and got.count() == 4000


def spread(df, column, files):
    placed = df.withColumn("file", F.spark_partition_id())
    return placed.groupBy("file").agg((F.max(column) - F.min(column)).alias("w")).agg(F.avg("w")).first()[0]


def test_clustering_is_by_rank(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(10_000), rng.randrange(10_000), f"name-{rng.randrange(500):03d}", start) for start in [dt.date(2020, 1, 1)] * 4000]
    plain = spark.createDataFrame(rows, "a long, b long, c string, d date")
    far = plain.unionByName(spark.createDataFrame([(10**12, 10**12, "zzz", None), (None, None, None, None)], plain.schema))
    near = lambda df: df.filter("a < 1000000")
    for column in ("a", "b"):
        before = spread(layout.clustered(plain, ["a", "b"], files=16), column, 16)
        after = spread(near(layout.clustered(far, ["a", "b"], files=16)), column, 16)
        assert after < 1.2 * before < 0.6 * 10_000
    texts = layout.clustered(far, ["c", "a", "d"], files=16).withColumn("file", F.spark_partition_id())
    assert texts.groupBy("file").agg(F.count_distinct("c").alias("n")).agg(F.avg("n")).first()[0] < 250
    assert sorted(map(str, texts.drop("file").collect())) == sorted(map(str, far.collect()))


def test_overrides_are_folded_in_order(spark):
    table = spark.createDataFrame([
        (1, "entity", "e1", "G1", "A1", True), (1, "pattern", "e1%", "G1", "A1", True), (2, "workspace", "w", "G2", None, False),
        (3, "pattern", "%9", "G3", "A3", True), (4, "entity", "e1", None, "A4", False), (5, "pattern", "e_", "G5", None, True),
    ], U.OVERRIDES)
    fact = spark.createDataFrame([
        ("e1", "w", None, None, 1), ("e1", "v", "X", "a", 2), ("e29", "v", None, "a", 3), ("e29", "w", None, None, 4), (None, "w", "Y", "a", 5), (None, None, None, None, 6), ("e7", "v", "Z", "a", 7),
    ], "entity_id string, workspace_id string, cost_group string, agency string, n int")
    got = {r.n: (r.cost_group, r.agency) for r in U.apply_overrides(fact, table).collect()}
    # step by step: 1 and 2 and 4 empty the group again, which 5 then fills
    assert got == {1: ("G5", "A4"), 2: ("G5", "A4"), 3: ("G3", "A3"), 4: ("G2", None), 5: ("G2", "a"), 6: (None, None), 7: ("Z", "a")}
    assert U.apply_overrides(fact, table.limit(0)).count() == 7
