"""Rule tables: ordered pattern rules applied to columns.

A rule table has the columns ``priority, kind, pattern, original, new``.
Patterns are SQL LIKE patterns.  Rules are matched against the *distinct*
values of the data, never row by row, and reach the rows by an equality join,
so neither side has to be small; only a few rules are written out as one expression.  A value does not meet every rule of its owner either: each
pattern is filed under a literal piece of it, and LIKE is tried on values that hold the piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_SCHEMA = "priority int, kind string, pattern string, original string, new string"


def rule_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), RULE_SCHEMA)


def ordered_case(cases: Sequence[tuple[Column, Column | str]], otherwise: Column) -> Column:
    """First true condition wins; written rules become one CASE expression."""
    result = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return otherwise if result is None else result.otherwise(otherwise)


def matches_any(column: Column, patterns: Sequence[str]) -> Column:
    """True when the column is LIKE one of the patterns."""
    result = F.lit(False)
    for pattern in patterns:
        result = result | column.like(pattern)
    return result


#: So many rules are written into one expression, or sent to every task, and the rows are not shuffled.
FEW = 100


def _few(rules: DataFrame) -> list | None:
    """The rows of a short rule table; None for a long one."""
    rows = rules.limit(FEW + 1).collect()
    return rows if len(rows) <= FEW else None


#: Longest piece by which a pattern is filed: at its beginning or end, or anywhere.
EDGE, INNER = 8, 4


def _piece(pattern: Column) -> Column:
    """Where (start, end, any, none) and by which literal text a pattern is filed: its longest sure piece."""
    plain = ~F.contains(pattern, F.lit("\\"))  # an escaped wildcard is no piece; such patterns are tried on everything
    head = F.left(F.regexp_extract(pattern, "^[^%_]*", 0), F.lit(EDGE))
    tail = F.right(F.regexp_extract(pattern, "[^%_]*$", 0), F.lit(EDGE))
    inner = F.left(F.reduce(F.split(pattern, "[%_]"), F.lit(""), lambda best, p: F.when(F.length(p) > F.length(best), p).otherwise(best)), F.lit(INNER))
    filed = lambda place, text: F.struct(F.lit(place).alias("place"), text.alias("text"))
    return (
        F.when(plain & (F.length(head) > 0) & (F.length(head) >= F.length(tail)), filed("start", head))
        .when(plain & (F.length(tail) > 0), filed("end", tail))
        .when(plain & (F.length(inner) > 0), filed("any", inner))
        .otherwise(filed("none", F.lit("")))
    )


def like_candidates(values: DataFrame, owner: str, value: str, rules: DataFrame, rule_owner: str, pattern: str) -> DataFrame:
    """Each (owner, value) with the rules of that owner whose filed piece it holds; all columns of both, no pair twice.

    A value is looked up under its beginnings, ends and inner pieces of the lengths that are in use (at most
    ``2 * EDGE + INNER + 1`` of them).
    """
    filed = rules.withColumn("_piece", _piece(F.col(pattern)))
    used = filed.select("_piece.place", F.length("_piece.text").alias("n")).distinct().collect()
    pieces = []
    for place, n in ((r["place"], r["n"]) for r in used):
        text = F.col(value)
        if place == "any":
            found = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))  # noqa: B023
            pieces.append(F.transform(F.array_distinct(found), lambda p: F.struct(F.lit("any").alias("place"), p.alias("text"))))
        else:
            cut = {"start": F.left(text, F.lit(n)), "end": F.right(text, F.lit(n)), "none": F.lit("")}[place]
            pieces.append(F.array(F.struct(F.lit(place).alias("place"), cut.alias("text"))))
    if not pieces:
        pieces = [F.array(F.struct(F.lit("none").alias("place"), F.lit("").alias("text")))]
    asked = values.withColumn("_held", F.explode(F.array_distinct(F.concat(*pieces))))
    same = (F.col(owner) == F.col(rule_owner)) & (F.col("_held.place") == F.col("_piece.place")) & (F.col("_held.text") == F.col("_piece.text"))
    return asked.join(filed, same).drop("_held", "_piece")


def pattern_targets(
    df: DataFrame, owner: str, value: str, rules: DataFrame, on_conflict: str = "priority"
) -> DataFrame:
    """Rule result for each distinct (owner, value): ``owner, value, new``.

    A rule applies when its ``original`` equals the owner and the value is LIKE
    its ``pattern``.  With several matches the lowest priority number wins, or
    with ``on_conflict="error"`` different results stop the job.
    """
    pairs = df.select(F.col(owner).alias("_rule_owner"), F.col(value).alias("_rule_value")).distinct()
    rules = rules.select("priority", "pattern", "original", "new")
    hit = like_candidates(pairs, "_rule_owner", "_rule_value", rules, "original", "pattern").filter(F.expr("_rule_value LIKE pattern"))
    best = hit.groupBy("_rule_owner", "_rule_value").agg(
        F.min_by("new", F.struct("priority", "new")).alias("_rule_new"),
        F.min("new").alias("_rule_low"),
        F.max("new").alias("_rule_high"),
    )
    if on_conflict == "error":
        clash = F.raise_error(F.concat(F.lit("several rules match "), F.col("_rule_value"))).cast("string")
        best = best.withColumn("_rule_new", F.when(F.col("_rule_low") == F.col("_rule_high"), F.col("_rule_new")).otherwise(clash))
    return best.select("_rule_owner", "_rule_value", "_rule_new")


def _written_target(rows: Sequence, owner: Column, value: Column, on_conflict: str) -> Column:
    """The result of :func:`pattern_targets` as one expression over the rules."""
    ordered = sorted(rows, key=lambda r: (r["priority"] is not None, r["priority"] or 0, r["new"] is not None, r["new"] or ""))
    new = [F.lit(r["new"]).cast("string") for r in ordered]
    hit = [(owner == F.lit(r["original"])) & value.like(r["pattern"]) for r in ordered]
    best = ordered_case(list(zip(hit, new)), F.lit(None).cast("string"))
    if on_conflict != "error" or not hit:
        return best
    found = F.array_compact(F.array(*[F.when(h, n) for h, n in zip(hit, new)]))
    clash = F.raise_error(F.concat(F.lit("several rules match "), value)).cast("string")
    same = F.array_min(found) == F.array_max(found)
    return F.when(F.coalesce(F.greatest(*hit, F.lit(False)), F.lit(False)), F.when(same, best).otherwise(clash))


def with_pattern_target(
    df: DataFrame, owner: str, value: str, rules: DataFrame, output: str, on_conflict: str = "priority"
) -> DataFrame:
    """Add the matching rule's ``new`` as ``output``, null where none matches.

    A few rules become one CASE expression. Of many, the results of the distinct values are joined to the rows, and
    values of owners without a rule are left out before they are told apart.
    """
    rules = rules.select("priority", "pattern", "original", "new")
    few = _few(rules.filter("pattern IS NOT NULL AND original IS NOT NULL"))
    if few is not None:
        return df.withColumn("_rule_new", _written_target(few, F.col(owner), F.col(value), on_conflict)).select(*df.columns, F.col("_rule_new").alias(output))
    ruled = df.join(rules.select(F.col("original").alias(owner)).distinct(), owner, "left_semi")
    targets = pattern_targets(ruled, owner, value, rules, on_conflict)
    joined = df.join(
        targets, (F.col(owner) == F.col("_rule_owner")) & (F.col(value) == F.col("_rule_value")), "left"
    )
    return joined.select(*df.columns, F.col("_rule_new").alias(output))


def with_exact_target(df: DataFrame, key: Column, rules: DataFrame, match: str, output: str) -> DataFrame:
    """Add ``new`` of the first rule whose ``match`` column equals ``key``; a few rules are sent to every task."""
    first = rules.groupBy(F.col(match).alias("_rule_match")).agg(
        F.min_by("new", F.struct("priority", "new")).alias("_rule_new")
    )
    if _few(rules.select(match)) is not None:
        first = F.broadcast(first)
    return df.join(first, key == F.col("_rule_match"), "left").select(*df.columns, F.col("_rule_new").alias(output))


def suffix_lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: Column, text: str
) -> DataFrame:
    """Left join where right ``text`` ends with the left ``value`` and ``keys`` agree."""
    right = right.select(*[F.col(c).alias(c if c not in keys else f"_r_{c}") for c in right.columns])
    on = F.endswith(F.col(text), F.col("_suffix"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return left.withColumn("_suffix", value).join(right, on, "left").drop("_suffix", *[f"_r_{k}" for k in keys])


def rule_conflicts(rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that lead to more than one rule row; an empty result is the good case."""
    return (
        rules.groupBy(*keys)
        .agg(F.min("new").alias("lowest"), F.max("new").alias("highest"), F.count(F.lit(1)).alias("rules"))
        .filter("rules > 1")
    )
