"""Run registered queries beside DuckDB and compare names, types and values."""

from __future__ import annotations

import math

import duckdb

from millrace.catalog.registry import REGISTRY, TABLES, run

KINDS = {
    "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def connect(root: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        if value == 0:
            return "0.0"
    return repr(value)


def compare(spark, con, root: str, name: str) -> list[str]:
    """Differences between the Spark result and the SQL result; empty if none."""
    df = run(name, spark, root)
    rows = [tuple(r) for r in df.collect()]
    sql = REGISTRY[name].sql
    if sql is None:
        return [] if rows else ["no rows"]
    relation = con.sql(sql)
    names = list(relation.columns)
    kinds = dict(zip(names, map(str, relation.types)))
    expected = relation.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field_name, dtype in df.dtypes:
        want = KINDS.get(dtype, dtype)
        if kinds[field_name] != want:
            problems.append(f"type of {field_name}: spark {dtype}, sql {kinds[field_name]}")
    order = sorted(names)
    left_at = [df.columns.index(n) for n in order]
    right_at = [names.index(n) for n in order]
    left = sorted(tuple(_plain(r[i]) for i in left_at) for r in rows)
    right = sorted(tuple(_plain(r[i]) for i in right_at) for r in expected)
    if len(left) != len(right):
        problems.append(f"rows: spark {len(left)}, sql {len(right)}")
    if left != right:
        left_set, right_set = set(left), set(right)
        only_l = [r for r in left if r not in right_set][:3]
        only_r = [r for r in right if r not in left_set][:3]
        problems.append(f"values in {order}: spark only {only_l}; sql only {only_r}")
    return problems
