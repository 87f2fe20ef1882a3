"""A result that is the same everywhere proves little: no column of a check may be wholly null or constant unless it is named here."""

import pytest

from millrace import catalog
from tests.oracle import connect

ROOT = "/root/testdata/sf0.01"
#: Columns that are one value by their meaning: a literal, an input that has one value, or a mark that is the feature.
SINGLE = {
    "src_23": {"filled"}, "snk_07": {"loaded_at"}, "snk_16": {"discount", "note"}, "snk_18": {"fewer_files"}, "prj_09": {"known"}, "flt_09": {"list"},
    "agg_12": {"event_history"}, "agg_21": {"updated_at"}, "agg_22": {"distinct_sum"}, "str_02": {"missing", "head"}, "str_09": {"no_digits"},
    "dtm_04": {"year", "month"}, "dtm_08": {"month"}, "dtm_12": {"clock_set"}, "map_01": {"absent"}, "jsn_01": {"missing"}, "bin_01": {"bytes"},
    "cur_17": {"service"}, "cur_21": {"tag_group2", "charge_type"}, "cur_22": {"billing_entity", "tag_group2"}, "cur_30": {"family", "service"},
    "set_04": {"like_copy"}, "snk_19": {"stored_part", "repeatable"}, "cur_32": {"usage_month", "hours"}, "agg_04": {"within_bound"}, "agg_23b": {"count", "within_bound"},
}


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.mark.parametrize("name", [n for n, q in catalog.load().items() if q.sql is not None])
def test_columns_vary(con, name):
    relation = con.sql(catalog.load()[name].sql)
    frame = f"({catalog.load()[name].sql})"
    columns = relation.columns
    parts = ", ".join(f'count("{c}"), count(DISTINCT "{c}")' for c in columns)
    rows, *counts = con.sql(f"SELECT count(*), {parts} FROM {frame}").fetchall()[0]
    if rows < 2:
        return
    single = {c for c, filled, values in zip(columns, counts[::2], counts[1::2]) if not filled or (values == 1 and filled == rows)}
    assert single == SINGLE.get(name, set())
