"""The monthly run: what a broken run leaves, what a second run changes, what months see."""

import datetime as dt
from pathlib import Path
from urllib.parse import urlparse

import pytest

from millrace.catalog import standins as S
from millrace.catalog import usage as catalog
from millrace.plans import monthly
from millrace.workspace import fresh_path

MAY, JUNE, JULY = (dt.date(2000, m, 1) for m in (5, 6, 7))


@pytest.fixture(scope="module")
def inputs(tables):
    return monthly.Inputs(
        S.usage(tables), S.contract_prices(tables), S.list_prices(tables), catalog.contracts(tables), catalog.REMAP, catalog.RULES, catalog.ROLLED, catalog.ROOT)


def rows(df):
    return sorted(map(str, df.collect()))


def files(folder):
    return sorted(str(p) for p in Path(urlparse(folder).path).rglob("*.parquet"))


def test_broken_and_repeated_runs(spark, inputs):
    store = monthly.Published(spark, fresh_path(spark, "cost"))
    assert store.table("cumulative") is None and store.months() == set()
    with pytest.raises(RuntimeError):
        monthly.run_month(store, inputs, MAY, fail_before_switch=True)
    assert store.table("cumulative") is None  # nothing of it is seen
    assert monthly.run_month(store, inputs, MAY.replace(day=17))
    first = rows(store.table("cumulative"))
    with pytest.raises(RuntimeError):
        monthly.run_month(store, inputs, JUNE, fail_before_switch=True)
    assert rows(store.table("cumulative")) == first and store.months() == {MAY}
    before = files(store.folder)
    assert not monthly.run_month(store, inputs, MAY)
    assert files(store.folder) == before

    assert monthly.run_month(store, inputs, JUNE) and monthly.run_month(store, inputs, JULY)
    assert store.months() == {MAY, JUNE, JULY}
    fact = monthly.whole_fact(store)
    assert fact.filter("usage_date >= '2000-08-01'").count() == 0
    # each month stands in one part, and no archived part was written twice
    archived = store.table("archive").groupBy("year", "month").count()
    assert archived.count() == archived.select("year", "month").distinct().count() == 12 * 5 + 6
    days = fact.groupBy("usage_date", "workspace_id", "sku", "entity_id").count()
    assert days.filter("count > 1").count() == 0


def test_one_run_or_month_by_month(spark, inputs):
    """Cost does not depend on how many runs it took: only tags may, and these are all known."""
    once, steps = (monthly.Published(spark, fresh_path(spark, "cost")) for _ in range(2))
    monthly.run_month(once, inputs, JULY)
    for month in (JUNE, JULY):
        monthly.run_month(steps, inputs, month)
    total = lambda store: [round(r[0], 4) for r in monthly.whole_fact(store).groupBy("year", "month").sum("net_cost").orderBy("year", "month").select("sum(net_cost)").collect()]
    assert total(once) == total(steps)
