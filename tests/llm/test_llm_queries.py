"""Registered text queries against their SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from millrace.llm import queries
from tests.conftest import SMALL
from tests.oracle import _plain, connect


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query(spark, name):
    df = queries.queries()[name](spark, SMALL)
    found = connect(SMALL).sql(queries.oracle_sql()[name])
    assert sorted(df.columns) == sorted(found.columns)
    plain = lambda rows: sorted(tuple(_plain(r[i]) for i in range(len(r))) for r in rows)
    assert plain(df.select(sorted(df.columns)).collect()) == plain(found.select(*sorted(found.columns)).fetchall())


def test_pipeline(spark):
    docs = queries.table(spark, SMALL, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        rows = docs.count()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and 0 < rows <= before, name
        before = rows
    out = corpus_pipeline.run(spark, SMALL)
    assert out.filter("not round_trip").count() == 0 and out.count() == before
