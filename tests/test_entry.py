"""Driver contract: entry(), queries() and oracle_sql() line up."""

import __spark_entry__ as E
from conftest import SF


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["url_hash", "url", "publisher_id", "title", "publish_time", "pos_time",
                          "variety_rank", "variety", "score", "n_copies"]


def test_every_query_has_an_oracle():
    from quillfeed.plans import catalog

    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())

def test_query_is_deterministic(spark):
    fn = E.queries()["dedup_url_hash"]
    a = sorted(map(tuple, fn(spark, SF).collect()))
    b = sorted(map(tuple, fn(spark, SF).collect()))
    assert a == b and len(a) > 0
