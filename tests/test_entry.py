import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert {r.split for r in rows} == {"train", "validation", "test"}
    assert all(0 < r.wer < 100 for r in rows)


def test_every_query_of_the_library_has_an_oracle():
    from utterflow.plans.catalog import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())
