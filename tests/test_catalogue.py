"""Every query of the catalogue against its SQL in DuckDB."""

import duckdb
import pytest

from probata.plans import catalogue, reports

assert reports  # its queries join the catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(df):
    one = lambda v: None if v is None or v != v else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(str(tuple(one(v) for v in row)) for row in df[sorted(df.columns)].astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    want = duck.execute(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry_runs_without_the_training_data_operators(spark):
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
