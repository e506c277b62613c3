import re

import duckdb
import pytest

import __spark_entry__ as entry
from fieldkit.llm import queries
from fieldkit.sources.tables import TABLES

SMALL = "/root/testdata/sf0.001"


def test_one_query_per_operator_and_the_pipeline():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(queries.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    res = con.execute(queries.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    df = queries.queries()[name](spark, SMALL)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(res.fetchall())
