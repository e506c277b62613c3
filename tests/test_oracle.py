"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
gate runs the same comparison at sf0.01); rows-only keys must run."""

import duckdb
import pytest

from fieldkit.plans import catalog
from fieldkit.sources.tables import TABLES

from .conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return round(v, 5)
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_all_queries_match_oracle(spark, con):
    qs, sql = catalog.queries(), catalog.oracle_sql()
    bad = []
    for name, fn in sorted(qs.items()):
        df = fn(spark, SF_SMALL)
        rows, cols = df.collect(), df.columns
        if name not in sql:
            continue
        res = con.execute(sql[name])
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        order = sorted(cols)
        if order != sorted(dcols) or len(rows) != len(drows):
            bad.append(name)
            continue
        a = sorted((tuple(_norm(r[cols.index(c)]) for c in order) for r in rows), key=repr)
        b = sorted((tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows), key=repr)
        if a != b:
            bad.append(name)
    assert bad == []
