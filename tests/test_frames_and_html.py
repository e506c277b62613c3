"""Quantiles of many columns, shared results, side counters, similarity, and one walk per page."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from fieldkit.functions import html as H
from fieldkit.functions import text as TXT
from fieldkit.operators import aggregates as AG
from fieldkit.operators import frames as PR
from fieldkit.plans import catalog
from fieldkit.sources import fixtures as FX

from .conftest import SF_SMALL

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


def quantile(values, p):
    values = sorted(values, key=lambda v: (math.isnan(v), v))
    if not values:
        return None
    rank = (len(values) - 1) * p
    low, high = values[math.floor(rank)], values[math.ceil(rank)]
    return low if low == high or (math.isnan(low) and math.isnan(high)) else low + (high - low) * (rank - math.floor(rank))


def test_quantiles_of_all_kinds_of_columns(spark):
    rnd = random.Random(1)
    n = 2_000
    cols = {
        "even": [rnd.uniform(-5, 5) for _ in range(n)],
        "few": [float(rnd.randint(0, 3)) for _ in range(n)],
        "one": [7.5] * n,
        "scales": [rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300) for _ in range(n)],
        "outliers": [rnd.gauss(0, 1e-6) if rnd.random() < 0.99 else rnd.choice([1e300, -1e200, 1e100]) for _ in range(n)],
        "close": [1e9 + rnd.randint(0, 500) * 1e-6 for _ in range(n)],
        "hot": [0.0 if rnd.random() < 0.7 else rnd.random() for _ in range(n)],
        "infinite": [rnd.choice([float("inf"), float("-inf"), 1.0, 2.0]) for _ in range(n)],
        "nan": [rnd.choice([float("nan"), rnd.random()]) for _ in range(n)],
        "nulls": [rnd.choice([None, None, rnd.random()]) for _ in range(n)],
        "nothing": [None] * n,
        "odd name.": [float(rnd.randint(-100, 100)) for _ in range(n)],
    }
    df = spark.createDataFrame(list(zip(*cols.values(), strict=True)), ", ".join(f"`{c}` double" for c in cols)).repartition(3)
    got = {r["column"]: r for r in PR.column_quantiles(df, list(cols), PROBS).collect()}
    assert set(got) == set(cols)
    for c, values in cols.items():
        held = [v for v in values if v is not None]
        for k, p in enumerate(PROBS):
            if c == "infinite" and p not in (0.0, 1.0):
                continue
            want = quantile(held, p)
            assert got[c][f"q{k}"] == want or math.isnan(want) and math.isnan(got[c][f"q{k}"]), (c, p)


def test_quantiles_of_no_rows(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert [tuple(r) for r in PR.column_quantiles(df, ["a", "b"], (0.5,)).orderBy("column").collect()] == [("a", None), ("b", None)]
    assert PR.exact_quantiles(df, "a", (0.25, 0.5)).collect() == [(None, None)]


def plan_of(df):
    """The plan that ran, with stages that are used again left out."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_of_the_data_for_any_number_of_columns(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    jobs = spark.sparkContext.statusTracker()
    numbers = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"]
    before = len(jobs.getJobIdsForGroup(None))
    frames = [PR.column_quantiles(li, numbers[:k], (0.25, 0.5, 0.75)) for k in (1, 5)]
    assert len(jobs.getJobIdsForGroup(None)) == before      # nothing ran while the plans were built
    for df in frames:
        plan = plan_of(df)
        final = plan.split("== Initial Plan ==")[0]
        # the shuffle on (column, value) is made once and used again by the later rounds; the table is read for it alone
        assert final.count("FileScan parquet") == 1, final
        assert "ReusedExchange" in final


def test_shared_result_reads_its_sources_once(spark):
    df = catalog.queries()["shared_result"](spark, SF_SMALL)
    assert all("/shared-" in f for f in df.inputFiles()) and df.inputFiles()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan and "Join" not in plan


def test_counters_beside_a_result(spark):
    def build(session):
        return session.createDataFrame([("1",), ("x",), ("3",), (None,)], "p string").withColumn("v", F.col("p").try_cast("int"))

    kept = []
    seen = AG.with_counters(spark, build, {"rows": F.count(F.lit(1)), "bad": F.count_if(F.col("p").isNotNull() & F.col("v").isNull())},
                            lambda d: kept.append([r.v for r in d.collect()]))
    assert seen == {"rows": 4, "bad": 1} and kept == [[1, None, 3, None]]
    none = AG.with_counters(spark, lambda s: build(s).where("p = 'no'"), {"rows": F.count(F.lit(1)), "sum": F.sum("v")}, lambda d: d.count())
    assert none == {"rows": 0, "sum": None}


def test_jaro_similarity(spark):
    """Characters are compared (the other engine compares bytes, which is the same for ASCII)."""
    assert TXT.jaro("daé", "dae") == pytest.approx((2 / 3 + 2 / 3 + 1) / 3)
    rnd = random.Random(3)
    pairs = [("".join(rnd.choices("abcd ", k=rnd.randint(0, 9))), "".join(rnd.choices("abcd ", k=rnd.randint(0, 9)))) for _ in range(800)]
    pairs += [("", ""), ("", "a"), ("martha", "marhta"), (None, "a"), ("a", None)]
    con = duckdb.connect()
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    for r in df.withColumn("j", TXT.jaro_similarity("a", "b")).collect():
        want = con.execute("SELECT jaro_similarity(?::VARCHAR, ?::VARCHAR)", [r.a, r.b]).fetchone()[0]
        assert r.j == want or r.j == pytest.approx(want, abs=1e-9), (r.a, r.b)


PAGE = ("<html><head><title> The &amp; page </title></head><body><li><a href='x'>one</a></li><div class='ad b'>buy</div>"
        "<table><tr><th>h<th>i<tr><td>1<td>2</table><a href=y>two</a>")


def test_readers_share_one_walk(monkeypatch):
    walks, taken = [], []
    tokens = H.tokens

    def counted(page):
        walks.append(page)
        for t in tokens(page):
            taken.append(t)
            yield t

    monkeypatch.setattr(H, "tokens", counted)
    got = H.read_page(PAGE, [H.Title(), H.Text(), H.Links(), H.NestedLinks("li"), H.Elements("div", "ad"), H.Rows("td", 1), H.Header()])
    assert got == ["The & page", "The & page one buy h i 1 2 two", [{"href": "x", "anchor": "one"}, {"href": "y", "anchor": "two"}],
                   ["x"], ["buy"], [["1", "2"]], ["h", "i"]]
    assert len(walks) == 1
    whole, taken[:] = len(taken), []
    assert H.read_page(PAGE, [H.Title()]) == ["The & page"]
    assert len(taken) == 5 < whole      # html, head, title, its text and its end
    assert H.read_page("<p>no title", [H.Title(), H.Text()]) == [None, "no title"]
    assert H.read_page("<title>open", [H.Title()]) == [None] and H.read_page("", [H.Title(), H.Links()]) == [None, []]


def test_a_query_walks_a_page_once(spark):
    df = catalog.queries()["page_metadata"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("run(html") == 1
    df = spark.createDataFrame([(PAGE,), (None,)], "html string").select(H.extract("html", t=(H.Title,), l=(H.NestedLinks, "li")).alias("e"))
    assert [(r.e.t, r.e.l) for r in df.collect()] == [("The & page", ["x"]), (None, None)]


def test_pages_of_a_customer_are_bounded(spark):
    n = FX.order_pages(spark, SF_SMALL).select(F.size(H.table_rows("html", 2)).alias("n")).agg(F.max("n")).first()[0]
    assert 0 < n <= FX.ORDERS_PAGE


def test_split_pages_read_like_walked_ones():
    """Odd markup read from one split gives what the walk over its tokens gives."""
    import random
    rnd = random.Random(8)
    bits = ["<td>", "</td>", "<TR>", "<th class='a>b'>", "<table>", "</table>", "x & y", "&amp;\xa0 z", " ", "\n", "<", "<!--", "-->", "<a href=\"/u>v\">",
            "</a>", "<div class='ad b'>", "</div>", "<p a=b c = \"d\" e='", "'", "=", ">", "<script>", "</script>", "<style", "\x0b"]
    for _ in range(3000):
        page = "".join(rnd.choice(bits) for _ in range(rnd.randrange(20)))
        readers = [[H.Text(), H.Links(), H.Elements("div", "ad"), H.Rows("td", 1), H.Header()] for _ in range(2)]
        for token in H.tokens(page):
            for r in readers[1]:
                r.take(*token)
        assert H.read_page(page, readers[0]) == [r.result() for r in readers[1]], page


def test_pages_without_scripts_are_split_at_once(monkeypatch):
    """No step of Python per token of a page but the split's (F3)."""
    walks, tokens = [], H.tokens
    monkeypatch.setattr(H, "tokens", lambda page: walks.append(page) or tokens(page))
    assert H.read_page("<table><tr><th>a<tr><td>1<td>2</table>", [H.Header(), H.Rows("td")]) == [["a"], [["1", "2"]]]
    assert not walks
    assert H.read_page("<script><td></script><td>1", [H.Rows("td")]) == [[["1"]]] and len(walks) == 1


def test_pages_of_a_batch_become_arrow_some_at_a_time(spark, monkeypatch):
    """No more than PAGES pages of a batch, with their results, are Python objects at a time (F4)."""
    import pyarrow as pa
    sizes = []

    class Array:
        def __getattr__(self, name):
            return getattr(pa, name)

        def array(self, rows, kind):
            sizes.append(len(rows))
            return pa.array(rows, kind)

    kept = {}
    monkeypatch.setattr(H, "pa", Array())
    monkeypatch.setattr(H.F, "arrow_udf", lambda kind: lambda f: kept.setdefault("run", f) and (lambda c: c))
    H.extract("html", l=(H.Links,))
    pages = pa.array([None if k == 3 else f"<a href='{k}'>{k}</a>" for k in range(1000)])
    got = kept["run"](pages).to_pylist()
    assert max(sizes) <= 256 and len(got) == 1000
    assert got[3] == {"l": None} and got[999] == {"l": [{"href": "999", "anchor": "999"}]}
    assert len(kept["run"](pages[:0])) == 0
