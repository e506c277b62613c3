"""Hand-computed micro-tables for relational, text, scalar, spatial and HTML
operators (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from fieldkit.functions import html as H
from fieldkit.functions import scalars as S
from fieldkit.functions import text as TXT
from fieldkit.operators import aggregates as AG
from fieldkit.operators import frames as PR
from fieldkit.operators import spatial as SP
from fieldkit.operators import text as OT

TIDES = ["low tide at dawn", "high tide at noon", "tide tables at the pier", "no boats at noon"]


def test_mean_by_key(spark):
    df = spark.createDataFrame([("pier", 4), ("quay", 7), ("pier", 5), ("dock", 12), ("pier", 9), ("quay", None)],
                               "berth string, boats int")
    got = {r.berth: r.mean for r in AG.mean_by_key(df, "berth", "boats", "mean").collect()}
    assert got == {"pier": 6.0, "quay": 7.0, "dock": 12.0}


def test_word_count_lines(spark):
    df = spark.createDataFrame([(s,) for s in TIDES], "text string")
    got = {r.word: r.n for r in OT.word_count(df, TXT.split_space("text")).collect()}
    assert got == {"low": 1, "tide": 3, "at": 4, "dawn": 1, "high": 1, "noon": 2, "tables": 1, "the": 1, "pier": 1,
                   "no": 1, "boats": 1}


def test_split_space_vs_whitespace(spark):
    df = spark.createDataFrame([("a  b",)], "text string")
    r = df.select(TXT.split_space("text").alias("s"), TXT.split_ws("text").alias("w")).first()
    assert r.s == ["a", "", "b"] and r.w == ["a", "b"]


def test_trigrams_and_chunks(spark):
    sent = "the quick brown fox jumps over the lazy dog and runs away"  # 12 words
    df = spark.createDataFrame([(1, sent), (2, "one two")], "id long, text string")
    tri = df.select("id", F.size(TXT.ngrams(TXT.split_ws("text"), 3)).alias("n")).orderBy("id").collect()
    assert [r.n for r in tri] == [10, 0]
    ch = OT.token_chunks(df, "id", TXT.split_ws("text"), 3).where("id = 1").orderBy("chunk_no").collect()
    assert len(ch) == 4 and ch[-1].chunk == "and runs away"


def test_array_functions(spark):
    df = spark.createDataFrame([([1, 2, 3], [10, 20, 30, 40], [100, 200, 300])], "a array<int>, b array<int>, c array<int>")
    r = df.select(S.zip_map3("a", "b", "c", lambda x, y, z: x + y + z).alias("z"),
                  F.aggregate(F.array(*[F.lit(i) for i in range(1, 6)]), F.lit(0), lambda s, x: s + x).alias("f0"),
                  F.aggregate(F.array(*[F.lit(i) for i in range(1, 6)]), F.lit(10), lambda s, x: s + x).alias("f10"),
                  ).first()
    assert r.z == [111, 222, 333] and (r.f0, r.f10) == (15, 25)
    sq = spark.createDataFrame([(100, 4), (150, 5), (200, 6), (300, 4)], "a int, b int")
    assert [x[0] for x in sq.select(F.col("a") * F.col("a") + F.col("b") * F.col("b")).collect()][2] == 40036


def test_sort_by_length_and_palindrome(spark):
    df = spark.createDataFrame([(["bb", "a", "ccc", "dd"],)], "w array<string>")
    assert df.select(S.sort_by_length_desc("w")).first()[0] == ["ccc", "bb", "dd", "a"]
    p = spark.createDataFrame([("level",), ("spark",)], "s string").select(S.is_palindrome("s")).collect()
    assert [r[0] for r in p] == [True, False]


def test_parse_timestamp_any_case(spark):
    df = spark.createDataFrame([("01-NOV-19 13.05.07.000000000 PM",), ("01-Nov-19 13.05.07.000000000 PM",),
                                ("garbage-and-more-chars",)], "s string")
    got = [r[0] for r in df.select(S.parse_timestamp("s", tail=13)).collect()]
    assert got[:2] == [dt.datetime(2019, 11, 1, 13, 5, 7)] * 2 and got[2] is None


def test_weekday_category(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6, 10),), (dt.datetime(2024, 1, 8, 10),)], "ts timestamp_ntz")
    assert [r[0] for r in df.select(S.weekday_category("ts")).collect()] == ["wkend", "wkday"]


def test_dedup_first_keeps_earliest(spark):
    df = spark.createDataFrame([(1, 5, 2, "b"), (1, 5, 1, "a"), (2, 7, 3, "c")], "k long, s long, t long, v string")
    got = sorted(tuple(r) for r in PR.dedup_first(df, ["k", "s"], ["t"]).collect())
    assert got == [(1, 5, 1, "a"), (2, 7, 3, "c")]


def test_remove_spaces_and_union(spark):
    a = spark.createDataFrame([("1", 1.0)], "`Cell ID` string, `Lat itude` double")
    b = spark.createDataFrame([("2", "x")], "`Cell ID` string, name string")
    u = PR.union_all_by_name([PR.remove_spaces_in_colnames(a), PR.remove_spaces_in_colnames(b)])
    assert u.columns == ["Cell_ID", "Lat_itude", "name"] and u.count() == 2


def test_null_counts_and_safe_cast(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "p string")
    df = PR.safe_cast(df, "p", "int", "age")
    r = AG.null_counts(df).first()
    assert (r.p, r.age) == (1, 2)


POLY_SCHEMA = "admin_id string, admin_name string, rings array<array<struct<x:double,y:double>>>"


def _poly(spark, rows):
    return spark.createDataFrame(rows, POLY_SCHEMA)


def test_point_in_polygon_shapes(spark):
    sq = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]
    concave = [[(0.0, 0.0), (3.0, 0.0), (3.0, 3.0), (2.0, 3.0), (2.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0),
                (0.0, 0.0)]]
    hole = [[(10.0, 0.0), (14.0, 0.0), (14.0, 4.0), (10.0, 4.0), (10.0, 0.0)],
            [(11.0, 1.0), (13.0, 1.0), (13.0, 3.0), (11.0, 3.0), (11.0, 1.0)]]
    multi = [[(20.0, 0.0), (21.0, 0.0), (21.0, 1.0), (20.0, 1.0), (20.0, 0.0)],
             [(22.0, 0.0), (23.0, 0.0), (23.0, 1.0), (22.0, 1.0), (22.0, 0.0)]]
    polys = _poly(spark, [("SQ", "square", sq), ("CC", "concave", [[(p[0] + 5, p[1]) for p in concave[0]]]),
                          ("HO", "hole", hole), ("MU", "multi", multi)])
    pts = spark.createDataFrame([
        (1, 2.0, 2.0),    # square: inside
        (2, 4.0, 2.0),    # square: on edge → not within
        (3, 6.5, 2.0),    # concave notch → out
        (4, 5.5, 2.0),    # concave left arm → in
        (5, 12.0, 2.0),   # in the hole → out
        (6, 10.5, 2.0),   # ring between outer and hole → in
        (7, 22.5, 0.5),   # second part → in
        (8, 21.5, 0.5),   # between parts → out
        (9, 0.0, 0.0),    # vertex → not within
    ], "id long, x double, y double")
    got = {r.id: r.admin_id for r in SP.points_in_polygons(pts, polys, cell_deg=0.5).collect()}
    assert got == {1: "SQ", 4: "CC", 6: "HO", 7: "MU"}


def test_broadcast_check_falls_back_to_shuffle_join(spark, capsys, monkeypatch):
    """Above the limit the polygon side is not hinted; the join result is the same."""
    from fieldkit.sources import fixtures as FX
    pts = FX.pings(spark, "/root/testdata/sf0.001").select("event_id", "x", "y")
    polys = FX.admin_polygons(spark)
    small = sorted(tuple(r) for r in SP.points_in_polygons(pts, polys).select("event_id", "admin_id").collect())
    monkeypatch.setattr(SP, "BROADCAST_MAX_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = SP.points_in_polygons(pts, polys)
        joined.explain()
        big = sorted(tuple(r) for r in joined.select("event_id", "admin_id").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in capsys.readouterr().out
    assert big == small and len(small) > 0


def test_polygon_index_grows_with_the_outline(spark):
    """A triangle over a 10 degree box takes thousands of cells, and random points agree with the plain rule."""
    import numpy as np
    tri = [[(30.0, -20.0), (40.0, -20.0), (30.0, -10.0), (30.0, -20.0)]]
    polys = _poly(spark, [("T", "triangle", tri)])
    n = SP.polygon_cells(polys).count()
    assert 1000 < n < 20000
    rng = np.random.default_rng(1)
    pts = rng.uniform([29, -21], [41, -9], (3000, 2))
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id long, x double, y double")
    got = {r.id for r in SP.points_in_polygons(df, polys).collect()}
    assert got == {i for i, (x, y) in enumerate(pts) if x > 30 and y > -20 and (x - 30) + (y + 20) < 10}


def test_links_nesting_and_references(spark):
    page = ("<a href='u1'>one</a><A HREF=u2 class=x>tw<b>o</b></A><a href=\"/q?a=1&amp;b=2\">&eacute;&#8217;</a><a>no</a>"
            "<div class=ad>yes<div>in</div>tail</div><div class='ad-slot'>not me</div>")
    df = spark.createDataFrame([(page,), (None,), ("<p>open <a href=x>end",)], "html string")
    r = df.select(H.links("html").alias("l"), H.element_text("html", "div", "ad").alias("d")).collect()
    assert [(x.href, x.anchor) for x in r[0].l] == [("u1", "one"), ("u2", "tw o"), ("/q?a=1&b=2", "é’")]
    assert r[0].d == ["yes in tail"]
    assert r[1].l is None and [(x.href, x.anchor) for x in r[2].l] == [("x", "end")]


def test_html_table_cells_keep_commas(spark):
    html = ("<table><tr><th>Name</th><th>Country</th><th>A</th><th>B</th><th>C</th><th>D</th></tr>"
            "<tr><td> Smith, John </td><td>KE</td><td>1</td><td>2</td><td>3</td><td>4</td></tr>"
            "<tr><td>short</td><td>row</td></tr></table>")
    df = spark.createDataFrame([(html,)], "html string")
    r = df.select(H.table_rows("html", 5).alias("rows"), H.table_header("html").alias("head")).first()
    assert r.rows == [["Smith, John", "KE", "1", "2", "3", "4"]]
    assert r.head == ["Name", "Country", "A", "B", "C", "D"]


def test_html_title_text_links(spark):
    html = ('<html><head><title>A &amp; B</title><script>var t="</p>";</script></head><body>'
            '<p><b>Bold<br>text</p><!-- c --><a href="/x">a very long anchor text here</a>'
            '<div class="ad big">Ad &copy; me</div></body></html>')
    df = spark.createDataFrame([(html,)], "html string")
    r = df.select(H.title("html").alias("t"), H.visible_text("html").alias("v"), H.links("html").alias("l"),
                  H.element_text("html", "div", "ad").alias("d")).first()
    assert r.t == "A & B"
    assert r.v == "A & B Bold text a very long anchor text here Ad © me"
    assert [(x.href, x.anchor) for x in r.l] == [("/x", "a very long anchor text here")]
    assert r.d == ["Ad © me"]


def test_sample_users_exact_k(spark):
    df = spark.createDataFrame([(u, i) for u in range(20) for i in range(3)], "user_id long, i long")
    s = PR.sample_users(df, "user_id", 5)
    assert s.select("user_id").distinct().count() == 5 and s.count() == 15


def test_summary_and_max_row(spark):
    df = spark.createDataFrame([(1, 3.0, "b"), (2, 5.0, "a"), (3, 5.0, None), (4, None, "c")], "k long, v double, t string")
    r = AG.max_row(df, "v", ["k"]).first()
    assert (r.v, r.k) == (5.0, 3)
    s = {r.column: r for r in PR.summary_stats(df, ["v", "t"]).collect()}
    assert (s["v"]["count"], s["v"]["min"], s["v"].p25, s["v"].p50, s["v"].p75) == (3, "3.0", 4.0, 5.0, 5.0)
    assert (s["t"]["count"], s["t"]["min"], s["t"]["max"], s["t"].mean, s["t"].p50) == (3, "a", "c", None, None)


def test_exact_quantiles_of_many_values(spark):
    import numpy as np
    v = np.random.default_rng(2).normal(size=5001).round(2)
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double").repartition(7)
    probs = (0.0, 0.1, 0.25, 0.5, 0.99, 1.0)
    r = PR.exact_quantiles(df, "v", probs).first()
    assert np.allclose(list(r), np.quantile(v, probs), atol=1e-12)


def test_split_parts_are_disjoint_and_stable(spark):
    df = spark.range(0, 4000).withColumnRenamed("id", "k")
    a = {r.k: r.split for r in PR.random_split(df.repartition(3), "k", [0.5, 0.3, 0.2]).collect()}
    b = {r.k: r.split for r in PR.random_split(df.repartition(11), "k", [0.5, 0.3, 0.2]).collect()}
    n = [sum(v == i for v in a.values()) for i in range(3)]
    assert a == b and len(a) == 4000 and abs(n[0] - 2000) < 150 and abs(n[2] - 800) < 120


def test_dense_days_bounds(spark):
    import pytest
    from fieldkit.operators import joins as JN
    d = lambda n: dt.datetime(2024, 1, n, 8)
    ev = spark.createDataFrame([(1, d(2)), (1, d(4)), (2, d(3)), (2, None)], "u long, ts timestamp_ntz")
    got = sorted((r.u, r.day.day, r.n) for r in JN.dense_daily_counts(ev, "u").collect())
    assert got == [(1, 2, 1), (1, 3, 0), (1, 4, 1), (2, 2, 0), (2, 3, 1), (2, 4, 0)]
    assert JN.dense_daily_counts(ev, "u", first_day="2024-01-01", last_day="2024-01-10").count() == 20
    with pytest.raises(Exception, match="more than 2"):
        JN.dense_daily_counts(ev, "u", max_days=2).collect()


def test_pivot_keys_bound(spark):
    import pytest
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "c string")
    assert AG.pivot_keys(df, "c") == ["a", "b"]
    with pytest.raises(ValueError):
        AG.pivot_keys(df, "c", most=1)


def test_hash_sample_is_layout_independent(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    a = {r.k for r in PR.hash_sample(df.repartition(1), "k", 0.1).collect()}
    b = {r.k for r in PR.hash_sample(df.repartition(7), "k", 0.1).collect()}
    assert a == b and 350 < len(a) < 650


def test_ngrams_are_combined_before_the_shuffle(spark, monkeypatch):
    """A chunk's repeated n-grams are one row each, in Spark rows only once they are counted (F5); short, empty and null texts."""
    from collections import Counter

    from fieldkit.operators import text as OT
    texts = ["a b a b a b", "b a", "", None, " x\ty\nz  x y z ", "é ü é", "a a a a"] + ["w%d w%d w1" % (k, k % 3) for k in range(50)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    for n in (1, 3, 4):
        want = Counter(" ".join(w[i:i + n]) for w in ((t or "").split() for t in texts) for i in range(len(w) - n + 1))
        got = OT.ngram_count(docs, TXT.split_ws("text"), n)
        assert {r.ngram: r.n for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan and "MapInArrow" in plan
    import pyarrow as pa
    lists = pa.array([["p", "q", "p", "q"], [], ["p", "q"]] * 10)
    assert OT._counted_ngrams(lists, 2, " ").to_pylist() == [{"ngram": "p q", "n": 30}, {"ngram": "q p", "n": 10}]
