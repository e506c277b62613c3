"""Views over the driver's tables that stand in for the reference's datasets.

Each view is derived from a given table by projections only (no shuffle
except where noted), so its size grows with the table. Definitions follow
FIXTURES.md §2; the DuckDB twins live in ``fieldkit.plans.oracle_views``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldkit.sources.tables import read_table

# Fixed values of the admin-area fixture: a 3 x 3 grid of rectangles over the
# 10 x 10 site grid (x = 33.7 + i*0.004, y = -14.0 + j*0.004). Edges sit at a
# grid value + 0.0013717 so no site and no cluster centroid lies on an edge.
ADMIN_X_EDGES = (33.6973717, 33.7133717, 33.7253717, 33.7373717)
ADMIN_Y_EDGES = (-14.0026283, -13.9866283, -13.9746283, -13.9626283)
# (row, col) -> name; A01 and A10 share a name on purpose (flows keyed by id)
ADMIN_NAMES = {
    (0, 0): "Kasama", (0, 1): "Mbala", (0, 2): "Mpika",
    (1, 0): "Mbala", (1, 1): "Chinsali", (1, 2): "Isoka",
    (2, 0): "Nakonde", (2, 1): "Mporokoso", (2, 2): "Luwingu",
}
# code book of l_returnflag (JN-9)
RETURNFLAG_LABELS = (("A", "accepted"), ("N", "none"), ("R", "returned"))

POLYGON_SCHEMA = T.StructType([
    T.StructField("admin_id", T.StringType(), False),
    T.StructField("admin_name", T.StringType(), False),
    T.StructField("rings", T.ArrayType(T.ArrayType(T.StructType([
        T.StructField("x", T.DoubleType(), False),
        T.StructField("y", T.DoubleType(), False)]))), False),
])


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons table: one lineitem row = one person, its order = household."""
    li = read_table(spark, sf_dir, "lineitem")
    hh = F.col("l_orderkey").cast("string")
    return li.select(
        hh.alias("hh_id"),
        F.col("l_linenumber").alias("person"),
        F.col("l_quantity").alias("age"),
        F.col("l_returnflag").alias("sex"),
        F.col("l_linestatus").alias("urban_rural"),
        F.year("l_shipdate").cast("int").alias("dob_yr"),
        F.substring(hh, 1, 1).alias("prov_id"),
        F.substring(hh, 1, 2).alias("dist_id"),
    )


def census_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census with the age as text: one unparseable and one NULL value per
    household of 7 (the reference's raw text file)."""
    li = read_table(spark, sf_dir, "lineitem")
    hh = F.col("l_orderkey").cast("string")
    p08 = (F.when(F.col("l_linenumber") == 7, F.lit("NaN?"))
           .when(F.col("l_linenumber") == 6, F.lit(None).cast("string"))
           .otherwise(F.col("l_quantity").cast("int").cast("string")))
    return li.select(hh.alias("hh_id"), F.col("l_linenumber").alias("person"),
                     p08.alias("P08"), F.substring(hh, 1, 1).alias("prov_id"))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity log with the raw ``dd-MMM-yy HH.mm.ss`` + 13-character tail."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("SID"),
        F.col("event_id").alias("ACTIVITY_ID"),
        F.col("event_type").alias("Last"),
        F.concat(F.date_format("ts", "dd-MMM-yy HH.mm.ss"), F.lit(".000000000 XX")).alias("ACTIVITY_TIME"),
        F.upper(F.substring("event_type", 1, 1)).alias("STATUS"),
    )


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location-stamped events (CDR stand-in): user, time, site and its x/y."""
    return pings_from_events(read_table(spark, sf_dir, "events"))


def pings_from_events(ev: DataFrame) -> DataFrame:
    """The pings projection of any events frame (batch or stream)."""
    s = (F.col("event_id") * 37 + F.col("user_id")) % 100
    return (ev.select("event_id", "user_id", "ts", "event_type", s.alias("site_id"))
            .select("event_id", "user_id", "ts", "event_type", "site_id",
                    (F.lit(33.7) + (F.col("site_id") % 10).cast("double") * F.lit(0.004)).alias("x"),
                    (F.lit(-14.0) + F.expr("site_id div 10").cast("double") * F.lit(0.004)).alias("y")))


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    # distinct sites of the pings (partial aggregation before the shuffle)
    return pings(spark, sf_dir).select("site_id", "x", "y").distinct()


def sites_2g(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even sites, file-style column names with spaces."""
    return (_sites(spark, sf_dir).where("site_id % 2 = 0")
            .select(F.col("site_id").cast("string").alias("Cell ID"),
                    F.col("x").alias("Longitude"), F.col("y").alias("Latitude")))


def sites_3g(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd sites; other column order plus an extra column."""
    return (_sites(spark, sf_dir).where("site_id % 2 = 1")
            .select(F.col("site_id").cast("string").alias("Cell ID"),
                    F.col("y").alias("Latitude"), F.col("x").alias("Longitude"),
                    F.concat(F.lit("S"), F.col("site_id").cast("string")).alias("Site Name")))


def cdrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CDRs: pings without coordinates, file-style column names."""
    return pings(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("calling imei"),
        F.col("event_id").alias("event id"),
        F.col("ts").alias("datetime"),
        F.col("event_type").alias("cdr type"),
        F.col("site_id").cast("string").alias("last calling cellid"))


def _sql_literal(v, dt: T.DataType) -> str:
    if isinstance(dt, T.ArrayType):
        return "array(" + ", ".join(_sql_literal(e, dt.elementType) for e in v) + ")"
    if isinstance(dt, T.StructType):
        vals = [v[f.name] for f in dt.fields] if isinstance(v, dict) else list(v)
        return "named_struct(" + ", ".join(f"'{f.name}', {_sql_literal(e, f.dataType)}"
                                           for e, f in zip(vals, dt.fields)) + ")"
    if isinstance(dt, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dt, T.DoubleType):
        return f"{float(v)!r}D"
    return str(v)


def _literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A fixed in-plan table: an inline ``VALUES`` list, folded by the
    analyser into a local relation (exact size statistics, no Python RDD)."""
    values = ", ".join("(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(r, schema.fields)) + ")"
                       for r in rows)
    cols = ", ".join(f.name for f in schema.fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({cols})")


def admin_polygons(spark: SparkSession) -> DataFrame:
    """Admin-area layer: 9 rectangles, one ring each (closed)."""
    rows = []
    for r in range(3):
        for c in range(3):
            x0, x1 = ADMIN_X_EDGES[c], ADMIN_X_EDGES[c + 1]
            y0, y1 = ADMIN_Y_EDGES[r], ADMIN_Y_EDGES[r + 1]
            ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
            rows.append((f"A{r}{c}", ADMIN_NAMES[(r, c)], [[{"x": x, "y": y} for x, y in ring]]))
    return _literal_table(spark, rows, POLYGON_SCHEMA)


def shaped_polygons(spark: SparkSession) -> DataFrame:
    """A layer of three shapes over the site grid: an L (concave), a frame (a hole) and two parts of one area.
    Their edges lie on the lines of ``admin_polygons``, so that boxes put together describe them."""
    x, y = ADMIN_X_EDGES, ADMIN_Y_EDGES
    pt = lambda i, j: {"x": x[i], "y": y[j]}
    box = lambda a, b, c, d: [pt(a, c), pt(b, c), pt(b, d), pt(a, d), pt(a, c)]
    rows = [("L", "concave", [[pt(0, 0), pt(2, 0), pt(2, 1), pt(1, 1), pt(1, 3), pt(0, 3), pt(0, 0)]]),
            ("O", "hole", [box(0, 3, 0, 3), box(1, 2, 1, 2)]),
            ("P", "parts", [box(0, 1, 0, 1), box(2, 3, 2, 3)])]
    return _literal_table(spark, rows, POLYGON_SCHEMA)


def codebook(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("label", T.StringType())])
    return _literal_table(spark, list(RETURNFLAG_LABELS), schema)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast-style nested JSON per event."""
    return read_table(spark, sf_dir, "events").select("event_id", weather_json().alias("json"))


def weather_json() -> F.Column:
    """A forecast of an ``events`` row: a two-element ``list``; the optional
    ``rain`` field only on error events' second element."""
    k = F.get_json_object("props", "$.k").cast("bigint").cast("string")
    k1 = (F.get_json_object("props", "$.k").cast("bigint") + 1).cast("string")
    hum = (F.col("user_id") % 100).cast("string")
    rain = F.when(F.col("event_type") == "error",
                  F.concat(F.lit(',"rain":{"3h":'), k, F.lit("}"))).otherwise(F.lit(""))
    return F.concat(
        F.lit('{"city":{"id":'), F.col("user_id").cast("string"), F.lit('},"list":[{"dt":'),
        F.col("event_id").cast("string"), F.lit(',"main":{"temp_min":'), k, F.lit(',"humidity":'), hum,
        F.lit('}},{"dt":'), (F.col("event_id") + 1).cast("string"), F.lit(',"main":{"temp_min":'), k1,
        F.lit(',"humidity":'), hum, F.lit("}"), rain, F.lit("}]}"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (vec_id, class) score: every position of the embedding is a class (ranking input)."""
    emb = read_table(spark, sf_dir, "embeddings")
    return (emb.select("vec_id", "label", F.posexplode("embedding").alias("cls", "score"))
            .select("vec_id", F.col("cls").cast("int").alias("cls"),
                    F.col("score").cast("double").alias("score"), "label"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def _escaped(c) -> F.Column:
    out = c
    for ch, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&#62;")):
        out = F.replace(out, F.lit(ch), F.lit(ref))
    return out


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per document with a link, single-quoted, for every line of the text."""
    doc = F.col("doc_id").cast("string")
    link = lambda line, i: F.concat(F.lit("<a class=x href='/d?a=1&amp;id="), doc, F.lit("&amp;line="), (i + 1).cast("string"),
                                    F.lit("'><b>"), _escaped(line), F.lit("</b></a><br>\n"))
    lines = F.array_join(F.transform(F.split("text", "\n"), link), "")
    return read_table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("<p>no link <a>nor here</a>"), lines, F.lit("<p>end")).alias("html"))


ORDERS_PAGE = 1024   # order keys per page: a customer's table goes over as many pages as it needs


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with an HTML table of a customer's orders, one per range of order keys (tags in mixed case, cells left open)."""
    o = read_table(spark, sf_dir, "orders").withColumn("page", F.floor(F.col("o_orderkey") / ORDERS_PAGE))
    row = F.concat(F.lit("<TR><td>"), F.col("o_orderkey").cast("string"), F.lit("<td align='right'> "),
                   F.col("o_orderstatus"), F.lit(" </td>\n<td>"), _escaped(F.col("o_orderpriority")), F.lit(", <i>x</i></td></tr>"))
    return o.groupBy("o_custkey", "page").agg(F.concat(   # ORDERS_PAGE rows at most
        F.lit("<table><tr><th>order<th>status</th><th class=\"w\">priority</th></tr>"),
        F.array_join(F.array_sort(F.collect_list(row)), ""), F.lit("</table><p>end")).alias("html"))
