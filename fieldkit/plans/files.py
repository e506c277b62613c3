"""Readers and writers (IO-*) on files that the queries write from the given tables.

Files go to a fresh folder under ``spark.checkpoint.dir`` (shared by driver and
executors) and are read back; the oracle is the table they came from.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldkit.functions import text as TXT
from fieldkit.functions.geo import round6
from fieldkit.operators import aggregates as AG
from fieldkit.operators import frames as PR
from fieldkit.operators import ml as ML
from fieldkit.plans.catalog import register
from fieldkit.sources import files as IO
from fieldkit.sources import fixtures as FX
from fieldkit.sources.tables import read_table
from fieldkit.session import ensure_checkpoint_dir


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"


@register("csv_all_strings", ids=("IO-1", "IO-3", "IO-13"), sql="""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""")
def csv_all_strings(spark, sf_dir):
    at = _folder(spark)
    IO.write_csv(read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").repartition(3), at)
    return IO.read_csv(spark, at)   # a folder of files is one table; every column is text


@register("delimited_text", ids=("IO-2",), sql="""
    SELECT 'tab' AS kind, CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier
    UNION ALL SELECT 'pipe', CAST(s_suppkey AS VARCHAR), s_name FROM supplier""")
def delimited_text(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    out = None
    for kind, sep in (("tab", "\t"), ("pipe", "|")):
        at = _folder(spark)
        IO.write_csv(s, at, sep=sep)
        one = IO.read_csv(spark, at, sep=sep).select(F.lit(kind).alias("kind"), "s_suppkey", "s_name")
        out = one if out is None else out.unionByName(one)
    return out


@register("csv_typed", ids=("IO-4",), views=("census_dirty",), sql="""
    SELECT hh_id, person, TRY_CAST(P08 AS INTEGER) AS P08,
           CASE WHEN P08 = 'NaN?' THEN P08 || ',' || person || ',' || hh_id END AS _corrupt_record FROM census_dirty""")
def csv_typed(spark, sf_dir):
    at = _folder(spark)
    # columns in another order than declared: they are matched by name
    IO.write_csv(FX.census_dirty(spark, sf_dir).select("P08", "person", "hh_id"), at)
    return IO.read_csv_typed(spark, at, "hh_id string, person int, P08 int")


@register("text_lines", ids=("IO-5",), sql="""
    SELECT unnest(string_split(text, chr(10))) AS value FROM documents WHERE text IS NOT NULL""")
def text_lines(spark, sf_dir):
    """Whole texts written as text files and read back line by line."""
    at = _folder(spark)
    read_table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.col("text").alias("value")).write.text(at)
    return IO.read_text_lines(spark, at, "\n")


@register("json_file", ids=("IO-7",), sql="SELECT doc_id AS id, text, lang, source, n_chars FROM documents")
def json_file(spark, sf_dir):
    """Documents as nested JSON lines, read back with a declared schema and flattened."""
    at = _folder(spark)
    d = read_table(spark, sf_dir, "documents")
    d.select(F.col("doc_id").alias("id"), F.struct("lang", "source", "n_chars").alias("about"), "text").write.json(at)
    return IO.flatten_struct(IO.read_json(spark, at, "id long, text string, about struct<lang: string, source: string, n_chars: long>"),
                             "about", ["lang", "source", "n_chars"])


@register("folder_combine", ids=("IO-11",), sql="""
    SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, c_mktsegment FROM customer""")
def folder_combine(spark, sf_dir):
    """Files with different headers in one folder, aligned by name."""
    at = _folder(spark)
    s = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    c = read_table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("key"),
                                                     F.col("c_name").alias("name"))
    for df in (s, c):
        df.write.mode("append").option("header", True).csv(at)
    return IO.combine_csv_folder(spark, at)


@register("labelled_points", ids=("IO-14", "ML-10"), sql="""
    SELECT CAST(l_linenumber AS DOUBLE) AS label, [CAST(l_quantity AS DOUBLE), CAST(l_discount AS DOUBLE)] AS features FROM lineitem""")
def labelled_points(spark, sf_dir):
    at = _folder(spark)
    li = read_table(spark, sf_dir, "lineitem")
    li.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in ("l_linenumber", "l_quantity", "l_discount")]).alias("value")).write.text(at)
    pts = IO.parse_labeled_points(IO.read_text_lines(spark, at))
    return pts.select("label", vector_to_array("features").alias("features"))


@register("polygons_read", ids=("IO-16",), views=("pings",), sql="""
    SELECT CAST(user_id AS VARCHAR) AS admin_id, 'user ' || user_id AS admin_name, CAST(5 AS INTEGER) AS n_points,
           min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax
    FROM pings WHERE user_id IS NOT NULL GROUP BY user_id HAVING min(x) < max(x)""")
def polygons_read(spark, sf_dir):
    """The box around each user's events as a polygon, through the layer's file form; rings that were left open come back closed."""
    at = _folder(spark)
    box = FX.pings(spark, sf_dir).where("user_id IS NOT NULL").groupBy("user_id").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).where("x0 < x1")
    ring = F.array(*[F.array(x, y) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))])
    box.select(F.col("user_id").cast("string").alias("id"), F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name"),
               F.array(ring).alias("coordinates")).write.json(at)
    ring = F.col("rings")[0]
    side = lambda pick, axis: pick(F.transform(ring, lambda p: p[axis]))
    return IO.read_polygons_json(spark, at).select(
        "admin_id", "admin_name", F.size(ring).alias("n_points"), side(F.array_min, "x").alias("xmin"), side(F.array_max, "x").alias("xmax"),
        side(F.array_min, "y").alias("ymin"), side(F.array_max, "y").alias("ymax"))


@register("partition_folders", ids=("PR-19", "IO-13"), sql="""
    SELECT CAST(l_linenumber AS INTEGER) AS l_linenumber, CAST(count(*) AS BIGINT) AS n, true AS own_folder FROM lineitem GROUP BY l_linenumber""")
def partition_folders(spark, sf_dir):
    """A table written in a folder per value: the rows of each, and whether all its files lie in that folder alone."""
    at = _folder(spark)
    read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").repartition("l_linenumber").write.partitionBy("l_linenumber").parquet(at)
    rows = spark.read.parquet(at).select(F.col("l_linenumber").cast("int").alias("l_linenumber"), F.col("_metadata.file_path").alias("file"))
    inside = F.contains("file", F.concat(F.lit("/l_linenumber="), F.col("l_linenumber").cast("string"), F.lit("/")))
    return rows.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.bool_and(inside).alias("own_folder"))


@register("side_counters", ids=("AG-21", "PR-22"), views=("census_dirty",), sql="""
    SELECT prov_id, CAST(sum(TRY_CAST(P08 AS INTEGER)) AS BIGINT) AS total, any_value(b.n_rows) AS n_rows, any_value(b.n_bad) AS n_bad,
           any_value(b.n_missing) AS n_missing
    FROM census_dirty, (SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (P08 IS NULL) AS BIGINT) AS n_missing,
                               CAST(count(*) FILTER (P08 IS NOT NULL AND TRY_CAST(P08 AS INTEGER) IS NULL) AS BIGINT) AS n_bad FROM census_dirty) b
    GROUP BY prov_id""")
def side_counters(spark, sf_dir):
    """Totals of a cleaned table beside what the cleaning counted on the way: rows, bad and missing values, in one pass."""
    at = _folder(spark)
    clean = lambda own: FX.census_dirty(own, sf_dir).select("prov_id", "P08", F.col("P08").try_cast("int").alias("value"))
    bad = F.col("P08").isNotNull() & F.col("value").isNull()
    seen = AG.with_counters(spark, clean, {"n_rows": F.count(F.lit(1)), "n_bad": F.count_if(bad), "n_missing": F.count_if(F.col("P08").isNull())},
                            lambda df: df.drop("P08").write.parquet(at))
    totals = spark.read.parquet(at).groupBy("prov_id").agg(F.sum("value").alias("total"))
    return totals.select("*", *[F.lit(seen[n]).cast("bigint").alias(n) for n in ("n_rows", "n_bad", "n_missing")])


@register("shared_result", ids=("PR-20",), sql="""
    WITH r AS (SELECT o_custkey, o_orderpriority, CAST(count(*) AS BIGINT) AS n, max(l_extendedprice) AS top
               FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
    SELECT 'priority' AS kind, o_orderpriority AS key, CAST(sum(n) AS BIGINT) AS n, max(top) AS top FROM r GROUP BY o_orderpriority
    UNION ALL SELECT 'customer', CAST(o_custkey AS VARCHAR), CAST(sum(n) AS BIGINT), max(top) FROM r GROUP BY o_custkey""")
def shared_result(spark, sf_dir):
    """One joined and counted table, kept in the shared folder, for two consumers."""
    o, li = (read_table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    r = PR.shared(o.join(li, o["o_orderkey"] == li["l_orderkey"]).groupBy("o_custkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.max("l_extendedprice").alias("top")))
    by = lambda kind, c: r.groupBy(F.col(c).cast("string").alias("key")).agg(F.sum("n").alias("n"), F.max("top").alias("top")).select(
        F.lit(kind).alias("kind"), "key", "n", "top")
    return by("priority", "o_orderpriority").unionByName(by("customer", "o_custkey"))


@register("assembled_features", ids=("ML-1",), sql="""
    SELECT doc_id, [CAST(n_chars AS DOUBLE), CAST(len(string_split(text, chr(10))) AS DOUBLE)] AS features FROM documents""")
def assembled_features(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"), F.size(F.split("text", "\n")).cast("double").alias("n_lines"))
    return ML.assembler(["n_chars", "n_lines"]).transform(d).select("doc_id", vector_to_array("features").alias("features"))


@register("label_index", ids=("ML-9",), sql="""
    WITH f AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
    SELECT lang, CAST(row_number() OVER (ORDER BY n DESC, lang) - 1 AS DOUBLE) AS lang_idx FROM f""")
def label_index(spark, sf_dir):
    from pyspark.ml.feature import StringIndexer
    d = read_table(spark, sf_dir, "documents").select("lang")
    return StringIndexer(inputCol="lang", outputCol="lang_idx").fit(d).transform(d).distinct()


@register("pandas_udf_batches", ids=("UD-3",), sql="SELECT event_id, upper(left(event_type, 1)) AS status FROM events")
def pandas_udf_batches(spark, sf_dir):
    """A vectorised Python function, the extension point for what built-ins lack."""
    @F.pandas_udf("string")
    def status(s: pd.Series) -> pd.Series:
        return s.str[:1].str.upper()

    return read_table(spark, sf_dir, "events").select("event_id", status("event_type").alias("status"))


@register("pandas_udf_similarity", ids=("UD-3",), sql="""
    SELECT p_partkey, floor(jaro_similarity(p_name, lower(p_brand || p_type)) * 1e6 + 0.5) / 1e6 AS jaro FROM part""")
def pandas_udf_similarity(spark, sf_dir):
    """Similarity of two names, a vectorised Python function for what built-ins lack."""
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", round6(TXT.jaro_similarity("p_name", F.lower(F.concat("p_brand", "p_type")))).alias("jaro"))
