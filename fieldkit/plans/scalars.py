"""Scalar, date/time, array and JSON function queries (SC-*, AG-8, SO-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldkit.functions import scalars as S
from fieldkit.functions import text as TXT
from fieldkit.functions.geo import haversine, haversine_hayford, round6
from fieldkit.plans.catalog import register
from fieldkit.plans.oracle_views import hav_sql, r6
from fieldkit.sources import fixtures as FX
from fieldkit.sources.tables import read_table

WS = r"'[ \t\n\r\f]+'"
_TOKENS = f"list_filter(regexp_split_to_array(text, {WS}), lambda x: x <> '')"
# fixed reference point of the distance queries: the site grid origin
REF_LAT, REF_LON = -14.0, 33.7

WEATHER_SCHEMA = ("struct<city:struct<id:bigint>, list:array<struct<dt:bigint, "
                  "main:struct<temp_min:bigint, humidity:bigint>, rain:struct<`3h`:bigint>>>>")


def _t(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


@register("split_take", ids=("SC-2",), sql="SELECT page_id, string_split(url, '/')[3] AS host FROM pages")
def split_take(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", TXT.nth_field("url", "/", 3).alias("host"))


@register("reverse_palindrome", ids=("SC-3",), sql=f"""
    SELECT DISTINCT lower(w) AS word, reverse(lower(w)) AS reversed, lower(w) = reverse(lower(w)) AS is_palindrome
    FROM (SELECT unnest({_TOKENS}) AS w FROM benchmark)""")
def reverse_palindrome(spark, sf_dir):
    w = _t(spark, sf_dir, "benchmark").select(F.explode(TXT.split_ws("text")).alias("w")).select(F.lower("w").alias("word"))
    return w.distinct().select("word", F.reverse("word").alias("reversed"), S.is_palindrome("word").alias("is_palindrome"))


@register("clean_whitespace", ids=("SC-4",), sql=f"""
    SELECT conv_id, turn, trim(regexp_replace(text, {WS}, ' ', 'g')) AS clean FROM conversations""")
def clean_whitespace(spark, sf_dir):
    return _t(spark, sf_dir, "conversations").select("conv_id", "turn", TXT.clean_whitespace("text").alias("clean"))


@register("replace_text", ids=("SC-5",), sql="SELECT p_partkey, replace(p_name, ' ', '_') AS p_name_key FROM part")
def replace_text(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("_")).alias("p_name_key"))


@register("contains_text", ids=("SC-6",), sql="SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'red')")
def contains_text(spark, sf_dir):
    return _t(spark, sf_dir, "part").where(F.col("p_name").contains("red")).select("p_partkey", "p_name")


@register("concat_key", ids=("SC-7",), sql="""
    SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) || ' , ' || CAST(l_linenumber AS VARCHAR) AS loc_key
    FROM lineitem""")
def concat_key(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat_ws(" , ", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("loc_key"))


@register("parse_timestamp", ids=("SC-8", "SC-9", "UD-2"), views=("activity",), sql="""
    SELECT ACTIVITY_ID, try_strptime(left(ACTIVITY_TIME, length(ACTIVITY_TIME) - 13), '%d-%b-%y %H.%M.%S') AS activity_ts
    FROM activity""")
def parse_timestamp(spark, sf_dir):
    return FX.activity(spark, sf_dir).select(
        "ACTIVITY_ID", S.parse_timestamp("ACTIVITY_TIME", "dd-MMM-yy HH.mm.ss", tail=13).alias("activity_ts"))


@register("add_time_columns", ids=("SC-10", "SC-11", "SC-12", "SC-13"), sql="""
    WITH r AS (SELECT event_id, strptime(strftime(ts, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') AS datetime FROM events)
    SELECT event_id, datetime, CAST(datetime AS DATE) AS date, CAST(hour(datetime) AS INTEGER) AS hr,
           CAST(isodow(datetime) - 1 AS INTEGER) AS weekday, dayname(datetime) AS day_name FROM r""")
def add_time_columns(spark, sf_dir):
    raw = _t(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyyMMddHHmmss").alias("raw"))
    parsed = raw.select("event_id", S.parse_timestamp("raw", "yyyyMMddHHmmss").alias("datetime"))
    return parsed.select("event_id", "datetime", *[c.alias(n) for n, c in S.time_columns("datetime").items()])


@register("weekday_category", ids=("SC-16",), sql="""
    SELECT DISTINCT CAST(ts AS DATE) AS day, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
           CASE WHEN isodow(ts) - 1 >= 5 THEN 'wkend' ELSE 'wkday' END AS wkday_cat FROM events""")
def weekday_category(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.select(F.to_date("ts").alias("day"), F.weekday("ts").alias("weekday"),
                    S.weekday_category("ts").alias("wkday_cat")).distinct()


@register("haversine", ids=("SC-18",), views=("pings",), sql=f"""
    SELECT event_id, {r6(hav_sql(repr(REF_LAT), repr(REF_LON), 'y', 'x'))} AS dist_km FROM pings""")
def haversine_q(spark, sf_dir):
    return FX.pings(spark, sf_dir).select(
        "event_id", round6(haversine(F.lit(REF_LAT), F.lit(REF_LON), "y", "x")).alias("dist_km"))


@register("haversine_hayford", ids=("SC-19",), views=("pings",), sql=f"""
    SELECT event_id, {r6(hav_sql(repr(REF_LAT), repr(REF_LON), 'y', 'x', 6378.388))} AS dist_km FROM pings""")
def haversine_hayford_q(spark, sf_dir):
    return FX.pings(spark, sf_dir).select(
        "event_id", round6(haversine_hayford(F.lit(REF_LAT), F.lit(REF_LON), "y", "x")).alias("dist_km"))


@register("square_add", ids=("SC-20",), sql="""
    SELECT l_orderkey, l_linenumber, l_quantity * l_quantity AS sq,
           l_quantity * l_quantity + l_linenumber * l_linenumber AS sq_add FROM lineitem""")
def square_add(spark, sf_dir):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (q * q).alias("sq"),
                                                (q * q + n * n).alias("sq_add"))


@register("even_flag", ids=("SC-21",), sql="""
    SELECT l_orderkey, l_linenumber, l_orderkey % 2 = 0 AS even, pow(l_linenumber, 3) AS cube FROM lineitem""")
def even_flag(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 2 == 0).alias("even"),
                                                F.pow("l_linenumber", 3).alias("cube"))


def _milli(x):
    return F.floor(x.cast("double") * 1000)


_MILLI_SQL = "CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT)"


@register("array_map", ids=("SC-22", "UD-4"), sql=f"""
    SELECT vec_id, list_transform(embedding, lambda x: {_MILLI_SQL}) AS milli FROM embeddings""")
def array_map(spark, sf_dir):
    return _t(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", _milli).alias("milli"))


@register("array_zip_map", ids=("SC-23",), sql="""
    SELECT vec_id, list_transform(range(1, len(embedding) + 1), lambda i: CAST(floor((CAST(embedding[i] AS DOUBLE)
        + CAST(embedding[len(embedding) + 1 - i] AS DOUBLE) + CAST(embedding[i] AS DOUBLE) * 2) * 1000) AS BIGINT)) AS zipped
    FROM embeddings""")
def array_zip_map(spark, sf_dir):
    # the whole vector, its mirror image and its double, in lock-step
    e = F.col("embedding")
    z = S.zip_map3(e, F.reverse(e), F.transform(e, lambda v: v.cast("double") * 2),
                   lambda a, b, c: F.floor((a.cast("double") + b.cast("double") + c) * 1000))
    return _t(spark, sf_dir, "embeddings").select("vec_id", z.alias("zipped"))


@register("array_filter", ids=("SC-24",), sql=f"""
    SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_pos,
           list_transform(list_filter(embedding, lambda x: x > 0), lambda x: {_MILLI_SQL}) AS pos_milli
    FROM embeddings""")
def array_filter(spark, sf_dir):
    pos = F.filter("embedding", lambda x: x > 0)
    return _t(spark, sf_dir, "embeddings").select("vec_id", F.size(pos).alias("n_pos"),
                                                  F.transform(pos, _milli).alias("pos_milli"))


@register("array_reduce", ids=("AG-8",), sql=f"""
    SELECT vec_id, CAST(list_sum(list_transform(embedding, lambda x: {_MILLI_SQL})) AS BIGINT) AS total,
           CAST(10 + list_sum(list_transform(embedding, lambda x: {_MILLI_SQL})) AS BIGINT) AS total_from_10
    FROM embeddings""")
def array_reduce(spark, sf_dir):
    m = _t(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", _milli).alias("m"))
    return m.select("vec_id", F.aggregate("m", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
                    F.aggregate("m", F.lit(10).cast("bigint"), lambda a, x: a + x).alias("total_from_10"))


@register("array_sort_by_key", ids=("SO-3",), sql=f"""
    SELECT conv_id, turn,
           list_transform(list_sort(list_transform({_TOKENS}, lambda x: {{'k': -length(x), 'w': x}})),
                          lambda s: s.w) AS by_length FROM conversations""")
def array_sort_by_key(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").select("conv_id", "turn", TXT.split_ws("text").alias("w"))
    return c.select("conv_id", "turn", S.sort_by_length_desc("w").alias("by_length"))


@register("json_extract", ids=("SC-25",), views=("weather",), sql="""
    SELECT e.event_id, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
           CAST(json_extract_string(w.json, '$.list[0].main.temp_min') AS BIGINT) AS first_temp_min,
           CAST(json_extract_string(w.json, '$.city.id') AS BIGINT) AS city_id
    FROM events e JOIN weather w USING (event_id)""")
def json_extract(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", "props", FX.weather_json().alias("json")).select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.get_json_object("json", "$.list[0].main.temp_min").cast("bigint").alias("first_temp_min"),
        F.get_json_object("json", "$.city.id").cast("bigint").alias("city_id"))


@register("json_explode", ids=("SC-26", "IO-7"), views=("weather",), sql="""
    WITH p AS (SELECT event_id, json, unnest(range(0, CAST(json_array_length(json, '$.list') AS BIGINT))) AS pos
               FROM weather)
    SELECT event_id, CAST(pos AS INTEGER) AS pos,
           CAST(json_extract_string(json, '$.list[' || pos || '].dt') AS BIGINT) AS dt,
           CAST(json_extract_string(json, '$.list[' || pos || '].main.temp_min') AS BIGINT) AS temp_min,
           CAST(json_extract_string(json, '$.list[' || pos || '].main.humidity') AS BIGINT) AS humidity,
           CAST(json_extract_string(json, '$.list[' || pos || '].rain.3h') AS BIGINT) AS rain_3h
    FROM p""")
def json_explode(spark, sf_dir):
    w = FX.weather(spark, sf_dir).select("event_id", F.from_json("json", WEATHER_SCHEMA).alias("d"))
    ex = w.select("event_id", F.posexplode("d.list").alias("pos", "e"))
    return ex.select("event_id", "pos", F.col("e.dt").alias("dt"), F.col("e.main.temp_min").alias("temp_min"),
                     F.col("e.main.humidity").alias("humidity"), F.col("e.rain.3h").alias("rain_3h"))
