"""Scans, projections, joins, set operations, sorting and small aggregates
over the TPC-H-style tables and the site fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldkit.functions.geo import round6
from fieldkit.operators import aggregates as AG
from fieldkit.operators import frames as PR
from fieldkit.operators import joins as JN
from fieldkit.plans.catalog import register
from fieldkit.plans.oracle_views import r6
from fieldkit.sources import fixtures as FX
from fieldkit.sources.tables import read_table

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")   # of the oracle text; the query asks the table


def _md5_fraction(key: str, seed: int = 42) -> str:
    """``frames.key_fraction`` as DuckDB text."""
    return f"(CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0)"


def _t(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


@register("read_limit", ids=("IO-8", "PR-15"), sql="""
    SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 100""")
def read_limit(spark, sf_dir):
    # first-N read made deterministic with an order: TakeOrderedAndProject
    return _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type").orderBy("event_id").limit(100)


@register("read_columns", ids=("IO-9",), sql="""
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem""")
def read_columns(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@register("read_filter_project", ids=("IO-10",), sql="""
    SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'""")
def read_filter_project(spark, sf_dir):
    # filter + projection reach the parquet scan (PushedFilters / ReadSchema)
    return (_t(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
            .select("event_id", "user_id", "value"))


@register("project_columns", ids=("PR-1", "SQ-1"), sql="""
    SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def project_columns(spark, sf_dir):
    return spark.sql("SELECT c_custkey, c_name, c_mktsegment FROM {customer}",
                     customer=_t(spark, sf_dir, "customer"))


@register("flag_column", ids=("PR-2",), sql="""
    SELECT c_custkey, c_mktsegment = 'BUILDING' AS flag_expr, c_mktsegment = 'BUILDING' AS flag_col,
           c_acctbal > 5000 AS rich FROM customer""")
def flag_column(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return (c.withColumn("flag_expr", F.expr("c_mktsegment = 'BUILDING'"))
            .withColumn("flag_col", F.col("c_mktsegment") == "BUILDING")
            .withColumn("rich", F.col("c_acctbal") > 5000)
            .select("c_custkey", "flag_expr", "flag_col", "rich"))


@register("rename_columns", ids=("PR-5",), sql="""
    SELECT n_nationkey AS nation_id, n_name AS nation, n_regionkey AS region_id FROM nation""")
def rename_columns(spark, sf_dir):
    return _t(spark, sf_dir, "nation").withColumnsRenamed(
        {"n_nationkey": "nation_id", "n_name": "nation", "n_regionkey": "region_id"})


@register("drop_columns", ids=("PR-7",), sql="""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def drop_columns(spark, sf_dir):
    return _t(spark, sf_dir, "orders").drop("o_orderdate", "o_orderpriority")


@register("distinct_values", ids=("PR-10",), sql="SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select("o_orderpriority").distinct()


@register("distinct_count", ids=("PR-10",), sql="""
    SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_customers FROM orders""")
def distinct_count(spark, sf_dir):
    return _t(spark, sf_dir, "orders").agg(F.count_distinct("o_custkey").alias("n_customers"))


@register("dedup_first", ids=("PR-11",), views=("pings",), sql="""
    SELECT user_id, site_id, ts, event_id, x, y FROM (
      SELECT user_id, site_id, ts, event_id, x, y,
             row_number() OVER (PARTITION BY user_id, site_id ORDER BY ts, event_id) AS rn FROM pings)
    WHERE rn = 1""")
def dedup_first(spark, sf_dir):
    p = FX.pings(spark, sf_dir).select("user_id", "site_id", "ts", "event_id", "x", "y")
    return PR.dedup_first(p, ["user_id", "site_id"], ["ts", "event_id"])


@register("sample_fraction", ids=("PR-12",))
def sample_fraction(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").sample(withReplacement=False, fraction=0.1, seed=42)


@register("sample_hash", ids=("PR-12",), sql=f"SELECT * FROM lineitem WHERE {_md5_fraction('l_orderkey')} < 0.1")
def sample_hash(spark, sf_dir):
    # reproducible ~10 % sample: the same rows for any partitioning or rerun
    return PR.hash_sample(_t(spark, sf_dir, "lineitem"), "l_orderkey", 0.1, seed=42)


@register("sample_users", ids=("PR-13",), views=("pings",), sql=f"""
    SELECT user_id, event_id, ts, event_type, site_id, x, y FROM pings
    WHERE user_id IN (SELECT user_id FROM (SELECT DISTINCT user_id FROM pings)
                      ORDER BY {_md5_fraction('user_id')}, user_id LIMIT 10)""")
def sample_users(spark, sf_dir):
    return PR.sample_users(FX.pings(spark, sf_dir), "user_id", k=10, seed=42)


@register("random_split", ids=("PR-14",), sql=f"""
    SELECT o_orderkey, o_totalprice, CAST({_md5_fraction('o_orderkey')} >= 0.7 AS INTEGER) AS split FROM orders""")
def random_split(spark, sf_dir):
    return PR.random_split(_t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", [0.7, 0.3])


@register("row_count", ids=("PR-16",), sql="SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem")
def row_count(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def _summary_sql(table: str, numeric: tuple[str, ...], text: tuple[str, ...]) -> str:
    one = lambda c, num: (
        f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS \"count\", "
        + (f"{r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std, " if num
           else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, ")
        + f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, "
        + (", ".join(f"{r6(f'quantile_cont(CAST({c} AS DOUBLE), {p / 100})')} AS p{p}" for p in (25, 50, 75)) if num
           else ", ".join(f"CAST(NULL AS DOUBLE) AS p{p}" for p in (25, 50, 75))) + f" FROM {table}")
    return " UNION ALL ".join([one(c, True) for c in numeric] + [one(c, False) for c in text])


@register("summary_stats", ids=("PR-18",), sql=_summary_sql("orders", ("o_orderkey", "o_custkey"), ("o_orderpriority", "o_orderstatus")))
def summary_stats(spark, sf_dir):
    return PR.summary_stats(_t(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"])


@register("quartiles", ids=("PR-18",), sql=f"""
    SELECT {', '.join(f"{r6(f'quantile_cont(CAST(l_extendedprice AS DOUBLE), {p / 100})')} AS p{p}" for p in (25, 50, 75))}
    FROM lineitem""")
def quartiles(spark, sf_dir):
    q = PR.exact_quantiles(_t(spark, sf_dir, "lineitem"), "l_extendedprice", (0.25, 0.5, 0.75))
    return q.select(*[round6(f"q{k}").alias(f"p{p}") for k, p in enumerate((25, 50, 75))])


@register("enrich_with_site", ids=("JN-2", "MB-1", "PR-6", "ST-1"), views=("pings", "sites_2g", "sites_3g"), sql="""
    WITH s AS (SELECT "Cell ID" AS Cell_ID, Longitude, Latitude, NULL AS Site_Name FROM sites_2g
               UNION ALL SELECT "Cell ID", Longitude, Latitude, "Site Name" FROM sites_3g)
    SELECT CAST(p.user_id AS VARCHAR) AS calling_imei, p.event_id AS event_id,
           CAST(p.site_id AS VARCHAR) AS last_calling_cellid, s.Cell_ID, s.Longitude, s.Latitude, s.Site_Name,
           'both' AS _merge
    FROM pings p JOIN s ON CAST(p.site_id AS VARCHAR) = s.Cell_ID""")
def enrich_with_site(spark, sf_dir):
    out = JN.enrich_with_site(FX.cdrs(spark, sf_dir), [FX.sites_2g(spark, sf_dir), FX.sites_3g(spark, sf_dir)],
                              "last_calling_cellid", "Cell_ID")
    return out.select("calling_imei", "event_id", "last_calling_cellid", "Cell_ID", "Longitude", "Latitude",
                      "Site_Name", "_merge")


@register("match_coverage", ids=("JN-3",), views=("pings", "sites_2g", "sites_3g"), sql="""
    WITH s AS (SELECT * FROM (SELECT "Cell ID" AS id FROM sites_2g UNION SELECT "Cell ID" FROM sites_3g)
               WHERE CAST(id AS INTEGER) < 95),
         e AS (SELECT CAST(site_id AS VARCHAR) AS id, count(*) AS n FROM pings GROUP BY 1)
    SELECT CAST((SELECT sum(n) FROM e) AS BIGINT) AS n_events,
           CAST((SELECT count(*) FROM e) AS BIGINT) AS n_event_ids,
           CAST((SELECT count(*) FROM s) AS BIGINT) AS n_site_ids,
           CAST((SELECT count(*) FROM e JOIN s USING (id)) AS BIGINT) AS n_matched_ids,
           CAST((SELECT coalesce(sum(n), 0) FROM e JOIN s USING (id)) AS BIGINT) AS n_matched_events""")
def match_coverage(spark, sf_dir):
    sites = PR.union_all_by_name([PR.remove_spaces_in_colnames(FX.sites_2g(spark, sf_dir)),
                                  PR.remove_spaces_in_colnames(FX.sites_3g(spark, sf_dir))])
    sites = sites.where(F.col("Cell_ID").cast("int") < 95)   # partial coverage is what is measured
    return JN.match_coverage(PR.remove_spaces_in_colnames(FX.cdrs(spark, sf_dir)), sites,
                             "last_calling_cellid", "Cell_ID")


@register("union_sites", ids=("ST-1", "PR-6"), views=("pings", "sites_2g", "sites_3g"), sql="""
    SELECT "Cell ID" AS Cell_ID, Longitude, Latitude, NULL AS Site_Name FROM sites_2g
    UNION ALL SELECT "Cell ID", Longitude, Latitude, "Site Name" FROM sites_3g""")
def union_sites(spark, sf_dir):
    return PR.union_all_by_name([PR.remove_spaces_in_colnames(FX.sites_2g(spark, sf_dir)),
                                 PR.remove_spaces_in_colnames(FX.sites_3g(spark, sf_dir))])


@register("union_many", ids=("ST-2",), sql="""
    SELECT 'customer' AS kind, c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
           c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier
    UNION ALL SELECT 'nation', n_nationkey, n_name, n_nationkey, NULL, NULL FROM nation""")
def union_many(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"),
                                             F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
                                             F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = _t(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"),
                                             F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
                                             F.col("s_acctbal").alias("acctbal"))
    n = _t(spark, sf_dir, "nation").select(F.lit("nation").alias("kind"), F.col("n_nationkey").cast("bigint").alias("key"),
                                           F.col("n_name").alias("name"), F.col("n_nationkey").alias("nationkey"))
    return PR.union_all_by_name([c, s, n])


@register("top_k", ids=("SO-2", "SO-1"), sql="""
    SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10""")
def top_k(spark, sf_dir):
    return (_t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
            .orderBy(F.col("c_acctbal").desc(), "c_custkey").limit(10))


@register("max_row", ids=("AG-10", "SO-4"), sql="""
    SELECT o_totalprice, o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1""")
def max_row(spark, sf_dir):
    return AG.max_row(_t(spark, sf_dir, "orders"), "o_totalprice", ["o_orderkey", "o_custkey"])


@register("date_range", ids=("AG-11",), sql="""
    SELECT min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders""")
def date_range(spark, sf_dir):
    return AG.date_range(_t(spark, sf_dir, "orders"), "o_orderdate")


@register("pivot_wide", ids=("AG-19",), sql="""
    WITH s AS (SELECT r_name, CAST(year(o_orderdate) AS INTEGER) AS yr, o_totalprice
               FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey)
    SELECT yr, """ + ", ".join(
        f"CAST(count_if(r_name = '{r}') AS BIGINT) AS \"{r}\"" for r in REGIONS) + """ FROM s GROUP BY yr""")
def pivot_wide(spark, sf_dir):
    return AG.pivot_dense(_orders_by_region(spark, sf_dir), ["yr"], "r_name", _regions(spark, sf_dir))


@register("pivot_values", ids=("AG-19",), sql="""
    WITH s AS (SELECT r_name, CAST(year(o_orderdate) AS INTEGER) AS yr, o_totalprice
               FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey)
    SELECT yr, """ + ", ".join(f"max(CASE WHEN r_name = '{r}' THEN o_totalprice END) AS \"{r}\"" for r in REGIONS)
          + """ FROM s GROUP BY yr""")
def pivot_values(spark, sf_dir):
    return AG.pivot_values(_orders_by_region(spark, sf_dir), ["yr"], "r_name", "o_totalprice", F.max, _regions(spark, sf_dir))


def _regions(spark, sf_dir):
    return AG.pivot_keys(_t(spark, sf_dir, "region"), "r_name")


def _orders_by_region(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("yr"), "o_totalprice")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = _t(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey))


@register("centroid", ids=("AG-20",), views=("pings",), sql=f"""
    SELECT user_id, {r6('sum(x) / count(*)')} AS cx, {r6('sum(y) / count(*)')} AS cy
    FROM (SELECT DISTINCT user_id, x, y FROM pings) GROUP BY user_id""")
def centroid(spark, sf_dir):
    locs = FX.pings(spark, sf_dir).select("user_id", "x", "y").distinct()
    return AG.centroid(locs, ["user_id"])


@register("centroid_weighted", ids=("AG-20",), views=("pings",), sql=f"""
    SELECT user_id, {r6('sum(x * freq) / sum(freq)')} AS cx, {r6('sum(y * freq) / sum(freq)')} AS cy
    FROM (SELECT user_id, x, y, CAST(count(*) AS DOUBLE) AS freq FROM pings GROUP BY ALL) GROUP BY user_id""")
def centroid_weighted(spark, sf_dir):
    locs = FX.pings(spark, sf_dir).groupBy("user_id", "x", "y").agg(F.count(F.lit(1)).cast("double").alias("freq"))
    return AG.centroid(locs, ["user_id"], weight="freq")


@register("events_per_day_dense", ids=("JN-7", "SC-14"), sql="""
    WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
    r AS (SELECT min(CAST(ts AS DATE)) AS d0, max(CAST(ts AS DATE)) AS d1 FROM events),
    s AS (SELECT u.user_id, CAST(g.day AS DATE) AS day FROM (SELECT DISTINCT user_id FROM events) u, r,
          generate_series(CAST(r.d0 AS TIMESTAMP), CAST(r.d1 AS TIMESTAMP), INTERVAL 1 DAY) g(day))
    SELECT s.user_id, s.day, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM s LEFT JOIN c USING (user_id, day)""")
def events_per_day_dense(spark, sf_dir):
    return JN.dense_daily_counts(_t(spark, sf_dir, "events"), "user_id")


@register("date_spine", ids=("SC-14",), sql="""
    SELECT CAST(g.day AS DATE) AS day FROM (SELECT min(CAST(ts AS DATE)) AS d0, max(CAST(ts AS DATE)) AS d1 FROM events) r,
      generate_series(CAST(r.d0 AS TIMESTAMP), CAST(r.d1 AS TIMESTAMP), INTERVAL 1 DAY) g(day)""")
def date_spine(spark, sf_dir):
    return spark.sql("""SELECT explode(sequence(min(to_date(ts)), max(to_date(ts)), INTERVAL 1 DAY)) AS day
                        FROM {e}""", e=_t(spark, sf_dir, "events"))


@register("lookup_case_insensitive", ids=("JN-10",), sql="""
    SELECT n_nationkey, n_name, q.query FROM nation
    JOIN (VALUES ('nation_3'), ('NATION_7'), ('Nation_12'), ('atlantis')) q(query) ON lower(n_name) = lower(q.query)""")
def lookup_case_insensitive(spark, sf_dir):
    out = JN.lookup_case_insensitive(_t(spark, sf_dir, "nation"), "n_name",
                                     ["nation_3", "NATION_7", "Nation_12", "atlantis"])
    return out.select("n_nationkey", "n_name", "query")


@register("pandas_api_mean", ids=("IO-12", "PR-23"), sql=f"""
    SELECT l_returnflag, {r6('avg(l_quantity)')} AS mean_qty, CAST(count(*) AS BIGINT) AS n
    FROM lineitem GROUP BY l_returnflag""")
def pandas_api_mean(spark, sf_dir):
    # pandas-style code on the pandas API over Spark: the group-by runs as a
    # Spark aggregate; the 'distributed' default index avoids a sequence job
    import pyspark.pandas as ps
    with ps.option_context("compute.default_index_type", "distributed"):
        psdf = _t(spark, sf_dir, "lineitem").pandas_api()
        g = psdf.groupby("l_returnflag").agg(mean_qty=("l_quantity", "mean"), n=("l_quantity", "count"))
        out = g.reset_index().to_spark()
    return out.select("l_returnflag", round6("mean_qty").alias("mean_qty"), F.col("n").cast("bigint").alias("n"))


@register("attach_mean_price", ids=("JN-1",), sql=f"""
    SELECT o_orderkey, o_orderpriority, {r6('m.mean')} AS mean_price, CAST(m.n AS BIGINT) AS n
    FROM orders JOIN (SELECT o_orderpriority, avg(o_totalprice) AS mean, count(*) AS n FROM orders GROUP BY ALL) m
    USING (o_orderpriority)""")
def attach_mean_price(spark, sf_dir):
    """Every order with the mean price and size of its priority group."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    m = o.groupBy("o_orderpriority").agg(round6(F.avg("o_totalprice")).alias("mean_price"), F.count(F.lit(1)).alias("n"))
    return o.join(m, "o_orderpriority").select("o_orderkey", "o_orderpriority", "mean_price", "n")


@register("schema_columns", ids=("PR-17",), sql="""
    SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS pos, column_name AS name,
           CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
                WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type, true AS nullable, n_values
    FROM (DESCRIBE SELECT * FROM orders) JOIN (
      UNPIVOT (SELECT count(COLUMNS(*)) FROM orders) ON COLUMNS(*) INTO NAME column_name VALUE n_values) USING (column_name)""")
def schema_columns(spark, sf_dir):
    """Every column of a table with its type and how many values it holds."""
    return PR.schema_table(_t(spark, sf_dir, "orders"))


@register("partition_rows", ids=("PR-19",), sql="""
    SELECT CAST(count(*) AS BIGINT) AS n_rows FROM lineitem""")
def partition_rows(spark, sf_dir):
    """Rows per partition, counted on the executors, add up to the table."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey").repartition(8, "l_orderkey")
    return PR.partition_sizes(li).agg(F.sum("n").alias("n_rows"))
