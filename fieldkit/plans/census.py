"""Census questions (lineitem as persons, orders as households)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldkit.functions.geo import round6
from fieldkit.operators import aggregates as AG
from fieldkit.plans.catalog import register
from fieldkit.sources import fixtures as FX


@register("population_by_province", ids=("AG-3", "SQ-2"), views=("census",), sql="""
    SELECT prov_id, CAST(COUNT(prov_id) AS BIGINT) AS pop FROM census GROUP BY prov_id""")
def population_by_province(spark, sf_dir):
    # SQL surface over a DataFrame argument: no global temp view needed
    return spark.sql("SELECT prov_id, COUNT(prov_id) AS pop FROM {census} GROUP BY prov_id",
                     census=FX.census(spark, sf_dir))


@register("mean_household_size", ids=("AG-5",), views=("census",), sql="""
    SELECT prov_id, floor(avg(n) * 1e6 + 0.5) / 1e6 AS mean_hh_size
    FROM (SELECT hh_id, prov_id, COUNT(*) AS n FROM census GROUP BY hh_id, prov_id)
    GROUP BY ROLLUP (prov_id)""")
def mean_household_size(spark, sf_dir):
    return AG.two_level_mean(FX.census(spark, sf_dir), "hh_id", "prov_id", "mean_hh_size")


@register("mean_age", ids=("AG-1",), views=("census_dirty",), sql="""
    SELECT floor(avg(TRY_CAST(P08 AS DOUBLE)) * 1e6 + 0.5) / 1e6 AS mean_age,
           CAST(count(TRY_CAST(P08 AS DOUBLE)) AS BIGINT) AS n_valid FROM census_dirty""")
def mean_age(spark, sf_dir):
    age = F.expr("try_cast(P08 AS DOUBLE)")
    return FX.census_dirty(spark, sf_dir).agg(round6(F.avg(age)).alias("mean_age"),
                                              F.count(age).alias("n_valid"))


@register("mean_by_key", ids=("AG-2",), views=("census",), sql="""
    SELECT dist_id, floor(avg(age) * 1e6 + 0.5) / 1e6 AS mean_age FROM census GROUP BY dist_id""")
def mean_by_key(spark, sf_dir):
    return AG.mean_by_key(FX.census(spark, sf_dir), "dist_id", "age", "mean_age")


@register("largest_group", ids=("AG-4", "SO-2"), views=("census",), sql="""
    SELECT prov_id, CAST(COUNT(*) AS BIGINT) AS pop FROM census GROUP BY prov_id
    ORDER BY pop DESC, prov_id LIMIT 1""")
def largest_group(spark, sf_dir):
    pop = AG.group_count(FX.census(spark, sf_dir), ["prov_id"], "pop")
    return AG.arg_max(pop, "prov_id", "pop")


@register("largest_group_ties", ids=("AG-4", "SQ-3"), views=("census",), sql="""
    WITH p AS (SELECT dob_yr, CAST(COUNT(*) AS BIGINT) AS pop FROM census GROUP BY dob_yr)
    SELECT * FROM p WHERE pop = (SELECT max(pop) FROM p)""")
def largest_group_ties(spark, sf_dir):
    pop = AG.group_count(FX.census(spark, sf_dir), ["dob_yr"], "pop")
    return AG.arg_max_ties(pop, "pop")


@register("attach_group_size", ids=("JN-1",), views=("census",), sql="""
    SELECT c.hh_id, c.person, c.age, s.hh_size
    FROM census c JOIN (SELECT hh_id, CAST(COUNT(*) AS BIGINT) AS hh_size FROM census GROUP BY hh_id) s
      ON c.hh_id = s.hh_id""")
def attach_group_size(spark, sf_dir):
    # count per household (map-side combined) joined back on the key: unlike a
    # count() window, AQE's skew-join can split a household holding a large
    # share of all rows across tasks
    c = FX.census(spark, sf_dir)
    sizes = c.groupBy("hh_id").agg(F.count(F.lit(1)).alias("hh_size"))
    return c.join(sizes, "hh_id").select("hh_id", "person", "age", "hh_size")


@register("filter_under_five", ids=("PR-3",), views=("census_dirty",), sql="""
    SELECT hh_id, person, TRY_CAST(P08 AS INTEGER) AS age FROM census_dirty
    WHERE TRY_CAST(P08 AS INTEGER) <= 5""")
def filter_under_five(spark, sf_dir):
    # try_cast first: under ANSI a bare comparison on text raises on 'NaN?'
    age = F.expr("try_cast(P08 AS INT)")
    return FX.census_dirty(spark, sf_dir).select("hh_id", "person", age.alias("age")).where(F.col("age") <= 5)


@register("filter_not_equal", ids=("PR-3",), views=("census",), sql="""
    SELECT hh_id, person, sex FROM census WHERE sex <> 'N'""")
def filter_not_equal(spark, sf_dir):
    return FX.census(spark, sf_dir).where(F.col("sex") != "N").select("hh_id", "person", "sex")


@register("filter_isin", ids=("PR-4",), views=("census",), sql="""
    SELECT hh_id, person, prov_id FROM census WHERE prov_id IN ('1', '3', '5')""")
def filter_isin(spark, sf_dir):
    return FX.census(spark, sf_dir).where(F.col("prov_id").isin("1", "3", "5")).select("hh_id", "person", "prov_id")


@register("prefix_key", ids=("SC-1", "UD-1"), sql="""
    SELECT l_orderkey, l_linenumber, left(CAST(l_orderkey AS VARCHAR), 1) AS prov_id,
           left(CAST(l_orderkey AS VARCHAR), 2) AS dist_id FROM lineitem""")
def prefix_key(spark, sf_dir):
    from fieldkit.sources.tables import read_table
    k = F.col("l_orderkey").cast("string")
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.left(k, F.lit(1)).alias("prov_id"), F.left(k, F.lit(2)).alias("dist_id"))


@register("safe_cast", ids=("PR-22",), views=("census_dirty",), sql="""
    SELECT hh_id, person, P08, TRY_CAST(P08 AS INTEGER) AS age FROM census_dirty""")
def safe_cast(spark, sf_dir):
    return FX.census_dirty(spark, sf_dir).select("hh_id", "person", "P08", F.expr("try_cast(P08 AS INT)").alias("age"))


@register("null_counts", ids=("PR-9",), views=("census_dirty",), sql="""
    SELECT CAST(count_if(hh_id IS NULL) AS BIGINT) AS hh_id, CAST(count_if(person IS NULL) AS BIGINT) AS person,
           CAST(count_if(P08 IS NULL) AS BIGINT) AS P08, CAST(count_if(TRY_CAST(P08 AS INTEGER) IS NULL) AS BIGINT) AS age
    FROM census_dirty""")
def null_counts(spark, sf_dir):
    df = FX.census_dirty(spark, sf_dir).select("hh_id", "person", "P08", F.expr("try_cast(P08 AS INT)").alias("age"))
    return AG.null_counts(df)


@register("dropna_any", ids=("PR-8",), views=("census_dirty",), sql="""
    SELECT hh_id, person, P08, TRY_CAST(P08 AS INTEGER) AS age FROM census_dirty
    WHERE hh_id IS NOT NULL AND person IS NOT NULL AND P08 IS NOT NULL AND TRY_CAST(P08 AS INTEGER) IS NOT NULL""")
def dropna_any(spark, sf_dir):
    df = FX.census_dirty(spark, sf_dir).select("hh_id", "person", "P08", F.expr("try_cast(P08 AS INT)").alias("age"))
    return df.na.drop(how="any")


@register("group_fold", ids=("AG-6",), views=("census",), sql="""
    SELECT prov_id, sum(age) AS total_age FROM census GROUP BY prov_id""")
def group_fold(spark, sf_dir):
    # groupByKey + reduce(add) == sum with map-side combine (the fold of + is
    # associative, so the per-key list never needs to be materialised)
    return FX.census(spark, sf_dir).groupBy("prov_id").agg(F.sum("age").alias("total_age"))


@register("value_counts", ids=("AG-9",), views=("census",), sql="""
    SELECT urban_rural, CAST(COUNT(*) AS BIGINT) AS n FROM census GROUP BY urban_rural""")
def value_counts(spark, sf_dir):
    return AG.value_counts(FX.census(spark, sf_dir), "urban_rural")


@register("decode_labels", ids=("JN-9", "JN-11"), views=("census", "codebook"), sql="""
    SELECT c.hh_id, c.person, c.sex, k.label FROM census c JOIN codebook k ON c.sex = k.code""")
def decode_labels(spark, sf_dir):
    # the code book has a fixed, tiny size: a broadcast hash join, no shuffle
    return (FX.census(spark, sf_dir)
            .join(F.broadcast(FX.codebook(spark)), F.col("sex") == F.col("code"))
            .select("hh_id", "person", "sex", "label"))


@register("age_consistency", ids=("SC-17",), views=("census",), sql="""
    SELECT hh_id, person, age, dob_yr, 2030 - dob_yr AS calc_age FROM census
    WHERE CAST(2030 - dob_yr AS DOUBLE) = age""")
def age_consistency(spark, sf_dir, ref_year: int = 2030):
    calc = (F.lit(ref_year) - F.col("dob_yr"))
    return (FX.census(spark, sf_dir).select("hh_id", "person", "age", "dob_yr", calc.alias("calc_age"))
            .where(F.col("calc_age").cast("double") == F.col("age")))
