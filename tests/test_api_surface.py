"""Inspection, caching, accumulator, pandas-interop and UDF surfaces (U items)."""

import pandas as pd
from pyspark.sql import Observation
from pyspark.sql import functions as F

from fieldkit.functions import scalars as S
from fieldkit.operators import frames as PR
from fieldkit.operators import ml as ML

from .conftest import SF_SMALL


def test_schema_table_and_partitions(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    rows = PR.schema_table(df).collect()
    assert [(r.name, r.type) for r in rows] == [("id", "int"), ("name", "string")]
    parts = PR.partition_sizes(spark.range(100).repartition(4))
    assert sum(r.n for r in parts.collect()) == 100


def test_observe_counts_like_an_accumulator(spark):
    # own SQL session: the observation listener stays out of the shared one
    s = spark.newSession()
    obs = Observation("bad")
    df = s.createDataFrame([("1",), ("x",), ("3",)], "p string")
    out = df.observe(obs, F.count_if(F.expr("try_cast(p AS INT)").isNull()).alias("bad"))
    assert out.count() == 3 and obs.get["bad"] == 1


def test_cache_and_pandas_interop(spark):
    df = spark.read.parquet(f"{SF_SMALL}/nation.parquet").cache()
    assert df.count() == 25 and df.is_cached
    pdf = df.groupBy("n_regionkey").count().toPandas()  # small, aggregated result only
    assert int(pdf["count"].sum()) == 25
    ps = df.pandas_api()
    assert len(ps) == 25
    back = spark.createDataFrame(pd.DataFrame({"a": [1, 2]}))
    assert back.count() == 2
    df.unpersist()


def test_typed_udfs_equal_builtins(spark):
    """A typed Python UDF and a pandas UDF (extension points) give the
    built-in parser's answer."""
    import datetime as dt

    @F.udf("timestamp_ntz")
    def parse_row(s):
        return dt.datetime.strptime(s[:-13], "%d-%b-%y %H.%M.%S")

    @F.pandas_udf("timestamp_ntz")
    def parse_batch(s: pd.Series) -> pd.Series:
        return pd.to_datetime(s.str[:-13], format="%d-%b-%y %H.%M.%S")

    df = spark.createDataFrame([("01-Nov-19 13.05.07.000000000 PM",)], "s string")
    r = df.select(parse_row("s").alias("a"), parse_batch("s").alias("b"),
                  S.parse_timestamp("s", tail=13).alias("c")).first()
    assert r.a == r.b == r.c


def test_forest_description_and_label_index(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    pts = ML.array_features(docs, "embedding").withColumn("cls", F.concat(F.lit("c"), F.col("label").cast("string")))
    model = ML.fit_forest(pts, label="cls", index_label=True)
    forest = model.stages[-1]
    assert "Tree 0" in forest.toDebugString and forest.getNumTrees == 3
    imp = ML.feature_importances(model, [f"e{i}" for i in range(64)])
    assert len(imp) == 64 and abs(sum(v for _, v in imp) - 1.0) < 1e-9


def test_count_by_key_to_driver_after_aggregation(spark):
    """AG-7: counts per key reach the driver only as the aggregated result."""
    from fieldkit.operators import aggregates as AG
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    counts = {r.l_returnflag: r.n for r in AG.group_count(df, ["l_returnflag"]).collect()}
    assert sum(counts.values()) == df.count() and set(counts) <= {"A", "N", "R"}


def test_scraped_table_tabulated(spark):
    """HT-6/HT-7: header + rows → typed table → participants per country."""
    from fieldkit.functions import html as H
    from fieldkit.operators import aggregates as AG
    html = ("<table><tr><th>Pos</th><th>Name</th><th>Country</th><th>Time</th><th>Club</th><th>Age</th></tr>"
            + "".join(f"<tr><td>{i}</td><td>Runner {i}</td><td>{c}</td><td>2:1{i}</td><td>X</td><td>3{i}</td></tr>"
                      for i, c in enumerate(["KE", "ET", "KE", "UG", "KE"], start=1)) + "</table>")
    df = spark.createDataFrame([(html,)], "html string")
    rows = df.select(H.table_header("html").alias("h"), F.explode(H.table_rows("html", 5)).alias("r"))
    table = rows.select(F.map_from_arrays("h", "r").alias("m")).select(
        F.col("m")["Name"].alias("name"), F.col("m")["Country"].alias("country"),
        F.col("m")["Age"].try_cast("int").alias("age"))
    got = [(r.country, r.n) for r in AG.value_counts(table, "country").collect()]
    assert got == [("KE", 3), ("ET", 1), ("UG", 1)]


def test_broadcast_hint_in_plan(spark, capsys):
    """JN-11: the fixed code book is joined by broadcast."""
    from fieldkit.plans import catalog
    catalog.queries()["decode_labels"](spark, SF_SMALL).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan
