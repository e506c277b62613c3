"""Random-forest and ranking-metric queries (ML-*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldkit.functions.geo import round6
from fieldkit.operators import forest as FO
from fieldkit.operators import ml as ML
from fieldkit.plans.catalog import register
from fieldkit.plans.oracle_views import r6
from fieldkit.sources import fixtures as FX
from fieldkit.session import ensure_checkpoint_dir
from fieldkit.sources.tables import read_table


def _points(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    return ML.array_features(emb, "embedding").select("vec_id", F.col("label").cast("double").alias("label"),
                                                      "features")


def _predictions(spark, sf_dir):
    train, test = ML.train_test(_points(spark, sf_dir), "vec_id")
    model = ML.fit_forest(train)
    return model.transform(test)


@register("rf_predictions", ids=("ML-1", "ML-2", "ML-3", "ML-4", "ML-8"))
def rf_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir).select("vec_id", "label", "prediction")


@register("rf_test_error", ids=("ML-5",))
def rf_test_error(spark, sf_dir):
    return ML.test_error(_predictions(spark, sf_dir))


@register("map_at_5", ids=("ML-7",), views=("scores",), sql=f"""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, cls) AS rk FROM scores),
         a AS (SELECT vec_id, max(CASE WHEN rk <= 5 AND cls = label THEN 1.0 / rk ELSE 0.0 END) AS ap
               FROM r GROUP BY vec_id)
    SELECT {r6('avg(ap)')} AS map_at_5, CAST(count(*) AS BIGINT) AS n FROM a""")
def map_at_5(spark, sf_dir):
    m = ML.map_at_k(FX.scores(spark, sf_dir), "vec_id", "cls", "score", "label", 5)
    return m.select(round6("map_at_5").alias("map_at_5"), "n")


def _quality(spark, sf_dir):
    """Train and test rows of document quality: labels joined to documents, simple text features, language indexed."""
    from pyspark.ml.feature import StringIndexer
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"))
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    data = StringIndexer(inputCol="lang", outputCol="lang_idx", handleInvalid="keep").fit(docs).transform(docs)
    return ML.train_test(ML.prepared(data.join(lab, "doc_id"), "doc_id"), "doc_id")


_QUALITY_FEATURES = ["n_chars", "n_lines", "lang_idx"]


@register("rf_quality_predictions", ids=("ML-1", "ML-3", "ML-8", "ML-9"))
def rf_quality_predictions(spark, sf_dir):
    """Document quality from simple text features, columns assembled in a fixed order."""
    train, test = _quality(spark, sf_dir)
    model = ML.fit_forest(train, feature_cols=_QUALITY_FEATURES)
    return model.transform(test).select("doc_id", "label", "prediction")


def _saved(spark, model):
    """The nodes of a fitted pipeline, read from where it was written."""
    at = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    ML.save_model(model, at)
    return FO.forest_nodes(spark, at)


def _two_ways(predictions, nodes, key):
    """How the model's predictions and those by joins with its nodes compare, in one row."""
    from pyspark.ml.functions import vector_to_array
    own = predictions.select(key, "label", "prediction", vector_to_array("probability").alias("probability"))
    other = FO.score(predictions.select(key, "features"), nodes, key).toDF(key, "prediction_2", "probability_2")
    both = own.join(other, key, "left")
    gap = F.array_max(F.zip_with("probability", "probability_2", lambda p, q: F.abs(p - q)))
    told = both.agg(
        F.count(F.lit(1)).alias("n_test"), F.count_if(~F.col("prediction").eqNullSafe(F.col("prediction_2"))).alias("n_different"),
        F.count_if(F.coalesce(gap, F.lit(1.0)) > 1e-12).alias("n_other_probability"),
        F.count_if(F.col("prediction_2") != F.col("label")).alias("n_wrong"))
    error = ML.test_error(predictions)
    return told.join(F.broadcast(error.select("test_error"))).select(   # a row each
        "n_test", "n_different", "n_other_probability",
        (F.round(F.col("test_error") * F.col("n_test")) == F.col("n_wrong")).alias("error_is_the_count"))


_SPLIT_0 = "CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0"


@register("forest_two_ways", ids=("ML-2", "ML-3", "ML-4", "ML-5", "ML-8"), sql=f"""
    SELECT CAST(count(*) AS BIGINT) AS n_test, CAST(0 AS BIGINT) AS n_different, CAST(0 AS BIGINT) AS n_other_probability,
           true AS error_is_the_count
    FROM embeddings WHERE {_SPLIT_0.format(seed=42, key="vec_id")} >= 0.7""")
def forest_two_ways(spark, sf_dir):
    """Every test row scored by the model and by walking its saved nodes: both agree, and the error is the count of wrong ones."""
    train, test = ML.train_test(_points(spark, sf_dir), "vec_id")
    model = ML.fit_forest(train)
    return _two_ways(model.transform(test), _saved(spark, model), "vec_id")


@register("forest_two_ways_quality", ids=("ML-1", "ML-3", "ML-4", "ML-5", "ML-8", "ML-9"), sql=f"""
    SELECT CAST(count(*) AS BIGINT) AS n_test, CAST(0 AS BIGINT) AS n_different, CAST(0 AS BIGINT) AS n_other_probability,
           true AS error_is_the_count
    FROM documents JOIN labels USING (doc_id)
    WHERE lang IS NOT NULL AND n_chars IS NOT NULL AND text IS NOT NULL AND quality IS NOT NULL
      AND {_SPLIT_0.format(seed=43, key="doc_id")} < 0.5 AND {_SPLIT_0.format(seed=42, key="doc_id")} >= 0.7""")
def forest_two_ways_quality(spark, sf_dir):
    """The same for a job with dropped nulls, a sample, assembled columns and a categorical feature."""
    train, test = _quality(spark, sf_dir)
    model = ML.fit_forest(train, feature_cols=_QUALITY_FEATURES)
    return _two_ways(model.transform(test), _saved(spark, model), "doc_id")


@register("forest_nodes", ids=("ML-6",))
def forest_nodes(spark, sf_dir):
    """The fitted forest as rows: every node with its split, gain and training rows per class."""
    train, _ = ML.train_test(_points(spark, sf_dir), "vec_id")
    return _saved(spark, ML.fit_forest(train))


@register("forest_description", ids=("ML-6",), sql="""
    SELECT CAST(t.range AS INTEGER) AS tree, true AS same_nodes, true AS same_depth, true AS within_depth, true AS leaves_and_splits,
           true AS leaves_hold_the_root, CAST(max(len(embedding)) AS BIGINT) AS n_features, CAST(0 AS BIGINT) AS n_other_importance,
           1.0::DOUBLE AS importance_sum
    FROM embeddings, range(3) t GROUP BY t.range""")
def forest_description(spark, sf_dir):
    """Per tree: what the table of nodes says against what the model says of itself; importances against the model's."""
    train, _ = ML.train_test(_points(spark, sf_dir), "vec_id")
    model = ML.fit_forest(train)
    nodes = _saved(spark, model)
    forest = model.stages[-1]
    said = spark.createDataFrame([(k, t.numNodes, t.depth) for k, t in enumerate(forest.trees)],   # a row per tree
                                 "tree int, said_nodes long, said_depth int")
    own = spark.createDataFrame(list(enumerate(forest.featureImportances.toArray().tolist())), "feature int, said double")   # and per feature
    imp = own.join(FO.importances(nodes), "feature", "left").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_if(F.abs(F.col("said") - F.coalesce("importance", F.lit(0.0))) > 1e-9).alias("n_other_importance"),
        round6(F.sum("importance")).alias("importance_sum"))
    trees = FO.tree_summary(nodes).join(said, "tree", "full_outer")
    return trees.join(F.broadcast(imp)).select(   # one row
        "tree", (F.col("n_nodes") == F.col("said_nodes")).alias("same_nodes"), (F.col("depth") == F.col("said_depth")).alias("same_depth"),
        (F.col("depth") <= forest.getOrDefault("maxDepth")).alias("within_depth"),
        (F.col("n_nodes") == 2 * F.col("n_leaves") - 1).alias("leaves_and_splits"),
        (F.col("n_root") == F.col("n_in_leaves")).alias("leaves_hold_the_root"), "n_features", "n_other_importance", "importance_sum")


@register("model_round_trip", ids=("IO-15", "ML-4"), sql="""
    SELECT CAST(count(*) AS BIGINT) AS n_test, CAST(0 AS BIGINT) AS n_different FROM embeddings
    WHERE CAST(('0x' || substr(md5('42:' || CAST(vec_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.7""")
def model_round_trip(spark, sf_dir):
    """A forest written to the shared folder and read back scores the test rows as before."""
    train, test = ML.train_test(_points(spark, sf_dir), "vec_id")
    model = ML.fit_forest(train)
    at = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    ML.save_model(model, at)
    first = model.transform(test).select("vec_id", F.col("prediction").alias("a"))
    again = ML.load_model(at).transform(test).select("vec_id", F.col("prediction").alias("b"))
    return first.join(again, "vec_id").agg(F.count(F.lit(1)).alias("n_test"), F.count_if(F.col("a") != F.col("b")).alias("n_different"))
