"""Random-forest training / scoring and ranking metrics (ML-*).

Training is Spark ML (distributed per tree level); scoring is a
``transform``; metrics are aggregates. Nothing is pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldkit.operators.frames import hash_sample, random_split
from fieldkit.params import RF_MAX_BINS, RF_MAX_DEPTH, RF_NUM_TREES, RF_SEED, SAMPLE_FRACTION, SPLIT_WEIGHTS


def array_features(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    """array<float> column → ML vector column (ML-1 for array inputs)."""
    return df.withColumn(out, array_to_vector(F.col(col)))


def assembler(cols: Sequence[str], out: str = "features") -> VectorAssembler:
    """Feature vector from columns in a fixed order; rows with invalid
    values are skipped (ML-1)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip")


def random_forest(label: str = "label", features: str = "features", num_trees: int = RF_NUM_TREES,
                  max_depth: int = RF_MAX_DEPTH, max_bins: int = RF_MAX_BINS, seed: int = RF_SEED,
                  ) -> RandomForestClassifier:
    """Classifier with the reference's settings: 3 trees, gini, depth 4,
    32 bins, automatic feature subsets (ML-2, ML-3)."""
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=num_trees, maxDepth=max_depth,
                                  maxBins=max_bins, impurity="gini", featureSubsetStrategy="auto", seed=seed)


def train_test(df: DataFrame, key: str, weights=SPLIT_WEIGHTS, seed: int = RF_SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by the key's hash: no row is in both or in neither, however the jobs are laid out."""
    parts = random_split(df, key, weights, seed)
    return parts.where("split = 0").drop("split"), parts.where("split = 1").drop("split")


def prepared(df: DataFrame, key: str, fraction: float = SAMPLE_FRACTION, seed: int = RF_SEED) -> DataFrame:
    """First stages of a training job: rows with a NULL dropped, then a reproducible sample (ML-8)."""
    return hash_sample(df.na.drop(how="any"), key, fraction, seed + 1)


def fit_forest(train: DataFrame, feature_cols: Sequence[str] | None = None, label: str = "label",
               index_label: bool = False, **rf) -> PipelineModel:
    """End-to-end pipeline: optional label indexing, assembly, forest (ML-8, ML-9)."""
    stages = []
    lab = label
    if index_label:
        stages.append(StringIndexer(inputCol=label, outputCol="label_idx", handleInvalid="skip"))
        lab = "label_idx"
    if feature_cols:
        stages.append(assembler(feature_cols))
    stages.append(random_forest(label=lab, **rf))
    return Pipeline(stages=stages).fit(train)


def test_error(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction differs from the label (ML-5)."""
    return pred.agg(F.avg((F.col(label).cast("double") != F.col(prediction)).cast("double")).alias("test_error"),
                    F.count(F.lit(1)).alias("n_test"))


def map_at_k(scores: DataFrame, key: str, cls: str, score: str, label: str, k: int = 5) -> DataFrame:
    """Mean average precision at k with one relevant class per key (ML-7):
    1 / rank of the label among the k best-scored classes, else 0. Ranks
    come from a window over each key's (bounded) class list."""
    w = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(cls))
    ranked = scores.withColumn("_r", F.row_number().over(w))
    per_key = ranked.groupBy(key).agg(
        F.max(F.when((F.col("_r") <= k) & (F.col(cls) == F.col(label)), 1.0 / F.col("_r")).otherwise(0.0)).alias("ap"))
    return per_key.agg(F.avg("ap").alias(f"map_at_{k}"), F.count(F.lit(1)).alias("n"))


def feature_importances(model: PipelineModel, names: Sequence[str]) -> list[tuple[str, float]]:
    """Forest feature importances paired with names (ML-6)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return list(zip(names, imp))


def save_model(model: PipelineModel, path: str) -> None:
    """Write a fitted pipeline, replacing what is there (IO-15)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
