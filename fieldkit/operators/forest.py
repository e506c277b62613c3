"""A saved random forest as a table of nodes (ML-4, ML-5, ML-6).

``forest_nodes`` reads the nodes of a pipeline written by ``ml.save_model``;
``walk`` scores rows by joins with that table, one join per level of the trees,
and so is a second way beside the model's own ``transform``: where
only the table is at hand, and to check the one by the other. ``tree_summary`` and
``importances`` describe the model from the same table.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkit.operators.joins import broadcast_if_small
from fieldkit.session import cut_lineage

MAX_LEVELS = 31                    # Spark's trees are at most 30 deep
BROADCAST_MAX_BYTES = 32 << 20     # nodes above that are joined by a shuffle
NODE_BYTES = 200


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """One row per node: tree, node, parent, depth, left, right, feature, threshold, left_categories, gain, impurity, stats, n, prediction.

    A leaf has no left, right, feature and gain. A split sends a row to the left
    if its value is at most ``threshold``, or where that is NULL, if it is one of ``left_categories``.
    ``stats`` are the (weighted) training rows of each class, ``n`` their sum.
    """
    data = spark.read.parquet(f"{path.rstrip('/')}/stages/*/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    categorical = F.col("split.numCategories") >= 0
    rows = data.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & ~categorical, F.get(F.col("split.leftCategoriesOrThreshold"), 0)).alias("threshold"),
        F.when(inner & categorical, F.col("split.leftCategoriesOrThreshold")).alias("left_categories"),
        F.when(inner, F.col("gain")).alias("gain"), "impurity", F.col("impurityStats").alias("stats"),
        F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b).alias("n"), "prediction")
    rows = cut_lineage(rows)
    level = rows.where("node = 0").select("tree", "node", F.lit(None).cast("int").alias("parent"), F.lit(0).alias("depth"))
    places = level
    for _ in range(MAX_LEVELS):
        below = level.join(rows.where("left IS NOT NULL"), ["tree", "node"]).select(
            "tree", F.explode(F.array("left", "right")).alias("child"), F.col("node").alias("parent"), F.col("depth") + 1)
        level = cut_lineage(below.toDF("tree", "node", "parent", "depth"))
        if level.isEmpty():
            break
        places = places.union(level)
    return rows.join(places, ["tree", "node"]).select("tree", "node", "parent", "depth", *rows.columns[2:])


def walk(rows: DataFrame, nodes: DataFrame, key: str, features: str = "features") -> DataFrame:
    """(key, tree, node) of the leaf that each row ends in, in each tree. ``features``: an ML vector or an array of doubles."""
    nodes = cut_lineage(nodes)
    depth, trees = nodes.agg(F.max("depth"), F.collect_set("tree")).first()   # a number per tree
    x = F.col(features) if rows.schema[features].dataType.typeName() == "array" else vector_to_array(features)
    at = rows.select(key, x.alias("x"), F.explode(F.array(*[F.lit(t) for t in sorted(trees)])).alias("tree"), F.lit(0).alias("node"))
    splits = broadcast_if_small(nodes.where("left IS NOT NULL").select("tree", "node", "left", "right", "feature", "threshold", "left_categories"),
                                BROADCAST_MAX_BYTES, F.lit(NODE_BYTES))
    value = F.get("x", F.col("feature"))
    to_left = F.when(F.col("threshold").isNotNull(), value <= F.col("threshold")).otherwise(F.array_contains("left_categories", value))
    for _ in range(depth):
        at = at.join(splits, ["tree", "node"], "left").select(
            key, "x", "tree", F.when(F.col("left").isNull(), F.col("node")).when(to_left, F.col("left")).otherwise(F.col("right")).alias("node"))
    return at.drop("x")


def score(rows: DataFrame, nodes: DataFrame, key: str, features: str = "features") -> DataFrame:
    """(key, prediction, probability): each tree votes with the shares of the classes in the row's leaf.

    Votes are added in the order of the trees, as the model does; of classes with equal votes the first wins.
    """
    share = F.transform("stats", lambda s: s / F.col("n"))
    leaves = broadcast_if_small(cut_lineage(nodes.where("left IS NULL").select("tree", "node", share.alias("share"))),
                                BROADCAST_MAX_BYTES, F.lit(NODE_BYTES))
    votes = walk(rows, nodes, key, features).join(leaves, ["tree", "node"]).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("tree", "share"))).alias("v"))   # one per tree
    total = F.aggregate("v", F.transform(F.get("v", F.lit(0))["share"], lambda s: s * 0),
                        lambda a, t: F.zip_with(a, t["share"], lambda p, q: p + q))
    votes = votes.select(key, total.alias("votes"))
    whole = F.aggregate("votes", F.lit(0.0), lambda a, b: a + b)
    return votes.select(key, (F.array_position("votes", F.array_max("votes")) - 1).cast("double").alias("prediction"),
                        F.transform("votes", lambda v: v / whole).alias("probability"))


def tree_summary(nodes: DataFrame) -> DataFrame:
    """Per tree: nodes, leaves, depth, training rows at the root and over all leaves (ML-6)."""
    leaf = F.col("left").isNull()
    return nodes.groupBy("tree").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.count_if(leaf).alias("n_leaves"), F.max("depth").alias("depth"),
        F.sum(F.when(F.col("node") == 0, F.col("n"))).alias("n_root"), F.sum(F.when(leaf, F.col("n"))).alias("n_in_leaves"))


def importances(nodes: DataFrame) -> DataFrame:
    """feature, importance of the features that split (ML-6): gain times rows, shares within each tree, shares of all trees."""
    gains = nodes.where("left IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
    of_tree = gains.groupBy("tree").agg(F.sum("g").alias("of_tree")).where("of_tree > 0")
    shares = gains.join(of_tree, "tree").groupBy("feature").agg(F.sum(F.col("g") / F.col("of_tree")).alias("share"))
    n_trees = of_tree.agg(F.count(F.lit(1)).alias("n_trees"))
    return shares.join(F.broadcast(n_trees)).select("feature", (F.col("share") / F.col("n_trees")).alias("importance"))   # one row
