"""A saved forest as a table: scores by joins and descriptions, against the model itself."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldkit.operators import forest as FO
from fieldkit.operators import ml as ML


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        kind = rnd.choice("abcde")
        u, v = rnd.uniform(-1, 1), rnd.choice([0.0, 1.0, 2.0])
        label = float((u > 0.2) + (kind in "bd") * (v > 0))
        rows.append((i, kind, u, v, label))
    from pyspark.ml.feature import StringIndexer
    df = spark.createDataFrame(rows, "id long, kind string, u double, v double, label double")
    return StringIndexer(inputCol="kind", outputCol="k").fit(df).transform(df)


def fitted(data, tmp_path, **kw):
    model = ML.fit_forest(data, feature_cols=["u", "v", "k"], **kw)
    ML.save_model(model, str(tmp_path / "m"))
    return model, FO.forest_nodes(data.sparkSession, str(tmp_path / "m"))


@pytest.mark.parametrize("kw", [{}, {"num_trees": 1, "max_depth": 1}, {"num_trees": 8, "max_depth": 9, "seed": 3}, {"num_trees": 2, "max_depth": 0}])
@pytest.mark.parametrize("limit", [FO.BROADCAST_MAX_BYTES, 0])
def test_walk_equals_the_model(spark, data, tmp_path, monkeypatch, kw, limit):
    monkeypatch.setattr(FO, "BROADCAST_MAX_BYTES", limit)
    model, nodes = fitted(data, tmp_path, **kw)
    own = model.transform(data)
    want = {r.id: (r.prediction, r.p) for r in own.select("id", "prediction", vector_to_array("probability").alias("p")).collect()}
    got = {r.id: (r.prediction, r.probability) for r in FO.score(own.select("id", "features"), nodes, "id").collect()}
    assert {i: p for i, (p, _) in got.items()} == {i: p for i, (p, _) in want.items()}
    assert all(got[i][1] == pytest.approx(p, abs=1e-12) for i, (_, p) in want.items())
    arrays = own.select("id", vector_to_array("features").alias("features"))
    assert FO.walk(arrays, nodes, "id").count() == data.count() * model.stages[-1].getNumTrees


def test_description(spark, data, tmp_path):
    model, nodes = fitted(data, tmp_path, num_trees=4, max_depth=6)
    forest = model.stages[-1]
    summary = {r.tree: r for r in FO.tree_summary(nodes).collect()}
    assert {t: (r.n_nodes, r.depth) for t, r in summary.items()} == {k: (t.numNodes, t.depth) for k, t in enumerate(forest.trees)}
    assert all(r.n_nodes == 2 * r.n_leaves - 1 and r.n_root == r.n_in_leaves for r in summary.values())
    imp = {r.feature: r.importance for r in FO.importances(nodes).collect()}
    assert [imp.get(k, 0.0) for k in range(3)] == pytest.approx(forest.featureImportances.toArray().tolist(), abs=1e-12)
    rows = nodes.collect()
    assert any(r.left_categories for r in rows) and any(r.threshold is not None for r in rows)
    at = {(r.tree, r.node): r for r in rows}
    for r in rows:
        assert (r.left is None) == (r.feature is None) == (r.gain is None)
        assert (r.parent is None) == (r.node == 0)
        if r.parent is not None:
            up = at[r.tree, r.parent]
            assert r.node in (up.left, up.right) and r.depth == up.depth + 1 and r.n <= up.n


def test_equal_votes_go_to_the_first_class(spark):
    nodes = spark.createDataFrame([(t, 0, None, 0, None, None, None, None, None, None, 0.5, [1.0, 1.0, 0.0], 2.0, 0.0) for t in (0, 1)],
                                  "tree int, node int, parent int, depth int, left int, right int, feature int, threshold double, "
                                  "left_categories array<double>, gain double, impurity double, stats array<double>, n double, prediction double")
    rows = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, features array<double>")
    assert [(r.prediction, r.probability) for r in FO.score(rows, nodes, "id").collect()] == [(0.0, [0.5, 0.5, 0.0])] * 2
    assert FO.importances(nodes).collect() == []
    assert FO.score(rows.where(F.lit(False)), nodes, "id").collect() == []
