"""Sources, sinks and model round trips; the driver contract on sf0.001."""

import json
import os

from pyspark.sql import functions as F

from fieldkit.operators import ml as ML
from fieldkit.sources import files as IO

from .conftest import SF_SMALL


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_round_trip_and_delimiters(spark, tmp_out):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "id int, name string")
    IO.write_csv(df, os.path.join(tmp_out, "out"))
    back = IO.read_csv(spark, os.path.join(tmp_out, "out"))
    assert sorted(tuple(r) for r in back.collect()) == [("1", "a b"), ("2", "c")]  # all strings
    _write(os.path.join(tmp_out, "t.tsv"), "x\ty\n1\t2\n")
    _write(os.path.join(tmp_out, "p.txt"), "x|y\n3|4\n")
    assert IO.read_csv(spark, os.path.join(tmp_out, "t.tsv"), sep="\t").first().y == "2"
    assert IO.read_csv(spark, os.path.join(tmp_out, "p.txt"), sep="|").first().x == "3"


def test_typed_csv_by_name(spark, tmp_out):
    p = os.path.join(tmp_out, "a.csv")
    _write(p, "b,a,extra\n2,x,9\nnot-a-number,y,9\n")
    df = IO.read_csv_typed(spark, p, "a string, b int")
    assert df.columns == ["a", "b", "_corrupt_record"]
    assert sorted(tuple(r) for r in df.collect()) == [("x", 2, None), ("y", None, "not-a-number,y,9")]
    assert IO.read_csv_typed(spark, p, "a string, b int", bad_rows=None).columns == ["a", "b"]


def test_text_json_and_folder(spark, tmp_out):
    d = os.path.join(tmp_out, "lines")
    os.makedirs(d)
    _write(os.path.join(d, "1.txt"), "one\ntwo\n")
    _write(os.path.join(d, "2.txt"), "three\n")
    assert IO.read_text_lines(spark, d).count() == 3
    j = os.path.join(tmp_out, "cities.json")
    _write(j, json.dumps([{"id": 1, "name": "Nairobi", "coord": {"lon": 36.8, "lat": -1.3}}]))
    df = IO.read_json(spark, j, "id long, name string, coord struct<lon:double, lat:double>")
    r = IO.flatten_struct(df, "coord", ["lon", "lat"]).first()
    assert (r.name, r.lon, r.lat) == ("Nairobi", 36.8, -1.3)
    f = os.path.join(tmp_out, "csvs")
    os.makedirs(f)
    _write(os.path.join(f, "a.csv"), "id,x\n1,2\n")
    _write(os.path.join(f, "b.csv"), "id,y\n3,4\n")
    comb = IO.combine_csv_folder(spark, f)
    assert sorted(comb.columns) == ["id", "x", "y"] and comb.count() == 2


def test_labeled_points_and_polygons(spark, tmp_out):
    lines = spark.createDataFrame([("1 0.5 2.0",), ("0 1.5 3.0",)], "value string")
    pts = IO.parse_labeled_points(lines).collect()
    assert pts[0].label == 1.0 and pts[0].features.toArray().tolist() == [0.5, 2.0]
    g = os.path.join(tmp_out, "poly.json")
    _write(g, json.dumps([{"id": "P", "name": "p", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}]))
    poly = IO.read_polygons_json(spark, g, multiline=True).first()
    assert poly.admin_id == "P" and poly.rings[0][1].x == 1.0 and poly.rings[0][3].x == 0.0


def test_forest_save_load_same_predictions(spark, tmp_out):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    pts = ML.array_features(emb, "embedding").select("vec_id", F.col("label").cast("double").alias("label"), "features")
    train, test = ML.train_test(pts, "vec_id")
    model = ML.fit_forest(train)
    p1 = model.transform(test).select("prediction").collect()
    path = os.path.join(tmp_out, "rf")
    ML.save_model(model, path)
    p2 = ML.load_model(path).transform(test).select("prediction").collect()
    assert p1 == p2
    err = ML.test_error(model.transform(test)).first()
    assert 0.0 <= err.test_error <= 1.0 and err.n_test == test.count()


def test_map_at_k_hand_example(spark):
    rows = [(1, c, s, 2) for c, s in enumerate([0.9, 0.8, 0.7, 0.1, 0.0])] + \
           [(2, c, s, 4) for c, s in enumerate([0.9, 0.8, 0.7, 0.6, 0.5, 0.4])]
    df = spark.createDataFrame(rows, "k long, cls long, score double, label long")
    r = ML.map_at_k(df, "k", "cls", "score", "label", 5).first()
    assert abs(r.map_at_5 - (1 / 3 + 1 / 5) / 2) < 1e-12


def test_driver_contract(spark):
    import __spark_entry__ as E
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 100
    df = E.entry(spark)
    assert df.count() >= 0 and "trp_id" in df.columns


def test_checkpoint_folder_is_required_off_local_masters():
    import types

    import pytest
    from fieldkit.session import ensure_checkpoint_dir
    fake = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda k, d=None: None),
                                 sparkContext=types.SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)
