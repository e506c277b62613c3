import zlib

import numpy as np
import pytest

import corpus_pipeline
from fieldkit.llm import embed_dedup, line_dedup, mixing, packing, quality, simhash, toxicity

from . import brute


# --- embeddings ---------------------------------------------------------------------------------------------------

def vectors(seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(25):
        centre = rng.normal(size=16)
        out += [centre + rng.normal(scale=s, size=16) * np.linalg.norm(centre) / 4 for s in rng.uniform(0, 0.4, 8)]
    out += list(rng.normal(size=(200, 16)))
    out += [out[0], out[0], out[0] * 3]
    return [v.astype(np.float64) for v in out]


@pytest.mark.parametrize("cell", [1024, 3])
def test_links_and_components(spark, cell):
    xs = vectors()
    near = brute.cosine_links(xs, 0.95)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(xs)], "vec_id bigint, embedding array<double>, c int")
    got = {r["vec_id"]: r for r in embed_dedup.near_duplicates(df, cell=cell).collect()}
    links = np.array([got[i]["n_links"] for i in range(len(xs))])
    assert (links <= near.sum(axis=1)).all()                       # none below the threshold
    assert links.sum() >= 0.9 * near.sum()                         # measured recall
    if links.sum() == near.sum():
        want = brute.groups(range(len(xs)), zip(*np.nonzero(near), strict=True))
        assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_collision_probability():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(200000, 1)) * 0.3, rng.uniform(0, 1, (200000, 1))
    assert np.mean(np.floor(a + b) == np.floor(b)) == pytest.approx(embed_dedup.collision(0.3, 1.0), abs=0.005)


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]),
            (8, [float("inf"), 1.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (10, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, embed_dedup.near_duplicates(df).select("vec_id", "n_links", "component_id").collect()), key=repr)
    alone = [(k, 0, k) for k in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted([*alone, (None, 0, None), (1, 3, 1), (1, 3, 1), (2, 3, 1), (10, 3, 1)], key=repr)
    assert embed_dedup.near_duplicates(df.limit(0)).collect() == []


# --- toxicity -----------------------------------------------------------------------------------------------------

def toxic_rows(n=700):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 6))) for _ in range(400)]
    bad = ["zonk", "wrax", "plimf"]
    rows, labels = [], []
    for i in range(n):
        own = list(rng.choice(words, rng.integers(20, 120)))
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.integers(1, 5)):
                # inflected forms share their stem
                own.insert(rng.integers(0, len(own)), rng.choice(bad) + "".join(rng.choice(list("abcdefgh"), rng.integers(0, 4))))
        rows.append((i, " ".join(own), "en" if i % 2 else "de"))
        labels.append((i, toxic))
    return rows, labels


def test_toxicity_held_out_accuracy(spark):
    rows, labels = toxic_rows()
    rows += [(1000, None, None), (1001, "", "xx"), (None, "abc zonk", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    known = spark.createDataFrame([*labels, (0, None), (None, 1)], "doc_id bigint, toxic int")
    got = toxicity.toxicity(docs, known).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    held = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    right = np.mean([r["predicted"] == truth[r["doc_id"]] for r in held])
    assert len(held) > 100 and right >= 0.93
    assert {r["score"] for r in got if r["doc_id"] in (1000, 1001)}.__len__() == 1


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, None, None)], "doc_id bigint, text string, lang string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r["predicted"] for r in toxicity.toxicity(docs, none).collect()} == {0}
    assert toxicity.toxicity(docs.limit(0), none).collect() == []


# --- pipeline -----------------------------------------------------------------------------------------------------

def test_stages_follow_each_other(spark, docs, rows):
    """Each stage against the brute-force version of its operator, on what the stage before kept."""
    now = docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "simhash near-dedup", "mixing", "packing"]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = now.collect()
        now = stage(spark, now, "")
        after = now.collect()
        if name == "quality rules":
            fine = {r[0] for r in rows for f in [brute.quality_figures(r[1])] if f[0] >= 10 and 100 * f[4] <= 20 * f[0]}
            assert {r["doc_id"] for r in after} == fine
        elif name == "line dedup":
            texts = sorted((r["doc_id"], r["text"]) for r in before)
            gone = brute.removed_lines(texts, line_dedup.MIN_WORDS)
            want = {k: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[k]) for k, t in texts}
            assert {r["doc_id"]: r["text"] for r in after} == {k: t for k, t in want.items() if not gone[k] or brute.WORD.search(t)}
            columns = [c for c in columns if c not in ("n_lines", "removed")]
        elif name == "simhash near-dedup":
            fps = {r["doc_id"]: brute.fingerprint(r["text"]) for r in before}
            links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
            assert {r["doc_id"] for r in after} == set(brute.groups(fps, links).values())
        elif name == "mixing":
            want = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(spark.createDataFrame(before)).collect()}
            assert sorted(r["doc_id"] for r in after) == sorted(k for k, n in want.items() for _ in range(n))
        else:
            assert sum(r["length"] for r in after) == packing.pack(spark.createDataFrame(before)).agg({"length": "sum"}).first()[0]
        if name != "packing":
            assert now.columns == columns


def test_pipeline_on_odd_and_empty_tables(spark, odd, none, tmp_path):
    for k, table in enumerate((odd, none)):
        folder = tmp_path / str(k)
        table.write.parquet(str(folder / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(folder))
        assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        assert (out.count() == 0) == (table is none)
    assert quality.MIN_WORDS == 10 and simhash.MAX_BITS == 4
