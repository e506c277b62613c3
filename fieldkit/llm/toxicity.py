"""Toxicity: a convolutional text classifier in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first
3 to 6 letters (inflected forms share them). Filters over one, two and three
words are max-pooled over the whole text and feed a logistic output. Training
is by Adagrad; the first embedding component starts at the log odds of its
bucket, and buckets seen in fewer than ``MIN_DOCS`` training texts stay zero, so chance
words say nothing. Fitted to a bounded sample of labelled rows (hash order);
every document is scored whole.

A part of the sample is held back to place the cut: the score is shifted so
that 0.5 is the best threshold overall, and a threshold per language is kept
for ``flagged``. Neither language nor labels enter a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.common import bucket_of, words_of

SAMPLE_PER_LABEL = 4000   # labelled rows of each label the model is fitted to, at most
BUCKETS = 1 << 18
DIM = 16
FILTERS = 12
WIDTHS = (1, 2, 3)
PREFIXES = (3, 4, 5, 6)
MIN_DOCS = 3
EPOCHS = 8
BATCH = 32
FOLDS = 5                 # documents of fold 0 are held out
CACHE_WORDS = 1_000_000
SEED = 5
EDGES = b".,;:!?\"'()[]{}*&%$#|<>-"


def features(word: bytes) -> list[int]:
    """Buckets of a word: itself and its prefixes (A-Z lower-cased, outer punctuation off)."""
    w = word.strip(EDGES)
    if not w:
        return []
    out = [zlib.crc32(b"w" + w) % BUCKETS]
    try:
        letters = w.decode()
    except UnicodeDecodeError:
        return out
    return out + [zlib.crc32(b"p" + letters[:n].encode()) % BUCKETS for n in PREFIXES if len(letters) >= n]


@dataclass
class Model:
    rows: list             # bucket -> row of emb (0: unknown)
    emb: np.ndarray        # rows x DIM, row 0 is zero
    filters: list          # per width: (width, DIM, FILTERS)
    bias: np.ndarray       # per pooled filter
    out: np.ndarray        # weights of the pooled filters
    shift: float
    thresholds: dict

    def known(self, word: bytes) -> tuple[int, ...]:
        """The embedding rows of a word."""
        return tuple(r for f in features(word) if (r := self.rows[f]))


def _windows(x: np.ndarray, f: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Filter responses per start word; windows that leave their text are -inf."""
    n, w = len(x), len(f)
    h = x @ f[0]
    for o in range(1, w):
        h[:n - o] += x[o:] @ f[o]
    for o in range(1, w):
        at = ends - o
        h[at[at >= 0]] = -np.inf
    return h


def pooled(x: np.ndarray, starts: np.ndarray, model: Model) -> np.ndarray:
    """Max of each filter over each (non-empty) text, at least 0, after its bias."""
    ends = np.append(starts[1:], len(x))
    parts = [np.maximum.reduceat(_windows(x, f, ends), starts, axis=0) for f in model.filters]
    # in a text shorter than a filter, -inf may have hit the text before: those rows were its last words anyway
    return np.maximum(np.hstack(parts) + model.bias, 0)


def logits(x: np.ndarray, starts: np.ndarray, model: Model) -> np.ndarray:
    return pooled(x, starts, model) @ model.out + model.shift


def fit(texts: list[bytes], labels: list[int], langs: list, seed: int = SEED) -> Model:
    """The model of labelled texts; a constant one where a label is missing."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float64)
    number: dict[bytes, int] = {}
    ids = [np.array([number.setdefault(w, len(number)) for w in words_of(t.lower())], np.int32) for t in texts]
    found = [features(w) for w in number]
    df = np.zeros((2, BUCKETS), np.int32)
    for own, label in zip(ids, labels, strict=True):
        df[int(label), list({f for w in np.unique(own).tolist() for f in found[w]})] += 1
    known = np.flatnonzero(df.sum(axis=0) >= MIN_DOCS)
    rows = np.zeros(BUCKETS, np.int32)
    rows[known] = np.arange(1, known.size + 1)
    n = [max(1, int((y == k).sum())) for k in (0, 1)]
    odds = np.log((df[1, known] + 0.5) / (n[1] + 1)) - np.log((df[0, known] + 0.5) / (n[0] + 1))
    emb = np.zeros((known.size + 1, DIM), np.float32)
    emb[1:] = rng.normal(0, 0.05, (known.size, DIM))
    emb[1:, 0] = odds / 2
    filters = [rng.normal(0, 0.15, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, :] = np.abs(f[:, 0, :]) + 0.3 / len(f)
    size = FILTERS * len(WIDTHS)
    model = Model(rows.tolist(), emb, filters, np.full(size, -0.5, np.float32), np.full(size, 0.1, np.float32), -1.0, {})
    if not len(texts) or y.min() == y.max():
        model.out[:] = 0
        model.shift = -4.0 if not len(texts) or y.max() == 0 else 4.0
        return model
    held = rng.random(len(texts)) < 0.2
    train = np.flatnonzero(~held & np.array([t.size > 0 for t in ids]))
    lists = [[r for f in w if (r := model.rows[f])] for w in found]
    bound = np.concatenate([[0], np.cumsum([len(r) for r in lists])])
    words = (np.array([r for w in lists for r in w], np.int32), bound)
    _train(model, words, ids, y, train, rng)
    at = np.flatnonzero(held)
    _calibrate(model, words, [ids[k] for k in at], y[held], [langs[k] for k in at])
    return model


def _rows_of(words: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The embedding rows of a text's words one after another, and each word's bounds in them."""
    rows, bound = words
    n = bound[ids + 1] - bound[ids]
    upto = np.concatenate([[0], np.cumsum(n)])
    return rows[np.arange(upto[-1]) + np.repeat(bound[ids] - upto[:-1], n)], upto


def _vectors(model: Model, own: np.ndarray, upto: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, DIM)), np.cumsum(model.emb[own], axis=0, dtype=np.float64)])
    return (total[upto[1:]] - total[upto[:-1]]).astype(np.float32)


def _train(model: Model, words: tuple[np.ndarray, np.ndarray], ids: list, y: np.ndarray, train: np.ndarray,
           rng: np.random.Generator) -> None:
    rate, eps = 0.08, 1e-6
    weight = np.where(y > 0, 0.5 / max(y[train].mean(), 1e-6), 0.5 / max(1 - y[train].mean(), 1e-6))
    acc = {"emb": np.zeros_like(model.emb), "bias": np.zeros_like(model.bias), "out": np.zeros_like(model.out),
           "shift": 0.0, "filters": [np.zeros_like(f) for f in model.filters]}
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for at in range(0, train.size, BATCH):
            part = train[at:at + BATCH]
            flat = [_rows_of(words, ids[k]) for k in part]
            xs = [_vectors(model, *f) for f in flat]
            best, pool = [], np.zeros((len(part), len(model.bias)), np.float32)
            for d, x in enumerate(xs):
                tops = []
                for j, f in enumerate(model.filters):
                    if len(x) < len(f):
                        tops.append(np.full(FILTERS, -1))
                        continue
                    h = _windows(x, f, np.array([len(x)]))
                    top = h.argmax(axis=0)
                    tops.append(top)
                    pool[d, j * FILTERS:(j + 1) * FILTERS] = np.maximum(
                        h[top, np.arange(FILTERS)] + model.bias[j * FILTERS:(j + 1) * FILTERS], 0)
                best.append(tops)
            z = pool @ model.out + model.shift
            err = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * weight[part] / len(part)).astype(np.float32)
            up = err[:, None] * model.out[None, :] * (pool > 0)
            grad_f = [np.zeros_like(f) for f in model.filters]
            touched, grads = [], []
            for d, (own, upto) in enumerate(flat):
                for j, f in enumerate(model.filters):
                    g = up[d, j * FILTERS:(j + 1) * FILTERS]
                    live = np.flatnonzero(g)
                    for o in range(len(f)):
                        word = best[d][j][live] + o
                        grad_f[j][o][:, live] += xs[d][word].T * g[live]
                        back = g[live][:, None] * f[o][:, live].T
                        for w, v in zip(word.tolist(), back, strict=True):
                            rows = own[upto[w]:upto[w + 1]]
                            touched.append(rows)
                            grads.append(np.broadcast_to(v, (len(rows), DIM)))
            for name, g in (("out", pool.T @ err), ("bias", up.sum(axis=0))):
                acc[name] += g * g
                getattr(model, name).__isub__(rate * g / np.sqrt(acc[name] + eps))
            acc["shift"] += float(err.sum()) ** 2
            model.shift -= rate * float(err.sum()) / np.sqrt(acc["shift"] + eps)
            for f, g, a in zip(model.filters, grad_f, acc["filters"], strict=True):
                a += g * g
                f -= rate * g / np.sqrt(a + eps)
            if touched:
                rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
                g = np.zeros((rows.size, DIM), np.float32)
                np.add.at(g, inverse, np.concatenate(grads))
                g[rows == 0] = 0
                acc["emb"][rows] += g * g
                model.emb[rows] -= rate * g / np.sqrt(acc["emb"][rows] + eps)
    model.emb[0] = 0


def _best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The logit with the highest F1, in the middle of its gap."""
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    last = np.append(z[order][1:] < z[order][:-1], True)   # a cut cannot part equal logits
    at = int(np.argmax(np.where(last, f1, -1)))
    below = z[order][at + 1] if at + 1 < len(z) else z[order][at] - 2
    return float((z[order][at] + below) / 2)


def _calibrate(model: Model, words: tuple[np.ndarray, np.ndarray], ids: list, y: np.ndarray, langs: list) -> None:
    z = np.array([logits(_vectors(model, *_rows_of(words, t)), np.zeros(1, np.int64), model)[0] if t.size else model.shift
                  for t in ids])
    if not len(y) or y.max() == 0 or y.min() == 1:
        return
    cut = _best_cut(z, y)
    model.shift -= cut
    z = z - cut
    for lang in sorted({s for s in langs if s is not None}):
        own = np.array([s == lang for s in langs])
        if 0 < y[own].sum() < own.sum():
            model.thresholds[lang] = float(1 / (1 + np.exp(-_best_cut(z[own], y[own]))))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """At most ``per_label`` rows (text, toxic, lang) of each label, in hash order, outside the held-out fold."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(bucket_of("doc_id", FOLDS) != 0)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64(F.lit(SEED), "doc_id")
    picked = None
    for label in (0, 1):
        own = known.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(per_label)
        picked = own if picked is None else picked.unionByName(own)
    ids = picked.select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic"))
    # bounded by per_label; the texts of other documents are not moved
    return (docs.join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
            .select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"), "__toxic", "lang"))


class Words:
    """What a task knows of words under a model: the vector number of each word. Words with the same
    embedding rows share a vector; vector 0 is that of words the model does not know."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.by_rows: dict[tuple, int] = {(): 0}
        self.vectors = np.zeros((1024, DIM), np.float32)

    def learn(self, words: set[bytes]) -> None:
        for w in words:
            at = self.model.known(w)
            k = self.by_rows.get(at)
            if k is None:
                k = self.by_rows[at] = len(self.by_rows)
                if k == len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
                self.vectors[k] = self.model.emb[list(at)].sum(axis=0)
            self.number[w] = k

    def runs(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Word vectors of about 100,000 words of texts at a time, the texts' starts in them, and which texts they are."""
        ids, starts, which = [], [], []
        for k, t in enumerate(texts):
            words = words_of(t.lower())
            if words:
                new = set(words).difference(self.number)
                if new:
                    if len(self.number) + len(new) > CACHE_WORDS and not ids:
                        self.clear()
                        new = set(words)
                    self.learn(new)
                starts.append(len(ids))
                which.append(k)
                ids += map(self.number.__getitem__, words)
            if len(ids) > 100_000:
                yield self.vectors[ids], np.array(starts), np.array(which)
                ids, starts, which = [], [], []
        if ids:
            yield self.vectors[ids], np.array(starts), np.array(which)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, threshold (of the language) and flagged (score >= threshold) per row."""
    # bounded by BUCKETS; plain arrays and dicts, as a broadcast names classes instead of carrying them
    shared = docs.sparkSession.sparkContext.broadcast(dict(vars(model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        known = Words(m)   # a task's own: bounded by its part
        for b in batches:
            z = np.full(b.num_rows, m.shift)
            for x, starts, which in known.runs(b.column("text").to_pylist()):
                z[which] = logits(x, starts, m)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            limit = np.array([m.thresholds.get(s, 0.5) for s in b.column("lang").to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32)),
                 pa.array(limit), pa.array(p >= limit)],
                names=["doc_id", "held_out", "score", "predicted", "threshold", "flagged"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(bucket_of("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out")
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    return docs.select("doc_id", held, text, F.col("lang").cast("string").alias("lang")).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int, threshold double, flagged boolean")


def toxicity(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """Scores of all ``docs(doc_id, text, lang, ...)``, learned from ``labels(doc_id, toxic, ...)``.

    Null and empty texts get the score of no evidence; rows without a doc_id
    are scored but never held out; of repeated labels the highest counts, null
    ones do not; without both labels the score is constant; an empty table
    gives no rows; other columns are ignored.
    """
    rows = labelled_sample(docs, labels, per_label).toArrow().sort_by([("doc_id", "ascending")])
    model = fit(*[rows.column(c).to_pylist() for c in ("text", "__toxic", "lang")])
    return score(docs, model)
