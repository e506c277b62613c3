"""Trip clustering (WN-4) for hot user-days: a range-split, exact fold.

The leader fold is sequential inside a user-day, so the plain plan
(``clustering.trip_fold_stream``) gives each user to one task. When one user
holds a large share of all rows, this module splits the days:

1. ``repartitionByRange`` on (user, day, time, event) cuts the global order
   into contiguous chunks, kept in the shared checkpoint folder; a hot
   user-day spans several chunks (tasks).
2. Pass A folds every chunk *speculatively*, each user-day run starting
   fresh at the chunk start.
3. A run that continues a user-day from the previous chunk (at most one per
   chunk) is folded again in pass B from the true carried-in cluster, next to
   the fresh fold, until both open a cluster on the same event; from there on
   the speculative pieces are exact. A chunk that never gets there hands its
   true end to the next, and pass B runs again for that one. So there are at
   most as many rounds as the longest hot user-day has chunks; two in all
   but days spent in one place.
4. Pieces get their user-day cluster number from a running sum over the
   run summaries and are merged by one aggregate.

Sums are integers (``clustering.UNIT``), so pieces of a cluster add up to the
sums of the undivided fold, to the bit. The carried clusters are a table of
a row per chunk at most, written anew each round and joined to the chunks they
continue; the driver learns only whether a round is needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldkit.operators.clustering import Open, fold_clusters, open_flags, packed_hours
from fieldkit.session import cut_lineage

_PIECE = ("user_id bigint, d int, part int, idx int, visit_freq int, sx bigint, sy bigint, first_us bigint, "
          "last_us bigint, hours array<int>")
_KEYS = ["user_id", "d", "part"]
_CARRIED = ["carried_n", "carried_sx", "carried_sy"]


def _pass_a(radius: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in fold_clusters(batches, _KEYS, radius):
            yield packed_hours(f.assign(idx=f["clust_id"] - 1).drop(columns="clust_id"))
    return run


def _pass_b(radius: float):
    """Pieces of a continued run (with its carried cluster in every row) up to where the true and the fresh fold meet, and
    one row with visit_freq NULL: idx (the fresh fold's cluster there, -1 if they never meet), first_us (the true
    fold's) and, if they never meet, the true open cluster at the end as last_us, sx, sy."""
    def row(key, **cols) -> pd.DataFrame:
        base = dict(zip(_KEYS, key, strict=True)) | {"idx": -1, "visit_freq": None, "sx": None, "sy": None,
                                                     "first_us": None, "last_us": None, "hours": None}
        return pd.DataFrame([base | cols]).astype({c: "Int64" for c in ("visit_freq", "sx", "sy", "first_us", "last_us")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, done = None, False
        true, fresh = Open(), Open()
        opened_true = opened_fresh = 0
        for pdf in batches:
            if done or not len(pdf):
                continue   # the rest of the run is exact already
            if key is None:
                key = tuple(int(pdf[k].iloc[0]) for k in _KEYS)
                true = Open(*(int(pdf[c].iloc[0]) for c in _CARRIED))
            x, y = pdf["xi"].to_numpy(np.int64), pdf["yi"].to_numpy(np.int64)
            none = np.zeros(len(pdf), bool)
            t = open_flags(x, y, none, radius, true)
            f = open_flags(x, y, none, radius, fresh)
            meet = np.flatnonzero(t & f)
            upto = int(meet[0]) if meet.size else len(pdf)
            number = opened_true + np.cumsum(t)
            if upto:
                yield _pieces(key, pdf.iloc[:upto], x[:upto], y[:upto], number[:upto])
            if meet.size:
                yield row(key, idx=opened_fresh + int(np.cumsum(f)[upto]) - 1, first_us=int(number[upto]))
                done = True
                continue
            opened_true, opened_fresh = int(number[-1]), opened_fresh + int(f.sum())
        if key is not None and not done:
            yield row(key, first_us=opened_true, last_us=true.n, sx=true.sx, sy=true.sy)
    return run


def _pieces(key: tuple, pdf: pd.DataFrame, x: np.ndarray, y: np.ndarray, number: np.ndarray) -> pd.DataFrame:
    rows = np.flatnonzero(np.diff(np.concatenate([[-1], number])))
    t = pdf["t_us"].to_numpy(np.int64)
    place = np.cumsum(np.isin(np.arange(len(x)), rows)) - 1
    hours = np.bincount(place * 24 + pdf["hr"].to_numpy(), minlength=24 * rows.size).reshape(-1, 24)
    out = pd.DataFrame({"idx": number[rows], "visit_freq": np.diff(np.append(rows, len(x))), "sx": np.add.reduceat(x, rows),
                        "sy": np.add.reduceat(y, rows), "first_us": t[rows], "last_us": t[np.append(rows[1:], len(x)) - 1],
                        "hours": list(hours.astype(np.int32))})
    for k, v in zip(_KEYS, key, strict=True):
        out[k] = v
    return out


def trip_clusters_split(events: DataFrame, radius_km: float, n_chunks: int, trace: list | None = None) -> DataFrame:
    """Clusters of ``clustering.placed_events`` with hot user-days split over ``n_chunks`` tasks:
    user_id, d, clust_id, visit_freq, sx, sy, first_us, last_us, hours. ``trace`` collects the chunks folded again per round."""
    keys = ["user_id", "d", "t_us", "event_id"]
    ranged = cut_lineage(events.repartitionByRange(n_chunks, *keys).sortWithinPartitions(*keys)
                         .select("user_id", "d", "t_us", "xi", "yi", "hr", F.spark_partition_id().alias("part")))
    a = cut_lineage(ranged.mapInPandas(_pass_a(radius_km), _PIECE))
    repaired: list[DataFrame] = []
    state = _first_state(a)
    todo = cut_lineage(state)
    while not todo.isEmpty():
        if trace is not None:
            trace.append(todo.count())
        # n_chunks rows at most; the chunks keep their partitions and their order
        carried = F.broadcast(todo.select(*_KEYS, *[F.col(f"carry.{c}").alias(n) for c, n in zip(("visit_freq", "sx", "sy"), _CARRIED, strict=True)]))
        b = cut_lineage(ranged.join(carried, _KEYS).mapInPandas(_pass_b(radius_km), _PIECE))
        repaired.append(b)
        state = cut_lineage(_next_state(state, b))
        todo = cut_lineage(state.where("NOT (carry <=> used)"))
    return _assemble(a, repaired)


_OPEN = "struct<visit_freq:int,sx:bigint,sy:bigint>"


def _first_state(a: DataFrame) -> DataFrame:
    """A row per continued run: the chunk before, its speculative end, the cluster carried into the run (that end) and
    the one the run was last folded from (none yet)."""
    runs = a.groupBy(*_KEYS).agg(F.max_by(F.struct("visit_freq", "sx", "sy"), "idx").cast(_OPEN).alias("end"))
    w = Window.partitionBy("user_id", "d").orderBy("part")   # a row per chunk of a user-day
    return (runs.select(*_KEYS, F.lag("part").over(w).alias("before"), F.lag("end").over(w).alias("speculative")).where("before IS NOT NULL")
            .withColumns({"carry": F.col("speculative"), "used": F.lit(None).cast(_OPEN)}))


def _next_state(state: DataFrame, b: DataFrame) -> DataFrame:
    """The state after a round: a chunk folded again hands on its true end, or the speculative one if the folds met."""
    ends = b.where("visit_freq IS NULL").select(
        "user_id", "d", F.col("part").alias("before"), (F.col("idx") >= 0).alias("met"),
        F.struct(F.col("last_us").cast("int").alias("visit_freq"), "sx", "sy").cast(_OPEN).alias("end"))
    carry = F.when(F.col("met").isNull(), F.col("carry")).when(F.col("met"), F.col("speculative")).otherwise(F.col("end"))
    return (state.join(ends, ["user_id", "d", "before"], "left")
            .select(*_KEYS, "before", "speculative", carry.alias("carry"), F.col("carry").alias("used")))


def _assemble(a: DataFrame, repaired: list[DataFrame]) -> DataFrame:
    b = a.limit(0).withColumn("_round", F.lit(0))
    for i, df in enumerate(repaired):
        b = b.unionByName(df.withColumn("_round", F.lit(i)))
    last = b.groupBy("part").agg(F.max("_round").alias("_round"))   # the latest result of a chunk counts
    b = b.join(last, ["part", "_round"]).drop("_round")
    meet = b.where("visit_freq IS NULL").select(*_KEYS, F.col("idx").alias("f"), F.col("first_us").cast("int").alias("t"))
    # speculative pieces: all of a fresh run; of a repaired one those from the meeting on, in the true numbering
    kept = (a.join(meet, _KEYS, "left").where("f IS NULL OR (f >= 0 AND idx >= f)")
            .withColumn("idx", F.when(F.col("f").isNull(), F.col("idx")).otherwise(F.col("idx") - F.col("f") + F.col("t")))
            .drop("f", "t"))
    pieces = kept.unionByName(b.where("visit_freq IS NOT NULL"))
    # clusters that a run adds to its user-day: its highest index
    top = a.groupBy(*_KEYS).agg(F.max("idx").alias("top")).join(meet, _KEYS, "left").select(
        *_KEYS, F.when(F.col("f").isNull(), F.col("top")).when(F.col("f") >= 0, F.col("top") - F.col("f") + F.col("t"))
        .otherwise(F.col("t")).alias("top"))
    w = Window.partitionBy("user_id", "d").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = top.select(*_KEYS, (F.lit(1) + F.coalesce(F.sum("top").over(w), F.lit(0))).alias("base"))
    numbered = pieces.join(base, _KEYS).withColumn("clust_id", (F.col("base") + F.col("idx")).cast("int"))
    return numbered.groupBy("user_id", "d", "clust_id").agg(
        F.sum("visit_freq").cast("int").alias("visit_freq"), F.sum("sx").alias("sx"), F.sum("sy").alias("sy"),
        F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"),
        F.array(*[F.sum(F.col("hours")[i]).cast("int") for i in range(24)]).alias("hours"))
