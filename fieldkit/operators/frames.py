"""Projection, cleaning, inspection and sampling operators (PR-*, ST-*)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkit.session import ensure_checkpoint_dir


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a frame over the cluster when its scan is narrower than
    the default parallelism (one big file / one row group), so CPU-heavy row
    work that follows is not serialised in a few tasks. A wide input (the
    normal case on a cluster) is returned untouched — no extra shuffle."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par)
    return df


def remove_spaces_in_colnames(df: DataFrame) -> DataFrame:
    """Replace spaces in every column name with '_' (PR-6)."""
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns if " " in c})


def schema_table(df: DataFrame) -> DataFrame:
    """Columns / dtypes / nullability, and how many values each column holds, as a small table (PR-17)."""
    held = df.agg(*[F.count(f"`{f.name}`").alias(f"n{i}") for i, f in enumerate(df.schema.fields)])
    return held.select(F.explode(F.array(*[F.struct(
        F.lit(i).alias("pos"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
        F.lit(f.nullable).alias("nullable"), F.col(f"n{i}").alias("n_values")) for i, f in enumerate(df.schema.fields)])).alias("s")).select("s.*")


def shared(df: DataFrame, name: str = "shared") -> DataFrame:
    """``df`` as a table in the shared folder, for several consumers (PR-20): its sources are read once, and a
    consumer reads only the columns and rows that it needs. Survives lost executors, unlike a cache on their disks."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shared-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key in ``order`` (PR-11).

    Written as ``min(struct(order..., rest...))`` per key: a hash aggregate
    with map-side partial aggregation, so a hot key is reduced before the
    shuffle instead of being sorted in one task as ``row_number`` would."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    m = F.min(F.struct(*[F.col(c) for c in list(order) + rest])).alias("_m")
    return df.groupBy(*keys).agg(m).select(*keys, "_m.*")


def safe_cast(df: DataFrame, col: str, to: str, name: str | None = None) -> DataFrame:
    """Cast with invalid values → NULL instead of an ANSI error (PR-22)."""
    return df.withColumn(name or col, F.expr(f"try_cast(`{col}` AS {to})"))


_STEPS, _ROUNDS = 4096, 3


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """A row per column: ``column``, ``q0``, ``q1``, ...: exact quantiles, linearly interpolated, NULLs ignored (NaN
    is the largest number); NULL where a column holds nothing.

    All columns together are one table of (column, value, count), combined on the map side: one shuffle of the data,
    whatever the number of columns. The values at the wanted places are then found by selection: counts per
    order-preserving bucket tell the bucket of a place, whose own values are bucketed anew. Windows run over
    at most ``_STEPS`` buckets (the first time, over those of the logarithm), the last one over the distinct values left of a
    bucket. Nothing runs while the plan is built.
    """
    values = df.select(F.posexplode(F.array(*[F.col(f"`{c}`").cast("double") for c in cols])).alias("c", "v"))
    counts = values.where("v IS NOT NULL").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    inf = F.lit(float("inf"))
    scale = (F.when(F.isnan("v"), F.lit(20_000)).when(F.col("v") == inf, F.lit(10_000)).when(F.col("v") == -inf, F.lit(-10_000))
             .otherwise(F.floor(F.signum("v") * F.log1p(F.abs("v")) * 4).cast("int")))

    def buckets(rows: DataFrame, keys: list[str]) -> DataFrame:
        """Buckets ``b`` with their count, bounds and the count up to them."""
        upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
        return (rows.groupBy(*keys, "b").agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                .withColumn("upto", upto))

    hit = (F.col("place") <= F.col("upto")) & (F.col("place") > F.col("upto") - F.col("n"))
    first = buckets(counts.withColumn("b", scale), ["c"]).withColumn("total", F.sum("n").over(Window.partitionBy("c")))
    place = lambda p: (F.col("total") - 1) * F.lit(float(p))
    asked = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), (at(place(p)) + 1).alias("place"),
                               (place(p) - F.floor(place(p))).alias("part"))
                      for k, p in enumerate(probs) for side, at in ((0, F.floor), (1, F.ceil))])
    wanted = first.select("*", F.explode(asked).alias("a")).select("*", "a.*").where(hit)
    target = ["c", "k", "side"]
    found = lambda w: w.select(*target, (F.col("place") - F.col("upto") + F.col("n")).alias("place"), "part", "lo", "hi")
    wanted = found(wanted)

    def inside(wanted: DataFrame) -> DataFrame:
        """The counts of the wanted buckets (a few rows per column: two per quantile)."""
        return counts.join(F.broadcast(wanted), "c").where("v >= lo AND v <= hi")

    for _ in range(_ROUNDS):
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        b = F.when(F.col("lo") == F.col("hi"), F.lit(0)).otherwise(F.least(F.lit(_STEPS - 1), F.floor(share * _STEPS).cast("int")))
        wanted = found(buckets(inside(wanted).withColumn("b", b), [*target, "place", "part"]).where(hit))
    running = F.sum("n").over(Window.partitionBy(*target).orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    exact = (inside(wanted).withColumn("upto", running).where(F.col("upto") >= F.col("place"))
             .groupBy(*target).agg(F.min("v").alias("v"), F.first("part").alias("part")))
    pick = lambda k, side, col: F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col(col)))
    low, high, part = ([pick(k, side, col) for k in range(len(probs))] for side, col in ((0, "v"), (1, "v"), (0, "part")))
    by_column = exact.groupBy("c").agg(*[
        F.when(low[k] == high[k], low[k]).otherwise(low[k] + (high[k] - low[k]) * part[k]).alias(f"q{k}") for k in range(len(probs))])
    names = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("c", "column"))
    return names.join(by_column, "c", "left").drop("c")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """One row, columns ``q0``, ``q1``, ...: exact quantiles of ``col`` (see ``column_quantiles``)."""
    return column_quantiles(df, [col], probs).drop("column")


def summary_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A row per column: values that are not NULL, mean, standard deviation, minimum, quartiles, maximum (PR-18).

    Minimum and maximum are text, so that text columns have a place; mean,
    deviation and (exact) quartiles are NULL for them."""
    from fieldkit.functions.geo import round6
    kinds = dict(df.dtypes)
    numeric = [c for c in cols if kinds[c] not in ("string", "boolean", "date", "timestamp", "timestamp_ntz", "binary")]
    none = F.lit(None).cast("double")
    one = df.agg(*[a for k, c in enumerate(cols) for a in (
        F.count(f"`{c}`").alias(f"n{k}"), F.min(f"`{c}`").cast("string").alias(f"lo{k}"),
        F.max(f"`{c}`").cast("string").alias(f"hi{k}"),
        (round6(F.avg(f"`{c}`")) if c in numeric else none).alias(f"mean{k}"),
        (round6(F.stddev_samp(f"`{c}`")) if c in numeric else none).alias(f"std{k}"))])
    rows = one.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"n{k}").alias("count"), F.col(f"mean{k}").alias("mean"), F.col(f"std{k}").alias("std"),
        F.col(f"lo{k}").alias("min"), F.col(f"hi{k}").alias("max")) for k, c in enumerate(cols)])).alias("s")).select("s.*")
    if not numeric:
        return rows.select("*", *[none.alias(f"p{p}") for p in (25, 50, 75)])
    quartiles = column_quantiles(df, numeric, (0.25, 0.5, 0.75)).select(
        "column", *[round6(f"q{k}").alias(f"p{p}") for k, p in enumerate((25, 50, 75))])
    return rows.join(quartiles, "column", "left")


def key_fraction(key: str, seed: int = 42) -> Column:
    """A number in [0, 1) from the MD5 of the key and a seed: the same in any engine and for any partitioning."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Reproducible Bernoulli-style sample: rows whose key falls below ``fraction`` (PR-12)."""
    return df.where(key_fraction(key, seed) < F.lit(float(fraction)))


def sample_users(df: DataFrame, user: str, k: int, seed: int = 42) -> DataFrame:
    """All rows of ``k`` distinct users, those with the smallest key fraction (PR-13).

    The list of users has ``k`` rows; the join is left to the planner, which
    broadcasts it while it is small."""
    users = (df.select(user).distinct().withColumn("_h", key_fraction(user, seed)).orderBy("_h", user).limit(k).select(user))
    return df.join(users, user, "left_semi")


def random_split(df: DataFrame, key: str, weights: Sequence[float], seed: int = 42) -> DataFrame:
    """Each row with the part it falls into, ``split`` 0, 1, ... (PR-14). Parts are ranges of the key's fraction, so a
    row is in exactly one, whatever the partitioning."""
    total, upto, split = float(sum(weights)), 0.0, F.lit(0)
    for w in list(weights)[:-1]:
        upto += w / total
        split = split + (key_fraction(key, seed) >= F.lit(upto)).cast("int")
    return df.withColumn("split", split)


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Append tables by column name, missing columns NULL (ST-1, ST-2)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition (PR-19), computed on the executors."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


def parse_points(lines: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """'label f1 f2 …' text lines → (label, features vector) (IO-14, ML-10)."""
    from pyspark.ml.functions import array_to_vector
    nums = F.transform(F.split(F.trim(F.col(col)), sep), lambda s: s.try_cast("double"))
    return lines.select(F.element_at(nums, 1).alias("label"),
                        array_to_vector(F.slice(nums, 2, F.size(nums) - 1)).alias("features"))
