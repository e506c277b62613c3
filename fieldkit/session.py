"""SparkSession factory and shared-storage helpers.

Everything in the library takes a ``SparkSession`` that the caller owns;
``get_spark`` is a convenience for tests, the bench and local runs. On a
cluster the session comes from ``spark-submit`` and only
``ensure_checkpoint_dir`` is used: it reads ``spark.checkpoint.dir`` from the
session and sets a scratch folder only where the setting is absent (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every fieldkit job relies on (UTC wall clock for the NTZ test data,
# ANSI semantics, adaptive execution with skew handling).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "fieldkit", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's base settings."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("FIELDKIT_SHUFFLE_PARTITIONS", cpus))
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.driver.memory", os.environ.get("FIELDKIT_DRIVER_MEMORY", "8g")))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it. Where it is unset a scratch folder is made for a
    local master only (tests); on a cluster that would be one machine's disk,
    so it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not (master.startswith("local[") and master.endswith("]")):
            raise ValueError(f"spark.checkpoint.dir is not set; on {master} it must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="fieldkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder (reliable, survives
    executor loss) and return a frame that reads from it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
