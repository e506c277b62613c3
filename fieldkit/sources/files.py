"""File readers and writers (IO-*).

Every reader returns a lazy DataFrame; schemas are declared where the layout
is known (no inference job), files are matched to the declared columns *by
name* (header on), and malformed values become NULL through ``try_cast``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str | Sequence[str], sep: str = ",", header: bool = True,
             recursive: bool = False) -> DataFrame:
    """Delimited text with a header line, all columns as strings (IO-1..3).
    ``path`` may be a file, a folder (all its files form one table) or a glob."""
    r = spark.read.option("header", header).option("sep", sep)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return r.csv(path if isinstance(path, str) else list(path))


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
                   bad_rows: str | None = "_corrupt_record") -> DataFrame:
    """Delimited text with declared column types (IO-4).

    The header names the columns, so the declared fields are picked *by name*
    (a positional schema silently mislabels files whose column order
    differs). Values that do not parse become NULL, and ``bad_rows`` holds
    the row's fields as they stand in the file (NULL for good rows; ``None``: no such column)."""
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    raw = read_csv(spark, path, sep=sep)
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType) for f in st.fields]
    bad = F.lit(False)
    for f, c in zip(st.fields, typed):
        bad = bad | (c.isNull() & F.col(f"`{f.name}`").isNotNull())
    whole = F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in raw.columns])
    return raw.select(*[c.alias(f.name) for f, c in zip(st.fields, typed)],
                      *([F.when(bad, whole).alias(bad_rows)] if bad_rows else []))


def read_text_lines(spark: SparkSession, path: str, line_end: str | None = None) -> DataFrame:
    """One row per line, column ``value`` (IO-5); folders are read whole. Lines end in LF, CR or both, or in ``line_end`` alone."""
    r = spark.read if line_end is None else spark.read.option("lineSep", line_end)
    return r.text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = False) -> DataFrame:
    """JSON documents with a declared nested schema (IO-7): one per line, so that files can be split, or
    with ``multiline`` one per file."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def flatten_struct(df: DataFrame, col: str, fields: Sequence[str], prefix: str = "") -> DataFrame:
    """Lift nested fields to top-level columns, e.g. ``coord.lon`` → ``lon``."""
    return df.select("*", *[F.col(f"{col}.{f}").alias(prefix + f) for f in fields]).drop(col)


def combine_csv_folder(spark: SparkSession, folder: str, sep: str = ",", out: str | None = None) -> DataFrame:
    """All CSV files of a folder as one table (IO-11). Files whose headers
    differ are aligned by column name (missing columns NULL); optionally
    written back as CSV.

    Headers are read on the executors, on any file system; there is one
    reader per distinct header (usually one)."""
    frames = [spark.read.option("header", True).option("sep", sep).csv(g) for g in _files_by_header(spark, folder)]
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f, allowMissingColumns=True)
    if out:
        write_csv(df, out)
    return df


def _files_by_header(spark: SparkSession, folder: str) -> list[list[str]]:
    """Files of the folder grouped by their first line (a row per file reaches the driver, for the readers)."""
    lines = spark.read.text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("at"))
    headers = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = headers.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [r.files for r in groups]


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV sink with header, overwrite (IO-13)."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def parse_labeled_points(lines: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """'label f1 f2 …' lines → (label, features vector) (IO-14, ML-10)."""
    from fieldkit.operators.frames import parse_points
    return parse_points(lines, col, sep)


def read_libsvm(spark: SparkSession, path: str) -> DataFrame:
    """LibSVM text (the commented alternative of IO-14)."""
    return spark.read.format("libsvm").load(path)


def read_polygons_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """GeoJSON-like polygon table → (admin_id, admin_name, rings) (IO-16 re-aimed).

    Expected record: ``{"id":…, "name":…, "coordinates": [[[x, y], …], …]}``
    (Polygon rings; a MultiPolygon is listed as all its rings)."""
    schema = "id string, name string, coordinates array<array<array<double>>>"
    raw = spark.read.schema(schema).option("multiLine", multiline).json(path)
    point = lambda p: F.struct(F.element_at(p, 1).alias("x"), F.element_at(p, 2).alias("y"))
    # rings that do not end where they begin are closed
    rings = F.transform("coordinates", lambda ring: F.transform(
        F.when(F.element_at(ring, 1) == F.element_at(ring, -1), ring).otherwise(F.concat(ring, F.array(F.element_at(ring, 1)))),
        point))
    return raw.select(F.col("id").alias("admin_id"), F.col("name").alias("admin_name"), rings.alias("rings"))
