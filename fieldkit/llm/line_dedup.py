"""Later copies of repeated line runs, by prefix doubling over line-id sequences.

A document is the sequence of its lines' ids (128-bit hashes). Suffixes are
ranked by their first 1, 2, 4, ... lines: the rank of 2k lines is that of the
pair (rank of the first k, rank of the next k), and pairs are ranked by a
range-partitioned sort of the distinct pairs. Only suffixes that still share
their prefix with another are carried on, so rounds shrink to the repeats.

Suffixes of equal rank form the intervals whose longest common prefix has
that depth. A maximal run of ``min_words`` words or more is the union of
minimal windows: the shortest runs from a line on, or up to a line, that
reach ``min_words`` words. Equal windows have equal lengths, so each is cut out
of the interval at its own depth: a window of l lines, 2^h <= l < 2^(h+1), is
the pair (rank of 2^h lines at its start, rank of 2^h lines at its end).
The first place of each interval stays; all later places are deleted. Runs
never cross documents; places are ordered by doc_id, then line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldkit.llm.common import save, tidied, words_of

MIN_WORDS = 20   # shortest repeated run, in words, whose later copies go
SALTS = 64       # groups that equal rows are dealt to


def minimal_windows(words: np.ndarray, least: int) -> list[set[int]]:
    """Per start line, the lengths of the minimal windows of ``least`` words that begin there."""
    n = words.size
    upto = np.concatenate([[0], np.cumsum(words)])
    out: list[set[int]] = [set() for _ in range(n)]
    end = np.searchsorted(upto, upto[:-1] + least)           # shortest run from line i on
    begin = np.searchsorted(upto, upto[1:] - least, side="right") - 1   # shortest run up to line j
    for i in np.flatnonzero(end <= n).tolist():
        out[i].add(int(end[i]) - i)
    for j in np.flatnonzero(upto[1:] >= least).tolist():
        out[int(begin[j])].add(j + 1 - int(begin[j]))
    return out


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """A row per line: doc, line, id (h1, h2), lens (minimal windows from here) and deep (the document's longest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, line, ids, lens, deep = [], [], [], [], []
            for k, t in enumerate(b.column("__text")):
                parts = t.as_py().split(b"\n")
                windows = minimal_windows(np.array([len(words_of(p)) for p in parts], np.int64), min_words)
                longest = max((max(w) for w in windows if w), default=0)
                if not longest:
                    continue   # the whole text is shorter than any run
                row += [k] * len(parts)
                line += range(len(parts))
                ids += [xxhash.xxh3_128_digest(p) for p in parts]
                lens += [sorted(w) for w in windows]
                deep += [longest] * len(parts)
                if len(row) > 200_000:
                    yield batch(b, row, line, ids, lens, deep)
                    row, line, ids, lens, deep = [], [], [], [], []
            yield batch(b, row, line, ids, lens, deep)

    def batch(b, row, line, ids, lens, deep) -> pa.RecordBatch:
        h = np.frombuffer(b"".join(ids), np.int64).reshape(-1, 2)
        at = pa.array(row, pa.int64())
        return pa.RecordBatch.from_arrays(
            [b.column("id").take(at), b.column("t").take(at), pa.array(line, pa.int32()), pa.array(h[:, 0].copy()),
             pa.array(h[:, 1].copy()), pa.array(lens, pa.list_(pa.int32())), pa.array(deep, pa.int32())],
            names=["id", "t", "line", "h1", "h2", "lens", "deep"])

    text = F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("__text")
    return docs.select(*_doc_key(), text).mapInArrow(
        tidied(run), "id bigint, t bigint, line int, h1 bigint, h2 bigint, lens array<int>, deep int")


def _doc_key():
    """A document is named by its doc_id (rows without one come last) and a hash of its text."""
    return (F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1)).alias("id"),
            F.xxhash64(F.lit(11), F.col("text")).alias("t"))


def _place():
    return F.struct("id", "t", "line")


def _ranked(classes: DataFrame, a: str, b: str) -> DataFrame:
    """``classes`` in the order of (a, b) with ``rank``, an increasing number."""
    ordered = classes.repartitionByRange(a, b).sortWithinPartitions(a, b)
    return save(ordered.withColumn("rank", F.monotonically_increasing_id()), "ranks")


def _repeated(places: DataFrame, a: str, b: str) -> DataFrame:
    """Classes of equal (a, b) with two or more places: a, b, first place, rank."""
    classes = places.groupBy(a, b).agg(F.count("*").alias("n"), F.min(_place()).alias("first")).where("n > 1").drop("n")
    return _ranked(classes, a, b)


def repeated_windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, t, line, l): every minimal window of ``l`` lines from ``line`` on that occurs at an earlier place."""
    lines = line_table(docs, min_words)
    lines = save(lines, "lines")
    classes = _repeated(lines, "h1", "h2")
    now = save(lines.join(classes, ["h1", "h2"]).drop("h1", "h2").distinct(), "suffixes")
    found = []
    h = 0
    while True:
        k = 1 << h
        starts = (now.select("id", "t", "line", "rank", "first", F.explode("lens").alias("l"))
                  .where(F.col("l").between(k, 2 * k - 1)))
        same = _place()
        found.append(starts.where((F.col("l") == k) & (same != F.col("first"))).select("id", "t", "line", "l"))
        if h:
            ends = now.select("id", "t", F.col("line").alias("end_line"), F.col("rank").alias("end_rank"))
            pairs = (starts.where(F.col("l") > k).withColumn("end_line", F.col("line") + F.col("l") - k)
                     .join(ends, ["id", "t", "end_line"]).select("id", "t", "line", "l", "rank", "end_rank"))
            pairs = save(pairs, "windows")
            firsts = (pairs.groupBy("rank", "end_rank", "l").agg(F.count("*").alias("n"), F.min(_place()).alias("first"))
                      .where("n > 1"))
            found.append(pairs.join(firsts, ["rank", "end_rank", "l"]).where(same != F.col("first"))
                         .select("id", "t", "line", "l"))
        deeper = now.where(F.col("deep") >= 2 * k)
        if deeper.isEmpty():
            break
        after = deeper.select("id", "t", (F.col("line") - k).alias("line"), F.col("rank").alias("rank2"))
        doubled = deeper.drop("first").join(after, ["id", "t", "line"])
        doubled = save(doubled.withColumnRenamed("rank", "rank1"), "pairs")
        classes = _repeated(doubled, "rank1", "rank2")
        now = save(doubled.join(classes, ["rank1", "rank2"]).drop("rank1", "rank2"), "suffixes")
        h += 1
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def without_lines(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, list[tuple[int, int]]]:
    """The text without the lines in ``spans`` (line, count), its line count, and the merged spans [from, to)."""
    lines = text.split(b"\n")
    edge = np.zeros(len(lines) + 1, np.int64)
    for at, n in spans:
        edge[at] += 1
        edge[at + n] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    merged = list(zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True))
    return b"\n".join(x for x, g in zip(lines, gone.tolist(), strict=True) if not g), len(lines), merged


def _later_copies(keyed: DataFrame) -> DataFrame:
    """``keyed`` rows with ``__later``: whether another row equal in (id, t) counts as the first.

    Only rows that have an equal are looked at, in two steps over salted groups, so that many equal rows do not
    meet in one task.
    """
    equal = save(keyed.groupBy("id", "t").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "equal_rows")
    if equal.isEmpty():
        return keyed.withColumn("__later", F.lit(False))
    same = keyed.join(equal, ["id", "t"], "left_semi").withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    nth = F.row_number().over(Window.partitionBy("id", "t", "__salt").orderBy("__salt"))
    first = F.row_number().over(Window.partitionBy("id", "t", "__nth").orderBy("__salt"))   # SALTS rows at most
    same = same.withColumn("__nth", nth).withColumn("__first", first)
    marked = same.withColumn("__later", ~((F.col("__nth") == 1) & (F.col("__first") == 1)))
    single = keyed.join(equal, ["id", "t"], "left_anti").withColumn("__later", F.lit(False))
    return single.unionByName(marked.drop("__salt", "__nth", "__first"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` with the text less its repeats, ``n_lines`` before and the
    spans ``removed`` (lines [from, to)).

    Null texts stay null and have no lines; of rows equal in doc_id and text
    one is the first and the others are later copies of it, so they lose all
    lines if the text has ``min_words`` words; among rows that share a doc_id, or lack
    one, the order is that of a hash of the text; an empty table gives no rows.
    Columns of ``docs`` named like the two new ones are replaced.
    """
    spans = (repeated_windows(docs, min_words).distinct().groupBy("id", "t")
             .agg(F.collect_list(F.struct("line", "l")).alias("__spans")))   # at most two per line of a document
    names = [c for c in docs.columns if c not in ("n_lines", "removed")]
    own = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("__row")
    keyed = _later_copies(docs.select(own, F.col("text").cast("binary").alias("__text"), *_doc_key()))
    joined = keyed.join(spans, ["id", "t"], "left").select("__row", "__text", "__spans", "__later")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
        for b in batches:
            texts, counts, removed = [], [], []
            for t, s, later in zip(*(b.column(c).to_pylist() for c in ("__text", "__spans", "__later")), strict=True):
                if t is None:
                    new, n, gone = None, 0, []
                elif later and len(words_of(t)) >= min_words:
                    n = t.count(b"\n") + 1
                    new, gone = b"", [(0, n)]
                elif s:
                    new, n, gone = without_lines(t, [(x["line"], x["l"]) for x in s])
                else:
                    new, n, gone = t, t.count(b"\n") + 1, []
                texts.append(new)
                counts.append(n)
                removed.append([{"from": a, "to": z} for a, z in gone])
            yield pa.RecordBatch.from_arrays(
                [b.column("__row"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int32()),
                 pa.array(removed, kind)], names=["__row", "__new", "__lines", "__removed"])

    row = joined.schema["__row"].dataType.simpleString()
    out = joined.mapInArrow(tidied(run), f"__row {row}, __new string, __lines int, "
                                 "__removed array<struct<from: int, to: int>>")
    return out.select(*[F.col("__new").alias("text") if c == "text" else F.col(f"__row.`{c}`") for c in names],
                      F.col("__lines").alias("n_lines"), F.col("__removed").alias("removed"))


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs taken out of the text (n_chars follows, if there).

    Documents that lose lines and have no word left are dropped; all others stay.
    """
    done = dedup_lines(docs.drop("n_lines", "removed"), min_words)
    cut = F.size("removed") > 0
    kept = done.where(~cut | F.col("text").rlike("[^ \\t-\\r]"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return kept.drop("n_lines", "removed")
