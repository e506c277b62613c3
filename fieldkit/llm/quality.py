"""Quality rules: per-text rules and the frequency of lines across documents.

A line is normalised (A-Z lower-cased, digits to 0, words joined by single
spaces) and hashed (128 bits). Per host the distinct documents that hold it are counted, exact
copies of a text once. A line is frequent above a share of the host's
documents, but never allowed in more than a fixed number of them, however large
the host. It is taken out of every document of the host except the first
(smallest doc_id) that holds it, so boilerplate goes but no text vanishes
altogether. A document left with too few words is rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.common import WORD_BREAKS, save, tidied, words_of

MIN_WORDS = 10          # fewer words fail, before and after lines are taken out
MAX_REPEAT_PCT = 20     # share of words in repeated 5-word windows
WINDOW = 5
MAX_LINE_DOCS = 25      # a line is frequent in more documents of its host than this
MAX_LINE_SHARE = 0.04   # ... or in more than this share of them,
MIN_LINE_DOCS = 4       # if in more than this many
MIN_LEFT_PCT = 30       # share of words that must stay

NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
SYMBOLS = b"#*$%&|<>"


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    h = ids[:n].copy()
    for k in range(1, window):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += ids[k:k + n]
    order = np.sort(h)
    same = order[1:] == order[:-1]
    if not same.any():
        return 0
    starts = np.isin(h, order[1:][same])
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += starts
    edge[window:window + n] -= starts
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def text_rules(text: bytes) -> tuple[int, int, int, int, int, dict[bytes, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the words in each normalised line."""
    words = words_of(text)
    solid = text.translate(None, WORD_BREAKS)
    chars = len(solid) - len(solid.translate(None, bytes(range(0x80, 0xC0)))) if not solid.isascii() else 0
    chars = len(solid) - chars
    symbols = len(solid) - len(solid.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines: Counter = Counter()
    dup = 0
    for line in text.split(b"\n"):
        own = line.translate(NORMAL).split()
        if own:
            dup += line in seen
            seen.add(line)
            lines[normal_line(own)] += len(own)
    return len(words), chars, symbols, dup, repeat_words(words), lines


_RULES = ("text_key binary, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, lines array<struct<h: binary, w: bigint>>")
_LINES = pa.list_(pa.struct([("h", pa.binary()), ("w", pa.int64())]))


def _host():
    return F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))


def measured(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, host and the text rules, with the lines as an array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, figures, lines = [], [], []
            for t in b.column("text"):
                text = t.as_py()
                *row, own = text_rules(text)
                keys.append(xxhash.xxh3_128_digest(text))
                figures.append(row)
                lines.append([{"h": h, "w": w} for h, w in own.items()])
            table = np.array(figures, np.int64).reshape(-1, 5)
            names = ["doc_id", "host", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     "n_repeat_words", "lines"]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("host"), pa.array(keys, pa.binary()),
                 *[pa.array(table[:, k]) for k in range(5)], pa.array(lines, _LINES)], names=names)
    ids = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", _host().alias("host"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
            .mapInArrow(tidied(run), f"doc_id {ids}, host string, {_RULES}"))


def normal_line(words: list[bytes]) -> bytes:
    """The hash of a normalised line, given its normalised words."""
    return xxhash.xxh3_128_digest(b" ".join(words))


def less_lines(text: bytes, gone: set[bytes]) -> tuple[bytes, list[int]]:
    """The text without the lines of these hashes, and their numbers."""
    lines = text.split(b"\n")
    out = [k for k, x in enumerate(lines) if (own := x.translate(NORMAL).split()) and normal_line(own) in gone]
    at = set(out)
    return b"\n".join(x for k, x in enumerate(lines) if k not in at), out


def quality(docs: DataFrame, min_line_docs: int = MIN_LINE_DOCS, max_line_share: float = MAX_LINE_SHARE,
            min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT,
            min_left_pct: int = MIN_LEFT_PCT, max_line_docs: int = MAX_LINE_DOCS) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source, ...)``: the rules, words taken out, ``kept``.

    Null text counts as empty and fails; rows without a source form a host of
    their own; repeated rows get equal results; rows without a doc_id come last
    in the choice of the first document; an empty table gives no rows; other
    columns are ignored.
    """
    return _judged(docs, min_line_docs, max_line_share, min_words, max_repeat_pct, min_left_pct, max_line_docs)[0]


def _judged(docs: DataFrame, min_line_docs: int = MIN_LINE_DOCS, max_line_share: float = MAX_LINE_SHARE,
            min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT,
            min_left_pct: int = MIN_LEFT_PCT, max_line_docs: int = MAX_LINE_DOCS) -> tuple[DataFrame, DataFrame]:
    """The result of ``quality``, and per (host, text_key) the hashes ``hs`` of the lines to take out."""
    rules = save(measured(docs), "rules")
    last = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")   # of any type that has an order, nulls last
    lines = (rules.select("host", "text_key", last.alias("id"), F.explode("lines").alias("l"))
             .groupBy("host", F.col("l.h").alias("h"), "text_key")
             .agg(F.max("l.w").alias("w"), F.min("id").alias("id")))
    hosts = (rules.select("host", "text_key").distinct().groupBy("host").agg(F.count("*").alias("host_docs")))
    frequent = (lines.groupBy("host", "h").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
                .where(F.col("n") > min_line_docs).join(hosts, "host")
                .where((F.col("n") > max_line_docs) | (F.col("n") > F.col("host_docs") * F.lit(max_line_share)))
                .select("host", "h", "first_id"))
    places = lines.join(frequent, ["host", "h"]).where(~F.col("id").eqNullSafe(F.col("first_id")))
    taken = places.groupBy("host", "text_key").agg(F.sum("w").alias("w"))
    out = rules.drop("lines").join(taken, ["host", "text_key"], "left")
    gone = F.coalesce("w", F.lit(0))
    left = F.col("n_words") - gone
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    depleted = (gone > 0) & ((left < min_words) | (100 * left < min_left_pct * F.col("n_words")))
    out = out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
                     gone.alias("frequent_line_words"), "text_key", "host")
    # a text has no more hashes here than lines
    return out, places.groupBy("host", "text_key").agg(F.collect_list("h").alias("hs"))


def without_frequent_lines(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that pass, with the text less its host's frequent lines and ``removed``, their numbers.

    Each row goes by the verdict on its own text and host, whatever other rows share its doc_id. n_chars follows, if there.
    """
    verdicts, taken = _judged(docs, **limits)
    good = verdicts.where("kept").select("host", "text_key").distinct().join(taken, ["host", "text_key"], "left")
    names = [c for c in docs.columns if c not in ("removed", "n_chars")]
    sized = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [xxhash.xxh3_128_digest(t.as_py()) for t in b.column("__bytes")]
            yield pa.RecordBatch.from_arrays([b.column("__row"), b.column("__host"), b.column("__bytes"),
                                              pa.array(found, pa.binary())], names=["__row", "__host", "__bytes", "__key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, gone = [], []
            for t, hs in zip(b.column("__bytes").to_pylist(), b.column("hs").to_pylist(), strict=True):
                text, out = less_lines(t, set(hs)) if hs else (t, [])
                texts.append(text)
                gone.append(out)
            yield pa.RecordBatch.from_arrays([b.column("__row"), pa.array(texts, pa.binary()).cast(pa.string()),
                                              pa.array(gone, pa.list_(pa.int32()))], names=["__row", "__new", "__removed"])

    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("text", "removed")],
                   F.col("text").isNull().alias("__null")).alias("__row")
    rows = docs.select(own, _host().alias("__host"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("__bytes"))
    row = rows.schema["__row"].dataType.simpleString()
    keyed = rows.mapInArrow(tidied(keys), f"__row {row}, __host string, __bytes binary, __key binary")
    joined = keyed.join(good, (F.col("__host") == F.col("host")) & (F.col("__key") == F.col("text_key")))
    out = joined.select("__row", "__bytes", "hs").mapInArrow(tidied(cut), f"__row {row}, __new string, __removed array<int>")
    text = F.when(~F.col("__row.__null"), F.col("__new"))
    cols = {c: text if c == "text" else F.col(f"__row.`{c}`") for c in names}
    if sized:
        cols["n_chars"] = F.when(F.size("__removed") > 0, F.length("__new")).otherwise(F.col("__row.n_chars")).cast(sized)
    order = [c for c in docs.columns if c != "removed"]
    return out.select(*[cols[c].alias(c) for c in order], F.col("__removed").alias("removed"))


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """``without_frequent_lines`` with the columns of ``docs``."""
    old = "removed" in docs.columns
    named = docs.withColumnRenamed("removed", "__removed_before") if old else docs
    out = without_frequent_lines(named, **limits).drop("removed")
    return (out.withColumnRenamed("__removed_before", "removed") if old else out).select(*[f"`{c}`" for c in docs.columns])
