"""Text column expressions: tokenisers, n-grams, chunks, cleaning (TX-*, SC-2..8).

All but ``jaro_similarity`` are native expressions (split / transform / slice /
regexp), so they run inside whole-stage code generation on whole texts.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the whitespace set of the MapReduce tokenizer (space, tab,
# newline, carriage return, form feed).
WS_CLASS = "[ \\t\\n\\r\\f]+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_space(text) -> Column:
    """Split on one space; empty tokens are kept ('a  b' → a, '', b) (TX-1)."""
    return F.split(_c(text), " ", -1)


def split_ws(text) -> Column:
    """Split on runs of whitespace; no empty tokens ('a  b' → a, b) (TX-2)."""
    return F.filter(F.split(_c(text), WS_CLASS, -1), lambda w: w != "")


def ngrams(tokens, n: int, sep: str = " ") -> Column:
    """Overlapping word n-grams of a token array, joined by ``sep`` (TX-3).
    A text with fewer than n tokens has none."""
    t = _c(tokens)
    starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(t, i, n), sep))


def chunks(tokens, n: int, sep: str = " ") -> Column:
    """Non-overlapping chunks of n tokens, the last one possibly shorter (TX-4)."""
    t = _c(tokens)
    starts = F.when(F.size(t) > 0, F.sequence(F.lit(1), F.size(t), F.lit(n))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(t, i, n), sep))


def clean_whitespace(text) -> Column:
    """Collapse whitespace runs to one space and trim (SC-4)."""
    return F.trim(F.regexp_replace(_c(text), WS_CLASS, " "))


def nth_field(text, sep: str, n: int) -> Column:
    """n-th (1-based) field of a delimited line, NULL when missing (SC-2)."""
    return F.try_element_at(F.split(_c(text), sep, -1), F.lit(n))


def drop_tail(text, n: int) -> Column:
    """Drop the last n characters (SC-8)."""
    t = _c(text)
    return F.substring(t, F.lit(1), F.length(t) - n)


def jaro(a: str, b: str) -> float:
    """Jaro similarity of two strings: shares of characters matched within half the longer length, and their order;
    0 where one is empty."""
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = list(b)
    mine = []
    places = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] == ch:
                free[j] = None
                mine.append(ch)
                places.append(j)
                break
    if not mine:
        return 0.0
    theirs = [b[j] for j in sorted(places)]
    m, moved = len(mine), sum(p != q for p, q in zip(mine, theirs, strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - moved) / m) / 3


def jaro_similarity(a, b) -> Column:
    """``jaro`` of two columns (UD-3), which no built-in gives: an Arrow-batched function that works out each
    distinct pair of a batch once; NULL where either is."""
    @F.pandas_udf("double")
    def run(p: pd.Series, q: pd.Series) -> pd.Series:
        known: dict = {}
        out = []
        for pair in zip(p, q, strict=True):
            if pair not in known:
                known[pair] = None if pair[0] is None or pair[1] is None else jaro(*pair)
            out.append(known[pair])
        return pd.Series(out, dtype="float64")
    return run(a, b)
