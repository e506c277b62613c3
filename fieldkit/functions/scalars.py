"""Scalar and array column helpers (SC-*, AG-8, SO-3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldkit.params import WEEKEND_FROM


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_timestamp(text, fmt: str = "dd-MMM-yy HH.mm.ss", tail: int = 0) -> Column:
    """Text → timestamp without zone; ``tail`` trailing characters dropped
    first; unparseable → NULL (SC-8, SC-9, SC-10). Month names parse in any
    letter case."""
    t = _c(text)
    if tail:
        t = F.substring(t, F.lit(1), F.length(t) - tail)
    # the value is parsed straight to a wall-clock timestamp (no session
    # zone, so DST gaps cannot shift it); the try_ parse only screens out
    # text that does not match, which becomes NULL instead of an ANSI error
    return F.when(F.try_to_timestamp(t, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(t, F.lit(fmt)))


def weekday_category(ts) -> Column:
    """'wkend' for weekday ≥ 5 (Saturday, Sunday; Monday = 0), else 'wkday' (SC-16)."""
    return F.when(F.weekday(_c(ts)) >= WEEKEND_FROM, "wkend").otherwise("wkday")


def time_columns(ts) -> dict[str, Column]:
    """date, hour, weekday number (Monday = 0) and weekday name (SC-11..13)."""
    t = _c(ts)
    return {"date": F.to_date(t), "hr": F.hour(t), "weekday": F.weekday(t), "day_name": F.date_format(t, "EEEE")}


def is_palindrome(s) -> Column:
    return _c(s) == F.reverse(_c(s))


def zip_map3(a, b, c, f) -> Column:
    """Element-wise f over three arrays in lock-step, stopping at the
    shortest (Python ``map`` semantics) (SC-23)."""
    a, b, c = _c(a), _c(b), _c(c)
    n = F.least(F.size(a), F.size(b), F.size(c))
    return F.zip_with(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: F.struct(x.alias("x"), y.alias("y"))),
                      F.slice(c, 1, n), lambda xy, z: f(xy["x"], xy["y"], z))


def sort_by_length_desc(words) -> Column:
    """Words by length descending, ties by the word (SO-3)."""
    return F.transform(
        F.array_sort(F.transform(_c(words), lambda w: F.struct((-F.length(w)).alias("k"), w.alias("w")))),
        lambda s: s["w"])
