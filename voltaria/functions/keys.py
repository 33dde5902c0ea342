"""Surrogate keys and text that skips or keeps nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How timestamps are rendered inside keys.
TIMESTAMP = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(*parts: Column | str) -> Column:
    """Concatenation that skips nulls; never null itself. Strings are literals."""
    return F.concat_ws("", *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def stamp(ts: Column | str) -> Column:
    return F.date_format(_col(ts), TIMESTAMP)


def zoned(ts: Column | str) -> Column:
    """A timestamp's text with its zone, as in "2026-07-10 12:00:00+00"."""
    return F.date_format(_col(ts), TIMESTAMP + "x")


def number_text(df: DataFrame, column: str) -> Column:
    """A number's shortest text, whole numbers without a decimal point; text as it is."""
    c = F.col(column)
    if dict(df.dtypes)[column] not in ("double", "float"):
        return c.cast("string")
    return F.when((c == F.floor(c)) & (F.abs(c) < 1e15), c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def md5_key(*parts: Column | str, sep: str = "") -> Column:
    """MD5 of the columns' text; null if any is null."""
    cols = [_col(p).cast("string") for p in parts]
    woven = [x for c in cols for x in (F.lit(sep), c)][1:] if sep else cols
    return F.md5(F.concat(*woven))


def surrogate_key(*parts: Column | str, null: str = "_null_", sep: str = "-") -> Column:
    """Null-safe MD5 key: nulls take a placeholder, so rows that differ in a null differ in the key."""
    return F.md5(F.concat_ws(sep, *(F.coalesce(_col(p).cast("string"), F.lit(null)) for p in parts)))


def iri(base: str, *parts: Column | str) -> Column:
    """An identifier under ``base``; null parts are skipped."""
    return text(base, *(_col(p) for p in parts))
