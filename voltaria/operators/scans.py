"""Windows over series of any length: no task ever holds more than a bucket of one.

Rows of a series are numbered without sorting it as a whole: spans of time are numbered on their own, and a span starts after
the rows of the spans before it. Buckets of consecutive numbers then get copies of the rows that lie before and after them
as far as the windows look (a halo); windows run within buckets and the copies are dropped. What reaches back without end,
such as the last known value, is handed on by one row a bucket.

Every series needs an order without ties: one row per key and time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bucket; seconds of a span that is numbered at once (about as many hourly rows).
SIZE, SPAN = 4096, 4096 * 3600


def numbered(df: DataFrame, keys: Sequence[str], ts: str, out: str = "__n", span: int = SPAN, total: str | None = None) -> DataFrame:
    """Adds each row's number in its series, from 0, and the number of its rows if ``total`` names it. A span must hold a bounded
    number of a series' rows."""
    df = df.withColumn("__span", F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / span))
    counts = df.groupBy(*keys, "__span").agg(F.count("*").alias("__rows"))
    series = Window.partitionBy(*keys)
    before = series.orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "__span", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__first"), *([F.sum("__rows").over(series).alias(total)] if total else []))
    own = Window.partitionBy(*keys, "__span").orderBy(ts)
    placed = df.withColumn("__at", F.row_number().over(own) - 1).alias("d").join(starts.alias("s"), _same(keys, "__span"))
    return placed.select("d.*", (F.col("__first") + F.col("__at")).cast("long").alias(out), *([f"s.{total}"] if total else [])).drop("__span", "__at")


def _same(keys: Sequence[str], *more: str) -> Column:
    on = F.lit(True)
    for k in (*keys, *more):
        on = on & F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}"))
    return on


def bucketed(df: DataFrame, keys: Sequence[str], ts: str, back: int, ahead: int = 0, size: int = SIZE) -> DataFrame:
    """Rows numbered (``__n``) and dealt to buckets (``__bucket``) with the ``back`` rows before and the ``ahead`` rows after
    them; ``__own`` tells a bucket's rows from such copies. Windows by keys and bucket, in order of ``__n``, that look no
    further are those of the whole series."""
    return dealt(numbered(df, keys, ts), back, ahead, size)


def dealt(df: DataFrame, back: int, ahead: int = 0, size: int = SIZE) -> DataFrame:
    """Numbered rows dealt to buckets."""
    size = max(size, back, ahead, 1)
    n = F.col("__n")
    bucket, at = F.floor(n / size), n % size
    has = [bucket, F.when(at >= size - back, bucket + 1) if back else None, F.when((at < ahead) & (bucket > 0), bucket - 1) if ahead else None]
    return df.withColumn("__bucket", F.explode(F.array_compact(F.array(*(h for h in has if h is not None))))).withColumn("__own", F.col("__bucket") == bucket)


def own_rows(df: DataFrame) -> DataFrame:
    return own_rows_numbered(df).drop("__n")


def own_rows_numbered(df: DataFrame) -> DataFrame:
    return df.filter("__own").drop("__own", "__bucket")


def decaying(keys: Sequence[str], value: str | Column, half_life: float, back: int, size: int = SIZE) -> Column:
    """Within buckets: the mean of all rows so far, each weighted by half per ``half_life`` rows of age; nulls age, but weigh
    nothing. Rows further back than ``reach(half_life)`` weigh less than a double can tell."""
    if (max(size, back) + 2 * back) / half_life > 1000:
        raise ValueError("weights of a bucket exceed a double: take smaller buckets")
    value = F.col(value) if isinstance(value, str) else value
    w = Window.partitionBy(*keys, "__bucket").orderBy("__n").rowsBetween(Window.unboundedPreceding, 0)
    grow = F.pow(F.lit(2.0), (F.col("__n") - F.col("__bucket") * max(size, back)) / half_life)
    total = F.sum(F.when(value.isNotNull(), grow).otherwise(0.0)).over(w)
    return F.when(total > 0, F.sum(F.coalesce(value * grow, F.lit(0.0))).over(w) / total)


def reach(half_life: float) -> int:
    """Rows after which a weight is under 2 to the -64."""
    return int(64 * half_life) + 1


def last_known(df: DataFrame, keys: Sequence[str], values: dict[str, Callable[[], Column]], forward: bool = True, size: int = SIZE) -> DataFrame:
    """Adds the last value that isn't null so far, the row's own included (or, not ``forward``, the next one). ``df`` is numbered.
    Buckets hand on one row each."""
    return _known(df, keys, {n: (v, forward) for n, v in values.items()}, size)


def neighbours(df: DataFrame, keys: Sequence[str], values: dict[str, Callable[[], Column]], size: int = SIZE) -> DataFrame:
    """Adds ``<name>_before`` and ``<name>_after``: the last value so far that isn't null and the next one, the row's own included."""
    return _known(df, keys, {f"{n}_{side}": (v, side == "before") for n, v in values.items() for side in ("before", "after")}, size)


def _known(df: DataFrame, keys: Sequence[str], values: dict[str, tuple[Callable[[], Column], bool]], size: int) -> DataFrame:
    """Each value by name with its direction. A bucket's rows look within it; the ends of each bucket are handed on beside them.
    To look ahead the order is turned, as a frame up to the last row is computed anew for every row."""
    df = df.withColumn("__k", F.floor(F.col("__n") / size))
    turn = lambda c, forward: F.col(c) if forward else F.col(c).desc()
    own = lambda f: Window.partitionBy(*keys, "__k").orderBy(turn("__n", f)).rowsBetween(Window.unboundedPreceding, 0)
    others = lambda f: Window.partitionBy(*keys).orderBy(turn("__k", f)).rowsBetween(Window.unboundedPreceding, -1)

    def end(v: Callable[[], Column], forward: bool) -> Column:
        return (F.max_by if forward else F.min_by)(v(), F.when(v().isNotNull(), F.col("__n")))

    ends = df.groupBy(*keys, "__k").agg(*(end(v, f).alias(f"__e_{n}") for n, (v, f) in values.items()))
    handed = ends.select(*keys, "__k", *(F.last(f"__e_{n}", ignorenulls=True).over(others(f)).alias(f"__h_{n}") for n, (_, f) in values.items()))
    local = df.withColumns({f"__l_{n}": F.last(v(), ignorenulls=True).over(own(f)) for n, (v, f) in values.items()})
    both = local.alias("d").join(handed.alias("s"), _same(keys, "__k")).select("d.*", *(f"s.__h_{n}" for n in values))
    return both.withColumns({n: F.coalesce(f"__l_{n}", f"__h_{n}") for n in values}).drop("__k", *(f"__{p}_{n}" for n in values for p in "lh"))
