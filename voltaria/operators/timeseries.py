"""Slots, spines, gaps, islands, sessions, as-of lookups, rolling and decaying statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import time as T
from . import scans


def rollup(df: DataFrame, keys: Sequence[str], ts: str, minutes: int, sums: dict[str, Column]) -> DataFrame:
    """Sums per key and slot, the slot's start in ``ts``."""
    slot = T.floor_hour(ts) if minutes == 60 else T.floor_minutes(ts, minutes)
    return df.groupBy(*keys, slot.alias(ts)).agg(*(F.sum(c).alias(n) for n, c in sums.items()))


def spine(entities: DataFrame, start: Column, end: Column, step: str, name: str = "ts") -> DataFrame:
    """Every entity with every slot from start to end, both included; none where start is after end."""
    slots = F.when(start <= end, F.sequence(start, end, F.expr(f"INTERVAL {step}")))
    return entities.withColumn(name, F.explode(slots))


def missing_slots(df: DataFrame, keys: Sequence[str], ts: str, start: Column, end: Column, step: str) -> DataFrame:
    """Slots of the spine for which an entity has no row. The entities are those that occur."""
    return spine(df.select(*keys).distinct(), start, end, step, ts).join(df.select(*keys, ts), [*keys, ts], "left_anti")


def islands(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Adds island (its first-day marker), its length so far and in all, for runs of consecutive days. One row per key and day."""
    w = Window.partitionBy(*keys).orderBy(day)
    marked = df.withColumn("island", F.date_sub(day, F.row_number().over(w)))
    own = Window.partitionBy(*keys, "island")
    return marked.withColumn("streak", F.row_number().over(own.orderBy(day)).cast("long")).withColumn("streak_total", F.count("*").over(own))


def sessions(df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int) -> DataFrame:
    """Adds session: a running count of gaps longer than ``gap_seconds`` per key."""
    w = Window.partitionBy(*keys).orderBy(ts)
    passed = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(ts).over(w).cast("timestamp"))
    return df.withColumn("__new", (F.coalesce(passed, F.lit(0)) > gap_seconds * 1_000_000).cast("long")).withColumn("session", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def chunks(df: DataFrame, keys: Sequence[str], ts: str, size: int) -> DataFrame:
    """Adds chunk: every ``size`` rows of a key in order."""
    w = Window.partitionBy(*keys).orderBy(ts)
    return df.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / size).cast("long"))


def deaccumulate(df: DataFrame, keys: Sequence[str], ts: str, value: str, out: str) -> DataFrame:
    """The increase of a running total since the row before; the total itself where it starts or falls back."""
    w = Window.partitionBy(*keys).orderBy(ts)
    before = F.lag(value).over(w)
    return df.withColumn(out, F.when(before.isNull() | (F.col(value) < before), F.col(value)).otherwise(F.col(value) - before))


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], tolerance_seconds: int | None = None, right_ts: str = "right_ts") -> DataFrame:
    """Each left row with the newest right row of its key at or before it, within a tolerance, else nulls.

    Both sides are merged into one sorted stream per key: a single shuffle and no join, whatever the number of matches.
    Right rows that share key and time: the greatest columns win.
    """
    value = F.struct(F.col(ts).alias(right_ts), *columns)
    newest = right.groupBy(*keys, ts).agg(F.max(F.struct(*columns)).alias("__v")).select(*keys, ts, "__v.*").withColumn("__right", value)
    carried = [c for c in left.columns if c not in (*keys, ts)]
    a = left.select(*keys, ts, F.struct(*carried, F.lit(1).alias("__one")).alias("__left"))
    b = newest.select(*keys, ts, "__right")
    w = Window.partitionBy(*keys).orderBy(F.col(ts), F.col("__left").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("__last", F.last("__right", ignorenulls=True).over(w)).filter("__left IS NOT NULL")
    ok = F.lit(True)
    if tolerance_seconds is not None:
        micros = lambda c: F.unix_micros(c.cast("timestamp"))
        ok = micros(F.col(ts)) - micros(F.col(f"__last.{right_ts}")) <= tolerance_seconds * 1_000_000
    both = both.withColumn("__last", F.when(ok, F.col("__last")))
    return both.select(*keys, ts, *(f"__left.{c}" for c in carried), f"__last.{right_ts}", *(f"__last.{c}" for c in columns))


def rolling(keys: Sequence[str], ts: str, rows: int) -> Window:
    """The last ``rows`` rows of a key, the current one included."""
    return Window.partitionBy(*keys).orderBy(ts).rowsBetween(-(rows - 1), 0)


def trailing(df: DataFrame, keys: Sequence[str], day: str, value: str, days: int, kind: str, out: str) -> DataFrame:
    """Mean or exact median of the ``days`` days before each row, the row's own day left out; null without any.

    One row per key and day. The mean is a range window; the median collects at most ``days`` values a row.
    """
    w = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-days, -1)
    if kind == "mean":
        return df.withColumn(out, F.avg(value).over(w))
    values = F.array_sort(F.collect_list(value).over(w))
    n = F.size(values)
    at = lambda k: F.element_at(values, k.cast("int"))
    median = (at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2
    return df.withColumn(out, F.when(n > 0, median))


def sums_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, total: str, rows: str) -> DataFrame:
    """(keys, total, rows): a sum of doubles added up in the order given, and how many rows there are.

    Partial sums depend on how rows are dealt to tasks in their last digits, which decides where totals are compared with a
    bound or rounded at a tie. Here a group's total is the last value of a running sum, so no task holds a group as a whole.
    """
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = df.select(*keys, F.sum(value).over(w).alias("__sum"), F.count("*").over(w).alias("__n"))
    return run.groupBy(*keys).agg(F.max_by("__sum", "__n").alias(total), F.max("__n").alias(rows))


def fill(df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], forward: bool = True, backward: bool = False) -> DataFrame:
    """Last known value carried forward, then the next one backward; however long a series is, no task holds it."""
    out = scans.numbered(df, keys, ts)
    own = {f"__f_{c}": (lambda c=c: F.col(c)) for c in columns}
    if forward:
        out = scans.last_known(out, keys, own)
    if backward:
        out = scans.last_known(out, keys, {f"__b_{c}": (lambda c=c: F.col(c)) for c in columns}, forward=False)
    tries = lambda c: [f"__f_{c}"] * forward + [f"__b_{c}"] * backward
    return out.withColumns({c: F.coalesce(c, *tries(c)) for c in columns}).drop("__n", *(t for c in columns for t in tries(c)))


def _gap(value: str, at: str) -> Column:
    """Length of the run of nulls around a row, from the numbers of the known rows around it; 0 where there is a value."""
    gap = F.coalesce(f"{at}_after", "__total") - F.coalesce(f"{at}_before", F.lit(-1)) - 1
    return F.when(F.col(value).isNull(), gap).otherwise(0)


def _known_at(value: str) -> Column:
    return F.when(F.col(value).isNotNull(), F.col("__n"))


def gap_lengths(df: DataFrame, keys: Sequence[str], ts: str, value: str, out: str = "gap_length") -> DataFrame:
    """Length of the run of nulls that a row lies in, 0 where there is a value."""
    n = scans.neighbours(scans.numbered(df, keys, ts, total="__total"), keys, {"__at": lambda: _known_at(value)})
    return n.withColumn(out, _gap(value, "__at")).drop("__n", "__total", "__at_before", "__at_after")


def decaying_mean(df: DataFrame, keys: Sequence[str], ts: str, value: str, half_life: float, out: str) -> DataFrame:
    """Mean of all rows so far, each weighted by half per ``half_life`` rows of age; nulls age, but weigh nothing. Buckets of
    rows reach back as far as a weight can be told from 0; a row with no value in reach keeps the last mean."""
    back = scans.reach(half_life)
    b = scans.bucketed(df, keys, ts, back).withColumn(out, scans.decaying(keys, value, half_life, back))
    mean = scans.last_known(b.filter("__own").drop("__own", "__bucket"), keys, {"__mean": lambda: F.col(out)})
    return mean.withColumn(out, F.col("__mean")).drop("__mean", "__n")


def impute(df: DataFrame, keys: Sequence[str], ts: str, column: str, small: int = 6, day: int = 24, days_back: int = 3, monthly: dict[int, float] | None = None) -> DataFrame:
    """``impute_columns`` for one column."""
    return impute_columns(df, keys, ts, {column: monthly}, small, day, days_back)


def impute_columns(df: DataFrame, keys: Sequence[str], ts: str, columns: Mapping[str, Mapping[int, float] | None], small: int = 6, day: int = 24, days_back: int = 3) -> DataFrame:
    """Fills nulls of hourly series, in order: in gaps longer than ``small`` the value a day (two, three) before, values
    filled earlier included; then the month's default, if the column has defaults; short gaps by interpolation over rows; edges
    by the nearest value. A column without any value gets its defaults, or stays null.

    The day-before rule reads what it has filled itself, but needs no walk: rows a whole number of days apart form a chain,
    and what a row takes over is the last value or default of its chain, unless the last ``days_back`` links are all short
    gaps (not filled yet at that point), where the month's default starts anew. Those links are a bounded look back, the rest
    is handed on by one row a bucket, so a series of any length is in no task whole.
    """
    names = {c: f"__c{k}" for k, c in enumerate(columns)}
    of = lambda c, part: f"{names[c]}_{part}"
    each = lambda part, make: {of(c, part): make(c) for c in columns}
    df = scans.numbered(df, keys, ts, total="__total")
    df = scans.neighbours(df, keys, each("at", lambda c: lambda: _known_at(c)))
    df = df.withColumns(each("large", lambda c: _gap(c, of(c, "at")) > small)).drop("__total", *(of(c, f"at_{s}") for c in columns for s in ("before", "after")))

    # where a chain starts anew, by the links a day to days_back days before
    near = Window.partitionBy(*keys, "__bucket").orderBy("__n")
    taken = lambda c: F.col(c).isNotNull() | F.col(of(c, "large"))
    linked = lambda c: reduce(lambda a, b: a | b, (F.coalesce(F.lag(taken(c), day * k).over(near), F.lit(False)) for k in range(1, days_back + 1)))
    df = scans.own_rows_numbered(scans.dealt(df, day * days_back).withColumns(each("new", lambda c: F.col(of(c, "large")) & ~linked(c))))

    def source(c: str) -> Column:
        """A struct, so that a default that is null is handed on too."""
        monthly = columns[c]
        default = F.try_element_at(F.create_map(*(F.lit(x) for m, v in monthly.items() for x in (m, float(v)))), F.month(ts)) if monthly else F.lit(None).cast("double")
        return F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("double").alias("v"))).when(F.col(of(c, "new")), F.struct(default.alias("v")))

    df = scans.last_known(df.withColumn("__link", F.col("__n") % day), [*keys, "__link"], each("from", lambda c: lambda: source(c)), size=scans.SIZE * day)
    df = df.withColumns(each("v", lambda c: F.when(taken(c), F.col(of(c, "from"))["v"])))
    df = scans.neighbours(df.drop("__link", *(of(c, p) for c in columns for p in ("large", "new", "from"))), keys, each("k", lambda c: lambda: F.when(F.col(of(c, "v")).isNotNull(), F.struct(F.col("__n").alias("n"), F.col(of(c, "v")).alias("v")))))

    def value(c: str) -> Column:
        p, q = F.col(of(c, "k_before")), F.col(of(c, "k_after"))
        steps = F.least(F.col("__n") - p["n"], F.lit(small))
        between = p["v"] + (q["v"] - p["v"]) * steps / (q["n"] - p["n"])
        return F.coalesce(F.col(of(c, "v")), F.when(q["n"] > p["n"], between), p["v"], q["v"])

    return df.withColumns({c: value(c) for c in columns}).drop("__n", *(of(c, p) for c in columns for p in ("v", "k_before", "k_after")))


def hours(df: DataFrame, start: str, end: str, step: str = "1 HOUR", out: str = "ts") -> DataFrame:
    """A row per step of the half-open interval [start, end)."""
    last = F.col(end) - F.expr(f"INTERVAL {step}")
    return df.withColumn(out, F.explode(F.when(F.col(start) <= last, F.sequence(F.col(start), last, F.expr(f"INTERVAL {step}")))))
