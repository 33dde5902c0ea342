"""Ladders: the first step that matches names the tier."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(value: Column, steps: list[tuple[float, object]], otherwise: object = None) -> Column:
    """steps: (least value, result), tried in order; a null value takes ``otherwise``."""
    out: Column | None = None
    for least, result in steps:
        out = F.when(value >= least, result) if out is None else out.when(value >= least, result)
    return out.otherwise(otherwise)


def ladder_below(value: Column, steps: list[tuple[float, object]], otherwise: object = None) -> Column:
    """steps: (upper bound, result): the first bound that is above the value."""
    out: Column | None = None
    for below, result in steps:
        out = F.when(value < below, result) if out is None else out.when(value < below, result)
    return out.otherwise(otherwise)


#: Metres a second by which gusts pass the mean wind, and the level from there on (fixed values).
WIND_LEVELS = [(12.46, "ALERT"), (7.62, "WARNING")]
#: Colours of tiers (fixed values).
RISK_COLORS = {"ALERT": "#D00000", "WARNING": "#F7D000", "NORMAL": "#00A000"}


def wind_level(gust: Column, wind: Column) -> Column:
    return ladder(gust - wind, WIND_LEVELS, "NORMAL")


def risk_color(level: Column, default: str = "#808080") -> Column:
    out = F.lit(default)
    for name, color in RISK_COLORS.items():
        out = F.when(level == name, color).otherwise(out)
    return out


#: Metres at which altitude bands end, and the 90th percentile of daily maxima (degrees C) by band and month (fixed values).
BANDS = [(500.0, "low"), (1000.0, "mid")]
HEAT_P90 = {"low": {5: 22.0, 6: 26.0, 7: 27.0, 8: 27.0, 9: 23.0}, "mid": {5: 18.0, 6: 22.0, 7: 23.0, 8: 23.0, 9: 19.0}, "high": {5: 14.0, 6: 18.0, 7: 19.0, 8: 19.0, 9: 15.0}}


def altitude_band(metres: Column) -> Column:
    """low, mid or high; null for a null height."""
    return F.when(metres.isNotNull(), ladder_below(metres, BANDS, "high"))


def heat_threshold(band: Column, day: Column) -> Column:
    """The heat threshold of a band on a day; null off season."""
    return month_threshold(band, F.month(day), HEAT_P90)


def month_threshold(band: Column, month: Column, table: dict[str, dict[int, float]]) -> Column:
    """A threshold by band and month; null where the table has none (off season)."""
    out = F.lit(None).cast("double")
    for b, months in table.items():
        for m, value in months.items():
            out = F.when((band == b) & (month == m), value).otherwise(out)
    return out


def share(part: Column, whole: Column, otherwise: float | None = 0.0) -> Column:
    """part / whole, and ``otherwise`` where the whole is not above zero."""
    return F.when(whole > 0, part / whole).otherwise(otherwise)


def effort_points(kwh: Column, slots: Column, factor: float = 10.0) -> Column:
    """Points that grow with the logarithm of the effort per slot."""
    return F.when(slots > 0, slots * F.log1p(kwh / slots) * factor).otherwise(0.0)


def streak_multiplier(level: Column, increment: float = 0.05, most: float = 1.5) -> Column:
    return F.least(F.lit(1.0) + level * increment, F.lit(most))
