"""Ranking of installations, roll-out by year and summaries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import rounded
from .joins import range_lookup, ranked, with_scalars


def rank_with_percentile(df: DataFrame, *order: Column) -> DataFrame:
    """Adds rank (1 is best), total_buildings and cumulative_pct, the rank's share of all rows in per cent, two decimals."""
    total = df.agg(F.count("*").alias("total_buildings"))
    return with_scalars(ranked(df, *order), total).withColumn("cumulative_pct", rounded(F.col("rank") * 100.0 / F.col("total_buildings"), 2))


def roll_out(ranking: DataFrame, params: DataFrame) -> DataFrame:
    """The year in which each rank is installed. params: (year, cumulative_adoption_pct, degradation_rate), a few rows."""
    before = F.lag("cumulative_adoption_pct", 1, 0.0).over(Window.orderBy("year"))
    steps = params.withColumn("above_pct", before)
    return range_lookup(ranking, "cumulative_pct", steps, "above_pct", "cumulative_adoption_pct").drop("above_pct", "cumulative_adoption_pct").withColumnRenamed("year", "install_year")


def _totals(per_mwh: float = 1000.0) -> list[Column]:
    """What the summaries of installations share: buildings, capacity, energy in MWh, money and means."""
    made, own = F.col("annual_production_kwh"), F.col("tasso_autoconsumo")
    mwh = lambda x: rounded(F.sum(x) / per_mwh, 1)
    return [
        F.count("*").alias("buildings"), rounded(F.sum("kwp"), 1).alias("kwp"), mwh(made).alias("production_mwh"), mwh("annual_consumption_kwh").alias("consumption_mwh"),
        mwh(made * own).alias("self_consumed_mwh"), mwh(made * (1 - own)).alias("grid_export_mwh"), rounded(F.sum("capex"), 0).alias("investment_eur"), rounded(F.sum("npv"), 0).alias("npv_eur"),
        rounded(F.sum(F.col("kwp") * F.col("irr")) / F.nullif(F.sum("kwp"), F.lit(0.0)), 4).alias("weighted_avg_irr"), rounded(F.avg("payback_simple"), 1).alias("avg_payback_years"),
    ]


def yearly_summary(plan: DataFrame, total: DataFrame) -> DataFrame:
    """Per install year: what is new, running totals, coverage of the ``total`` (one row: total_eligible), and the energy of
    all cohorts with each cohort's loss by its year. A row per year, so the running totals' one task sees few rows."""
    y = plan.groupBy("install_year").agg(*_totals(), F.min("degradation_rate").alias("degradation_rate"))
    new = ["buildings", "kwp", "production_mwh", "consumption_mwh", "self_consumed_mwh", "grid_export_mwh", "investment_eur", "npv_eur"]
    y = with_scalars(y.withColumnsRenamed({c: f"new_{c}" for c in new}), total)
    w = Window.orderBy("install_year")
    run = lambda c: F.sum(c).over(w)
    lost = F.col("new_production_mwh") * F.col("degradation_rate") * (F.col("install_year") - 1)
    y = y.withColumns({"cum_buildings": run("new_buildings"), "cum_kwp": rounded(run("new_kwp"), 1), "cum_investment_eur": rounded(run("new_investment_eur"), 0), "cum_npv_eur": rounded(run("new_npv_eur"), 0), "cum_annual_production_mwh": rounded(run("new_production_mwh") - F.sum(lost).over(w), 1)})
    y = y.withColumns({"coverage_pct": rounded(F.col("cum_buildings") * 100.0 / F.col("total_eligible"), 1), "cum_mwp": rounded(F.col("cum_kwp") / 1000, 2), "cum_investment_meur": rounded(F.col("cum_investment_eur") / 1e6, 2)})
    return y.select(
        "install_year", "new_buildings", "cum_buildings", "coverage_pct", "new_kwp", "cum_kwp", "cum_mwp", "new_production_mwh", "new_consumption_mwh", "new_self_consumed_mwh", "new_grid_export_mwh",
        "cum_annual_production_mwh", "new_investment_eur", "cum_investment_eur", "cum_investment_meur", "new_npv_eur", "cum_npv_eur", "weighted_avg_irr", "avg_payback_years", "total_eligible",
    )


def area_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """What the roofs of each area hold."""
    kind = lambda u: F.count_if(F.col("user_type") == u).alias(f"{u}_buildings")
    t = df.groupBy(*keys).agg(*_totals(), rounded(F.sum("kwp") / 1000, 2).alias("total_mwp"), rounded(F.sum("capex") / 1e6, 2).alias("total_investment_meur"), rounded(F.avg("tasso_autoconsumo"), 4).alias("avg_autoconsumo"), *map(kind, ("residential", "commercial", "industrial")))
    return t.withColumnsRenamed({c: f"total_{c}" for c in ("kwp", "production_mwh", "consumption_mwh", "self_consumed_mwh", "grid_export_mwh", "investment_eur", "npv_eur")})


def area_plan(df: DataFrame, keys: list[str]) -> DataFrame:
    """What is installed in each area and year, with running totals by area (from sums before rounding)."""
    g = df.groupBy(*keys, "install_year").agg(*_totals(), F.sum("kwp").alias("__kwp"), F.sum("capex").alias("__capex"))
    w = Window.partitionBy(keys[0]).orderBy("install_year")
    g = g.withColumns({"cum_buildings": F.sum("buildings").over(w), "cum_kwp": rounded(F.sum("__kwp").over(w), 1), "cum_investment_eur": rounded(F.sum("__capex").over(w), 0)})
    g = g.withColumnsRenamed({c: f"new_{c}" for c in ("buildings", "kwp", "production_mwh", "self_consumed_mwh", "grid_export_mwh", "investment_eur", "npv_eur")})
    return g.select(
        *keys, "install_year", "new_buildings", "cum_buildings", "new_kwp", "cum_kwp", "new_production_mwh", "new_self_consumed_mwh", "new_grid_export_mwh", "new_investment_eur", "cum_investment_eur",
        "new_npv_eur", "weighted_avg_irr", "avg_payback_years",
    )


#: Classes that name their use; floors and square metres that tell uses apart; kWh a square metre by use;
#: kWh of a household and its headroom; kWp a square metre of roof, greatest and least kWp, EUR a kWp, kWh a kWp.
KNOWN_USES = ("residential", "office", "commercial", "industrial", "agricultural")
HOME_FLOORS, HOME_AREA, INDUSTRY_AREA = 3, 200, 500
USE_KWH_M2 = {"office": 80.0, "commercial": 100.0, "industrial": 150.0, "agricultural": 30.0}
HOME_KWH, HEADROOM = 3500.0, 0.2
KWP_M2, MOST_KWP, LEAST_KWP, EUR_KWP, KWH_KWP = 0.130, 20.0, 3.0, 1500.0, 1100.0


def use_of_building(area: Column, floors: Column, building_class: Column) -> Column:
    """Kind of use: by class if known; high houses are commercial; large low ones industrial, other large ones commercial."""
    n, known = F.coalesce(floors.cast("int"), F.lit(0)), F.lower(building_class)
    large = F.when((area >= INDUSTRY_AREA) & (n <= 1), "industrial").otherwise("commercial")
    return F.when(known.isin(*KNOWN_USES), known).when(n > HOME_FLOORS, "commercial").when(area > HOME_AREA, large).otherwise("residential")


def yearly_use(area: Column, use: Column) -> Column:
    """kWh a year: a household's, or by area."""
    factor = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in USE_KWH_M2.items() for x in kv)), use), F.lit(80.0))
    return F.when(use == "residential", HOME_KWH).otherwise(area * factor)


def system_size(area: Column, use: Column, use_kwh: Column) -> Column:
    """kWp, two decimals: what the roof holds, at most the limit; for homes no more than their use and some headroom ask for."""
    roof = F.least(area * KWP_M2, F.lit(MOST_KWP))
    return F.round(F.when(use == "residential", F.least(roof, use_kwh * (1 + HEADROOM) / KWH_KWP)).otherwise(roof), 2)


def _growth(df: DataFrame, owed: str, years: int, out: str, steps: int = 8) -> DataFrame:
    """Adds the q over 0 with q + q^2 + ... + q^years = owed, by Newton's method, a projection a step. The sum is convex and
    rises with q, so from a start above the root every step stays above it. Where q is near 1 the closed forms of sum and slope
    lose digits, so their expansions at 1 stand in."""
    n, q, owes = float(years), F.col(out), F.col(owed)
    # the first power alone, and the mean of the powers, are bounds
    df = df.withColumn(out, F.least(owes, F.pow(owes / n, F.lit(2 / (n + 1)))))
    near, power = F.abs(q - 1) < 1e-5, F.col("__power")
    total = F.when(near, n + (q - 1) * (n * (n + 1) / 2)).otherwise(q * (power - 1) / (q - 1))
    slope = F.when(near, n * (n + 1) / 2 + (q - 1) * (n * (n + 1) * (n - 1) / 3)).otherwise((1 - (n + 1) * power + n * power * q) / ((1 - q) * (1 - q)))
    for _ in range(steps):
        df = df.withColumn("__power", F.pow(q, F.lit(n))).withColumn(out, q - (total - owes) / slope)
    return df.drop("__power")


def cash_flow(df: DataFrame, kw: str, use_kwh: str, years: int = 25, rate: float = 0.055, price: float = 0.25, feed_in: float = 0.08, self_share: float = 0.35, loss: float = 0.0045) -> DataFrame:
    """Adds net present value (npv), internal rate of return (irr), simple and discounted payback and the share consumed on site
    (tasso_autoconsumo) of a system, as plain discounted cash flow. The solver that the source system calls is private; this
    one is documented here.

    The yearly series is geometric, so present values have a closed form. The internal rate is the root of the present
    value between -90 and 1000 per cent; null where there is none in between.
    """
    made = F.col(kw) * KWH_KWP
    df = df.withColumn("__own", F.least(made * self_share, F.col(use_kwh))).withColumn("__first", F.col("__own") * price + (made - F.col("__own")) * feed_in)
    cost, first = F.col(kw) * EUR_KWP, F.nullif("__first", F.lit(0.0))

    def present(r: float) -> Column:
        q = (1 - loss) / (1 + r)
        return F.col("__first") / (1 + r) * (float(years) if abs(q - 1) < 1e-12 else (1 - q**years) / (1 - q))

    df = _growth(df.withColumn("__owed", cost / first * (1 - loss)), "__owed", years, "__q")
    q = (1 - loss) / (1 + rate)
    left = 1 - cost * (1 - q) * (1 + rate) / first
    return df.withColumns(
        {
            "npv": present(rate) - cost, "irr": F.when((present(-0.9) > cost) & (present(10.0) < cost), (1 - loss) / F.col("__q") - 1), "payback_simple": cost / first,
            "payback_discounted": F.when(left > q**years, F.log(left) / math.log(q)), "tasso_autoconsumo": F.col("__own") / F.nullif(made, F.lit(0.0)),
        }
    ).drop("__own", "__first", "__owed", "__q")
