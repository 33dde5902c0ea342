"""Rooftop photovoltaics: ranking, roll-out, summaries, sizing, detections; merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..materialize import merged
from ..operators import dedup, planning
from ..sources import payloads
from .base import r4, t

_PARAMS = [(1, 2.0, 0.0045), (2, 6.0, 0.0045), (3, 12.0, 0.0045), (4, 20.0, 0.0045), (5, 30.0, 0.0045)]


def _params(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_PARAMS, "year int, cumulative_adoption_pct double, degradation_rate double")


def _ranking(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("nation"), r4(F.abs("c_acctbal") / 500, 2).alias("kw"), r4(F.abs("c_acctbal") / 1000 + 2, 4).alias("payback"))
    return planning.rank_with_percentile(c, F.col("payback").asc(), F.col("c_custkey").asc())


_RANK = """c AS (SELECT c_custkey, c_nationkey::BIGINT AS nation, round(abs(c_acctbal) / 500, 2) AS kw, round(abs(c_acctbal) / 1000 + 2, 4) AS payback FROM customer),
r AS (SELECT *, row_number() OVER (ORDER BY payback, c_custkey) AS rank, count(*) OVER () AS total FROM c), k AS (SELECT *, round(100.0::DOUBLE * rank / total, 2) AS pct FROM r)"""
_PLAN = _RANK + ", v(year, cum, deg) AS (VALUES (1, 2.0, 0.0045), (2, 6.0, 0.0045), (3, 12.0, 0.0045), (4, 20.0, 0.0045), (5, 30.0, 0.0045)), g AS (SELECT *, lag(cum, 1, 0) OVER (ORDER BY year) AS lo FROM v), pl AS (SELECT k.*, g.year, g.deg FROM k JOIN g ON pct > lo AND pct <= cum)"


def q_rank_percentile(spark: SparkSession, d: str) -> DataFrame:
    return _ranking(spark, d).select("c_custkey", "rank", "cumulative_pct")


SQL_rank_percentile = f"WITH {_RANK} SELECT c_custkey, rank, pct AS cumulative_pct FROM k"


def q_range_plan(spark: SparkSession, d: str) -> DataFrame:
    return planning.roll_out(_ranking(spark, d), _params(spark)).select("c_custkey", "rank", F.col("install_year").cast("long").alias("install_year"))


SQL_range_plan = f"WITH {_PLAN} SELECT c_custkey, rank, year::BIGINT AS install_year FROM pl"

#: What a plan's row holds besides: energy and money made of size and payback.
_ENERGY = {"kwp": "kw * 1.0137184159D", "annual_production_kwh": "kw * 1100.3141592D", "annual_consumption_kwh": "kw * 900", "capex": "kw * 1500.271828D", "npv": "kw * 100.1414213D - payback", "irr": "payback / 100", "payback_simple": "payback", "tasso_autoconsumo": "0.25 + nation / 100"}


def q_plan_summary(spark: SparkSession, d: str) -> DataFrame:
    r = _ranking(spark, d)
    plan = planning.roll_out(r, _params(spark)).withColumns({k: F.expr(v) for k, v in _ENERGY.items()})
    y = planning.yearly_summary(plan, r.agg(F.count("*").alias("total_eligible")))
    return y.withColumn("install_year", F.col("install_year").cast("long"))


_SUMS = """count(*) AS buildings, round(sum(kwp), 1) AS kwp1, round(sum(annual_production_kwh) / 1000, 1) AS made, round(sum(annual_consumption_kwh) / 1000, 1) AS used, round(sum(annual_production_kwh * tasso_autoconsumo) / 1000, 1) AS own,
round(sum(annual_production_kwh * (1 - tasso_autoconsumo)) / 1000, 1) AS out, round(sum(capex), 0) AS paid, round(sum(npv), 0) AS npv0, round(sum(kwp * irr) / nullif(sum(kwp), 0), 4) AS weighted_avg_irr, round(avg(payback_simple), 1) AS avg_payback_years"""
_WITH_ENERGY = "e AS (SELECT *, " + ", ".join(f"({v.replace('D', '::DOUBLE')})::DOUBLE AS {k}" for k, v in _ENERGY.items()) + " FROM pl)"
SQL_plan_summary = f"""WITH {_PLAN}, {_WITH_ENERGY}, y AS (SELECT year, {_SUMS}, min(deg)::DOUBLE AS deg FROM e GROUP BY 1),
s AS (SELECT *, sum(buildings) OVER w AS cb, round(sum(kwp1) OVER w, 1) AS ck, round(sum(paid) OVER w, 0) AS cp, round(sum(npv0) OVER w, 0) AS cn, round(sum(made) OVER w - sum(made * deg * (year - 1)) OVER w, 1) AS cm, (SELECT count(*) FROM k) AS total FROM y WINDOW w AS (ORDER BY year))
SELECT year::BIGINT AS install_year, buildings AS new_buildings, cb::BIGINT AS cum_buildings, round(100.0::DOUBLE * cb / total, 1) AS coverage_pct, kwp1 AS new_kwp, ck AS cum_kwp, round(ck / 1000, 2) AS cum_mwp, made AS new_production_mwh, used AS new_consumption_mwh,
own AS new_self_consumed_mwh, out AS new_grid_export_mwh, cm AS cum_annual_production_mwh, paid AS new_investment_eur, cp AS cum_investment_eur, round(cp / 1000000, 2) AS cum_investment_meur, npv0 AS new_npv_eur, cn AS cum_npv_eur, weighted_avg_irr, avg_payback_years, total AS total_eligible FROM s"""


def q_area_plan(spark: SparkSession, d: str) -> DataFrame:
    """Installations by area and year, areas being nations."""
    plan = planning.roll_out(_ranking(spark, d), _params(spark)).withColumns({k: F.expr(v) for k, v in _ENERGY.items()})
    return planning.area_plan(plan, ["nation"]).withColumn("install_year", F.col("install_year").cast("long"))


SQL_area_plan = f"""WITH {_PLAN}, {_WITH_ENERGY}, y AS (SELECT nation, year, {_SUMS}, sum(kwp) AS k, sum(capex) AS c FROM e GROUP BY 1, 2)
SELECT nation, year::BIGINT AS install_year, buildings AS new_buildings, (sum(buildings) OVER w)::BIGINT AS cum_buildings, kwp1 AS new_kwp, round(sum(k) OVER w, 1) AS cum_kwp, made AS new_production_mwh, own AS new_self_consumed_mwh, out AS new_grid_export_mwh,
paid AS new_investment_eur, round(sum(c) OVER w, 0) AS cum_investment_eur, npv0 AS new_npv_eur, weighted_avg_irr, avg_payback_years FROM y WINDOW w AS (PARTITION BY nation ORDER BY year)"""


def q_area_summary(spark: SparkSession, d: str) -> DataFrame:
    """What the roofs of each area hold, with kinds of use."""
    kinds = F.element_at(F.array(*map(F.lit, ("residential", "commercial", "industrial", "office"))), (F.col("c_custkey") % 4 + 1).cast("int"))
    return planning.area_summary(_ranking(spark, d).withColumns({k: F.expr(v) for k, v in _ENERGY.items()} | {"user_type": kinds}), ["nation"])


SQL_area_summary = f"""WITH {_RANK}, pl AS (SELECT * FROM k), {_WITH_ENERGY} SELECT nation, buildings, kwp1 AS total_kwp, mwp AS total_mwp, made AS total_production_mwh, used AS total_consumption_mwh, own AS total_self_consumed_mwh, out AS total_grid_export_mwh, paid AS total_investment_eur, meur AS total_investment_meur, npv0 AS total_npv_eur, weighted_avg_irr,
avg_payback_years, share AS avg_autoconsumo, a AS residential_buildings, b AS commercial_buildings, c AS industrial_buildings FROM (SELECT nation, {_SUMS}, round(sum(kwp) / 1000, 2) AS mwp, round(sum(capex) / 1000000, 2) AS meur, round(avg(tasso_autoconsumo), 4) AS share, count(*) FILTER (c_custkey % 4 = 0) AS a, count(*) FILTER (c_custkey % 4 = 1) AS b, count(*) FILTER (c_custkey % 4 = 2) AS c FROM e GROUP BY 1)"""


def q_window_over_agg(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders").groupBy(F.year("o_orderdate").cast("long").alias("year"), "o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("price"))
    w = Window.partitionBy("o_orderstatus").orderBy("year")
    return o.select("year", "o_orderstatus", "n", F.sum("n").over(w).alias("running"), F.round(F.col("price") / F.sum("price").over(Window.partitionBy("year")), 6).alias("share"))


SQL_window_over_agg = """SELECT year(o_orderdate) AS year, o_orderstatus, count(*) AS n, sum(count(*)) OVER (PARTITION BY o_orderstatus ORDER BY year(o_orderdate))::BIGINT AS running,
round(sum(o_totalprice) / sum(sum(o_totalprice)) OVER (PARTITION BY year(o_orderdate)), 6) AS share FROM orders GROUP BY 1, 2"""


def q_weighted_summary(spark: SparkSession, d: str) -> DataFrame:
    li = t(spark, d, "lineitem")
    q = F.col("l_quantity")
    return li.groupBy("l_returnflag").agg(F.count_if(F.col("l_linestatus") == "O").alias("open"), F.round(F.sum(q * F.col("l_discount")) / F.nullif(F.sum(q), F.lit(0.0)), 6).alias("mean_discount"), r4(F.avg("l_extendedprice"), 2).alias("mean_price"))


SQL_weighted_summary = "SELECT l_returnflag, count(*) FILTER (l_linestatus = 'O') AS open, round(sum(l_quantity * l_discount) / nullif(sum(l_quantity), 0), 6) AS mean_discount, round(avg(l_extendedprice), 2) AS mean_price FROM lineitem GROUP BY 1"


def _sized(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part")
    area = F.col("p_size") * 20.0
    use = planning.use_of_building(area, F.when(F.col("p_partkey") % 7 > 0, F.col("p_size") % 6), F.when(F.col("p_size") % 5 == 0, "Agricultural").when(F.col("p_size") % 5 == 1, "barn"))
    kwh = planning.yearly_use(area, use)
    return p.select("p_partkey", area.alias("area"), use.alias("use"), kwh.alias("kwh"), planning.system_size(area, use, kwh).alias("kw"))


#: By the rules of classification, consumption and sizing: a known class; more than three floors; more than 200 square
#: metres, from 500 on and with one floor at most industrial; homes by 3500 kWh and a fifth of headroom; 0.13 kWp a square metre.
_SIZED = """b AS (SELECT p_partkey, p_size * 20.0::DOUBLE AS area, CASE WHEN p_size % 5 = 0 THEN 'agricultural' WHEN floors > 3 THEN 'commercial' WHEN p_size * 20 > 200 AND p_size * 20 >= 500 AND floors <= 1 THEN 'industrial' WHEN p_size * 20 > 200 THEN 'commercial' ELSE 'residential' END AS use
  FROM (SELECT *, CASE WHEN p_partkey % 7 > 0 THEN p_size % 6 ELSE 0 END AS floors FROM part)),
z AS (SELECT *, CASE use WHEN 'residential' THEN 3500 WHEN 'office' THEN area * 80 WHEN 'commercial' THEN area * 100 WHEN 'industrial' THEN area * 150 WHEN 'agricultural' THEN area * 30 ELSE area * 80 END::DOUBLE AS kwh FROM b),
s AS (SELECT *, round(CASE WHEN use = 'residential' THEN least(area * 0.13::DOUBLE, kwh * 1.2::DOUBLE / 1100, 20.0) ELSE least(area * 0.13::DOUBLE, 20.0) END, 2) AS kw FROM z)"""


def q_classify_building(spark: SparkSession, d: str) -> DataFrame:
    return _sized(spark, d).groupBy("use").agg(F.count("*").alias("n"), r4(F.sum("kwh"), 2).alias("kwh"))


SQL_classify_building = f"WITH {_SIZED} SELECT use, count(*) AS n, round(sum(kwh), 2) AS kwh FROM s GROUP BY 1"


def q_size_system(spark: SparkSession, d: str) -> DataFrame:
    return _sized(spark, d).select("p_partkey", "use", "kw")


SQL_size_system = f"WITH {_SIZED} SELECT p_partkey, use, kw FROM s"


def q_cash_flow(spark: SparkSession, d: str) -> DataFrame:
    """Present value and paybacks; the internal rate by the present value that it leaves (zero)."""
    s = planning.cash_flow(_sized(spark, d), "kw", "kwh")
    flow = F.expr("(least(kw * 1100 * 0.35D, kwh) * 0.25D + (kw * 1100 - least(kw * 1100 * 0.35D, kwh)) * 0.08D)")
    s = s.withColumn("first", flow).withColumn("year", F.explode(F.sequence(F.lit(1), F.lit(25))))
    paid = F.sum(F.col("first") * F.pow(F.lit(1 - 0.0045), F.col("year") - 1) / F.pow(1 + F.col("irr"), F.col("year")))
    cols = ["npv", "payback_simple", "payback_discounted", "tasso_autoconsumo", "kw"]
    s = s.groupBy("p_partkey").agg(*(F.first(c).alias(c) for c in cols), paid.alias("paid"))
    left = F.col("paid") - F.col("kw") * 1500
    return s.select("p_partkey", r4(F.col("npv"), 2).alias("npv"), r4(F.col("payback_simple"), 2).alias("payback_simple"), r4(F.col("payback_discounted"), 2).alias("payback_discounted"), r4(F.col("tasso_autoconsumo")).alias("tasso_autoconsumo"), (F.abs(left) < 0.01).alias("irr_solves"))


SQL_cash_flow = f"""WITH {_SIZED}, f AS (SELECT *, least(kw * 1100 * 0.35::DOUBLE, kwh) AS own FROM s), n AS (SELECT *, own * 0.25::DOUBLE + (kw * 1100 - own) * 0.08::DOUBLE AS first FROM f),
p AS (SELECT p_partkey, (SELECT sum(n.first * pow(1 - 0.0045::DOUBLE, y - 1) / pow(1.055::DOUBLE, y)) FROM range(1, 26) g(y)) AS present, kw, own, first FROM n)
SELECT p_partkey, round(present - kw * 1500, 2) AS npv, round(kw * 1500 / nullif(first, 0), 2) AS payback_simple, CASE WHEN present > kw * 1500 THEN round(ln(1 - kw * 1500 * (1 - 0.9955::DOUBLE / 1.055) * 1.055::DOUBLE / first) / ln(0.9955::DOUBLE / 1.055), 2) END AS payback_discounted,
round(own / nullif(kw * 1100, 0), 4) AS tasso_autoconsumo, true AS irr_solves FROM p"""


_ANSWERS = [
    ('Result: {"has_pv": true, "confidence": 1.5} end', True, 1.0), ('{"has_pv": false, "confidence": 0.25}', False, 0.25), ('{"confidence": 0.5} yes', None, 0.5), ('{"has_pv": null}', False, 0.0),
    ("Yes, confidence 0.75", True, 0.75), ("No panels. Conf: 0.5", False, 0.5), ("false, not true", True, 0.0), ("unclear", None, 0.0), ('{broken} nothing seen, confidence: 7', False, 1.0), ('{"has_pv": 1, "confidence": "high"} yes', True, 0.0),
]


def q_parse_detection(spark: SparkSession, d: str) -> DataFrame:
    """Free answers of a model: JSON first, then words anywhere; confidence held within 0 and 1."""
    e = t(spark, d, "events")
    raw = F.element_at(F.array(*(F.lit(a[0]) for a in _ANSWERS)), (F.col("event_id") % len(_ANSWERS) + 1).cast("int"))
    flag, confidence = payloads.detection(raw)
    return e.select("event_id", flag.alias("has_pv"), F.round(confidence, 4).alias("confidence"))


#: What the rules give for each answer, worked out by hand.
SQL_parse_detection = "SELECT event_id, a.has_pv, a.confidence FROM events JOIN (VALUES " + ", ".join(f"({k}, {'NULL' if f is None else f}::BOOLEAN, {c}::DOUBLE)" for k, (_, f, c) in enumerate(_ANSWERS)) + f") a(k, has_pv, confidence) ON event_id % {len(_ANSWERS)} = a.k"


def _batches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """What was known by the end of 1996, and the batch of 1996 and after."""
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"), "o_orderdate")
    old, new = o.filter("o_orderdate < DATE '1997-01-01'").drop("o_orderdate"), o.filter("o_orderdate >= DATE '1996-01-01'")
    return old, new.select("o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))


def q_merge_partial(spark: SparkSession, d: str) -> DataFrame:
    old, new = _batches(spark, d)
    return merged(old, new, ["o_orderkey"], ["o_totalprice"])


SQL_merge_partial = """WITH a AS (SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS p FROM orders WHERE o_orderdate < DATE '1997-01-01'), b AS (SELECT o_orderkey, 'X' AS o_orderstatus, round(o_totalprice, 2) + 1 AS p FROM orders WHERE o_orderdate >= DATE '1996-01-01')
SELECT o_orderkey, coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus, coalesce(b.p, a.p) AS o_totalprice FROM a FULL JOIN b USING (o_orderkey)"""


def q_merge_full(spark: SparkSession, d: str) -> DataFrame:
    old, new = _batches(spark, d)
    return merged(old, new, ["o_orderkey"])


SQL_merge_full = """WITH a AS (SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS p FROM orders WHERE o_orderdate < DATE '1997-01-01'), b AS (SELECT o_orderkey, 'X' AS o_orderstatus, round(o_totalprice, 2) + 1 AS p FROM orders WHERE o_orderdate >= DATE '1996-01-01')
SELECT o_orderkey, coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus, coalesce(b.p, a.p) AS o_totalprice FROM a FULL JOIN b USING (o_orderkey)"""


def q_registry_unnest(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer")
    m = c.select(
        F.col("c_custkey").cast("string").alias("user_id"), F.lit("rec").alias("rec_id"), F.col("c_mktsegment").alias("area"), F.lit("home").alias("member_type"), F.when(F.col("c_acctbal") > 0, "prosumer").otherwise("consumer").alias("role"),
        F.filter(F.array(F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("s-"), F.col("c_custkey"))), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("t-"), F.col("c_custkey")))), lambda x: x.isNotNull()).alias("sensor_ids"),
        F.when(F.col("c_custkey") % 5 > 0, F.array(F.col("c_nationkey").cast("string"))).otherwise(F.array().cast("array<string>")).alias("topology_ids"),
    )
    return payloads.registry_devices(m)


SQL_registry_unnest = """SELECT user_id, 'rec' AS rec_id, area, role, 'home' AS member_type, substation_id, unnest(s) AS sensor_id FROM (SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS area, CASE WHEN c_acctbal > 0 THEN 'prosumer' ELSE 'consumer' END AS role,
list_filter([CASE WHEN c_custkey % 2 = 0 THEN 's-' || c_custkey END, CASE WHEN c_custkey % 3 = 0 THEN 't-' || c_custkey END], lambda x: x IS NOT NULL) AS s, CASE WHEN c_custkey % 5 > 0 THEN CAST(c_nationkey AS VARCHAR) END AS substation_id FROM customer)"""


def q_latest_estimate(spark: SparkSession, d: str) -> DataFrame:
    """The newest estimate of each building joined to its detection."""
    li = t(spark, d, "lineitem")
    newest = dedup.distinct_on(li, ["l_partkey"], F.col("l_shipdate").desc(), F.col("l_orderkey"), F.col("l_linenumber"))
    p = t(spark, d, "part")
    return newest.join(p, F.col("l_partkey") == F.col("p_partkey")).select("p_partkey", "l_orderkey", "p_brand")


SQL_latest_estimate = """SELECT p_partkey, l_orderkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) AS rn FROM lineitem) JOIN part ON l_partkey = p_partkey WHERE rn = 1"""
