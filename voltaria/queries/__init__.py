"""Registered queries and the DuckDB SQL that each is held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import community, environment, metering, rooftops, runs
from .base import Query

_MODULES = (metering, community, environment, rooftops, runs)

#: Queries that show dates, and the columns: dates are given as text, so that both sides render them alike.
_DATES = {
    "day": "unpivot_drop_null unpivot_keep_null pivot_case net_share_daily share_of_total proportional_cap passive_alloc effort_points trailing_median_spike trailing_avg_cap percent_rank co2 co2_community islands_streak day_tier range_replace heat_waves_resumed",
    "local_day": "local_day",
    "flag_date": "anti_gaming",
    "season_start season_end": "season_leaderboard",
}
_DATES_OF = {f"q_{n}": columns.split() for columns, names in _DATES.items() for n in names.split()}


def _dates_as_text(name: str, query: Query) -> Query:
    columns = _DATES_OF.get(name)
    return (lambda spark, sf_dir: query(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in columns})) if columns else query


def _sql_dates_as_text(name: str, sql: str) -> str:
    columns = _DATES_OF.get(name)
    return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in columns)}) FROM ({sql})" if columns else sql


QUERIES: dict[str, Query] = {n: _dates_as_text(n, f) for m in _MODULES for n, f in vars(m).items() if n.startswith("q_")}
ORACLE_SQL: dict[str, str] = {n: _sql_dates_as_text(n, s) for m in _MODULES for k, s in vars(m).items() if k.startswith("SQL_") for n in [f"q_{k[4:]}"]}
