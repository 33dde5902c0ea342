"""What a run knows: the session, where tables lie, the time that counts as now, and parameters."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Context:
    """``as_of`` stands for the wall clock, so that runs can be repeated."""

    spark: SparkSession
    warehouse: str
    as_of: dt.datetime
    vars: dict[str, Any] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    #: What the model that is being built has written before; None where it hasn't, or is written anew.
    target: DataFrame | None = None

    def now(self) -> Column:
        return F.lit(self.as_of).cast("timestamp_ntz")

    def today(self, back: int = 0) -> Column:
        """The day of ``as_of``, or a number of days before it."""
        return F.lit(self.as_of.date() - dt.timedelta(days=back))

    def path(self, layer: str, name: str) -> str:
        return f"{self.warehouse}/{layer}/{name}"

    def var(self, name: str, default: Any = None) -> Any:
        return self.vars.get(name, default)
