"""Wide and long forms, nested text and arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value", keep_nulls: bool = False, cast: str = "double") -> DataFrame:
    """A row per id and column; rows without a value only if asked for."""
    long = df.select(*ids, *(F.col(c).cast(cast) for c in columns)).unpivot(list(ids), list(columns), name, value)
    return long if keep_nulls else long.filter(F.col(value).isNotNull())


def to_wide(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str], how: str = "max") -> DataFrame:
    """A column per name (the names are given, so no pass over the data finds them)."""
    picked = [getattr(F, how)(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names]
    return df.groupBy(*keys).agg(*picked)


def explode_json(df: DataFrame, column: str, schema: str, out: str) -> DataFrame:
    """A row per element of a JSON array given as text; none for null or empty arrays."""
    return df.withColumn(out, F.explode(F.from_json(column, f"array<{schema}>"))).drop(column)


def json_fields(column: Column | str, **paths: str) -> list[Column]:
    """Fields of a JSON text by path, as text."""
    return [F.get_json_object(column, p).alias(n) for n, p in paths.items()]


def json_object(**fields: Column) -> Column:
    """A JSON object that keeps null fields."""
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())), {"ignoreNullFields": "false"})


def zip_arrays(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """Arrays side by side to a row per position (column-wise answers of forecast services)."""
    zipped = F.explode(F.arrays_zip(*arrays)).alias("__z")
    rest = [c for c in df.columns if c not in arrays]
    return df.select(*rest, zipped).select(*rest, *(f"__z.{a}" for a in arrays))


def pad_union(*frames: DataFrame) -> DataFrame:
    """Union by name; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
