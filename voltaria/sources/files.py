"""Files: GeoJSON, CSV seeds, Parquet with a bounding box, JSON lines, and image tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """(id, geometry, properties) as text, a row per feature of the collections under a path."""
    schema = "type string, features array<string>"
    docs = spark.read.text(path, wholetext=True)
    return (
        docs.select(F.explode(F.from_json("value", schema)["features"]).alias("f"))
        .select(F.get_json_object("f", "$.id").alias("id"), F.get_json_object("f", "$.geometry").alias("geometry"), F.get_json_object("f", "$.properties").alias("properties"))
    )


def seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True)


def csv_tree(spark: SparkSession, path: str, schema: str, pattern: str = "*.csv") -> DataFrame:
    """All CSV files below a path whose names match."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).csv(path, schema=schema, header=True)


def parquet_in_box(spark: SparkSession, path: str, box: tuple[float, float, float, float], field: str = "bbox") -> DataFrame:
    """Rows whose box (struct of xmin, ymin, xmax, ymax) meets another; the comparisons are pushed into the scan."""
    x0, y0, x1, y1 = box
    b = lambda k: F.col(f"{field}.{k}")
    return spark.read.parquet(path).filter((b("xmin") <= x1) & (b("xmax") >= x0) & (b("ymin") <= y1) & (b("ymax") >= y0))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def tiles(spark: SparkSession, path: str) -> DataFrame:
    """(tile_id, content): images by the stem of their file name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{png,jpg,jpeg,tif,tiff}").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("tile_id"), "content")


def tiles_of(buildings: DataFrame, images: DataFrame, key: str = "building_id", prefix: int = 8) -> DataFrame:
    """Buildings with their tile: by the whole id, else by its first characters."""
    b = buildings.withColumn("__short", F.substring(F.col(key), 1, prefix))
    whole = b.join(images.select(F.col("tile_id").alias(key), F.col("content").alias("__whole")), key, "left")
    short = images.filter(F.length("tile_id") == prefix).select(F.col("tile_id").alias("__short"), F.col("content").alias("__part"))
    return whole.join(short, "__short", "left").withColumn("content", F.coalesce("__whole", "__part")).drop("__whole", "__part", "__short")
