"""Annotation files: matched to slides by name, and polygons read from GeoJSON or XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_GEOJSON = "struct<features:array<struct<geometry:struct<type:string,coordinates:array<array<array<double>>>>,properties:struct<classification:struct<name:string>>>>>"


def matched(slides: DataFrame, files: DataFrame, slide_col: str = "slide_id", file_col: str = "name") -> DataFrame:
    """Pairs whose names contain one another, either way round.

    No equality follows from containment, so the plan is a nested loop over pairs; files are a small listing beside slides.
    """
    a, b = slides[slide_col], files[file_col]
    return slides.join(files, F.contains(a, b) | F.contains(b, a))


def geojson_polygons(spark: SparkSession, path: str) -> DataFrame:
    """(path, label, polygon array<struct<x,y>>) of each outer ring of each feature."""
    raw = spark.read.format("binaryFile").load(path).select("path", F.from_json(F.decode("content", "UTF-8"), _GEOJSON).alias("j"))
    feature = raw.select("path", F.explode("j.features").alias("f"))
    ring = F.transform(F.get("f.geometry.coordinates", 0), lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y")))
    return feature.where("f.geometry.type = 'Polygon'").select("path", F.col("f.properties.classification.name").alias("label"), ring.alias("polygon"))


def xml_polygons(spark: SparkSession, path: str) -> DataFrame:
    """(path, label, polygon) of ASAP annotations, by path expressions over whole files."""
    raw = spark.read.format("binaryFile").load(path).select("path", F.decode("content", "UTF-8").alias("doc"))
    one = raw.select("path", F.posexplode(F.regexp_extract_all("doc", F.lit(r"(?s)(<Annotation .*?</Annotation>)"), 1)).alias("k", "a"))
    points = F.regexp_extract_all("a", F.lit(r"(<Coordinate [^>]*>)"), 1)
    at = lambda p, n: F.regexp_extract(p, rf'{n}="([^"]*)"', 1).cast("double")
    polygon = F.transform(points, lambda p: F.struct(at(p, "X").alias("x"), at(p, "Y").alias("y")))
    return one.select("path", F.regexp_extract("a", r'PartOfGroup="([^"]*)"', 1).alias("label"), polygon.alias("polygon"))


def inside(tiles: DataFrame, polygons: DataFrame, keys: str = "slide_id") -> DataFrame:
    """tiles whose centre lies in a polygon of their slide, with its label; by counting crossings, in one expression."""
    t = tiles.join(polygons.select(keys, "label", "polygon"), keys)
    cx, cy, n = F.col("x") + F.col("size") / 2, F.col("y") + F.col("size") / 2, F.size("polygon")
    p = lambda i: F.get("polygon", i % n)
    crossed = F.filter(F.sequence(F.lit(0), n - 1), lambda i: ((p(i)["y"] > cy) != (p(i + 1)["y"] > cy)) & (cx < (p(i + 1)["x"] - p(i)["x"]) * F.try_divide(cy - p(i)["y"], p(i + 1)["y"] - p(i)["y"]) + p(i)["x"]))
    return t.where(F.size(crossed) % 2 == 1).drop("polygon")
