"""Tiles drawn on a thumbnail: included ones framed, the others black."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def marked(grid: DataFrame, included: DataFrame, keys: tuple[str, ...] = ("slide_id", "x", "y")) -> DataFrame:
    """grid with is_included: whether the tile is among the included ones. A hash join; tiles met twice count once."""
    flag = included.select(*keys).distinct().withColumn("__in", F.lit(True))
    flag = flag.hint("merge")  # tiles look few to the planner, which would broadcast them
    return grid.join(flag, list(keys), "left").withColumn("is_included", F.col("__in").isNotNull()).drop("__in")


def missing(valid: DataFrame, surviving: DataFrame, keys: tuple[str, ...] = ("slide_id", "x", "y")) -> DataFrame:
    """Origins of valid that are not in surviving, each once."""
    # grouped rather than subtracted: that is a join, for which the planner would broadcast surviving
    both = valid.select(*keys, F.lit(False).alias("__survives")).union(surviving.select(*keys, F.lit(True)))
    return both.groupBy(*keys).agg(F.max("__survives").alias("__survives")).where("NOT __survives").drop("__survives")


def reconstructed(pixels: DataFrame, tiles: DataFrame, line: int = 1, blank: bool = True) -> DataFrame:
    """pixels under the drawing of tiles (slide_id, x, y, size, scale, is_included).

    Each tile is exploded to the pixels it paints, reduced to one paint a pixel, and joined once. A frame covers a blank.
    """
    side, px, py = F.floor(F.col("size") / F.col("scale")).cast("int"), F.floor(F.col("x") / F.col("scale")).cast("int"), F.floor(F.col("y") / F.col("scale")).cast("int")
    t = tiles.select("slide_id", "is_included", px.alias("px"), py.alias("py"), side.alias("side")).where("side > 0")
    box = t.select("*", F.explode(F.sequence(-F.lit(line), F.col("side") - 1)).alias("dy")).select("*", F.explode(F.sequence(-F.lit(line), F.col("side") - 1)).alias("dx"))
    edge = lambda d: (F.col(d) < 0) | (F.col(d) >= F.col("side") - line)
    corner = (F.col("dx") < 0) & (F.col("dy") < 0)
    paint = F.when(F.col("is_included") & (edge("dx") | edge("dy")) & ~corner, 2).when(~F.col("is_included") & (F.col("dx") >= 0) & (F.col("dy") >= 0) & F.lit(blank), 1)
    paint = box.select("slide_id", (F.col("px") + F.col("dx")).alias("x"), (F.col("py") + F.col("dy")).alias("y"), paint.alias("paint")).where("paint IS NOT NULL").groupBy("slide_id", "x", "y").agg(F.max("paint").alias("paint"))
    out = pixels.join(paint.hint("merge"), ["slide_id", "x", "y"], "left")
    return out.select(*pixels.columns[: len(pixels.columns) - 3], *(F.when(F.col("paint") == 2, 255).when(F.col("paint") == 1, 0).otherwise(F.col(c)).cast("smallint").alias(c) for c in "rgb"))
