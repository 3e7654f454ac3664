"""Tile grids: per-slide sequences of origins, tumbling or sliding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def origins(length: Column, size: Column, stride: Column) -> Column:
    """0, stride, 2 stride .. below length - size + stride: the last tile may pass the edge. Empty where the slide is too small."""
    stop = length - size + stride
    return F.when((stop > 0) & (stride > 0), F.sequence(F.lit(0), stop - 1, stride)).otherwise(F.array().cast("array<int>"))


def stride_of(size: Column, overlap: int) -> Column:
    """size // overlap: half-overlapping tiles at 2, and so on; never under one pixel."""
    return F.greatest(F.expr("1"), F.floor(size / F.lit(overlap)).cast("int")) if overlap > 1 else size


def tile_grid(slides: DataFrame, overlap: int = 1, width: str = "width", height: str = "height", size_x: str = "size", size_y: str | None = None) -> DataFrame:
    """slides exploded to a row a tile, with x and y. Rows without a size have no tiles."""
    size_y = size_y or size_x
    xs = origins(F.col(width), F.col(size_x), stride_of(F.col(size_x), overlap))
    ys = origins(F.col(height), F.col(size_y), stride_of(F.col(size_y), overlap))
    return slides.withColumn("y", F.explode(ys)).withColumn("x", F.explode(xs))
