"""Stain statistics and Reinhard normalisation over pixel tables; the same on tiles held as bytes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import colour
from . import kernels

_LAB = (("L", "LL"), ("a", "aa"), ("b", "bb"))


def od_statistics(pixels: DataFrame, key: str, beta: float | None = 0.15, light: float = 240.0) -> DataFrame:
    """Per group: n and the six sample covariances of the optical densities of pixels that are dense in every channel (all, if beta is None)."""
    od = pixels.select(key, *(colour.optical_density(F.col(c), light).alias(c) for c in "rgb"))
    if beta is not None:
        od = od.where((F.col("r") >= beta) & (F.col("g") >= beta) & (F.col("b") >= beta))
    pairs = [(a, b) for i, a in enumerate("rgb") for b in "rgb"[i:]]
    return od.groupBy(key).agg(F.count("*").alias("n"), *(F.covar_samp(a, b).alias(f"cov_{a}{b}") for a, b in pairs))


def od_percentiles(pixels: DataFrame, key: str, shares: tuple[float, ...] = (0.01, 0.99), light: float = 240.0) -> DataFrame:
    """Per group: linearly interpolated percentiles of each channel's optical density."""
    od = pixels.select(key, *(colour.optical_density(F.col(c), light).alias(c) for c in "rgb"))
    return od.groupBy(key).agg(*(F.percentile(c, F.lit(s)).alias(f"{c}_p{round(100 * s)}") for c in "rgb" for s in shares))


def lab_statistics(pixels: DataFrame, key: str, masked: bool = True) -> DataFrame:
    """Per group: mean and deviation of L, a, b. masked: population deviation, without pixels that are black or white in L; else sample deviation over all."""
    # a channel may be named b, so the Lab columns have names of their own
    out = colour.with_lab(pixels.select(key, "r", "g", "b"), ("LL", "aa", "bb"))
    # a condition within the sums: a filter would be pushed below, with all of Lab's arithmetic in it once more
    counts = (F.col("LL") > 0) & (F.col("LL") < 100) if masked else F.lit(True)
    own = lambda c: F.when(counts, F.col(c))
    spread = F.stddev_pop if masked else F.stddev_samp
    return out.groupBy(key).agg(*(F.avg(own(c)).alias(f"mean_{n}") for n, c in _LAB), *(spread(own(c)).alias(f"std_{n}") for n, c in _LAB))


def reinhard(pixels: DataFrame, key: str, masked: bool = True) -> DataFrame:
    """pixels with r, g, b normalised: L's contrast is scaled about its mean, a and b move to the target means.

    The scale is 1 + q with q = (target - own deviation) / target, .05 where that isn't positive.
    """
    stats = lab_statistics(pixels, key, masked)
    # from the left, so that the pixels, which look few to the planner, are never what it broadcasts
    full = colour.with_lab(pixels.where(F.col(key).isNotNull()), ("LL", "aa", "bb")).join(stats, key, "left")
    q = (kernels.LAB_STDS[0] - F.col("std_L")) / kernels.LAB_STDS[0]
    full = full.withColumn("__q", F.when(q <= 0, 0.05).otherwise(q))
    moved = {"LL": F.col("mean_L") + (F.col("LL") - F.col("mean_L")) * (1 + F.col("__q")), "aa": kernels.LAB_MEANS[1] + (F.col("aa") - F.col("mean_a")), "bb": kernels.LAB_MEANS[2] + (F.col("bb") - F.col("mean_b"))}
    back = colour.with_rgb(full.withColumns(moved), ("LL", "aa", "bb"))
    return back.select(*(c for c in pixels.columns if c not in ("r", "g", "b")), *(F.floor(F.col(c) * 255).cast("smallint").alias(c) for c in "rgb"))


def reinhard_tile(tile: np.ndarray, variant: str = "masked") -> np.ndarray | None:
    """The same on one tile; None if no pixel counts."""
    m = np.array(colour.RGB_XYZ)
    c = tile.reshape(-1, 3) / 255.0
    c = np.where(c > 0.04045, ((c + 0.055) / 1.055) ** 2.4, c / 12.92) @ m.T / np.array(colour.WHITE)
    f = np.where(c > 0.008856, np.cbrt(c), 7.787 * c + 16 / 116)
    lab = np.stack([116 * f[:, 1] - 16, 500 * (f[:, 0] - f[:, 1]), 200 * (f[:, 1] - f[:, 2])], axis=1)
    own = lab[(lab[:, 0] > 0) & (lab[:, 0] < 100)] if variant == "masked" else lab
    if len(own) < 2:
        return None
    mean, std = own.mean(axis=0), own.std(axis=0, ddof=0 if variant == "masked" else 1)
    q = (kernels.LAB_STDS[0] - std[0]) / kernels.LAB_STDS[0]
    q = 0.05 if q <= 0 else q
    L, a, b = mean[0] + (lab[:, 0] - mean[0]) * (1 + q), kernels.LAB_MEANS[1] + lab[:, 1] - mean[1], kernels.LAB_MEANS[2] + lab[:, 2] - mean[2]
    y = (L + 16) / 116
    v = np.stack([a / 500 + y, y, y - b / 200], axis=1)
    v = np.where(v > 0.2068966, v**3, (v - 16 / 116) / 7.787) * np.array(colour.WHITE) @ np.linalg.inv(m).T
    v = np.where(v > 0.0031308, 1.055 * np.maximum(v, 0) ** (1 / 2.4) - 0.055, v * 12.92)
    return (np.clip(v, 0, 1) * 255).astype(np.uint8).reshape(tile.shape)
