"""Colour arithmetic on pixel columns r, g, b (0 to 255)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds (red, green, blue) of pen marks.
BLUE_PEN = ((60, 120, 190), (120, 170, 200), (175, 210, 230), (145, 180, 210), (37, 95, 160), (30, 65, 130), (130, 155, 180), (40, 35, 85), (30, 20, 65), (90, 90, 140), (60, 60, 120), (110, 110, 175))
RED_PEN = ((150, 80, 90), (110, 20, 30), (185, 65, 105), (195, 85, 125), (220, 115, 145), (125, 40, 70), (100, 50, 65), (85, 25, 45))
GREEN_PEN = ((150, 160, 140), (70, 110, 110), (45, 115, 100), (30, 75, 60), (195, 220, 210), (225, 230, 225), (170, 210, 200), (20, 30, 20), (50, 60, 40), (30, 50, 35), (65, 70, 60), (100, 110, 105), (165, 180, 180), (140, 140, 150), (185, 195, 195))
BLACK_PEN = ((50, 50, 50), (30, 30, 30), (40, 40, 40), (20, 20, 20), (10, 10, 10), (0, 0, 0))
#: The milder list leaves out one blue triple and two black ones.
MILD = {"blue": tuple(t for t in BLUE_PEN if t != (90, 90, 140)), "black": tuple(t for t in BLACK_PEN if t not in ((40, 40, 40), (0, 0, 0)))}
# sRGB to XYZ, the inverse, and the white point.
RGB_XYZ = ((0.412453, 0.357580, 0.180423), (0.212671, 0.715160, 0.072169), (0.019334, 0.119193, 0.950227))
WHITE = (0.95047, 1.0, 1.08883)


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def pen(colour: str, r: Column, g: Column, b: Column, mild: bool = False) -> Column:
    """Whether a pixel is of a pen's colour: any of the colour's triples holds."""
    above = {"blue": (False, False, True), "red": (True, False, False), "green": (False, True, True), "black": (False, False, False)}[colour]
    triples = {"blue": BLUE_PEN, "red": RED_PEN, "green": GREEN_PEN, "black": BLACK_PEN}[colour]
    triples = MILD.get(colour, triples) if mild else triples
    return _any(reduce(lambda p, q: p & q, (c > v if up else c < v for c, v, up in zip((r, g, b), t, above, strict=True))) for t in triples)


def is_gray(r: Column, g: Column, b: Column, tolerance: int = 15) -> Column:
    return (F.abs(r - g) <= tolerance) & (F.abs(r - b) <= tolerance) & (F.abs(g - b) <= tolerance)


def heat(r: Column, g: Column, b: Column) -> Column:
    """How far red and blue both exceed green: high for haematoxylin and eosin, 0 for white, gray and green."""
    return F.least(F.greatest(r - g, F.lit(0)), F.greatest(b - g, F.lit(0)))


def gray(r: Column, g: Column, b: Column, variant: str = "byte") -> Column:
    """Luminance from 0 to 1. byte: in 14-bit fixed point, rounded to a byte; float: exact weights; display: weights of linear displays."""
    if variant == "byte":
        return F.shiftright((4899 * r + 9617 * g + 1868 * b + 8192).cast("int"), 14) / F.lit(255.0)
    w = {"float": (0.299, 0.587, 0.114), "display": (0.2125, 0.7154, 0.0721)}[variant]
    return (w[0] * r + w[1] * g + w[2] * b) / F.lit(255.0)


def saturation(r: Column, g: Column, b: Column) -> Column:
    """S of HSV as a byte."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    return F.when(top == 0, 0).otherwise(F.floor((top - low) * 255.0 / F.when(top == 0, 1).otherwise(top) + 0.5)).cast("int")


def optical_density(p: Column, light: float = 240.0) -> Column:
    return -F.log(F.greatest(p, F.lit(1)) / F.lit(light))


def with_lab(pixels: DataFrame, names: tuple[str, str, str] = ("L", "a", "b")) -> DataFrame:
    """pixels with CIE L (0 to 100), a, b of the sRGB bytes r, g, b. In steps, so that no expression holds another many times over."""
    linear = lambda c: F.when(c / 255.0 > 0.04045, F.pow((c / 255.0 + 0.055) / 1.055, F.lit(2.4))).otherwise(c / 255.0 / 12.92)
    out = pixels.withColumns({f"__l{c}": linear(F.col(c)) for c in "rgb"})
    out = out.withColumns({f"__{n}": sum(w * F.col(f"__l{c}") for w, c in zip(row, "rgb", strict=True)) / F.lit(white) for n, row, white in zip("xyz", RGB_XYZ, WHITE, strict=True)})
    out = out.withColumns({f"__{n}": F.when(F.col(f"__{n}") > 0.008856, F.pow(F.col(f"__{n}"), F.lit(1 / 3))).otherwise(7.787 * F.col(f"__{n}") + 16 / 116) for n in "xyz"})
    x, y, z = (F.col(f"__{n}") for n in "xyz")
    out = out.withColumns(dict(zip(names, (116.0 * y - 16.0, 500.0 * (x - y), 200.0 * (y - z)), strict=True)))
    return out.drop(*(f"__l{c}" for c in "rgb"), *(f"__{n}" for n in "xyz"))


def with_rgb(pixels: DataFrame, names: tuple[str, str, str] = ("L", "a", "b")) -> DataFrame:
    """pixels with r, g, b (0 to 1, clamped) of CIE L, a, b in the named columns, which go."""
    L, a, b = (F.col(n) for n in names)
    out = pixels.withColumn("__y", (L + 16.0) / 116.0).withColumns({"__x": a / 500.0 + F.col("__y"), "__z": F.col("__y") - b / 200.0})
    out = out.withColumns({f"__{n}": F.when(F.col(f"__{n}") > 0.2068966, F.col(f"__{n}") * F.col(f"__{n}") * F.col(f"__{n}")).otherwise((F.col(f"__{n}") - 16 / 116) / 7.787) * F.lit(w) for n, w in zip("xyz", WHITE, strict=True)})
    out = out.withColumns({c: sum(w * F.col(f"__{n}") for w, n in zip(row, "xyz", strict=True)) for c, row in zip("rgb", inverse(RGB_XYZ), strict=True)})
    out = out.withColumns({c: F.when(F.col(c) > 0.0031308, 1.055 * F.pow(F.greatest(c, F.lit(0.0)), F.lit(1 / 2.4)) - 0.055).otherwise(F.col(c) * 12.92) for c in "rgb"})
    return out.withColumns({c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)) for c in "rgb"}).drop("__x", "__y", "__z", *names)


def inverse(m) -> list[list[float]]:
    import numpy as np

    return np.linalg.inv(np.array(m)).tolist()
