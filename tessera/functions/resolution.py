"""Resolution of slides: microns per pixel and magnification, read from headers or looked up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Microns per pixel and the magnification that goes with it, in order of mpp.
SCALE = ((0.1, 100.0), (0.167, 60.0), (0.25, 40.0), (0.5, 20.0), (1.0, 10.0), (2.0, 5.0), (4.0, 2.5), (8.0, 1.25), (16.0, 0.625), (32.0, 0.3125))


def nearest(value: Column, table: list[tuple[float, float]]) -> Column:
    """The entry of the key nearest to value, as one CASE over the midpoints. A midpoint belongs to the key above; values beyond the ends to the end."""
    table = sorted(table)
    out = None
    for (low, entry), (high, _) in zip(table[:-1], table[1:], strict=True):
        # midpoints have at most four decimals; rounding the value to three first can't move it past one
        below = F.round(value, 3) < F.lit((low + high) / 2)
        out = F.when(below, F.lit(entry)) if out is None else out.when(below, F.lit(entry))
    return F.when(value.isNull(), F.lit(None).cast("double")).otherwise(out.otherwise(F.lit(table[-1][1])))


def closest_mpp(mpp: Column) -> Column:
    return nearest(mpp, [(k, k) for k, _ in SCALE])


def mpp_to_magnification(mpp: Column) -> Column:
    return nearest(mpp, list(SCALE))


def magnification_to_mpp(magnification: Column) -> Column:
    return nearest(magnification, [(m, k) for k, m in SCALE])


def size_by_magnification(magnification: Column, pixels: int, target: float) -> Column:
    """Side at level 0 of a tile of so many pixels at the target magnification; the scale is floored first (40 to 15 is 2)."""
    return (F.floor(magnification / F.lit(float(target))) * pixels).cast("int")


def size_by_ratio(magnification: Column, pixels: int, target: float) -> Column:
    """As above without flooring the scale: 40 to 15 is 2.66."""
    return (F.lit(float(pixels)) * magnification / F.lit(float(target))).cast("int")


def size_by_mpp(mpp: Column, pixels: int, target: float) -> Column:
    return F.floor(F.lit(float(target) * pixels) / mpp).cast("int")


def header(slides: DataFrame, compat: bool = False, standard_magnification: float | None = None, standard_mpp: float | None = None) -> DataFrame:
    """slides with magnification, mpp_x, mpp_y (double) and closest_mpp.

    Each mpp stands in for the other; a missing mpp comes from the magnification and a missing magnification from the
    mpp; a magnification that contradicts the mpp gives way to it. Slides with neither take the standard values, if
    any. As older runs had it (compat), a missing objective power is 0, not missing, so neither fallback applies.
    """
    power = F.floor(F.expr("try_cast(objective_power AS double)"))
    power = F.when(F.col("objective_power").isNull(), F.lit(0 if compat else None)).otherwise(power).cast("double")
    mx, my = F.expr("try_cast(mpp_x AS double)"), F.expr("try_cast(mpp_y AS double)")
    out = slides.select("*", power.alias("__power"), F.coalesce(mx, my).alias("__mx"), F.coalesce(my, mx).alias("__my"))
    if not compat:
        both = F.col("__power").isNull() & F.col("__mx").isNull()
        if standard_magnification is not None:
            out = out.withColumn("__power", F.when(both, F.lit(float(standard_magnification))).otherwise(F.col("__power")))
        elif standard_mpp is not None:
            out = out.withColumn("__mx", F.when(both, F.lit(float(standard_mpp))).otherwise(F.col("__mx"))).withColumn("__my", F.coalesce("__my", "__mx"))
    known = F.col("__power") != 0
    mpp = lambda c: F.coalesce(F.col(c), F.when(known, magnification_to_mpp(F.col("__power"))))
    out = out.withColumns({"__mx": mpp("__mx"), "__my": mpp("__my")})
    by_mpp = mpp_to_magnification(F.col("__mx"))
    magnification = F.coalesce(by_mpp, F.col("__power"))
    drop = [c for c in ("mpp_x", "mpp_y", "magnification", "closest_mpp") if c in slides.columns]
    return out.select(*(c for c in slides.columns if c not in drop), F.col("__mx").alias("mpp_x"), F.col("__my").alias("mpp_y"), magnification.alias("magnification"), closest_mpp(F.col("__mx")).alias("closest_mpp"))


def checked(slides: DataFrame, desired_magnification: float) -> DataFrame:
    """Resolved slides with error and step: null where all is well, else which property is missing or that tiles would be enlarged."""
    lack = F.array_compact(F.array(*(F.when(F.col(c).isNull() | (F.col(c) == 0), F.lit(n)) for c, n in (("magnification", "magnification"), ("mpp_x", "mpp"), ("width", "width"), ("height", "height")))))
    missing = F.size(lack) > 0
    small = F.col("magnification") < F.lit(float(desired_magnification))
    error = F.when(missing, F.concat(F.lit("missing: "), F.array_join(lack, ", "))).when(small, F.lit("magnification below the desired one"))
    return slides.withColumns({"error": error, "step": F.when(missing, "Property Check").when(small, "Resolution Sanity Check")})


def comment_fields(comment: Column) -> Column:
    """mpp, width and height from a scanner's free-text comment; null where it doesn't say."""
    of = lambda pattern, kind: F.nullif(F.regexp_extract(comment, pattern, 1), F.lit("")).cast(kind)
    return F.struct(of(r"MPP\s*=\s*([0-9.]+)", "double").alias("mpp"), of(r"OriginalWidth\s*=\s*([0-9]+)", "int").alias("width"), of(r"(?i)OriginalHeight\s*=\s*([0-9]+)", "int").alias("height"))
