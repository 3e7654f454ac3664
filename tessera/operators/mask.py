"""Tissue masks over pixel tables, in DataFrame operations; where connected parts are asked for, all masks in kernels, a slide at a time.

A thumbnail is at most some hundred thousand pixels, so a window over one slide is small; slides are what there are many of.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import colour
from ..session import ship
from . import kernels

MASKS = ("otsu", "blue", "red", "green", "black", "gray", "folds")


def mask_scale(last_downsample: Column, given: int | None = None) -> Column:
    return F.lit(given) if given else F.least(F.lit(64), last_downsample.cast("int"))


def otsu(values: DataFrame, key: str, value: str, bins: int = 256) -> DataFrame:
    """(key, threshold) of each group: the bin centre with the greatest variance between the sides, the first of equals.

    Values are counted by bin before the shuffle; the running sums then go over `bins` rows a group. A group of one
    value has that value. A pixel is above its threshold if strictly greater.
    """
    ends = values.groupBy(key).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    binned = values.join(ends, key).where("lo < hi")
    bin_ = F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)).cast("int")
    counts = binned.groupBy(key, bin_.alias("bin")).agg(F.count("*").alias("n"))
    frame = ends.where("lo < hi").withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    full = frame.join(counts, [key, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("c", F.col("lo") + (F.col("bin") + 0.5) * (F.col("hi") - F.col("lo")) / bins)
    # what lies above a bin is the whole less what lies up to it: a frame that runs to the end would sum the rest again at every bin
    up, every = Window.partitionBy(key).orderBy("bin"), Window.partitionBy(key)
    mass = F.col("n") * F.col("c")
    s = full.select(key, "bin", "c", F.sum("n").over(up).alias("w1"), F.sum("n").over(every).alias("w"), F.sum(mass).over(up).alias("s1"), F.sum(mass).over(every).alias("s"))
    s = s.where(F.col("bin") < bins - 1).selectExpr(f"`{key}`", "bin", "c", "w1", "w - w1 AS w2", "s1", "s - s1 AS s2")
    s = s.withColumn("between", F.col("w1") * F.col("w2") * F.pow(F.col("s1") / F.greatest("w1", F.lit(1)) - F.col("s2") / F.greatest("w2", F.lit(1)), F.lit(2)))
    best = s.groupBy(key).agg(F.max_by("c", F.struct("between", -F.col("bin"))).alias("threshold"))
    return best.union(ends.where("lo = hi").select(key, F.col("lo").cast("double")))


def dilated_all(pixels: DataFrame, sizes: dict[str, int], keys: tuple[str, str, str] = ("slide_id", "x", "y")) -> DataFrame:
    """pixels with each boolean column grown by a window of its size, one axis after the other. Even windows reach further back.

    All columns share two window operators, whatever their sizes: the frames differ, the orders don't.
    """
    slide, x, y = keys
    for along, order in ((y, x), (x, y)):
        rows = Window.partitionBy(slide, along).orderBy(order)
        # a pixel is set by those up to size // 2 before it and the rest of the window behind it
        pixels = pixels.withColumns({c: F.max(c).over(rows.rangeBetween(-(n // 2), n - 1 - n // 2)) for c, n in sizes.items()})
    return pixels


def dilated(pixels: DataFrame, column: str, size: int, keys: tuple[str, str, str] = ("slide_id", "x", "y")) -> DataFrame:
    return dilated_all(pixels, {column: size}, keys)


def equalised(values: DataFrame, key: str, value: str) -> DataFrame:
    """values with `equalised`: histogram equalisation to 0..255 within each group; all 0 in a group of one value."""
    counts = values.groupBy(key, value).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(key).orderBy(value))
    every = Window.partitionBy(key)
    table = counts.select(key, value, upto.alias("upto"), F.sum("n").over(every).alias("all"), F.min_by("n", value).over(every).alias("base"))
    level = F.when(F.col("all") == F.col("base"), 0).otherwise(F.floor((F.col("upto") - F.col("base")) * 255.0 / F.when(F.col("all") == F.col("base"), 1).otherwise(F.col("all") - F.col("base")) + 0.5)).cast("int")
    return values.join(table.select(key, value, level.alias("equalised")), [key, value])


def _hot(pixels: DataFrame) -> DataFrame:
    """pixels with `otsu`: heat above the slide's threshold. They are dealt out by slide once; windows over a slide's rows and columns then need no further exchange."""
    hot = pixels.repartition("slide_id").withColumn("heat", colour.heat(F.col("r"), F.col("g"), F.col("b")))
    hot = hot.hint("merge")  # pixels look few to the planner, which would broadcast them; dealt out by slide, they merge without an exchange
    return hot.join(otsu(hot, "slide_id", "heat"), "slide_id").withColumn("otsu", F.col("heat") > F.col("threshold")).drop("heat", "threshold")


def otsu_mask(pixels: DataFrame) -> DataFrame:
    """pixels with `otsu`: heat above the slide's threshold, grown by 3 x 3."""
    return dilated(_hot(pixels), "otsu", 3)


#: How far each mark is grown, and the share of the tissue beyond which its mask is ignored.
_GROWN = {"otsu": 3, "blue": 6, "red": 3, "green": 3, "black": 3, "gray": 3}
_IGNORED = {"blue": 0.4, "red": 0.4, "gray": 0.6}


def _marked(pixels: DataFrame, names: tuple[str, ...], mild: bool = False) -> DataFrame:
    """pixels with one boolean column for each name: the pen's colour, or not gray."""
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    return pixels.withColumns({n: ~colour.is_gray(r, g, b) if n == "gray" else colour.pen(n, r, g, b, mild) for n in names})


def colour_masks(pixels: DataFrame, names: tuple[str, ...], limits: dict[str, float] | None = None) -> DataFrame:
    """pixels (with otsu and the grown marks) with each mark turned into a mask: true where the pixel stays.

    Pen masks are the complement of the grown mark; gray is what isn't gray, grown. Where a mark covers more than its
    limit of the slide's tissue, its mask is ignored (all true); so it is where there is no tissue at all.
    """
    limits = _IGNORED | (limits or {})
    out = pixels
    slide = Window.partitionBy("slide_id")
    tissue = F.count_if("otsu").over(slide)
    cols = {}
    for name in names:
        ignored = F.lit(False)
        if name in limits:
            ignored = F.coalesce(F.try_divide(F.count_if(name).over(slide), tissue) > limits[name], F.lit(True))
        cols[name] = ignored | (F.col(name) if name == "gray" else ~F.col(name))
    return out.withColumns(cols)


def tissue_mask(pixels: DataFrame, masks: tuple[str, ...] = MASKS[:6], red_pen_thresh: float = 0.4, blue_pen_thresh: float = 0.4, clean: bool = True, compat: bool = False, mild: bool = False) -> DataFrame:
    """(slide_id, mx, my, tissue): the masks combined, small parts removed and small holes filled."""
    names = tuple(m for m in masks if m not in ("otsu", "folds"))
    limits = {"red": red_pen_thresh, "blue": blue_pen_thresh}
    if clean or "folds" in masks:
        ship(pixels.sparkSession)
        run = _whole(masks, names, _IGNORED | limits, clean, compat, mild)
        return pixels.select("slide_id", "x", "y", "r", "g", "b").groupBy("slide_id").applyInArrow(run, "slide_id string, mx int, my int, tissue boolean")
    out = dilated_all(_marked(_hot(pixels), names, mild), {m: _GROWN[m] for m in ("otsu", *names)})
    out = colour_masks(out, names, limits) if names else out
    tissue = F.lit(True)
    for m in masks:
        tissue = tissue & F.col(m)
    return out.select("slide_id", F.col("x").alias("mx"), F.col("y").alias("my"), tissue.alias("tissue"))


def _whole(masks: tuple[str, ...], names: tuple[str, ...], limits: dict[str, float], clean: bool, compat: bool, mild: bool):
    """All masks of one slide in kernels: connected parts need the whole of it at once, and then the other masks cost neither sorts nor joins of pixels. A pixel without a channel has heat 0 and no pen mark of its own."""

    def run(slide: pa.Table) -> pa.Table:
        x, y = (slide.column(c).to_numpy() for c in "xy")
        r, g, b = (slide.column(c).fill_null(0).to_numpy().astype(np.int16) for c in "rgb")
        known = {c: slide.column(c).is_valid().to_numpy() for c in "rgb"}
        apart = lambda p, q, d: np.where(known[p] & known[q], d, 0)  # noqa: E731  as greatest() takes nulls
        rg, bg, rb = apart("r", "g", r - g), apart("b", "g", b - g), apart("r", "b", r - b)
        marks = {n: np.maximum(np.maximum(abs(rg), abs(rb)), abs(bg)) > 15 if n == "gray" else colour.pen(n, r, g, b, mild) & known["r"] & known["g"] & known["b"] for n in names}
        heat = np.minimum(np.maximum(rg, 0), np.maximum(bg, 0)).astype(np.int64)
        out = kernels.tissue(x, y, (r, g, b), marks, _GROWN, limits, heat, tuple(m for m in masks if m != "folds"), "folds" in masks, clean, compat)
        return pa.table([slide.column("slide_id"), slide.column("x"), slide.column("y"), pa.array(out)], names=["slide_id", "mx", "my", "tissue"])

    return run


def component_counts(pixels: DataFrame, value: str, thresholds: tuple[float, ...]) -> DataFrame:
    """(slide_id, threshold, parts): connected parts of value > threshold on each slide."""
    ship(pixels.sparkSession)

    def run(slide: pd.DataFrame) -> pd.DataFrame:
        x, y = slide["x"].to_numpy(), slide["y"].to_numpy()
        image = np.full((y.max() + 1, x.max() + 1), -np.inf)
        image[y, x] = slide[value].to_numpy()
        return pd.DataFrame({"slide_id": slide["slide_id"].iloc[0], "threshold": thresholds, "parts": [kernels.components(image > t)[1] for t in thresholds]})

    return pixels.select("slide_id", "x", "y", value).groupBy("slide_id").applyInPandas(run, "slide_id string, threshold double, parts int")


def component_sizes(mask: DataFrame, diagonal: bool = True) -> DataFrame:
    """(slide_id, part, area, is_largest) of each slide's connected parts."""
    ship(mask.sparkSession)

    def run(slide: pd.DataFrame) -> pd.DataFrame:
        x, y = slide["mx"].to_numpy(), slide["my"].to_numpy()
        image = np.zeros((y.max() + 1, x.max() + 1), bool)
        image[y, x] = slide["tissue"].to_numpy()
        labels, n = kernels.components(image, diagonal)
        area = np.bincount(labels.ravel(), minlength=n + 1)[1:]
        return pd.DataFrame({"slide_id": [slide["slide_id"].iloc[0]] * n, "part": np.arange(1, n + 1), "area": area, "is_largest": area == (area.max() if n else 0)})

    return mask.groupBy("slide_id").applyInPandas(run, "slide_id string, part int, area long, is_largest boolean")


def masked_pixels(pixels: DataFrame, mask: DataFrame) -> DataFrame:
    """pixels with those outside the mask black."""
    out = pixels.join(mask.withColumnsRenamed({"mx": "x", "my": "y"}).hint("merge"), ["slide_id", "x", "y"])  # neither side may be broadcast
    return out.select("slide_id", "x", "y", *(F.when(F.col("tissue"), F.col(c)).otherwise(F.lit(0)).cast("smallint").alias(c) for c in "rgb"))


def mask_attributes(mask: DataFrame) -> DataFrame:
    """width, height, tissue cells and their share of each slide's mask."""
    return mask.groupBy("slide_id").agg((F.max("mx") + 1).alias("width"), (F.max("my") + 1).alias("height"), F.count_if("tissue").alias("tissue_cells"), F.avg(F.col("tissue").cast("int")).alias("tissue_share"))
