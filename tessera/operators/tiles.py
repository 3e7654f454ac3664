"""Operations on tiles held as raw bytes (height x width x 3), in Arrow batches; a tile that a step rejects leaves the table.

Steps are named functions from a tile to a tile or None and may record numbers by name. Registered ones can be put in any
order; the default order is blur, then stain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import kernels

Step = Callable[[np.ndarray, dict], "np.ndarray | None"]
_STEPS: dict[str, Callable[..., Step]] = {}


def tile_op(name: str):
    """Registers a function of settings that makes a step."""

    def add(make: Callable[..., Step]) -> Callable[..., Step]:
        _STEPS[name] = make
        return make

    return add


def step(name: str, **settings) -> Step:
    if name not in _STEPS:
        raise ValueError(f"no such tile operation: {name}; there are {', '.join(sorted(_STEPS))}")
    return _STEPS[name](**settings)


@tile_op("blur")
def blur(threshold: float = 0.015, variant: str = "laplacian") -> Step:
    """Rejects tiles of at most the threshold; records laplacian_var of all."""

    def run(tile: np.ndarray, notes: dict) -> np.ndarray | None:
        notes["laplacian_var"] = kernels.sharpness(tile, variant)
        return tile if notes["laplacian_var"] > threshold else None

    return run


@tile_op("macenko")
def macenko(strict: bool = False, **settings) -> Step:
    return lambda tile, notes: kernels.macenko(tile, strict=strict, **settings)


@tile_op("reinhard")
def reinhard(variant: str = "masked") -> Step:
    from .stain import reinhard_tile

    return lambda tile, notes: reinhard_tile(tile, variant)


@tile_op("stainnet")
def stainnet(model: Callable[[np.ndarray], np.ndarray] | None = None) -> Step:
    """A learned normaliser that the caller brings; nothing is fetched."""
    if model is None:
        raise ValueError("stainnet needs model=, a function from a tile to a tile")
    return lambda tile, notes: model(tile)


@tile_op("resize")
def resize(side: int, how: str = "bilinear") -> Step:
    return lambda tile, notes: kernels.resized(tile, side, how)


def _image(raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(size, -1, 3)


def apply(tiles: DataFrame, steps: list[Step], keep_rejected: bool = False) -> DataFrame:
    """tiles (.., size int, tile binary) after the steps, with laplacian_var (null unless a step records it).

    Rejected tiles go, or stay with a null tile (keep_rejected). A null tile passes through as rejected.
    """
    ship(tiles.sparkSession)
    names = [c for c in tiles.columns if c not in ("tile", "size", "laplacian_var")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            images, sizes, variances = [], [], []
            for raw, size in zip(b.column("tile").to_pylist(), b.column("size").to_pylist(), strict=True):
                notes: dict = {}
                image = _image(raw, size) if raw is not None else None
                for s in steps:
                    if image is None:
                        break
                    image = s(image, notes)
                images.append(None if image is None else np.ascontiguousarray(image).tobytes())
                sizes.append(size if image is None else image.shape[0])
                variances.append(notes.get("laplacian_var"))
            out = pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(sizes, pa.int32()), pa.array(variances, pa.float64()), pa.array(images, pa.binary())], [*names, "size", "laplacian_var", "tile"])
            yield out if keep_rejected else out.filter(pa.array([x is not None for x in images], pa.bool_()))

    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tiles.schema.fields if f.name in names)
    return tiles.select(*names, "size", "tile").mapInArrow(run, f"{rest}, size int, laplacian_var double, tile binary")


def augmentations(tiles: DataFrame, copies: int) -> DataFrame:
    """Each tile as itself (copy 0) and so many copies, each with its seed from slide, origin and number: reruns agree."""
    return tiles.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies)))).withColumn("seed", F.xxhash64("slide_id", "x", "y", "copy"))


def augmented(tiles: DataFrame, copies: int) -> DataFrame:
    """As augmentations, with the copies' pixels changed."""
    ship(tiles.sparkSession)
    full = augmentations(tiles, copies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [raw if k == 0 or raw is None else kernels.augmented(_image(raw, n), seed).tobytes() for raw, n, k, seed in zip(*(b.column(c).to_pylist() for c in ("tile", "size", "copy", "seed")), strict=True)]
            yield b.set_column(b.schema.get_field_index("tile"), "tile", pa.array(new, pa.binary()))

    return full.mapInArrow(run, full.schema)


def laplacian_sql(cells: DataFrame, side: int, keys: str = "slide_id", value: str = "v") -> DataFrame:
    """(key, laplacian_var) of square gray tiles held as cells (key, x, y, v), as a stencil join with mirrored borders.

    The diagonal neighbours count twice, the centre minus eight times. The kernel does the same to tiles held as bytes.
    """
    mirror = lambda c: F.when(c < 0, -c).when(c >= side, 2 * side - 2 - c).otherwise(c)
    taps = F.explode(F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(w).alias("w")) for dx, dy, w in ((-1, -1, 2), (1, -1, 2), (-1, 1, 2), (1, 1, 2), (0, 0, -8)))))
    need = cells.select(keys, "x", "y", taps.alias("t")).select(keys, "x", "y", mirror(F.col("x") + F.col("t.dx")).alias("sx"), mirror(F.col("y") + F.col("t.dy")).alias("sy"), F.col("t.w").alias("w"))
    edges = need.join(cells.select(keys, F.col("x").alias("sx"), F.col("y").alias("sy"), F.col(value).alias("sv")), [keys, "sx", "sy"]).groupBy(keys, "x", "y").agg(F.sum(F.col("w") * F.col("sv")).alias("e"))
    return edges.groupBy(keys).agg(F.var_pop("e").alias("laplacian_var"))


def variance_histogram(tiles: DataFrame, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n): tiles by laplacian_var, in bins 1..bins; 0 and bins + 1 are beyond the ends.

    A value on an edge goes by its quotient by a bin's width, in double precision: 0.6 / 0.2 is under 3. width_bucket divides by the range instead.
    """
    v = F.col("laplacian_var")
    bin_ = F.when(v < low, 0).when(v >= high, bins + 1).otherwise(F.floor((v - low) / F.lit((high - low) / bins)) + 1).cast("long")
    return tiles.where("laplacian_var IS NOT NULL").groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))


def qc_samples(tiles: DataFrame, per_slide: int = 5, seed: int = 0, by: Column | None = None) -> DataFrame:
    """Up to so many tiles of each slide, blurry and sharp apart, drawn by a seeded hash of their origin, or in order of `by`."""
    from pyspark.sql import Window

    draw = Window.partitionBy("slide_id", "is_blurry").orderBy(F.xxhash64("x", "y", F.lit(seed)) if by is None else by, "x", "y")
    return tiles.withColumn("rank", F.row_number().over(draw)).where(F.col("rank") <= per_slide)
